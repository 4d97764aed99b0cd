"""Composed plans, daily jobs, registered queries and their SQL oracles."""
