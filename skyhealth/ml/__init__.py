"""Spark ML risk model."""
