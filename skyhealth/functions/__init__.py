"""Column expressions: features, rule profiles, AQI and bands, fills, rounding, fixed values."""
