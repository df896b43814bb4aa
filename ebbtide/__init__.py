"""Change-data lake on PySpark: raw, staged and curated tables."""
