"""Leakage-free history features, context joins and forecasts for entities observed over seasons, on Spark."""
