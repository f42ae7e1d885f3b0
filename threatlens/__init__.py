"""Threat-indicator analytics on Spark: batch, stream, models and serving."""
