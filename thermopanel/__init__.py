"""Hourly weather and heat-demand panel analytics as Spark DataFrame jobs."""
