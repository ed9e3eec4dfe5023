"""Marketplace analytics on Spark: cleaning, star schema, dashboards, data quality and ML jobs."""
