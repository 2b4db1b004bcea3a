"""Vessel-position analytics on Spark: sector traffic and busiest-sector reports."""
