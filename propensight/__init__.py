"""Explainable purchase-propensity analytics on event tables, as Spark DataFrame jobs."""
