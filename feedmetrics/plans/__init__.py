"""Registered queries: ``(spark, sf_dir) -> DataFrame`` over the driver's tables."""
