"""Layered (bronze, silver, gold) analytics expressed as Spark DataFrame and SQL jobs."""
