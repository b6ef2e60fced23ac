"""Retail data quality and star-schema jobs as composable Spark DataFrame operators."""
