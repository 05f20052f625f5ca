"""Medallion record pipelines as Spark DataFrame operators: Bronze mapping, Silver columns, Gold aggregates."""
