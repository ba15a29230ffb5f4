"""Warehouse-ETL operators for PySpark: plain ``DataFrame -> DataFrame`` functions on Spark's public API."""
