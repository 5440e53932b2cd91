"""Warehouse operators for change logs and behaviour logs, written on the PySpark DataFrame API."""
