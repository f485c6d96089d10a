"""saleslake: layered sales data quality and analytics on PySpark."""

__version__ = "0.1.0"
