"""tallybook: reconciliation, data-quality and KPI analytics on PySpark."""

__version__ = "0.1.0"
