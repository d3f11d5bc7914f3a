"""Laboratory-result analytics on Spark: CSV to bronze, OMOP silver, gold tables, audits."""

__version__ = "0.1.0"
