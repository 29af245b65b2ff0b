"""commerce_lake: a PySpark change-data-capture lakehouse for retail analytics.

Layers: ``sources`` (tables, change-log fixtures), ``streaming`` (bronze
ingestion), ``operators`` (change-data, filters, quality checks),
``plans`` (silver, gold, reports), ``functions`` (Column helpers).
"""

__version__ = "0.1.0"
