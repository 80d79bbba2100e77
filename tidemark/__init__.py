"""tidemark: change-capture current-state tables and event-to-sales attribution on Spark.

Every transformation is a DataFrame -> DataFrame function built from Spark SQL
built-ins; streaming entry points are thin ``foreachBatch`` wrappers around the
same functions.
"""

__version__ = "0.1.0"
