"""laborstar: a PySpark-native occupational and wage warehouse.

Raw delimited or Parquet files -> cleaned star schema (one occupation
dimension, five facts) -> data-quality checks and labour-market reports,
all as DataFrame plans that run on Spark executors.
"""

__version__ = "0.1.0"
