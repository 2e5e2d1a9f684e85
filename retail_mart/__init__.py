"""retail_mart: a Spark-native retail sales & inventory mart.

Daily sales aggregate, weekly sales-and-inventory fact, monthly customer
programme, type-2 customer dimension, BI result sets and data profiling,
all expressed as DataFrame plans over Parquet.
"""

__version__ = "0.1.0"
