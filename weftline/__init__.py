"""weftline: a PySpark-native analytics engine for document corpora.

Plans are declared with the DataFrame and SQL API; Catalyst and AQE choose the physical strategy.
"""
