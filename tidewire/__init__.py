"""Spark-native engine for columnar tables in the q IPC wire format, and for training-data pipelines."""
