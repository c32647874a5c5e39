"""Spark-native analytics operators: DataFrame in, DataFrame out."""
