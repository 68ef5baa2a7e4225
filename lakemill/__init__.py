"""Spark-native medallion, streaming and serving analytics as lazy DataFrame operators."""
