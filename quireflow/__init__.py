"""Spark-native restoration and auditing of long recognised documents."""
