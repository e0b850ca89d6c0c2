"""Tulha: a Spark-native ERP warehouse and analytics engine."""
