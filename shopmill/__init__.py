"""Spark-native retail warehouse: cleaning, star schema, marts, reports and order-event ingestion."""
