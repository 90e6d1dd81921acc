"""Batch data operators for order and passenger analytics, written as Spark DataFrame code."""
