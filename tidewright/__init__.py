"""Batch and streaming data operators as plain PySpark DataFrame functions."""
