"""Receivables analytics as lazy PySpark DataFrame functions."""
