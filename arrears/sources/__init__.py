"""Scans, sinks and tables."""
