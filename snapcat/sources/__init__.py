"""Scans, sinks and the adapter from the driver tables."""
