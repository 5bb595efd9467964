"""Scans, sinks and change reads."""
