"""Scans, sinks, lineage and the run log."""
