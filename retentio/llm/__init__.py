"""Operators for preparing training text: filters, deduplication, mixing, scans.

Nothing else in the library imports this subpackage.  Each operator is a
function of DataFrames with its own general interface; ``queries.py`` holds
the thin registered queries and their SQL, and ``corpus_pipeline.py`` at the
repository top chains five of them.
"""
