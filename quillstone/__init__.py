"""Quillstone: a PySpark-native engine for event-sourced ledger analytics."""
