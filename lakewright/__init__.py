"""Lakehouse ingestion, reconciliation, ledger and exploration operators for Spark."""
