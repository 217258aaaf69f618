"""Ledger, forecast, report, reconciliation, checks and lineage operators."""
