"""Relational operators: staging, marts, metrics, dashboard analytics, quality, contract, ingest."""
