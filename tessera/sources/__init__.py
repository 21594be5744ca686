"""Readers, writers and ingest clean-up jobs."""
