"""Scoring of arriving batches with a saved pipeline (Structured Streaming)."""
