"""Structured Streaming ingestion of daily drops."""
