"""Streaming jobs. Every query has its own checkpoint."""
