"""Batch and streaming readers, and the writers that mirror them."""
