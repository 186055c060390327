"""Structured Streaming layers and runners."""
