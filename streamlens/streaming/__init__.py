"""Streaming jobs."""
