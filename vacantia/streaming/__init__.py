"""Streaming forms of the daily landing and of the weekly trend."""
