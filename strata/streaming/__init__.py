"""Structured Streaming forms of the layer jobs (ST1-ST6)."""
