"""Readers: landing JSON, layer tables, raw payloads, location dimension and driver fixtures."""
