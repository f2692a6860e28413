"""Whole jobs (bronze, silver, gold, training, full run) and the registered driver queries."""
