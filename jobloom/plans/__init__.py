"""Whole runs: the batch from feeds to warehouse, and the dashboard query."""
