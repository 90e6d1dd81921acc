"""Whole jobs: star schema, change cycle, passenger marts."""
