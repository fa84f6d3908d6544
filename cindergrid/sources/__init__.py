"""Landed feeds, the region seed and the adapters over the test tables."""
