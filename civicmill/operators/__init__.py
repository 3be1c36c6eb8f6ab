"""Joins, merges, nesting, rollups and record matching over any DataFrame."""
