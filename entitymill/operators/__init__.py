"""Operators on DataFrames: dedupe, resolve, merge, map, upsert, reshape, measure."""
