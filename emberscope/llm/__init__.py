"""Operators of a training-data pipeline: mixing, packing, duplicates, extraction, search, coding and scoring."""
