"""Operators of a training-data pipeline over text: extraction, duplicates, scores, mixing, shards."""
