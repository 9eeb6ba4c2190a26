"""Operators of a training-data pipeline: licences, secrets, duplicates, contamination, quality, toxicity, packing, HTML, WARC."""
