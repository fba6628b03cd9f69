"""Structured Streaming jobs.

Every job writes what changed in a micro-batch to ``<table>/batch_id=N`` with
overwrite, so a batch that runs again leaves the same table, and a batch costs as
much as it changes. Readers take the last row per key.
"""
