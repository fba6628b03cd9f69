"""Readers and writers; formats and options come from the caller."""
