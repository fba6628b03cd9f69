"""Whole batch jobs, wired from the operators."""
