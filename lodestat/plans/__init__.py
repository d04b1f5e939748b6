"""Whole jobs, from input paths to result tables."""
