"""Operators for training-data preparation, each a job over whole tables."""
