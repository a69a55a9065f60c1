"""Operators for training-data corpora and the queries that run them over whole tables."""
