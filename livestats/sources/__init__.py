"""Readers: topics (S1, S2), delimited text (S4), polled dimension (S3)."""
