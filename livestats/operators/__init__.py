"""Batch operators: ``DataFrame -> DataFrame`` functions over whole tables."""
