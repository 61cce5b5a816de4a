"""Clause analytics on Spark: regulatory and technical text as clean, typed, queryable tables."""
