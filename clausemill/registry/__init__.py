"""Registered queries by area; each module has QUERIES and ORACLES with the same keys."""
