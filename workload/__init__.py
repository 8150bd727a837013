"""Queries over the driver tables: each library operator on whole tables."""
