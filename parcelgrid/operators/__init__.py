"""Operators: keyed merges, similarity joins, record linkage, spatial and graph joins."""
