"""Relational operators: ranking, checks, counts, joins, repetition and lint."""
