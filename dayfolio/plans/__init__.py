"""Whole-table jobs composed from the operators."""
