"""Readers, writers and bulk extraction."""
