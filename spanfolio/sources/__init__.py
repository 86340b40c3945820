"""Readers, panels derived from tables, and written tables."""
