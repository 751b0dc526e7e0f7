"""Readers, lookups and writers."""
