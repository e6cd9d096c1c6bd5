"""Readers; schemas are always given, never inferred."""
