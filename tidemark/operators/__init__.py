"""Operators over event tables."""
