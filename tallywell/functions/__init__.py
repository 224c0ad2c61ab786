"""Tallywell functions."""
