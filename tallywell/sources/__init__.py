"""Tallywell sources."""
