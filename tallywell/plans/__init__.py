"""Tallywell plans."""
