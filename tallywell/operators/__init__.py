"""Tallywell operators."""
