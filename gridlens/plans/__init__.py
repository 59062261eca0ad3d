"""Composed daily jobs."""
