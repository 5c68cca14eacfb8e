"""Readers: each returns a DataFrame."""
