"""Readers; each returns DataFrames."""
