"""Whole annotation runs: ``annotate`` on DataFrames, ``files`` from path to path."""
