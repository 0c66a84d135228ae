"""Registered queries, their inputs and their oracle SQL."""
