"""Operators on graph tables."""
