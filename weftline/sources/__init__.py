"""Readers of models, files and driver tables."""
