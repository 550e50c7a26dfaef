"""Incremental reading."""
