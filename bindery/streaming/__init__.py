"""Operators over unbounded tables."""
