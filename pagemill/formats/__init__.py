"""Formats of the engine."""
