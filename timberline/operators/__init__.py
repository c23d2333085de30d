"""Timberline operators."""
