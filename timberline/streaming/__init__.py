"""Timberline streaming."""
