"""Timberline sources."""
