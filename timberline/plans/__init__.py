"""Timberline plans."""
