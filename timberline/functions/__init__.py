"""Timberline functions."""
