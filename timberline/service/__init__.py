"""Timberline service layer: API keys, cursors, cache, limiter, notifier and HTTP handlers."""
