"""Cached search: pages kept for a while, and one search for callers that ask the same at once."""

from __future__ import annotations

import threading
import time
from concurrent.futures import Future
from typing import Callable

from timberline.operators.search import Query
from timberline.service.cursor import cache_key


class CachedSearch:
    def __init__(self, search: Callable[[Query], object], ttl: float = 5.0, size: int = 10_000, clock=time.monotonic):
        self.search, self.ttl, self.size, self.clock = search, ttl, size, clock
        self.pages: dict[str, tuple[float, object]] = {}
        self.running: dict[str, Future] = {}
        self.lock = threading.Lock()

    def get(self, query: Query) -> tuple[object, bool]:
        """The page, and whether it came from the cache; failures are not kept."""
        key = cache_key(query)
        with self.lock:
            kept = self.pages.get(key)
            if kept and kept[0] > self.clock():
                return kept[1], True
            future = self.running.get(key)
            own = future is None
            if own:
                future = self.running[key] = Future()
        if not own:
            return future.result(), False
        try:
            page = self.search(query)
        except BaseException as e:
            with self.lock:
                del self.running[key]
            future.set_exception(e)
            raise
        with self.lock:
            del self.running[key]
            if len(self.pages) >= self.size:
                now = self.clock()
                self.pages = {k: v for k, v in self.pages.items() if v[0] > now}
                while len(self.pages) >= self.size:
                    self.pages.pop(next(iter(self.pages)))
            self.pages[key] = (self.clock() + self.ttl, page)
        future.set_result(page)
        return page, False
