"""A token bucket for callers: refill by time, clamped costs, fails open."""

from __future__ import annotations

import math
import threading
import time


class TokenBucket:
    def __init__(self, rate: float, burst: int, clock=lambda: int(time.monotonic() * 1000)):
        self.rate, self.burst, self.clock = rate, burst, clock
        self.left, self.at, self.lock = float(burst), clock(), threading.Lock()

    def allow(self, cost: float = 1) -> tuple[bool, int]:
        """Whether the cost is taken, and else the milliseconds to wait; costs lie between 1 and the burst."""
        cost = min(max(cost, 1), self.burst)
        with self.lock:
            now = self.clock()
            self.left = min(float(self.burst), self.left + max(0, now - self.at) * self.rate / 1000)
            self.at = now
            if self.left >= cost:
                self.left -= cost
                return True, 0
            return False, math.ceil((cost - self.left) * 1000 / self.rate)

    @property
    def full(self) -> bool:
        return self.left + max(0, self.clock() - self.at) * self.rate / 1000 >= self.burst

    def wait(self, cost: float = 1, sleep=time.sleep) -> None:
        while True:
            ok, ms = self.allow(cost)
            if ok:
                return
            sleep(ms / 1000)


class Limiters:
    """A bucket per caller; a broken store of buckets lets all pass.

    Beyond ``most`` callers those whose buckets are full again are forgotten: a new
    bucket is as full.
    """

    def __init__(self, rate: float, burst: int, make=None, most: int = 10_000):
        self.make, self.most = make or (lambda: TokenBucket(rate, burst)), most
        self.buckets, self.lock = {}, threading.Lock()

    def allow(self, key: str, cost: float = 1) -> tuple[bool, int]:
        try:
            with self.lock:
                bucket = self.buckets.get(key)
                if bucket is None:
                    if len(self.buckets) >= self.most:
                        self.buckets = {k: b for k, b in self.buckets.items() if not b.full}
                    bucket = self.buckets[key] = self.make()
            return bucket.allow(cost)
        except Exception:  # noqa: BLE001  the limiter must not take the service down
            return True, 0
