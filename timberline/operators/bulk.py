"""Bulk delivery with retries for single items."""

from __future__ import annotations

import time
from typing import Callable

from timberline.service.notify import backoff

OK, RETRY, DEAD = "ok", "retry", "dead"


def status_class(status: int) -> str:
    return OK if 200 <= status < 300 else RETRY if status == 429 or status >= 500 else DEAD


def deliver(items: list, send: Callable[[list], list[int]], attempts: int = 10, sleep=time.sleep) -> list[tuple[object, int]]:
    """Send items until each is stored or refused for good; returns the refused ones with their status.

    Only items that may still succeed are sent again; an answer of another
    length fails the whole request, and so does an exhausted number of attempts.
    """
    waiting, dead = list(items), []
    for attempt in range(attempts):
        try:
            answers = send(waiting)
            if len(answers) != len(waiting):
                raise OSError("the answer has another number of items")
        except OSError:
            answers = [503] * len(waiting)
        again = []
        for item, status in zip(waiting, answers):
            kind = status_class(status)
            if kind == RETRY:
                again.append(item)
            elif kind == DEAD:
                dead.append((item, status))
        if not again:
            return dead
        waiting = again
        sleep(backoff(attempt))
    raise OSError(f"{len(waiting)} items could not be stored")
