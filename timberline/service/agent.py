"""The agent: tails files, batches entries, spools batches, and sends them to a collector with a window of unacknowledged ones."""

from __future__ import annotations

import datetime as dt
import json
import time
from collections import deque
from collections.abc import Callable

from timberline.service.spool import Spool, SpoolFull, replace_file
from timberline.sources.tailfile import TailReader

COUNT, BYTES, LINGER = 1000, 1 << 20, 0.2
WINDOW = 8


class Batcher:
    """Collects encoded entries; a batch is due at ``count`` entries, ``size`` bytes, or ``linger`` seconds after its first entry."""

    def __init__(self, count: int = COUNT, size: int = BYTES, linger: float = LINGER, clock=time.monotonic):
        self.count, self.size, self.linger, self.clock = count, size, linger, clock
        self.held: list[bytes] = []
        self.bytes, self.since = 0, 0.0

    def add(self, entry: bytes) -> list[bytes] | None:
        """The batch that the entry completes; an entry that doesn't fit begins the next one."""
        due = None
        if self.held and self.bytes + len(entry) > self.size:
            due = self.take()
        if not self.held:
            self.since = self.clock()
        self.held.append(entry)
        self.bytes += len(entry)
        if due is None and (len(self.held) >= self.count or self.bytes >= self.size):
            due = self.take()
        return due

    def due(self) -> list[bytes] | None:
        """The batch, if it has waited long enough."""
        return self.take() if self.held and self.clock() - self.since >= self.linger else None

    def take(self) -> list[bytes]:
        out, self.held, self.bytes = self.held, [], 0
        return out


class Agent:
    """One step reads what is new, spools due batches, and only then remembers the files' positions; another sends."""

    def __init__(self, pattern: str, spool: Spool, registry: str, agent_id: str = "agent-1", host: str | None = None, batcher: Batcher | None = None):
        self.reader, self.spool, self.registry, self.agent_id, self.host = TailReader(pattern), spool, registry, agent_id, host
        self.batcher = batcher or Batcher()
        try:
            with open(registry) as f:
                self.position = json.load(f)
        except FileNotFoundError:
            self.position = {}

    def encode(self, row: tuple) -> bytes:
        source, epoch, offset, line = row
        now = dt.datetime.now(dt.timezone.utc).isoformat()
        return json.dumps({"source": source, "epoch": epoch, "offset": offset, "message": line, "agent_id": self.agent_id, "host": self.host, "observed_at": now}).encode()

    def step(self) -> int:
        """Lines read. A full spool raises SpoolFull, and the same lines are read again by the next step."""
        rows, end = self.reader.read(self.position)
        batches, n = [], 0
        for row in rows:
            n += 1
            if batch := self.batcher.add(self.encode(row)):
                batches.append(batch)
        if self.batcher.held:  # positions are remembered with what was read, so nothing lingers beyond a step
            batches.append(self.batcher.take())
        for batch in batches:
            self.spool.append(b"\n".join(batch))
        if end != self.position:
            replace_file(self.registry, json.dumps(end).encode())
            self.position = end
        return n

    def send(self, session: Callable) -> int:
        """Batches that a collector's ``session`` has acknowledged: it takes an iterator of batches and yields an answer for each, in order."""
        waiting: deque[tuple[int, int]] = deque()

        def batches():
            for position, batch in self.spool.read():
                waiting.append(position)
                yield batch

        done = 0
        for _ in session(batches()):
            self.spool.ack(waiting.popleft())
            done += 1
        return done

    def run(self, session: Callable, stop, poll: float = 0.1) -> None:
        """Until ``stop`` is set: read, spool, send. A full spool pauses reading, a failed session is tried again; what is spooled is sent at the end."""
        while not stop.is_set():
            try:
                new = self.step()
            except SpoolFull:
                new = 0
            try:
                self.send(session)
            except OSError:
                stop.wait(1.0)
            if not new:
                stop.wait(poll)
        self.step()
        self.send(session)


def http_session(url: str, key: str, window: int = WINDOW) -> Callable:
    """A session with a collector over HTTP: up to ``window`` batches are on their way at once, answers come in order."""
    import urllib.request
    from concurrent.futures import ThreadPoolExecutor

    def post(batch: bytes) -> dict:
        request = urllib.request.Request(url, batch, {"Authorization": f"Bearer {key}", "Content-Type": "application/x-ndjson"})
        with urllib.request.urlopen(request, timeout=30) as r:
            return json.load(r)

    def session(batches):
        with ThreadPoolExecutor(window) as pool:
            running: deque = deque()
            for batch in batches:
                running.append(pool.submit(post, batch))
                while len(running) >= window:
                    yield running.popleft().result()
            while running:
                yield running.popleft().result()

    return session
