"""HTTP: search pages, live tail, health and metrics, on the standard library's server."""

from __future__ import annotations

import json
import time
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qsl, urlsplit

from timberline.operators import search
from timberline.operators.tail import TailFilter
from timberline.service.cache import CachedSearch
from timberline.service.cursor import encode_cursor
from timberline.service.keys import KeyMap
from timberline.service.limiter import Limiters
from timberline.streaming.hub import Hub, TooManyClients, sse


class QueryTimeout(RuntimeError):
    pass


class LogApi:
    """Answers requests: checks the key first, then the limit, then searches ``logs``: a table, a function that gives one, or a ``StoreSearch``."""

    def __init__(self, logs, keys: KeyMap, limits: Limiters | None = None, hub: Hub | None = None, ttl: float = 5.0, timeout: float = 10.0, collector=None):
        self.collector = collector
        self.logs, self.keys, self.limits, self.hub, self.timeout = logs, keys, limits, hub, timeout
        self.cached = CachedSearch(self._search, ttl)
        self.counts: Counter = Counter()

    def _search(self, query: search.Query):
        import threading

        logs = self.logs() if callable(self.logs) else self.logs  # a store has to be listed anew
        spark = logs.sparkSession
        tag = f"search-{time.monotonic_ns()}"
        timer = threading.Timer(self.timeout, spark.interruptTag, (tag,))
        timer.start()
        began = time.monotonic()
        spark.addTag(tag)
        try:
            rows, after = logs.fetch(query) if hasattr(logs, "fetch") else search.fetch(logs, query)
        except Exception as e:
            if time.monotonic() - began >= self.timeout:
                raise QueryTimeout from e
            raise
        finally:
            spark.removeTag(tag)
            timer.cancel()
        return [{k: v for k, v in r.asDict().items() if k not in ("_ms", "batch")} for r in rows], after

    def answer(self, path: str, key: str | None) -> tuple[int, dict, dict]:
        """Status, headers and body for GET of a path."""
        url = urlsplit(path)
        if url.path in ("/healthz", "/readyz"):
            return 200, {}, {"status": "ok"}
        if url.path != "/v1/logs":
            return self._error(404, "not_found", "no such path")
        if key is None or self.keys.service(key) is None:
            return self._error(401, "unauthenticated", "a valid API key is needed")
        if self.limits is not None:
            ok, ms = self.limits.allow(key)
            if not ok:
                status, headers, body = self._error(429, "rate_limited", "too many requests")
                return status, headers | {"Retry-After": str(-(-ms // 1000))}, body
        try:
            query = search.parse_query(dict(parse_qsl(url.query)))
            (rows, after), hit = self.cached.get(query)
        except search.InvalidArgument as e:
            return self._error(400, "invalid_argument", e.message, e.field)
        except QueryTimeout:
            return self._error(504, "deadline_exceeded", "the search took too long")
        except Exception:  # noqa: BLE001  callers get no internals
            return self._error(503, "unavailable", "the search failed")
        self.counts[200] += 1
        body = {"logs": rows}
        if after is not None:
            body["next_cursor"] = encode_cursor(after, query)
        return 200, {"X-Cache": "HIT" if hit else "MISS"}, body

    def _error(self, status: int, code: str, message: str, field: str = "") -> tuple[int, dict, dict]:
        self.counts[status] += 1
        return status, {}, {"error": {"code": code, "message": message} | ({"field": field} if field else {})}

    def metrics(self) -> str:
        lines = [f'http_requests_total{{status="{s}"}} {n}' for s, n in sorted(self.counts.items())]
        if self.hub:
            lines += [f"tail_{k}_total {getattr(self.hub, k)}" for k in ("consumed", "delivered", "dropped")]
        return "\n".join(lines) + "\n"


def serve(api: LogApi, host: str = "127.0.0.1", port: int = 0) -> ThreadingHTTPServer:
    """A server that is ready to run; ``serve_forever`` starts it."""

    class Handler(BaseHTTPRequestHandler):
        def log_message(self, *_) -> None:
            pass

        def key(self) -> str | None:
            value = self.headers.get("Authorization") or ""
            return value[7:] if value.startswith("Bearer ") else self.headers.get("X-API-Key")

        def do_GET(self) -> None:  # noqa: N802
            path = urlsplit(self.path).path
            if path == "/metrics":
                return self.send(200, {"Content-Type": "text/plain"}, api.metrics().encode())
            if path == "/v1/tail" and api.hub is not None:
                return self.tail()
            status, headers, body = api.answer(self.path, self.key())
            self.send(status, headers | {"Content-Type": "application/json"}, json.dumps(body, default=str).encode())

        def do_POST(self) -> None:  # noqa: N802
            service = api.keys.service(self.key() or "")
            body = self.rfile.read(int(self.headers.get("Content-Length") or 0))
            if urlsplit(self.path).path != "/v1/ingest" or api.collector is None:
                return self.send(404, {}, b"{}")
            if service is None:
                return self.send(401, {}, b"{}")
            try:
                (answer,) = api.collector.session(service, [body])
            except Exception:  # noqa: BLE001  the agent keeps the batch and sends it again
                return self.send(503, {}, b"{}")
            self.send(200, {"Content-Type": "application/json"}, json.dumps(answer).encode())

        def send(self, status: int, headers: dict, body: bytes) -> None:
            self.send_response(status)
            for k, v in (headers | {"Content-Length": str(len(body))}).items():
                self.send_header(k, v)
            self.end_headers()
            self.wfile.write(body)

        def tail(self) -> None:
            if (key := self.key()) is None or api.keys.service(key) is None:
                return self.send(401, {}, b"{}")
            if api.limits is not None:
                ok, ms = api.limits.allow(key)
                if not ok:
                    return self.send(429, {"Retry-After": str(-(-ms // 1000))}, b"{}")
            got = dict(parse_qsl(urlsplit(self.path).query))
            name = f"{self.client_address}-{time.monotonic_ns()}"
            try:
                client = api.hub.subscribe(name, TailFilter.parse(*(got.get(k, "") for k in ("service", "host", "level", "q"))))
            except ValueError:
                return self.send(400, {}, b"{}")
            except TooManyClients:
                return self.send(503, {}, b"{}")
            try:
                self.send_response(200)
                self.send_header("Content-Type", "text/event-stream")
                self.end_headers()
                self.wfile.write(b": connected\n\n")
                quiet = 0
                while True:
                    events, dropped = client.take()
                    if events or dropped:
                        self.wfile.write(sse(events, dropped).encode())
                        quiet = 0
                    else:
                        time.sleep(0.05)
                        quiet += 1
                        if quiet % 300 == 0:
                            self.wfile.write(b": keepalive\n\n")
                    self.wfile.flush()
            except OSError:
                pass
            finally:
                api.hub.unsubscribe(name)

    return ThreadingHTTPServer((host, port), Handler)
