import json
import threading
import urllib.error
import urllib.request

import pytest

from timberline.operators.search import InvalidArgument, Query, SortKey, parse_query
from timberline.service import api as api_module
from timberline.service.cache import CachedSearch
from timberline.service.cursor import cache_key, decode_cursor, encode_cursor, fingerprint
from timberline.service.keys import KeyMap
from timberline.service.limiter import Limiters, TokenBucket
from timberline.service.notify import AlertQueue, Webhook, backoff, duration, render, rendered
from timberline.sources.tables import logs_from_events
from timberline.streaming.hub import Hub


def test_cursor_is_bound_to_filters():
    q = Query(service="hdfs", level="info")
    text = encode_cursor(SortKey(5, "ab"), q)
    assert decode_cursor(text, q) == SortKey(5, "ab")
    with pytest.raises(InvalidArgument, match="different filters"):
        decode_cursor(text, Query(service="apache", level="info"))
    for bad in ("!!!", "e30", encode_cursor(SortKey(5, ""), q)):
        with pytest.raises(InvalidArgument, match="malformed"):
            decode_cursor(bad, q)
    assert parse_query({"service": "hdfs", "level": "INFO", "cursor": text}).after == SortKey(5, "ab")


def test_cache_keys_differ():
    variants = [{}, {"service": "a"}, {"host": "a"}, {"level": "info"}, {"q": "a"}, {"limit": "5"}, {"from": "2026-01-01T00:00:00Z"}, {"to": "2026-01-01T00:00:00Z"}]
    assert len({cache_key(parse_query(v)) for v in variants}) == len(variants)
    assert fingerprint(parse_query({"limit": "5"})) == fingerprint(Query())


def test_one_search_for_callers_at_once():
    calls, go = [], threading.Event()

    def search(q):
        calls.append(q)
        go.wait(5)
        return "page"

    cached, out = CachedSearch(search), []
    threads = [threading.Thread(target=lambda: out.append(cached.get(Query()))) for _ in range(20)]
    for t in threads:
        t.start()
    while not calls:
        pass
    go.set()
    for t in threads:
        t.join()
    assert len(calls) == 1 and len(out) == 20 and cached.get(Query()) == ("page", True)


def test_failures_are_not_cached():
    answers = [ValueError("x"), "ok"]

    def search(_):
        a = answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return a

    cached = CachedSearch(search)
    with pytest.raises(ValueError):
        cached.get(Query())
    assert cached.get(Query()) == ("ok", False)


def test_token_bucket():
    now = [0]
    b = TokenBucket(10, 5, lambda: now[0])
    assert [b.allow()[0] for _ in range(6)] == [True] * 5 + [False] and b.allow()[1] == 100
    now[0] = 100
    assert b.allow()[0]
    big = TokenBucket(10, 10, lambda: 0)
    assert big.allow(1000)[0] and not big.allow()[0]

    def broken():
        raise OSError

    assert Limiters(1, 1, broken).allow("k") == (True, 0)


def test_exactly_the_burst_passes_under_contention():
    limits, passed, lock = Limiters(0.001, 50), [], threading.Lock()

    def call():
        ok, _ = limits.allow("k")
        with lock:
            passed.append(ok)

    threads = [threading.Thread(target=call) for _ in range(400)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sum(passed) == 50


def test_keys():
    keys = KeyMap.parse(" k1:a, k2:b ,")
    assert keys.service("k1") == "a" and keys.service("x") is None
    for bad in ("k1", "k1:", ":a", "k1:a,k1:b"):
        with pytest.raises(ValueError) as e:
            KeyMap.parse(bad)
        assert "k1" not in str(e.value)


def test_notifications():
    alert = {"service": "a<b", "kind": "firing", "errors": 21, "usual": 0.0, "samples": ["x `y`"]}
    assert "a&lt;b" in render(alert) and "'y'" in render(alert) and "21" in render(alert)
    assert [duration(x) for x in (0, 20, 60, 90.4, 3600, 7265)] == ["0s", "20s", "1m0s", "1m30s", "1h0m0s", "2h1m5s"]
    answers, waits = [(429, "99"), (0, ""), (503, ""), (200, "")], []

    def send(_):
        status, after = answers.pop(0)
        if not status:
            raise OSError
        return status, after

    Webhook("http://secret", send=send, sleep=waits.append).notify(alert)
    assert waits[0] == 30.0 and len(waits) == 3
    with pytest.raises(RuntimeError) as e:
        Webhook("http://secret", send=lambda _: (404, "")).notify(alert)
    assert "secret" not in str(e.value)
    assert 0 <= backoff(10) <= 30
    got, gate = [], threading.Event()
    q = AlertQueue(lambda a: (gate.wait(5), got.append(a)), size=2)
    for i in range(10):
        q.put({"i": i})
    gate.set()
    q.close()
    assert len(got) + q.dropped == 10 and q.dropped >= 7


def test_http(spark, sf_dir):
    api = api_module.LogApi(logs_from_events(spark, sf_dir).cache(), KeyMap.parse("k:svc"), Limiters(0.001, 6), Hub())
    server = api_module.serve(api)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"

    def get(path, key="k"):
        try:
            with urllib.request.urlopen(urllib.request.Request(base + path, headers={"Authorization": f"Bearer {key}"} if key else {})) as r:
                return r.status, dict(r.headers), r.read()
        except urllib.error.HTTPError as e:
            return e.code, dict(e.headers), e.read()

    try:
        assert get("/healthz", None)[0] == 200 and get("/v1/logs", None)[0] == 401 and get("/v1/logs", "no")[0] == 401
        status, headers, body = get("/v1/logs?limit=7&level=error")
        page = json.loads(body)
        assert status == 200 and headers["X-Cache"] == "MISS" and len(page["logs"]) == 7
        assert get("/v1/logs?limit=7&level=error")[1]["X-Cache"] == "HIT"
        nxt = json.loads(get(f"/v1/logs?limit=7&level=error&cursor={page['next_cursor']}")[2])
        assert not {x["id"] for x in nxt["logs"]} & {x["id"] for x in page["logs"]}
        status, _, body = get("/v1/logs?level=loud")
        assert status == 400 and json.loads(body)["error"]["field"] == "level"
        assert [get("/v1/logs?limit=1")[0] for _ in range(3)] == [200, 200, 429]
        assert b"http_requests_total" in get("/metrics")[2]
    finally:
        server.shutdown()


def test_texts_of_alerts_as_columns_and_one_by_one(spark):
    rows = [("a<b", "firing", 21, 2.5, ["x & `y`", "z"]), ("b", "firing", 7, 3.5, []), ("c", "firing", 5, 0.2, None), ("d&", "resolved", 1, 4.0, ["gone"])]
    df = spark.createDataFrame(rows, "service string, kind string, errors long, usual double, samples array<string>")
    got = [r.text for r in rendered(df, 90).collect()]
    assert got == [render(r.asDict(), 90) for r in df.collect()]
    assert got[0] == ":rotating_light: *Error spike in `a&lt;b`*\n21 errors in the last 1m30s (usually about 2).\nMost recent:\n• `x &amp; 'y'`\n• `z`"
    assert got[1].endswith("(usually about 4).") and got[3] == ":white_check_mark: *Errors back to normal in `d&amp;`* (1 in the last 1m30s)"
