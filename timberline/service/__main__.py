"""python -m timberline.service COMMAND: the agent, collector, indexer, queryapi, tail, alerter, loggen, querybench and zerolosscheck.

Settings come from the environment and are checked together; SIGTERM and SIGINT
end a service gracefully, with GRACE for the work in progress.
"""

from __future__ import annotations

import json
import signal
import sys
import threading
import time
import urllib.error
import urllib.request

from timberline.service.config import Settings

STOP = threading.Event()


def session(name: str):
    from pyspark.sql import SparkSession

    import timberline

    spark = SparkSession.builder.appName(f"timberline-{name}").config("spark.sql.session.timeZone", "UTC").config(
        "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ).getOrCreate()
    timberline.importable(spark)
    return spark


def stream(spark, settings: Settings, start: str):
    """The log's records as a stream: a topic where LOG names servers, else a folder."""
    from timberline.sources import filelog, kafka

    log = settings.text("LOG")
    settings.check()
    return filelog.records(spark, log, start=start) if "/" in log else kafka.records(spark, log, settings.text("TOPIC", "logs"), start)


def entries(raw):
    """Valid log entries of a stream of records, for readers that leave dead letters to the indexer."""
    from pyspark.sql import functions as F

    from timberline.operators import validate

    return validate.decode(raw, F.current_timestamp())[0]


def until_stopped(query, grace: float) -> int:
    from timberline.streaming.ingest import drain

    while query.isActive and not STOP.wait(0.5):
        pass
    failed = query.exception() if not query.isActive else None
    if query.isActive:
        drain(query, grace)
    return 1 if failed else 0


def agent(s: Settings) -> int:
    from timberline.service.agent import Agent, Batcher, http_session
    from timberline.service.spool import Spool

    pattern, url, key, folder = s.text("FILES"), s.text("COLLECTOR"), s.text("API_KEY"), s.text("SPOOL")
    batcher = Batcher(s.integer("BATCH_COUNT", 1000), s.integer("BATCH_BYTES", 1 << 20), s.seconds("LINGER", 0.2))
    name, host, most = s.text("AGENT_ID", "agent-1"), s.text("HOST", "") or None, s.integer("SPOOL_BYTES", 1 << 30)
    s.check()
    spool = Spool(folder, most_bytes=most)
    Agent(pattern, spool, f"{folder}/registry.json", name, host, batcher).run(http_session(url, key), STOP)
    spool.close()
    return 0


def collector(s: Settings) -> int:
    from timberline.service.api import LogApi, serve
    from timberline.service.collector import Collector
    from timberline.service.keys import KeyMap
    from timberline.service.limiter import Limiters
    from timberline.sources.filelog import Producer

    keys, log, port, rate, burst = s.text("API_KEYS"), s.text("LOG"), s.integer("PORT", 8081), s.number("RATE", 0.0), s.integer("BURST", 10_000)
    s.check()
    api = LogApi(None, KeyMap.parse(keys), collector=Collector(Producer(log).send, Limiters(rate, burst) if rate else None))
    return serving(serve(api, s.text("ADDRESS", "127.0.0.1"), port))


def serving(server) -> int:
    threading.Thread(target=server.serve_forever, daemon=True).start()
    print(f"listening on {server.server_address[0]}:{server.server_address[1]}", flush=True)
    STOP.wait()
    server.shutdown()
    return 0


def indexer(s: Settings) -> int:
    from timberline.streaming import ingest

    store, dead, checkpoint, grace = s.text("STORE"), s.text("DEAD_LETTERS"), s.text("CHECKPOINT"), s.seconds("GRACE", 30.0)
    spark = session("indexer")
    return until_stopped(ingest.index(spark, stream(spark, s, "earliest"), ingest.Config(store, dead, checkpoint, "")), grace)


def queryapi(s: Settings) -> int:
    from timberline.operators import store
    from timberline.operators.storesearch import StoreSearch
    from timberline.service.api import LogApi, serve
    from timberline.service.keys import KeyMap
    from timberline.service.limiter import Limiters

    path, keys, port, rate, burst, ttl = s.text("STORE"), s.text("API_KEYS"), s.integer("PORT", 8080), s.number("RATE", 50.0), s.integer("BURST", 100), s.seconds("CACHE_TTL", 5.0)
    s.check()
    spark = session("queryapi")
    store.create(spark, path)
    return serving(serve(LogApi(StoreSearch(spark, path), KeyMap.parse(keys), Limiters(rate, burst), ttl=ttl), s.text("ADDRESS", "127.0.0.1"), port))


def tail(s: Settings) -> int:
    from timberline.service.api import LogApi, serve
    from timberline.service.keys import KeyMap
    from timberline.streaming.hub import Hub

    keys, port, clients, buffer = s.text("API_KEYS"), s.integer("PORT", 8082), s.integer("CLIENTS", 100), s.integer("BUFFER", 1000)
    spark = session("tail")
    hub = Hub(clients, buffer)
    query = hub.sink(entries(stream(spark, s, "latest"))).trigger(processingTime="100 milliseconds").start()
    try:
        return serving(serve(LogApi(None, KeyMap.parse(keys), hub=hub), s.text("ADDRESS", "127.0.0.1"), port))
    finally:
        query.stop()


def alerter(s: Settings) -> int:
    from timberline.operators.alerts import Rule
    from timberline.service.notify import AlertQueue, Webhook
    from timberline.streaming import alerting

    bucket = s.seconds("BUCKET", 5.0)
    parts = lambda name, default: max(1, round(s.seconds(name, default) / bucket))
    rule = Rule(parts("WINDOW", 60.0), parts("BASELINE", 900.0), s.integer("MIN_ERRORS", 20), s.number("RATIO", 5.0), parts("COOLDOWN", 300.0), round(bucket * 1e6), s.integer("SAMPLES", 3))
    url, checkpoint, grace = s.text("WEBHOOK", ""), s.text("CHECKPOINT"), s.seconds("GRACE", 30.0)
    spark = session("alerter")
    alerts = AlertQueue(Webhook(url, window=rule.window * bucket).notify) if url else None

    def out(df, _: int) -> None:
        for row in df.collect():  # transitions are few
            alert = row.asDict()
            print(json.dumps(alert), flush=True)
            if alerts:
                alerts.put(alert)

    query = alerting.alerts(entries(stream(spark, s, "latest")), rule).writeStream.outputMode("update").foreachBatch(out)
    return until_stopped(query.option("checkpointLocation", checkpoint).trigger(processingTime="5 seconds").start(), grace)


def loggen(s: Settings) -> int:
    """Lines of a file, over and over without blank ones, at a rate against the start's time."""
    source, target, count, rate = s.text("INPUT"), s.text("OUTPUT"), s.integer("COUNT", 100_000), s.number("RATE", 0.0)
    s.check()
    with open(source, "rb") as f:
        lines = [x for x in (y.rstrip(b"\r") for y in f.read().split(b"\n")) if x]
    began, step = time.monotonic(), max(1, int(rate / 50)) if rate else 10_000
    with open(target, "ab", buffering=1 << 20) as out:
        for at in range(0, count if lines else 0, step):
            if STOP.is_set():
                break
            out.write(b"".join(lines[i % len(lines)] + b"\n" for i in range(at, min(at + step, count))))
            out.flush()
            if rate and (ahead := began + (at + step) / rate - time.monotonic()) > 0:
                STOP.wait(ahead)
    print(json.dumps({"lines": count if lines else 0, "seconds": round(time.monotonic() - began, 3)}))
    return 0


def querybench(s: Settings) -> int:
    from timberline.sources import workload

    url, key, words, ids = s.text("URL"), s.text("API_KEY"), s.items("WORDS", ["error"]), s.items("IDS", [])
    n, seed, start, end = s.integer("QUERIES", 300), s.integer("SEED", 1), s.integer("START", 0), s.integer("END", int(time.time()))
    workers, warmup, seconds = s.integer("WORKERS", 4), s.seconds("WARMUP", 2.0), s.seconds("DURATION", 10.0)
    s.check()

    def call(target: str) -> tuple[int, str, int]:
        request = urllib.request.Request(f"{url}/v1/logs?{target}", headers={"Authorization": f"Bearer {key}"})
        try:
            with urllib.request.urlopen(request, timeout=60) as r:
                return r.status, r.headers.get("X-Cache") or "", len(json.load(r)["logs"])
        except urllib.error.HTTPError as e:
            return e.code, "", 0

    print(json.dumps(workload.run(call, workload.targets(n, seed, start, end, words, ids), workers, warmup, seconds, seed), indent=2))
    return 0


def zerolosscheck(s: Settings) -> int:
    """Frame a source file anew, and look each line's id up in the store."""
    from pyspark.sql import functions as F

    from timberline.functions.framing import frame_files
    from timberline.functions.ids import log_id
    from timberline.operators import store
    from timberline.service import report

    path, source, name, at = s.text("STORE"), s.text("FILE"), s.text("AGENT_ID", "agent-1"), s.text("REPORT", "")
    s.check()
    spark = session("zerolosscheck")
    lines = frame_files(spark, source)
    ids = lines.select(log_id(F.lit(name), F.lit(source), F.lit(0), F.col("offset")).alias("id"))
    return report.write(report.zero_loss(ids, store.current(spark, path), source), at or None)


COMMANDS = {f.__name__: f for f in (agent, collector, indexer, queryapi, tail, alerter, loggen, querybench, zerolosscheck)}


def main(args: list[str], env: dict[str, str] | None = None) -> int:
    if len(args) != 1 or args[0] not in COMMANDS:
        print(f"{__doc__}\nCommands: {', '.join(COMMANDS)}", file=sys.stderr)
        return 2
    settings = Settings(env)
    if threading.current_thread() is threading.main_thread():
        for sig in (signal.SIGTERM, signal.SIGINT):
            signal.signal(sig, lambda *_: STOP.set())
    try:
        return COMMANDS[args[0]](settings)
    except ValueError as e:
        print(e, file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
