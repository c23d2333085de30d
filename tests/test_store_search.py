"""Served search of a store against its aggregation, and the index of its files."""

import datetime as dt
import glob
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from timberline.operators import search, store, storeindex
from timberline.operators.storesearch import StoreSearch, key_of
from timberline.plans.storing import writes
from timberline.service.api import LogApi
from timberline.service.keys import KeyMap
from timberline.sources.tables import LOG_SCHEMA, logs_from_events


def spread(spark, rows, path, batches):
    """A store of so many batches; writes of an id lie in different ones."""
    store.create(spark, path)
    n = F.pmod(F.xxhash64("id", "indexed_at"), F.lit(batches)).cast("string")
    rows.withColumn("batch", n).repartition(2).write.mode("append").partitionBy("event_date", "batch").parquet(path)
    storeindex.add(spark, path, "*")
    return path


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    """All logs, a third of them written again with another level, some of these on another day and without a time of their own."""
    moved = (F.col("level") == "fatal") & (F.col("offset") % 9 == 0)
    at = F.when(moved, F.col("timestamp") + F.expr("INTERVAL '1' DAY")).otherwise(F.col("timestamp"))
    days = F.to_date("timestamp").cast("string").isin([f"2024-01-{d:02d}" for d in (4, 5, 12, 15, 20, 28)])
    out = writes(spark, sf_dir).select(*LOG_SCHEMA.names).where(days).withColumn("timestamp", at)
    seen = F.when(F.col("offset") % 9 == 0, F.col("timestamp")).otherwise(F.col("observed_at"))
    return out.withColumn("observed_at", seen).withColumn("event_date", F.to_date("timestamp")).persist()


@pytest.fixture(scope="module", params=[1, 100])
def stored(spark, rows, request, tmp_path_factory):
    return spread(spark, rows if request.param > 1 else store.last_write(rows), f"file://{tmp_path_factory.mktemp('store')}/s", request.param)


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour, tzinfo=dt.timezone.utc)


QUERIES = [
    search.Query(limit=50), search.Query(level="info", limit=70), search.Query(level="fatal", service="svc-1", start=at(5), end=at(20, 12), limit=30),
    search.Query(text="signup 7", limit=100), search.Query(text="no such term", limit=5), search.Query(host="host-2", limit=1000), search.Query(text="...", limit=5),
    search.Query(level="fatal", limit=40, after=search.SortKey(1705276800000, "8")), search.Query(start=at(28), limit=20), search.Query(end=at(1), limit=20),
]


@pytest.mark.parametrize("query", QUERIES, ids=range(len(QUERIES)))
def test_page_equals_the_aggregated_store(spark, stored, query):
    want = search.page(store.current(spark, stored), query).select("id", "level", search.ms().alias("ms"), "message").collect()
    got = StoreSearch(spark, stored).rows(query)
    assert [(r.id, r.level, key_of(r).ms, r.message) for r in got] == [tuple(r) for r in want]


def test_walk_of_a_service_by_its_api(spark, stored):
    """Pages of a served walk are those of the aggregated store, each row once."""
    logs = store.current(spark, stored).where("service = 'svc-2' AND level = 'fatal'")
    want = [r.id for r in logs.orderBy(search.ms().desc(), F.desc("id")).collect()]
    api, got, cursor = LogApi(StoreSearch(spark, stored), KeyMap.parse("k:me")), [], ""
    while True:
        status, _, body = api.answer(f"/v1/logs?service=svc-2&level=fatal&limit=4{cursor}", "k")
        assert status == 200
        got += [r["id"] for r in body["logs"]]
        if "next_cursor" not in body:
            break
        cursor = f"&cursor={body['next_cursor']}"
    assert got == want and len(want) > 10


def test_plan_of_a_served_page(spark, stored):
    """Candidates come from the days' files, filtered in the scan, without a shuffle of the store."""
    query = search.Query(service="svc-1", level="fatal", start=at(5), end=at(20, 12), limit=50)
    at_work = StoreSearch(spark, stored)
    days = at_work.days(query)
    assert days[0] == "2024-01-20" and days[-1] == "2024-01-05"
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = at_work.candidates(days[:4], query)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "Exchange" not in plan and "Aggregate" not in plan and "TakeOrderedAndProject" in plan
    assert "EqualTo(service,svc-1)" in plan and "EqualTo(level,fatal)" in plan and "GreaterThanOrEqual(timestamp" in plan and "PartitionFilters: [isnotnull(event_date" in plan


def test_text_search_opens_files_that_may_match_only(spark, rows, tmp_path):
    """By the index a term that one batch holds opens that batch's files; absent terms open about one file of a hundred."""
    path = spread(spark, store.last_write(rows), f"file://{tmp_path}/s", 20)
    special = rows.where("level <> 'fatal'").orderBy("offset").limit(1).withColumn("message", F.lit("the Zebra-crossing at blk_4242"))
    store.append(spark, path, special, "special")
    for text, n in (("zebra", 1), ("crossing ZEBRA", 1), ("blk_4242 zebra", 1), ("blk_42", 0), ("zebra absent", 0)):
        own = StoreSearch(spark, path)
        found = own.rows(search.Query(text=text, limit=10))
        assert [r.message for r in found] == ["the Zebra-crossing at blk_4242"] * n
        assert own.opened <= 3 * n + own.listed // 20 < own.listed
    files = store.files_of(spark, path, store.day_folders(spark, path))
    wrong = sum(len(storeindex.narrowed(spark, path, files, "term", storeindex.term_hashes(f"absent{i}"), every=True)) for i in range(5))
    assert wrong / (5 * len(files)) < 0.03


def test_filters_know_all_values_and_few_others(spark):
    r = np.random.default_rng(1)
    values, others = (r.integers(-(2**63), 2**63 - 1, 60_000) for _ in range(2))
    for bits, most in ((10, 0.03), (20, 0.004)):
        width, blocks = storeindex.filter_blocks(values, bits)
        assert width * storeindex.BLOCK_BITS >= bits * len(values) and blocks.shape == (width, 4096)
        table = spark.createDataFrame([(i, bytearray(b.tobytes())) for i, b in enumerate(blocks)], "block int, bits binary")
        for asked, lo, hi in ((values, 1, 1), (others, 0, most)):
            h = spark.createDataFrame([(int(x),) for x in asked], "h long")
            block, places = storeindex._bits(F.col("h"), F.lit(width))
            hit = h.select("h", block.alias("block"), places.alias("places")).join(table, "block").where(F.forall("places", lambda p: storeindex._set(F.col("bits"), p)))
            assert lo <= hit.count() / len(asked) <= hi


def test_files_without_entries_are_read(spark, rows, tmp_path):
    path = f"file://{tmp_path}/s"
    store.create(spark, path)
    one = store.last_write(rows)
    for i in range(12):
        store.append(spark, path, one.where(F.col("offset") % 12 == i), i, indexed=i % 2 == 0)
    query = search.Query(text="purchase", limit=1000)
    assert [r.id for r in StoreSearch(spark, path).rows(query)] == [r.id for r in search.page(store.current(spark, path), query).collect()]


def test_redelivery_a_week_later_is_dropped(spark, sf_dir, tmp_path):
    """A batch of new records and of ones that the store has had for long: the new ones are left, and few files are opened."""
    path = f"file://{tmp_path}/s"
    logs = logs_from_events(spark, sf_dir).select(*LOG_SCHEMA.names, F.to_date("timestamp").alias("event_date"))
    spread(spark, logs.where("offset % 10 < 8"), path, 3)
    late = logs.where("offset % 10 = 9 AND event_date >= '2024-01-20'").unionByName(logs.where("event_date = '2024-01-13' AND offset % 10 < 8")).withColumn("indexed_at", F.current_timestamp())
    late.write.parquet(f"{path}-late")
    batch = spark.read.schema(late.schema).parquet(f"{path}-late")
    fresh, share = storeindex.unseen(spark, path, batch)
    assert sorted(r.id for r in fresh.collect()) == sorted(r.id for r in logs.where("offset % 10 = 9 AND event_date >= '2024-01-20'").collect())
    own = store.files_of(spark, path, ["2024-01-13"])
    assert len(own) <= share["opened"] <= len(own) + 0.05 * share["files"] < share["files"]
    # a record without a time of its own is found on another day
    again = logs.where("offset % 10 = 2").limit(20).withColumns({"timestamp": F.lit("2024-06-01 00:00:00").cast("timestamp"), "observed_at": F.lit("2024-06-01 00:00:00").cast("timestamp"), "event_date": F.lit("2024-06-01").cast("date")})
    assert storeindex.unseen(spark, path, again)[0].count() == 0
    assert storeindex.unseen(spark, path, logs.where("false"))[0].count() == 0
    store.create(spark, f"{path}-new")
    assert storeindex.unseen(spark, f"{path}-new", batch)[0].count() == batch.count()


def test_merged_days_are_indexed_and_old_entries_go(spark, rows, tmp_path):
    path = f"file://{tmp_path}/s"
    store.create(spark, path)
    for i in range(3):
        store.upsert(spark, path, rows.where(F.col("offset") % 3 == i), i)
    files = store.files_of(spark, path, store.day_folders(spark, path))
    known = {(str(r.event_date), r.batch, r.file) for r in storeindex.entries(spark, path).select("event_date", "batch", "file").distinct().collect()}
    assert {storeindex.file_key(x) for x in files} == known
    local = str(tmp_path) + "/s/_index"
    assert len(glob.glob(f"{local}/event_date=*/batch=*")) == len({x.rsplit("/", 1)[0] for x in files}) and os.path.isdir(local)
