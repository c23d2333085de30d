import datetime as dt

import pytest
from pyspark.sql import functions as F

from timberline.functions import framing, ids, levels, text, timestamps

NOW = "2026-03-01 00:00:00"


def one(spark, column, **values):
    row = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], row).select(column).first()[0]


def test_log_id_known_value_and_sensitivity(spark):
    rows = [("agent-1", "/var/log/app.log", 0, 42), ("as", "", 0, 0), ("a", "s", 0, 0), ("ä", "ö", 1, 2**40)]
    df = spark.createDataFrame(rows, "a string, s string, e long, o long")
    got = [r[0] for r in df.select(ids.log_id(F.col("a"), F.col("s"), F.col("e"), F.col("o"))).collect()]
    assert got[0] == "be023a440457acb295d883c43f65b98f"
    assert got == [ids.log_id_value(*r) for r in rows] and len(set(got)) == 4


@pytest.mark.parametrize("value,ok", [("a" * 32, True), ("A" * 32, False), ("a" * 31, False), ("a" * 33, False), ("", False), ("a" * 31 + "\n", False)])
def test_valid_log_id(spark, value, ok):
    assert one(spark, ids.valid_log_id(F.col("x")), x=value) is ok


LINES = [
    # a compact date and time, times in brackets, with a comma, with slashes, with an offset, without a year
    ("240229 000001 7 WARN store: slow write", "2024-02-29 00:00:01", "warn"),
    ("991231 235959 t-9 [FATAL] store: gone", "1999-12-31 23:59:59", "fatal"),
    ("[Thu Feb 29 23:59:59 2024] [notice] proxy: reload", "2024-02-29 23:59:59", "info"),
    ("2031-07-04 00:00:00,001 DEBUG <pool-3> tick", "2031-07-04 00:00:00.001", "debug"),
    ("21/12/31 09:08:07 TRACE task.Runner: stage", "2021-12-31 09:08:07", "trace"),
    ("2025-01-01T00:30:00+02:00 severity high", "2024-12-31 22:30:00", "unknown"),
    ("2025-06-30T11:22:33.123456Z alert: disk", "2025-06-30 11:22:33.123", "fatal"),
    ("Feb  3 04:05:06 edge cron[7]: emerg", "2026-02-03 04:05:06", "fatal"),
    ("Nov 30 23:00:00 edge cron[7]: ok", "2025-11-30 23:00:00", "unknown"),
    # no time: other words, days and months that don't exist
    ("queue drained", None, "unknown"),
    ("2025-13-01 00:00:00,000 critical", None, "fatal"),
    ("", None, "unknown"),
    # a level among the first eight words, and one behind them
    ("one two three four five six seven SEVERE", None, "error"),
    ("one two three four five six seven eight SEVERE", None, "unknown"),
    # levels of structured lines: three keys, the first that is one counts; what is no object is read as words
    ('{"n":3,"level":"Err"}', None, "error"),
    ('{"severity":"dbug","text":"ERROR"}', None, "debug"),
    ('{"severity_text":"EMERG"}', None, "fatal"),
    ('{"text":"nothing"}', None, "unknown"),
    ('{"level":"high","log.level":"Warn"}', None, "warn"),
    ("{broken WARN", None, "warn"),
]


def test_timestamps_and_levels(spark):
    df = spark.createDataFrame([(x,) for x, _, _ in LINES], "line string")
    at = timestamps.parse_timestamp(F.col("line"), F.lit(NOW).cast("timestamp"))
    got = df.select(F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSS"), levels.parse_level(F.col("line"))).collect()
    for (line, when, level), row in zip(LINES, got):
        want = None if when is None else f"{dt.datetime.fromisoformat(when):%Y-%m-%d %H:%M:%S.%f}"[:-3]
        assert (row[0], row[1]) == (want, level), line


def test_level_names(spark):
    df = spark.range(-1, 8)
    assert [r[0] for r in df.select(levels.level_name(F.col("id"))).collect()] == ["unknown", *levels.LEVELS, "unknown"]


def test_framing_chunks_and_resume():
    got, rest, at = [], b"", 100
    for chunk in (b"ab", b"c\nde", b"f\r\n\n", b"gh"):
        found, used = framing.lines_of(rest + chunk, at)
        rest, at = (rest + chunk)[used:], at + used
        got += found
    assert got == [(100, b"abc"), (104, b"def")] and at == 110 and rest == b"gh"
    data = b"one\ntwo\nthree\nfour\n"
    expected, _ = framing.lines_of(data)
    part, used = framing.lines_of(data[:10])
    assert part + framing.lines_of(data[used:], used)[0] == expected


def test_framing_long_lines_flush_and_utf8():
    got, used = framing.lines_of(b"x" * 10 + b"\n", 0, 4)
    assert [o for o, _ in got] == [0, 4, 8] and got[-1][1] == b"xx" and used == 11
    assert framing.lines_of(b"x" * 10, 0, 4) == ([(0, b"xxxx"), (4, b"xxxx")], 8)
    assert framing.lines_of(b"done\npart") == ([(0, b"done")], 5)
    assert framing.lines_of(b"part", 5, final=True) == ([(5, b"part")], 4)
    assert framing.lines_of(b"") == ([], 0)
    assert framing.to_valid_utf8(b"a\xff\xfeb\xffc") == "a�b�c"


def test_framing_of_files_in_blocks(spark, tmp_path):
    data = b"".join(b"line %d %s\r\n" % (i, b"y" * (i % 50)) for i in range(3000)) + b"\n\n" + b"z" * 70_000 + b"\na\xff\xfeb\nlast"
    (tmp_path / "x.log").write_bytes(data)
    (tmp_path / "y.log").write_bytes(b"one\ntwo\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = framing.frame_files(spark, f"file://{tmp_path}").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = [(o, framing.to_valid_utf8(x)) for o, x in framing.lines_of(data, 0, framing.MAX_LINE, True)[0]]
    assert sorted((r.offset, r.line) for r in got if r.source.endswith("x.log")) == want
    assert sorted((r.offset, r.line) for r in got if r.source.endswith("y.log")) == [(0, "one"), (4, "two")]


def test_container_lines(spark):
    lines = ['{"log":"hi\\r\\n","stream":"stdout","time":"2026-01-01T00:00:00.5Z"}', "plain text", '{"unrelated":1}', '{"log":', '{"log":"\\n","time":"2026-01-01T00:00:00Z"}', ""]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = [r[0] for r in df.select(text.unwrap_container_line(F.col("line"))).collect()]
    assert [(g.ok, g.message, g.drop) for g in got] == [(True, "hi", False), (False, lines[1], False), (False, lines[2], False), (False, lines[3], False), (True, "", True), (False, "", False)]


def test_terms_and_match(spark):
    line = "dfs.DataNode$PacketResponder: block blk_4242 from 10.250.19.102:54106"
    assert one(spark, text.terms(F.col("x")), x=line) == ["dfs.datanode", "packetresponder", "block", "blk_4242", "from", "10.250.19.102", "54106"]
    for q, want in (("BLK_4242 block", True), ("blk_42", False), ("$", False), ("", False)):
        assert one(spark, text.matches(F.col("x"), q), x=line) is want


def test_samples_status_and_backoff(spark):
    assert bytes(one(spark, text.truncated(F.col("x")), x="é" * 150)) == ("é" * 100).encode() + b"..."
    df = spark.createDataFrame([(x,) for x in (201, 400, 429, 503)], "s int")
    assert [r[0] for r in df.select(text.status_class(F.col("s"))).collect()] == ["ok", "dead", "retry", "retry"]
    assert [r[0] for r in spark.range(3).select(text.backoff_ceiling(F.col("id") * 5)).collect()] == [100, 3200, 30000]
    assert one(spark, text.escape_chat(F.col("x")), x="a<b>&c") == "a&lt;b&gt;&amp;c"
