"""Streams replayed from files with increasing times, compared with the batch operators."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from stocktide.operators import validate as V
from stocktide.operators import windows as W
from stocktide.plans import catalog
from stocktide.plans import samples as S_
from stocktide.sources import readers as R
from stocktide.streaming import checked
from stocktide.streaming import ingest as I
from stocktide.streaming import state as S

T0 = dt.datetime(2026, 1, 1)


def publish(spark, folder, batches):
    """One file per batch of documents, in order of time."""
    os.makedirs(folder, exist_ok=True)
    have = len([f for f in os.listdir(folder) if f.endswith(".parquet")])
    for i, documents in enumerate(batches, start=have):
        rows = [(bytearray(json.dumps(d).encode() if not isinstance(d, str) else d.encode()), None, T0) for d in documents]
        part = f"{folder}-part{i}"
        spark.createDataFrame(rows, R.MESSAGE_SCHEMA).coalesce(1).write.parquet(part)
        source = next(f for f in os.listdir(part) if f.endswith(".parquet"))
        target = os.path.join(folder, f"m{i:03d}.parquet")
        os.link(os.path.join(part, source), target)
        os.utime(target, (1_700_000_000 + i * 60,) * 2)


def reading(device, second, temperature=20.0, **more):
    stamp = (T0 + dt.timedelta(seconds=second)).isoformat() + "Z"
    return {"device_id": device, "temperature": temperature, "humidity": 40, "status": "OK", "timestamp": stamp, **more}


def readings(spark, folder, step=1):
    return V.valid(V.tag_readings(R.read_messages(spark, str(folder), step)))


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_windows_close_with_the_watermark_and_wait_for_late_rows(spark, tmp_path):
    topic, out = tmp_path / "topic", f"{tmp_path}/out"
    publish(
        spark, topic,
        [
            [reading("a", 10), reading("a", 70)],
            [reading("a", 20, 30.0), reading("a", 170)],  # late by 50 s, inside the allowed 120 s
            [reading("a", 400)],
            [reading("a", 405)],  # lateness is judged by the watermark of the batch before
            [reading("a", 30, 99.0), reading("a", 700)],  # far too late
        ],
    )
    closed = S.closed_windows(readings(spark, topic))
    I.drained(I.append_stream(closed, out, f"{tmp_path}/cp", once=True))
    got = rows(spark.read.parquet(out), "window_start", "avg_temperature", "reading_count")
    start = lambda s: T0 + dt.timedelta(seconds=s)
    assert got == [(start(0), 25.0, 2), (start(60), 20.0, 1), (start(120), 20.0, 1), (start(360), 20.0, 2)]


def test_update_mode_accumulates(spark, tmp_path):
    topic, out = tmp_path / "topic", f"{tmp_path}/out"
    publish(spark, topic, [[reading("a", 10), reading("b", 15)], [reading("a", 20, 30.0)], [reading("a", 50, 40.0)]])
    I.drained(S.window_updates(readings(spark, topic), out, f"{tmp_path}/cp", once=True))
    columns = ["device_id", "window_start", "avg_temperature", "reading_count"]
    batch = V.valid(V.tag_readings(spark.read.parquet(str(topic))))
    assert rows(S.newest_updates(spark, out), *columns) == rows(W.device_windows(batch), *columns)
    assert spark.read.parquet(out).count() == 4  # a three times, b once


def test_repeats_are_dropped_within_the_horizon(spark, tmp_path):
    topic, out = tmp_path / "topic", f"{tmp_path}/out"
    publish(spark, topic, [[reading("a", 10), reading("a", 10)], [reading("a", 10), reading("b", 40)]])
    unique = S.without_repeats(readings(spark, topic), ["device_id"])
    I.drained(I.append_stream(unique, out, f"{tmp_path}/cp", once=True))
    assert rows(spark.read.parquet(out), "device_id") == [("a",), ("b",)]


def test_restart_continues_without_repeats(spark, tmp_path):
    topic, out = tmp_path / "topic", f"{tmp_path}/out"
    publish(spark, topic, [[reading("a", 1)], [reading("a", 2)]])

    def run():
        I.drained(I.append_stream(readings(spark, topic), out, f"{tmp_path}/cp", once=True))

    run()
    run()
    publish(spark, topic, [[reading("a", 3)]])
    run()
    assert len(rows(spark.read.parquet(out), "ts")) == 3


def test_redelivered_batch_replaces_itself(spark, tmp_path):
    """A handler that dies after writing is called again with the same batch."""
    topic, out = tmp_path / "topic", f"{tmp_path}/out"
    publish(spark, topic, [[reading("a", 1), reading("a", 2)]])
    calls = []

    def handle(batch, number):
        I.write_batch(batch, out, number)
        calls.append(number)
        if len(calls) == 1:
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        I.drained(I.consume(readings(spark, topic), handle, f"{tmp_path}/cp", once=True))
    I.drained(I.consume(readings(spark, topic), handle, f"{tmp_path}/cp", once=True))
    assert calls == [0, 0] and spark.read.parquet(out).count() == 2


def test_three_sources_with_dead_letters(spark, tmp_path):
    order = {"order_id": "o", "store_id": "s", "product_id": "p", "quantity": 1, "price": 2.5, "event_time": "2026-01-01T00:00:00Z"}
    stock = {"store_id": "s", "product_id": "p", "quantity_on_hand": 4, "event_time": "2026-01-01T00:00:00Z"}
    person = {"customer_id": "c", "email": "c@example.com", "event_time": "2026-01-01T00:00:00Z"}
    sources = {"orders": [order, "bad", {**order, "price": None}], "inventory": [stock, {}], "customers": [person]}
    for kind, documents in sources.items():
        publish(spark, tmp_path / kind, [documents])
    streams = {k: R.read_messages(spark, str(tmp_path / k)) for k in sources}
    I.drained(I.ingest_retail(spark, streams, f"{tmp_path}/lake", once=True))
    valid = {k: spark.read.parquet(f"{tmp_path}/lake/raw/{k}").count() for k in sources}
    dead = {k: spark.read.parquet(f"{tmp_path}/lake/rejected/{k}").count() for k in sources}
    assert valid == {"orders": 1, "inventory": 1, "customers": 1}
    assert dead == {"orders": 2, "inventory": 1, "customers": 0}


def test_checked_ingestion(spark, tmp_path):
    def order(number, minute, **other):
        return {"order_id": number, "store_id": "s", "product_id": "p", "quantity": 1, "price": 2.5, "customer_id": "c",
                "event_time": f"2026-01-01T00:{minute:02}:00Z", "status": "COMPLETED", **other}

    publish(spark, tmp_path / "orders", [
        [order("a", 10), order("b", 20), order("c", 0, quantity="2"), "bad"],
        [order("a", 10), order("d", 5), order("e", 19), order("f", 30, status="LOST", quantity=3.7)],
    ])
    stream = R.read_messages(spark, str(tmp_path / "orders"), files_per_batch=1)
    I.drained(checked.ingest_checked({"orders": stream}, f"{tmp_path}/lake", once=True))
    assert rows(spark.read.parquet(f"{tmp_path}/lake/raw/orders"), "order_id", "is_late") == [
        ("a", False), ("b", False), ("d", True), ("e", False),
    ]
    dead = spark.read.parquet(f"{tmp_path}/lake/rejected/orders").select("reason", F.array_join("violations", " ").alias("violations"))
    assert rows(dead, "reason", "violations") == [
        ("CONTRACT_BROKEN", "quantity:type"), ("CONTRACT_BROKEN", "quantity:type status:enum"), ("MALFORMED", "document:type"),
    ]


def test_current_rows_equal_the_batch_result(spark, tmp_path):
    topic, out = tmp_path / "topic", f"{tmp_path}/out"
    publish(spark, topic, [[reading("a", 5, 1.0), reading("b", 1, 1.0)], [reading("a", 3, 2.0)], [reading("b", 9, 3.0)]])
    order = [F.col("ts")]
    I.drained(S.keep_current(readings(spark, topic), ["device_id"], order, out, f"{tmp_path}/cp", once=True))
    got = rows(S.current_rows(spark, out, ["device_id"], order), "device_id", "temperature")
    assert got == [("a", 1.0), ("b", 3.0)]


TIMED = "device_id string, arrival int, ts timestamp, temperature double, humidity double, status string"


def _arrivals(spark, folder, batches):
    """A stream with one micro-batch for each list of (device, arrival, seconds)."""
    for batch in batches:
        made = [(d, n, T0 + dt.timedelta(seconds=s), 20.0 + n, 40.0, "OK") for d, n, s in batch]
        spark.createDataFrame(made, TIMED).coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(TIMED).option("maxFilesPerTrigger", 1).parquet(str(folder))


def test_late_rows_are_tagged_over_batches(spark, tmp_path):
    day = 86_400
    batches = [
        [("a", 1, 500), ("a", 2, 1), (None, 3, 9_000)], [("a", 4, 379), ("a", 5, 380), ("b", 6, 100), (None, 7, 1)],
        [("a", 8, 40 * day), ("a", 9, 30)], [("b", 10, -900), ("a", 11, 40 * day - 121), ("a", 12, 40 * day - 120)],
    ]
    out = f"{tmp_path}/out"
    I.drained(S.tag_late(_arrivals(spark, tmp_path / "in", batches), out, f"{tmp_path}/cp", "device_id", ["arrival"], once=True))
    got = spark.read.parquet(out).collect()
    # 10 is not: its device was forgotten after a month without readings
    assert sorted(r["arrival"] for r in got if r["is_late"]) == [2, 4, 9, 11] and len(got) == 12
    assert [r["device_id"] for r in spark.read.parquet(f"{out}-peaks/turn=1").collect()] == ["a"]
    assert sorted(p for p in os.listdir(f"{out}-peaks") if not p.startswith(".")) == ["turn=0", "turn=1"]


def test_windows_fire_again_for_late_rows(spark, tmp_path):
    batches = [
        [("a", 0, 10), ("b", 1, 20)],
        [("a", 2, 61)],  # both windows of the first minute fire
        [("a", 3, 30), ("b", 4, 400)],  # late within the allowance: fires again; the second minute fires
        [("a", 5, 40)],  # Spark drops by the mark of the batch before, so this still counts
        [("a", 6, 50), ("b", 7, 410)],  # gone
    ]
    out = f"{tmp_path}/out"
    I.drained(S.window_panes(_arrivals(spark, tmp_path / "in", batches), out, f"{tmp_path}/cp", once=True))
    panes = [
        (r["_batch"], r["device_id"], int((r["window_start"] - T0).total_seconds()), r["pane"], r["reading_count"])
        for r in spark.read.parquet(out).collect()
    ]
    assert sorted(panes) == [
        (1, "a", 0, "ON_TIME", 1), (1, "b", 0, "ON_TIME", 1), (2, "a", 0, "LATE", 2), (2, "a", 60, "ON_TIME", 1), (3, "a", 0, "LATE", 3),
    ]
    assert sorted(p for p in os.listdir(f"{out}-waiting") if not p.startswith(".")) == ["turn=0", "turn=1"]


def test_folded_log_needs_few_runs():
    runs = S.Runs("log", lambda rows: rows, width=8)
    for batches in (1, 7, 8, 9, 64, 200, 511, 512, 5000):
        folders = runs.newest(batches)
        covered = []
        for folder in folders:
            level, run = (int("".join(c for c in part if c.isdigit())) for part in folder.split("/")[1:])
            covered += range(run * 8**level, (run + 1) * 8**level)
        assert sorted(covered) == list(range(batches)) and len(folders) <= 7 * 5
    assert len(runs.newest(200)) == 4


def test_folded_log_keeps_the_newest_rows(spark, tmp_path):
    runs = S.current_runs(str(tmp_path), ["k"], [F.col("v")], width=3)
    newest = {}
    for number in range(20):
        rows = [(number * 7 % 5, number), (99, -number)]
        for _ in range(2 if number in (8, 9) else 1):  # delivered twice
            runs.append(spark.createDataFrame(rows, "k int, v int").coalesce(1), number)
        for k, v in rows:
            newest[k] = max(v, newest.get(k, v))
    found = runs.read(spark)
    assert {r["k"]: r["v"] for r in found.collect()} == newest
    assert len(runs.newest(20)) == 4 and len(os.listdir(tmp_path / "newest")) == 3


def test_a_batch_that_completes_levels_is_written_once(spark, tmp_path):
    runs = S.current_runs(str(tmp_path), ["k"], [F.col("v")], width=2)
    for number in range(8):
        runs.append(spark.createDataFrame([(number % 3, number)], "k int, v int").coalesce(1), number)
        assert sorted(map(tuple, runs.read(spark).collect())) == sorted((k, max(v for v in range(number + 1) if v % 3 == k)) for k in range(min(number + 1, 3)))
    written = sorted(f"{level.name}/{run.name}" for level in tmp_path.glob("level*") for run in level.iterdir())
    assert written == ["level0/run0", "level0/run2", "level0/run4", "level0/run6", "level1/run0", "level1/run2", "level2/run0", "level3/run0"]


def test_messages_of_few_files_are_dealt_to_all_cores(spark, tmp_path):
    publish(spark, tmp_path / "topic", [[reading("a", n, 1.0) for n in range(40)]])
    tasks = []
    stream = R.dealt(R.read_messages(spark, str(tmp_path / "topic"), files_per_batch=1))
    I.drained(I.consume(stream, lambda batch, number: tasks.append((batch.rdd.getNumPartitions(), batch.count())), f"{tmp_path}/cp", once=True))
    assert tasks[0] == (spark.sparkContext.defaultParallelism, 40)


@pytest.mark.parametrize("again", [False, True])
def test_checked_orders_arrive_in_batches_of_many_files(spark, sf_dir, monkeypatch, again):
    seen, real = [], R.read_messages

    def read(spark, topic, files_per_batch=None):
        files = spark.read.parquet(topic).select("_metadata.file_path").distinct().count()
        seen.append((files, files_per_batch))
        return real(spark, topic, files_per_batch)

    monkeypatch.setattr(catalog.R, "read_messages", read)
    catalog._checked(spark, sf_dir, again)
    files = [n for n, _ in seen]
    assert len(files) == 4 and all(b - a > 1 for a, b in zip([0, *files], files)) and all(most is None for _, most in seen)


@pytest.mark.parametrize("tag", [V.tag_orders, V.tag_inventory, V.tag_customers, V.tag_telemetry, V.tag_readings])
def test_reading_of_messages_is_small_enough_to_be_compiled(spark, tag):
    messages = spark.createDataFrame([], R.MESSAGE_SCHEMA)
    made = spark.createDataFrame([(bytearray(b"{}"), None, None)], R.MESSAGE_SCHEMA).unionByName(messages)
    for df in (tag(made), V.valid(tag(made)), V.rejected(tag(made))):
        found = df._jdf.queryExecution().debug().codegenToSeq()
        assert max(found.apply(i)._3().maxMethodCodeSize() for i in range(found.size())) < 8000


def test_a_split_batch_is_judged_once_and_not_held(spark, tmp_path, monkeypatch):
    topic, held, real = tmp_path / "topic", [], I.write_batch
    publish(spark, topic, [[reading("a", 0), "broken"], [reading("b", 1), {"device_id": "c"}, reading("d", 2)]])

    def write(df, path, number):
        held.append(spark.sparkContext._jsc.getPersistentRDDs().size())
        real(df, path, number)

    monkeypatch.setattr(I, "write_batch", write)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    stream = V.tag_telemetry(R.read_messages(spark, str(topic), files_per_batch=1))
    I.drained(I.split_stream(stream, f"{tmp_path}/ok", f"{tmp_path}/bad", f"{tmp_path}/cp", once=True))
    assert held == [before] * 4
    judged = spark.read.parquet(f"{tmp_path}/cp-judged")  # of the last batch only
    assert sorted((r["row"] is None, r["value"] is None) for r in judged.collect()) == [(False, True), (False, True), (True, False)]
    assert rows(spark.read.parquet(f"{tmp_path}/ok"), "device_id") == [("a",), ("b",), ("d",)]
    bad = sorted((r["_batch"], bytes(r["value"]), r["reason"]) for r in spark.read.parquet(f"{tmp_path}/bad").collect())
    assert bad == [(0, b"broken", V.MALFORMED), (1, b'{"device_id": "c"}', V.MISSING)]


def test_topics_and_split_tables_are_packed(spark, tmp_path):
    topic = catalog._topic(spark, spark.createDataFrame([(bytearray(json.dumps(reading("a", 1)).encode()),)], "value binary"), "topic")
    I.drained(I.split_stream(V.tag_telemetry(R.read_messages(spark, topic)), f"{tmp_path}/ok", f"{tmp_path}/bad", f"{tmp_path}/cp", once=True))
    for folder in (topic.removeprefix("file:").replace("//", "/"), f"{tmp_path}/ok/_batch=0", f"{tmp_path}/bad/_batch=0"):
        files = [f for f in os.listdir(folder) if f.endswith(".parquet")]
        assert files and all(".zstd." in f for f in files)


def test_order_fields_stand_beside_their_messages(spark, sf_dir):
    made = S_.order_messages(spark, sf_dir, ("order_id", "store_id", "event_time"))
    said = {n: F.get_json_object(F.col("value").cast("string"), f"$.{n}") for n in ("order_id", "store_id")}
    when = F.try_to_timestamp(F.get_json_object(F.col("value").cast("string"), "$.event_time"))
    apart = [~c.eqNullSafe(F.col(n)) for n, c in said.items()] + [~when.eqNullSafe(F.try_to_timestamp("event_time"))]
    assert made.where(apart[0] | apart[1] | apart[2]).isEmpty() and made.where("order_id IS NULL").count() > 0


def test_events_with_a_contract_are_judged_in_generated_code(spark, tmp_path):
    spark.createDataFrame([(bytearray(b"{}"), None, None)], R.MESSAGE_SCHEMA).write.parquet(str(tmp_path / "topic"))
    messages = spark.read.parquet(str(tmp_path / "topic"))
    for kind in checked.KINDS.values():
        tagged = kind.tag(messages, contract=kind.contract)
        for df in (V.valid(tagged), V.rejected(tagged)):
            found = df._jdf.queryExecution().debug().codegenToSeq()
            assert max(found.apply(i)._3().maxMethodCodeSize() for i in range(found.size())) < 8000
        plan = V.valid(tagged)._jdf.queryExecution().executedPlan().toString()
        assert "filter(array(" not in plan and "violations" not in plan


def test_late_rows_land_on_their_own_day(spark, tmp_path):
    topic, out = tmp_path / "topic", f"{tmp_path}/out"
    day = 86_400
    publish(spark, topic, [[reading("a", day + 5)], [reading("a", 7)]])
    I.drained(I.land_by_day(readings(spark, topic), out, f"{tmp_path}/cp", once=True))
    assert sorted(os.path.basename(p) for p in os.listdir(out) if p.startswith("date=")) == [
        "date=2026-01-01", "date=2026-01-02",
    ]


def test_windows_go_out_as_messages(spark, tmp_path):
    topic, out = tmp_path / "topic", f"{tmp_path}/out"
    publish(spark, topic, [[reading("a", 10), reading("a", 20, 21.0)], [reading("a", 1000)]])
    messages = W.window_messages(S.closed_windows(readings(spark, topic)), "Z")
    I.drained(I.append_stream(messages, out, f"{tmp_path}/cp", once=True))
    (row,) = spark.read.parquet(out).collect()
    assert json.loads(bytes(row["value"])) == {
        "device_id": "a", "window_start": "2026-01-01T00:00:00Z", "window_end": "2026-01-01T00:01:00Z",
        "avg_temperature": 20.5, "avg_humidity": 40.0, "reading_count": 2, "error_count": 0,
    }


def test_encoded_rows_come_back(spark, tmp_path):
    from stocktide.sources.messages import encode_events

    rows_in = spark.createDataFrame([("7", "20.5", 40, "OK"), ("8", "warm", 40, "OK")], "device_id string, temperature string, humidity int, status string")
    encode_events(rows_in, F.lit("2026-01-01T00:00:00+00:00")).write.parquet(str(tmp_path / "topic"))
    kept = V.valid(V.tag_telemetry(R.read_messages(spark, str(tmp_path / "topic"))))
    I.drained(I.append_stream(kept, f"{tmp_path}/out", f"{tmp_path}/cp", once=True))
    got = [tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect()]
    assert got == [("7", 20.5, 40.0, "OK", "2026-01-01T00:00:00+00:00")]


def test_text_messages(spark, tmp_path):
    os.makedirs(tmp_path / "lines")
    (tmp_path / "lines" / "one.json").write_text(json.dumps(reading("a", 1)) + "\n" + "broken\n")
    stream = V.valid(V.tag_telemetry(R.read_text_messages(spark, str(tmp_path / "lines"))))
    I.drained(I.append_stream(stream, f"{tmp_path}/out", f"{tmp_path}/cp", once=True))
    assert rows(spark.read.parquet(f"{tmp_path}/out"), "device_id") == [("a",)]


def test_sessions_close(spark, tmp_path):
    topic, out = tmp_path / "topic", f"{tmp_path}/out"
    publish(spark, topic, [[reading("a", 0), reading("a", 30)], [reading("a", 300)], [reading("a", 1000)]])
    timed = W.with_event_time(readings(spark, topic))
    I.drained(I.append_stream(W.sessions_streaming(timed, "60 seconds"), out, f"{tmp_path}/cp", once=True))
    assert rows(spark.read.parquet(out), "reading_count") == [(1,), (2,)]


def test_cadence(spark, tmp_path):
    publish(spark, tmp_path / "topic", [[reading("a", 1)]])
    query = I.append_stream(readings(spark, tmp_path / "topic"), f"{tmp_path}/out", f"{tmp_path}/cp", every="1 second")
    try:
        query.processAllAvailable()
        assert spark.read.parquet(f"{tmp_path}/out").count() == 1
    finally:
        query.stop()
