"""Streams over several files: state, lateness and merges across micro-batches."""

import os
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from offerwell.operators.negotiation import first_bids, replay
from offerwell.plans import streams
from offerwell.plans.registry import QUERIES
from offerwell.sources.views import Tables
from offerwell.streaming import jobs as S

SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double"


def files(spark, folder, parts):
    """One parquet file per part, with growing modification times."""
    for i, rows in enumerate(parts):
        df = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double")
        df = df.withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1)
        df.toPandas().assign(ts=lambda p: p.ts.astype("datetime64[us]")).to_parquet(f"{folder}/part-{i}.parquet", index=False)
        now = time.time() - 100 + i
        os.utime(f"{folder}/part-{i}.parquet", (now, now))


def stream(spark, folder):
    schema = SCHEMA.replace("timestamp", "timestamp_ntz")
    rows = S.read_files(spark, str(folder), schema, "part-*.parquet", files_per_batch=1)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


PARTS = [
    [(1, "2024-01-01 10:00:00", 1, "a", 90.0), (2, "2024-01-01 11:00:00", 2, "a", 70.0)],
    [(3, "2024-01-03 10:00:00", 1, "b", 95.0), (4, "2024-01-03 11:00:00", 3, "a", 20.0)],
    [(5, "2024-01-01 10:30:00", 2, "b", 75.0), (6, "2024-01-03 12:00:00", 1, "a", 99.0)],
]


def test_upsert_keeps_the_first_sighting(spark, tmp_path):
    files(spark, tmp_path, PARTS)
    got = S.upsert_sink(stream(spark, tmp_path), "user_id", ["ts", "event_id"], "t-upsert").collect()
    assert sorted((r["user_id"], r["event_id"]) for r in got) == [(1, 1), (2, 2), (3, 4)]


def test_merge_new_drops_repeats_across_batches(spark, tmp_path):
    files(spark, tmp_path, PARTS)
    got = S.append_to_files(S.merge_new(stream(spark, tmp_path), "user_id").select("user_id"), "t-merge")
    assert sorted(r["user_id"] for r in got.collect()) == [1, 2, 3]


def test_late_rows_are_flagged_by_earlier_batches(spark, tmp_path):
    files(spark, tmp_path, PARTS)
    got = S.late_split(stream(spark, tmp_path), "1 DAY", "t-late").collect()
    assert sorted(r["event_id"] for r in got if r["is_late"]) == [5] and len(got) == 6


def test_windows_drop_rows_behind_the_watermark(spark, tmp_path):
    # A row is late once the watermark of the batch before the last one has passed it: event 5 still counts, 7 does not.
    files(spark, tmp_path, [*PARTS, [(7, "2024-01-01 10:40:00", 1, "a", 1.0)]])
    rows = S.window_kpis(stream(spark, tmp_path), [], "value", "1 day", delay="1 hour")
    got = S.latest_results(rows, "t-window", ["window_start"]).orderBy("window_start").collect()
    assert [(str(r["window_start"])[:10], r["n"]) for r in got] == [("2024-01-01", 3), ("2024-01-03", 3)]


def test_negotiation_state_survives_batches_and_is_removed(spark, tmp_path):
    # Negotiation 1 goes on after its last round, in the same and in a later batch.
    more = [(10 + i, f"2024-01-04 {10 + i}:00:00", 1, "a", 96.0 + i) for i in range(8)]
    parts = [*PARTS, more, [(30, "2024-01-05 10:00:00", 1, "a", 150.0), (31, "2024-01-05 10:00:00", 3, "a", 25.0)]]
    files(spark, tmp_path, parts)
    bids = spark.createDataFrame([r for p in parts for r in p], "event_id long, ts string, negotiation long, k string, bid double")
    wide = first_bids(bids.withColumn("ts", F.col("event_id")))  # arrival order
    opening = wide.select("negotiation", "current", "floor_price")
    before = spark.conf.get(S.STATE_PROVIDER)
    spark.conf.set(S.STATE_PROVIDER, S.ROCKSDB)
    try:
        end = S.Closing(spark, "t-negotiate")
        source = stream(spark, tmp_path).selectExpr("user_id AS negotiation", "event_id AS seq", "ts", "value AS bid")
        open_, done = [], []
        S.append_to_files(S.negotiate(source, opening), "t-open", progress=open_)
        states = S.append_to_files(S.negotiate(end.attach(source), opening), "t-negotiate", [None, end.close], done)
    finally:
        spark.conf.set(S.STATE_PROVIDER, before)
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(S.negotiated_prices(states)) == key(replay(wide))
    assert len({r["upto"] for r in states.where("negotiation = 1").collect()}) == states.where("negotiation = 1").count()
    rows = lambda reports: reports[-1].stateOperators[0].numRowsTotal
    assert rows(open_) > 0 and rows(done) == 0


class Held:
    """A state variable that counts what is asked of it."""

    def __init__(self, asked):
        self.asked, self.value = asked, None

    def get(self):
        self.asked.append("get")
        return self.value

    def update(self, value):
        self.asked.append("update")
        self.value = value

    def clear(self):
        self.asked.append("clear")
        self.value = None


class Handle:
    def __init__(self):
        self.asked, self.timers = [], []

    def getValueState(self, name, schema):
        return Held(self.asked)

    def registerTimer(self, at):
        self.timers.append(at)


def test_a_key_of_a_batch_is_one_read_and_one_write_of_its_state():
    def batch(*rows):
        seq, bid = zip(*rows)
        return pd.DataFrame({"seq": seq, "bid": bid, "ts": pd.to_datetime(["2024-01-01"] * len(rows))})

    handle = Handle()
    bids = S.FirstBids(1000)
    bids.init(handle)
    got = []
    for pdfs in ([batch((5, 50.0), (2, 20.0)), batch((3, None))], [batch((9, 90.0), (7, 70.0), (8, 80.0), (7, 71.0))], [batch((10, 1.0))]):
        handle.asked.clear()
        got += [r for out in bids.handleInputRows((4,), iter(pdfs), None) for r in out.astype(object).where(out.notna(), None).values.tolist()]
        assert sorted(handle.asked) == ["get", "update"]
    assert [r[:2] for r in got] == [[4, i] for i in range(1, 6)] and len(handle.timers) == 1
    assert got[0][2:] == [20.0, None, None, None, None] and got[4][2:] == [20.0, None, 50.0, 70.0, 71.0]
    handle.asked.clear()
    clock = type("Clock", (), {"getCurrentWatermarkInMs": lambda self: handle.timers[0]})()
    assert list(bids.handleExpiredTimer((4,), clock, None)) == [] and handle.asked == ["get", "clear"]


def test_opening_prices_are_not_worked_out_by_every_batch(spark, monkeypatch):
    class Stop(Exception):
        pass

    def negotiate(bids, opening):
        plan = opening._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate" not in plan and "Join" not in plan
        raise Stop

    monkeypatch.setattr(streams.S, "negotiate", negotiate)
    with pytest.raises(Stop):
        QUERIES["stream_negotiate"](Tables(spark, "/root/testdata/sf0.001"))


def test_an_idle_negotiation_is_forgotten(spark, tmp_path):
    parts = [[(1, "2024-01-01 10:00:00", 1, "a", 90.0)], [(2, "2024-01-09 10:00:00", 2, "a", 80.0)], [(3, "2024-01-09 11:00:00", 2, "a", 85.0)],
             [(4, "2024-01-10 10:00:00", 1, "a", 91.0)]]
    files(spark, tmp_path, parts)
    opening = spark.createDataFrame([(1, 100.0, 60.0), (2, 100.0, 60.0)], "negotiation long, current double, floor_price double")
    before = spark.conf.get(S.STATE_PROVIDER)
    spark.conf.set(S.STATE_PROVIDER, S.ROCKSDB)
    try:
        source = stream(spark, tmp_path).selectExpr("user_id AS negotiation", "event_id AS seq", "ts", "value AS bid")
        states = S.append_to_files(S.negotiate(source, opening, idle="3 days"), "t-idle")
    finally:
        spark.conf.set(S.STATE_PROVIDER, before)
    assert sorted((r["negotiation"], r["upto"], r["h1"]) for r in states.collect()) == [(1, 1, 90.0), (1, 1, 91.0), (2, 1, 80.0), (2, 2, 80.0)]


def test_closing_emits_what_is_open(spark, tmp_path):
    files(spark, tmp_path, PARTS)
    one = S.append_to_files(S.sessions(stream(spark, tmp_path), "user_id"), "t-open").count()
    end = S.Closing(spark, "t-sessions")
    rows = S.append_to_files(S.sessions(end.attach(stream(spark, tmp_path)), "user_id"), "t-closed", [None, end.close])
    got = sorted((r["user_id"], str(r["session_start"]), r["n"]) for r in rows.collect())
    # Event 5 came behind the watermark of its batch.
    assert one < len(got) and [g for g in got if g[0] != 2] == [(1, "2024-01-01 10:00:00", 1), (1, "2024-01-03 10:00:00", 2), (3, "2024-01-03 11:00:00", 1)]
    end = S.Closing(spark, "t-expiry")
    offers = stream(spark, tmp_path).selectExpr("user_id AS buyer_id", "event_id AS offer_id", "ts").where("offer_id IN (1, 4)")
    paid = stream(spark, tmp_path).selectExpr("user_id AS buyer_id", "event_id AS payment_id", "ts").where("payment_id IN (3, 6)")
    rows = S.expiry(end.attach(offers, buyer_id=-1), end.attach(paid, buyer_id=-2))
    got = S.append_to_files(rows, "t-expiry", [None, end.close]).collect()
    assert sorted((r["offer_id"], r["status"]) for r in got) == [(1, "EXPIREE"), (4, "EXPIREE")]


def test_upsert_reads_only_the_buckets_it_touches(spark, monkeypatch):
    read = []
    real = S._stored

    def counted(spark, path, schema, buckets, before):
        rows = real(spark, path, schema, buckets, before)
        assert not buckets or "bucket" in rows._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]
        files_read = rows.select(F.input_file_name()).distinct().count()
        read.append((len(buckets), files_read, len(spark.read.parquet(f"{path}/rows").inputFiles())))
        return rows

    monkeypatch.setattr(S, "_stored", counted)
    source = S.Arrivals(spark, "t-upsert")
    make = lambda ids: spark.createDataFrame([(i, j) for j, i in enumerate(ids)], "k long, at long").coalesce(1)
    parts = [make(range(500)), make([3, 3, 7, 1_000, None]), make([3, 1_000, None, 2_000]), make([9_000])]
    rows = S.upsert_sink(source.stream(parts[0].schema), "k", ["at"], "t-upsert", [source.part(p) for p in parts])
    got = rows.collect()
    assert sorted((r["k"] is None, r["k"] or 0) for r in got) == sorted([(False, i) for i in [*range(500), 1_000, 2_000, 9_000]] + [(True, 0)])
    assert {r["k"]: r["at"] for r in got if r["k"] in (3, 1_000, 2_000)} == {3: 3, 1_000: 3, 2_000: 3}
    for buckets, files_read, stored in read:
        assert buckets <= 4 and files_read <= 3 * buckets < stored


def test_a_repeated_batch_gives_the_same_table(spark, monkeypatch):
    """The handler runs twice for every batch, as after a lost driver."""
    real = S.run_batches

    def twice(stream, name, mode, handle, arrivals=(None,)):
        return real(stream, name, mode, lambda b, i, path: [handle(b, i, path), handle(b, i, path)], arrivals)

    monkeypatch.setattr(S, "run_batches", twice)
    source = S.Arrivals(spark, "t-twice")
    parts = [spark.range(a, b).selectExpr("id AS k", f"{a} AS at") for a, b in ((0, 50), (30, 80), (10, 90))]
    rows = S.upsert_sink(source.stream(parts[0].schema), "k", ["at"], "t-twice", [source.part(p) for p in parts])
    assert sorted((r["k"], r["at"]) for r in rows.collect()) == [(i, 0 if i < 50 else 30 if i < 80 else 10) for i in range(90)]
