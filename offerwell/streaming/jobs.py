"""Streaming versions of merge, window, session, negotiation, anomaly and expiry jobs.

Lateness rules are ours: every job names its watermark delay. Jobs drain what is available and stop, keep offsets and
state in a checkpoint below the shared folder, and write to files there, so a restart continues where it stopped. A job can
be given arrivals: steps that bring new input, each followed by a drain. ``Closing`` is the last arrival of a bounded source.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, IntegerType, LongType

from offerwell import constants as K
from offerwell.operators.dedup import keep_first
from offerwell.operators.negotiation import replay
from offerwell.operators.ordered import null_safe_join
from offerwell.operators.pricing import anomaly_columns
from offerwell.session import cut_lineage, work_dir

STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_files(spark: SparkSession, folder: str, schema: str, pattern: str, files_per_batch: int | None = None):
    """Stream of the parquet files of a folder whose name matches the pattern."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


class Arrivals:
    """A folder that a stream watches. Every part is written whole, in as many files as Spark makes of it, before the next drain."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder, self.made = spark, work_dir(spark, f"{name}-arrivals"), 0

    def stream(self, schema) -> DataFrame:
        return self.spark.readStream.schema(schema).parquet(f"{self.folder}/part-*")

    def part(self, df: DataFrame) -> Callable[[], None]:
        self.made += 1
        path = f"{self.folder}/part-{self.made}"
        return lambda: df.write.parquet(path)


#: Event time of the closing row: every real event is before it, and pandas can hold it.
END = "2200-01-01"


class Closing:
    """Ends a bounded source: one row far behind all events moves the watermark past the last of them.

    ``attach`` goes before the watermark of a stream; the row has its event time and null elsewhere, so it belongs to no key, and nothing that
    it opens is ever emitted. Columns that a join compares need a value that no other stream's row has, as rows with null are filtered
    before they reach the watermark. Pass ``close`` as the last arrival.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.ends = spark, name, []

    def attach(self, stream: DataFrame, ts: str = "ts", **values) -> DataFrame:
        end = Arrivals(self.spark, f"{self.name}-end")
        values[ts] = END
        row = self.spark.range(1).select(*[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in stream.schema])
        self.ends.append(end.part(row))
        return stream.unionByName(end.stream(stream.schema))

    def close(self) -> None:
        for end in self.ends:
            end()


def _drain(writer, checkpoint: str, arrivals: Iterable[Callable[[], None] | None]):
    """Run the query until all that is there is read, once per arrival; returns the last run."""
    query = None
    for arrive in arrivals:
        if arrive is not None:
            arrive()
        query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    return query


def append_to_files(stream: DataFrame, name: str, arrivals: Iterable = (None,), progress: list | None = None) -> DataFrame:
    """Run an append query into a parquet sink and return what was written; ``progress`` gets the report of the last run."""
    spark = stream.sparkSession
    path = work_dir(spark, name)
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", f"{path}/out")
    query = _drain(writer, f"{path}/checkpoint", arrivals)
    if progress is not None:
        progress.extend(query.recentProgress)
    return spark.read.schema(stream.schema).parquet(f"{path}/out")


def run_batches(stream: DataFrame, name: str, mode: str, handle: Callable[[DataFrame, int, str], None], arrivals: Iterable = (None,)) -> str:
    """Run ``handle(batch, batch_id, path)`` per micro-batch; returns the output path."""
    path = work_dir(stream.sparkSession, name)
    writer = stream.writeStream.outputMode(mode).foreachBatch(lambda batch, i: handle(batch, i, f"{path}/out"))
    _drain(writer, f"{path}/checkpoint", arrivals)
    return f"{path}/out"


def latest_results(stream: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """Run an update query; a result row is the last version of its key.

    Every batch overwrites its own folder, so a repeated batch leaves no second copy.
    """

    def write(batch: DataFrame, i: int, path: str) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={i}")

    path = run_batches(stream, name, "update", write)
    spark = stream.sparkSession
    schema = stream.schema.add("batch_id", LongType())
    rows = spark.read.schema(schema).parquet(path)
    return keep_first(rows, keys, [F.desc("batch_id")]).drop("batch_id")


def merge_new(stream: DataFrame, key: str, ts: str = "ts", delay: str = "60 days") -> DataFrame:
    """First sighting per key; the delay must cover the longest time between two sightings (append)."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def window_kpis(
    stream: DataFrame, by: Sequence[str], value: str, width: str, slide: str | None = None, delay: str = "1 hour",
    ts: str = "ts",
) -> DataFrame:
    """Count, sum and maximum per tumbling or sliding window (update; rows older than the watermark are dropped)."""
    window = F.window(ts, width, slide) if slide else F.window(ts, width)
    out = stream.withWatermark(ts, delay).groupBy(window.alias("w"), *by)
    return out.agg(F.count("*").alias("n"), F.sum(value).alias("total"), F.max(value).alias("highest")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "n", "total", "highest"
    )


def sessions(stream: DataFrame, key: str, gap: str = "2 hours", delay: str = "1 hour", ts: str = "ts") -> DataFrame:
    """Activity sessions closed by a gap; a session is emitted once the watermark has passed its end (append)."""
    window = F.session_window(ts, gap)
    out = stream.withWatermark(ts, delay).groupBy(key, window.alias("w")).agg(F.count("*").alias("n"))
    return out.select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def severity_counts(stream: DataFrame, width: str = "1 day", delay: str = "1 hour", ts: str = "ts") -> DataFrame:
    """Audit events per window and severity (update)."""
    out = stream.withWatermark(ts, delay).groupBy(F.window(ts, width).alias("w"), "severity")
    return out.agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), "severity", "n")


def anomalies(offers: DataFrame, products: DataFrame, threshold: float = 0.30) -> DataFrame:
    """Alert rows of an offer stream against the stored products; stateless (append)."""
    rows = offers.join(products.select("product_id", "price"), "product_id")
    rows = rows.withColumns(anomaly_columns(F.col("price_proposed"), F.col("price"), threshold))
    return rows.where("is_suspect")


def offer_to_deal(offers: DataFrame, deals: DataFrame, within: str = "3 days", delay: str = "1 hour") -> DataFrame:
    """Offers with the deals of the same buyer inside the time bound; state is dropped past it (append)."""
    o = offers.select("buyer_id", "offer_id", F.col("ts").alias("offer_ts")).withWatermark("offer_ts", delay)
    d = deals.select(F.col("buyer_id").alias("_buyer"), "deal_id", F.col("ts").alias("deal_ts")).withWatermark(
        "deal_ts", delay
    )
    on = F.expr(f"buyer_id = _buyer AND deal_ts >= offer_ts AND deal_ts < offer_ts + INTERVAL {within}")
    return o.join(d, on).drop("_buyer")


def expiry(offers: DataFrame, payments: DataFrame, hours: int = 24, delay: str = "1 hour") -> DataFrame:
    """Offers with their payment inside ``hours``; an offer whose time has passed unpaid comes out expired (append)."""
    o = offers.select("buyer_id", "offer_id", F.col("ts").alias("offer_ts")).withWatermark("offer_ts", delay)
    p = payments.select(F.col("buyer_id").alias("_buyer"), "payment_id", F.col("ts").alias("paid_ts")).withWatermark(
        "paid_ts", delay
    )
    on = F.expr(f"buyer_id = _buyer AND paid_ts >= offer_ts AND paid_ts <= offer_ts + INTERVAL {hours} HOURS")
    rows = o.join(p, on, "left_outer").drop("_buyer")
    return rows.withColumn("status", F.when(F.col("payment_id").isNull(), "EXPIREE").otherwise("PAYEE"))


def late_rows(df: DataFrame, delay: str, ts: str = "ts") -> DataFrame:
    """Batch rule of lateness: older than the latest event time minus the delay."""
    from offerwell.operators.ordered import attach_one

    rows = attach_one(df, df.agg(F.max(ts).alias("_latest")))
    return rows.withColumn("is_late", F.expr(f"{ts} < _latest - INTERVAL {delay}")).drop("_latest")


def late_split(stream: DataFrame, delay: str, name: str, ts: str = "ts", arrivals: Iterable = (None,)) -> DataFrame:
    """Rows of each micro-batch flagged late against the event time reached by the earlier batches.

    Late rows are kept next to the others; the reached time of a batch is stored with it for the next one.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, i: int, path: str) -> None:
        seen = F.lit(None).cast("timestamp")
        if i > 0:
            seen = spark.read.parquet(f"{path}/mark/batch_id={i - 1}").select("reached").scalar()
        rows = batch.withColumn("is_late", F.coalesce(F.col(ts) < seen - F.expr(f"INTERVAL {delay}"), F.lit(False)))
        rows.write.mode("overwrite").parquet(f"{path}/rows/batch_id={i}")
        reached = batch.agg(F.max(ts).alias("m")).select(F.greatest("m", seen).alias("reached"))
        reached.write.mode("overwrite").parquet(f"{path}/mark/batch_id={i}")

    path = run_batches(stream, name, "append", write, arrivals)
    schema = stream.schema.add("is_late", BooleanType()).add("batch_id", LongType())
    return spark.read.schema(schema).parquet(f"{path}/rows")


#: Buckets of the stored table of ``upsert_sink``, and 32,768-bit words of the membership filter of each.
BUCKETS, WORDS = 64, 8


def _bits(key: str) -> Column:
    return F.pmod(F.xxhash64(F.lit("filter"), F.col(key)), F.lit(WORDS * 32768)) + 1


def _bit_is_set(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (position % 8).cast("int")) == 1


def _stored(spark: SparkSession, path: str, schema, buckets: list[int], before: int) -> DataFrame:
    """Rows of earlier batches in the named buckets; the folders of others are not opened."""
    full = schema.add("batch_id", LongType()).add("bucket", IntegerType())
    rows = spark.read.schema(full).parquet(f"{path}/rows")
    return rows.where((F.col("batch_id") < before) & F.col("bucket").isin(buckets))


def upsert_sink(stream: DataFrame, key: str, order: Sequence[str], name: str, arrivals: Iterable = (None,)) -> DataFrame:
    """Merge each micro-batch into the stored table: only keys not stored yet are added, with their first row in ``order``.

    The table lies in buckets of the key's hash, with a bitmap of key hashes per bucket. A micro-batch asks the bitmaps first: keys whose bit is
    not set are new, and only the buckets of the others are read to compare keys. A batch writes its own folders and looks at those of
    earlier batches only, so a repeated batch gives the same table. A null key is a key.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, i: int, path: str) -> None:
        first = keep_first(batch, [key], order).withColumns({"bucket": F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int"), "_bit": _bits(key)})
        first = cut_lineage(first.withColumn("_word", F.bitmap_bucket_number("_bit")), "upsert")
        if i > 0:
            filters = spark.read.schema("bucket int, _word bigint, bits binary, batch_id bigint").parquet(f"{path}/filters").where(F.col("batch_id") < i)
            filters = filters.groupBy("bucket", "_word").agg(F.bitmap_or_agg("bits").alias("_bits"))  # BUCKETS * WORDS rows at most
            asked = first.join(filters, ["bucket", "_word"], "left")
            seen = F.coalesce(_bit_is_set(F.col("_bits"), F.bitmap_bit_position("_bit")), F.lit(False))
            asked = asked.withColumn("_seen", seen).drop("_bits")
            touched = sorted(r["bucket"] for r in asked.where("_seen").select("bucket").distinct().collect())  # BUCKETS rows at most
            known = null_safe_join(asked.where("_seen"), _stored(spark, path, stream.schema, touched, i).select(key), [key], "left_anti")
            first = asked.where("NOT _seen").unionByName(known).drop("_seen")
        first = cut_lineage(first, "upsert-new")
        first.drop("_bit", "_word").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/rows/batch_id={i}")
        bits = first.groupBy("bucket", "_word").agg(F.bitmap_construct_agg(F.bitmap_bit_position("_bit")).alias("bits"))
        bits.write.mode("overwrite").parquet(f"{path}/filters/batch_id={i}")

    path = run_batches(stream, name, "append", write, arrivals)
    return spark.read.schema(stream.schema.add("batch_id", LongType()).add("bucket", IntegerType())).parquet(f"{path}/rows").select(*stream.columns)


# --- negotiation state --------------------------------------------------------------------------------------------


def _earliest(seq: np.ndarray, bid: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``n`` rows with the smallest ``seq`` in their order; equal ones as they came, missing ones last."""
    order = np.argsort(seq, kind="stable")[:n]
    return seq[order], bid[order]


class FirstBids(StatefulProcessor):
    """Keeps the first bids of a negotiation (a handful by contract) and emits them after each accepted bid.

    With the last round the bids are dropped; a mark that the negotiation is over stays, so that bids which still come are not taken for a new
    one. Bids and mark are removed when the watermark is ``idle`` milliseconds past the last bid of the key.
    """

    def __init__(self, idle: int):
        self.idle = idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # Every access is a message to the executor's JVM: one state holds all of a key.
        self.state = handle.getValueState("negotiation", "bids array<double>, seen bigint, over boolean")

    def handleInputRows(self, key, rows, timerValues):
        if pd.isna(key[0]):  # the closing row
            return
        state = self.state.get()
        held, seen, over = state or ([], 0, False)
        held, start = list(held), len(held)
        arrived = []
        for pdf in rows:
            seen = max(seen, int(pdf["ts"].max().value // 1_000_000))
            # Only as many of the earliest rows as there are rounds left can matter.
            if not over:
                arrived.append(_earliest(pdf["seq"].to_numpy(), pdf["bid"].to_numpy(), K.MAX_ROUNDS - start))
        if not state:
            self.handle.registerTimer(seen + self.idle)
        if over:
            self.state.update(([], seen, True))
            return
        seq, bid = arrived[0] if len(arrived) == 1 else _earliest(*(np.concatenate(x) for x in zip(*arrived)), K.MAX_ROUNDS - start)
        held += bid.astype("float64").tolist()
        full = len(held) == K.MAX_ROUNDS
        self.state.update(([], seen, True) if full else (held, seen, False))
        upto = np.arange(start + 1, len(held) + 1)
        out = {"negotiation": np.full(len(upto), int(key[0])), "upto": upto}
        for i in range(K.MAX_ROUNDS):
            out[f"h{i + 1}"] = np.where(upto > i, held[i] if i < len(held) else np.nan, np.nan)
        yield pd.DataFrame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        state = self.state.get()
        due = (state[1] if state else 0) + self.idle
        if due > timerValues.getCurrentWatermarkInMs():  # bids came since the timer was set
            self.handle.registerTimer(due)
        else:
            self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


def negotiate(bids: DataFrame, opening: DataFrame, idle: str = "60 days", delay: str = "1 hour") -> DataFrame:
    """Price after every bid of a stream (append).

    State holds the bids so far and nothing else; the price is the native replay of those few rounds, so pricing has one
    definition. ``bids``: negotiation, seq (order), ts, bid; ``opening``: negotiation, current, floor_price. A negotiation without a bid for
    ``idle`` is over and its state removed; a later bid opens a new one.
    """
    names = [f"h{i}" for i in range(1, K.MAX_ROUNDS + 1)]
    schema = "negotiation bigint, upto int, " + ", ".join(f"{n} double" for n in names)
    wait = int(pd.Timedelta(idle).total_seconds() * 1000)
    states = bids.withWatermark("ts", delay).groupBy("negotiation").transformWithStateInPandas(
        statefulProcessor=FirstBids(wait), outputStructType=schema, outputMode="Append", timeMode="EventTime"
    )
    return states.join(opening, "negotiation")


def negotiated_prices(states: DataFrame) -> DataFrame:
    """Rounds played by the bids that ``negotiate`` wrote: one row per accepted bid with the price after it."""
    last = keep_first(states, ["negotiation"], [F.desc("upto")]).drop("upto")
    return replay(last)
