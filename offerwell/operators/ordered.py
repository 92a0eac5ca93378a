"""Running values, numbering and exact quantiles that do not put one hot key into one task.

A plain window over a key sorts all rows of that key in a single task. ``scan`` is a prefix scan in two passes instead: rows are dealt by sampled
ranges of (key, order) and written, so that a partition holds its share of rows however they are spread over keys and times; every
partition then computes its own running values, and a carry says what the partitions before it hold of the key it opens with. Keys
compare null-safely, so rows with a missing key are kept.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerwell.session import cut_lineage

PART = "_part"


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join on ``keys`` where nulls match; the right keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        on = same if on is None else on & same
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def ranged(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` dealt by sampled ranges of (keys, order) and written; ``_part`` is the number of the range."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(parts, *keys, *order).withColumn(PART, F.spark_partition_id())
    return cut_lineage(rows, "ranges")


def scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: dict[str, Column] | None = None,
    last: dict[str, Column] | None = None,
    previous: dict[str, Column] | None = None,
) -> DataFrame:
    """``df`` with running values per key in ``order``, which must be total; no keys make the whole table one key.

    ``sums`` are inclusive running sums (null counts as 0), ``last`` the latest value that is not null up to and with the row, ``previous`` the value of the
    row before, null or not. Each maps a new column to its expression. Only keys that go on over several ranges have carries, so there are
    fewer carry rows than ranges.
    """
    sums, last, previous = sums or {}, last or {}, previous or {}
    keep = df.columns
    wrapped = {f"_v_{n}": e for n, e in sums.items()}
    wrapped |= {f"_v_{n}": F.when(e.isNotNull(), F.struct(e.alias("v"))) for n, e in last.items()}
    wrapped |= {f"_v_{n}": F.struct(e.alias("v")) for n, e in previous.items()}
    rows = ranged(df.withColumns(wrapped), keys, order)
    at = F.struct(*order)
    totals = rows.groupBy(*keys, PART).agg(
        *[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums],
        *[F.max_by(f"_v_{n}", F.when(F.col(f"_v_{n}").isNotNull(), at)).alias(f"_t_{n}") for n in [*last, *previous]],
    )
    across = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(PART)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        *keys,
        PART,
        F.row_number().over(across).alias("_nth"),
        *[F.sum(f"_t_{n}").over(before).alias(f"_c_{n}") for n in sums],
        *[F.last(f"_t_{n}", ignorenulls=True).over(before).alias(f"_c_{n}") for n in [*last, *previous]],
    )
    carry = F.broadcast(carry.where("_nth > 1").drop("_nth"))  # a range opens with one key: fewer rows than ranges
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    inside = Window.partitionBy(*keys, PART).orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    own = rows.repartitionById(parts, F.col(PART)).withColumns(
        {f"_i_{n}": F.sum(f"_v_{n}").over(upto) for n in sums}
        | {f"_i_{n}": F.last(f"_v_{n}", ignorenulls=True).over(upto) for n in last}
        | {f"_i_{n}": F.lag(f"_v_{n}").over(inside) for n in previous}
    )
    joined = null_safe_join(own, carry, [*keys, PART], "left")
    out = {n: F.coalesce(f"_c_{n}", F.lit(0)) + F.coalesce(f"_i_{n}", F.lit(0)) for n in sums}
    out |= {n: F.coalesce(f"_i_{n}", f"_c_{n}")["v"] for n in [*last, *previous]}
    joined = joined.withColumns(out)
    return joined.select(*[c for c in keep if c not in out], *out)


def number_rows(df: DataFrame, order: Sequence[str], out: str, drop: Sequence[str] = ()) -> DataFrame:
    """1-based number of every row in ``order``, without a global sort in one task; ``drop`` names columns that only the order needs.

    Rows are dealt by sampled ranges, sorted and written with their place in the range, so they are shuffled once; what the ranges
    before hold, one number each, is added on reading.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
    rows = cut_lineage(rows.drop(*drop), "ranges").withColumn(PART, F.shiftright("_place", 33))
    before = Window.partitionBy(F.lit(0)).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(PART).agg(F.count("*").alias("_n"))
    starts = starts.select(PART, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    number = F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    rows = rows.join(F.broadcast(starts), PART)  # a row per range
    return rows.select(*[c for c in df.columns if c not in (out, *drop)], number.alias(out))


@F.arrow_udf(T.LongType())
def _sortable(x: pa.Array) -> pa.Array:
    """Bits of a double as an integer of the same order; both zeros are one."""
    bits = (pc.fill_null(x, 0.0).to_numpy() + 0.0).view(np.int64)
    return pa.array(np.where(bits < 0, bits ^ np.int64(2**63 - 1), bits), mask=x.is_null().to_numpy(zero_copy_only=False))


@F.arrow_udf(T.DoubleType())
def _double(k: pa.Array) -> pa.Array:
    bits = pc.fill_null(k, 0).to_numpy()
    return pa.array(np.where(bits < 0, bits ^ np.int64(2**63 - 1), bits).view(np.float64), mask=k.is_null().to_numpy(zero_copy_only=False))


DIGIT = 16


def column_quantiles(df: DataFrame, by: Sequence[str], columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Exact linear-interpolated quantiles of many columns per group: rows (by, column, n, low, high, q0, q1, ...).

    Radix selection: a double's bits, ordered like the double, are four digits of 16 bits. A pass counts the next digit of the values that share the
    digits found so far for some wanted rank, and every rank settles its digit from those counts. So ``df`` is read once for any number
    of columns and groups, its numbers (written beside the keys) four times; nothing is sorted, and a shuffle carries at most
    65,536 counts per wanted rank. Columns without a value in a group have no row there.
    """
    by, probs = list(by), [float(p) for p in probs]
    group = F.struct(*by) if by else F.lit(0)
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns])).alias("_c")
    rows = df.select(group.alias("_g"), cells).where("_c.x IS NOT NULL").select("_g", F.col("_c.column").alias("_at"), _sortable("_c.x").alias("_k"))
    rows = cut_lineage(rows, "numbers")
    cell = ["_g", "_at"]
    whole = F.lit(None).cast("bigint").alias("_prefix")
    first = rows.groupBy(*cell, whole, F.shiftright("_k", 64 - DIGIT).alias("_digit")).agg(
        F.count("*").alias("_n"), F.min("_k").alias("_low"), F.max("_k").alias("_high")
    )
    first = cut_lineage(first, "digits")
    sizes = first.groupBy(*cell).agg(F.sum("_n").alias("n"), F.min("_low").alias("_low"), F.max("_high").alias("_high"))
    place = lambda p: (F.col("n") - 1) * p
    ranks = F.array_distinct(F.array(*[f(place(p)).cast("bigint") for p in probs for f in (F.floor, F.ceil)]))
    wanted = sizes.select(*cell, F.explode(ranks).alias("_rank")).withColumn("_left", F.col("_rank")).withColumn("_prefix", F.lit(None).cast("bigint"))
    for shift in range(64 - DIGIT, -1, -DIGIT):
        counts = first
        if shift + DIGIT < 64:
            live = rows.withColumn("_prefix", F.shiftright("_k", shift + DIGIT))
            live = null_safe_join(live, wanted.select(*cell, "_prefix").distinct(), [*cell, "_prefix"], "left_semi")
            counts = live.groupBy(*cell, "_prefix", F.shiftright("_k", shift).alias("_digit")).agg(F.count("*").alias("_n"))
        upto = Window.partitionBy(*cell, "_prefix").orderBy("_digit").rowsBetween(Window.unboundedPreceding, 0)
        counts = counts.withColumn("_end", F.sum("_n").over(upto))
        met = null_safe_join(wanted, counts, [*cell, "_prefix"], "inner").where("_left < _end AND _left >= _end - _n")
        wanted = met.select(*cell, "_rank", (F.col("_left") - F.col("_end") + F.col("_n")).alias("_left"), F.col("_digit").alias("_prefix"))
        wanted = cut_lineage(wanted, "digits")
    found = wanted.groupBy(*cell).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_prefix"))).alias("_found"))
    out = null_safe_join(sizes, found, cell, "inner")
    picks = []
    for i, p in enumerate(probs):
        low, high = (_double(F.element_at("_found", f(place(p)).cast("bigint"))) for f in (F.floor, F.ceil))
        picks.append((low + (high - low) * (place(p) - F.floor(place(p)))).alias(f"q{i}"))
    return out.select(*[F.col(f"_g.{c}").alias(c) for c in by], F.col("_at").alias("column"), "n", _double("_low").alias("low"), _double("_high").alias("high"), *picks)


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """``column_quantiles`` of one column."""
    return column_quantiles(df, by, [value], probs).drop("column")


def attach_one(df: DataFrame, one: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame; they are computed once, as a single scalar subquery."""
    row = one.select(F.struct(*one.columns).alias("r")).scalar()
    rows = df.withColumn("_one", row)
    return rows.select(*df.columns, *[F.col(f"_one.{c}").alias(c) for c in one.columns])
