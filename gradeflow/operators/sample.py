"""Seeded, partition-independent sampling and deterministic choice."""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.positions import positions_of


def _keys(key) -> list[Column]:
    return [F.col(k) for k in ([key] if isinstance(key, str) else key)]


def hash_rank(key, seed: int) -> Column:
    """md5 of ``key|seed``: a random-looking order that any engine repeats."""
    return F.md5(F.concat_ws("|", *[k.cast("string") for k in _keys(key)], F.lit(str(seed))))


BUCKET_HEX = 5  # 16^5 hash buckets


def sample_fixed(df: DataFrame, key: str | Sequence[str], n: int | None, seed: int = 0, ties: str | Sequence[str] = ()) -> DataFrame:
    """The ``n`` rows that come first in hash order; ``n`` of 0/None keeps all; more than
    the table holds gives the whole table. Rows of equal keys come in the order of ``ties``.

    Rows are counted per hash bucket (a small aggregate), and a running count tells where
    each bucket begins. Buckets that begin before ``n`` are kept by a join, and inside a
    bucket rows are numbered: no task ever holds more than a bucket, whatever ``n`` is,
    and building the plan runs no job.
    """
    if not n:
        return df
    columns = df.columns
    ranked = df.withColumn("_rank", hash_rank(key, seed)).withColumn("_bucket", F.substring("_rank", 1, BUCKET_HEX))
    counts = ranked.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # At most 16^BUCKET_HEX rows: the running sum over the bucket counts is small.
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")).filter(F.col("_before") < int(n))
    inside = Window.partitionBy("_bucket").orderBy("_rank", *_keys(key), *_keys(ties))
    kept = ranked.join(begins, "_bucket").withColumn("_nth", F.row_number().over(inside))
    return kept.filter(F.col("_before") + F.col("_nth") <= int(n)).select(*columns)


def sample_capped(df: DataFrame, key: str | Sequence[str], n: int | None, seed: int = 0) -> DataFrame:
    """Same as :func:`sample_fixed`; sampling applies after any type filter."""
    return sample_fixed(df, key, n, seed)


def sample_positions(placed: DataFrame, n: int | None, seed: int = 0, position: str = "position", capped: bool = False) -> DataFrame:
    """The rows whose positions Python's ``random.Random(seed).sample`` picks out of the
    table's row positions (``sources.positions``): the very items that a list of the rows
    would give. ``n`` of 0/None keeps all; more than there are is an error, as there, unless
    ``capped``.

    Only the number of rows and the ``n`` picks are on the driver; the rows are found by an
    equi-join with the picks, which Spark broadcasts under its size limit.
    """
    if not n:
        return placed
    last = placed.agg(F.max(position)).first()[0]
    size = 0 if last is None else last + 1
    if capped and size <= n:
        return placed
    picks = random.Random(seed).sample(range(size), n)
    return placed.join(positions_of(placed.sparkSession, picks, position).drop("pick"), position)


def debug_head(df: DataFrame, key: str | Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows by key (the toolkit's debug mode)."""
    return df.orderBy(*_keys(key)).limit(int(n))


def pick_index(key_cols: Sequence, n, seed: int = 0) -> Column:
    """Deterministic choice in ``[0, n)`` from the first 8 hex digits of md5."""
    cols = [F.col(c) if isinstance(c, str) else c for c in key_cols]
    h = F.md5(F.concat_ws("|", *[c.cast("string") for c in cols], F.lit(str(seed))))
    n_col = F.lit(n) if isinstance(n, int) else n
    return (F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") % n_col).cast("int")
