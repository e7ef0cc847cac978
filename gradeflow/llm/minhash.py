"""Near-duplicate documents by min-max hashing.

Under each permutation both the least and the greatest hash of a document's
shingle set are kept, so ``PERMUTATIONS`` evaluations give twice as many
signature values (each agrees with the probability of the Jaccard similarity).
The values are banded; documents that share a band are candidates, and a link
counts only after the full sets are compared (100 * common >= 75 * union).

The bands (40 of 4 values) miss a pair of similarity 0.75 with a probability of
2.5e-7.  How the work is kept linear in hot groups, without losing a link:

* documents with the same shingle set are one node from the start;
* for each candidate node the shingles that occur in another candidate are counted, and
  a parity sketch is kept (bit i tells whether an odd number of shingles hash to i). A
  pair cannot be linked unless 7 * (the smaller count) >= 3 * (both sizes), nor if the
  sketches differ in more than a seventh of both sizes in bits: every bit that differs
  stands for a shingle that only one of them has.  Both bounds are exact, and part the
  members of a family of copies that differ too much before any pair is made;
* in a band shared by many nodes each node is first compared with one of them only (a
  star around the node with most of its shingles in others); links make components;
* then every possible pair of nodes that share a band but not a component is compared.
  Pairs inside a component cannot change the result.

Cases: a null, empty or wordless text has an empty set, is linked with nothing
and is its own component; a text of fewer than five words is one shingle;
repeated rows have the same set and so one component; a null id takes part, and
the smallest non-null id of a component names it; columns other than ``doc_id``
and ``text`` are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_slice, small_or_shuffled, stored
from .components import components
from .shingles import mixed, shingle_sets

BANDS, ROWS = 40, 4
PERMUTATIONS = BANDS * ROWS // 2
PERCENT = 75
#: Bits of the parity sketch, as so many 64-bit words.
WORDS = 8
PARITY = [f"p{i}" for i in range(WORDS)]
_RNG = np.random.default_rng(75)
FACTOR = _RNG.integers(1, 1 << 63, PERMUTATIONS, np.uint64) * np.uint64(2) + np.uint64(1)
SHIFT = _RNG.integers(1, 1 << 63, PERMUTATIONS, np.uint64)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The least and the greatest value under each permutation."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(PERMUTATIONS, np.uint64)
    for at in range(0, len(hashes), 1024):
        part = np.multiply.outer(FACTOR, hashes[at : at + 1024])
        part += SHIFT[:, None]
        np.minimum(low, part.min(axis=1), out=low)
        np.maximum(high, part.max(axis=1), out=high)
    return np.concatenate([low, high])


def band_keys(values: np.ndarray) -> np.ndarray:
    groups = values.reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for j in range(ROWS):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + groups[:, j])
    return key


def _digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _signed(batch: pa.RecordBatch) -> pa.RecordBatch:
    sets = shingle_sets(batch.column("text"))
    digests = pa.array([_digest(s) if len(s) else None for s in sets], pa.binary())
    bands = pa.array([band_keys(signature(s)).tobytes() if len(s) else None for s in sets], pa.binary())
    n = pa.array([len(s) for s in sets], pa.int64())
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), n, digests, bands], names=["doc_id", "text_hash", "n_shingles", "digest", "bands"])


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_shingles, digest, bands) of every document."""
    text = F.col("text").cast("string")
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return slim.mapInArrow(per_slice(_signed), "doc_id bigint, text_hash bigint, n_shingles bigint, digest binary, bands binary")


def _exploded(batch: pa.RecordBatch) -> pa.RecordBatch:
    """One row for each band of each node, with the node's other columns."""
    keys = np.frombuffer(b"".join(batch.column("bands").to_pylist()), np.int64)
    again = pa.array(np.repeat(np.arange(batch.num_rows), BANDS))
    names = [c for c in batch.schema.names if c != "bands"]
    return pa.RecordBatch.from_arrays([pa.array(keys), *(batch.column(c).take(again) for c in names)], names=["band", *names])


def by_band(nodes: DataFrame) -> DataFrame:
    """The nodes, once for each of their bands."""
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema.fields if f.name != "bands")
    return nodes.mapInArrow(per_slice(_exploded), f"band bigint, {fields}")


def candidate_nodes(nodes: DataFrame) -> DataFrame:
    """The nodes that share a band with another."""
    rows = by_band(nodes.select("node", "bands"))
    return rows.join(_shared(rows, "band"), "band", "left_semi").select("node").distinct()


def _shared(rows: DataFrame, key: str, of: str = "node") -> DataFrame:
    """The keys that several nodes (or roots) have."""
    return rows.groupBy(key).agg(F.min(of).alias("lo"), F.max(of).alias("hi")).filter("lo < hi").select(key)


def _sets(batch: pa.RecordBatch) -> pa.RecordBatch:
    sets = shingle_sets(batch.column("text"))
    parity = np.zeros((len(sets), WORDS), np.int64)
    for i, s in enumerate(sets):
        odd = np.bincount((s & np.uint64(64 * WORDS - 1)).astype(np.int64), minlength=64 * WORDS) & 1
        parity[i] = np.packbits(odd.astype(np.uint8)).view(np.int64)
    digests = pa.array([_digest(s) if len(s) else None for s in sets], pa.binary())
    return pa.RecordBatch.from_arrays([digests, pa.array([s.tobytes() for s in sets], pa.binary()), *(pa.array(parity[:, i]) for i in range(WORDS))], names=["digest", "shingles", *PARITY])


def full_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, n, shingles, parity) of candidate nodes, read again from one document of each."""
    wanted = stored(nodes.join(candidate_nodes(nodes), "node").select("node", "n_shingles", "digest", "first_id"), "wanted")
    ids = wanted.select(F.col("first_id").alias("_id")).distinct()
    slim = docs.select(F.col("doc_id").cast("bigint").alias("_doc"), F.col("text").cast("string").alias("text"))
    texts = slim.join(small_or_shuffled(ids, wanted.count()), F.col("_doc").eqNullSafe(F.col("_id")), "left_semi").select("text")
    sets = texts.mapInArrow(per_slice(_sets), "digest binary, shingles binary, " + ", ".join(f"{p} bigint" for p in PARITY))
    # copies of one document give the same set: any one of them serves
    rows = sets.join(wanted.select("node", "n_shingles", "digest"), "digest").withColumnRenamed("n_shingles", "n")
    return stored(rows.groupBy("node").agg(*[F.first(c).alias(c) for c in ("n", "shingles", *PARITY)]), "sets")


def _occurrences(batch: pa.RecordBatch) -> pa.RecordBatch:
    sets = [np.frombuffer(x.as_py(), np.uint64) for x in batch.column("shingles")]
    # half a hash will do: a chance agreement only makes the bound weaker
    half = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(half), pa.array(np.repeat(batch.column("node").to_numpy(), [len(s) for s in sets]))], names=["half", "node"])


def shared_counts(sets: DataFrame) -> DataFrame:
    """(node, n, c): a node's size, and how many of its shingles another candidate has
    (or more: two shingles may agree by chance)."""
    rows = sets.select("node", "shingles").mapInArrow(per_slice(_occurrences), "half int, node bigint")
    counts = rows.join(_shared(rows, "half"), "half", "left_semi").groupBy("node").agg(F.count("*").alias("c"))
    return sets.select("node", "n").join(counts, "node").filter(f"100 * c >= {PERCENT} * n")


def _compared(batch: pa.RecordBatch) -> pa.RecordBatch:
    common, total = [], []
    for x, y in zip(batch.column("set_a"), batch.column("set_b")):
        p, q = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
        both = len(np.intersect1d(p, q, assume_unique=True))
        common.append(both), total.append(len(p) + len(q) - both)
    return pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(common, pa.int64()), pa.array(total, pa.int64())], names=["a", "b", "common", "total"])


def similarities(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, common, total) of candidate pairs, from their full sets."""
    sets = sets.select("node", "shingles")
    full = (
        pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b")), "b")
        .join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")), "a")
        .select("a", "b", "set_a", "set_b")
    )
    return stored(full.mapInArrow(per_slice(_compared), "a bigint, b bigint, common bigint, total bigint"), "compared")


def _possible(a: str, b: str):
    """Whether two nodes (columns with these prefixes) can be linked, by sizes, shared
    counts and parity sketches: with 75 of 100 in common, the common part is at least 3/7
    of both sizes, and what only one of them has at most 1/7."""
    apart = " + ".join(f"bit_count({a}{p} ^ {b}{p})" for p in PARITY)
    only = f"({100 + PERCENT}) * ({apart}) <= {100 - PERCENT} * ({a}n + {b}n)"
    return F.expr(f"{100 + PERCENT} * least({a}c, {b}c) >= {PERCENT} * ({a}n + {b}n) and {only}")


def _prefixed(rows: DataFrame, prefix: str) -> DataFrame:
    return rows.select("band", *[F.col(c).alias(prefix + c) for c in rows.columns if c != "band"])


def links(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, root): the component of every node that has a verified link."""
    sets = full_sets(docs, nodes)
    known = shared_counts(sets).join(sets.select("node", *PARITY), "node").join(nodes.select("node", "bands"), "node")
    known = stored(known, "candidates")
    stars = similarities(sets, _stars(stored(_open(known.withColumn("root", F.col("node"))), "open")))
    labels = stored(components(_linked(stars)), "labels")
    rows = known.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rest = _remaining(stored(_open(rows), "open"))
    rest = similarities(sets, rest.join(stars, ["a", "b"], "left_anti"))
    return components(_linked(stars.unionByName(rest)))


def _linked(compared: DataFrame) -> DataFrame:
    return compared.filter(f"100 * common >= {PERCENT} * total").select("a", "b")


def _open(nodes: DataFrame) -> DataFrame:
    """The nodes once for each band that holds several components."""
    rows = by_band(nodes)
    return rows.join(_shared(by_band(nodes.select("root", "bands")), "band", "root"), "band")


def _stars(rows: DataFrame) -> DataFrame:
    """Each node of a band with the band's centre: the node with the greatest part of its
    shingles in other candidates, which the bands of one group share."""
    node = F.struct(*[c for c in rows.columns if c != "band"])
    centre = rows.groupBy("band").agg(F.min(F.struct((-F.col("c") / F.col("n")).alias("rank"), "node", node.alias("at"))).alias("m"))
    pairs = _prefixed(rows, "x_").join(_prefixed(centre.select("band", "m.at.*"), "y_"), "band").filter("x_node <> y_node").filter(_possible("x_", "y_"))
    return pairs.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()


def _remaining(rows: DataFrame) -> DataFrame:
    """Every possible pair that shares a band but no component.

    The component with most entries of a band stays on one side of the join only, so
    a large component costs its size times the strangers in its band.
    """
    sizes = rows.groupBy("band", "root").agg(F.count("*").alias("k"))
    main = sizes.groupBy("band").agg(F.max(F.struct("k", "root")).alias("m")).select("band", F.col("m.root").alias("main"))
    rows = rows.join(main, "band")
    left, right = _prefixed(rows.filter("root <> main"), "x_"), _prefixed(rows, "y_")
    met = left.join(right, (left["band"] == right["band"]) & F.expr("x_root <> y_root and (y_root = y_main or x_node < y_node)") & _possible("x_", "y_"))
    return met.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()


def grouped(docs: DataFrame) -> DataFrame:
    """``near_duplicates`` with ``text_hash`` and ``root``, the component (null: an empty set)."""
    signed = stored(signatures(docs), "signed")
    groups = signed.filter("digest is not null").groupBy("digest")
    nodes = groups.agg(F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"))
    # ids are given once, in the written table, and never computed again
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    labels = links(docs, nodes)
    names = nodes.select("digest", "node", "first_id").join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = names.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = names.join(named, "root").select("digest", "component_id", "root")
    out = signed.select("doc_id", "text_hash", "n_shingles", "digest").join(classes, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "text_hash", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "root")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document."""
    return grouped(docs).select("doc_id", "n_shingles", "component_id", "kept")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents with one row of each group left; columns as given.

    A row of the smallest id stays: where several rows of a group have that id, the one
    of the least text hash, and of equal rows the least by its other columns. Rows with
    an empty set belong to no group and all stay.
    """
    found = stored(grouped(docs).filter("root is not null"), "found")
    first = found.filter("kept").groupBy("root").agg(F.min("text_hash").alias("least"), F.count("*").alias("k")).filter("k > 1").select("root", "least")
    also = found.filter("kept").join(first, "root").filter("text_hash <> least")
    gone = found.filter("not kept").unionByName(also.select(found.columns)).select(F.col("doc_id").alias("_gone"), F.col("text_hash").alias("_hash")).distinct()
    # the row goes along in one column, so that no name of its own meets those used here
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    hashed = docs.select(row, F.col("doc_id").alias("_doc_id"), F.xxhash64(F.col("text").cast("string")).alias("_text_hash"))
    same_row = lambda ids, hashes: F.col("_doc_id").eqNullSafe(F.col(ids)) & (F.col("_text_hash") == F.col(hashes))
    rest = hashed.join(small_or_shuffled(gone, gone.count()), same_row("_gone", "_hash"), "left_anti")
    twice = found.filter("kept").groupBy("doc_id", "text_hash").count().filter("count > 1").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    n = twice.count()
    if not n:
        return rest.select("_row.*")
    again = rest.join(small_or_shuffled(twice, n), same_row("_id", "_hash"), "left_semi")
    single = rest.join(small_or_shuffled(twice, n), same_row("_id", "_hash"), "left_anti")
    one = again.groupBy("_doc_id", "_text_hash").agg(F.min("_row").alias("_row"))
    return single.select("_row.*").unionByName(one.select("_row.*"))
