"""Token counts from an exact length histogram.

Every whole text is encoded once by a public byte-pair vocabulary; only its length
leaves the task.  The histogram (length, documents) answers every context limit L by
suffix sums: documents of at least L, their tokens, and the tokens kept when every
document is cut at L, sum(min(length, L)); prefix counts give the quantiles.

The suffix sums run in two levels: blocks of ``BLOCK`` lengths are summed first, so no
task holds more than a block's lengths or the list of blocks, however many rows there are.

The vocabulary file is a parameter and goes to the tasks by broadcast (its size is
checked).

Cases: a null or empty text has length 0; an empty table gives an empty histogram;
repeated rows count each; columns other than ``text`` are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

BLOCK = 1024
MAX_RANKS = 16 << 20


def _encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def token_lengths(docs: DataFrame, ranks_file: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens) of every whole text."""
    with open(ranks_file, "rb") as f:
        ranks = f.read(MAX_RANKS + 1)
    if len(ranks) > MAX_RANKS:
        raise ValueError(f"{ranks_file} is over {MAX_RANKS} bytes")
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(shared.value, pattern)
        for batch in batches:
            n = [len(encoding.encode_ordinary(t.as_py() or "")) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64())], names=["doc_id", "n_tokens"])

    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id bigint, n_tokens bigint")


def histogram(lengths: DataFrame) -> DataFrame:
    """(n_tokens, n_docs): one row for each length that occurs."""
    return lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def stored_histogram(lengths: DataFrame) -> DataFrame:
    """The histogram, written once: its rows are read several times, the texts only once."""
    return stored(histogram(lengths), "histogram")


def totals(hist: DataFrame) -> DataFrame:
    """For each length L of the histogram: documents and tokens of at least L, tokens left
    when all are cut at L, and the share of documents of at most L (their quantile)."""
    rows = hist.withColumn("block", F.expr(f"n_tokens div {BLOCK}")).withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    after = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    # one row for each block of lengths: the longest text over BLOCK rows at most
    blocks = blocks.select("block", F.coalesce(F.sum("d").over(after), F.lit(0)).alias("docs_after"), F.coalesce(F.sum("t").over(after), F.lit(0)).alias("tokens_after"), F.sum("d").over(Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("all_docs"), F.sum("t").over(Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("all_tokens"))
    down = Window.partitionBy("block").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = rows.join(blocks, "block").select(
        "n_tokens",
        "n_docs",
        (F.sum("n_docs").over(down) + F.col("docs_after")).alias("docs_at_least"),
        (F.sum("tokens").over(down) + F.col("tokens_after")).alias("tokens_at_least"),
        "all_docs",
        "all_tokens",
    )
    # what is shorter stays whole, what is at least as long leaves L each
    cut = F.col("all_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")
    share = (F.col("all_docs") - F.col("docs_at_least") + F.col("n_docs")) / F.col("all_docs")
    return out.select("n_tokens", "n_docs", "docs_at_least", "tokens_at_least", cut.alias("tokens_cut_here"), share.alias("quantile"))


def at_limit(answers: DataFrame, limit: int) -> DataFrame:
    """(docs_over, tokens_cut) for any context limit, from the answers of the lengths:
    between two lengths the cut total is linear."""
    row = F.struct("n_tokens", "docs_at_least", "tokens_cut_here")
    found = answers.agg(F.min(F.when(F.col("n_tokens") > limit, row)).alias("r"), F.max(row).alias("w"))
    cut = F.coalesce(F.col("r.tokens_cut_here") - (F.col("r.n_tokens") - limit) * F.col("r.docs_at_least"), F.col("w.tokens_cut_here"), F.lit(0))
    return found.select(F.lit(limit).alias("context_limit"), F.coalesce("r.docs_at_least", F.lit(0)).alias("docs_over"), cut.alias("tokens_cut"))
