"""CSV files with quoted newlines, read by several tasks each.

Spark's multi-line reader takes a whole file in one task.  Here a file is read as lines,
which split; a line that ends inside a quoted cell goes on in the next.  Doubled quotes
do not change whether a cell is open, so the parity of the quotes tells:

1. quotes are counted per split (one small row each), and a running sum of parities over
   the splits of a file tells which splits begin inside a cell; that goes to the lines by a
   broadcast of one flag per split;
2. each split is read again in order, and its lines are put together to records; what was
   begun before the split or is not finished at its end becomes a fragment; Spark's
   ``from_csv`` reads the cells of each whole record, once, in the same pass;
3. fragments, at most two per split, are joined across split ends: they are numbered without
   their text, which meets only the other fragments of its own record; their cells are read then.

A task reads as many splits as the session's own settings give it bytes: splits may be small
without a task, a Python start and a file for each.

Nothing but small rows per split, no text, reaches the driver.  Quotes stand for cells only where they
enclose them, as the writers of this package and RFC 4180 have it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..fixed_values import NA_STRINGS
from ..session import scratch_path, settings
from .io import BAD_RECORD, CSV_READ_OPTIONS, na_to_null, named_columns
from .positions import FILE, START, from_files

#: A whole record, the end of one begun before, the begin of one, a split inside one.
WHOLE, HEAD, TAIL, INSIDE = range(4)
RECORDS = f"{FILE} string, {START} bigint, seq bigint, kind int, record string"
SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"
OPEN_COST = "spark.sql.files.openCostInBytes"
MOST_TASKS = "spark.sql.files.maxPartitionNum"
#: Bytes that a task holds of the records that it writes, and whoever reads them, of each file.
RECORDS_BLOCK = 1 << 24


def _quotes(line: Column) -> Column:
    return F.octet_length(line) - F.octet_length(F.replace(line, F.lit('"'), F.lit("")))


def split_records(lines: DataFrame) -> DataFrame:
    """Records and fragments of records of each split, in the order of its lines (``seq``).

    ``inside``, a column: whether the line's split begins inside a quoted cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # parts: the lines so far of a record that is not closed yet
        place, opened, parts, kind, seq = None, False, [], WHOLE, 0
        out: list[tuple] = []

        def put(kinds: list[int], records: pa.Array) -> None:
            nonlocal seq
            n = len(kinds)
            out.append((pa.repeat(place[0], n), pa.repeat(pa.scalar(place[1], pa.int64()), n), pa.array(range(seq, seq + n), pa.int64()), pa.array(kinds, pa.int32()), records))
            seq += n

        def end_split() -> None:
            """What is still open is all that the split has of its record."""
            nonlocal parts
            if parts:
                put([INSIDE if kind == HEAD else TAIL], pa.array(["\n".join(parts)]))
            parts = []

        def passed_on() -> pa.RecordBatch:
            columns = [pa.concat_arrays(c) for c in zip(*out)] or [pa.array([], t) for t in (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string())]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=[FILE, START, "seq", "kind", "record"])

        for batch in batches:
            n = batch.num_rows
            files, starts, inside, values = (batch.column(c) for c in (FILE, START, "inside", "value"))
            odd = pc.bit_wise_and(pc.count_substring(values, '"'), 1).to_numpy()
            other = pc.or_(pc.not_equal(files[1:], files[:-1]), pc.not_equal(starts[1:], starts[:-1])) if n else pa.array([], pa.bool_())
            begins = [0, *(np.flatnonzero(other.to_numpy(zero_copy_only=False)) + 1).tolist()] if n else []
            for begin, end in zip(begins, [*begins[1:], n]):
                here = (files[begin].as_py(), starts[begin].as_py())
                if here != place:
                    end_split()
                    place, opened, seq = here, inside[begin].as_py(), 0
                    kind = HEAD if opened else WHOLE
                open_after = (np.cumsum(odd[begin:end]) + opened) % 2
                opened = bool(open_after[-1])
                closed = np.flatnonzero(open_after == 0) + begin + 1
                bounds = np.concatenate(([begin], closed, [end] if opened else [])).astype(np.int32)
                texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds), values), "\n")
                if not len(closed):
                    parts.append(texts[0].as_py())
                    continue
                if parts:
                    put([kind], pa.array(["\n".join([*parts, texts[0].as_py()])]))
                else:
                    put([kind], texts[:1])
                put([WHOLE] * (len(closed) - 1), texts[1 : len(closed)])
                parts, kind = [texts[-1].as_py()] if opened else [], WHOLE
            yield passed_on()
        end_split()
        yield passed_on()

    return lines.mapInArrow(run, RECORDS)


def csv_records(spark: SparkSession, path: str, parse: Callable[[DataFrame], DataFrame], split_bytes: int | None = None) -> DataFrame:
    """(file, start, seq, what ``parse`` makes of ``record``) of every record of the files,
    written once; the order (file, start, seq) is that of the files. ``parse`` must give null
    columns for a null record. ``split_bytes``: the size of a split; a task reads many small
    ones, one after the other, so their size does not tell the number of tasks."""
    held = {}
    if split_bytes:
        # as many tasks as the session's own settings give for these files
        tasks = spark.read.option("lineSep", "\n").text(path).rdd.getNumPartitions()
        held = {SPLIT_BYTES: str(split_bytes), OPEN_COST: "0", MOST_TASKS: str(max(tasks, 1))}
    with settings(spark, held):
        lines = from_files(spark.read.option("lineSep", "\n").text(path))
        sums = lines.groupBy(FILE, START).agg((F.sum(_quotes(F.col("value"))) % 2).alias("odd"))
        until = Window.partitionBy(FILE).orderBy(START)
        sums = sums.select(FILE, START, "odd", (F.coalesce(F.sum("odd").over(until.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2 == 1).alias("inside"), (F.sum("odd").over(until) % 2 == 1).alias("open"))
        sums_path = scratch_path(spark, "csv_parities")
        sums.write.parquet(sums_path)
        sums = spark.read.schema(sums.schema).parquet(sums_path)
        last = sums.groupBy(FILE).agg(F.max_by("open", START).alias("open")).filter("open").select(FILE).first()
        if last:
            raise ValueError(f"{last[0]} ends inside a quoted cell")
        records_path = scratch_path(spark, "csv_records")
        # a broadcast join leaves the lines of a split in their order
        found = split_records(lines.join(F.broadcast(sums.select(FILE, START, "inside")), [FILE, START]))
        # a fragment is text of its own column, so that its pass reads no whole records
        whole = F.col("kind") == WHOLE
        rows = parse(found.withColumns({"fragment": F.when(~whole, F.col("record")), "record": F.when(whole, F.col("record"))}))
        rows.write.option("parquet.block.size", RECORDS_BLOCK).parquet(records_path)
    rows = spark.read.schema(rows.schema).parquet(records_path)
    # at most two per split: the end of the one before, the begin of the next
    fragments = rows.filter(F.col("kind") != WHOLE).select(FILE, START, "seq", "kind", "fragment")
    nth = F.count_if(F.col("kind") == TAIL).over(Window.partitionBy(FILE).orderBy(START, "seq"))
    numbers = fragments.select(FILE, START, "seq", "kind").select(FILE, START, "seq", nth.alias("nth"))
    fragments = fragments.join(F.broadcast(numbers), [FILE, START, "seq"])
    joined = fragments.groupBy(FILE, "nth").agg(F.array_sort(F.collect_list(F.struct(START, "seq", "fragment"))).alias("parts"))
    joined = parse(joined.select(FILE, F.col("parts")[0][START].alias(START), F.col("parts")[0]["seq"].alias("seq"), F.array_join("parts.fragment", "\n").alias("record")))
    return rows.filter(F.col("kind") == WHOLE).drop("kind", "fragment").unionByName(joined)


def read_csv_split(spark: SparkSession, path: str, columns: Sequence[str] | None = None, na_values: Sequence[str] = NA_STRINGS, split_bytes: int | None = None) -> tuple[DataFrame, DataFrame]:
    """As ``io.read_csv_parts``: (rows, records that do not fit the header), from files that
    several tasks read each."""
    names = spark.read.options(**CSV_READ_OPTIONS).csv(path).columns
    chosen = named_columns(names, columns, path)
    schema = ", ".join("`" + n.replace("`", "``") + "` string" for n in [*names, BAD_RECORD])
    options = {k: v for k, v in CSV_READ_OPTIONS.items() if k in ("quote", "escape")} | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_RECORD}
    cell = {n: f"cell{i}" for i, n in enumerate(names)}

    def parse(records: DataFrame) -> DataFrame:
        """The cells of each record and, of one that does not fit, its text."""
        # the newline of a record may be preceded by a carriage return
        records = records.withColumn("record", F.regexp_replace("record", "\r\\z", ""))
        records = records.withColumn("cells", F.from_csv(F.regexp_replace("record", "\\A\ufeff", ""), schema, options))
        empty, bad = F.col("record") == "", F.col("cells")[BAD_RECORD].isNotNull()
        cells = [F.col("cells")[n].alias(c) for n, c in cell.items()]
        others = [c for c in records.columns if c not in ("record", "cells")]
        return records.select(*others, empty.alias("empty"), bad.alias("bad"), F.when(bad, F.col("record")).alias("record"), *cells)

    rows = csv_records(spark, path, parse, split_bytes).filter(~F.col("empty"))
    first = (F.col(START) == 0) & (F.col("seq") == 0)
    wrong = F.raise_error(F.concat(F.lit("another header in "), F.col(FILE))).cast("boolean")
    header = F.lit(True)
    for n, c in cell.items():
        header = header & F.col(c).eqNullSafe(F.lit(n))
    # the first record of each file is its header, and must be the same one
    rows = rows.filter(F.when(first, F.when(header, F.lit(False)).otherwise(wrong)).otherwise(F.lit(True)))
    good = rows.filter(~F.col("bad")).select(*[F.col(cell[n]).alias(n) for n in chosen])
    return na_to_null(good, na_values), rows.filter("bad").select("record")
