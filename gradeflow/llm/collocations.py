"""Phrase collocations by Toivonen's sampling method.

A sample of the documents proposes frequent words and phrases, at a lowered threshold.
A full pass then counts every phrase whose two parts of one word less were both proposed:
the proposed phrases and their negative border.  Where a phrase of the border turns out
frequent, its extensions were not counted: it joins the proposals, and a further pass
counts what that adds to the border, until no border phrase is frequent.  Each pass
closes one length, so there are at most ``max_words`` passes.  These passes count by a
64-bit hash of language and phrase, which never counts less than there is; a last pass
counts by their texts the phrases whose hash is frequent.  So the result is exact,
whatever the sample held and whatever hashes meet; a poor sample costs passes.

Proposals go to the tasks as bits of a fixed size (``BITS``), by the hash of the phrase.
Two phrases of one bit only make the border larger.

A task counts in numpy, a block of about ``FLUSH`` bytes at a time, and puts its blocks
together before anything is shuffled; a common phrase or language is a row per task.

Words and pieces: A-Z in lower case; pieces part at ``[.,;:!?\\x0A-\\x0D]``, words at
spaces and tabs; phrases lie in one piece.  All is per language.

Cases: a null text is empty, a null language is ``und``; very long texts are counted whole,
in blocks cut between pieces (a piece is held whole); repeated rows count as often as they occur; an empty table
or one without frequent phrases gives an empty result; columns other than ``text`` and
``lang`` (and ``doc_id`` for the draw of the sample) are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import give_back, stored
from .subword import word_hashes

#: Bits of the proposals of each length (as a power of two): 4 MB each.
BITS = 25
#: Bytes of a block that is counted at a time, and words that a task keeps numbered.
FLUSH = 1 << 20
KEPT_WORDS = 1 << 19
#: Different hashes, and different phrases, that a task holds before it passes them on.
HELD_HASHES = 1 << 21
HELD_PHRASES = 1 << 21
#: Blocks whose phrases are held before they are put together.
MERGED = 8
#: The range of a hash is its head of 8 bits.
RANGE = np.uint64(56)
#: Rows passed on at a time.
ROWS_OUT = 1 << 15
#: Bytes of a text that are handled at a time (cut after a piece).
SLICE = 1 << 20
#: One of so many documents is in the sample.
SAMPLE = 8
SEPARATORS = b".,;:!?\n\x0b\x0c\r"
TABLE = bytes(0x2E if b in SEPARATORS else 0x20 if b == 9 else b for b in range(256))
SEPARATOR = re.compile(b"[" + re.escape(SEPARATORS) + b"]")
Bits = list[np.ndarray]  # proposals of one word, two words, ...


def _cleaned(text: str) -> Iterator[bytes]:
    """The text with A-Z in lower case, "." for what parts pieces and a space for a tab, in
    slices cut after a piece."""
    data = text.encode("utf-8")
    at = 0
    while at < len(data):
        cut = SEPARATOR.search(data, at + SLICE) if len(data) - at > SLICE else None
        end = cut.end() if cut else len(data)
        yield data[at:end].lower().translate(TABLE)  # only A-Z have a lower case in bytes
        at = end


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list[bytes]]]:
    """The cleaned texts of a block by language."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            for data in _cleaned(text.as_py() or ""):
                held.setdefault(lang, []).append(data)
                size += len(data)
                if size >= FLUSH:
                    yield held
                    held, size = {}, 0
        give_back()
    if held:
        yield held


def hashed_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word of a cleaned text, and whether the next word follows in its piece."""
    codes = np.frombuffer(data, np.uint8)
    word = (codes != 0x2E) & (codes != 0x20)
    edge = np.diff(np.concatenate([[False], word, [False]]).view(np.int8))
    begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    piece = np.cumsum(codes == 0x2E)[begins] if len(begins) else begins
    return word_hashes(codes.astype(np.uint32), begins, ends), np.append(piece[1:] == piece[:-1], False)[: len(begins)]


class Words(dict):
    """Numbers of words, given when they are first met, and their hashes; 0 ends a piece."""

    def __init__(self):
        super().__init__({b".": 0})
        self.names = [b"."]
        self._hashes = np.zeros(1, np.uint64)

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.names)
        self.names.append(word)
        return n

    def hashes(self) -> np.ndarray:
        if new := self.names[len(self._hashes) :]:
            self._hashes = np.concatenate([self._hashes, hashed_words(b" ".join(new))[0]])
        return self._hashes

    def numbers(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The number of each word of a cleaned text, and whether the next word follows in its piece."""
        tokens = data.replace(b".", b" . ").split()
        found = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        word = found != 0
        piece = np.cumsum(~word)[word]
        return found[word], np.append(piece[1:] == piece[:-1], False)[: len(piece)]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _bit(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether the hashes are among the proposals."""
    at = h >> np.uint64(64 - BITS)
    return (bits[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def places(words: np.ndarray, follows: np.ndarray, lang: str, bits: Bits, before: Bits | None, max_words: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, hashes) of the phrases to count in a block of one language.

    ``words``: the hash of each word; ``follows``: whether the next is in the same piece.
    A phrase counts where both its parts of one word less are in ``bits``, unless both were
    ``before``, as it has been counted then; every word counts in the first pass."""
    one = _mix(words ^ np.uint64(xxhash.xxh64_intdigest(lang.encode("utf-8"))))
    size = len(one)
    at = np.arange(size)
    if before is None:
        yield 1, at, one
    h, was = one, np.ones(size + 1, bool)  # was: counted by earlier passes
    for k in range(2, max_words + 1):
        if len(bits) < k - 1:
            return
        # where phrases of k - 1 words begin that are proposed now, and were before
        now, old = np.zeros(size + 1, bool), np.zeros(size + 1, bool)
        now[at] = found = _bit(bits[k - 2], h[at])
        if before is not None:
            old[at] = was[at] & _bit(before[k - 2], h[at])
        at = at[found]
        at = at[now[at + 1] & follows[at]]
        if not len(at):
            return
        longer = np.zeros(size, np.uint64)
        longer[at] = _mix(h[at] * np.uint64(0x9E3779B97F4A7C15) + one[at + k - 1])
        h = longer
        was = np.zeros(size + 1, bool)
        was[at] = old[at] & old[at + 1]
        new = at if before is None else at[~was[at]]
        yield k, new, h[new]


def _summed(h: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Different hashes and their counts."""
    if n is None:
        h = np.sort(h)
        first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.empty(0, np.int64)
        return h[first], np.diff(np.r_[first, len(h)]).astype(np.int64)
    order = np.argsort(h)
    h, n = h[order], n[order]
    first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    return h[first], np.add.reduceat(n, first)


def counted(docs: DataFrame, bits: Bits, before: Bits | None, max_words: int, only: int | None = None) -> DataFrame:
    """(k, h, n): hashes of the phrases to count (see ``places``) and how often they occur, summed
    over all documents. ``only``: just that length."""
    sent = docs.sparkSession.sparkContext.broadcast((bits, before))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, before = sent.value
        held: dict[int, list] = {}
        size = 0

        def passed_on():
            for k, parts in held.items():
                h, n = _summed(*map(np.concatenate, zip(*parts))) if len(parts) > 1 else parts[0]
                for at in range(0, len(h), ROWS_OUT):
                    part = slice(at, at + ROWS_OUT)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h[part]), k, np.int32)), pa.array(h[part].view(np.int64)), pa.array(n[part])], names=["k", "h", "n"])

        for block in _texts(batches):
            for lang, texts in block.items():
                for k, _, h in places(*hashed_words(b".".join(texts)), lang, bits, before, only or max_words):
                    if len(h) and k == (only or k):
                        held.setdefault(k, []).append(_summed(h))
                        size += len(held[k][-1][0])
            if size > HELD_HASHES:
                yield from passed_on()
                held, size = {}, 0
                give_back()
        yield from passed_on()
        give_back()

    rows = docs.mapInArrow(run, "k int, h bigint, n bigint")
    # Dealt out first: tasks have summed their own rows, which hardly meet again before that.
    return rows.repartition("k", "h").groupBy("k", "h").agg(F.sum("n").alias("n"))


def exact_counts(docs: DataFrame, bits: Bits, max_words: int, least: int) -> DataFrame:
    """(lang, phrase, k, f) by their texts, of the words and phrases whose hashes are in
    ``bits`` and that occur ``least`` times; and of all words of a language (null phrase).

    Tasks send their phrases in packs, one for each language, length and range of hashes
    (``RANGE``), not row by row; a range's packs meet in one task, which adds them up."""
    sent = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value
        words, totals, others = Words(), Counter(), Counter()
        held: dict[tuple[str, int], list] = {}
        size = 0

        def packs(rows: list[tuple]):
            for at in range(0, len(rows), ROWS_OUT):
                columns = zip(*rows[at : at + ROWS_OUT])
                kinds = (pa.int32(), pa.string(), pa.int32(), pa.string(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["part", "lang", "k", "phrases", "counts"])

        def named(numbers: np.ndarray) -> list[bytes]:
            names = words.names
            return [b" ".join([names[i] for i in row]) for row in numbers.tolist()]

        def merged(lang: str, k: int, parts: list) -> tuple:
            """One row per hash; phrases that only share their hash are counted by themselves."""
            h, n, numbers = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(h)
            h, n, numbers = h[order], n[order], numbers[order]
            first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            same = (numbers == np.repeat(numbers[first], np.diff(np.r_[first, len(h)]), axis=0)).all(axis=1)
            if not same.all():
                for part, phrase, c in zip((h[~same] >> RANGE).tolist(), named(numbers[~same]), n[~same].tolist()):
                    others[part, lang, k, phrase] += c
            return h[first], np.add.reduceat(np.where(same, n, 0), first), numbers[first]

        def passed_on():
            for (lang, k), parts in held.items():
                h, n, numbers = merged(lang, k, parts)
                part = h >> RANGE  # ascending, as the hashes are
                cuts = np.r_[np.flatnonzero(np.r_[True, part[1:] != part[:-1]]), len(h)].tolist()
                yield from packs([(int(part[i]), lang, k, b"\n".join(named(numbers[i:j])), n[i:j].tolist()) for i, j in zip(cuts, cuts[1:])])
            yield from packs([(part, lang, k, phrase, [c]) for (part, lang, k, phrase), c in others.items()])

        for block in _texts(batches):
            if len(words) > KEPT_WORDS or size > HELD_PHRASES:
                yield from passed_on()
                words, held, size = Words(), {}, 0
                others.clear()
                give_back()
            for lang, texts in block.items():
                numbers, follows = words.numbers(b".".join(texts))
                totals[lang] += len(numbers)
                for k, at, h in places(words.hashes()[numbers], follows, lang, bits, None, max_words):
                    keep = _bit(bits[k - 1], h)
                    at, h = at[keep], h[keep]
                    if len(at):
                        parts = held.setdefault((lang, k), [])
                        parts.append(merged(lang, k, [(h, np.ones(len(h), np.int64), numbers[at[:, None] + np.arange(k)].astype(np.int32))]))
                        size += len(parts[-1][0])
                        if len(parts) == MERGED:
                            parts[:] = [merged(lang, k, parts)]
                            size = sum(len(p[0]) for x in held.values() for p in x)
        yield from passed_on()
        yield from packs([(0, lang, 0, "", [n]) for lang, n in totals.items()])
        give_back()

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int], dict[str, int]] = {}
        for batch in batches:
            lang, k, phrases, counts = (batch.column(c) for c in ("lang", "k", "phrases", "counts"))
            for i in range(batch.num_rows):
                held = sums.setdefault((lang[i].as_py(), k[i].as_py()), {})
                for phrase, n in zip(phrases[i].as_py().split("\n"), counts[i].as_py()):
                    held[phrase] = held.get(phrase, 0) + n
        for (lang, k), held in sums.items():
            rows = [(p, n) for p, n in held.items() if n >= least or not k]
            for at in range(0, len(rows), ROWS_OUT):
                part = rows[at : at + ROWS_OUT]
                columns = [pa.array([lang] * len(part), pa.string()), pa.array([p if k else None for p, _ in part], pa.string()), pa.array([k] * len(part), pa.int32()), pa.array([n for _, n in part], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "k", "f"])
        give_back()

    sent_out = docs.mapInArrow(run, "part int, lang string, k int, phrases string, counts array<bigint>")
    return sent_out.repartition("part").mapInArrow(add_up, "lang string, phrase string, k int, f bigint")


def bits_of(hashes: DataFrame, old: np.ndarray | None = None) -> np.ndarray:
    """The proposals' bits of the hashes ``h``, with the old ones: at most ``2**BITS / 64`` rows reach the driver."""
    at = F.shiftrightunsigned("h", 64 - BITS)
    words = hashes.groupBy(F.shiftright(at, 6).alias("w")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - BITS}) & 63 as int))")).alias("v")).toArrow()
    out = np.zeros(1 << (BITS - 6), np.uint64) if old is None else old.copy()
    out[words.column("w").to_numpy()] |= words.column("v").to_numpy().view(np.uint64)
    return out


def proposals(docs: DataFrame, least: int, max_words: int, sample: int) -> Bits:
    """Bits of the phrases of one word, two, ... (but the longest) that the sample proposes."""
    drawn = stored(docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(sample)) == 0).select("lang", "text"), "collocation_sample")
    low = max(2, least * 4 // (5 * sample))
    bits: Bits = []
    for k in range(1, max_words):
        bits.append(bits_of(counted(drawn, bits, None, max_words, only=k).filter(F.col("n") >= low)))
    return bits


def not_proposed(frequent: DataFrame, bits: Bits) -> DataFrame:
    """The frequent hashes of the border."""
    sent = frequent.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k, h = batch.column("k").to_numpy(), batch.column("h").to_numpy().view(np.uint64)
            there = np.zeros(len(k), bool)
            for length, b in enumerate(sent.value, 1):
                there[k == length] = _bit(b, h[k == length])
            yield batch.filter(pa.array(~there & (k <= len(sent.value))))

    return frequent.mapInArrow(run, frequent.schema)


def frequent(docs: DataFrame, least: int = 30, max_words: int = 4, sample: int = SAMPLE) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, k, f) of every phrase of up to ``max_words`` words with f >= ``least``,
    (lang, n) of all words), exact."""
    docs = docs.select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    bits, before = proposals(docs, least, max_words, sample), None
    docs = docs.select("lang", "text")
    known: Bits = [None] * max_words
    while True:
        found = stored(counted(docs, bits, before, max_words).filter(F.col("n") >= least), "collocation_hashes")
        known = [bits_of(found.filter(F.col("k") == k), b) for k, b in enumerate(known, 1)]
        failed = stored(not_proposed(found, bits), "collocation_border")
        lengths = {r["k"] for r in failed.groupBy("k").count().collect()}
        if not lengths:
            break
        before, bits = bits, [bits_of(failed.filter(F.col("k") == k), b) if k in lengths else b for k, b in enumerate(bits, 1)]
    counts = stored(exact_counts(docs, known, max_words, least), "collocation_counts")
    return counts.filter("phrase is not null"), counts.filter("phrase is null").select("lang", F.col("f").alias("n"))


def _part(begin: int, size: int) -> Column:
    """The words of a phrase from the given one on."""
    return F.array_join(F.slice("words", begin, size), " ")


def collocations(docs: DataFrame, least: int = 30, max_words: int = 4, top: int = 2000, covered: int = 80, sample: int = SAMPLE) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first phrases by their weakest cut."""
    found, totals = frequent(docs, least, max_words, sample)
    exact = "decimal(20,0)"
    phrases = found.filter("k >= 2").select("lang", "phrase", "k", F.col("f").alias("a"))
    cuts = phrases.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.withColumns({"first": F.expr("substring_index(phrase, ' ', cut)"), "rest": F.expr("substring_index(phrase, ' ', cut - k)")})
    counts = found.select("lang", "phrase", "f")
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    cuts = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    score = F.expr(f"cast(2000000 as decimal(7,0)) * cast(a as {exact}) div (cast(l as {exact}) + cast(r as {exact}))")
    scored = cuts.groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("m")).select("lang", "phrase", "a", "m.score", "m.l", "m.r")
    longer = phrases.filter("k >= 3").withColumn("words", F.split("phrase", " ", -1))
    inner = [F.when((F.col("k") > size) & (F.col("k") >= begin + size - 1), _part(begin, size)) for size in range(2, max_words) for begin in range(1, max_words - size + 2)]
    inside = longer.select("lang", "a", F.explode(F.array(*inner, F.lit(None).cast("string"))).alias("phrase")).filter("phrase is not null")
    inside = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(inside, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (F.col("longer").cast(exact) * 100 < F.col("a").cast(exact) * covered)).drop("longer")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # first within parts of a language, so that the last task of each has a bounded number of rows
    part = F.pmod(F.xxhash64("phrase"), F.lit(16))
    kept = kept.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = """
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), p AS (
  SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d
), w AS (
  SELECT lang, [x FOR x IN regexp_split_to_array(piece, '[\\x20\\x09]+') IF x <> ''] AS ws FROM p
), g AS (
  SELECT lang, k, unnest([array_to_string(ws[i : i + k - 1], ' ') FOR i IN range(1, CAST(len(ws) AS BIGINT) - k + 2)]) AS phrase
  FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(ws) >= k
), f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2 AND f >= 30),
cut AS (
  SELECT lang, k, phrase, a, ws, unnest(range(1, CAST(k AS BIGINT))) AS j FROM c
), s AS (
  SELECT cut.lang, cut.phrase, cut.k, cut.a, cut.j, l.f AS l, r.f AS r, CAST(2000000::HUGEINT * cut.a // (l.f + r.f) AS BIGINT) AS score
  FROM cut JOIN f l ON l.lang = cut.lang AND l.phrase = array_to_string(cut.ws[1 : j], ' ')
  JOIN f r ON r.lang = cut.lang AND r.phrase = array_to_string(ws[j + 1 : cut.k], ' ')
), m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS o FROM s) WHERE o = 1),
i AS (
  SELECT lang, array_to_string(ws[b : b + z - 1], ' ') AS phrase, max(a) AS longer
  FROM c, (SELECT unnest([2, 3]) AS z), (SELECT unnest([1, 2, 3]) AS b) WHERE k > z AND b + z - 1 <= k GROUP BY ALL
), r AS (
  SELECT m.*, row_number() OVER (PARTITION BY m.lang ORDER BY score DESC, a DESC, m.phrase) AS rank
  FROM m LEFT JOIN i ON i.lang = m.lang AND i.phrase = m.phrase WHERE i.longer IS NULL OR 100 * i.longer < 80 * m.a
)
SELECT r.lang, rank, r.phrase, a, l, r, n.n, score FROM r JOIN n ON n.lang = r.lang WHERE rank <= 2000
"""
