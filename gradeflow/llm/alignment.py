"""Cross-tokenizer alignment: which tokens of one tokenizer cover which of another.

Both tokenizers encode the same text (a space, then the text).  Byte offsets at which
tokens of both end cut the tokens into groups; two tokens are linked where their byte
ranges overlap.  An id pair's count is the number of its links in all documents.

Fast path: an array of the vocabulary's length maps each id of the first tokenizer (A) to
the id of the second (B) with the same bytes.  A group of just such a pair is counted in
a vector of that length, one vector a task; its pair never enters a shuffle of pairs.
Other groups are irregular: their distinct forms are counted, and only these forms are
resolved into id pairs, which are shuffled and counted.  Each document then sums the
counts of its links: regular ones from the vector, irregular ones by their form.  Forms
that hold more than one in ``HOT_FORMS`` of the rows to be joined (so fewer than
``HOT_FORMS``) are broadcast; the others are joined by a shuffle.  A common form is
thus never one task's work.

Where no token of either can cross (before a space that follows a non-space) texts are
cut into chunks, and a task encodes each distinct chunk once and keeps it in a bounded table.

Cases: a null or empty text, and one whose tokens' bytes of either tokenizer are not a
space and the text (such as one with U+2581), have no tokens: zeros and an empty digest.
Texts are taken whole, whatever their length.  Repeated rows and ids count as often as
they occur, each with a row of its own; a null id stays null.  Strings of special tokens
are plain text.  An empty table gives an empty result.  Columns other than ``doc_id`` and
``text`` are not read, whatever their names.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
from collections.abc import Iterator, Sequence
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, stored
from .sentencepieces import SPACE, _groups, _model, _slim

#: Chunks that a task keeps, in two generations of half each.
KEPT_CHUNKS = 120_000
#: Chunks that B encodes together.
JOINED = 200
#: Characters of the texts that are handled at a time, about.
GROUP = 1 << 18
#: Chunks longer than this are encoded but not kept.
KEPT_LENGTH = 64
#: At most so many irregular forms are broadcast (about 40 bytes each).
HOT_FORMS = 50_000
#: A chunk ends before a space that follows a non-space.
CHUNK = re.compile(r"\s*\S+(?:[^\S ]\s*\S*)*|\s+")
COUNTS = "uid bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for
    themselves, the others for the letters from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


#: The pattern by which byte-level vocabularies part a text before merging (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters whose classes no two versions of Unicode tables tell apart.
PLAIN = re.compile("[\t\n\r -~\u00c0-\u024f]*[!-~\u00c0-\u024f]")

#: A chunk's alignment: number of A ids and of B ids, its groups as text, A ids of regular
#: groups, irregular groups (number of A ids, A ids, B ids); None where the tokens' bytes
#: are not the chunk's.
Chunk = tuple[int, int, str, tuple[int, ...], tuple[bytes, ...]] | None


class Vocabularies:
    """Both tokenizers, the bytes of their ids, and the map between ids of the same bytes."""

    def __init__(self, a_json: bytes, b_model: bytes):
        self.a_json, self._a = a_json, None
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        letter = byte_letters()
        described = json.loads(a_json)
        a_ids = described["model"]["vocab"]
        self.size_a, self.size_b = max(a_ids.values()) + 1, self.b.get_piece_size()
        wrong = b"\xff"  # no text holds this byte: such an id never matches
        self.a_bytes = [wrong] * self.size_a
        for piece, i in a_ids.items():
            self.a_bytes[i] = bytes(letter[c] for c in piece) if all(c in letter for c in piece) else wrong
        self.b_bytes = [wrong] * self.size_b
        of_bytes: dict[bytes, int] = {}
        for i in range(self.size_b):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.b_bytes[i] = bytes([int(piece[3:5], 16)])
            elif not (self.b.is_unknown(i) or self.b.is_control(i) or self.b.is_unused(i)):
                self.b_bytes[i] = piece.replace(SPACE, " ").encode("utf-8")
            # an ordinary piece goes before a byte of the same content
            if not self.b.is_byte(i) or self.b_bytes[i] not in of_bytes:
                of_bytes[self.b_bytes[i]] = i
        of_bytes.pop(wrong, None)
        self.same = np.array([of_bytes.get(x, -1) for x in self.a_bytes], np.int64)
        self.a_len = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int64)
        pieces = [self.b.id_to_piece(i).replace(SPACE, " ") for i in range(self.size_b)]
        self.cut = not any(re.search(r"\S \S*|\n", p) for p in pieces if len(p) > 1 and not re.fullmatch(r"<0x..>", p))
        self.probe = len(self.b.encode("\n"))
        self.ranks = self._ranks(described)
        self.width = np.dtype("<u2") if max(self.size_a, self.size_b) < 1 << 16 else np.dtype("<u4")

    @property
    def a(self):
        """The tokenizer library's own A: loaded only where ``ranks`` do not serve."""
        if self._a is None:
            from tokenizers import Tokenizer

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            self._a = Tokenizer.from_str(self.a_json.decode("utf-8"))
            self._a.encode_special_tokens = True
        return self._a

    def chunks(self, text: str | None) -> list[str]:
        """The chunks of a space and the text; none of an empty text."""
        if not text:
            return []
        return CHUNK.findall(" " + text) if self.cut else [" " + text]

    def _ranks(self, described: dict) -> tiktoken.Encoding | None:
        """The same tokenizer by ranks, which is several times as fast; None where the file's
        merges are not in the order of their ids or it parts texts otherwise."""
        parts, vocab = described["pre_tokenizer"] or {}, described["model"]["vocab"]
        made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in described["model"]["merges"]]
        if parts.get("type") != "ByteLevel" or parts.get("add_prefix_space") or not parts.get("use_regex") or described["normalizer"] or described["post_processor"] or made != sorted(made):
            return None
        return tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks={x: i for i, x in enumerate(self.a_bytes) if x != b"\xff"}, special_tokens={})

    def ids(self, chunks: Sequence[str], n_plain: int) -> tuple[list[int], np.ndarray, list[int], np.ndarray]:
        """The A ids of all the chunks and how many are of each chunk, and the same of B.

        The first ``n_plain`` chunks end with a non-space and are plain, so they are encoded
        together: no token of either crosses from one to the next."""
        joined, other = chunks[:n_plain], chunks[n_plain:]
        ends = np.cumsum([0, *(len(c.encode("utf-8")) for c in joined)])
        a = self.ranks.encode_ordinary("".join(joined)) if joined else []
        b = []
        for at in range(0, n_plain, JOINED):
            b += self.b.encode("\n" + "".join(joined[at : at + JOINED]))[self.probe :]
        n_a, n_b = (np.diff(np.searchsorted(np.cumsum(size[ids]), ends, side="right")) for size, ids in ((self.a_len, a), (self.b_len, b)))
        if not other:
            return a, n_a, b, n_b
        a_each = [e.ids for e in self.a.encode_batch_fast(list(other), add_special_tokens=False)]
        if self.cut:  # after a line feed of its own, so that the chunk's own space is the only one
            b_each = [x[self.probe :] for x in self.b.encode(["\n" + c for c in other], num_threads=1)]
        else:
            b_each = self.b.encode([c[1:] for c in other], num_threads=1)
        sizes = [np.r_[n, [len(x) for x in each]].astype(np.int64) for n, each in ((n_a, a_each), (n_b, b_each))]
        return a + list(chain.from_iterable(a_each)), sizes[0], b + list(chain.from_iterable(b_each)), sizes[1]

    def align(self, chunks: Sequence[str]) -> dict[str, Chunk]:
        """The alignments of all the chunks, worked out together."""
        plain = [c for c in chunks if PLAIN.fullmatch(c)] if self.ranks and self.cut else []
        chunks = plain if len(plain) == len(chunks) else [*plain, *set(chunks).difference(plain)]
        if not chunks:
            return {}
        a, n_a, b, n_b = self.ids(chunks, len(plain))
        flat_a, flat_b = np.array(a, np.int64), np.array(b, np.int64)
        ends_a, ends_b = np.cumsum(self.a_len[flat_a]), np.cumsum(self.b_len[flat_b])
        raw = [c.encode("utf-8") for c in chunks]
        ends = np.cumsum([len(x) for x in raw])
        a_of, b_of, until_a, until_b = self.a_bytes.__getitem__, self.b_bytes.__getitem__, np.cumsum(n_a), np.cumsum(n_b)
        whole = b"".join(raw)
        whole = whole == b"".join(map(a_of, a)) == b"".join(map(b_of, b))
        if not (whole and (ends_a[until_a - 1] == ends).all() and (ends_b[until_b - 1] == ends).all()):
            # some chunk is not what its tokens spell: it is left out
            at = zip(chunks, raw, np.split(flat_a, until_a[:-1]), np.split(flat_b, until_b[:-1]))
            good = [c for c, x, i, j in at if x == b"".join(map(a_of, i.tolist())) == b"".join(map(b_of, j.tolist()))]
            if len(good) == len(chunks):
                raise AssertionError("chunks of the same bytes that do not add up")
            return dict.fromkeys(chunks) | self.align(good)
        last_a, last_b = ends_b[np.searchsorted(ends_b, ends_a)] == ends_a, ends_a[np.searchsorted(ends_a, ends_b)] == ends_b
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        size_a, size_b = np.bincount(group_a), np.bincount(group_b)
        # all ids in the order of the groups, those of A before those of B
        at_a = np.arange(len(flat_a)) + (np.cumsum(size_b) - size_b)[group_a]
        at_b = np.arange(len(flat_b)) + np.cumsum(size_a)[group_b]
        ids, words = (np.empty(len(flat_a) + len(flat_b), t) for t in (np.int64, object))
        ids[at_a], ids[at_b] = flat_a, flat_b
        words[at_a], words[at_b] = self._words(last_a, flat_a, "|"), self._words(last_b, flat_b, ";")
        words = words.tolist()
        begin = np.r_[0, np.cumsum(size_a + size_b)]
        first_a, first_b = flat_a[np.cumsum(size_a) - size_a], flat_b[np.cumsum(size_b) - size_b]
        regular = (size_a == 1) & (size_b == 1) & (self.same[first_a] == first_b)
        packed, w = ids.astype(self.width).tobytes(), self.width.itemsize
        if size_a.max() >= 1 << (8 * w):
            raise ValueError("a group of more tokens than can be numbered")
        heads = [n.to_bytes(w, "little") for n in range(int(size_a.max()) + 1)]
        odd = np.flatnonzero(~regular)
        forms = [heads[n] + packed[i:j] for n, i, j in zip(size_a[odd].tolist(), (w * begin[odd]).tolist(), (w * begin[odd + 1]).tolist())]
        one = first_a[regular].tolist()
        # where each chunk's words, regular groups and forms begin
        groups_at = np.r_[0, np.cumsum(last_a)[until_a - 1]]
        words_at = np.r_[0, np.cumsum(n_a + n_b)].tolist()
        one_at, forms_at = (np.r_[0, np.cumsum(x)][groups_at].tolist() for x in (regular, ~regular))
        return {
            c: (x, y, "".join(words[i:j])[:-1], tuple(one[k:m]), tuple(forms[p:q]))
            for c, x, y, i, j, k, m, p, q in zip(chunks, n_a.tolist(), n_b.tolist(), words_at, words_at[1:], one_at, one_at[1:], forms_at, forms_at[1:])
        }

    def _words(self, last: np.ndarray, ids: np.ndarray, end: str) -> np.ndarray:
        """Each id as text, with what follows it."""
        if not hasattr(self, "_text"):
            n = max(self.size_a, self.size_b)
            self._text = {e: np.array([f"{i}{e}" for i in range(n)], object) for e in ",|;"}
        return np.where(last, self._text[end][ids], self._text[","][ids])


def links_of(forms: Sequence[bytes], width: np.dtype, a_len: np.ndarray, b_len: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the form, A id, B id) of every link in the forms."""
    w = width.itemsize
    size = np.array([len(f) // w for f in forms], np.int64)
    values = np.frombuffer(b"".join(forms), width).astype(np.int64)
    begins = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(forms)), size)
    place = np.arange(len(values)) - begins[owner]
    n_a = values[begins][owner]
    in_a, in_b = (place >= 1) & (place <= n_a), place > n_a
    a, b = values[in_a], values[in_b]
    ends_a, ends_b = np.cumsum(a_len[a]), np.cumsum(b_len[b])
    # each stretch between two ends of either side lies in one token of each
    ends = np.union1d(ends_a, ends_b)
    at = np.searchsorted(ends_a, ends)
    return owner[in_a][at], a[at], b[np.searchsorted(ends_b, ends)]


class Table:
    """The alignments of the chunks seen lately, in two generations: a full young one becomes
    the old one, and a chunk met again in the old one is young again."""

    def __init__(self, vocabularies: Vocabularies):
        self.vocabularies = vocabularies
        self.young: dict[str, Chunk] = {}
        self.old: dict[str, Chunk] = {}

    def learn(self, chunks: set[str]) -> tuple[dict[str, Chunk], list[str]]:
        missing = chunks.difference(self.young)
        again = missing.intersection(self.old)
        self.young.update(zip(again, map(self.old.__getitem__, again)))
        new = list(missing.difference(again))
        self.young.update(self.vocabularies.align(new))
        return self.young, [c for c in new if len(c) > KEPT_LENGTH]

    def forget(self, long: list[str]) -> None:
        for c in long:
            del self.young[c]
        if len(self.young) >= KEPT_CHUNKS // 2:
            self.old, self.young = self.young, {}


def _packed(values: np.ndarray, sizes: Sequence[int]) -> pa.BinaryArray:
    """Parts of an int32 array, each as its bytes."""
    offsets = np.r_[0, np.cumsum(sizes)].astype(np.int32) * 4
    return pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values, "<i4"))])


def _lists(values: pa.Array, sizes: Sequence[int]) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), values)


class _Numbers(dict):
    """Numbers in the order of first asking."""

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


def _ragged(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places begin, begin + 1, ... of all parts, one part after the other."""
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _aligned(v: Vocabularies, table: Table, texts: Sequence[str | None]) -> tuple[list[pa.Array], np.ndarray, np.ndarray]:
    """What ``encoded`` returns of some texts, and their regular ids with their times."""
    cut = [v.chunks(t) for t in texts]
    size = np.array([len(c) for c in cut], np.int64)
    known = _Numbers()
    at = np.fromiter(map(known.__getitem__, chain.from_iterable(cut)), np.int64, size.sum())
    got, long = table.learn(set(known))
    found = [got[c] or (0, 0, "", (), ()) for c in known]
    ok = np.array([got[c] is not None for c in known], bool)
    table.forget(long)
    n = len(texts)
    doc = np.repeat(np.arange(n), size)
    good = (np.bincount(doc[~ok[at]], minlength=n) == 0) & (size > 0)
    keep = good[doc]
    at, doc, size = at[keep], doc[keep], np.where(good, size, 0)
    n_a, n_b = (np.bincount(doc, weights=np.array([f[k] for f in found], np.int64)[at], minlength=n).astype(np.int64) for k in (0, 1))
    groups, ends, places = [f[2] for f in found], np.cumsum(size).tolist(), at.tolist()
    joined = [";".join([groups[k] for k in places[j - m : j]]) for j, m in zip(ends, size.tolist())]
    n_groups = np.array([x.count("|") for x in joined], np.int64)
    digest = pa.array([hashlib.sha256(x.encode()).hexdigest() if x else "" for x in joined])
    # each chunk of a text once, with its times
    pairs, times = np.unique(doc * len(known) + at, return_counts=True)
    doc, at = np.divmod(pairs, max(1, len(known)))
    count = np.array([len(f[3]) for f in found], np.int64)
    flat = np.fromiter(chain.from_iterable(f[3] for f in found), np.int32)
    ids = flat[_ragged((np.cumsum(count) - count)[at], count[at])]
    id_times = np.repeat(times, count[at]).astype(np.int32)
    n_ids = np.bincount(doc, weights=count[at], minlength=n).astype(np.int64)
    count = np.array([len(f[4]) for f in found], np.int64)
    number = {f: k for k, f in enumerate(dict.fromkeys(chain.from_iterable(f[4] for f in found)))}
    flat = np.fromiter(map(number.__getitem__, chain.from_iterable(f[4] for f in found)), np.int64)
    form = np.repeat(doc, count[at]) * max(1, len(number)) + flat[_ragged((np.cumsum(count) - count)[at], count[at])]
    pairs, inverse = np.unique(form, return_inverse=True)
    form_times = np.bincount(inverse, weights=np.repeat(times, count[at])).astype(np.int32)
    doc, form = np.divmod(pairs, max(1, len(number)))
    n_forms = np.bincount(doc, minlength=n)
    lists = [_packed(ids, n_ids), _packed(id_times, n_ids), _lists(pa.array(list(number), pa.binary()).take(pa.array(form)), n_forms), _lists(pa.array(form_times, pa.int32()), n_forms)]
    return [*(pa.array(c) for c in (n_a, n_b, n_groups, n_a + n_b - n_groups)), digest, *lists], ids, id_times


def encoded(docs: DataFrame, a_json: str, b_model: str) -> DataFrame:
    """One row per document: its counts and digest, its regular A ids with how often each
    occurs (packed: ``ids`` of 4 bytes, ``times`` of 4), its irregular forms with how often;
    and one row per task (null uid) with the task's vector of regular groups.  ``uid``
    numbers the rows."""
    sc = docs.sparkSession
    files = _model(sc, a_json), _model(sc, b_model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabularies(*(f.value for f in files))
        gc.disable()  # millions of small tuples and no cycles among them
        table, vector, uid = Table(v), np.zeros(v.size_a, np.int64), TaskContext.get().partitionId() << 33
        for batch in batches:
            at = 0
            for texts in _groups(batch.column("text"), GROUP):
                columns, ids, times = _aligned(v, table, texts)
                vector += np.bincount(ids, weights=times, minlength=v.size_a).astype(np.int64)
                first = [pa.array(np.arange(uid, uid + len(texts))), batch.column("doc_id").slice(at, len(texts))]
                yield pa.RecordBatch.from_arrays([*first, *columns, pa.nulls(len(texts), pa.list_(pa.int64()))], names=NAMES)
                at += len(texts)
                uid += len(texts)
            give_back()
        del table, v
        gc.enable()
        give_back()
        if vector.any():
            types = [f.type for f in columns_of(1)]
            yield pa.RecordBatch.from_arrays([*(pa.nulls(1, t) for t in types[:-1]), pa.array([vector.tolist()], types[-1])], names=NAMES)

    return _slim(docs).mapInArrow(run, f"{COUNTS}, ids binary, times binary, forms array<binary>, form_times array<int>, vector array<bigint>")


NAMES = ["uid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "ids", "times", "forms", "form_times", "vector"]


def columns_of(n: int) -> list[pa.Array]:
    """So many null rows of what ``encoded`` returns."""
    kinds = [pa.int64()] * 6 + [pa.string(), pa.binary(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int32()), pa.list_(pa.int64())]
    return [pa.nulls(n, k) for k in kinds]


class Aligned(NamedTuple):
    docs: DataFrame  # what ``encoded`` returns, written
    pairs: DataFrame  # (a, b, n, best): each linked id pair, its count, whether no pair of b has more
    forms: DataFrame  # (form, n_rows, best, total): the sums over the links of each irregular form
    vector: DataFrame  # (a, b, n): regular pairs


def align(docs: DataFrame, a_json: str, b_model: str) -> Aligned:
    """The id pairs of all documents and their counts."""
    spark = docs.sparkSession
    files = _model(spark, a_json), _model(spark, b_model)
    rows = stored(encoded(docs, a_json, b_model), "alignment_docs", **{"parquet.block.size": str(16 << 20)})
    # at most a row per id of A, already summed by task
    vector = rows.filter("vector is not null").select(F.posexplode("vector").alias("a", "n")).filter("n > 0").groupBy("a").agg(F.sum("n").alias("n"))
    v = Vocabularies(*(f.value for f in files))
    lengths = v.width, v.a_len, v.b_len
    same = spark.createDataFrame([(a, b) for a, b in enumerate(v.same.tolist()) if b >= 0], "a int, b int")
    del v
    vector = stored(vector.join(F.broadcast(same), "a").select("a", "b", "n"), "alignment_vector")
    met = rows.select(F.explode(F.arrays_zip("forms", "form_times")).alias("f"))
    forms = met.groupBy(F.col("f.forms").alias("form")).agg(F.sum("f.form_times").alias("n"), F.count(F.lit(1)).alias("n_rows"))
    forms = stored(forms.withColumn("gid", F.monotonically_increasing_id()), "alignment_forms")

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at, a, b = links_of(batch.column("form").to_pylist(), *lengths)
                yield pa.RecordBatch.from_arrays([batch.column("gid").take(pa.array(at)), pa.array(a << 32 | b), batch.column("n").take(pa.array(at))], names=["gid", "pair", "n"])

    links = stored(forms.select("gid", "form", "n").mapInArrow(resolve, "gid bigint, pair bigint, n bigint"), "alignment_links")
    regular = vector.select((F.col("a").cast("bigint") * (1 << 32) + F.col("b")).alias("pair"), "n")
    pairs = links.select("pair", "n").unionByName(regular).groupBy("pair").agg(F.sum("n").alias("n"))
    pairs = stored(pairs.withColumn("b", F.col("pair").bitwiseAND((1 << 32) - 1).cast("int")), "alignment_counts")
    # at most a row per id of B
    most = F.broadcast(pairs.groupBy("b").agg(F.max("n").alias("most")))
    pairs = stored(pairs.join(most, "b").select("pair", F.shiftright("pair", 32).cast("int").alias("a"), "b", "n", (F.col("n") == F.col("most")).alias("best")), "alignment_pairs")
    sums = links.select("gid", "pair").join(pairs.select("pair", F.col("n").alias("count"), "best"), "pair")
    sums = sums.groupBy("gid").agg(F.sum(F.col("best").cast("bigint")).alias("best"), F.sum("count").alias("total"))
    summed = stored(forms.select("gid", "form", "n_rows").join(sums, "gid").select("form", "n_rows", "best", "total"), "alignment_sums")
    return Aligned(rows, pairs.select("a", "b", "n", "best"), summed, vector)


def digests(docs: DataFrame, a_json: str, b_model: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document."""
    spark = docs.sparkSession
    found = align(docs, a_json, b_model)
    # the counts of regular pairs: two arrays of the vocabulary's length
    regular = found.pairs.join(F.broadcast(found.vector.select("a", "b")), ["a", "b"]).collect()
    size = 1 + max((r["a"] for r in regular), default=0)
    count, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for r in regular:
        count[r["a"]], best[r["a"]] = r["n"], r["best"]
    arrays = spark.sparkContext.broadcast((count, best))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, best = arrays.value
        for batch in batches:
            at, n = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<i4").astype(np.int64) for c in ("ids", "times"))
            ends = np.cumsum([len(x) // 4 for x in batch.column("ids").to_pylist()], dtype=np.int64)
            out = [np.r_[0, np.cumsum(n * values[at])] for values in (best, count)]
            out = [pa.array(np.diff(np.r_[0, x[ends]])) for x in out]
            yield pa.RecordBatch.from_arrays([*batch.columns[:7], *out], names=[*NAMES[:7], "n_best", "count_sum"])

    base = found.docs.filter("uid is not null").select(*NAMES[:9]).mapInArrow(sums, f"{COUNTS}, n_best bigint, count_sum bigint")
    met = found.docs.select("uid", F.explode(F.arrays_zip("forms", "form_times")).alias("f")).select("uid", F.col("f.forms").alias("form"), F.col("f.form_times").alias("times"))
    n_rows = found.forms.agg(F.sum("n_rows")).first()[0] or 0
    # fewer than HOT_FORMS by their definition: each holds more than its part of all rows
    hot = F.broadcast(found.forms.filter(F.col("n_rows") * HOT_FORMS > n_rows).select("form", "best", "total"))
    cold = found.forms.filter(F.col("n_rows") * HOT_FORMS <= n_rows).select("form", "best", "total")
    by_hot = met.join(hot, "form").groupBy("uid").agg(F.sum(F.col("times") * F.col("best")).alias("n_best"), F.sum(F.col("times") * F.col("total")).alias("count_sum"))
    by_cold = met.join(hot.select("form"), "form", "left_anti").join(cold, "form").select("uid", (F.col("times") * F.col("best")).alias("n_best"), (F.col("times") * F.col("total")).alias("count_sum"))
    every = base.unionByName(by_hot, allowMissingColumns=True).unionByName(by_cold, allowMissingColumns=True)
    keep = [F.max(c).alias(c) for c in NAMES[1:6]]
    out = every.groupBy("uid").agg(*keep, F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"), F.max("groups_sha256").alias("groups_sha256"))
    return out.drop("uid")
