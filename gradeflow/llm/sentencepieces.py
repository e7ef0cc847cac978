"""SentencePiece encoding and decoding of merge-type vocabularies.

A text is a row of symbols (characters); an agenda of adjacent symbol pairs, in
the order of the score of the piece they make and then of place, says which pair
is merged next, until no pair makes a piece.  A symbol without a piece becomes
the pieces of its UTF-8 bytes.  Decoding joins the pieces and bytes again.

Spaces become U+2581, and one is put before a non-empty text.  Where no piece of
the vocabulary holds a boundary inside (after a non-space and before a space, and
around a line feed) no merge can cross it, so a text is cut there and every
distinct chunk of an Arrow batch is encoded once; a bounded table keeps chunks
between batches.  With ``check`` each newly encoded chunk is compared with the
sentencepiece library before it is used, and a difference ends the task.

The vocabulary file is a parameter; its content (a fixed size, under ``MAX_MODEL``
bytes) goes to the tasks with a broadcast, so executors need no file.

Cases: a null text is an empty one, which has only the end id; texts are encoded
whole, whatever their length; repeated rows are encoded alike; columns other than
``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back

MAX_MODEL = 16 << 20
SPACE = "▁"
#: Chunks that a task keeps, in two generations of half each.
KEPT_CHUNKS = 240_000
#: Chunks whose agendas advance together.
STEP = 8000
#: Chunks longer than this are encoded but not kept.
KEPT_LENGTH = 64


class Pieces:
    """A vocabulary: scores, ids and bytes of its pieces."""

    def __init__(self, proto: bytes):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=proto)
        size = self.library.get_piece_size()
        self.names = [self.library.id_to_piece(i) for i in range(size)]
        self.digits = list(map(str, range(size)))
        lib = self.library
        plain = [i for i in range(size) if not (lib.is_unknown(i) or lib.is_control(i) or lib.is_byte(i) or lib.is_unused(i))]
        self.ids = {self.names[i]: i for i in plain}
        self.scores = {self.names[i]: lib.get_score(i) for i in plain}
        self.byte_ids = {int(self.names[i][3:5], 16): i for i in range(size) if lib.is_byte(i)}
        self.bytes = {i: b for b, i in self.byte_ids.items()}
        self.silent = {i for i in range(size) if lib.is_control(i)}
        self.unknown = lib.unk_id()
        self.end = lib.eos_id()
        cut = not any(re.search(f"[^{SPACE}]{SPACE}|\n", p) for p in self.ids)
        self.chunk = re.compile(f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+" if cut else r"(?s).+")
        self._made = None
        self.probe = [*lib.encode("\n")] if cut else []

    def merged(self, chunk: str) -> list[str]:
        """The symbols left when the agenda of adjacent pairs is empty."""
        if chunk in self.ids and len(chunk) < 2:
            return [chunk]
        scores = self.scores
        symbols = list(chunk)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            pair = symbols[i] + symbols[i + 1]
            if pair in scores:
                agenda.append((-scores[pair], i, pair))
        heapq.heapify(agenda)
        while agenda:
            _, i, pair = heapq.heappop(agenda)
            left = symbols[i]
            if not left:
                continue
            j = after[i]
            # an entry is out of date once one of its symbols has grown or gone
            if j >= n or left + symbols[j] != pair or len(left) >= len(pair):
                continue
            symbols[i], symbols[j] = pair, ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                new = pair + symbols[k]
                if new in scores:
                    heapq.heappush(agenda, (-scores[new], i, new))
            h = before[i]
            if h >= 0:
                new = symbols[h] + pair
                if new in scores:
                    heapq.heappush(agenda, (-scores[new], h, new))
        return [s for s in symbols if s]

    def pieces_ids(self, symbols: Sequence[str]) -> list[int]:
        """Ids of the last symbols; one without a piece gives the ids of its bytes."""
        out = []
        for s in symbols:
            i = self.ids.get(s)
            if i is not None:
                out.append(i)
            elif self.byte_ids:
                out += [self.byte_ids[b] for b in s.encode("utf-8")]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out

    def chunk_ids(self, chunk: str) -> list[int]:
        return self.pieces_ids(self.merged(chunk))

    def _pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys (left id, right id) of all pairs that make a piece, sorted; the piece; and
        the place of each piece in the order of scores (equal scores share a place)."""
        if self._made is None:
            found = sorted((self.ids[p[:k]] << 32 | self.ids[p[k:]], i) for p, i in self.ids.items() for k in range(1, len(p)) if p[:k] in self.ids and p[k:] in self.ids)
            ids = np.array([self.ids[p] for p in self.scores], np.int64)
            score = np.array([self.scores[p] for p in self.scores])
            order = np.full(len(self.names), 0, np.int64)
            order[ids] = np.unique(-score, return_inverse=True)[1]
            self._made = np.array([k for k, _ in found], np.int64), np.array([i for _, i in found], np.int64), order
        return self._made

    def many(self, chunks: Sequence[str]) -> list[list[int]]:
        """The ids of many short chunks: their agendas advance together, one merge of
        each chunk a step, in numpy."""
        keys, makes, order = self._pairs()
        far = np.int64(1) << 62
        chars = {c: self.ids.get(c, -1 - n) for n, c in enumerate(dict.fromkeys("".join(chunks)))}
        symbols = np.array([chars[c] for c in "".join(chunks)], np.int64)
        owner = np.repeat(np.arange(len(chunks)), [len(c) for c in chunks])
        done: list[tuple[np.ndarray, np.ndarray]] = []

        def look(left, right):
            """What each pair makes, -1 if nothing."""
            key = left << 32 | right
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            return np.where((keys[at] == key) & (left >= 0) & (right >= 0), makes[at], -1)

        made = np.full(len(symbols), -1, np.int64)
        same = np.flatnonzero(owner[1:] == owner[:-1])
        made[same] = look(symbols[same], symbols[same + 1])
        while len(symbols):
            # the agenda: the best pair of each chunk by score, then by place
            place = np.arange(len(symbols), dtype=np.int64)
            rank = np.where(made >= 0, order[made] << 40 | place, far)
            begins = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            best = np.minimum.reduceat(rank, begins)
            lengths = np.diff(np.r_[begins, len(symbols)])
            open_chunk = np.repeat(best < far, lengths)
            if not open_chunk.all():
                done.append((owner[~open_chunk], symbols[~open_chunk]))
            at = best[best < far] & ((np.int64(1) << 40) - 1)
            symbols[at] = made[at]
            keep = open_chunk
            keep[at + 1] = False
            moved = np.cumsum(keep) - 1
            at = moved[at]
            symbols, owner, made = symbols[keep], owner[keep], made[keep]
            made[at] = -1
            right = at[(at + 1 < len(symbols))]
            right = right[owner[right] == owner[right + 1]]
            made[right] = look(symbols[right], symbols[right + 1])
            left = at[at > 0] - 1
            left = left[owner[left] == owner[left + 1]]
            made[left] = look(symbols[left], symbols[left + 1])
        own = np.concatenate([o for o, _ in done]) if done else np.empty(0, np.int64)
        ids = np.concatenate([x for _, x in done]) if done else own
        by_chunk = np.argsort(own, kind="stable")
        ids, own = ids[by_chunk], own[by_chunk]
        cuts = np.r_[0, np.cumsum(np.bincount(own, minlength=len(chunks)))].tolist()
        flat = ids.tolist()
        out = [flat[i:j] for i, j in zip(cuts, cuts[1:])]
        back = {i: c for c, i in chars.items() if i < 0}
        for k in np.unique(own[ids < 0]).tolist():
            out[k] = self.pieces_ids([back[i] if i < 0 else self.names[i] for i in out[k]])
        return out

    def chunks(self, text: str | None) -> list[str]:
        return self.chunk.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def encode(self, text: str | None) -> list[int]:
        """The ids of a whole text, the end id last."""
        return [i for c in self.chunks(text) for i in self.chunk_ids(c)] + [self.end]

    def _joined(self, ids: Sequence[int]) -> str:
        out, raw = [], bytearray()
        for i in ids:
            if i in self.bytes:
                raw.append(self.bytes[i])
                continue
            if raw:
                out.append(_utf8(bytes(raw)))
                raw.clear()
            if i not in self.silent:
                out.append(" ⁇ " if i == self.unknown else self.names[i].replace(SPACE, " "))
        if raw:
            out.append(_utf8(bytes(raw)))
        return "".join(out)

    def decode(self, ids: Sequence[int]) -> str:
        """The text of the ids, without the space put before it."""
        first = next((i for i in ids if i not in self.silent), None)
        text = self._joined(ids)
        return text[1:] if first is not None and self.names[first].startswith(SPACE) else text

    def differing(self, chunks: Sequence[str], ids: Sequence[list[int]]) -> list[str]:
        """The chunks that the library encodes otherwise (each after a line feed of its own)."""
        if self.probe:
            skip = len(self.probe)
            theirs = [x[skip:] for x in self.library.encode(["\n" + c.replace(SPACE, " ") for c in chunks], num_threads=1)]
        else:
            theirs = self.library.encode([c[1:].replace(SPACE, " ") for c in chunks], num_threads=1)
        return [c for c, a, b in zip(chunks, ids, theirs) if a != b]


def _utf8(raw: bytes) -> str:
    """Decoded bytes; each byte that is not part of a character becomes U+FFFD."""
    out, at = [], 0
    while at < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + n].decode("utf-8"))
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


class Table:
    """The ids, as text, of the chunks seen lately; ``odd`` chunks do not decode to themselves.

    Chunks met are kept in the young generation; once it is full it becomes the old one,
    whose former chunks go.  A chunk met again in the old one is young again, so what is
    frequent stays.  Long chunks live for their group of texts only.
    """

    def __init__(self, pieces: Pieces, check: bool = True):
        self.pieces, self.check = pieces, check
        self.young: dict[str, str] = {}
        self.old: dict[str, str] = {}
        self.odd: dict[str, str] = {}
        self.long: list[str] = []

    def learn(self, chunks: set[str]) -> dict[str, str]:
        """The ids of all the chunks; newly encoded ones are compared with the library."""
        missing = chunks.difference(self.young)
        again = missing.intersection(self.old)
        self.young.update(zip(again, map(self.old.__getitem__, again)))
        new = list(missing.difference(again))
        short = [c for c in new if len(c) <= KEPT_LENGTH]
        long = [c for c in new if len(c) > KEPT_LENGTH]
        found = [x for at in range(0, len(short), STEP) for x in self.pieces.many(short[at : at + STEP])]
        found += map(self.pieces.chunk_ids, long)
        if self.check and new and (bad := self.pieces.differing(short + long, found)):
            raise ValueError(f"{len(bad)} chunks differ from the library, such as {bad[0]!r}")
        names, digits = self.pieces.names, self.pieces.digits
        for c, ids in zip(short + long, found):
            self.young[c] = " ".join([digits[i] for i in ids])
            if "".join([names[i] for i in ids]) != c:  # bytes or unknown pieces
                decoded = self.pieces._joined(ids)
                if decoded != c.replace(SPACE, " "):
                    self.odd[c] = decoded
        self.long = long
        return self.young

    def forget(self) -> None:
        """After a group: its long chunks go, and a full young generation becomes the old one."""
        for c in self.long:
            del self.young[c]
            self.odd.pop(c, None)
        if len(self.young) >= KEPT_CHUNKS // 2:
            self.old, self.young = self.young, {}
            self.odd = {c: d for c, d in self.odd.items() if c in self.old}

    def encode(self, texts: Sequence[str | None]) -> list[tuple[str, str]]:
        """(ids as text, decoded text) of each whole text, the end id last."""
        end = str(self.pieces.end)
        cut = [self.pieces.chunks(t) for t in texts]
        got = self.learn(set().union(*cut))
        out = []
        for text, chunks in zip(texts, cut):
            ids = " ".join([*map(got.__getitem__, chunks), end])
            if self.odd and not self.odd.keys().isdisjoint(chunks):
                decoded = "".join([self.odd.get(c) or c.replace(SPACE, " ") for c in chunks])
            else:  # every chunk's ids decode to the chunk itself, as tried when it was encoded
                decoded = "".join(chunks).replace(SPACE, " ")
            spaced = chunks and self.pieces.names[int(ids.split(" ", 1)[0])].startswith(SPACE)
            out.append((ids, decoded[1:] if spaced else decoded))
        self.forget()
        return out


#: Texts are handled in groups of about so many characters, which bounds a task's memory.
GROUP = 1 << 19


def _groups(texts: pa.Array, characters: int = GROUP) -> Iterator[list[str | None]]:
    group, size = [], 0
    for t in texts:
        t = t.as_py()
        group.append(t)
        size += len(t or "")
        if size >= characters:
            yield group
            group, size = [], 0
    if group:
        yield group


def _model(spark, path: str):
    """The vocabulary's bytes, read on the driver and broadcast under a checked size."""
    with open(path, "rb") as f:
        proto = f.read(MAX_MODEL + 1)
    if len(proto) > MAX_MODEL:
        raise ValueError(f"{path} is over {MAX_MODEL} bytes")
    return spark.sparkContext.broadcast(proto)


def encode(docs: DataFrame, model: str, check: bool = True) -> DataFrame:
    """(doc_id, ids, decoded) of every whole text, the end id last."""
    proto = _model(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(Pieces(proto.value), check)
        for batch in batches:
            at = 0
            for texts in _groups(batch.column("text")):
                rows = table.encode(texts)
                ids = [list(map(int, x[0].split(" "))) for x in rows]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(texts)), pa.array(ids, pa.list_(pa.int32())), pa.array([x[1] for x in rows], pa.string())], names=["doc_id", "ids", "decoded"])
                at += len(texts)
            give_back()

    return _slim(docs).mapInArrow(run, "doc_id bigint, ids array<int>, decoded string")


def digests(docs: DataFrame, model: str, check: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text: the digests of
    what ``encode`` returns, without the lists."""
    proto = _model(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(Pieces(proto.value), check)
        for batch in batches:
            at = 0
            for texts in _groups(batch.column("text")):
                rows = table.encode(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(at, len(texts)),
                        pa.array([r[0].count(" ") + 1 for r in rows], pa.int64()),
                        pa.array([hashlib.sha256(r[0].encode()).hexdigest() for r in rows]),
                        pa.array([hashlib.sha256(r[1].encode()).hexdigest() for r in rows]),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )
                at += len(texts)
            give_back()

    return _slim(docs).mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def decode(rows: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """The rows with the text of their ids in a new column ``decoded`` (null ids: null)."""
    proto = _model(rows.sparkSession, model)

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pieces = Pieces(proto.value)
        for lists in batches:
            yield pd.Series([None if x is None else pieces.decode([int(i) for i in x]) for x in lists])

    return rows.withColumn("decoded", text(F.col(ids)))


def _slim(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
