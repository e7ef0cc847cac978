"""Own encoding and decoding against the library."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from gradeflow.llm import registry, sentencepieces
from gradeflow.llm.sentencepieces import Pieces, Table

ODD = ["", " ", "  a", "a  b ", "a\nb\n\n c", "a\x00b", "▁x", "é😀z", "a\xa0b", "ａｂ", "</s><s>", "<0x41>", "�", "x" * 3000, "ab " * 50, "\r\n\t x", "中文字符", "\n▁ ▁", None]


@pytest.fixture(scope="module")
def pieces():
    with open(registry.SENTENCEPIECE_MODEL, "rb") as f:
        return Pieces(f.read())


def library_ids(pieces, text):
    return pieces.library.encode(text or "", add_eos=True)


def test_agenda_equals_the_library(pieces):
    rng = random.Random(2)
    texts = ODD + ["".join(rng.choice("abcdeé ▁\n.,ñ中😀") for _ in range(rng.randrange(60))) for _ in range(300)]
    for t in texts:
        assert pieces.encode(t) == library_ids(pieces, t)
        assert pieces.decode(pieces.encode(t)) == pieces.library.decode(library_ids(pieces, t))
    for t, (ids, decoded) in zip(texts, Table(pieces).encode(texts)):
        assert ids == " ".join(map(str, library_ids(pieces, t))) and decoded == pieces.library.decode(library_ids(pieces, t))


def test_many_chunks_at_once_equal_one_by_one(pieces):
    rng = random.Random(4)
    chunks = ["▁" + "".join(rng.choice("theandior中") for _ in range(rng.randrange(1, 20))) for _ in range(500)]
    assert pieces.many(chunks) == [pieces.chunk_ids(c) for c in chunks]


def test_any_ids_decode_as_the_library_does(pieces):
    rng = random.Random(6)
    for _ in range(300):
        ids = [rng.randrange(400) if rng.random() < 0.5 else rng.randrange(32_000) for _ in range(12)]
        assert pieces.decode(ids) == pieces.library.decode(ids)


def test_a_difference_from_the_library_ends_the_task(pieces):
    table = Table(pieces)
    table.pieces.many, kept = (lambda chunks: [[5] for _ in chunks]), table.pieces.many
    try:
        with pytest.raises(ValueError, match="differ from the library"):
            table.encode(["hello there"])
    finally:
        table.pieces.many = kept


def test_a_full_table_changes_nothing(pieces, monkeypatch):
    monkeypatch.setattr(sentencepieces, "KEPT_CHUNKS", 5)
    table = Table(pieces)
    for t in ["a b c d e f g h", "a b x y z " + "q" * 100, "one two three"]:
        assert table.encode([t])[0][0] == " ".join(map(str, library_ids(pieces, t)))


def test_query_digests(spark, pieces):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in registry.op6_sentencepiece(spark, SF_SMALL).collect():
        ids = library_ids(pieces, rows[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(pieces.library.decode(ids).encode()).hexdigest()


def test_round_trip_and_edge_cases(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a  b"), (4, "é" * 20_000), (4, "x")], "doc_id long, text string").withColumn("ids", F.lit("clash"))
    out = sentencepieces.encode(docs, registry.SENTENCEPIECE_MODEL)
    rows = out.collect()
    assert [(r.doc_id, r.decoded) for r in rows] == [(1, ""), (2, ""), (None, "a  b"), (4, "é" * 20_000), (4, "x")]
    assert rows[0].ids == [2]
    back = sentencepieces.decode(out.select("doc_id", "ids"), registry.SENTENCEPIECE_MODEL).collect()
    assert [r.decoded for r in back] == [r.decoded for r in rows]
    assert sentencepieces.digests(docs.limit(0), registry.SENTENCEPIECE_MODEL).count() == 0
