"""Cross-tokenizer alignment against a plain version with both libraries."""

import hashlib
import json
import random
from collections import Counter, defaultdict

import sentencepiece
from conftest import SF_SMALL
from tokenizers import Tokenizer

from gradeflow.llm import alignment
from gradeflow.llm.registry import BYTE_PAIR_VOCABULARY, SENTENCEPIECE_MODEL, op13_tokenizer_alignment

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def spans(ids, lengths):
    out, at = [], 0
    for i in ids:
        out.append((at, at + lengths[i], i))
        at += lengths[i]
    return out


def plain(docs):
    """Each document's row, from overlaps of byte ranges of all token pairs around each place."""
    a = Tokenizer.from_file(BYTE_PAIR_VOCABULARY)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=SENTENCEPIECE_MODEL)
    letters = alignment.byte_letters()
    a_bytes = {i: bytes(letters[c] for c in p) for p, i in json.load(open(BYTE_PAIR_VOCABULARY, encoding="utf-8"))["model"]["vocab"].items() if all(c in letters for c in p)}
    b_bytes = {i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in range(b.get_piece_size())}
    found, counts = [], Counter()
    for doc, text in docs:
        ids_a, ids_b = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        raw = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes[i] for i in ids_a) != raw or b"".join(b_bytes[i] for i in ids_b) != raw:
            found.append((doc, None))
            continue
        in_a, in_b = spans(ids_a, {i: len(x) for i, x in a_bytes.items()}), spans(ids_b, {i: len(x) for i, x in b_bytes.items()})
        links, j = [], 0
        for s, e, i in in_a:
            while in_b[j][1] <= s:
                j += 1
            k = j
            while k < len(in_b) and in_b[k][0] < e:
                links.append((i, in_b[k][2]))
                k += 1
        ends = sorted({e for _, e, _ in in_a} & {e for _, e, _ in in_b})
        groups, begin = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for s, e, i in side if begin <= s and e <= end) for side in (in_a, in_b)) if len(ends) < 200 else None)
            begin = end
        if None in groups:  # long texts: one walk
            groups, x, y = [], 0, 0
            for end in ends:
                p, q = x, y
                while x < len(in_a) and in_a[x][1] <= end:
                    x += 1
                while y < len(in_b) and in_b[y][1] <= end:
                    y += 1
                groups.append(",".join(str(t[2]) for t in in_a[p:x]) + "|" + ",".join(str(t[2]) for t in in_b[q:y]))
        counts.update(links)
        found.append((doc, (len(ids_a), len(ids_b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest())))
    most = defaultdict(int)
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    for doc, r in found:
        if r is None:
            yield (doc, 0, 0, 0, 0, 0, 0, "")
        else:
            yield (doc, *r[:3], len(r[3]), sum(counts[p] == most[p[1]] for p in r[3]), sum(counts[p] for p in r[3]), r[4])


def rows(df):
    return Counter(tuple(r) for r in df.select(*COLUMNS).collect())


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert rows(op13_tokenizer_alignment(spark, SF_SMALL)) == Counter(plain([tuple(r) for r in docs]))


ODD = ["", "  ", None, "a\nb  c", "a \n b\t c 　x", "tab\t\t two", "a▁b c", "x" * 3000, "<|endoftext|> </s> <0x41> <unk>", "\x1c \x1d a \x85 b", "日本語 テキスト 🙂 ok", "don't  we'll", " lead", " \n", "\x00 a", "ﬁ ligature ①", "é ü", "ſ ẞ ͸"]


def test_odd_texts(spark):
    r = random.Random(1)
    letters = " \n\tab'sé1.,▁ 日🙂\x1c "
    texts = ODD + ["".join(r.choice(letters) for _ in range(r.randint(1, 30))) for _ in range(300)]
    docs = [*enumerate(texts), (5, "same id"), (5, "same id"), (None, "null id")]
    df = spark.createDataFrame([(d, t, 9, "x") for d, t in docs], "doc_id int, text string, n_a int, groups_sha256 string")
    assert rows(alignment.digests(df, BYTE_PAIR_VOCABULARY, SENTENCEPIECE_MODEL)) == Counter(plain(docs))
    assert rows(alignment.digests(df.limit(0), BYTE_PAIR_VOCABULARY, SENTENCEPIECE_MODEL)) == Counter()


def test_forms_by_shuffle_and_small_table(spark, monkeypatch):
    """Most forms beyond the broadcast ones, and chunks that are forgotten between groups."""
    monkeypatch.setattr(alignment, "HOT_FORMS", 3)
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").limit(40).collect()]
    df = spark.createDataFrame(docs * 3, "doc_id bigint, text string")
    assert rows(alignment.digests(df, BYTE_PAIR_VOCABULARY, SENTENCEPIECE_MODEL)) == Counter(plain(docs * 3))


def vocabularies():
    return alignment.Vocabularies(open(BYTE_PAIR_VOCABULARY, "rb").read(), open(SENTENCEPIECE_MODEL, "rb").read())


def test_table_of_chunks_forgets(monkeypatch):
    v = vocabularies()
    monkeypatch.setattr(alignment, "KEPT_CHUNKS", 20)
    table = alignment.Table(v)
    texts = [" ".join(f"word{i * 7 % 50}x" for i in range(n, n + 12)) for n in range(40)] + ["y" * 500]
    for t in texts * 2:
        chunks = set(v.chunks(t))
        got, long = table.learn(chunks)
        want = v.align(list(chunks))
        assert all(got[c] == want[c] for c in chunks)
        table.forget(long)
        assert len(table.young) + len(table.old) <= 20 + 2 * 12


def test_ranks_are_the_tokenizer():
    v = vocabularies()
    assert v.ranks is not None and v.cut
    r = random.Random(2)
    plain_letters = [chr(c) for c in [9, 10, 13, *range(0x20, 0x7F), *range(0xC0, 0x250)]]
    texts = [" " + "".join(r.choice(plain_letters) for _ in range(60)) for _ in range(500)]
    assert [e.ids for e in v.a.encode_batch(texts, add_special_tokens=False)] == [v.ranks.encode_ordinary(t) for t in texts]


def test_one_byte_map():
    v = vocabularies()
    for a, b in enumerate(v.same.tolist()):
        if b >= 0:
            assert v.a_bytes[a] == v.b_bytes[b]
