"""Language identification: averaged hashed subword embeddings with a linear softmax.

Trained by numpy stochastic gradient descent on a bounded sample of rows with a
language (``max_train``).  The sample is drawn per language: each has as many rows as any
other, those of smallest id hash, or all where it has fewer, and the rest is dealt to the
others; so the rarest language is learned, from however few rows.  Further rows of the
sample (``max_check``) are set aside: on them a temperature makes the probabilities calibrated, and two cutoffs are
fitted, of the calibrated probability and of the share of n-grams seen in training.  A
text under either is rejected; each cutoff is what all but ``reject_share`` of the rightly
named texts set aside reach, and all but ``reject_share`` of texts mixed from two to four
of their languages.  No constant bounds a cutoff.  N-grams count as seen by a hash of
``SEEN_BITS`` bits, so that hardly any is seen by chance.  So a text of which more is new
than of nearly all known ones is rejected: another script or language, also one of the
same script, and a text with long parts in one.

Cases: a null text or one without a letter is ``und`` with score 0 and rejected;
with nothing to learn from every
text is ``und``; under 50 rows nothing is set aside and the cutoffs are those of the
rows learned from; with more than ``max_train`` languages the rarest are not learned and a
warning says so; of rows that repeat id and language one is learned from; repeated rows are
handled one by one; columns other than
``doc_id``, ``text`` and, for learning, ``lang`` are not read.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SLICE_ROWS, give_back, held_out
from .subword import Features, bags, feature_ids, softmax, train

SPEC = Features(ngrams=(2, 3, 4), words=False, letters=True, bits=17)
UNDETERMINED = "und"
#: Steps of training that even few rows get.
LEAST_STEPS = 3000
#: Bits of the hash by which an n-gram counts as seen: one of 100,000 learned is met by chance in 0.3 % of cases.
SEEN_BITS = 25


@dataclass(frozen=True)
class LanguageModel:
    table: np.ndarray  # folded logits of each language
    langs: tuple[str, ...]
    temperature: float
    threshold: float  # of the calibrated probability
    seen: np.ndarray  # a bit for each n-gram hash: seen in training
    seen_share: float  # least share of seen n-grams
    spec: Features = SPEC

    def predict(self, texts) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, calibrated probability, rejected) of each text."""
        texts = list(texts)
        some = np.array([bool(t) and any(map(str.isalpha, t)) for t in texts], bool)
        if not self.langs:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        z, known = measures(texts, self.table, self.seen, self.spec)
        p = softmax(z / self.temperature) if texts else np.zeros((0, len(self.langs)))
        best = p.argmax(axis=1)
        score = np.where(some, p.max(axis=1), 0.0)
        return [self.langs[k] if s else UNDETERMINED for k, s in zip(best, some)], score, ~some | (score < self.threshold) | (known < self.seen_share)


def measures(texts, table: np.ndarray, seen: np.ndarray, spec: Features) -> tuple[np.ndarray, np.ndarray]:
    """(logits, share of seen n-grams) of each whole text; 0 for a text without any feature."""
    total, known, count = np.zeros((len(texts), table.shape[1])), np.zeros(len(texts)), np.zeros(len(texts))
    for own, ids in feature_ids(texts, replace(spec, bits=SEEN_BITS)):
        count += np.bincount(own, minlength=len(texts))
        known += np.bincount(own, weights=seen[ids >> 3] >> (7 - (ids & 7)) & 1, minlength=len(texts))
        ids >>= SEEN_BITS - spec.bits  # the bucket is the head of the longer hash
        for k in range(table.shape[1]):
            total[:, k] += np.bincount(own, weights=table[:, k][ids], minlength=len(texts))
    count = np.maximum(count, 1)
    return total / count[:, None], known / count


def mixed(texts: list[str], y: np.ndarray, seed: int = 7) -> Iterator[str]:
    """For each text a mixture of it with texts of one to three other languages, equal parts of each."""
    rng = np.random.default_rng(seed)
    of = {k: np.flatnonzero(y == k) for k in np.unique(y)}
    for i in range(len(texts) if len(of) > 1 else 0):
        others = rng.permutation([k for k in of if k != y[i]])[: rng.integers(1, min(4, len(of)))]
        words = [texts[j].split() for j in (i, *(rng.choice(of[k]) for k in others))]
        n = min(map(len, words))
        yield " ".join(w for part in words for w in part[:n])


def dealt(counts: dict[str, int], rows: int) -> dict[str, int]:
    """So many rows dealt evenly to labels that have ``counts`` of them, at least one each."""
    out, left = {}, rows
    for k, (label, n) in enumerate(sorted(counts.items(), key=lambda c: (c[1], c[0]))):
        out[label] = max(1, min(n, left // (len(counts) - k)))
        left -= out[label]
    return out


def sample_per_language(docs: DataFrame, max_rows: int, max_langs: int) -> list[tuple[str, str]]:
    """(lang, text) of at most ``max_rows`` rows of the learning folds with a letter in their
    text, dealt evenly to the languages, in a fixed order.

    Nothing is sorted or grouped by language: cutoffs of the id hash, from counts, leave
    little more than the sample, and only its ids and then its texts leave the scans.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("_y"), F.col("text").cast("string").alias("text"))
    rows = rows.filter(F.col("doc_id").isNotNull() & F.col("_y").isNotNull() & ~held_out(F.col("doc_id")) & F.col("text").rlike(r"\p{L}"))
    counts = rows.groupBy("_y").agg(F.approx_count_distinct("doc_id").alias("n")).orderBy(F.desc("n"), "_y").limit(max_langs + 1).collect()
    if len(counts) > max_langs:
        warnings.warn(f"over {max_langs} languages: the rarest are not learned", stacklevel=2)
    counts = {r["_y"]: max(1, r["n"]) for r in counts[:max_langs]}
    if not counts:
        return []
    # a generous part, as the counts are estimates; all of a rare language
    part = {label: min(1.0, (1.3 * n + 50) / counts[label]) for label, n in dealt(counts, max_rows).items()}
    cuts = spark.createDataFrame([(label, min((1 << 63) - 1, int((p - 0.5) * (1 << 64)))) for label, p in part.items()], "_y string, _cut bigint")
    found = rows.join(F.broadcast(cuts), "_y").withColumn("_h", F.xxhash64("doc_id")).filter("_h <= _cut").select("_y", "_h", "doc_id").distinct().collect()
    of: dict[str, list] = {}
    for r in sorted(found):
        of.setdefault(r["_y"], []).append((r["doc_id"], r["_y"]))
    if not of:
        return []
    share = dealt({label: len(ids) for label, ids in of.items()}, max_rows)
    chosen = spark.createDataFrame([pair for label, ids in of.items() for pair in ids[: share[label]]], "doc_id bigint, _y string")
    texts = rows.join(F.broadcast(chosen), ["doc_id", "_y"]).groupBy("doc_id", "_y").agg(F.min("text").alias("text"))
    # Python orders them: by language, and in it by the hash
    text_of = {(r["doc_id"], r["_y"]): r["text"] for r in texts.collect()}
    return [(label, text_of[pair]) for label, ids in sorted(of.items()) for pair in ids[: share[label]]]


def fit(docs: DataFrame, max_train: int = 3000, spec: Features = SPEC, epochs: int = 5, reject_share: float = 0.001, max_check: int = 3000) -> LanguageModel:
    rows = sample_per_language(docs, max_train + max_check, max_train)
    langs = tuple(sorted({v for v, _ in rows}))
    if not langs:
        return LanguageModel(np.zeros((1 << spec.bits, 1), np.float32), (), 1.0, 0.0, np.zeros(1, np.uint8), 0.0, spec)
    y, texts = np.array([langs.index(v) for v, _ in rows]), [t for _, t in rows]
    aside = np.zeros(len(rows), bool)
    if len(rows) >= 50:  # of each language in turn; its first row is learned from
        nth = np.zeros(len(rows), int)
        for k in range(len(langs)):
            nth[y == k] = np.arange((y == k).sum())
        aside = (nth + 1) * max_check // (max_train + max_check) > nth * max_check // (max_train + max_check)
    learned = [t for t, a in zip(texts, aside) if not a]
    # few rows are seen more often
    table = train(bags(learned, spec), y[~aside], len(langs), spec, epochs=max(epochs, LEAST_STEPS // len(learned)))
    seen = np.zeros(1 << (SEEN_BITS - 3), np.uint8)
    for _, ids in feature_ids(learned, replace(spec, bits=SEEN_BITS)):
        ids = np.unique(ids)
        np.bitwise_or.at(seen, ids >> 3, (128 >> (ids & 7)).astype(np.uint8))
    check = np.flatnonzero(aside) if aside.any() else np.arange(len(rows))
    plain = [texts[i] for i in check]
    z, share = measures(plain, table, seen, spec)
    temperature = min(np.geomspace(0.05, 20, 121), key=lambda t: -np.log(softmax(z / t)[np.arange(len(check)), y[check]] + 1e-12).mean())
    right = z.argmax(axis=1) == y[check]
    # the plain texts of the right name, and mixtures, which have none
    groups = [(z[right], share[right])] if right.any() else [(z, share)]
    both = (t for t in mixed(plain, y[check]) if any(map(str.isalpha, t)))
    while some := list(islice(both, SLICE_ROWS)):
        groups.append(measures(some, table, seen, spec))
    groups = [groups[0], tuple(map(np.concatenate, zip(*groups[1:])))] if groups[1:] else groups
    del rows, texts, learned, plain
    give_back()
    threshold, seen_share = (min(float(np.quantile(v, reject_share)) for v in values) for values in ([softmax(z / temperature).max(axis=1) for z, _ in groups], [s for _, s in groups]))
    return LanguageModel(table, langs, float(temperature), threshold, seen, seen_share, spec)


def language_column(model: LanguageModel, text: Column) -> Column:
    """struct(lang_pred, score, rejected) of a text column."""
    parts = (model.table, model.langs, model.temperature, model.threshold, model.seen, model.seen_share, model.spec)

    @F.arrow_udf("lang_pred string, score double, rejected boolean")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fitted = LanguageModel(*parts)
        for texts in batches:
            langs, scores, rejected = [], [], []
            for at in range(0, len(texts), SLICE_ROWS):
                lang, score, gone = fitted.predict(texts.slice(at, SLICE_ROWS).to_pylist())
                langs += lang
                scores += score.tolist()
                rejected += gone.tolist()
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())], names=["lang_pred", "score", "rejected"])
            give_back()

    return predict(text)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) of every document."""
    found = docs.select("doc_id", language_column(model, F.col("text")).alias("_p"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "_p.lang_pred", "_p.score", "_p.rejected")


def keep_identified(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The documents whose language is not rejected, with all their columns, whatever their names."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), language_column(model, F.col("text"))["rejected"].alias("rejected"))
    return rows.filter("not rejected").select("row.*")
