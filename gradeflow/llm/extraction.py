"""Main text of HTML pages: a linear-chain conditional random field over DOM leaf blocks.

A page is the row of its leaf blocks (``htmlblocks``).  Features are the tags, classes,
ids and roles of all elements around a block and properties of its text; a chain of two
labels (main text or not) ties neighbours together.  Weights are learned by gradient
ascent on the penalised likelihood (forward-backward in numpy) from labelled pages: any
pages whose elements bear ``data-main`` marks, by default those of ``layouts``, a
documented number of them.  Viterbi's algorithm decodes every page of the table; the
blocks labelled main are joined by line feeds, whole and in order.

Cases: a null or empty page, and one without a main block, gives an empty text; broken
markup (unclosed or stray tags, a page cut short) is parsed as far as it goes, as browsers
do; pages are read whole, whatever their length or depth; repeated rows are extracted one
by one; an empty table gives an empty result; columns other than ``page_id``, ``url`` and
``html`` are not read, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_ROWS, give_back
from .htmlblocks import Block, blocks, features
from .layouts import labelled_pages

#: Labelled pages that are learned from.
TRAIN_PAGES = 1500
#: A feature is kept that so many labelled pages have.
LEAST_PAGES = 3


@dataclass(frozen=True)
class BlockModel:
    weights: dict[str, float]  # for main against not, by feature
    step: np.ndarray  # [label before, label]
    first: np.ndarray  # [label]

    def labels(self, page: list[Block]) -> list[bool]:
        """Viterbi: the likeliest labels of a page's blocks."""
        if not page:
            return []
        weight = self.weights.get
        scores = [sum([weight(f, 0.0) for f in found]) for found in features(page)]
        (s00, s01), (s10, s11) = self.step.tolist()
        rest, main = float(self.first[0]), float(self.first[1]) + scores[0]
        back = []
        for s in scores[1:]:
            from_rest, from_main = rest + s00 >= main + s10, rest + s01 >= main + s11
            back.append((not from_rest, not from_main))
            rest, main = (rest + s00 if from_rest else main + s10), (rest + s01 if from_main else main + s11) + s
        label = main > rest
        out = [label]
        for to_rest, to_main in reversed(back):
            label = to_main if label else to_rest
            out.append(label)
        return out[::-1]

    def extract(self, html: str | None) -> str:
        page = list(blocks(html))
        return "\n".join([b.text for b, main in zip(page, self.labels(page)) if main])


def fit(pages: Iterable[str] | None = None, steps: int = 150, rate: float = 1.0, penalty: float = 0.3) -> BlockModel:
    """The field learned from labelled pages (``TRAIN_PAGES`` made-up ones by default)."""
    found, labels = [], []
    for html in labelled_pages(TRAIN_PAGES) if pages is None else pages:
        page = list(blocks(html))
        if page:
            found.append(features(page))
            labels.append([bool(b.main) for b in page])
    if not found:
        return BlockModel({}, np.zeros((2, 2)), np.zeros(2))
    seen = Counter(f for page in found for f in {f for block in page for f in block})
    names = sorted(f for f, n in seen.items() if n >= LEAST_PAGES)
    number = {f: i for i, f in enumerate(names)}
    size = np.array([len(p) for p in found])
    order = np.argsort(-size, kind="stable")  # pages that still go on come first
    found, labels, size = [found[i] for i in order], [labels[i] for i in order], size[order]
    flat = [[number[f] for f in block if f in number] for page in found for block in page]
    column = np.fromiter((i for block in flat for i in block), np.int64)
    row = np.repeat(np.arange(len(flat)), [len(b) for b in flat])
    y = np.array([v for page in labels for v in page], np.int64)
    begin = np.cumsum(size) - size
    longest = int(size[0])
    alive = [int((size > t).sum()) for t in range(longest)]
    w, step, first = np.zeros(len(names)), np.zeros((2, 2)), np.zeros(2)
    squares = [np.full_like(x, 1e-6) for x in (w, step, first)]
    follows = np.zeros((2, 2))
    inner = np.ones(len(y), bool)
    inner[begin] = False
    at = np.flatnonzero(inner)
    np.add.at(follows, (y[at - 1], y[at]), 1)
    starts = np.bincount(y[begin], minlength=2)
    target = np.bincount(column, weights=y[row].astype(float), minlength=len(names))
    for _ in range(steps):
        score = np.zeros((len(y), 2))
        score[:, 1] = np.bincount(row, weights=w[column], minlength=len(y))
        ahead, back = np.zeros((len(y), 2)), np.zeros((len(y), 2))
        ahead[begin] = score[begin] + first
        for t in range(1, longest):
            here = begin[: alive[t]] + t
            ahead[here] = score[here] + np.logaddexp(ahead[here - 1, :1] + step[0], ahead[here - 1, 1:] + step[1])
        for t in range(longest - 2, -1, -1):
            here = begin[: alive[t + 1]] + t
            after = score[here + 1] + back[here + 1]
            back[here] = np.logaddexp(step[:, 0] + after[:, :1], step[:, 1] + after[:, 1:])
        ends = begin + size - 1
        whole = np.repeat(np.logaddexp(ahead[ends, 0], ahead[ends, 1]), size)
        p = np.exp(ahead + back - whole[:, None])
        pairs = np.exp(ahead[at - 1][:, :, None] + step + (score + back)[at][:, None, :] - whole[at][:, None, None]).sum(axis=0)
        slopes = [target - np.bincount(column, weights=p[row, 1], minlength=len(names)) - penalty * w, follows - pairs - penalty * step, starts - p[begin].sum(axis=0) - penalty * first]
        for x, g, square in zip((w, step, first), slopes, squares):
            square += g * g
            x += rate * g / np.sqrt(square)
    return BlockModel(dict(zip(names, w.tolist())), step, first)


def main_texts(pages: DataFrame, model: BlockModel) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    sent = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                texts = [model.extract(html.as_py()) for html in part.column("html")]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])
            give_back()

    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
