"""A generalised additive model with pairwise interactions, as lookup tables.

Each feature is cut into bins, and cyclic boosting adds shallow trees of one feature
at a time to that feature's table of log-odds. Then the pairs that explain most of
what is left get tables of their own, boosted in the same way with trees of one cut
on each side. A score is the sum of one table entry per feature and pair.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.common import WORD, arrow_schema, text_batches

#: Most labelled rows that a model is fitted on: those with the smallest hashes of their ids.
FIT_ROWS = 20_000
THRESHOLD = 0.7

FEATURES = (
    "log_chars", "log_words", "word_length", "long_word_share", "short_word_share", "letter_share", "upper_share",
    "digit_share", "stop_share", "symbol_share", "bar_share", "space_share", "byte_share", "line_words",
    "distinct_share", "top_word_share", "repeated_line_share", "stop_line_share", "upper_word_share",
)
_WORDS = re.compile(WORD)


def _byte_classes() -> np.ndarray:
    kinds = np.zeros((256, 8))
    for b in range(256):
        c = chr(b)
        kinds[b] = [
            b < 128 and c.isalpha(), b < 128 and c.isupper(), b < 128 and c.isdigit(), c in ".,;:?",
            33 <= b < 127 and not c.isalnum() and c not in ".,;:?|", c == "|", c in " \t\n\r\v\f", b >= 128,
        ]
    return kinds


_CLASSES = _byte_classes()


def text_features(text: str | None) -> list[float]:
    """``FEATURES`` of a whole text; a null text is empty. Shares of nothing are 0."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _CLASSES
    n = max(1, len(raw))
    words = _WORDS.findall(text)
    k = max(1, len(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    tally = Counter(words)
    lines = [line for line in text.split("\n") if line]
    letters, upper, digits, stops, symbols, bars, spaces, high = counts.tolist()
    return [
        np.log1p(len(text)), np.log1p(len(words)), float(sizes.sum()) / k, float((sizes > 10).sum()) / k, float((sizes < 4).sum()) / k,
        letters / n, upper / n, digits / n, stops / n, symbols / n, bars / n, spaces / n, high / n,
        len(words) / max(1, len(lines)), len(tally) / k, max(tally.values(), default=0) / k,
        1 - len(set(lines)) / max(1, len(lines)), sum(x[-1] in ".?!:;" for x in lines) / max(1, len(lines)),
        sum(w.isupper() for w in tally) / max(1, len(tally)),
    ]


def _texts_to(rows: DataFrame, columns: str, values) -> DataFrame:
    """``rows`` of (key, text) to key and what ``values`` makes of a batch's features."""
    shape = arrow_schema(columns)

    def task(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in text_batches(frames, "text"):
            features = np.array([text_features(t) for t in frame.column("text").to_pylist()]).reshape(len(frame), len(FEATURES))
            yield pa.RecordBatch.from_arrays([frame.column(0), pa.array(values(features), shape.field(1).type)], schema=shape)

    return rows.mapInArrow(task, columns)


@dataclass
class Model:
    """Cut points of each feature, one table per feature and per pair, and the log-odds of the whole."""

    base: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)
    both: bool = True  # rows of both labels were fitted

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row of features."""
        total = np.full(len(rows), self.base)
        for j, (cuts, table) in enumerate(zip(self.cuts, self.tables, strict=True)):
            total += table[np.searchsorted(cuts, rows[:, j], "right")]
        for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[np.searchsorted(self.coarse[a], rows[:, a], "right"), np.searchsorted(self.coarse[b], rows[:, b], "right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _cut_points(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _leaf(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g / (h + 1.0)


def _tree(g: np.ndarray, h: np.ndarray, depth: int, least: float) -> np.ndarray:
    """Leaf values by bin of a shallow tree over the bins of one feature."""
    value = np.full(len(g), _leaf(g.sum(), h.sum()))
    if depth and len(g) > 1:
        gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        gr, hr = g.sum() - gl, h.sum() - hl
        gain = np.where((hl >= least) & (hr >= least), gl**2 / (hl + 1) + gr**2 / (hr + 1), -1)
        k = int(gain.argmax())
        if gain[k] > g.sum() ** 2 / (h.sum() + 1) + 1e-12:
            value[: k + 1] = _tree(g[: k + 1], h[: k + 1], depth - 1, least)
            value[k + 1 :] = _tree(g[k + 1 :], h[k + 1 :], depth - 1, least)
    return value


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of both sides of a pair: its gain and the four leaf values by cell."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    top, side = slice(None, -1), slice(None, -1)
    parts = []
    for c in (cg, ch):
        a = c[top, side]
        b = c[top, -1:] - a
        d = c[-1:, side] - a
        parts.append((a, b, d, c[-1, -1] - a - b - d))
    gain = sum(x**2 / (y + 1) for x, y in zip(*parts, strict=True))
    if not gain.size:
        return 0.0, np.zeros_like(g)
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    value = np.empty_like(g)
    leaves = [_leaf(x[i, j], y[i, j]) for x, y in zip(*parts, strict=True)]
    value[: i + 1, : j + 1], value[: i + 1, j + 1 :], value[i + 1 :, : j + 1], value[i + 1 :, j + 1 :] = leaves
    return float(gain[i, j] - cg[-1, -1] ** 2 / (ch[-1, -1] + 1)), value


def fit(rows: np.ndarray, labels: np.ndarray, bins: int = 32, rounds: int = 80, rate: float = 0.15, n_pairs: int = 10, pair_rounds: int = 30) -> Model:
    """Tables from labelled rows. Without rows of both labels every score is near the share of label 1."""
    share = (labels.sum() + 1) / (len(labels) + 2)
    base = float(np.log(share / (1 - share)))
    width = rows.shape[1]
    cuts = [_cut_points(rows[:, j], bins) if len(rows) else np.zeros(0) for j in range(width)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    if len(set(labels.tolist())) < 2:
        return Model(base, cuts, tables, both=False)
    at = [np.searchsorted(c, rows[:, j], "right") for j, c in enumerate(cuts)]
    total = np.full(len(rows), base)
    least = max(1.0, 0.0005 * len(rows))

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return labels - p, p * (1 - p)

    for _ in range(rounds):
        for j in range(width):
            g, h = slopes()
            size = len(tables[j])
            step = rate * np.clip(_tree(np.bincount(at[j], g, size), np.bincount(at[j], h, size), 2, least), -4, 4)
            tables[j] += step
            total += step[at[j]]
    coarse = [_cut_points(rows[:, j], 8) for j in range(width)]
    cell = [np.searchsorted(c, rows[:, j], "right") for j, c in enumerate(coarse)]

    def sums(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
        both = cell[a] * shape[1] + cell[b]
        g, h = slopes()
        return tuple(np.bincount(both, x, shape[0] * shape[1]).reshape(shape) for x in (g, h))

    gains = sorted(((-_quadrants(*sums(a, b))[0], (a, b)) for a, b in combinations(range(width), 2)))
    pairs = [p for gain, p in gains[:n_pairs] if gain < 0]
    pair_tables = [np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1)) for a, b in pairs]
    for _ in range(pair_rounds):
        for (a, b), table in zip(pairs, pair_tables, strict=True):
            step = rate * np.clip(_quadrants(*sums(a, b))[1], -4, 4)
            table += step
            total += step[cell[a], cell[b]]
    return Model(base, cuts, tables, pairs, coarse, pair_tables)


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels are never learnt from."""
    return F.crc32(F.col(doc_id).cast("string")) % 4 == 2


def fit_quality(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, label: str = "quality") -> Model:
    """A model of ``label`` from at most ``fit_rows`` labelled ids that are not held out.

    They are the ids with the smallest hashes. Rows with a null id or label don't
    count; of several labels of an id the largest counts; labels without a document
    are of no use. Of several texts of an id the one with the smallest hash is fitted.
    Features are all that a score sees.
    """
    known = (
        labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(label).alias("label")).filter(~held_out())
    )
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows).withColumnRenamed("doc_id", "_id")
    # at most fit_rows rows of two numbers are broadcast, so only their texts are looked at
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    once = rows.groupBy("doc_id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    texts = once.select(F.struct("doc_id", "label").alias("key"), "text")
    kind = chosen.schema["label"].dataType.simpleString()
    found = _texts_to(texts, f"key struct<doc_id:bigint,label:{kind}>, features array<double>", lambda f: f.tolist()).collect()
    found.sort(key=lambda r: (r["key"]["doc_id"], r["features"]))
    x = np.array([r["features"] for r in found], dtype=np.float64).reshape(len(found), len(FEATURES))
    return fit(x, np.array([float(r["key"]["label"] > 0) for r in found]))


def quality_scores(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``.

    A null text is scored as an empty one, a null id is not held out, repeated rows are
    scored each for itself, an empty table gives no row, other columns are not read.
    """
    model = fit_quality(docs, labels, fit_rows)
    scored = _texts_to(docs.select("doc_id", "text"), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double", model.score)
    return scored.select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose texts score at least ``threshold``, with all their columns.

    Where the fitted rows don't hold both labels, nothing tells good texts from others:
    all rows stay.
    """
    model = fit_quality(docs, labels, fit_rows)
    if not model.both:
        return docs

    def task(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in text_batches(frames, "text"):
            features = np.array([text_features(t) for t in frame.column("text").to_pylist()]).reshape(len(frame), len(FEATURES))
            yield frame.filter(pa.array(model.score(features) >= threshold))

    return docs.mapInArrow(task, docs.schema)
