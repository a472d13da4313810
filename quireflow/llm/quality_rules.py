"""Quality rules: document statistics judged by gradient-boosted trees.

Statistics are computed by numpy passes over whole Arrow batches (no shuffle).  The trees are
histogram-based, fitted with logistic loss on a bounded sample of labelled rows, keep monotonic
constraints on chosen features, and are flattened into node arrays so that scoring is ``depth``
gathers over (rows, trees).

Defined results: null text counts as no words; documents without words fail the base rule; equal
texts get equal verdicts; an empty label table (or one class only) leaves the base rule alone to
decide; a text of any length is looked at whole; further columns pass through ``judge`` untouched
unless they clash with an output column, which replaces them (carry them in a struct to keep them).
Lines and windows are told apart by 62-bit hashes with drawn bases (``bytewords``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytewords as bw
from .common import passes, table, utf8

#: Labelled rows that one fit looks at, at most.
MAX_TRAIN_ROWS = 8192
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("log_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share", "mark_share", "line_words")
#: Direction in which P(good) may move as the feature grows; absent: free.
MONOTONE = {"symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "upper_share": -1, "mark_share": -1}
_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_UPPER = np.isin(np.arange(256), np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", np.uint8))
_DIGIT = np.isin(np.arange(256), np.frombuffer(b"0123456789", np.uint8))
_MARK = np.isin(np.arange(256), np.frombuffer(b"!?", np.uint8))
WINDOW = 8


def statistics(off: np.ndarray, data: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Base counts and the feature matrix of the documents ``data[off[i]:off[i+1]]``."""
    n = len(off) - 1
    starts, ends, doc = bw.word_spans(data, off)
    n_words = np.bincount(doc, minlength=n)
    inside = ~bw.SPACE[data]
    chars = (data & 0xC0) != 0x80
    word_chars = bw.per_doc(chars & inside, off)
    n_symbols = bw.per_doc(_SYMBOL[data], off)
    prefix = bw.prefix_hash(data)

    ends_of_lines = np.flatnonzero(data == 10)
    line_start = np.union1d(off[:-1][off[1:] > off[:-1]], ends_of_lines + 1)
    line_start = line_start[line_start < len(data)]
    line_doc = np.searchsorted(off, line_start, "right") - 1
    nxt = np.searchsorted(ends_of_lines, line_start)
    line_end = np.minimum(np.append(ends_of_lines, len(data))[nxt], off[1:][line_doc])
    words_before = np.concatenate(([0], np.cumsum(inside, dtype=np.int64)))
    live = words_before[line_end] > words_before[line_start]
    line_start, line_end, line_doc = line_start[live], line_end[live], line_doc[live]
    _, later = bw.repeated(line_doc, bw.span_hash(prefix, line_start, line_end))
    n_lines = np.bincount(line_doc, minlength=n)
    n_dup_lines = np.bincount(line_doc[later], minlength=n)

    n_repeat = np.zeros(n, np.int64)
    if len(starts) >= WINDOW:
        word = bw.span_hash(prefix, starts, ends)
        whole = len(word) - WINDOW + 1
        h = np.zeros(whole, np.uint64)
        for k in range(WINDOW):
            h = h * np.uint64(0x9FB21C651E98DF25) + word[k : k + whole]
        at = np.flatnonzero(doc[:whole] == doc[WINDOW - 1 :])
        many, _ = bw.repeated(doc[at], h[at])
        step = np.zeros(len(word) + 1, np.int64)
        np.add.at(step, at[many], 1)
        np.add.at(step, at[many] + WINDOW, -1)
        covered = np.cumsum(step[:-1]) > 0
        n_repeat = np.bincount(doc[covered], minlength=n)

    counts = dict(zip(BASE, (n_words, word_chars, n_symbols, n_dup_lines, n_repeat), strict=True))
    words, letters, lines = np.maximum(n_words, 1), np.maximum(word_chars, 1), np.maximum(n_lines, 1)
    x = np.stack(
        [
            np.log1p(n_words), word_chars / words, n_symbols / letters, n_dup_lines / lines, n_repeat / words,
            bw.per_doc(_UPPER[data], off) / letters, bw.per_doc(_DIGIT[data], off) / letters, bw.per_doc(_MARK[data], off) / letters, n_words / lines,
        ],
        axis=1,
    )
    return counts, x


@dataclass
class Trees:
    """Flattened trees: node i splits on ``feature[i]`` at ``cut[i]``; leaves point at themselves."""

    feature: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    cut: np.ndarray = field(default_factory=lambda: np.zeros(0))
    left: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    right: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))
    roots: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    depth: int = 0
    bias: float = 30.0  # with no trees: everything passes

    def score(self, x: np.ndarray) -> np.ndarray:
        """P(good) of each row."""
        margin = np.full(len(x), self.bias)
        if len(self.roots) and len(x):
            at = np.repeat(self.roots[None, :], len(x), axis=0)
            rows = np.arange(len(x))[:, None]
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.cut[at], self.left[at], self.right[at])
            margin = margin + self.value[at].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(margin, -40, 40)))


def fit_trees(x: np.ndarray, y: np.ndarray, monotone: dict[int, int], n_trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 48, l2: float = 1.0, min_rows: int = 8) -> Trees:
    """Gradient boosting with logistic loss on binned features.

    A constrained feature splits only where the two sides' optimal weights stand in the right order;
    both sides then inherit their midpoint as a bound, so no deeper leaf can break the order.
    """
    y = np.asarray(y, float)
    if len(y) == 0 or y.min() == y.max():
        return Trees()
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    code = np.stack([np.searchsorted(q, c, "left") for q, c in zip(cuts, x.T, strict=True)], axis=1)  # code <= k  <=>  x <= cuts[k]
    p0 = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    bias = float(np.log(p0 / (1 - p0)))
    margin = np.full(len(y), bias)
    nodes: list[list[float]] = []  # feature, cut, left, right, value
    roots = []

    def weight(g: np.ndarray, h: np.ndarray, lo: float, hi: float) -> np.ndarray:
        return np.clip(-g / (h + l2), lo, hi)

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int, lo: float, hi: float) -> int:
        me = len(nodes)
        gs, hs = g[rows].sum(), h[rows].sum()
        own = float(weight(gs, hs, lo, hi))
        nodes.append([0, 0.0, me, me, own * rate])
        best = (1e-6, -1, -1, 0.0, 0.0)
        gain_of = lambda gg, hh, w: -(gg * w + 0.5 * (hh + l2) * w * w)
        if level < depth and len(rows) >= 2 * min_rows:
            for f, q in enumerate(cuts):
                if not len(q):
                    continue
                c = code[rows, f]
                gl, hl, nl = (np.cumsum(np.bincount(c, weights=w, minlength=len(q) + 1))[:-1] for w in (g[rows], h[rows], np.ones(len(rows))))
                wl, wr = weight(gl, hl, lo, hi), weight(gs - gl, hs - hl, lo, hi)
                gain = gain_of(gl, hl, wl) + gain_of(gs - gl, hs - hl, wr) - gain_of(gs, hs, own)
                ok = (nl >= min_rows) & (len(rows) - nl >= min_rows) & (monotone.get(f, 0) * (wr - wl) >= 0)
                gain = np.where(ok, gain, -1.0)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (float(gain[k]), f, k, float(wl[k]), float(wr[k]))
        _, f, k, wl, wr = best
        if f >= 0:
            go = code[rows, f] <= k
            mid, way = (wl + wr) / 2, monotone.get(f, 0)
            l_lo, l_hi, r_lo, r_hi = lo, hi, lo, hi
            if way > 0:
                l_hi, r_lo = mid, mid
            elif way < 0:
                l_lo, r_hi = mid, mid
            a = grow(rows[go], g, h, level + 1, l_lo, l_hi)
            b = grow(rows[~go], g, h, level + 1, r_lo, r_hi)
            nodes[me][:4] = [f, float(cuts[f][k]), a, b]
        return me

    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-margin))
        roots.append(grow(np.arange(len(y)), p - y, p * (1 - p), 0, -8.0, 8.0))
        t = np.array(nodes)
        so_far = Trees(t[:, 0].astype(np.int32), t[:, 1], t[:, 2].astype(np.int32), t[:, 3].astype(np.int32), t[:, 4], np.array(roots[-1:], np.int32), depth, 0.0)
        s = so_far.score(x)
        margin = margin + np.log(s / (1 - s))
    t = np.array(nodes)
    return Trees(t[:, 0].astype(np.int32), t[:, 1], t[:, 2].astype(np.int32), t[:, 3].astype(np.int32), t[:, 4], np.array(roots, np.int32), depth, bias)


def _stat_batches(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, dict[str, np.ndarray], np.ndarray]]:
    for batch in batches:
        off, data = utf8(batch.column(batch.schema.get_field_index(text)))
        for lo, hi in passes(off):
            counts, x = statistics(off[lo : hi + 1] - off[lo], data[off[lo] : off[hi]])
            yield batch.slice(lo, hi - lo), counts, x


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS, key: str = "doc_id", text: str = "text", target: str = "quality", **options) -> Trees:
    """Trees from at most ``max_rows`` labelled documents (the smallest key hashes), statistics computed on the executors.

    Labels without a document and null labels are left out; of labels that repeat a key the highest counts, of
    documents that repeat one the row of least text.
    """
    sample = (
        labels.where(F.col(key).isNotNull() & F.col(target).isNotNull()).groupBy(key).agg(F.max(target).cast("int").alias("__y"))
        .orderBy(F.xxhash64(key), key).limit(max_rows)
    )
    # the sample has at most max_rows rows; so has what meets it
    rows = docs.select(F.col(key).alias("__k"), F.col(text).alias("__t")).join(F.broadcast(sample.withColumnRenamed(key, "__k")), "__k")
    rows = rows.groupBy("__k", "__y").agg(F.min("__t").alias(text)).select("__y", text)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, x in _stat_batches(batches, text):
            yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int32()), *(pa.array(c) for c in x.T)], ["y", *FEATURES])

    # at most max_rows short rows of numbers reach the driver
    got = rows.mapInArrow(features, "y int, " + ", ".join(f"{f} double" for f in FEATURES)).toPandas()
    got = got.sort_values([*FEATURES, "y"])
    direction = {FEATURES.index(k): v for k, v in MONOTONE.items()}
    return fit_trees(got[list(FEATURES)].to_numpy(float), (got["y"] > 0).to_numpy(float), direction, **options)


def judge(docs: DataFrame, trees: Trees, threshold: float = 0.5, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carry`` alone) with the base counts, ``base_failed``, ``quality_score`` and ``kept``."""
    added = [(c, pa.int64()) for c in BASE] + [("base_failed", pa.bool_()), ("quality_score", pa.float64()), ("kept", pa.bool_())]
    names = [c for c in (docs.columns if carry is None else carry) if c not in {a for a, _ in added}]
    spark_kinds = {pa.int64(): "bigint", pa.bool_(): "boolean", pa.float64(): "double"}
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names] + [f"{c} {spark_kinds[k]}" for c, k in added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, counts, x in _stat_batches(batches, "__text"):
            failed = (counts["n_words"] < 20) | (100 * counts["n_repeat_words"] > 30 * counts["n_words"])
            score = trees.score(x)
            new = [*(counts[c] for c in BASE), failed, score, ~failed & (score >= threshold)]
            kept = [part.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(v, k) for v, (_, k) in zip(new, added, strict=True))], [*names, *(a for a, _ in added)])

    source = docs.select(*(F.col(f"`{c}`") for c in names), F.col(text).alias("__text"))
    return source.mapInArrow(run, schema)


def op3(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trees = fit(docs, table(spark, sf_dir, "labels"))
    return judge(docs, trees, carry=["doc_id"])
