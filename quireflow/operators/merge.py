"""Seam merge: ordered chunk texts of a file become one text, overlaps removed once.

Which neighbours may be trimmed at all is relational (previous row by window, boxes, declared
overlaps).  The fold itself carries the text so far, so it is one pass in Python over files that a window keeps whole;
its state is the text and running bracket counts, so a seam costs its window and not the whole text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import OPEN_ENDINGS

#: Defaults of the shipped configuration.
WINDOW_BODY, WINDOW_TABLE, LIKENESS = 1200, 600, 0.88
#: The shortest exact and fuzzy overlaps, and the fuzzy search's step.
LEAST_EXACT, LEAST_FUZZY, FUZZY_STEP = 20, 40, 25
PROTECTED = ("toc", "table", "header_footer")
#: A seam inside one of these pairs goes on without a blank line.
MARKS = (("（", "）"), ("(", ")"), ("<td", "</td>"), ("<tr", "</tr>"))
RESULT = "file_name string, markdown string, removed array<struct<chunk_id:string,start:int,end:int>>"


def may_overlap(chunks: DataFrame, order: str = "rank", file: str = "file_name") -> DataFrame:
    """Adds ``trim``: the chunk and the one before it are plain text, declare an overlap and share pixels."""
    before = Window.partitionBy(file).orderBy(order)
    held = F.struct("block_type", "x0", "y0", "x1", "y1", "overlap")
    prev = F.lag(held).over(before)
    declared = lambda m: F.coalesce(F.exists(F.map_values(m), lambda v: v > 0), F.lit(False))
    shared = lambda lo, hi: F.least(F.col(hi), prev[hi]) > F.greatest(F.col(lo), prev[lo])
    plain: Column = ~F.col("block_type").isin(*PROTECTED) & ~prev["block_type"].isin(*PROTECTED)
    trim = plain & (declared(F.col("overlap")) | declared(prev["overlap"])) & shared("x0", "x1") & shared("y0", "y1")
    return chunks.withColumn("trim", F.coalesce(trim, F.lit(False)))


def exact_overlap(tail: str, head: str, least: int = 1) -> int:
    """The longest suffix of ``tail`` that is a prefix of ``head``, if at least ``least`` long, else 0.

    It begins where the first ``least`` characters of ``head`` stand in ``tail``; leftmost is longest.
    """
    tail = tail[-min(len(tail), len(head)) :] if head else ""
    at = tail.find(head[:least]) if tail else -1
    while 0 <= at <= len(tail) - least:
        if head.startswith(tail[at:]):
            return len(tail) - at
        at = tail.find(head[:least], at + 1)
    return 0


class Common:
    """Longest common subsequences of pieces of ``tail`` with beginnings of ``head``, a machine word of whose places is one step."""

    def __init__(self, tail: str, head: str):
        self.tail, places = tail, {}
        for i, c in enumerate(head):
            places.setdefault(c, []).append(i)
        self.places = {c: sum(1 << i for i in at) for c, at in places.items()}
        self.full = (1 << len(head)) - 1

    def with_last(self, k: int) -> Callable[[int], int]:
        """For j, the length of the longest common subsequence of the last ``k`` characters of ``tail`` and the first j of ``head``.

        A place of ``head`` is a zero bit once it ends a longer common subsequence than the places before it; carries only go up, so
        one pass over ``tail`` serves all beginnings of ``head``."""
        row, full, places = self.full, self.full, self.places
        for c in self.tail[-k:]:
            held = places.get(c)
            if held:
                hit = row & held
                row = (row + hit | row - hit) & full
        return lambda j: j - (row & ((1 << j) - 1)).bit_count()


def seam(tail: str, head: str, likeness: float = LIKENESS, fuzzy: bool = True) -> int:
    """Characters of ``head`` that repeat the end of ``tail``; 0 if neither an exact nor a fuzzy match is long enough."""
    n = min(len(tail), len(head))
    if n < LEAST_EXACT:
        return 0
    found = exact_overlap(tail, head, LEAST_EXACT)
    if found or not fuzzy:
        return found
    sizes = range(n, LEAST_FUZZY - 1, -FUZZY_STEP)
    common, bound, passed = None, lambda j: j, 0
    for k in sizes:
        # what matches is a common subsequence, and a shorter end of ``tail`` has no longer one
        if 2.0 * bound(k) / (2 * k) < likeness:
            continue
        if passed != k:
            common = common or Common(tail, head[:n])
            bound, passed = common.with_last(k), k
            if 2.0 * bound(k) / (2 * k) < likeness:
                continue
        if SequenceMatcher(None, tail[-k:], head[:k]).ratio() >= likeness:
            return k
    return 0


class _Text:
    """The text so far, right-stripped, with running counts of the marks that keep a seam open."""

    def __init__(self, first: str):
        self.parts, self.tail = [], ""
        self.open = [0] * len(MARKS)
        self.add("", first.rstrip())

    def add(self, glue: str, more: str) -> None:
        piece = glue + more
        if not piece:
            return
        reach = max(len(b) for _, b in MARKS) - 1
        edge = self.tail[-reach:]
        for i, (a, b) in enumerate(MARKS):
            # what straddles the seam counts once: count with the edge, take off what the edge held
            self.open[i] += (edge + piece).count(a) - edge.count(a) - (edge + piece).count(b) + edge.count(b)
        self.parts.append(piece)
        self.tail = (self.tail + piece)[-(WINDOW_BODY + 64) :] if len(piece) < WINDOW_BODY else piece

    def goes_on(self) -> bool:
        return bool(self.tail) and (any(n > 0 for n in self.open) or self.tail[-1] in OPEN_ENDINGS)

    def paragraph(self, more: str) -> None:
        # right-stripped on both sides: trailing space never decides anything later
        body = more.lstrip()
        if self.tail and more:
            self.add("\n\n", body.rstrip())
        elif not self.tail:
            self.add("", body.rstrip())

    def text(self) -> str:
        whole = "".join(self.parts).strip()
        return whole + "\n" if whole else ""


def fold(texts: list[str], kinds: list[str], trims: list[bool], ids: list[str], window: int = WINDOW_BODY, window_table: int = WINDOW_TABLE, likeness: float = LIKENESS, fuzzy: bool = True) -> tuple[str, list[tuple[str, int, int]]]:
    """The merged text, and (chunk_id, start, end) of what was cut, in positions of the stripped chunk."""
    if not texts:
        return "", []
    so_far, removed = _Text(texts[0] or ""), []
    for raw, kind, trim, cid in zip(texts[1:], kinds[1:], trims[1:], ids[1:], strict=True):
        now = (raw or "").strip()
        reach = window_table if kind == "table" else window
        tail = so_far.tail if reach <= len(so_far.tail) else "".join(so_far.parts)
        cut = seam(tail[-reach:], now[:reach], likeness, fuzzy) if trim else 0
        if cut:
            removed.append((cid, 0, cut))
            now = now[cut:]
            if not now:
                continue
            if now.startswith("\n"):
                so_far.add("", now.rstrip())
                continue
        if so_far.goes_on():
            so_far.add("", now.lstrip().rstrip())
        else:
            so_far.paragraph(now)
    return so_far.text(), removed


_REMOVED = pa.list_(pa.struct([("chunk_id", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def merge(chunks: DataFrame, order: str = "rank", fuzzy: bool = True, window: int = WINDOW_BODY, window_table: int = WINDOW_TABLE, likeness: float = LIKENESS) -> DataFrame:
    """(file_name, markdown, removed) of ordered chunks with ``trim``.

    The window that marks each file's first chunk leaves files whole and sorted within partitions
    (and shares the shuffle of ``may_overlap``), so the fold is one pass over a partition that
    holds one file's chunks at a time, without a call per file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple[str, str, list[dict]]] = []
        held: list[tuple] = []

        def close() -> None:
            text, removed = fold(*(list(c) for c in list(zip(*held, strict=True))[1:]), window, window_table, likeness, fuzzy)
            done.append((held[0][0], text, [{"chunk_id": c, "start": a, "end": b} for c, a, b in removed]))
            held.clear()

        def out() -> pa.RecordBatch:
            cols = list(zip(*done, strict=True)) if done else [[]] * 3
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.string(), _REMOVED), strict=True)], ["file_name", "markdown", "removed"])
            done.clear()
            return batch

        for batch in batches:
            for first, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if first and held:
                    close()
                held.append(tuple(row))
            if done:
                yield out()
        if held:
            close()
            yield out()

    first = F.row_number().over(Window.partitionBy("file_name").orderBy(order)) == 1
    rows = chunks.select(first.alias("first"), F.col("file_name").cast("string").alias("file_name"), "markdown", "block_type", "trim", "chunk_id")
    return rows.mapInArrow(run, RESULT)
