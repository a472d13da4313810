"""Best-fit packing of token pieces into sequences: bounded space, online.

A fixed number of bins is open per task.  Their free spaces are a bitset (one big integer, bit f
for free space f), so the tightest open bin for a piece is the lowest set bit at or above its
length.  A piece that fits nowhere opens a bin; if that is one too many, the fullest bin closes
first.  Tasks pack their own documents and never exchange texts.

Bins that are still open when a task ends are packed once more: as items of their own size, those of
``MERGED_TASKS`` tasks at a time, by the same rule, largest first.  So small tasks don't leave
part-filled sequences behind, and no merge holds more than ``open_bins`` small rows of each task.

Ids are the tokenizers library's for the whole text; the string of an added token gets that token's
id, as the library does unless told otherwise.

Defined results: null text is empty and gives one piece, the end id; documents are cut only beyond
the capacity, into whole sequences and one last shorter piece, whatever their length; rows that
repeat a doc_id are packed like any others; further columns are not read; an empty table gives no
rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import passes, table, utf8, written
from .tokens import ENCODE_BYTES, encoder, vocabulary

CAPACITY = 4096
OPEN_BINS = 256
END_ID = 1
#: Tasks whose open bins are packed together at the end.
MERGED_TASKS = 64
#: Bits of a sequence number below the task's.
_BIN_BITS = 36


class BestFit:
    """Places lengths one by one; at most ``open_bins`` bins are open at a time."""

    def __init__(self, capacity: int = CAPACITY, open_bins: int = OPEN_BINS):
        self.capacity, self.most = capacity, open_bins
        self.bits = self.n_open = self.n_bins = 0
        self.by_free: dict[int, list[int]] = {}

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        found = bins.pop()
        if not bins:
            del self.by_free[free]
            self.bits &= ~(1 << free)
        self.n_open -= 1
        return found

    def place(self, length: int) -> tuple[int, int]:
        """(bin number, offset in it) for a piece of 1 to ``capacity`` tokens."""
        if not 0 < length <= self.capacity:
            raise ValueError(f"a piece of {length} tokens doesn't fit in {self.capacity}")
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            chosen = self._take(free)
        else:
            free, chosen = self.capacity, self.n_bins
            self.n_bins += 1
        left = free - length
        if left:
            if self.n_open == self.most:
                fullest = (self.bits & -self.bits).bit_length() - 1
                if fullest <= left:
                    self._take(fullest)
                else:  # the bin just filled is the fullest: it closes
                    return chosen, self.capacity - free
            self.by_free.setdefault(left, []).append(chosen)
            self.bits |= 1 << left
            self.n_open += 1
        return chosen, self.capacity - free

    def still_open(self) -> list[tuple[int, int]]:
        """(bin number, tokens in it) of the bins that are open."""
        return [(b, self.capacity - free) for free, bins in self.by_free.items() for b in bins]


def _merged(left: DataFrame, capacity: int, open_bins: int) -> DataFrame:
    """(sequence_id, merged_id, shift) of open bins (sequence_id, length) that share a sequence with an earlier one."""

    def run(group: pa.Table) -> pa.Table:
        bins, rows, names = BestFit(capacity, open_bins), [], {}
        size, number = group.column("length").to_numpy(), group.column("sequence_id").to_numpy()
        for i in np.lexsort((number, -size)).tolist():
            chosen, shift = bins.place(int(size[i]))
            first = names.setdefault(chosen, int(number[i]))
            if shift:
                rows.append((int(number[i]), first, shift))
        return pa.table([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], names=["sequence_id", "merged_id", "shift"])

    group = F.shiftright("sequence_id", _BIN_BITS + MERGED_TASKS.bit_length() - 1).alias("group")
    return left.select(group, "sequence_id", "length").groupBy("group").applyInArrow(run, "sequence_id bigint, merged_id bigint, shift bigint")


def pack(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, open_bins: int = OPEN_BINS, end_id: int = END_ID, lower: bool = True, with_ids: bool = False) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32, sequence_id, offset (and ``ids``).

    ``path`` is a tokenizers file; ``lower`` says whether it folds case and drops white space.
    """
    kind = docs.schema[key].dataType.simpleString()
    names = [key, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, bins = encoder(path, lower).encode, BestFit(capacity, open_bins)
        first = TaskContext.get().partitionId() << _BIN_BITS
        for batch in batches:
            off, _ = utf8(batch.column(1))
            # half of what op 4 takes at a time: here the tasks of other stages have filled the executor before
            for lo, hi in passes(off, ENCODE_BYTES // 2):
                ids, counts = encode(batch.column(1).slice(lo, hi - lo))
                at, rows = 0, []
                for doc, n in enumerate(counts.tolist()):
                    own = np.append(ids[at : at + n], np.int32(end_id)).astype("<u4")
                    at += n
                    for piece, start in enumerate(range(0, n + 1, capacity)):
                        part = own[start : start + capacity]
                        rows.append((doc, piece, start, len(part), zlib.crc32(part), *bins.place(len(part)), part))
                cols = list(zip(*rows, strict=True))
                out = [
                    batch.column(0).slice(lo, hi - lo).take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64()),
                    pa.array(cols[4], pa.int64()), pa.array([first + b for b in cols[5]], pa.int64()), pa.array(cols[6], pa.int64()),
                ]
                if with_ids:
                    out.append(pa.array([p.astype(np.int64) for p in cols[7]], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(out, names)
        # the open bins, as rows without a piece
        left, kinds = bins.still_open(), [t.type for t in (out if bins.n_bins else [])]
        if left:
            none = [None] * len(left)
            values = {"length": [n for _, n in left], "sequence_id": [first + b for b, _ in left]}
            yield pa.RecordBatch.from_arrays([pa.array(values.get(c, none), k) for c, k in zip(names, kinds, strict=True)], names)

    schema = f"`{key}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint" + ", ids array<bigint>" * with_ids
    placed = written(docs.select(key, text).mapInArrow(run, schema), "pieces")
    moved = _merged(placed.where("piece is null").select("sequence_id", "length"), capacity, open_bins)
    met = placed.where("piece is not null").join(moved, "sequence_id", "left")
    again = {"sequence_id": F.coalesce("merged_id", "sequence_id"), "offset": F.col("offset") + F.coalesce("shift", F.lit(0))}
    return met.select(*(again[c].alias(c) if c in again else F.col(f"`{c}`") for c in names))


def op6(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
