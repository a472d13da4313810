"""Token-id files: documents in key order, each shard compressed by a Re-Pair grammar.

Re-Pair: pairs of neighbouring symbols that stand ``least`` times or more are replaced by
nonterminals, again and again, until no such pair is left.  A round replaces many pairs at once: a
pair wins a place if it is more frequent than the pairs that overlap it there, so no order has to
be walked; the most frequent pair wins all its places, so every round gets on.  Pairs never cross
documents.  A pair that falls below ``least`` comes back only if it holds a symbol that a later round has used
again, so rounds look at places that are still in play, and at those of such symbols at the end.

A shard holds about ``SHARD_TOKENS`` ids, which bounds what a grammar needs in memory, and stores its
rules, their expansion lengths and its symbols: any id range of any document is decoded by walking
down the rules that cover it, and nothing else is expanded.

Shards follow each other within the ranges of ``repartitionByRange`` over the key.  Files are rows of
a table in the shared folder (any store that Spark can write), and a document's global start is two
small prefix sums: over ranges, and over a range's shards.

Ids are the tokenizers library's for the whole text; the string of an added token gets that token's
id, as the library does unless told otherwise.

Defined results: null text is empty (its only id is the end id); a text of any length is one document
of one shard; a null key comes first; rows that repeat a key are ordered by text; further columns are
not read; an empty table writes no shard.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, passes, table, utf8, written
from .tokens import ENCODE_BYTES, encoder, vocabulary

SHARD_TOKENS = 1 << 18
#: Times that a pair stands in a shard to become a rule.  A rule takes as much room as four of its uses save; on the test
#: corpus rules of 8 to 11 uses saved 3 % of a shard and took a quarter of the time.
LEAST = 12
END_ID = 0
_MAGIC = b"QRP1"


def _overlaps(after: np.ndarray, live: np.ndarray, double: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """Of the pairs ``double`` of one symbol twice, those that overlap an equal pair before them: in a run, every other."""
    if not len(double):
        return double
    where, what = live[double], symbol[double]
    begins = np.concatenate(([True], (after[where[:-1]] != where[1:]) | (what[1:] != what[:-1])))
    nth = np.arange(len(where)) - np.flatnonzero(begins)[np.cumsum(begins) - 1]
    return double[nth % 2 == 1]


def repair(ids: np.ndarray, last: np.ndarray, first_rule: int, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, rules, last): the grammar of ``ids``; rule i is symbol ``first_rule + i``.

    ``last`` marks ids that end a document: no pair starts there.  At the end no pair stands
    ``least`` times (occurrences that overlap an equal one don't count).
    """
    seq, last = ids.astype(np.uint32), last.copy()
    last[-1:] = True
    # symbols are a linked list, so a round costs what is in play and not the whole sequence
    after, before, gone = np.arange(1, len(seq) + 1, dtype=np.int64), np.arange(-1, len(seq), dtype=np.int64), np.zeros(len(seq), bool)
    pairs: list[np.ndarray] = []
    number: dict[int, int] = {}  # rule of each pair
    again = np.zeros(2 * first_rule + 2, bool)  # rules that were used in a later round than their own
    live = np.flatnonzero(~last[:-1])
    # most pairs are rare: a count by hash, never below the true one, drops them at once
    slot = (seq[live] * np.uint32(0x9E3779B1) ^ seq[after[live]] * np.uint32(0x85EBCA6B)) >> np.uint32(13)
    live = live[np.bincount(slot, minlength=1 << 19)[slot] >= least]
    while True:
        a, b = seq[live], seq[after[live]]
        coded = pa.array((a.astype(np.uint64) << np.uint64(32)) | b).dictionary_encode()
        code, kinds = coded.indices.to_numpy(), coded.dictionary.to_numpy()
        overlaps = _overlaps(after, live, np.flatnonzero(a == b), a)
        count = np.bincount(code, minlength=len(kinds)) - np.bincount(code[overlaps], minlength=len(kinds))
        stands = count[code]
        strong = stands >= least
        strong[overlaps] = False
        at, own, code = live[strong], stands[strong], code[strong].astype(np.int64)
        if not len(at):
            if not again.any():
                break
            # pairs of these symbols may have become frequent after they fell out of play
            live = np.flatnonzero(~gone & ~last)
            live = live[again[seq[live]] | again[seq[after[live]]]]
            again[:] = False
            continue
        live = live[stands >= least]
        # ties in scattered order, else of a copied passage, whose pairs are equally frequent, one place a round would win
        rank = own << 32 | code * 0x9E3779B1 & 0xFFFFFFFF
        near = after[at[:-1]] == at[1:]
        wins = np.ones(len(at), bool)
        wins[1:] &= ~near | (rank[1:] > rank[:-1])
        wins[:-1] &= ~near | (rank[:-1] > rank[1:])
        at, code = at[wins], code[wins]
        used = np.bincount(code, minlength=len(kinds))
        some = np.flatnonzero(used)
        rule = np.full(len(kinds), -1, np.int64)
        rule[some] = np.fromiter((number.get(k, -1) for k in kinds[some].tolist()), np.int64, len(some))
        again[rule[some]] = True  # the last slot stands for none
        new = some[(rule[some] < 0) & (used[some] >= least)]
        rule[new] = first_rule + len(number) + np.arange(len(new))
        pairs.append(kinds[new])
        number.update(zip(kinds[new].tolist(), rule[new].tolist(), strict=True))
        again[-1] = False
        if first_rule + len(number) >= len(again):
            again = np.append(again, np.zeros(len(again) + len(number), bool))
        ok = rule[code] >= 0
        at, code = at[ok], code[ok]
        second = after[at]
        seq[at], last[at], gone[second] = rule[code], last[second], True
        after[at] = after[second]
        before[after[second]] = at
        # in play: what was, and what stands before or at a new symbol
        ahead = before[at]
        live = np.sort(np.concatenate((live[~gone[live]], at, ahead[ahead >= 0])))
        live = live[np.concatenate((live[1:] != live[:-1], [True])) & ~last[live]]
    seq, last = seq[~gone], last[~gone]
    flat = np.concatenate(pairs) if pairs else np.zeros(0, np.uint64)
    return seq, np.stack([flat >> np.uint64(32), flat & np.uint64(0xFFFFFFFF)], axis=1).astype(np.uint32), last


def _levels(rules: np.ndarray, first_rule: int) -> Iterator[tuple[int, int]]:
    """Ranges of rules whose children all stand before the range (one per round that made rules)."""
    top = np.maximum.accumulate(rules.max(axis=1).astype(np.int64)) - first_rule if len(rules) else np.zeros(0, np.int64)
    lo = 0
    while lo < len(rules):
        hi = int(np.searchsorted(top, lo, "left"))
        yield lo, hi
        lo = hi


@dataclass
class Shard:
    """One decoded header of a shard; ``symbols`` still are grammar symbols."""

    keys: list[int | None]
    symbol_ends: np.ndarray
    token_ends: np.ndarray
    first_rule: int
    rules: np.ndarray
    lengths: np.ndarray
    symbols: np.ndarray

    @classmethod
    def of(cls, keys: list[int | None], ids: np.ndarray, counts: np.ndarray, vocabulary_size: int) -> Shard:
        """The shard of documents that have ``counts`` of ``ids`` each (one at least)."""
        token_ends = np.cumsum(counts)
        last = np.zeros(len(ids), bool)
        last[token_ends - 1] = True
        symbols, rules, last = repair(ids, last, vocabulary_size)
        lengths = np.ones(len(rules), np.uint32)
        for lo, hi in _levels(rules, vocabulary_size):
            child = rules[lo:hi].astype(np.int64) - vocabulary_size
            lengths[lo:hi] = np.where(child >= 0, lengths[np.maximum(child, 0)], 1).sum(axis=1)
        return cls(keys, np.flatnonzero(last) + 1, token_ends, vocabulary_size, rules, lengths, symbols)

    def dump(self) -> bytes:
        """Header, keys (with a null mask), document ends, rules, expansion lengths, symbols of three or four bytes."""
        width = 3 if len(self.rules) + self.first_rule < 1 << 24 else 4
        head = _MAGIC + struct.pack("<IIIQB", len(self.keys), self.first_rule, len(self.rules), len(self.symbols), width)
        keys = np.array([0 if k is None else k for k in self.keys], "<i8")
        null = np.array([k is None for k in self.keys], np.uint8)
        packed = self.symbols.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width]
        return b"".join([head, keys.tobytes(), null.tobytes(), self.symbol_ends.astype("<u8").tobytes(), self.token_ends.astype("<u8").tobytes(), self.rules.astype("<u4").tobytes(), self.lengths.astype("<u4").tobytes(), np.ascontiguousarray(packed).tobytes()])

    @classmethod
    def load(cls, data: bytes) -> Shard:
        if data[:4] != _MAGIC:
            raise ValueError("not a token shard")
        docs, first_rule, n_rules, n, width = struct.unpack_from("<IIIQB", data, 4)
        at = 4 + struct.calcsize("<IIIQB")

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(data, kind, count, at)
            at += got.nbytes
            return got

        keys, null = take("<i8", docs), take("u1", docs)
        symbol_ends, token_ends = take("<u8", docs).astype(np.int64), take("<u8", docs).astype(np.int64)
        rules, lengths = take("<u4", 2 * n_rules).reshape(-1, 2), take("<u4", n_rules)
        wide = np.zeros((n, 4), np.uint8)
        wide[:, :width] = take("u1", n * width).reshape(n, width)
        return cls([None if z else k for k, z in zip(keys.tolist(), null.tolist(), strict=True)], symbol_ends, token_ends, first_rule, rules, lengths, wide.view("<u4").ravel())

    def _table(self) -> tuple[np.ndarray, np.ndarray]:
        """Every rule's expansion in a row, and where each begins; built once, rules in order."""
        if not hasattr(self, "_flat"):
            self._begin = np.cumsum(self.lengths, dtype=np.int64) - self.lengths
            self._flat = np.zeros(0, np.uint32)
            for lo, hi in _levels(self.rules, self.first_rule):
                # children are expanded already
                self._flat = np.concatenate((self._flat, self.expand(self.rules[lo:hi].ravel())))
        return self._flat, self._begin

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        flat, begin = self._table() if not hasattr(self, "_flat") else (self._flat, self._begin)
        is_rule = symbols >= self.first_rule
        rule = np.where(is_rule, symbols.astype(np.int64) - self.first_rule, 0)
        length = np.ones(len(symbols), np.int64)
        length[is_rule] = self.lengths[rule[is_rule]]
        ends = np.cumsum(length)
        out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint32)
        out[(ends - 1)[~is_rule]] = symbols[~is_rule]
        n = length[is_rule]
        total = np.cumsum(n) - n
        step = np.arange(int(n.sum()))
        out[np.repeat((ends - length)[is_rule] - total, n) + step] = flat[np.repeat(begin[rule[is_rule]] - total, n) + step]
        return out

    def _lengths(self, symbols: np.ndarray) -> np.ndarray:
        length = np.ones(len(symbols), np.int64)
        is_rule = symbols >= self.first_rule
        length[is_rule] = self.lengths[symbols[is_rule].astype(np.int64) - self.first_rule]
        return length

    def span(self, doc: int, lo: int, hi: int) -> np.ndarray:
        """Ids lo to hi (exclusive) of one document: rules are walked down, those outside the range left alone."""
        symbols = self.symbols[int(self.symbol_ends[doc - 1]) if doc else 0 : int(self.symbol_ends[doc])]
        begin = np.cumsum(self._lengths(symbols)) - self._lengths(symbols)
        lo = max(0, lo)
        while True:
            inside = (begin < hi) & (begin + self._lengths(symbols) > lo)
            symbols, begin = symbols[inside], begin[inside]
            is_rule = symbols >= self.first_rule
            if not is_rule.any():
                return symbols.astype(np.uint32)
            place = np.cumsum(1 + is_rule) - 1 - is_rule
            child = self.rules[symbols[is_rule].astype(np.int64) - self.first_rule]
            wide, start = np.empty(len(symbols) + int(is_rule.sum()), np.uint32), np.empty(len(symbols) + int(is_rule.sum()), np.int64)
            wide[place[~is_rule]], start[place] = symbols[~is_rule], begin
            wide[place[is_rule]], wide[place[is_rule] + 1] = child[:, 0], child[:, 1]
            start[place[is_rule] + 1] = begin[is_rule] + self._lengths(child[:, 0])
            symbols, begin = wide, start

    def documents(self, most: int = 1 << 18) -> Iterator[tuple[int, np.ndarray]]:
        """(document number, its ids) of the whole shard, some symbols at a time."""
        for lo, hi in passes(np.concatenate(([0], self.symbol_ends)), most):
            ids = self.expand(self.symbols[int(self.symbol_ends[lo - 1]) if lo else 0 : int(self.symbol_ends[hi - 1])])
            base = int(self.token_ends[lo - 1]) if lo else 0
            begin = base
            for doc in range(lo, hi):
                end = int(self.token_ends[doc])
                yield doc, ids[begin - base : end - base]
                begin = end


def write(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", lower: bool = False, end_id: int = END_ID, vocabulary_size: int | None = None, ranges: int | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """A written table of shards (part, shard, n_tokens, data), documents in ascending key order."""
    ranged = docs.select(F.col(key).cast("bigint").alias(key), text).repartitionByRange(ranges or partitions(docs.sparkSession), F.col(key).asc_nulls_first())
    ranged = ranged.sortWithinPartitions(F.col(key).asc_nulls_first(), text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, lower)
        size = vocabulary_size or coder.tokenizer.get_vocab_size(True)
        part, number = TaskContext.get().partitionId(), 0
        keys: list[int | None] = []
        held: list[np.ndarray] = []
        lengths: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            ids, counts = np.concatenate(held), np.concatenate(lengths)
            data = Shard.of(list(keys), ids, counts, size).dump()
            keys.clear(), held.clear(), lengths.clear()
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([data], pa.binary())], ["part", "shard", "n_tokens", "data"])

        for batch in batches:
            off, _ = utf8(batch.column(1))
            for lo, hi in passes(off, ENCODE_BYTES):
                ids, counts = coder.encode(batch.column(1).slice(lo, hi - lo))
                counts = counts + 1
                full = np.full(int(counts.sum()), end_id, np.int32)
                own = np.ones(len(full), bool)
                own[np.cumsum(counts) - 1] = False
                full[own] = ids
                own_keys, ends = batch.column(0).slice(lo, hi - lo).to_pylist(), np.concatenate(([0], np.cumsum(counts)))
                at = 0
                while at < hi - lo:  # as many documents as the shard still has room for, one at least
                    room = shard_tokens - sum(map(len, held))
                    to = max(at + 1, int(np.searchsorted(ends, ends[at] + room, "right")) - 1)
                    keys += own_keys[at:to]
                    held.append(full[ends[at] : ends[to]])
                    lengths.append(counts[at:to])
                    at = to
                    if sum(map(len, held)) >= shard_tokens or at < hi - lo:
                        yield flush()
                        number += 1
        if keys:
            yield flush()

    return written(ranged.mapInArrow(run, "part int, shard int, n_tokens bigint, data binary"), "tokens")


def read(shards: DataFrame, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """(key, start, n_tokens, ids_crc32, and the ids on demand) of every document, decoded from the shards."""
    names = ["part", "shard", key, "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard = Shard.load(batch.column(2)[row].as_py())
                ends = shard.token_ends
                crc, ids = [], []
                for _, got in shard.documents():
                    crc.append(zlib.crc32(got.astype("<u4", copy=False)))
                    if with_ids:
                        ids.append(got.astype(np.int64))
                n = len(ends)
                cols = [pa.array(np.full(n, batch.column(i)[row].as_py(), np.int32)) for i in range(2)]
                cols += [pa.array(shard.keys, pa.int64()), pa.array(np.concatenate(([0], ends[:-1]))), pa.array(np.diff(ends, prepend=0)), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(cols + ([pa.array(ids, pa.list_(pa.int64()))] if with_ids else []), names)

    rows = shards.select("part", "shard", "data").mapInArrow(run, f"part int, shard int, `{key}` bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids)
    sizes = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    parts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select("part", "shard", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("shard_start")).join(parts, "part")
    met = rows.join(starts, ["part", "shard"])
    return met.select(key, (F.col("part_start") + F.col("shard_start") + F.col("start")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def op4(spark, sf_dir: str) -> DataFrame:
    return read(write(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json")))
