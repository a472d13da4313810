"""Repeated 200-byte strings by prefix-free parsing and suffix arrays.

1. Parse.  A rolling hash over ``GRAM`` bytes marks triggers: a position is one if its hash is the
   least (leftmost of equals) among the ``MATCH - GRAM + 1`` positions of some window of ``MATCH``
   bytes.  Every window so has exactly one trigger, fixed by its content alone, and the windows
   that share a trigger occurrence are consecutive.  A *phrase* is their text: from the first of
   those windows to the end of the last, so phrases overlap by ``MATCH - 1`` bytes and no match
   ever needs to look beyond one.
2. Dictionary and parse.  Blocks count their triggers and distinct phrases over the corpus by
   hash.  A window whose trigger occurs once is unique.  A phrase that occurs twice repeats with
   all its windows, wherever it stands: highly repetitive text is settled here.
3. Suffix arrays.  What is left are phrases that occur once but share a trigger.  They, and one
   copy of each repeated phrase with such a trigger, go to the shard of their trigger as text.
   Each shard sorts the suffixes of its dictionary by prefix doubling up to ``MATCH`` bytes; in
   that order equal windows are neighbours of equal rank, compared byte by byte, not by hash.
   Since all occurrences of a window share its trigger, they meet in one shard, and the parse's
   multiplicities settle windows of repeated phrases.
4. Spans of repeated windows go back to their block, where their bytes are removed.

Hot triggers (a passage in a third of all rows): around it every document has phrases of its own that
begin or end inside the passage, all with one trigger.  Of a trigger that occurs more than ``HOT``
times no text is gathered: each window of such a phrase is counted by the hash of its 200 bytes.  These
are at most ``MATCH - GRAM + 1`` numbers per phrase, so they grow with the text and not with its square;
a block holds each of its windows once and sends them as one piece per shard.

The parse contributes multiplicities and places; its own suffix array is not built, since phrases already
reach past every match, so that it could only order equal windows among themselves.

Defined results: null text is empty; texts below ``MATCH`` bytes lose nothing; equal texts of at
least ``MATCH`` bytes lose everything; overlapping occurrences count; a text of any length is cut whole; rows that
repeat a doc_id are documents of their own; further columns are not read; an empty table gives no rows.
Phrases (step 2) and windows of hot triggers are told apart by hashes of 62 bits with drawn bases; all other windows are
compared byte by byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import bytewords as bw
from .blocks import ask
from .common import drop_written, passes, table, utf8, written

MATCH = 200
#: Bytes of a trigger: long enough that a larger corpus holds few of them twice by chance, which only costs time.
GRAM = 44
BLOCK_BYTES = 16 << 20
#: Occurrences of a trigger above which its windows are dealt more finely.
HOT = 2000
#: Bytes of phrases in a shard, about.
SHARD_BYTES = 2 << 20
#: Windows of hot triggers in a shard, about.
SHARD_WINDOWS = 1 << 21


def window_triggers(h: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` consecutive positions, the leftmost position of the least hash (its upper 40 bits)."""
    step = 1 << 23  # so that a position fits in the 24 bits below the hash
    parts = [lo + _least(h[lo : lo + step + width - 1], width) for lo in range(0, max(0, len(h) - width + 1), step)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _least(h: np.ndarray, width: int) -> np.ndarray:
    n, low = len(h), np.uint64((1 << 24) - 1)
    rows = -(-n // width)
    grid = np.full((rows, width), np.iinfo(np.uint64).max, np.uint64)
    grid.ravel()[:n] = (h & ~low) | np.arange(n, dtype=np.uint64)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(behind[: n - width + 1], ahead[width - 1 : n]) & low).astype(np.int64)


def parse(off: np.ndarray, data: np.ndarray, match: int = MATCH, gram: int = GRAM) -> dict[str, np.ndarray]:
    """Phrases of all documents: start of the first and one past the last window start, trigger position, hashes of trigger and phrase."""
    none = np.zeros(0, np.int64)
    if len(data) < match:
        return {"start": none, "stop": none, "at": none, "trigger": none.astype(np.uint64), "phrase": none.astype(np.uint64)}
    prefix = bw.prefix_hash(data)
    h = bw.rolling_hash(data, gram)
    at = window_triggers(h, match - gram + 1)
    # window starts that stay inside their document
    step = np.zeros(len(at) + 1, np.int64)
    size = np.diff(off)
    long = size >= match
    np.add.at(step, off[:-1][long], 1)
    np.add.at(step, off[1:][long] - match + 1, -1)
    i = np.flatnonzero(np.cumsum(step[:-1]) > 0)
    if not len(i):
        return parse(np.zeros(1, np.int64), data[:0], match, gram)
    a = at[i]
    first = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (i[1:] != i[:-1] + 1))))
    start, stop = i[first], np.append(i[first[1:] - 1], i[-1]) + 1
    at = a[first]
    return {"start": start, "stop": stop, "at": at, "trigger": h[at], "phrase": bw.mix(bw.span_hash(prefix, start, stop + match - 1) + (at - start).astype(np.uint64))}


def _packed(data: bytes) -> bytes:
    return bytes(pa.Codec("zstd", compression_level=6).compress(data))


def _unpacked(data: bytes, size: int) -> bytes:
    return pa.decompress(data, decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def blocks(docs: DataFrame, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A written table of blocks: ids, document ends, text. All that is derived from a block is computed where it is needed."""
    names = ["block", "ids", "ends", "text"]
    kind = docs.schema[key].dataType
    id_type = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, size = TaskContext.get().partitionId(), 0, 0
        ids: list = []
        texts: list[bytes] = []
        lengths: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            ends = np.cumsum(np.concatenate(lengths))
            values = [[(part << 32) + number], [list(ids)], [ends.astype("<i8").tobytes()], [_packed(b"".join(texts))]]
            ids.clear(), texts.clear(), lengths.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, (pa.int64(), pa.list_(id_type), pa.binary(), pa.binary()), strict=True)], names)

        for batch in batches:
            off, data = utf8(batch.column(1))
            for lo, hi in passes(off):
                ids += batch.column(0).slice(lo, hi - lo).to_pylist()
                texts.append(data[off[lo] : off[hi]].tobytes())
                lengths.append(np.diff(off[lo : hi + 1]))
                size += int(off[hi] - off[lo])
                if size >= block_bytes:
                    yield flush()
                    number, size = number + 1, 0
        if ids:
            yield flush()

    schema = f"block bigint, ids array<{kind.simpleString()}>, ends binary, text binary"
    return written(docs.select(F.col(key), text).mapInArrow(run, schema), "suffixblocks")


def _opened(ends: bytes, text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Document offsets and bytes of a block."""
    off = np.concatenate(([0], np.frombuffer(ends, "<i8")))
    return off, np.frombuffer(_unpacked(text, int(off[-1])), np.uint8)


def _phrases(off: np.ndarray, data: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """A block's phrases (trigger and phrase as codes), its distinct hashes of both, and how often it holds each."""
    found = []
    for lo, hi in passes(off):
        p = parse(off[lo : hi + 1] - off[lo], data[off[lo] : off[hi]])
        found.append({k: v + off[lo] if k in ("start", "stop", "at") else v for k, v in p.items()})
    p = {k: np.concatenate([f[k] for f in found]) for k in found[0]}
    words, codes, counts = np.unique(np.concatenate((bw.mix(p["trigger"] ^ np.uint64(0x51)), p["phrase"])), return_inverse=True, return_counts=True)
    n = len(p["start"])
    return p | {"trigger": codes[:n], "phrase": codes[n:]}, words, counts


def _asked(ends: bytes, text: bytes) -> tuple[np.ndarray, np.ndarray]:
    return _phrases(*_opened(ends, text))[1:]


def _runs(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each run, one run after the other."""
    return np.repeat(start - np.cumsum(n) + n, n) + np.arange(int(n.sum()))


def _windows(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Content hashes of the windows that start in ranges, range by range."""
    size, out = stop - start + MATCH - 1, [np.zeros(0, np.uint64)]
    off = np.concatenate(([0], np.cumsum(size)))
    for lo, hi in passes(off):
        own = data[_runs(start[lo:hi], size[lo:hi])]
        at = _runs(off[lo:hi] - off[lo], size[lo:hi] - MATCH + 1)
        out.append(bw.span_hash(bw.prefix_hash(own), at, at + MATCH))
    return np.concatenate(out)


def _piece(keys: np.ndarray, twice: np.ndarray, held: np.ndarray, places: np.ndarray) -> bytes:
    """Distinct windows: hash, whether it is known to repeat, in how many places it stands; the places."""
    return b"".join((keys.astype("<u8").tobytes(), twice.astype("u1").tobytes(), held.astype("<u4").tobytes(), places.astype("<i4").tobytes()))


def _opened_piece(raw: bytes, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(raw, "<u8", n), np.frombuffer(raw, "u1", n, 8 * n), np.frombuffer(raw, "<u4", n, 9 * n), np.frombuffer(raw, "<i4", -1, 13 * n)


def _merge(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open ranges, touching ones joined."""
    if not len(start):
        return start, stop
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(stop[order])
    first = np.concatenate(([True], start[1:] > reach[:-1]))
    return start[first], reach[np.append(np.flatnonzero(first)[1:] - 1, len(start) - 1)]


def sift(parsed: DataFrame, answers: DataFrame, hot: int = HOT) -> DataFrame:
    """A written table: spans of windows known to repeat (key null), windows of hot triggers (start -1: one row per block, its distinct windows by hash as ``text``, their number as ``stop``), and phrases that suffix arrays decide (key, text, single)."""
    names = ["block", "start", "stop", "key", "single", "text"]

    def run(block: pa.Table, known: pa.Table) -> pa.Table:
        number = block.column("block")[0].as_py()
        off, data = _opened(block.column("ends")[0].as_py(), block.column("text")[0].as_py())
        p, words, _ = _phrases(off, data)
        start, stop, at, trigger, phrase = (p[k] for k in ("start", "stop", "at", "trigger", "phrase"))
        # only counts above one are sent back
        counts, first = np.ones(len(words), np.int64), np.ones(len(words), bool)
        code = known.column("code").to_numpy()
        counts[code] = known.column("c").to_numpy()
        first[code] = known.column("first").to_numpy(zero_copy_only=False)
        whole = counts[phrase] >= 2
        s, e = _merge(start[whole], stop[whole])
        rows: list[tuple] = [(number, a, b, None, None, None) for a, b in zip(s.tolist(), e.tolist(), strict=True)]
        # phrases of their own whose trigger others have too; of repeated phrases with such a trigger one copy
        copy = np.zeros(len(start), bool)
        copy[np.unique(phrase, return_index=True)[1]] = True
        wanted = (counts[trigger] > counts[phrase]) & (~whole | copy & first[phrase])
        hot_ones = wanted & (counts[trigger] > hot)
        for i in np.flatnonzero(wanted & ~hot_ones).tolist():
            a, b = int(start[i]), int(stop[i])
            rows.append((number, a, b, int(words[trigger[i]]) & 0x7FFFFFFFFFFFFFFF, not whole[i], data[a : b + MATCH - 1].tobytes()))
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.binary()]
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
        out = [pa.table([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)]
        some = np.flatnonzero(hot_ones)
        if len(some):
            n = (stop - start)[some]
            first, keys, alone = _runs(start[some], n), _windows(data, start[some], stop[some]), np.repeat(~whole[some], n)
            # each window of the block once: whether it repeats already, and where it stands in phrases of their own
            order = np.argsort(keys, kind="stable")
            begin = np.flatnonzero(np.concatenate(([True], keys[order][1:] != keys[order][:-1])))
            weight, held = np.add.reduceat(np.where(alone, 1, 2)[order], begin), np.add.reduceat(alone[order].astype(np.int64), begin)
            values = [number, -1, len(begin), number, True, _piece(keys[order][begin], weight > 1, held, first[order][alone[order]])]
            out.append(pa.table([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names))
        return pa.concat_tables(out)

    left = parsed.select("block", "ends", "text").groupBy("block")
    right = answers.groupBy("block")
    return written(left.cogroup(right).applyInArrow(run, "block bigint, start int, stop int, key bigint, single boolean, text binary"), "phrases")


def repeated_windows(texts: list[bytes], single: np.ndarray, match: int = MATCH) -> list[np.ndarray]:
    """For each text, which of its windows stand in another text too, twice in one, or in a text that isn't ``single``.

    The suffixes of the texts (at least ``match`` bytes each) are ranked by their first 8 bytes, then
    by doubling up to ``match``; equal ranks are equal strings.
    """
    size = np.array([len(t) for t in texts], np.int64)
    end = np.cumsum(size)
    data = np.frombuffer(b"".join(texts) + bytes(8), np.uint8)
    n = int(end[-1])
    left = np.repeat(end, size) - np.arange(n)  # bytes from here to the end of the text
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | data[k : k + n]
    place = np.flatnonzero(left >= 8)
    rank = np.zeros(n, np.int64)
    rank[place] = np.unique(key[place], return_inverse=True)[1]
    length = 8
    while length < match:
        step = min(length, match - length)
        place = np.flatnonzero(left >= length + step)
        pair = rank[place] * (n + 1) + rank[place + step]
        rank = np.zeros(n, np.int64)
        rank[place] = np.unique(pair, return_inverse=True)[1]
        length += step
    weight = np.repeat(np.where(single, 1, 2), np.maximum(size - match + 1, 0))
    count = np.bincount(rank[place], weights=weight)
    many = count[rank[place]] >= 2
    return np.split(many, np.cumsum(size - match + 1)[:-1])


def decide(phrases: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(block, start, stop): spans of repeated windows in the phrases of ``sift`` that occur once."""
    rows = phrases.where("text is not null and start >= 0")
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    shards = max(1, -(-total // shard_bytes))

    def run(shard: pa.Table) -> pa.Table:
        texts = shard.column("text").to_pylist()
        single = shard.column("single").to_numpy(zero_copy_only=False)
        block, start = shard.column("block").to_numpy(), shard.column("start").to_numpy()
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for i, many in enumerate(repeated_windows(texts, single)):
            if single[i] and many.any():
                edge = np.flatnonzero(np.diff(np.concatenate(([0], many.astype(np.int8), [0]))))
                out.append((np.full(len(edge) // 2, block[i]), start[i] + edge[::2], start[i] + edge[1::2]))
        cols = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1].astype(np.int32)), pa.array(cols[2].astype(np.int32))], names=["block", "start", "stop"])

    dealt = rows.select(F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"), "block", "start", "single", "text")
    return dealt.groupBy("shard").applyInArrow(run, "block bigint, start int, stop int")


def counted_windows(phrases: DataFrame, shard_windows: int = SHARD_WINDOWS) -> DataFrame:
    """(block, places): where windows of hot triggers stand that stand elsewhere too; a window of a repeated phrase counts twice."""
    rows = phrases.where("start = -1").select("block", "stop", "text")
    total = rows.agg(F.coalesce(F.sum("stop"), F.lit(0)).alias("n")).first().n
    shards = max(1, -(-total // shard_windows))
    names = ["shard", "block", "n", "body"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, n, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                keys, twice, held, places = _opened_piece(raw, n)
                shard = ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)  # rises with the key
                ends = np.concatenate(([0], np.cumsum(held, dtype=np.int64)))
                edge = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1], [True]))).tolist()
                for lo, hi in zip(edge, edge[1:]):
                    body = _piece(keys[lo:hi], twice[lo:hi], held[lo:hi], places[ends[lo] : ends[hi]])
                    yield pa.RecordBatch.from_arrays([pa.array([int(shard[lo])]), pa.array([block]), pa.array([hi - lo]), pa.array([body], pa.binary())], names)

    def run(group: pa.Table) -> pa.Table:
        parts = [_opened_piece(raw, n) for raw, n in zip(group.column("body").to_pylist(), group.column("n").to_pylist(), strict=True)]
        _, which = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        weight = np.bincount(which, weights=1 + np.concatenate([p[1] for p in parts]))
        many = np.split(weight[which] > 1, np.cumsum([len(p[0]) for p in parts])[:-1])
        found = [places[np.repeat(m, held)].tobytes() for m, (_, _, held, places) in zip(many, parts, strict=True)]
        return pa.table([group.column("block"), pa.array(found, pa.binary())], names=["block", "places"])

    return rows.mapInArrow(cut, "shard bigint, block bigint, n bigint, body binary").groupBy("shard").applyInArrow(run, "block bigint, places binary")


def remove(parsed: DataFrame, spans: DataFrame, key: str = "doc_id", with_text: bool = False) -> DataFrame:
    """Per document: n_bytes, n_removed, n_spans, kept_sha256 (and the bytes that stay) without all bytes of repeated windows."""
    names = [key, "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text
    kind = parsed.schema["ids"].dataType.elementType
    kinds = [to_arrow_type(kind), *[pa.int64()] * 3, pa.string()] + [pa.binary()] * with_text

    def run(block: pa.Table, found: pa.Table) -> pa.Table:
        off, data = _opened(block.column("ends")[0].as_py(), block.column("text")[0].as_py())
        data = data.tobytes()
        # windows never cross documents, so neither do the byte ranges they cover; ranges that touch at a
        # document's edge are joined by the union and cut again below
        places = np.frombuffer(b"".join(x for x in found.column("places").to_pylist() if x), "<i4").astype(np.int64)
        s, e = (x.drop_null().to_numpy().astype(np.int64) for x in (found.column("start"), found.column("stop")))
        s, e = _merge(np.concatenate((s, places)), np.concatenate((e, places + 1)) + MATCH - 1)
        rows = []
        for doc, lo, hi in zip(block.column("ids")[0].as_py(), off[:-1].tolist(), off[1:].tolist(), strict=True):
            a, b = int(np.searchsorted(e, lo, "right")), int(np.searchsorted(s, hi, "left"))
            at, removed, kept = lo, 0, []
            for i in range(a, b):
                x, y = max(lo, int(s[i])), min(hi, int(e[i]))
                kept.append(data[at:x])
                removed += y - x
                at = y
            kept.append(data[at:hi])
            rest = b"".join(kept)
            rows.append((doc, hi - lo, removed, b - a if hi > lo else 0, hashlib.sha256(rest).hexdigest(), rest)[: len(names)])
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    left = parsed.select("block", "ids", "ends", "text").groupBy("block")
    schema = f"`{key}` {kind.simpleString()}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept binary" * with_text
    return left.cogroup(spans.groupBy("block")).applyInArrow(run, schema)


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", hot: int = HOT, with_text: bool = False, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The whole operator over a table of documents."""
    parsed = blocks(docs, key, text, block_bytes)
    answers = ask(parsed, ["ends", "text"], _asked)
    phrases = sift(parsed, answers, hot)
    drop_written(answers)
    spans = phrases.where("key is null").select("block", "start", "stop").unionByName(decide(phrases, shard_bytes))
    spans = spans.unionByName(counted_windows(phrases), allowMissingColumns=True)
    return remove(parsed, spans, key, with_text)


def op1(spark, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"))
