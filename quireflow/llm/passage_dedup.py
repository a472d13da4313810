"""Repeated runs of words by relative Lempel-Ziv parsing against indexed reference blocks.

1. Reference blocks.  Of every window of ``WORDS`` words the least hash among its runs of ``GRAM`` words (leftmost of
   equals) is its anchor, fixed by its content, so equal windows have equal anchors.  Consecutive windows with one
   anchor are a *phrase*.  Anchors are counted over the corpus; windows of an anchor that occurs once are
   unique.  All other phrases go, as text, to the reference block that their anchor's hash names.  So a document is
   factored against every block that holds one of its anchors, and no other block can hold one of its windows: what
   documents are compared with grows with their own length and not with the number of blocks.
2. Index and factors.  A block's index is the suffix array of its phrases over word ids, by prefix doubling; neighbours in
   it give each place its longest match elsewhere, exactly and whatever its length.  Phrases are factored greedily from
   left to right; a factor of ``WORDS`` words or more is a duplicate span.
3. Boundaries.  A greedy factor ends where its own source stops, and a window across that place may have another
   source.  So after a long factor parsing resumes at the first window that leaves it, ``WORDS`` - 1 words before its end,
   and after a short one at the next word.  Every window is so either inside a long factor or tried itself.
4. Spans go back to their documents, whose words are removed.

Hot anchors (a passage in a third of all rows) occur with as many phrases as documents, all in one reference block.
Above ``HOT`` occurrences a phrase is therefore cut into its single windows, which are dealt to blocks of their own by
a 128-bit hash of their words: at most ``WORDS - GRAM + 1`` a phrase, each once per block of documents, so that they grow with
the text and not with its square.  A factor there is one window, and those are told apart by that hash; all others by
their words.

Defined results: null text has no words; documents never join; texts below ``WORDS`` words lose nothing; equal texts of at
least ``WORDS`` words lose everything; a text of any length is parsed whole; rows that repeat a doc_id are documents of
their own; ids of any type are carried through; further columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import bytewords as bw
from .common import drop_written, passes, table, written
from .suffix_dedup import _merge, _opened, _runs, blocks, window_triggers

WORDS = 35
#: Words of an anchor: long enough that few recur by chance, which only costs time.
GRAM = 8
#: Occurrences of an anchor above which its windows are dealt one by one.
HOT = 2000
#: Bytes of phrases, and windows of hot anchors, in a reference block, about.
REFERENCE_BYTES = 2 << 20
REFERENCE_WINDOWS = 1 << 20
#: Bytes of a phrase, about; only to tell how many blocks there should be.
_PHRASE_BYTES = 400
#: Bases of the two halves of a window's hash.
_HALVES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_STEP = 1 << 16
#: Text bytes of one numpy pass.
_PASS = 1 << 20
#: Bytes of documents in a block.
BLOCK_BYTES = 8 << 20


class Parsed:
    """A block's words (starts and ends of their bytes) and phrases (first window, one past the last, anchor)."""

    def __init__(self, off: np.ndarray, data: np.ndarray, words: int = WORDS, gram: int = GRAM):
        self.off, self.data, self.words = off, data, words
        parts, base = [], 0
        for lo, hi in passes(off, _PASS):
            p = self._pass(off[lo : hi + 1] - off[lo], data[off[lo] : off[hi]], words, gram)
            p = {k: v if k == "anchor" else (v + (off[lo] if k in ("begin", "end") else base)).astype(np.int32) for k, v in p.items()}
            base += len(p["begin"])
            parts.append(p)
        join = lambda k: np.concatenate([p.pop(k) for p in parts]) if parts else np.zeros(0, np.int32)
        self.begin, self.end = join("begin"), join("end")
        self.start, self.stop = join("start"), join("stop")
        self.anchors, self.code, self.own = np.unique(join("anchor"), return_inverse=True, return_counts=True)

    @staticmethod
    def _pass(off: np.ndarray, data: np.ndarray, words: int, gram: int) -> dict[str, np.ndarray]:
        begin, end, doc = bw.word_spans(data, off)
        none = np.zeros(0, np.int64)
        found = {"begin": begin, "end": end, "start": none, "stop": none, "anchor": none.astype(np.uint64)}
        if len(begin) < words:
            return found
        grams = bw.mix(bw.rolled(bw.span_hash(bw.prefix_hash(data), begin, end), gram))
        at = window_triggers(grams, words - gram + 1)
        i = np.flatnonzero(doc[: len(at)] == doc[words - 1 : words - 1 + len(at)])  # windows inside one document
        if len(i):
            a = at[i]
            first = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (i[1:] != i[:-1] + 1))))
            found |= {"start": i[first], "stop": np.append(i[first[1:] - 1], i[-1]) + 1, "anchor": grams[a[first]]}
        return found

    def texts(self, which: np.ndarray) -> pa.Array:
        """Phrases as text, one space between words, for those of ``which``."""
        n = (self.stop[which] - self.start[which] + self.words - 1).astype(np.int64)
        size = self.end[self.stop[which] + self.words - 2] - self.begin[self.start[which]]
        parts = [pa.array([], pa.large_binary())]
        for lo, hi in passes(np.concatenate(([0], np.cumsum(size))), _PASS):
            parts.append(spaced(self.data, self.begin, self.end, _runs(self.start[which][lo:hi].astype(np.int64), n[lo:hi]), n[lo:hi]))
        return pa.concat_arrays(parts)

    def windows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the windows of phrases, and two hashes of each (columns)."""
        at = _runs(self.start[which].astype(np.int64), (self.stop - self.start)[which])
        parts = []
        for lo, hi in passes(self.off, _PASS):  # words never cross passes
            a, b = np.searchsorted(self.begin, (self.off[lo], self.off[hi]))
            own, text = slice(a, b), self.data[self.off[lo] : self.off[hi]]
            parts.append(bw.span_hash(bw.prefix_hash(text), self.begin[own] - self.off[lo], self.end[own] - self.off[lo]))
        h = np.concatenate(parts)
        return at, np.stack([bw.mix(bw.rolled(h, self.words, b)[at]) for b in _HALVES], 1)


def spaced(data: np.ndarray, begin: np.ndarray, end: np.ndarray, words: np.ndarray, n: np.ndarray) -> pa.Array:
    """Rows of ``n`` words each (numbers in a row), as text with one space between words."""
    size = end[words] - begin[words] + 1
    stop = np.cumsum(size)
    out = data[np.minimum(_runs(begin[words], size), len(data) - 1)] if len(words) else np.zeros(0, np.uint8)
    out[stop - 1] = 32
    # the space behind a row's last word goes
    rows = np.cumsum(n)
    last = stop[rows[n > 0] - 1] - 1
    out = np.delete(out, last)
    bounds = np.concatenate(([0], np.append(0, stop)[rows] - np.cumsum(n > 0)))
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(out)])


def _blobs(body: np.ndarray, ends: np.ndarray, width: int) -> pa.Array:
    """An array cut into binary values that end at ``ends`` (in items)."""
    bounds = (np.concatenate(([0], ends)) * width).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(body))])


def anchors(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Written tables: (block, code, anchor, own) of each block's distinct anchors; (anchor, c) of those that the corpus holds twice or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ends, text in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                p = Parsed(*_opened(ends.as_py(), text.as_py()))
                for lo in range(0, len(p.anchors), _STEP):
                    a = p.anchors[lo : lo + _STEP].view(np.int64)
                    columns = [np.full(len(a), block), np.arange(lo, lo + len(a), dtype=np.int32), a, p.own[lo : lo + _STEP].astype(np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["block", "code", "anchor", "own"])

    own = written(parsed.select("block", "ends", "text").mapInArrow(run, "block bigint, code int, anchor bigint, own bigint"), "anchors")
    return own, written(own.groupBy("anchor").agg(F.sum("own").alias("c")).where("c > 1"), "anchorcounts")


_SIFTED = "block bigint, shard bigint, hot boolean, n int, places binary, body binary"


def sift(parsed: DataFrame, own: DataFrame, counts: DataFrame, hot: int = HOT, reference_bytes: int = REFERENCE_BYTES, reference_windows: int = REFERENCE_WINDOWS) -> DataFrame:
    """A written table of what each reference block gets: distinct phrases of a block of documents (``body``: text) and where they stand, and,
    a row per block of windows of hot anchors, its distinct windows (``body``: hashes, and in how many places each stands)."""
    total = counts.agg(*(F.coalesce(F.sum(F.when(cond, F.col("c"))), F.lit(0)).alias(k) for k, cond in (("cold", F.col("c") <= hot), ("hot", F.col("c") > hot)))).first()
    cold_shards = max(1, -(-total.cold * _PHRASE_BYTES // reference_bytes))
    hot_shards = max(1, -(-total.hot * (WORDS - GRAM + 1) // reference_windows))
    names = [x.split()[0] for x in _SIFTED.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.binary(), pa.binary()]

    def made(block: int, shard: np.ndarray, is_hot: bool, n: np.ndarray, places: pa.Array, body: pa.Array) -> pa.Table:
        columns = [np.full(len(shard), block), shard.astype(np.int64), np.full(len(shard), is_hot), n.astype(np.int32), places, body]
        return pa.table([c.cast(k) if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def run(block: pa.Table, known: pa.Table) -> pa.Table:
        out = [pa.table([pa.array([], k) for k in kinds], names=names)]
        if not known.num_rows:
            return out[0]
        number = block.column("block")[0].as_py()
        p = Parsed(*_opened(block.column("ends")[0].as_py(), block.column("text")[0].as_py()))
        c = np.ones(len(p.anchors), np.int64)
        c[known.column("code").to_numpy()] = known.column("c").to_numpy()
        c = c[p.code]
        cold = np.flatnonzero((c > 1) & (c <= hot))
        if len(cold):
            coded = p.texts(cold).dictionary_encode()
            code = coded.indices.to_numpy().astype(np.int64)
            order = np.argsort(code, kind="stable")
            held = np.bincount(code)
            ends = np.cumsum(held)
            shard = p.anchors[p.code[cold[order[ends - held]]]] % np.uint64(cold_shards)
            out.append(made(number, shard, False, held, _blobs(p.start[cold[order]].astype("<i4"), ends, 4), coded.dictionary))
        some = np.flatnonzero(c > hot)
        if len(some):
            at, keys = p.windows(some)
            order = np.lexsort((keys[:, 1], keys[:, 0]))
            at, keys = at[order].astype("<i4"), keys[order]
            first = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(1))))
            held = np.diff(np.append(first, len(keys)))
            keys = keys[first]
            shard = ((keys[:, 0] >> np.uint64(32)) * np.uint64(hot_shards) >> np.uint64(32)).astype(np.int64)  # rises with the key
            ends = np.append(np.flatnonzero(shard[1:] != shard[:-1]) + 1, len(shard))
            n = np.diff(ends, prepend=0)
            body = np.zeros(len(keys), [("k", "<u8", 2), ("held", "<u4")])
            body["k"], body["held"] = keys, held
            out.append(made(number, shard[ends - 1], True, n, _blobs(at, np.cumsum(held)[ends - 1], 4), _blobs(body.view(np.uint8), ends, body.itemsize)))
        return pa.concat_tables(out)

    answers = own.join(counts, "anchor").select("block", "code", "c")
    left, right = parsed.select("block", "ends", "text").groupBy("block"), answers.groupBy("block")
    return written(left.cogroup(right).applyInArrow(run, _SIFTED), "phrases")


def longest_matches(words: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For each word of phrases (dense ids from 1, in a row; ``size`` words each) the length of the longest match of what
    follows it in its phrase with what follows any other word: the suffix array's neighbours have it."""
    n, end = len(words), np.repeat(np.cumsum(size), size)
    left = end - np.arange(n)
    levels, length = [np.append(words, 0)], 1
    while length < size.max(initial=0):
        ahead = np.minimum(np.arange(n) + length, n)
        second = np.where(left > length, levels[-1][ahead], 0)
        rank = np.unique(levels[-1][:n] * np.int64(n + 2) + second, return_inverse=True)[1] + 1
        levels.append(np.append(rank, 0))
        length *= 2
    order = np.argsort(levels[-1][:n], kind="stable")
    a, b = order[:-1], order[1:]
    common = np.zeros(len(a), np.int64)
    most = np.minimum(left[a], left[b])
    for k in range(len(levels) - 1, -1, -1):
        same = (common < most) & (levels[k][np.minimum(a + common, n)] == levels[k][np.minimum(b + common, n)])
        common += same * (1 << k)
    common = np.minimum(common, most)
    longest = np.zeros(n, np.int64)
    longest[b] = common
    longest[a] = np.maximum(longest[a], common)
    return longest


def factors(texts: pa.Array, twice: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(phrase, first word, words) of the long factors of phrases against all phrases; those of ``twice`` stand elsewhere as a whole."""
    cut = pc.split_pattern(texts.cast(pa.large_string()), " ")
    size = np.diff(cut.offsets.to_numpy()).astype(np.int64)
    ids = cut.flatten().dictionary_encode().indices.to_numpy().astype(np.int64) + 1
    longest = longest_matches(ids, size)
    end = np.cumsum(size)
    start = end - size
    whole = np.repeat(twice, size)
    longest[whole] = (np.repeat(end, size) - np.arange(len(ids)))[whole]
    found = []
    phrase, at = np.arange(len(size)), start.copy()
    while True:
        open_ = at + words <= end[phrase]
        phrase, at = phrase[open_], at[open_]
        if not len(phrase):
            break
        length = longest[at]
        long = length >= words
        found.append((phrase[long], (at - start[phrase])[long], length[long]))
        at = at + np.where(long, length - words + 1, 1)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3


def factored(sifted: DataFrame) -> DataFrame:
    """(block, start, stop): windows inside long factors of phrases."""

    def run(group: pa.Table) -> pa.Table:
        held = group.column("n").to_numpy()
        which, at, length = factors(group.column("body").combine_chunks(), held > 1)
        places = np.frombuffer(b"".join(group.column("places").to_pylist()), "<i4").astype(np.int64)
        first = np.cumsum(held) - held
        n = held[which].astype(np.int64)
        start = places[_runs(first[which].astype(np.int64), n)] + np.repeat(at, n)
        stop = start + np.repeat(length, n) - WORDS + 1
        return pa.table([pa.array(np.repeat(group.column("block").to_numpy()[which], n)), pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32))], names=["block", "start", "stop"])

    return sifted.where("not hot").select("shard", "block", "n", "places", "body").groupBy("shard").applyInArrow(run, "block bigint, start int, stop int")


def counted(sifted: DataFrame) -> DataFrame:
    """(block, places): windows of hot anchors that stand elsewhere too."""

    def run(group: pa.Table) -> pa.Table:
        parts = [np.frombuffer(raw, [("k", "<u8", 2), ("held", "<u4")]) for raw in group.column("body").to_pylist()]
        rows = np.concatenate(parts)
        order = np.lexsort((rows["k"][:, 1], rows["k"][:, 0]))
        keys, held = rows["k"][order], rows["held"][order].astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(1))))
        many = np.zeros(len(rows), bool)
        many[order] = np.repeat(np.add.reduceat(held, first) > 1, np.diff(np.append(first, len(rows))))
        found = []
        for part, own, raw in zip(parts, np.split(many, np.cumsum([len(p) for p in parts])[:-1]), group.column("places").to_pylist(), strict=True):
            found.append(np.frombuffer(raw, "<i4")[np.repeat(own, part["held"])].tobytes())
        return pa.table([group.column("block"), pa.array(found, pa.binary())], names=["block", "places"])

    return sifted.where("hot").select("shard", "block", "places", "body").groupBy("shard").applyInArrow(run, "block bigint, places binary")


def remove(parsed: DataFrame, spans: DataFrame, key: str = "doc_id", with_text: bool = False) -> DataFrame:
    """Per document: n_words, n_removed, kept_sha256, n_spans (and the words that stay) without all words of repeated windows."""
    names = [key, "n_words", "n_removed", "kept_sha256", "n_spans"] + ["kept"] * with_text
    kind = parsed.schema["ids"].dataType.elementType
    kinds = [to_arrow_type(kind), pa.int64(), pa.int64(), pa.string(), pa.int64()] + [pa.string()] * with_text

    def run(block: pa.Table, found: pa.Table) -> pa.Table:
        off, data = _opened(block.column("ends")[0].as_py(), block.column("text")[0].as_py())
        ids = block.column("ids")[0].as_py()
        places = np.frombuffer(b"".join(x for x in found.column("places").to_pylist() if x), "<i4").astype(np.int64)
        s, e = (x.drop_null().to_numpy().astype(np.int64) for x in (found.column("start"), found.column("stop")))
        s, e = _merge(np.concatenate((s, places)), np.concatenate((e, places + 1)) + WORDS - 1)
        out, before = [], 0
        for lo, hi in passes(off, _PASS):
            text = data[off[lo] : off[hi]]
            own = off[lo : hi + 1] - off[lo]
            begin, end, doc = bw.word_spans(text, own)
            step = np.zeros(len(begin) + 1, np.int64)
            a, b = np.searchsorted(e, before, "right"), np.searchsorted(s, before + len(begin), "left")
            np.add.at(step, np.maximum(s[a:b] - before, 0), 1)
            np.add.at(step, np.minimum(e[a:b] - before, len(begin)), -1)
            gone = np.cumsum(step[:-1]) > 0
            before += len(begin)
            n = np.bincount(doc, minlength=hi - lo)
            ends = np.concatenate(([0], np.cumsum(n)))
            removed = bw.per_doc(gone, ends)
            opens = gone & np.concatenate(([True], ~gone[:-1] | (doc[1:] != doc[:-1])))[: len(gone)]
            kept = spaced(text, begin, end, np.flatnonzero(~gone), n - removed).to_pylist()
            values = [ids[lo:hi], n, removed, [hashlib.sha256(k).hexdigest() for k in kept], bw.per_doc(opens, ends)] + [[k.decode("utf-8", "replace") for k in kept]] * with_text
            out.append(pa.table([pa.array(v, t) for v, t in zip(values, kinds, strict=True)], names=names))
        return pa.concat_tables(out)

    schema = f"`{key}` {kind.simpleString()}, n_words bigint, n_removed bigint, kept_sha256 string, n_spans bigint" + ", kept string" * with_text
    return parsed.select("block", "ids", "ends", "text").groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(run, schema)


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", hot: int = HOT, with_text: bool = False, block_bytes: int = BLOCK_BYTES, reference_bytes: int = REFERENCE_BYTES, reference_windows: int = REFERENCE_WINDOWS) -> DataFrame:
    """The whole operator over a table of documents."""
    parsed = blocks(docs, key, text, block_bytes)
    own, counts = anchors(parsed)
    sifted = sift(parsed, own, counts, hot, reference_bytes, reference_windows)
    drop_written(own, counts)
    return remove(parsed, factored(sifted).unionByName(counted(sifted), allowMissingColumns=True), key, with_text)


def op12(spark, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"))


#: The same by SQL: windows as strings (words hold no space), counted by content.
ORACLE = rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT r, i, array_to_string(w[i : i + {WORDS - 1}], ' ') AS s FROM (SELECT r, w, unnest(range(1, len(w) - {WORDS - 2})) AS i FROM t WHERE len(w) >= {WORDS})),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY s) AS c FROM s) WHERE c > 1),
gone AS (SELECT DISTINCT r, i + k AS i FROM again, (SELECT unnest(range({WORDS})) AS k)),
word AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM t),
kept AS (
  SELECT word.r, string_agg(word, ' ' ORDER BY word.i) FILTER (gone.i IS NULL) AS kept, count(gone.i) AS n_removed, count(gone.i) FILTER (before.i IS NULL) AS n_spans
  FROM word LEFT JOIN gone ON gone.r = word.r AND gone.i = word.i LEFT JOIN gone AS before ON before.r = word.r AND before.i = word.i - 1
  GROUP BY word.r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans
FROM t LEFT JOIN kept ON t.r = kept.r
"""
