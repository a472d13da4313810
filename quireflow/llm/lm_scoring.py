"""LM scoring: a probabilistic suffix tree over words, learnt from the training part of a corpus.

The query bounds neither the length of contexts nor which of them are tried (no ``longest``, ``LIFT``, ``SURPRISE``):
its tree ends where the divergence test ends it.  The bounds are options of the operator.

States are contexts of up to ``longest`` words.  A context that stands ``often`` times or more is a
candidate, and a state holds the symbols that follow it ``least`` times or more, discounted by
``DISCOUNT``; all mass left over follows its suffix, down to the root: add-one unigrams over all
words ever seen plus one unknown.  So every state's distribution sums to one, and a token is scored
in the state that is the longest suffix of what stands before it.

Divergence test: a candidate of count n is retained if n times the Kullback-Leibler divergence of its
distribution from its suffix's (explicit symbols and left-over mass) is at least ``PENALTY`` ln(n + 1)
nats for each of its explicit symbols; a candidate without explicit symbols says nothing new and goes.
The tree grows from the root: a longer context is a candidate only if its suffix is retained, if the
context without its last word was a candidate, and if its last word follows that one ``LIFT`` times as
often as its suffix lets expect, beyond chance by ``SURPRISE`` nats (n ln(n / expected) - n + expected).  So
text that repeats gets long contexts, while words that meet by chance, of which a larger corpus has ever
more, do not.

Both counts are the same at every size: no rule of the model reads how large the corpus is.  States and
symbols grow with the corpus, and nothing of the model is gathered or broadcast.

Text is read once into blocks of tokens, which stay where they are (a bucketed table), as does what is
known of the tokens that a longer context may still improve (others: the answers of depths 0 and 1, from
which a block works it out again, then a state).  Depth by depth each block asks
shards for its distinct contexts and runs of words, one small blob per (block, shard), and a shard answers
every block with counts.  A run stands ``least`` times only if the run without its first word does, so the
others are never asked for.  A context that stands ``HOT_CONTEXT`` times or more is dealt in parts by the
word that follows; blocks add up what its parts answer and test it as any other.

Words are told apart by 62-bit hashes with drawn bases (``bytewords``), contexts within a shard by 40 bits
and how often they stand, and the words after one context by 24: runs of words that agree by chance count as one.

Tokens: case-folded (A-Z) words, then one end per document.  Defined results: null text has the
end token alone; a text of any length is scored whole; a null id hashes as empty text and trains;
rows that repeat an id count as rows; further columns are not read; with no training rows every
known count is 0; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import itertools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytewords as bw
from .common import LOWER, UPPER, bucketed, drop_bucketed, drop_written, passes, table, utf8, written

#: Bytes of text in a block: what one task scores at a time.
BLOCK_BYTES = 4 << 20
#: Times that a context, and a symbol after it, must stand in training documents, however many there are.
OFTEN = 2
LEAST = 2
#: Words of the longest context.
LONGEST = 3
DISCOUNT = 0.5
#: What each explicit symbol of a retained state must earn, as a multiple of the logarithm of the state's count.
PENALTY = 1.0
#: Nats by which a run of words must exceed what is expected of it to become a context.
SURPRISE = 16.0
#: How many times what is expected of it a run of words must stand to become a context: unlike nats, the same at every size.
LIFT = 8.0
#: Tokens for one shard of questions, and occurrences for one part of a frequent context.
SHARD_TOKENS = 2_000_000
HOT_CONTEXT = 1 << 20
#: The fixed hold-out rule of the contract.
FOLDS, HELD_OUT = 7, 2
_LOW = np.frombuffer(bytes.maketrans(UPPER.encode(), LOWER.encode()), np.uint8)
_END = np.uint64(0x5BD1E995C2B2AE35)
#: Bits of a key for the word after a context; the rest is the context's.
_SYMBOL = 24
_SYMBOLS = np.uint64((1 << _SYMBOL) - 1)
#: A part of a frequent context doesn't know how much mass the whole leaves over, so it answers for these shares; between them its divergence is interpolated.
_SHARES = np.linspace(0.0, 1.0, 33)
#: Parent probabilities travel in single precision from depth 2 on, no smaller than this; only the divergence test reads them, and multiplies what they are off by with a context's count.
_LEAST_P = 1e-37


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD_OUT


def _squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob, byte planes apart."""
    head = np.array([len(a) for a in arrays], "<i8").tobytes()
    planes = [np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T).tobytes() if len(a) else b"" for a in arrays]
    body = b"".join(planes)
    return head + len(body).to_bytes(8, "little") + bytes(pa.Codec("zstd", compression_level=1).compress(body))


def _unsqueeze(raw: bytes, *kinds: str) -> list[np.ndarray]:
    at = 8 * len(kinds)
    lengths = np.frombuffer(raw, "<i8", len(kinds)).tolist()
    size = int.from_bytes(raw[at : at + 8], "little")
    body = np.frombuffer(pa.Codec("zstd").decompress(raw[at + 8 :], size), np.uint8) if size else np.zeros(0, np.uint8)
    out, at = [], 0
    for n, kind in zip(lengths, kinds, strict=True):
        width = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(body[at : at + n * width].reshape(width, n).T).view(kind).reshape(n))
        at += n * width
    return out


def _tokens(off: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of documents in a row (an end after each), and tokens per document."""
    data = _LOW[data]
    start, end, doc = bw.word_spans(data, off)
    n = np.bincount(doc, minlength=len(off) - 1) + 1
    out = np.full(int(n.sum()), _END, np.uint64)
    out[np.arange(len(start)) + doc] = bw.span_hash(bw.prefix_hash(data), start, end)
    return out, n


_BLOCK = "block bigint, n_tokens bigint, ids array<bigint>, held array<boolean>, body binary, counts binary"


def blocks(docs: DataFrame, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A bucketed table of tokenised blocks: ids, hold-out flags, tokens per document, distinct words and token codes, the words' training counts."""
    names = [x.split()[0] for x in _BLOCK.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        ids: list = []
        hashes: list[np.ndarray] = []
        lengths: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            n = np.concatenate(lengths)
            words, codes, often = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
            # frequent words have small codes, which pack better
            order = np.argsort(-often, kind="stable")
            rank = np.empty(len(words), np.int64)
            rank[order] = np.arange(len(words))
            words, codes = words[order], rank[codes]
            held = np.array([held_out(i) for i in ids], bool)
            counts = np.bincount(codes[np.repeat(~held, n)], minlength=len(words))
            values = [(part << 32) + number, int(n.sum()), list(ids), held.tolist(), _squeeze(n.astype("<u4"), words, codes.astype("<u4")), _squeeze(counts.astype("<u4"))]
            ids.clear(), hashes.clear(), lengths.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

        for batch in batches:
            off, data = utf8(batch.column(1))
            for lo, hi in passes(off, 1 << 20):
                h, n = _tokens(off[lo : hi + 1] - off[lo], data[off[lo] : off[hi]])
                ids += batch.column(0).slice(lo, hi - lo).to_pylist()
                hashes.append(h)
                lengths.append(n)
                size += int(off[hi] - off[lo])
                if size >= block_bytes:
                    yield flush()
                    number, size = number + 1, 0
        if ids:
            yield flush()

    return bucketed(docs.select(F.col(key).cast("bigint").alias(key), text).mapInArrow(run, _BLOCK), "lmblocks", "block")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _join(run: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a run of words and one more; the run is mixed, or the order of its words would be lost."""
    return _mix(run + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(3) + word


def _shard_order(shard: np.ndarray, key: np.ndarray, shards: int) -> np.ndarray:
    """Places sorted by shard, then by key."""
    order = np.argsort(shard.astype(np.uint16) if shards <= 1 << 16 else shard, kind="stable")
    cuts = np.flatnonzero(np.diff(shard[order])) + 1
    for lo, hi in zip(np.append(0, cuts).tolist(), np.append(cuts, len(order)).tolist(), strict=True):
        order[lo:hi] = order[lo:hi][np.argsort(key[order[lo:hi]])]
    return order


def _firsts(x: np.ndarray, *more: np.ndarray) -> np.ndarray:
    """Where sorted values change."""
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    for y in more:
        new[1:] |= y[1:] != y[:-1]
    return np.flatnonzero(new)


@dataclass(frozen=True)
class Model:
    """Everything that blocks and shards must agree on."""

    n: int
    v: int
    shards: int
    longest: int | None = LONGEST
    often: int = OFTEN
    least: int = LEAST
    hot: int = HOT_CONTEXT
    discount: float = DISCOUNT
    penalty: float = PENALTY
    surprise: float = SURPRISE
    lift: float = LIFT

    @property
    def words(self) -> float:
        """What a count and one is divided by."""
        return self.n + self.v + 1.0


@dataclass
class Play:
    """What one block asks at one depth: tokens in play and probes of frequent contexts' parts, sorted by shard, state and word."""

    at: np.ndarray  # tokens whose context is a candidate
    total: np.ndarray  # of each token and probe: how often its context stands
    alive: np.ndarray  # of each token: whether it asks for its run of words
    family: np.ndarray  # of each probe: number of its frequent context; then of each token: that, or -1
    order: np.ndarray
    key: np.ndarray  # sorted, as are the next three
    shard: np.ndarray
    states: np.ndarray  # where states begin
    entries: np.ndarray  # where distinct keys begin
    asked: np.ndarray  # of distinct keys: whether they are runs of words

    def bounds(self) -> Iterator[tuple[int, slice, slice]]:
        """(shard, its states, its runs) in order."""
        shard = self.shard[self.states]
        runs = self.shard[self.entries[self.asked]]
        for lo in _firsts(shard).tolist():
            s = shard[lo]
            yield int(s), slice(lo, int(np.searchsorted(shard, s, "right"))), slice(*np.searchsorted(runs, [s, s + 1]).tolist())


def _play(words: np.ndarray, at: np.ndarray, context: np.ndarray, total: np.ndarray, alive: np.ndarray, model: Model) -> Play:
    """``context`` and ``total``: hash and training count of the words before each token of ``at``; ``alive``: its run of words is asked for."""
    symbol = np.where(alive, np.maximum(_mix(words[at]) >> np.uint64(64 - _SYMBOL), np.uint64(1)), np.uint64(0))
    frequent = np.flatnonzero(total >= model.hot)
    family, probes = np.full(len(at), -1, np.int64), np.zeros(0, np.int64)
    if len(frequent):
        seen, first, family[frequent] = np.unique(context[frequent], return_index=True, return_inverse=True)
        parts = total[frequent[first]].astype(np.int64) // model.hot
        part = _mix(words[at[frequent]] ^ np.uint64(0xA5A5A5A5)) % parts[family[frequent]].astype(np.uint64)
        turn = np.uint64(0xD1342543DE82EF95)
        context[frequent] += part * turn
        # every part is asked for its share, whether the block holds a word of it or not
        probes = np.repeat(np.arange(len(seen)), parts)
        nth = np.arange(len(probes)) - np.repeat(np.cumsum(parts) - parts, parts)
        context = np.concatenate((context, seen[probes] + nth.astype(np.uint64) * turn))
        total = np.concatenate((total, total[frequent[first]][probes]))
        symbol = np.concatenate((symbol, np.zeros(len(probes), np.uint64)))
    key = (_mix(context) & ~_SYMBOLS) | symbol
    shard = ((_mix(context ^ np.uint64(0x6A09E667F3BCC909)) >> np.uint64(32)) * np.uint64(model.shards) >> np.uint64(32)).astype(np.int64)
    order = _shard_order(shard, key, model.shards)
    key, shard = key[order], shard[order]
    entries = _firsts(key, shard)
    states = _firsts(key >> np.uint64(_SYMBOL), shard)
    return Play(at, total, alive, np.concatenate((probes, family)), order, key, shard, states, entries, (key[entries] & _SYMBOLS) > 0)


def _rows(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.Table:
    return pa.table([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def _one_by_one(batch: pa.RecordBatch) -> Iterator[dict]:
    """A batch's rows, of which one at a time is copied out of Arrow: a block is megabytes."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


_QUESTION = (["shard", "block", "body"], [pa.int64(), pa.int64(), pa.binary()])
_ANSWER = (["block", "shard", "body", "n", "v"], [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()])
_ANSWERS = "block bigint, shard bigint, body binary, n bigint, v bigint"


def _word_shards(words: np.ndarray, shards: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order of the words, and (shard, from, to) in it."""
    shard = (_mix(words) % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    firsts = _firsts(shard[order]).tolist() if len(words) else []
    return order, [(int(shard[order[lo]]), lo, hi) for lo, hi in zip(firsts, [*firsts[1:], len(words)], strict=True)]


def _word_counts(tokenised: DataFrame, shards: int) -> DataFrame:
    """Answers of depth 0: per block and shard the training counts of words; one answer of each shard has its tokens and words seen."""

    def questions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _one_by_one(batch):
                words, own = _unsqueeze(row["body"], "<u4", "<u8", "<u4")[1], _unsqueeze(row["counts"], "<u4")[0]
                order, cuts = _word_shards(words, shards)
                yield from _rows([(s, row["block"], _squeeze(words[order[lo:hi]], own[order[lo:hi]])) for s, lo, hi in cuts], *_QUESTION).to_batches()

    def answers(group: pa.Table) -> pa.Table:
        asked = [_unsqueeze(x, "<u8", "<u4") for x in group.column("body").to_pylist()]
        words, own = (np.concatenate([a[i] for a in asked]) for i in range(2))
        _, inverse = np.unique(words, return_inverse=True)
        c = np.bincount(inverse, weights=own).astype(np.int64)
        mine, shard, seen = c.astype("<u4")[inverse], group.column("shard")[0].as_py(), (int(c.sum()), int((c > 0).sum()))
        ends = np.cumsum([len(a[0]) for a in asked])
        return _rows([(b, shard, _squeeze(x), *(seen if i == 0 else (0, 0))) for i, (b, x) in enumerate(zip(group.column("block").to_pylist(), np.split(mine, ends[:-1]), strict=True))], *_ANSWER)

    asked = tokenised.select("block", "body", "counts").mapInArrow(questions, "shard bigint, block bigint, body binary")
    return written(asked.groupBy("shard").applyInArrow(answers, _ANSWERS), "lmwords")


_STATE = "block bigint, body_ binary, sums binary, in_play bigint"


@dataclass
class Block:
    """A block's tokens, and of those in play (whose next longer context is a candidate) what is known so far."""

    number: int
    ids: list
    held: np.ndarray
    length: np.ndarray
    words: np.ndarray
    place: np.ndarray
    at: np.ndarray  # tokens in play
    total: np.ndarray  # of each: how often its context stands
    alive: np.ndarray  # of each: whether its run of words may be in the model
    p: np.ndarray  # of each: its probability in the longest state so far
    sums: list[np.ndarray]  # per document: known tokens, base score, score of the tokens that left play

    @classmethod
    def _of(cls, row: dict, own: np.ndarray, codes: np.ndarray, length: np.ndarray) -> Block:
        words, none = own[codes], np.zeros(0, np.int64)
        place = np.arange(len(words)) - np.repeat(np.cumsum(length) - length, length)
        return cls(row["block"], row["ids"], np.array(row["held"], bool), length, words, place, none, none, none.astype(bool), none.astype(float), [])

    @classmethod
    def begun(cls, row: dict, model: Model) -> Block:
        """From what is known of the block's words, and of its runs of two words where that is known too."""
        length, own, codes = _unsqueeze(row["body"], "<u4", "<u8", "<u4")
        now = cls._of(row, own, codes, length.astype(np.int64))
        got, counts = {x["shard"]: x["body"] for x in row["said0"]}, np.zeros(len(own), np.int64)
        order, cuts = _word_shards(own, model.shards)
        for s, lo, hi in cuts:
            counts[order[lo:hi]] = _unsqueeze(got[s], "<u4")[0]
        count = counts[codes]
        p = (count + 1.0) / model.words
        now.sums = [np.add.reduceat(x, np.cumsum(now.length) - now.length) for x in ((count > 0).astype(np.int64), np.log10(p))] + [np.zeros(len(now.length))]
        now._leave(np.arange(len(count)), count, p, np.ones(len(count), bool), np.ones(len(count), bool), 0, model)
        if "said1" in row:
            now.step(1, {x["shard"]: x["body"] for x in row["said1"] or []}, model)
        return now

    @classmethod
    def held_as(cls, row: dict) -> Block:
        """From the block and its state."""
        length, own, codes = _unsqueeze(row["body"], "<u4", "<u8", "<u4")
        now = cls._of(row, own, codes, length.astype(np.int64))
        play, total, alive, p = _unsqueeze(row["body_"], "u1", "<u4", "u1", "<f8")
        now.at = np.flatnonzero(np.unpackbits(play, count=len(now.words)))
        now.total, now.p = total.astype(np.int64), p
        now.alive = np.unpackbits(alive, count=len(now.at)).astype(bool)
        now.sums = _unsqueeze(row["sums"], "<i8", "<f8", "<f8")
        return now

    def state(self) -> tuple[int, bytes, bytes, int]:
        play = np.zeros(len(self.words), bool)
        play[self.at] = True
        return self.number, _squeeze(np.packbits(play), self.total.astype("<u4"), np.packbits(self.alive), self.p), _squeeze(self.sums[0].astype("<i8"), *self.sums[1:]), len(self.at)

    def play(self, depth: int, model: Model) -> Play:
        context = self.words[self.at - 1]
        for back in range(2, depth + 1):  # the same hash wherever the words stand
            context = _join(context, self.words[self.at - back])
        return _play(self.words, self.at, context, self.total, self.alive, model)

    def _leave(self, at: np.ndarray, c: np.ndarray, p: np.ndarray, grows: np.ndarray, opens: np.ndarray, depth: int, model: Model) -> None:
        """After ``depth``: of the tokens ``at``, with the counts of their runs, those whose longer context is a candidate stay in play."""
        before, may = np.zeros(len(self.words), np.int64), np.zeros(len(self.words), bool)
        before[at], may[at] = c, opens
        if model.longest is None or depth < model.longest:
            stay = grows & (self.place[at] > depth) & may[at - 1] & (before[at - 1] >= model.often)
        else:
            stay = np.zeros(len(at), bool)
        doc = np.repeat(np.arange(len(self.length)), self.length)[at[~stay]]
        self.sums[2] = self.sums[2] + np.bincount(doc, weights=np.log10(p[~stay]), minlength=len(self.length))
        self.at, self.p, self.total, self.alive = at[stay], p[stay], before[at[stay] - 1], c[stay] >= model.least

    def step(self, depth: int, got: dict[int, bytes], model: Model) -> None:
        """Take the answers of ``depth``, by shard."""
        play = self.play(depth, model)
        mass, kinds = np.zeros(len(play.states), np.int64), np.zeros(len(play.states), np.int64)
        runs = np.zeros(int(play.asked.sum()), np.int64)
        frequent = play.total[play.order[play.states]] >= model.hot
        curves = [np.zeros((0, 1 + len(_SHARES)))]
        for s, states, asked in play.bounds():
            mass[states], kinds[states], runs[asked], flat = _unsqueeze(got[s], "<u8", "<u4", "<u4", "<f4")
            curves.append(flat.reshape(-1, 1 + len(_SHARES)))
        n = len(play.at)
        stands = np.zeros(len(play.entries), np.int64)
        stands[play.asked] = runs
        # from sorted order back to tokens and probes
        c, m, k = (np.empty(len(play.order), np.int64) for _ in range(3))
        c[play.order] = np.repeat(stands, np.diff(play.entries, append=len(play.order)))
        width = np.diff(play.states, append=len(play.order))
        m[play.order], k[play.order] = np.repeat(mass, width), np.repeat(kinds, width)
        probes = len(play.order) - n
        if probes:
            # a frequent context's mass is that of all its parts, and so is its divergence
            family, mine = play.family[:probes], play.family[probes:]
            whole_m, whole_k = (np.bincount(family, weights=x[n:]).astype(np.int64) for x in (m, k))
            state = np.empty(len(play.order), np.int64)
            state[play.order] = np.repeat(np.arange(len(play.states)), width)
            sums = np.zeros((len(whole_m), 1 + len(_SHARES)))
            np.add.at(sums, family, np.concatenate(curves)[(np.cumsum(frequent) - 1)[state[n:]]])
            total = np.zeros(len(whole_m))
            total[family] = play.total[n:]
            rest = np.clip(1.0 - (whole_m - model.discount * whole_k) / total, 1e-300, 1.0)
            kl = _between(sums[:, 1:], rest) + _left_over(rest, sums[:, 0])
            kept = (whole_k > 0) & (total * kl >= model.penalty * np.log1p(total) * whole_k)
            for x, whole in ((m, whole_m), (k, whole_k)):
                x[:n] = np.where(mine >= 0, np.where(kept, whole, 0)[mine], x[:n])
        c, m, k, total, p = c[:n], m[:n], k[:n], play.total[:n], self.p
        expected = total * p
        opens = (c >= model.least) & (c >= model.lift * expected) & (c * np.log(np.maximum(c, 1) / expected) - c + expected >= model.surprise)
        own = np.where(c >= model.least, (c - model.discount) / total, 0.0)
        p = np.where(k > 0, own + (1.0 - (m - model.discount * k) / total) * p, p)
        self._leave(self.at, c, p, k > 0, opens, depth, model)

    def questions(self, depth: int, model: Model) -> pa.Table:
        """(shard, block, body): the block's distinct states and runs of words, with how often its training documents hold them."""
        play = self.play(depth, model)
        n, order = len(play.at), play.order
        train = np.zeros(len(order), np.uint32)
        train[:n] = np.repeat(~self.held, self.length)[play.at] & play.alive
        quiet = np.zeros(len(order), _parent(depth))
        # the parents of depth 1 are counts of words, which stay whole numbers
        quiet[:n] = np.rint(self.p * model.words) if depth == 1 else np.maximum(self.p, _LEAST_P)
        first = play.entries[play.asked]
        own = np.add.reduceat(train[order], play.entries)[play.asked] if len(order) else train
        quiet = quiet[order[first]]
        symbol = (play.key[first] & _SYMBOLS).astype("<u4")
        state, total = play.key[play.states] >> np.uint64(_SYMBOL), play.total[order[play.states]].astype("<u4")
        of = np.searchsorted(play.states, first, "right") - 1
        held = np.bincount(of, minlength=len(play.states)).astype("<u4")
        # sorted numbers travel as steps: states, and the symbols of each
        later = np.flatnonzero(np.diff(of, prepend=-1) == 0)
        step = symbol.copy()
        step[later] -= symbol[later - 1]

        def body(a: slice, b: slice) -> bytes:
            # a run that counts has training tokens somewhere, and who holds those says its parent's probability
            return _squeeze(np.diff(state[a], prepend=np.uint64(0)), total[a], held[a], step[b], own[b].astype("<u4"), quiet[b][own[b] > 0])

        return _rows([(s, self.number, body(a, b)) for s, a, b in play.bounds()], *_QUESTION)


def _parent(depth: int) -> str:
    """How parent probabilities travel: at depth 1 as counts of words and one."""
    return "<u4" if depth == 1 else "<f4"


def _bodies(answers: pa.Table) -> dict[int, bytes]:
    """A block's answers of one depth by shard."""
    return dict(zip(*(answers.column(c).to_pylist() for c in ("shard", "body")), strict=True))


def _left_over(rest: np.ndarray, explicit: np.ndarray) -> np.ndarray:
    """What the symbols that a state doesn't hold add to its divergence: the mass left over, shared out as its suffix has it."""
    return rest * np.maximum(1.0 - explicit, 0.0) * np.log(rest)


def _between(curves: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Each curve (its values at ``_SHARES``) at its share, by the cubic through the four nearest values."""
    steps = len(_SHARES) - 1
    first = np.clip((share * steps).astype(np.int64) - 1, 0, steps - 3)
    x, out = share * steps - first, np.zeros(len(share))
    for i in range(4):
        weight = np.ones(len(share))
        for j in range(4):
            if j != i:
                weight *= (x - j) / (i - j)
        out += weight * curves[np.arange(len(share)), first + i]
    return out


def _answered(asked: DataFrame, depth: int, model: Model) -> DataFrame:
    """Answers of one depth: per state the counts of its explicit symbols summed and how many they are (0: not retained); per run of words its count."""

    def answer(group: pa.Table) -> pa.Table:
        asked = [_unsqueeze(x, "<u8", "<u4", "<u4", "<u4", "<u4", _parent(depth)) for x in group.column("body").to_pylist()]
        state = np.concatenate([np.cumsum(a[0], dtype=np.uint64) for a in asked])
        total, held, step, own, parent = (np.concatenate([a[i] for a in asked]) for i in range(1, 6))
        quiet = np.zeros(len(own))
        quiet[own > 0] = parent / model.words if depth == 1 else parent
        sums = np.append(np.zeros(1, np.uint64), np.cumsum(step, dtype=np.uint64))
        symbol = sums[1:] - np.repeat(sums[np.cumsum(held, dtype=np.int64) - held], held)
        # contexts whose bits agree by chance are told apart where they stand more or less often
        kinds, first, which = np.unique(state << np.uint64(_SYMBOL) | (total & _SYMBOLS), return_index=True, return_inverse=True)
        total = total[first].astype(np.int64)
        key = np.repeat(which.astype(np.uint64) << np.uint64(_SYMBOL), held) | symbol
        order = np.argsort(key)
        entries = _firsts(key[order])
        c = np.add.reduceat(own[order].astype(np.int64), entries) if len(key) else np.zeros(0, np.int64)
        run = np.empty(len(key), np.int64)
        run[order] = np.repeat(c, np.diff(entries, append=len(key)))
        often = c >= model.least
        of = (key[order[entries[often]]] >> np.uint64(_SYMBOL)).astype(np.int64)
        q = np.maximum.reduceat(quiet[order], entries)[often] if len(key) else quiet
        p = (c[often] - model.discount) / total[of]
        mass, explicit, k = (np.bincount(of, weights=x, minlength=len(kinds)) for x in (p, q, np.ones(len(of))))
        rest = np.maximum(1.0 - mass, 1e-300)
        smooth = p + rest[of] * q
        kl = np.bincount(of, weights=smooth * np.log(smooth / q), minlength=len(kinds)) + _left_over(rest, explicit)
        # a part does not see its whole context: blocks add up the parts and decide
        hot = total >= model.hot
        keep = (k > 0) & (hot | (total * kl >= model.penalty * np.log1p(total) * k))
        curves, nth = np.zeros((int(hot.sum()), 1 + len(_SHARES))), np.cumsum(hot) - 1
        curves[:, 0] = explicit[hot]
        mine = hot[of]
        for i, share in enumerate(_SHARES if mine.any() else [], 1):
            x = p[mine] + share * q[mine]
            curves[:, i] = np.bincount(nth[of[mine]], weights=x * np.log(x / q[mine]), minlength=len(curves))
        summed = np.where(keep, np.bincount(of, weights=c[often], minlength=len(kinds)), 0).astype("<u8")
        k = np.where(keep, k, 0).astype("<u4")
        run = np.where(run >= model.least, run, 0).astype("<u4")
        shard, ends, runs = group.column("shard")[0].as_py(), np.cumsum([len(a[0]) for a in asked])[:-1], np.cumsum([len(a[3]) for a in asked])[:-1]
        parts = zip(group.column("block").to_pylist(), np.split(which, ends), np.split(run, runs), strict=True)
        return _rows([(b, shard, _squeeze(summed[w], k[w], z, curves[nth[w[hot[w]]]].ravel().astype("<f4")), 0, 0) for b, w, z in parts], *_ANSWER)

    return written(asked.groupBy("shard").applyInArrow(answer, _ANSWERS), f"lmanswers{depth}")


def _by_block(answers: DataFrame, name: str) -> DataFrame:
    """A bucketed table with one row per block of all that one depth's shards answer it."""
    return bucketed(answers.groupBy("block").agg(F.collect_list(F.struct("shard", "body")).alias(name)), name, "block")


def score(tokenised: DataFrame, key: str = "doc_id", longest: int | None = LONGEST, shard_tokens: int = SHARD_TOKENS, **options) -> DataFrame:
    """A written table with one row per document: key, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``longest`` None: contexts as long as the tree grows.  ``options`` are those of ``Model``.
    """
    spark = tokenised.sparkSession
    size = tokenised.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n")).first().n
    shards = int(size // shard_tokens) + 1
    sweep = spark._jvm.System.gc  # Spark deletes shuffle files once the driver's collector finds them unused
    known = _word_counts(tokenised, shards)
    sweep()
    seen = known.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("v"), F.lit(0)).alias("v")).first()
    model = Model(int(seen.n), int(seen.v), shards, longest, **options)
    held = tokenised.select("block", "ids", "held", "body")
    told = _by_block(known, "said0")
    drop_written(known)
    question = "shard bigint, block bigint, body binary"
    names = [key, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    schema = f"`{key}` bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"

    def opened(row: dict) -> Block:
        return Block.held_as(row) if "body_" in row else Block.begun(row, model)

    def scored(now: Block) -> pa.Table:
        cols = [now.ids, now.held, now.length, now.sums[0], np.full(len(now.length), model.n), now.sums[1], now.sums[2]]
        return pa.table([pa.array(x, k) for x, k in zip(cols, kinds, strict=True)], names=names)

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _one_by_one(batch):
                yield from scored(opened(row)).to_batches()

    def asks(depth: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in _one_by_one(batch):
                    yield from opened(row).questions(depth, model).to_batches()

        return run

    def after(depth: int):
        def run(block: pa.Table, answers: pa.Table) -> pa.Table:
            now = opened(block.to_pylist()[0])
            now.step(depth, _bodies(answers), model)
            return _rows([now.state()], ["block", "body_", "sums", "in_play"], [pa.int64(), pa.binary(), pa.binary(), pa.int64()])

        return run

    # what is known of depths 0 and 1 follows from their answers, which are smaller than a state of nearly all tokens
    state = [told]
    for depth in itertools.count(1) if longest is None else range(1, longest + 1):
        left = functools.reduce(lambda a, b: a.join(b, "block", "left"), state, held)
        got = _answered(left.mapInArrow(asks(depth), question), depth, model)
        sweep()
        if depth == 1:
            state.append(_by_block(got, "said1"))
        else:
            new = bucketed(left.groupBy("block").cogroup(got.groupBy("block")).applyInArrow(after(depth), _STATE), "lmstate", "block")
            for old in state:
                drop_bucketed(old)
            state = [new]
        drop_written(got)
        sweep()
        if longest is None and depth > 1 and not new.agg(F.coalesce(F.sum("in_play"), F.lit(0)).alias("n")).first().n:
            break
    out = written(functools.reduce(lambda a, b: a.join(b, "block", "left"), state, held).mapInArrow(finished, schema), "lmscores")
    for old in state:
        drop_bucketed(old)
    return out


def op5(spark, sf_dir: str) -> DataFrame:
    tokenised = blocks(table(spark, sf_dir, "documents"))
    out = score(tokenised, longest=None, surprise=-np.inf, lift=0.0)
    drop_bucketed(tokenised)
    return out
