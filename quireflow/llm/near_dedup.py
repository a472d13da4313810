"""SimHash near-duplicates: fingerprints of word shingles, linked by pigeonring filtering.

The 64 bits stand as a ring of four 16-bit segments.  If two fingerprints differ in at most three
bits, the ring has a segment from which every run of k segments differs in at most floor(3k/4)
bits: 0, then 1, then 2, then 3 (the pigeonring principle).  Candidates are therefore found by an
equal first segment together with one equal half of the second (it may differ in one bit, so one
of its halves is equal): eight keys of 24 bits per *distinct* fingerprint.  Beyond ``WIDE_FROM`` distinct
fingerprints keys have 32 bits: both segments, stored as they are and asked for as they are and with each
bit of the second flipped, so buckets stay small as the corpus grows.  The remaining prefix budgets prune
the candidates before the full Hamming check.

Buckets with more than ``hot`` distinct fingerprints are never paired.  There each member emits
the values within two flips among the 40 bits that its key leaves open: members within one flip
of a value are pairwise within two, and a member two flips away is within three of each of those,
so all of them link to the value's least near member.  Values without a near member link nothing.
Any two members within three bits share such a value, so no link is lost, at a cost that grows
with the bucket and not with its square.

Defined results: null text is the empty text; texts without words have fingerprint zero and link
to each other like any others; equal texts are always in one component; a text of any length is
fingerprinted whole; rows repeating a doc_id are told apart by their texts; further columns are not read
(``keep_one`` carries them in a struct, whatever their names); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import bytewords as bw
from .common import LOWER, UPPER, drop_written, passes, table, text_of, utf8, written
from .components import components

SEED = 42
RADIUS = 3
#: Distinct fingerprints in a bucket above which flipped values replace pairs.
HOT = 512
#: Distinct fingerprints from which keys have 32 bits: a bucket of 24 bits then holds eight on average.
WIDE_FROM = 1 << 27
_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())


def fingerprint_text(raw: bytes, shingle: int = 3) -> int:
    """SimHash of the case-folded word shingles of one UTF-8 text; 0 without words."""
    words = raw.translate(_FOLD).split()  # bytes.split: exactly the six ASCII white-space bytes
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    votes = np.zeros(64, np.int64)
    for lo in range(0, n, 1 << 14):
        h = np.array([digest(line[s:e], SEED) for s, e in zip(starts[lo : lo + (1 << 14)], stops[lo : lo + (1 << 14)], strict=False)], ">u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > n).tobytes(), "big")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(key, fp bigint: the fingerprint's 64 bits as a signed number), one row per row of ``docs``."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            off, data = utf8(batch.column(1))
            for lo, hi in passes(off, 1 << 23):
                got = np.array([fingerprint_text(data[off[i] : off[i + 1]].tobytes(), shingle) for i in range(lo, hi)], np.uint64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(got.view(np.int64))], [key, "fp"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, fp bigint")


def _segment(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, 48 - 16 * (i % 4)).bitwiseAND(F.lit(0xFFFF))


def _keys() -> list[tuple[int, int]]:
    """(bucket kind, 64-bit mask of the bits that the bucket shares): segment i and half j of segment i+1."""
    out = []
    for i in range(4):
        for j in range(2):
            second = (i + 1) % 4
            mask = 0xFFFF << (48 - 16 * i) | 0xFF << (48 - 16 * second + 8 * (1 - j))
            out.append((2 * i + j, mask - (1 << 64) if mask >> 63 else mask))
    return out


def _within_ring(a: Column, b: Column, start: Column) -> Column:
    """The prefix budgets of the chain that starts at the key's segment: 1, 2, 3 after two, three, four segments."""
    x = a.bitwiseXOR(b)
    # turn the ring so that the chain starts at the top
    turned = F.when(start == 0, x)
    for i in range(1, 4):
        turned = turned.when(start == i, F.shiftleft(x, 16 * i).bitwiseOR(F.shiftrightunsigned(x, 64 - 16 * i)))
    return (F.bit_count(F.shiftrightunsigned(turned, 32)) <= 1) & (F.bit_count(F.shiftrightunsigned(turned, 16)) <= 2) & (F.bit_count(turned) <= RADIUS)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _wide(kind: int) -> tuple[int, list[int]]:
    """Mask of segment ``kind`` and the next, and the bits of the next."""
    bits = [1 << (48 - 16 * ((kind + 1) % 4) + b) for b in range(16)]
    return 0xFFFF << (48 - 16 * kind) | sum(bits), bits


def links(distinct_fp: DataFrame, hot: int = HOT, wide: bool | None = None) -> DataFrame:
    """(a, b): links that connect exactly what Hamming distances of at most three connect, over distinct ``fp``."""
    if wide is None:
        wide = distinct_fp.count() > WIDE_FROM
    return _wide_links(distinct_fp, hot) if wide else _narrow_links(distinct_fp, hot)


def _narrow_links(distinct_fp: DataFrame, hot: int) -> DataFrame:
    kinds = _keys()
    keyed = distinct_fp.select(
        "fp", F.explode(F.array(*(F.struct(F.lit(k).cast("int").alias("kind"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for k, m in kinds))).alias("b")
    ).select("fp", "b.kind", "b.key")
    keyed = written(keyed, "ringkeys")
    sizes = keyed.groupBy("kind", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = written(sizes, "ringsizes")
    small = keyed.join(sizes.where(F.col("n") <= hot).drop("n"), ["kind", "key"])
    other = small.select("kind", "key", F.col("fp").alias("other"))
    met = small.join(other, ["kind", "key"]).where("fp < other")
    near = met.where(_within_ring(F.col("fp"), F.col("other"), F.expr("kind div 2"))).select(F.col("fp").alias("a"), F.col("other").alias("b"))
    large = keyed.join(sizes.where(F.col("n") > hot).drop("n"), ["kind", "key"])
    return near.unionByName(_hung(large.select("kind", "fp"), dict(kinds))).distinct()


def _wide_links(distinct_fp: DataFrame, hot: int) -> DataFrame:
    wide = [_wide(k) for k in range(4)]
    key = lambda k, m, flip: F.struct(F.lit(k).alias("kind"), F.col("fp").bitwiseXOR(F.lit(_signed(flip))).bitwiseAND(F.lit(_signed(m))).alias("key"), F.lit(flip == 0).alias("own"))
    asked = distinct_fp.select("fp", F.explode(F.array(*(key(k, m, flip) for k, (m, bits) in enumerate(wide) for flip in (0, *bits)))).alias("b")).select("fp", "b.*")
    asked = written(asked, "widekeys")
    stored = asked.where("own").select("kind", "key", F.col("fp").alias("other"))
    crowded = written(stored.groupBy("kind", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).select("kind", "key"), "widecrowds")
    # whoever stands in a crowded bucket or next to one
    close = asked.join(crowded, ["kind", "key"], "left_semi").select("kind", "fp").distinct()
    met = asked.join(stored.join(crowded, ["kind", "key"], "left_anti"), ["kind", "key"]).where((F.col("fp") < F.col("other")) | ~F.col("own"))
    near = met.where(_within_ring(F.col("fp"), F.col("other"), F.col("kind"))).select(F.col("fp").alias("a"), F.col("other").alias("b"))
    segment = {k: _signed(0xFFFF << (48 - 16 * k)) for k in range(4)}
    return near.unionByName(_hung(close, segment)).distinct()


def _hung(members: DataFrame, masks: dict[int, int]) -> DataFrame:
    """(a, b): links among crowded members (kind, fp) by values within two flips of the bits that the kind's mask leaves open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _flipped(batches, masks)

    stars = members.select("kind", "fp").mapInArrow(run, "kind int, value bigint, far boolean, fp bigint")
    # per value: the least member within one flip; the others hang on it
    least = stars.groupBy("kind", "value").agg(F.min(F.when(~F.col("far"), F.col("fp"))).alias("hub"), F.count(F.lit(1)).alias("n")).where("hub is not null and n > 1")
    return stars.join(least.drop("n"), ["kind", "value"]).where("fp <> hub").select(F.col("hub").alias("a"), F.col("fp").alias("b"))


def _flipped(batches: Iterator[pa.RecordBatch], open_: dict[int, int]) -> Iterator[pa.RecordBatch]:
    """All values within two flips of each fingerprint, among the bits its bucket leaves open."""
    flips = {}
    for kind, mask in open_.items():
        bits = [np.uint64(1 << b) for b in range(64) if not (mask >> b) & 1]
        one = np.array(bits, np.uint64)
        two = np.array([a ^ b for i, a in enumerate(bits) for b in bits[:i]], np.uint64)
        flips[kind] = np.concatenate(([np.uint64(0)], one, two)), 1 + len(one)
    for batch in batches:
        kinds = batch.column(batch.schema.get_field_index("kind")).to_numpy(zero_copy_only=False)
        fps = batch.column(batch.schema.get_field_index("fp")).to_numpy(zero_copy_only=False).view(np.uint64)
        for kind in np.unique(kinds):
            masks, near = flips[int(kind)]
            own = fps[kinds == kind]
            for lo in range(0, len(own), 64):
                part = own[lo : lo + 64]
                value = (part[:, None] ^ masks[None, :]).ravel()
                far = np.tile(np.arange(len(masks)) >= near, len(part))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(value), kind, np.int32)), pa.array(value.view(np.int64)), pa.array(far), pa.array(np.repeat(part, len(masks)).view(np.int64))],
                    ["kind", "value", "far", "fp"],
                )


def near_components(docs: DataFrame, key: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """(key, fp, component_id): every row's fingerprint and the least key it is connected with.

    Rows are first reduced to distinct fingerprints, so copies cost one row, not pairs.  A null key
    gets the least non-null key of its component (null if there is none).
    """
    marked = written(fingerprints(docs, key, text), "fingerprints")
    firsts = marked.groupBy("fp").agg(F.min(key).alias("least"))
    firsts = written(firsts, "firsts")
    joined = components(links(firsts.select("fp"), hot))
    # a fingerprint's component, then that component's least key
    owned = firsts.join(joined.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    root = owned.groupBy("component").agg(F.min("least").alias("component_id"))
    answer = owned.join(root, "component").select("fp", "component_id")
    return marked.join(answer, "fp").select(key, "fp", "component_id")


# Near copies by the Jaccard similarity of word shingles, as pipelines take them: candidates come from SimHash and the
# pigeonring, as above but over sets of five-word shingles, and, for pairs beyond its three bits, from min-hash bands.

#: Shingle and similarity of the pipeline's stage.
STAGE_SHINGLE, STAGE_SIMILARITY = 5, 0.8
#: Min-hash bands and values in each: a pair of similarity 0.8 shares no band once in 5000 times.
BANDS, BAND_ROWS = 16, 4
#: Distinct sets that are compared in one group.  Larger buckets are compared in parts that share ``HUBS`` of the bucket's sets, so that what
#: links to any of them meets across parts; sets that don't link to what most of the bucket links to then meet every part.
GROUP, HUBS = 2048, 32
_TURNS = np.random.default_rng(SEED).integers(1, 1 << 62, BANDS * BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(off: np.ndarray, data: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of documents in a row and where each document's begin (n+1); texts of fewer words are one shingle, without words none."""
    data = np.frombuffer(_FOLD, np.uint8)[data]
    start, end, doc = bw.word_spans(data, off)
    word = bw.span_hash(bw.prefix_hash(data), start, end)
    many = np.bincount(doc, minlength=len(off) - 1)
    first = np.cumsum(many) - many
    place = np.arange(len(word)) - first[doc]
    h = np.zeros(len(word), np.uint64)
    for k in range(shingle):  # words past the end of a short text count as none
        at = np.minimum(np.arange(len(word)) + k, max(len(word) - 1, 0))
        h = _mix(h + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(3) + np.where(place + k < many[doc], word[at], np.uint64(0))
    whole = place <= np.maximum(many[doc] - shingle, 0)
    h, doc = _mix(h[whole]), doc[whole]
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], np.concatenate(([0], np.cumsum(np.bincount(doc[new], minlength=len(off) - 1))))


def _set_ids(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One hash per set."""
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_mix(h + np.uint64(1)), dtype=np.uint64)))
    return _mix(total[at[1:]] - total[at[:-1]] + np.diff(at).astype(np.uint64)).view(np.int64)


def set_prints(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """SimHash of each set, every member with one vote; 0 of an empty set."""
    n = np.diff(at)
    some, out = np.flatnonzero(n), np.zeros(len(n), np.uint64)
    for b in range(64 if len(some) else 0):
        votes = np.add.reduceat((h >> np.uint64(b)) & np.uint64(1), at[some])
        out[some] |= (2 * votes.astype(np.int64) > n[some]).astype(np.uint64) << np.uint64(b)
    return out


def _sets(docs: DataFrame, key: str, text: str, shingle: int, whole: bool) -> DataFrame:
    """(key, row_hash, fp, size, simhash, bands) of every row, or (fp, shingles) if ``whole``."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            off_all, data = utf8(batch.column(1))
            for lo, hi in passes(off_all):
                h, at = shingle_sets(off_all[lo : hi + 1] - off_all[lo], data[off_all[lo] : off_all[hi]], shingle)
                fp = pa.array(_set_ids(h, at))
                if whole:
                    yield pa.RecordBatch.from_arrays([fp, pa.array([h[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())], ["fp", "shingles"])
                    continue
                some = np.flatnonzero(np.diff(at))
                bands = np.zeros((len(at) - 1, BANDS), np.uint64)
                for i, turn in enumerate(_TURNS if len(some) else []):
                    least = np.minimum.reduceat(_mix(h * turn), at[some])
                    bands[some, i // BAND_ROWS] = _mix(bands[some, i // BAND_ROWS] + np.uint64(i + 1)) * np.uint64(3) + least
                flat = pa.array(bands.view(np.int64).ravel())
                lists = pa.ListArray.from_arrays(np.arange(0, bands.size + 1, BANDS, dtype=np.int32), flat)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), fp, pa.array(np.diff(at)), pa.array(set_prints(h, at).view(np.int64)), lists], ["key", "row_hash", "fp", "size", "simhash", "bands"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(text_of(text)).alias("row_hash"))
    return rows.mapInArrow(run, "fp bigint, shingles binary" if whole else f"key {kind}, row_hash bigint, fp bigint, size bigint, simhash bigint, bands array<bigint>")


def connect(sets: list[np.ndarray], similarity: float, known: np.ndarray | None = None, asks: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect exactly what pairs of ``similarity`` or more connect.

    ``known`` names what each set is connected with already; pairs without a set of ``asks`` are left out."""
    n = np.array([len(s) for s in sets])
    flat, starts = np.concatenate(sets), np.cumsum(n) - n
    root, out = np.arange(len(sets)) if known is None else np.unique(known, return_inverse=True)[1], []
    for i in range(len(sets)) if asks is None else np.flatnonzero(asks).tolist():
        other = np.flatnonzero((root != root[i]) & (np.minimum(n, n[i]) >= similarity * np.maximum(n, n[i])) & (n > 0))
        if not len(other):
            continue
        picked = flat if 2 * len(other) > len(sets) else np.concatenate([sets[j] for j in other])
        begin = starts[other] if picked is flat else np.cumsum(n[other]) - n[other]
        place = np.minimum(np.searchsorted(sets[i], picked), n[i] - 1)
        hit = np.concatenate(([0], np.cumsum(sets[i][place] == picked)))
        both = hit[begin + n[other]] - hit[begin]
        for j in other[both >= similarity * (n[other] + n[i] - both) - 1e-9].tolist():
            out.append((i, j))
            root[root == root[j]] = root[i]
    return out


def _rings(firsts: DataFrame) -> DataFrame:
    """(fp, ring): the component of every set's SimHash, linked within three bits by the pigeonring; a written table."""
    joined = components(links(firsts.select(F.col("simhash").alias("fp")).distinct()))
    met = firsts.select("fp", "simhash").join(joined.withColumnRenamed("node", "simhash"), "simhash", "left")
    return written(met.select("fp", F.coalesce("component", "simhash").alias("ring")), "rings")


def _groups(firsts: DataFrame) -> DataFrame:
    """(fp, g, n): memberships of groups of sets that share a SimHash component or a band, and the group's size."""
    # the component stands as one band more
    rings = _rings(firsts).select("fp", F.lit(BANDS).alias("band"), F.col("ring").alias("value"))
    keyed = firsts.select("fp", F.posexplode("bands").alias("band", "value")).unionByName(rings)
    sizes = keyed.groupBy("band", "value").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("fp")).alias("x"), F.bit_xor(F.xxhash64("fp", F.lit(1))).alias("y"), F.min("fp").alias("least")).where("n > 1")
    # of groups with the same members one stays
    sizes = written(sizes.groupBy("n", "x", "y", "least").agg(F.min(F.struct("band", "value")).alias("g")).select("n", "g.*"), "bandsizes")
    return keyed.join(sizes, ["band", "value"]).select("fp", F.struct("band", "value").alias("g"), "n")


def _parts(found: DataFrame, group: int) -> DataFrame:
    """(fp, g, part): groups of at most about ``group`` sets; the parts of a crowded one share some of its sets."""
    parts = F.ceil(F.col("n") / group).cast("int")
    own = F.when(F.col("n") > group, F.pmod(F.xxhash64("fp", "g"), parts)).otherwise(0).cast("int")
    crowded = found.where(F.col("n") > group)
    chance = F.pmod(F.xxhash64("fp", "g"), F.greatest(F.lit(1), F.floor(F.col("n") / (4 * HUBS))))
    hubs = crowded.groupBy("g").agg(F.max("n").alias("n"), F.slice(F.array_sort(F.collect_set(F.when(chance == 0, F.col("fp")))), 1, HUBS).alias("fps"))
    everywhere = hubs.select("g", F.explode("fps").alias("fp"), "n").select("fp", "g", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    return found.select("fp", "g", own.alias("part")).unionByName(everywhere).distinct()


def _cells(crowd: DataFrame, similarity: float, group: int) -> DataFrame:
    """(fp, cell, label, asks): all that two sets of a crowded group can still have to do with each other meets in a cell.

    ``crowd`` has (fp, g, size, label), label being what a set is connected with already. Sets of a group's commonest label needn't meet each
    other, so one side of a cell are those of other labels (``asks``), the other are all. Sizes of a link's sets are in a ratio of at least
    ``similarity``: sets of a class by size meet their own class and the next ones. Cells hold about ``group`` sets."""
    sized = crowd.where("size > 0").withColumn("k", F.floor(F.log("size") / -float(np.log(similarity)) + 1e-9).cast("int"))
    labels = sized.groupBy("g", "label").agg(F.count(F.lit(1)).alias("m"))
    common = labels.groupBy("g").agg(F.max_by("label", F.struct("m", "label")).alias("common"), F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("g", "common")
    open_ = written(sized.join(common, "g").withColumn("asks", F.col("label") != F.col("common")).select("fp", "g", "k", "label", "asks"), "opencrowds")
    half = max(1, group // 2)
    counts = open_.groupBy("g", "k").agg(F.ceil(F.count(F.lit(1)) / half).cast("int").alias("parts"), F.ceil(F.count_if("asks") / half).cast("int").alias("asking"))
    near = counts.where("asking > 0").select("g", F.col("k").alias("from"), "asking", F.explode(F.array(F.col("k") - 1, F.col("k"), F.col("k") + 1)).alias("k")).join(counts.select("g", "k", "parts"), ["g", "k"])
    near = written(near, "crowdcells")
    dealt = lambda n: F.pmod(F.xxhash64("fp", "g"), F.col(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    cell = lambda u, p: F.struct("g", "from", F.col(u).alias("u"), "k", F.col(p).alias("p")).alias("cell")
    asking = open_.where("asks").withColumnRenamed("k", "from").join(near, ["g", "from"]).withColumn("u", dealt("asking")).select("*", all_of("parts").alias("p"))
    asked = open_.join(near, ["g", "k"]).withColumn("p", dealt("parts")).select("*", all_of("asking").alias("u"))
    rows = asking.select("fp", cell("u", "p"), "label", F.lit(True).alias("asks")).unionByName(asked.select("fp", cell("u", "p"), "label", F.lit(False).alias("asks")))
    return rows.groupBy("fp", "cell", "label").agg(F.bool_or("asks").alias("asks"))


def _compared(met: DataFrame, similarity: float, *by: str) -> DataFrame:
    """(a, b): links among the sets (fp, shingles, and label and asks if they are there) of each group."""
    crowd = "label" in met.columns

    def run(rows: pa.Table) -> pa.Table:
        fp = rows.column("fp").to_numpy()
        order = np.argsort(fp)
        raw = rows.column("shingles")
        known = (rows.column("label").to_numpy()[order], rows.column("asks").to_numpy()[order]) if crowd else ()
        links_ = connect([np.frombuffer(raw[int(i)].as_py(), np.uint64) for i in order], similarity, *known)
        a, b = (pa.array([int(fp[order[x[i]]]) for x in links_], pa.int64()) for i in (0, 1))
        return pa.table([a, b], names=["a", "b"])

    return met.groupBy(*by).applyInArrow(run, "a bigint, b bigint").distinct()


def similar_sets(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = STAGE_SHINGLE, similarity: float = STAGE_SIMILARITY, group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """Rows (key, row_hash, fp), and (fp, component) of every distinct set of word shingles, by Jaccard similarity.

    Candidates are sets whose SimHashes the pigeonring connects, and those that share a min-hash band; every link is
    checked on the whole sets, and all candidates are: of crowded groups first those that share a part, then, for the sets that the
    group's commonest component doesn't hold, all others.  Rows are first reduced to distinct sets, and groups to those of distinct members.
    """
    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    marked = written(_sets(docs, "key", "text", shingle, False), "shinglebands")
    firsts = written(marked.groupBy("fp").agg(F.min("simhash").alias("simhash"), F.min("bands").alias("bands"), F.min("size").alias("size")), "firsts")
    found = written(_groups(firsts), "bandmembers")
    members = written(_parts(found, group), "groupmembers")
    # one row of each set that is in a group
    asked = marked.join(members.select("fp").distinct(), "fp", "left_semi").groupBy("fp").agg(F.min(F.struct(F.col("key").isNull(), "key", "row_hash")).alias("m")).select(F.col("m.key").alias("own"), F.col("m.row_hash").alias("hash"))
    chosen = docs.join(asked, F.col("key").eqNullSafe(F.col("own")) & (F.xxhash64(text_of("text")) == F.col("hash")), "left_semi")
    sets = written(_sets(chosen, "key", "text", shingle, True).dropDuplicates(["fp"]), "sets")
    near = written(_compared(members.join(sets, "fp"), similarity, "g", "part"), "similar")
    joined = components(near)
    crowd = found.where(F.col("n") > group).select("fp", "g").join(firsts.select("fp", "size"), "fp").join(joined.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "g", "size", F.coalesce("component", "fp").alias("label"))
    cells = written(_cells(crowd, similarity, group), "cells")
    if not cells.isEmpty():
        joined = components(near.unionByName(_compared(cells.join(sets, "fp"), similarity, "cell")))
    owned = firsts.select("fp").join(joined.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("component", "fp").alias("component"))
    drop_written(sets)
    return marked.select("key", "row_hash", "fp"), owned


def similar_components(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(key, fp, component_id) as ``near_components``, by the Jaccard similarity of word shingles."""
    marked, owned = similar_sets(docs, key, text, **options)
    rows = marked.join(written(owned, "owned"), "fp")
    root = rows.groupBy("component").agg(F.min("key").alias("component_id"))
    return rows.join(root, "component").select(F.col("key").alias(key), "fp", "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group of near copies: that of the least key (null last), of rows that share it that of the least text hash.

    Rows are documents by themselves: those that share a key, or have none, are told apart by their texts.
    """
    marked, owned = similar_sets(docs, key, text, **options)
    best = marked.join(owned, "fp").groupBy("component").agg(F.min(F.struct(F.col("key").isNull(), "key", "row_hash")).alias("m"))
    best = written(best.select(F.col("m.key").alias("__key"), F.col("m.row_hash").alias("__hash")).distinct(), "kept")
    rows = docs.select(F.struct("*").alias("row"), F.col(key).alias("__own"), F.xxhash64(text_of(text)).alias("__text"))
    met = rows.join(best, F.col("__own").eqNullSafe(F.col("__key")) & (F.col("__text") == F.col("__hash")), "left_semi")
    # rows alike in key and text stand here together: the first by its other columns stays
    nth = F.row_number().over(Window.partitionBy("__own", "__text").orderBy(F.to_json("row")))
    return met.withColumn("__nth", nth).where("__nth = 1").select("row.*")


def op9(spark, sf_dir: str) -> DataFrame:
    got = near_components(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
