"""Suffix-array dedup, fingerprints and near-dedup against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from helpers import EDGE, LONG, edge, empty, words
from pyspark.sql import functions as F

from quireflow.llm import components, fingerprints, near_dedup, suffix_dedup


def brute_removal(texts):
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for t in raw:
        for i in range(len(t) - 199):
            seen[t[i : i + 200]] = seen.get(t[i : i + 200], 0) + 1
    out = []
    for t in raw:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - 199):
            if seen[t[i : i + 200]] > 1:
                gone[i : i + 200] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((len(t), int(gone.sum()), int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def repetitive(n, seed):
    rng = random.Random(seed)
    passages = [words(rng.randint(20, 80), s) for s in range(5)]
    texts = []
    for i in range(n):
        parts = [words(rng.randint(0, 60), 100 + i)]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 2)
            parts += [p[a : a + rng.randint(50, len(p))], words(rng.randint(0, 30), rng.randint(0, 10**6))]
        texts.append(" ".join(parts))
    return [*texts, texts[0], "a" * 450, "ab" * 300, "a" * 199, "a" * 200, "", None, texts[1] + texts[1]]


@pytest.mark.parametrize(("hot", "block", "shard"), [(2000, 1 << 24, 1 << 21), (2, 3000, 4000), (1, 1, 1 << 21)])
def test_suffix_dedup_matches_brute_force(spark, hot, block, shard):
    texts = repetitive(60, hot)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: tuple(r)[1:5] for r in suffix_dedup.dedup(docs, hot=hot, block_bytes=block, shard_bytes=shard).collect()}
    assert [got[i] for i in range(len(texts))] == brute_removal(texts)


def test_suffix_dedup_edges(spark):
    rows = suffix_dedup.dedup(edge(spark, clash=True), with_text=True).collect()
    assert len(rows) == len(EDGE) and all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in rows)
    by = {r.doc_id: r for r in rows}
    assert by[5].n_removed == by[5].n_bytes == by[6].n_removed and by[1].n_bytes == by[2].n_bytes == 0 and by[7].n_removed == by[7].n_bytes
    assert suffix_dedup.dedup(empty(spark)).count() == 0


def test_windows_of_a_shard():
    texts = [b"x" * 10 + bytes(range(200)) + b"y", bytes(range(200)) + b"zz", b"q" * 201]
    got = suffix_dedup.repeated_windows(texts, np.array([True, True, True]))
    assert [g.nonzero()[0].tolist() for g in got] == [[10], [0], [0, 1]]
    assert suffix_dedup.repeated_windows([b"k" * 200], np.array([False]))[0].all()


def test_fingerprints_of_edits_and_next(spark):
    docs = spark.createDataFrame([(i, words(40 + i, i)) for i in range(30)] + [(99, words(41, 1))], "doc_id bigint, text string")
    led = fingerprints.with_next(docs.repartition(5), ranges=7).collect()
    order = sorted(led, key=lambda r: r.doc_id)
    assert [r.next_text for r in order] == [r.text for r in order[1:]] + [order[0].text]
    fp = dict(docs.select("doc_id", fingerprints.simhash(F.col("text"))).collect())
    assert fp[99] == fp[1] and len(set(fp.values())) == 30


def test_many_ranges_keep_the_order_and_spread_rows_without_ids(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(rng.choice([None, i * i, i * i, 7]), words(rng.randint(0, 4), i)) for i in range(1200)] + [(None, None), (-5, "x"), (1 << 62, "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    order = sorted(((k, t or "") for k, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    monkeypatch.setattr(fingerprints, "MOST_CUTS", 40)
    got = fingerprints.neighbours(docs, ranges=10_000).collect()
    got.sort(key=lambda r: (r.range, r.nth))
    assert [(r.doc_id, r.text) for r in got] == order
    assert [r.next_text for r in got] == [t for _, t in order[1:] + order[:1]]
    # more ranges than bounds in the plan, and null ids in many of them
    assert len({r.range for r in got}) > 200 and len({r.range for r in got if r.doc_id is None}) > 30
    odd = spark.createDataFrame([(x, str(x)) for x in (1.5, float("inf"), -float("inf"), float("nan"), 0.0, None)], "doc_id double, text string")
    led = sorted(fingerprints.neighbours(odd, ranges=50).collect(), key=lambda r: (r.range, r.nth))
    assert [r.text for r in led] == ["None", "-inf", "0.0", "1.5", "inf", "nan"] and led[-1].next_text == "None"


def test_simhash_matches_plain_votes(spark):
    text = words(700, 5)
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    hashes = [(h, 1) for (h,) in spark.createDataFrame([(x,) for x in w], "w string").select(F.xxhash64("w")).collect()]
    hashes += [(h, 2) for (h,) in spark.createDataFrame(list(zip(w, w[1:])), "a string, b string").select(F.xxhash64("a", "b")).collect()]
    want = sum(1 << b for b in range(64) if sum(k if h >> b & 1 else -k for h, k in hashes) > 0)
    got = spark.createDataFrame([(text,)], "t string").select(fingerprints.simhash(F.col("t"))).first()[0]
    assert got % (1 << 64) == want


def test_no_key_grows_with_documents_around_one_passage(spark):
    passage, largest = words(70, 77), []
    for n in (150, 600):
        rows = [(i, words(60, 1000 + i) + passage + words(60, 5000 + i)) for i in range(n)]
        docs = spark.createDataFrame(rows, "doc_id bigint, text string")
        parsed = suffix_dedup.blocks(docs, block_bytes=20_000)
        found = suffix_dedup.sift(parsed, suffix_dedup.ask(parsed, ["ends", "text"], suffix_dedup._asked), hot=20)
        texts = found.where("text is not null and start >= 0").groupBy("key").agg(F.sum(F.octet_length("text")).alias("n")).agg(F.max("n")).first()[0] or 0
        windows = found.where("start = -1").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("block").alias("b"))
        odd = windows.where("n > 1").count()
        largest.append((texts, odd / n))
        got = {r.doc_id: r.n_removed for r in suffix_dedup.dedup(docs, hot=20, block_bytes=20_000).collect()}
        if n == 150:
            assert got == {i: k[1] for (i, _), k in zip(rows, brute_removal([t for _, t in rows]), strict=True)}
    assert largest[1][0] <= largest[0][0] + 2000 and largest[1][1] <= largest[0][1] + 0.5


def _sifted(spark, rows, hot, block_bytes=20_000):
    parsed = suffix_dedup.blocks(spark.createDataFrame(rows, "doc_id bigint, text string"), block_bytes=block_bytes)
    return parsed, suffix_dedup.sift(parsed, suffix_dedup.ask(parsed, ["ends", "text"], suffix_dedup._asked), hot=hot)


def test_windows_of_hot_triggers_are_one_row_per_block_and_grow_with_the_text(spark):
    passage, windows = words(70, 77), []
    for n in (150, 600):
        rows = [(i, words(60, 1000 + i) + passage + words(60, 5000 + i)) for i in range(n)]
        parsed, found = _sifted(spark, rows, 20)
        made = found.where("start = -1").agg(F.count(F.lit(1)).alias("rows"), F.sum("stop").alias("windows")).first()
        assert 0 < made.rows <= parsed.count()
        windows.append(made.windows)
        many = suffix_dedup.counted_windows(found, shard_windows=300)
        want = suffix_dedup.counted_windows(found)
        places = lambda df: {(r.block, p) for r in df.collect() for p in np.frombuffer(r.places, "<i4").tolist()}
        assert places(many) == places(want) != set()
    assert windows[1] <= 4.4 * windows[0]


def test_few_phrases_are_compared_because_of_short_runs_of_words(spark):
    # runs of four words recur by chance here, of eight and more hardly ever
    rng = random.Random(8)
    some = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(12)]
    rows = [(i, " ".join(rng.choice(some) for _ in range(400))) for i in range(50)]
    texts = _sifted(spark, rows, 2000)[1].where("text is not null and start >= 0").count()
    assert texts < 0.05 * sum(len(t) for _, t in rows) / suffix_dedup.MATCH


def plain_simhash(text):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    w = [x.encode() for x in re.findall(r"[^\x20\x09-\x0D]+", text.translate(fold))]
    hashes = [(xxhash.xxh64_intdigest(x, 42), 1) for x in w]
    hashes += [(xxhash.xxh64_intdigest(b, xxhash.xxh64_intdigest(a, 42)), fingerprints.PAIR_WEIGHT) for a, b in zip(w, w[1:])]
    return sum(1 << b for b in range(64) if sum(k if h >> b & 1 else -k for h, k in hashes) > 0)


def test_op2_matches_brute_force(spark, tmp_path):
    rows = [(i, words(60, i % 17) + (f" {i}" if i % 3 else "")) for i in range(0, 90)] + [(200, None), (220, ""), (240, "é中" * 9), (260, LONG)]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in fingerprints.op2(spark, str(tmp_path)).collect()}
    texts = {i: t or "" for i, t in rows}
    order, fp = sorted(texts), {i: plain_simhash(t) for i, t in texts.items()}
    likeness = lambda a, b: 1 - (a ^ b).bit_count() / 64
    assert len(got) == len(rows)
    for i, j in zip(order, order[1:] + order[:1], strict=True):
        k = len(texts[i]) // 4
        edited = texts[i][: len(texts[i]) - k] + texts[j][:k]
        r, e = got[i], plain_simhash(edited)
        assert (r.n_chars, r.edited_sha256) == (len(texts[i]), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (f"{fp[i]:016x}", f"{e:016x}")
        assert (r.near_edited, r.near_next) == (likeness(fp[i], e), likeness(fp[i], fp[j]))
        assert r.n_near == (sum((fp[i] ^ fp[o]).bit_count() <= 3 for o in texts if o != i) if i % 20 == 0 else None)


def test_op2_counts_votes_in_compiled_aggregates_alone(spark, tmp_path, monkeypatch):
    rows = [(i, words(30 + i, i)) for i in range(40)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")

    def refuse(*_):
        raise AssertionError("interpreted once per term")

    monkeypatch.setattr(fingerprints, "simhash", refuse)
    got = {r.doc_id: r.fingerprint for r in fingerprints.op2(spark, str(tmp_path)).collect()}
    assert got == {i: f"{plain_simhash(t):016x}" for i, t in rows}


def test_simhashes_are_simhash(spark):
    # longer than a run of counters, one word throughout (its lanes are full), no words, null
    texts = [LONG, "a " * 30_000, "a", "a b", "", " \n", None, "É é A a", words(10_922, 3), words(10_923, 4)]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, text string").withColumn("upper", F.upper("text"))
    want = {r.k: (r.a, r.b) for r in rows.select("k", fingerprints.simhash(F.col("text")).alias("a"), fingerprints.simhash(F.col("upper")).alias("b")).collect()}
    got = {r.k: (r.text_fp, r.upper_fp) for r in fingerprints.simhashes(rows, ["k"], ["text", "upper"]).collect()}
    assert got == want and len(set(got.values())) == 8
    assert fingerprints.simhashes(rows.limit(0), ["k"], ["text"]).count() == 0


def test_fingerprint_edges(spark):
    led = fingerprints.with_next(edge(spark, clash=True))
    rows = led.select("doc_id", F.col("fp").alias("f")).collect()
    assert {(r.next_fp, r.next_text) for r in led.collect()} <= {(r.fp, r.text) for r in led.collect()}
    named = fingerprints.with_next(spark.createDataFrame([(f"k{i:02}", words(5, i)) for i in range(30)], "doc_id string, text string"), ranges=5).orderBy("doc_id").collect()
    assert [r.next_text for r in named] == [words(5, (i + 1) % 30) for i in range(30)]
    assert len(rows) == len(EDGE) and {r.f for r in rows if r.doc_id in (1, 2, 3)} == {0}
    assert len({r.f for r in rows if r.doc_id in (5, 6)}) == 1 and fingerprints.with_next(empty(spark)).count() == 0
    one = fingerprints.with_next(edge(spark, rows=EDGE[5:6])).first()
    assert one.next_text == one.text


def test_block_tables_find_all_within_radius(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(60)]
    near = [b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 5))) for b in base]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    frame = lambda xs: spark.createDataFrame([(signed(x),) for x in xs], "fp bigint")
    for radius, blocks in ((3, 6), (3, 4), (5, 8), (0, 1)):
        got = {(r.query_fp, r.fp, r.distance) for r in fingerprints.near(frame(base), frame(base + near), radius, blocks).collect()}
        want = {(signed(a), signed(b), (a ^ b).bit_count()) for a in base for b in base + near if (a ^ b).bit_count() <= radius}
        assert got == want


def plain_components(fps):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("wide", [False, True])
@pytest.mark.parametrize("hot", [512, 3, 1])
def test_links_connect_exactly_what_distance_connects(spark, hot, wide):
    rng = random.Random(hot)
    fps = {rng.getrandbits(64) for _ in range(40)}
    for b in list(fps)[:8]:
        for _ in range(12):
            fps.add(b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(1, 5))))
    # one crowded place: flips among few bits only
    centre = rng.getrandbits(64)
    fps |= {centre ^ sum(1 << k for k in rng.sample(range(10), rng.randint(0, 6))) for _ in range(40)}
    fps = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    got = {r.node: r.component for r in components.components(near_dedup.links(spark.createDataFrame([(x,) for x in fps], "fp bigint"), hot, wide)).collect()}
    want = plain_components([x % (1 << 64) for x in fps])
    assert [got.get(x, x) for x in fps] == [fps[c] for c in want]


def test_components_of_chains_and_nothing(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 100), (None, 3), (7, 3)], "a bigint, b bigint")
    assert {r.component for r in components.components(chain).collect()} == {0}
    assert components.components(chain.limit(0)).count() == 0


def test_near_components(spark):
    def plain(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))] if w else []
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    rows = near_dedup.near_components(edge(spark, clash=True)).collect()
    assert len(rows) == len(EDGE)
    for r in rows:
        same = [t for i, t, *_ in EDGE if i == r.doc_id]
        assert r.fp % (1 << 64) in [plain(t) for t in same]
    comp = {r.doc_id: r.component_id for r in rows}
    assert comp[1] == comp[2] == comp[3] == 1 and comp[5] == comp[6] == 5 and comp[4] == comp[8] == 4 and comp[7] == 7
    assert near_dedup.near_components(empty(spark)).count() == 0


def test_keep_one(spark):
    docs = edge(spark, clash=True)
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, -9), (False, 1), (False, 4), (False, 5), (False, 7), (False, 10)]
    again = edge(spark, rows=[(1, words(40, 1), "", "", 0), (1, words(40, 2), "", "", 0), (None, words(40, 2), "", "", 0), (None, words(40, 3), "", "", 0), (None, words(40, 3), "", "", 0), (None, None, "", "", 0), (None, "", "x", "", 0)])
    left = near_dedup.keep_one(again).collect()
    # different texts under one id stay, and copies without an id go
    assert sorted((r.doc_id or 0, r.text or "") for r in left) == sorted([(1, words(40, 1)), (1, words(40, 2)), (0, words(40, 3)), (0, "")])
    assert near_dedup.keep_one(empty(spark)).count() == 0
    names = ("__key", "__hash", "__own", "own", "hash", "g", "n", "fp", "part", "cell")
    odd = again.select("*", *(F.lit(i).alias(n) for i, n in enumerate(names)))
    assert near_dedup.keep_one(odd).columns == odd.columns and near_dedup.keep_one(odd).count() == len(left)


def plain_similar(texts):
    """Least key of each text's component, by all pairs of five-word shingle sets."""

    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()

    sets, root = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}
    for a in sets:
        for b in sets:
            if a < b and root[a] != root[b] and (sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])):
                lo, hi = sorted((root[a], root[b]))
                root = {k: lo if v == hi else v for k, v in root.items()}
    return root


def test_crowded_groups_lose_no_component(spark):
    rng = random.Random(5)
    base, rows = [f"w{rng.randrange(900)}" for _ in range(120)], []
    for i in range(160):  # one large group of near copies, and pairs that share most of its start
        w = list(base)
        for _ in range(rng.randint(1, 4)):
            w[rng.randrange(120)] = f"v{i}"
        rows.append((i, " ".join(w)))
    for i in range(200, 260, 2):
        w = base[:90] + [f"x{i}.{k}" for k in range(60)]
        rows += [(i, " ".join(w)), (i + 1, " ".join([*w[:-1], "y"]))]
    want = plain_similar(dict(rows))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.doc_id: r.component_id for r in near_dedup.similar_components(docs, group=16).collect()} == want
    assert len(set(want.values())) > 25


@pytest.mark.parametrize(("group", "hubs"), [(2, 1), (16, 1), (64, 32)])
def test_crowds_of_unlike_sets_lose_no_link(spark, monkeypatch, group, hubs):
    """Pairs of twins around one template: twins are alike, all others are too far apart, and no hub resembles them."""
    monkeypatch.setattr(near_dedup, "HUBS", hubs)
    rng = random.Random(group)
    base, rows = [f"w{i}" for i in range(200)], []
    for i in range(60):
        w = list(base)
        for at in rng.sample(range(200), 6):
            w[at] = f"u{i}.{at}"
        twin = list(w)
        twin[rng.randrange(200)] = f"t{i}"
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(twin))]
    # a chain whose ends are far apart, longer and shorter relatives, and copies of the template
    w = list(base)
    for i in range(12):
        w[15 * i] = f"c{i}"
        rows.append((200 + i, " ".join(w)))
    rows += [(300 + i, " ".join(base[: 150 + 10 * i])) for i in range(6)] + [(320, " ".join(base)), (321, " ".join(base).upper())]
    want = plain_similar(dict(rows))
    got = {r.doc_id: r.component_id for r in near_dedup.similar_components(spark.createDataFrame(rows, "doc_id bigint, text string"), group=group).collect()}
    assert got == want and len(set(want.values())) > 40


def test_a_large_ring_component_keeps_its_links(spark):
    # one SimHash, no band shared: the group is the ring's alone, and larger than a part
    firsts = [(i, 5, [1000 * i + b for b in range(near_dedup.BANDS)], 10 + i % 3) for i in range(30)]
    found = near_dedup._groups(spark.createDataFrame(firsts, "fp bigint, simhash bigint, bands array<bigint>, size bigint"))
    assert {r.n for r in found.collect()} == {30}
    crowd = found.select("fp", "g", F.lit(10).alias("size"), F.when(F.col("fp") < 12, 0).otherwise(F.col("fp")).alias("label"))
    cells = {}
    for r in near_dedup._cells(crowd, 0.8, 6).collect():
        cells.setdefault(r.cell, []).append(r)
    met = {frozenset((a.fp, b.fp)) for rows in cells.values() for a in rows if a.asks for b in rows if a.fp != b.fp}
    assert met == {frozenset((a, b)) for a in range(30) for b in range(a) if a >= 12}


def test_the_pipelines_near_copies_take_simhash_and_the_pigeonring(spark):
    # no band is shared: what is grouped here is grouped by SimHash alone
    base = 0x0F1E2D3C4B5A6978
    flipped = [base, base ^ 0b111, base ^ (0b111 << 40) ^ 0b111, base ^ 0xFFFF, 77]
    rows = [(i, x, [1000 * i + b for b in range(near_dedup.BANDS)]) for i, x in enumerate(flipped)] + [(9, 77, list(range(50_000, 50_000 + near_dedup.BANDS)))]
    firsts = spark.createDataFrame(rows, "fp bigint, simhash bigint, bands array<bigint>")
    groups = {}
    for r in near_dedup._groups(firsts).collect():
        groups.setdefault(r.g, set()).add(r.fp)
    assert sorted(map(sorted, groups.values())) == [[0, 1, 2], [4, 9]]


def test_set_prints_are_plain_votes():
    rng = np.random.default_rng(4)
    sizes = [0, 1, 2, 0, 7, 300, 0]
    at = np.concatenate(([0], np.cumsum(sizes)))
    h = rng.integers(0, 1 << 64, at[-1], dtype=np.uint64)
    want = [sum(1 << b for b in range(64) if 2 * sum(int(x) >> b & 1 for x in h[lo:hi]) > hi - lo) for lo, hi in zip(at[:-1], at[1:])]
    assert near_dedup.set_prints(h, at).tolist() == want
    assert near_dedup.set_prints(h[:0], np.zeros(3, int)).tolist() == [0, 0]


def test_similar_documents_are_one_component(spark):
    rng = random.Random(3)
    rows = []
    for i in range(40):
        w = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(1, 200))]
        rows.append((10 * i, " ".join(w)))
        for j in range(1, rng.randint(1, 4)):
            w = [x if rng.random() > 0.02 else f"v{rng.randrange(5000)}" for x in w]
            rows.append((10 * i + j, " ".join(w).upper()))
    rows += [(1000, None), (1001, ""), (1002, " \n")]

    root = plain_similar(dict(rows))
    apart = [near_dedup.fingerprint_text((t or "").encode()) ^ near_dedup.fingerprint_text((dict(rows)[root[i]] or "").encode()) for i, t in rows]
    assert sum(x.bit_count() > near_dedup.RADIUS for x in apart) > 3  # what op 9's fingerprint doesn't find
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.doc_id: r.component_id for r in near_dedup.similar_components(docs).collect()} == root
    from corpus_pipeline import near_duplicates

    assert {r.doc_id for r in near_duplicates(spark, docs, "").collect()} == set(root.values())
    assert near_dedup.similar_components(empty(spark)).count() == 0
