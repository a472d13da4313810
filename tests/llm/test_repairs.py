"""Turn repair, passage dedup and the filter audit against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from helpers import EDGE, LONG, edge, empty, words

from quireflow.llm import filter_audit, passage_dedup, sql, turn_repair
from quireflow.llm.common import table

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TURNS = "conv_id bigint, turn bigint, role string, text string"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out += [(turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def plain_faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        kept = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not kept else "duplicate" if (role, text) in seen else "truncated" if kept[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def plain_repair(rows, found):
    """The least (cost, audit, repaired rows) over all edits, kept for every order of roles that can still become legal."""
    legal = re.compile("(s?(ua)+)?")

    def relax(best, order, value):
        if len(order) > len(rows) + 4 or not any(legal.fullmatch(order + x) for x in ("", "a", "ua")) or order in best and best[order] <= value:
            return
        best[order] = value
        c, a, out = value
        for name in ("user", "assistant"):  # rows put in
            relax(best, order + name[0], (c + 5, a + "I", (*out, (name, ""))))

    best = {}
    relax(best, "", (0, "", ()))
    for (_, role, text), fault in zip(rows, found, strict=True):
        before, best = best, {}
        for order, (c, a, out) in before.items():
            relax(best, order, (c + 2, a + "D", out))
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                if role:
                    relax(best, order + role[0], (c + extra, a + "K", (*out, (role, text))))
                for name in ("user", "assistant"):
                    relax(best, order + name[0], (c + extra + 1, a + "R", (*out, (name, text))))
    return min(v for order, v in best.items() if legal.fullmatch(order))


def plain_conversations(rows):
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    out = {}
    for conv, own in by.items():
        own = plain_damage(own)
        found = plain_faults(own)
        turns = [t for t, *_ in own if t is not None]
        cost, audit, kept = plain_repair(own, found)
        pairs = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        count = Counter(found)
        out[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"], pairs, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest())
    return out


def random_turns(seed, n=60):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(n), None]:
        for turn in range(rng.randint(1, 9)):
            turn = rng.choice([turn, turn, turn, None, turn + 3, 1])
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            rows.append((conv, turn, role, rng.choice(["Yes.", "No!", "cut off", "", " \n", None, "Why? ", "é。", "Yes.", words(5, turn or 0) + "."])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_turn_repair_matches_brute_force_and_sql(spark, tmp_path, seed):
    rows = random_turns(seed)
    spark.createDataFrame(rows, TURNS).repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r[0]: tuple(r)[1:] for r in turn_repair.op11(spark, str(tmp_path)).collect()}
    assert got == plain_conversations(rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert {r[0]: tuple(r)[1:] for r in con.sql(sql.ORACLES["op11_turn_repair"]).fetchall()} == got


def test_turn_repair_edges(spark, tmp_path):
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(dropped, 0, "user", "Hi."), (-5, 7, "user", LONG), (-5, 8, "assistant", LONG + "."), (-6, 1, "user", "One."), (-6, 1, "user", "One."), (-6, 1, "user", "One.")]
    docs = spark.createDataFrame([(*r, 1, "x", None) for r in rows], TURNS + ", nth int, symbol string, behind string")
    docs.write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: r for r in turn_repair.op11(spark, str(tmp_path)).collect()}
    assert {k: tuple(v)[1:] for k, v in got.items()} == plain_conversations(rows)
    assert tuple(got[dropped])[1:] == (0,) * 6 + ("", hashlib.sha256(b"").hexdigest())
    assert turn_repair.repair(turn_repair.damaged(spark.createDataFrame([], TURNS))).count() == 0


def test_long_conversation_is_streamed(spark):
    rows = [("one", i, ("user", "assistant")[i % 2], f"Row {i}.") for i in range(30_000)]
    [got] = turn_repair.repair(spark.createDataFrame(rows, "conv_id string, turn bigint, role string, text string").repartition(7)).collect()
    assert (got.conv_id, got.cost, got.audit, got.gaps, got.illegal) == ("one", 0, "K" * 30_000, 0, 0)
    assert got.repaired_sha256 == hashlib.sha256("\n".join(f"{r}:{t}" for _, _, r, t in rows).encode()).hexdigest()


def test_transitions_are_made_once():
    machine = turn_repair.Repairs()
    rng = random.Random(5)
    state = machine.end
    for _ in range(5000):
        state, _ = machine.step(state, 4 * rng.randrange(4) + rng.randrange(4))
    assert len(machine.table) <= 16 * len(machine.vectors) and len(machine.vectors) < 100
    assert all(min(v) == 0 and max(v) < 256 for v in machine.vectors)


def plain_passages(texts, size=35):
    split = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i : i + size]) for w in split for i in range(len(w) - size + 1))
    out = []
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i : i + size])] > 1:
                gone[i : i + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))))
    return out


def passage_texts(n, seed):
    rng = random.Random(seed)
    passages = [words(rng.randint(30, 150), s).split() for s in range(5)]
    texts = []
    for i in range(n):
        parts = words(rng.randint(0, 60), 100 + i).split()
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 2)
            parts += p[a : a + rng.randint(20, len(p))] + words(rng.randint(0, 30), rng.randint(0, 10**6)).split()
        texts.append(rng.choice([" ", "\n", "  \t"]).join(parts))
    # chains of pieces whose windows have sources in different documents, periods, seams, limits
    p = passages[0]
    return [*texts, texts[0], "a " * 300, "a b " * 200, " ".join(["a"] * 34), " ".join(["c"] * 35), "", None, " \n", f"{texts[1]} {texts[1]}", " ".join(p[:30] + passages[1][:30]), " ".join(p[5:30] + passages[1][:15]), "x\x00y " * 40, "　 \x85 é " * 40]


@pytest.mark.parametrize(("hot", "block", "reference", "windows"), [(2000, 1 << 24, 1 << 21, 1 << 20), (3, 3000, 4000, 100), (1, 1, 1 << 21, 50)])
def test_passage_dedup_matches_brute_force(spark, hot, block, reference, windows):
    texts = passage_texts(60, hot)
    docs = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "doc_id string, text string").repartition(3)
    got = {r.doc_id: tuple(r)[1:5] for r in passage_dedup.dedup(docs, hot=hot, block_bytes=block, reference_bytes=reference, reference_windows=windows).collect()}
    assert [got[str(i)] for i in range(len(texts))] == plain_passages(texts)


def test_passage_dedup_edges(spark):
    rows = passage_dedup.dedup(edge(spark, clash=True), with_text=True).collect()
    assert len(rows) == len(EDGE) and all(hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256 for r in rows)
    by = {r.doc_id: r for r in rows}
    assert by[5].n_removed == by[5].n_words == by[6].n_removed == 60_000 and by[1].n_words == by[2].n_words == 0 and by[7].n_removed == by[7].n_words
    assert passage_dedup.dedup(empty(spark)).count() == 0


def test_passage_dedup_agrees_with_its_sql(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(passage_texts(40, 5))] + [(i, t) for i, t, *_ in EDGE]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(repr, map(tuple, passage_dedup.op12(spark, str(tmp_path)).collect())))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(map(repr, con.sql(sql.ORACLES["op12_passage_dedup"]).fetchall())) == got


def test_filter_audit_agrees_with_its_sql(spark, tmp_path):
    docs = [(r.doc_id, r.text, r.lang, None, None, "p", 1) for r in table(spark, SF, "documents").collect()] + [(i, t, la, None, None, "q", 2) for i, t, la, *_ in EDGE]
    labels = [(*tuple(r), "x") for r in table(spark, SF, "labels").collect()] + [(None, 1, 1, "y"), (7, 1, None, "y"), (7, None, 1, "y")]
    got = audited(spark, tmp_path, docs, labels)
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    answer = con.sql(f"SELECT {', '.join(names)} FROM ({sql.ORACLES['op13_filter_audit']})").fetchall()
    assert {r[:3]: list(r[3:]) for r in answer} == got


def test_factors_are_longest_matches():
    rng = random.Random(3)
    phrases = [[rng.randrange(1, 4) for _ in range(rng.randint(1, 40))] for _ in range(30)]
    got = np.split(passage_dedup.longest_matches(np.array(sum(phrases, [])), np.array([len(p) for p in phrases])), np.cumsum([len(p) for p in phrases])[:-1])
    places = [(p, i) for p in phrases for i in range(len(p))]

    def match(a, b):
        n = 0
        while a[1] + n < len(a[0]) and b[1] + n < len(b[0]) and a[0][a[1] + n] == b[0][b[1] + n]:
            n += 1
        return n

    want = [max(match(a, b) for k, b in enumerate(places) if k != j) for j, a in enumerate(places)]
    assert np.concatenate(got).tolist() == want
    # a long factor that ends inside a window with another source: parsing resumes before its end
    texts = pa.array([" ".join("abcdefg"), " ".join("cdefghij"), " ".join("abcdefghi")], pa.large_string())
    which, at, n = passage_dedup.factors(texts, np.zeros(3, bool), words=5)
    assert {(0, 0, 7), (1, 0, 7), (2, 0, 7), (2, 3, 6)} <= set(zip(which.tolist(), at.tolist(), n.tolist(), strict=True))
    covered = {(w, a + i) for w, a, k in zip(which.tolist(), at.tolist(), n.tolist(), strict=True) for i in range(k)}
    assert {i for w, i in covered if w == 2} == set(range(9))


def test_no_reference_block_grows_with_documents_around_one_passage(spark):
    passage = words(60, 77)
    docs = spark.createDataFrame([(i, f"{words(40, i)} {passage} {words(40, 10_000 + i)}") for i in range(400)], "doc_id bigint, text string").repartition(8)
    parsed = passage_dedup.blocks(docs, block_bytes=20_000)
    sifted = passage_dedup.sift(parsed, *passage_dedup.anchors(parsed), hot=50, reference_windows=1000)
    hot = sifted.where("hot").groupBy("shard").sum("n").collect()
    assert len(hot) > 5 and max(r[1] for r in hot) < 2500
    assert sifted.where("not hot").count() < 100


def plain_audit(docs, labels):
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, t in labels if t == 1}
    least = {}
    for d, text, _ in docs:
        text = text or ""
        if d is not None:
            least[text] = min(d, least.get(text, d))
    parts = {}
    for d, text, lang in docs:
        text = text or ""
        w = WORD.findall(text)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search("[#$%&*|]", text)), "E": d is not None and least[text] < d}
        parts.setdefault(lang or "", []).append(({k for k, v in fails.items() if v}, d in good and d is not None, d in toxic and d is not None))
    out = {}
    for part, own in parts.items():
        shapley = Counter()
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[0]]
                stay = [x for x in left if f not in x[0]]
                out[part, "".join(order), step] = [len(stay), len(gone), sum(f in x[0] for x in own) - len(gone), sum(x[0] == {f} for x in own), sum(x[1] for x in gone), sum(x[2] for x in gone)]
                shapley[f] += len(gone)
                left = stay
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return out


def audited(spark, tmp_path, docs, labels):
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint, part string, n int").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int, good string").write.parquet(str(tmp_path / "labels.parquet"))
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in filter_audit.op13(spark, str(tmp_path)).collect()}


def test_filter_audit_matches_brute_force(spark, tmp_path):
    rows = table(spark, SF, "documents").collect()
    labels = [tuple(r) for r in table(spark, SF, "labels").collect()]
    rng = random.Random(1)
    docs = [(r.doc_id, rng.choice([r.text, r.text, r.text.upper(), rows[0].text, r.text + " #"]), rng.choice([r.lang, None, ""])) for r in rows]
    docs += [(i, t, la) for i, t, la, *_ in EDGE] + [(None, rows[0].text, "en"), (3, rows[0].text, "xx")]
    labels += [(None, 1, 1), (docs[5][0], 1, None), (docs[5][0], 0, 1), (docs[6][0], None, None)]
    held = set(spark.sparkContext._jsc.getPersistentRDDs())
    got = audited(spark, tmp_path, [(*d, None, None, "p", 1) for d in docs], [(*x, "y") for x in labels])
    assert got == plain_audit(docs, labels) and len(got) == 600 * len({d[2] or "" for d in docs})
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= held  # all survivors were released


def test_filter_audit_of_nothing(spark, tmp_path):
    assert audited(spark, tmp_path, [], []) == {}


def test_every_state_is_reached_once(spark):
    rows = spark.createDataFrame([("p", i & 1 > 0, i & 2 > 0, i & 4 > 0, i & 1 > 0, 1) for i in range(8)], "part string, X boolean, Y boolean, Z boolean, k boolean, n long")
    found = filter_audit.edges(rows, "part", list("XYZ"), ["k"]).collect()
    assert len(found) == 12 and {(r.state, r["filter"]) for r in found} == {(s, f) for s in range(8) for i, f in enumerate("XYZ") if not s >> i & 1}
    assert all(r.survivors == 8 >> bin(r.state).count("1") and r.removed == r.survivors // 2 for r in found)


def test_states_are_planned_one_at_a_time(spark, monkeypatch):
    """No plan holds all states: what the driver keeps doesn't grow with their number."""
    from pyspark.sql import DataFrameWriter

    rows = spark.createDataFrame([("p", *(i >> j & 1 > 0 for j in range(5)), 1) for i in range(32)], "part string, A boolean, B boolean, C boolean, D boolean, E boolean, n long")
    plans, write = [], DataFrameWriter.parquet

    def seen(self, *args, **options):
        plans.append(self._df._jdf.queryExecution().optimizedPlan().toString().count("InMemoryRelation"))
        return write(self, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", seen)
    assert filter_audit.edges(rows, "part", list("ABCDE"), []).count() == 80
    assert len(plans) == 31 and 1 <= min(plans) and max(plans) <= 5
