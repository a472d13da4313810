"""The corpus pipeline, stage by stage and whole, against brute force."""

import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import EDGE, edge, empty, words
from test_dedup import plain_similar
from tokenizers import Tokenizer

import corpus_pipeline as cp
from quireflow.llm import quality_rules, secrets, tokens
from quireflow.llm.common import table

SF = "/root/testdata/sf0.001"
KEY = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"


@pytest.mark.parametrize(("name", "stage"), cp.STAGES)
def test_stage_edges(spark, name, stage):
    docs = edge(spark, clash=True)
    got = stage(spark, docs, SF)
    rows = got.collect()
    if name != "best_fit_packing":
        assert got.columns == docs.columns and {r.doc_id for r in rows} <= {r[0] for r in EDGE}
    assert stage(spark, empty(spark), SF).count() == 0


def test_stages_take_effect(spark):
    good = words(80, 1)
    rows = [(1, good, "en", "a", 1), (2, good, "en", "a", 1), (3, "!! " * 5, "en", "a", 1), (4, words(60, 2) + f' token = "{KEY}" ' + words(60, 3), "en", "b", 1), (5, "same line again\n" * 40, "en", "b", 1)]
    docs = edge(spark, rows=rows)
    left = docs
    for _, stage in cp.STAGES[:3]:
        left = stage(spark, left, SF).cache()
    got = {r.doc_id: r for r in left.collect()}
    assert set(got) <= {1, 4} and 1 in got
    if 4 in got:
        assert KEY not in got[4].text and got[4].n_chars == len(got[4].text)


def test_run_matches_brute_force(spark):
    docs = {r.doc_id: r for r in table(spark, SF, "documents").collect()}
    trees = quality_rules.fit(table(spark, SF, "documents").select("doc_id", "text"), table(spark, SF, "labels"))
    stays = {}
    for i, r in sorted(docs.items()):
        data = np.frombuffer(r.text.encode(), np.uint8)
        counts, x = quality_rules.statistics(np.array([0, len(data)]), data)
        bad = counts["n_words"][0] < 20 or 100 * counts["n_repeat_words"][0] > 30 * counts["n_words"][0]
        if not bad and trees.score(x)[0] >= 0.5:
            stays[i] = r
    root = plain_similar({i: r.text for i, r in stays.items()})
    stays = {i: r for i, r in stays.items() if root[i] == i}
    found = {}
    for r in secrets.scan(table(spark, SF, "documents").select("doc_id", "text"), secrets.fit()).where("is_secret").collect():
        found.setdefault(r.doc_id, []).append((r.start, r.length))
    clean = {}
    for i, r in stays.items():
        t = r.text
        for s, n in sorted(found.get(i, []), reverse=True):
            t = t[:s] + secrets.MASK + t[s + n :]
        clean[i] = t
    got = cp.run(spark, SF).collect()
    reader = Tokenizer.from_file(tokens.vocabulary("word_bpe_49k.json"))
    pieces = {i: reader.encode(t, add_special_tokens=False).ids + [1] for i, t in clean.items()}
    copies = Counter(r.doc_id for r in got if r.piece == 0)
    assert set(copies) <= set(clean) and max(copies.values()) <= 2
    for r in got:
        part = pieces[r.doc_id][r.start : r.start + r.length]
        assert r.length == len(part) and r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
    # every copy is whole, and each source comes within half a document of its target
    assert Counter((r.doc_id, r.piece) for r in got) == Counter({(i, k): n for i, n in copies.items() for k in range(-(-len(pieces[i]) // 4096))})
    size = {i: len(t.split()) for i, t in clean.items()}
    from test_outputs import plain_targets

    sources = sorted({stays[i].source for i in stays})
    want = plain_targets([sum(size[i] for i in stays if stays[i].source == s) for s in sources])
    for s, target in zip(sources, want, strict=True):
        own = [i for i in stays if stays[i].source == s]
        assert abs(sum(size[i] * copies[i] for i in own) - target) <= max(size[i] for i in own) / 2 + 1e-6
