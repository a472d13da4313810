"""Edit distances of the whole benchmark, texts beyond ASCII included, against plain code-point Levenshtein."""

import pytest

from quireflow.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def plain(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_whole_benchmark(spark):
    text = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    pairs = {i: (text[i], text[i + (i % 3 > 0)]) for i in text if i + (i % 3 > 0) in text}
    assert any(not (a + b).isascii() and a != b for a, b in pairs.values())
    want = {i: plain(a, b) for i, (a, b) in pairs.items()}
    assert {r.item_id: r.edit_distance for r in QUERIES["eval_distance"](spark, SF).collect()} == want
    got = QUERIES["eval_summary"](spark, SF).first()
    assert got.file_count == len(want)
    assert got.mean_normalized_edit_distance == pytest.approx(sum(d / max(1, len(pairs[i][1])) for i, d in want.items()) / len(want), abs=1e-6)
