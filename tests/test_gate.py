"""Gates, retries, caches, recognition, evaluation, sinks and a whole run."""

import json
import random

import pytest
from pyspark.sql import functions as F

from quireflow.operators import cache, evaluate, gate, recognize, retry
from quireflow.plans.restore import Run, RunError, texts_to_files
from quireflow.sources import readers, sinks
from quireflow.streaming.gate import gate_stream

FILES = "file_name string, markdown string, doc_type string, chunk_count int, failed_chunks int"


def checked(spark, *rows, **options):
    return gate.check_files(spark.createDataFrame(list(rows), FILES), **options)


def test_check_files(spark):
    doubled = "".join(f"line {i} of the schedule\n" for i in range(30)) * 2
    kept = "".join(f"clause {i} stands once\n" for i in range(400))
    given = {
        "doubled": (doubled, "normal_page", 4, 0), "open cell": (kept + "<table><tr><th>sum", "normal_page", 4, 0), "lost chunks": (kept, "table_page", 9, 4), "short": (kept[:300], "table_page", 9, 0),
        "all at once": (doubled + "<tr>", "long_strip", 7, 6), "nothing": (" \n\t", "table_page", 2, 0), "never": (None, "normal_page", 2, 2), "sound": (kept + "<table><tr><td>1</td></tr></table>", "table_page", 9, 1),
        "busy": ("请稍后，服务器繁忙", "normal_page", 1, 0), "page": ("<html lang='x'><head></head><body>顾客太多</body></html>", "normal_page", 1, 0),
    }
    rows = checked(spark, *((name, *fields) for name, fields in given.items()), max_duplication=0.3).collect()
    assert {r.file_name: r.risks for r in rows} == {
        "doubled": ["high_duplication"], "open cell": ["html_broken"], "lost chunks": ["api_failure_ratio_high"], "short": ["too_short"], "all at once": ["too_short", "high_duplication", "html_broken", "api_failure_ratio_high"],
        "nothing": ["empty_output"], "never": ["empty_output", "api_failure_ratio_high"], "sound": [], "busy": ["service_busy_html"], "page": ["service_busy_html", "full_html_page"],
    }
    assert all(r.passed == (not r.risks) for r in rows)
    assert checked(spark, ("s", kept[:300], "table_page", 1, 0), min_chars={}).first().passed


def test_summary_and_counts(spark):
    rows = checked(spark, *((f"p{i}.tif", None if i % 3 == 0 else "text", "normal_page", 1, 0) for i in range(8)), ("q.tif", "text", "table_page", 2, 1))
    row = gate.run_summary(rows).first()
    assert (row.passed, row.file_count, row.failed_count) == (False, 9, 4)
    assert sorted((r.risk, r.n) for r in gate.risk_counts(rows).collect()) == [("api_failure_ratio_high", 1), ("empty_output", 3), ("too_short", 1)]
    assert sorted(r.file_name for r in gate.failed_files(rows).collect()) == ["p0.tif", "p3.tif", "p6.tif", "q.tif"]
    assert gate.run_summary(rows.limit(0)).first().passed


def test_submission(spark):
    names = lambda *n: spark.createDataFrame([(x,) for x in n], "file_name string")
    rows = spark.createDataFrame([(f"scan-{i % 4}.webp", str(i)) for i in range(5)], "file_name string, ground_truth string")
    wanted = [f"scan-{i}.webp" for i in range(4)]
    risks = lambda df, expected: gate.check_submission(df, names(*expected)).first().risks
    assert risks(rows.limit(4), wanted) == []
    assert risks(rows, wanted) == ["csv_row_count", "csv_duplicate_file_name"]
    assert risks(rows.limit(4), [*wanted[:3], "scan-9.webp"]) == ["csv_file_name_mismatch"]
    assert risks(rows.limit(3), wanted) == ["csv_row_count", "csv_file_name_mismatch"]
    assert risks(rows.limit(4).toDF("file", "ground_truth"), wanted)[0] == "csv_columns"
    assert gate.check_inputs(names(*wanted)).first().passed
    assert gate.check_inputs(names(*wanted, "scan-2.webp")).first().risks == ["duplicate_input_file_name"]


def test_retry_plan(spark):
    cases = [(["high_duplication"], 0), (["api_failure_ratio_high"], 1), (["html_broken", "too_short"], 0), (["service_busy_html", "full_html_page"], 1), (["too_short"], 2), ([], 0), (["service_busy_html"], 2)]
    rows = spark.createDataFrame([(i, risks, not risks, n) for i, (risks, n) in enumerate(cases)], "i int, risks array<string>, passed boolean, rerun_count int")
    p = [r for r in retry.plan(rows).orderBy("i").collect()]
    assert [r.rerun for r in p] == [True, True, True, True, False, False, False]
    assert [r.force_api for r in p[:4]] == [False, False, False, True] and [r.concurrency for r in p[:4]] == [0, 1, 0, 1]
    assert [float(r.overlap_scale) for r in p[:4]] == [1.0, 1.0, 1.5, 1.0]
    assert not any(r.rerun for r in retry.plan(rows.where("rerun_count > 0"), 1).collect())


def test_cache(spark):
    chunks = spark.createDataFrame([("c1", "i1"), ("c2", "i2"), ("c3", "i3")], "chunk_id string, image_sha1 string")
    done = spark.createDataFrame([("c1", "i1", True, "x"), ("c2", "i2", False, "")], "chunk_id string, image_sha1 string, ok boolean, markdown string")
    stored = cache.entries(done, "u").unionByName(cache.entries(done, "u"))
    hit = cache.hits(chunks, stored, "u")
    assert [(r.chunk_id, r.markdown) for r in hit.collect()] == [("c1", "x")]
    assert sorted(r.chunk_id for r in cache.misses(chunks, hit).collect()) == ["c2", "c3"]
    assert cache.hits(chunks, stored.withColumn("validator_version", F.lit(0)), "u").count() == cache.hits(chunks, stored, "v").count() == 0


def test_accept():
    body = json.dumps({"result": {"result": json.dumps({"choices": [{"message": {"content": "```MD\n## 3 条\n```"}}, 7]})}, "success": 1})
    assert recognize.accept(200, body) == recognize.accept(399, "## 3 条") == "## 3 条"
    refused = {401: recognize.AuthenticationError, 403: recognize.AuthenticationError, 404: recognize.RecognitionError, 429: recognize.RecognitionError, 500: recognize.RecognitionError, 599: recognize.RecognitionError}
    for status, kind in refused.items():
        with pytest.raises(kind) as e:
            recognize.accept(status, body)
        assert type(e.value) is kind
    for text in (" \n", '{"success": false}', "J_Retry_Link", "<!doctype html><head></head><body>x", "```md\n```"):
        with pytest.raises(recognize.RecognitionError):
            recognize.accept(200, text)


def test_attempt():
    got = recognize.attempt(lambda user: (200, f"text for {user}"), "u", 2)
    assert got[:3] == (True, "text for u", "") and (got[3]["status"], got[3]["retry_index"], got[3]["response_chars"]) == ("ok", 2, 10)
    for answer in (lambda user: (502, "x"), lambda user: 1 / 0):
        got = recognize.attempt(answer, "u")
        assert got[:2] == (False, "") and got[2] and got[3]["status"] == "retryable_error"
    with pytest.raises(recognize.AuthenticationError):
        recognize.attempt(lambda user: (401, ""), "u")


@pytest.mark.parametrize(("users", "concurrency", "per_user"), [(["p", "q", "r"], 40, 1), (["p", "q"], 3, 2), (["p", "q", "r"], 2, 1)])
def test_no_user_has_more_requests_open_than_allowed(spark, tmp_path, users, concurrency, per_user):
    folder, waits = str(tmp_path), []

    def service(fields, user):
        import os
        import time
        import uuid

        mine = f"{folder}/{user}-{uuid.uuid4().hex}"
        open(mine, "w").close()
        names = os.listdir(folder)
        time.sleep(0.02)
        os.remove(mine)
        log = sum(n.startswith(user + "-") for n in names), len(names)
        # every third request fails twice, and then is another user's
        tried = f"{folder}.{fields['ordinal']}"
        open(tried, "a").write("x")
        return (500, "later") if fields["ordinal"] % 3 == 0 and os.path.getsize(tried) < 3 else (200, f"{log[0]} {log[1]} {user}")

    chunks = spark.createDataFrame([(i, f"k{i}") for i in range(30)], "ordinal long, chunk_id string")
    rows = recognize.recognize(chunks, service, users, concurrency, per_user, 3, waits.append).orderBy("ordinal").collect()
    seen = [r.markdown.split() for r in rows]
    assert max(int(s[0]) for s in seen) <= per_user and max(int(s[1]) for s in seen) <= min(concurrency, len(users) * per_user)
    assert [s[2] for s in seen] == [users[(i + (2 if i % 3 == 0 else 0)) % len(users)] for i in range(30)]
    assert [[x.retry_index for x in r.log] for r in rows] == [[0, 1, 2] if i % 3 == 0 else [0] for i in range(30)]
    assert waits == [1.0, 2.0] and all([x.status for x in r.log][-1] == "ok" for r in rows)


def test_recognize_keeps_order_and_failures(spark):
    users = ["p", "q", "r"]
    chunks = spark.createDataFrame([(i, f"k{i}") for i in range(11)], "ordinal long, chunk_id string")

    def service(fields, user):
        n = int(fields["chunk_id"][1:])
        return (503, "later") if n % 4 == 2 else (200, f"<TABLE>{n}{user}" if n % 4 == 3 else f"{n}{user}")

    rows = recognize.recognize(chunks, service, users, 40, 2, 0, sleep=lambda s: None).orderBy("ordinal").collect()
    for i, r in enumerate(rows):
        kind = "unknown" if i % 4 == 2 else "table" if i % 4 == 3 else "body"
        assert (r.block_type, r.ok) == (kind, i % 4 != 2)
        assert r.markdown == ("" if i % 4 == 2 else f"{'<TABLE>' if i % 4 == 3 else ''}{i}{users[i % 3]}")
    assert [recognize.effective_concurrency(n, 3, 2) for n in (1, 6, 40)] == [1, 6, 6]


@pytest.mark.parametrize("seed", range(30))
def test_edit_distance(seed):
    rng = random.Random(seed)
    a, b = ("".join(rng.choice("ab中") for _ in range(rng.randint(0, 90))) for _ in range(2))
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, last[j] + 1, last[j - 1] + (x != y)))
    assert evaluate.edit_distance(a, b) == row[-1]


@pytest.mark.parametrize("seed", range(40))
def test_banded_edit_distance(seed, monkeypatch):
    rng = random.Random(seed)
    letters = rng.choice(["ab", "abcd", "abcdefghij中"])
    a = [rng.choice(letters) for _ in range(rng.randint(1, 80))]
    b = [c for x in a for c in rng.choice([[x]] * 12 + [[], [x, "z"], ["y"]])] or ["a"]
    a, b = sorted(("".join(a), "".join(b)), key=len)
    want = evaluate._whole(a, b)
    for bound in range(len(b) - len(a), len(b) + 5, 3):
        got = evaluate._within(a, b, bound)
        assert got == want if want <= bound else got > bound
    monkeypatch.setattr(evaluate, "FIRST_BOUND", 1)
    assert evaluate.edit_distance(a, b) == evaluate.edit_distance(b, a) == (0 if a == b else want)


def test_near_texts_cost_their_distance():
    import time

    rng = random.Random(6)
    a = [rng.choice("abcdefghijklmnop ") for _ in range(150_000)]
    b = list(a)
    for i in range(0, len(b), 500):
        b[i] = rng.choice(["", "#", b[i] + "x"])
    began = time.perf_counter()
    assert 200 < evaluate.edit_distance("".join(a), "".join(b)) <= 300
    assert time.perf_counter() - began < 5  # whole columns take some 20 s


def test_evaluate(spark, tmp_path):
    (tmp_path / "map.csv").write_text("﻿uuid,afts_id\nk-77,scan 5\n , x\nk-78,\n", encoding="utf-8")
    pred = spark.createDataFrame([("scan 5.md", "kitten"), ("k-78.md", ""), ("lost.md", "x"), ("long.md", "ab" * 400)], "file_name string, markdown string")
    truth = spark.createDataFrame([("k-77.md", "sitting"), ("k-78.md", "中文"), ("long.md", "ba" * 400)], "file_name string, markdown string")
    records, missing = evaluate.evaluate(pred, truth, readers.read_mapping(spark, str(tmp_path / "map.csv")))
    got = {r.file_name: r for r in records.collect()}
    assert {k: (r.gt_file, r.edit_distance) for k, r in got.items()} == {"scan 5.md": ("k-77.md", 3), "k-78.md": ("k-78.md", 2), "long.md": ("long.md", 2)}
    assert got["scan 5.md"].normalized_edit_distance == pytest.approx(3 / 7) and got["k-78.md"].normalized_edit_distance == 1.0
    assert [r.file_name for r in missing.collect()] == ["lost.md"] and evaluate.summary(records.limit(0)).first().mean_normalized_edit_distance == 0.0


def test_csv_round_trip(spark, tmp_path):
    rows = [("NA", 'a "b",\n c \n'), ("x.png", ""), ("y.png", "\n\n行\n")]
    files = spark.createDataFrame(rows, "file_name string, ground_truth string")
    out = f"file://{tmp_path}/out.csv"
    sinks.publish(files, out, files.select("file_name"))
    assert sorted((r.file_name, r.ground_truth or "") for r in readers.read_submission(spark, out).collect()) == sorted(rows)
    with pytest.raises(sinks.PublishError, match="csv_row_count"):
        sinks.publish(files.limit(1), out, files.select("file_name"))
    # what failed its check never was where readers look, and what stood there still does
    assert readers.read_submission(spark, out).count() == 3 and [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["out.csv"]
    with pytest.raises(sinks.PublishError):
        sinks.publish(files, f"file://{tmp_path}/sub/new.csv", files.select("file_name").limit(2))
    assert not (tmp_path / "sub" / "new.csv").exists()
    for single in (False, False, True):  # a folder over a file, over a folder, and a file over that
        assert sinks.publish(files, out, files.select("file_name"), single).first().row_count == 3
        assert (tmp_path / "out.csv").is_file() == single and readers.read_submission(spark, out).count() == 3
    with pytest.raises(ValueError, match="credentials"):
        sinks.append_json(files.withColumn("api_key", F.lit("k")), out)


def test_document_of_long_lists(spark, tmp_path):
    names = [f'p {i} "q"\\.png' for i in range(300)]
    rows = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, i int").repartition(5)
    told = F.to_json(F.struct("name", "i"))
    sinks.write_document({"n": 300, "of": "é"}, {"none": (rows.limit(0), "name", told), "rows": (rows, "i", told)}, f"file://{tmp_path}/d.json")
    got = json.loads((tmp_path / "d.json").read_text())
    assert (got["n"], got["of"], got["none"]) == (300, "é", []) and sorted((r["i"], r["name"]) for r in got["rows"]) == list(enumerate(names))


def test_config(tmp_path):
    (tmp_path / "c.yaml").write_text("api: {url: '${X}', concurrency: 4, per_user_concurrency: 1}\nquality: {max_reruns_per_file: 1}\n")
    args = ([str(tmp_path)], "o.csv", "w", str(tmp_path / "c.yaml"))
    with pytest.raises(readers.ConfigError):
        readers.load_config(*args, env={})
    c = readers.load_config(*args, env={"apiKey": "k", "userIds": "a, b,"}, default_url="http://d")
    assert (c.api_key, c.user_ids, c.api_url, c.api["concurrency"], c.snapshot()["api_key"]) == ("k", ["a", "b"], "http://d", 2, "***")
    assert readers.load_config(*args, env={"OCR_API_URL": "http://e"}, dry_run=True).api_url == "http://e"
    with pytest.raises(readers.ConfigError):
        readers.load_config(["/nowhere"], *args[1:], env={}, dry_run=True)


def test_env_file(tmp_path, monkeypatch):
    (tmp_path / "c.yaml").write_text("{}")
    (tmp_path / ".env").write_text("# keys\nexport OCR_API_KEY='k 1'\nOCR_USER_IDS=u, v\nbroken line\n")
    monkeypatch.chdir(tmp_path)
    for name in ("OCR_API_KEY", "OCR_USER_IDS"):
        monkeypatch.delenv(name, raising=False)
    c = readers.load_config([str(tmp_path)], "o", "w", "c.yaml")
    assert (c.api_key, c.user_ids) == ("k 1", ["u", "v"])
    monkeypatch.setenv("OCR_API_KEY", "other")
    assert readers.load_config([str(tmp_path)], "o", "w", "c.yaml").api_key == "other" and readers.read_env("nowhere") == {}


def test_dataset_report(spark, tmp_path):
    import numpy as np
    from test_geometry import png

    from quireflow.plans import dataset

    (tmp_path / "in").mkdir()
    for i in range(3):
        png(tmp_path / "in" / f"{i}.png", np.zeros((30 + i, 20 if i else 2), np.uint8))
    dataset.report(spark, [str(tmp_path / "in")], str(tmp_path / "out"))
    lines = [x for p in (tmp_path / "out" / "report").glob("part-*") for x in p.read_text().splitlines()]
    assert lines[0] == "## Pages by folder and type" and sum(x.startswith("## ") for x in lines) == 2
    assert any(x.startswith("| in | long_strip | 1 |") for x in lines) and any(x.startswith("| in | normal_page | 2 |") for x in lines)


def test_whole_run(spark, tmp_path):
    import numpy as np
    from test_geometry import png

    (tmp_path / "in").mkdir()
    for i, name in enumerate(("a.png", "b.png")):
        png(tmp_path / "in" / name, np.full((40 + i, 30), 255, np.uint8))
    out, work = f"file://{tmp_path}/out.csv", f"file://{tmp_path}/work"
    calls = str(tmp_path / "calls")

    def service(fields, user):
        assert fields["crop"][:4] == b"\x89PNG"
        with open(calls, "a") as f:
            f.write(fields["file_name"] + "\n")
        return 200, f"# {fields['file_name']}"

    config = readers.RunConfig([str(tmp_path / "in")], out, work, user_ids=["u"], api_url="x")
    files = Run(spark, config, service).run()
    assert sorted((r.file_name, r.markdown, r.rerun_count) for r in files.collect()) == [("a.png", "# a.png\n", 0), ("b.png", "# b.png\n", 0)]
    assert readers.read_submission(spark, out).count() == 2 and len(open(calls).readlines()) == 2
    assert (tmp_path / "out.csv").is_file()
    held = lambda name: [json.loads(x) for p in sorted((tmp_path / "work" / name).glob("part-*")) for x in p.read_text().splitlines()]
    assert {x["file_name"] for x in held("profiles")} == {x["file_name"] for x in held("manifests")} == {"a.png", "b.png"} and held("config")[0]["api_key"] == "***"
    (summary,) = held("summary")
    assert (summary["passed"], summary["file_count"], summary["failed_count"], summary["risk_counts"]) == (True, 2, 0, {}) and held("failed_files") == []
    document = json.loads((tmp_path / "work" / "summary.json").read_text())
    assert (document["passed"], document["failed_files"], document["risk_counts"], document["output_csv"]) == (True, [], {}, out)
    assert [(f["file_name"], f["quality"]["passed"], f["quality"]["metrics"]["chars"]) for f in document["files"]] == [("a.png", True, 7), ("b.png", True, 7)]
    again = Run(spark, config, service).run()
    assert {r.from_merged_cache for r in again.collect()} == {1} and len(open(calls).readlines()) == 2
    bad = readers.RunConfig([str(tmp_path / "in")], out, f"{work}2", user_ids=["u"], api_url="x", api={"max_retries": 0})
    with pytest.raises(RunError):
        Run(spark, bad, lambda fields, user: (500, ""), sleep=lambda s: None).run()
    assert not sinks.exists(spark, out)
    lost = [json.loads(x) for p in (tmp_path / "work2" / "failed_files").glob("part-*") for x in p.read_text().splitlines()]
    document = json.loads((tmp_path / "work2" / "summary.json").read_text())
    assert document["failed_files"] == ["a.png", "b.png"] and document["risk_counts"]["empty_output"] == 2 and not document["passed"]
    assert {x["file_name"] for x in lost} == {"a.png", "b.png"} and all("empty_output" in x["risks"] for x in lost)
    dry = Run(spark, readers.RunConfig([str(tmp_path / "in")], out, f"{work}3", dry_run=True)).run()
    assert dry.count() == 2 and not sinks.exists(spark, f"{work}3/merged")


def test_texts_to_files_without_table(spark):
    rows = spark.createDataFrame([("f", "normal_page", 0, 0, 0, 0, 9, 9, 0, "c", {}, True, "##x", "body")], "file_name string, doc_type string, row int, col int, x0 int, y0 int, x1 int, y1 int, ordinal long, chunk_id string, overlap map<string,int>, ok boolean, markdown string, block_type string")
    assert texts_to_files(rows).first().markdown == "## x\n"


def test_stream(spark, tmp_path):
    spark.createDataFrame([("a", "", "normal_page", 1, 0)], FILES).write.parquet(str(tmp_path / "in"))
    gate_stream(spark, str(tmp_path / "in"), FILES, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).first().risks == ["empty_output"]


def test_shipped_settings_are_the_defaults():
    from pathlib import Path

    from quireflow import cli
    from quireflow.operators import chunking, gate, merge, recognize, retry

    args = cli.parser().parse_args(["restore", "--input_dir", ".", "--output_csv", "o"])
    root = Path(cli.__file__).resolve().parents[1]
    c = readers.load_config(["."], "o", "w", str(root / args.config), env={}, dry_run=True)
    assert (c.api["max_retries"], c.quality["max_reruns_per_file"]) == (recognize.MAX_RETRIES, retry.MAX_RERUNS)
    assert list(c.chunk.values()) == [chunking.WINDOW, chunking.OVERLAP, chunking.CHUNK_PIXELS, chunking.PAGE_PIXELS, chunking.GRID_X, chunking.GRID_Y]
    assert list(c.merge.values()) == [merge.WINDOW_BODY, merge.WINDOW_TABLE, merge.LIKENESS]
    assert (c.quality["max_duplication_ratio"], c.quality["max_api_failure_ratio"]) == (gate.MAX_DUPLICATION, gate.MAX_FAILURE)
