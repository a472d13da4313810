"""Token store, packing, WARC, mixing and the pipeline."""

import base64
import gzip
import hashlib
import zlib

import duckdb
import numpy as np
import pytest
from helpers import EDGE, LONG, edge, empty, words
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quireflow.llm import mixing, packing, queries, sql, token_store, tokens, warc
from quireflow.llm.common import table

SF = "/root/testdata/sf0.001"
AWKWARD = ["", " ", "a", " a  b ", "x\n\ny", "don't we're", "<|endoftext|> hi", "hello <|endoftext|> hi", "a <|startoftext|>b", "A<|ENDOFTEXT|>", "x <|endoftext|>", "É́a b", "x  　y", "日本 語。 ok", "a\t b", "tail ", "Σας ΣΑΣ İ i", "1234 5a6", "\n", "a \n b", "...", " .", "ab,,, c!?", "\xa0 a", "a\xa0 b", "\x1f x", "a\t", "a\t b", "b\n", "b\n c", "\nab\ncd.\nEf, g", "a\n\n\nb", "q.\n...\n!x", "a\r\nb", "a\t\nb", "a\tb", "x_y", "don't's", words(500, 9)]


@pytest.mark.parametrize(("name", "lower"), [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_piecewise_ids_equal_whole_texts(spark, name, lower):
    texts = [r.text or "" for r in table(spark, SF, "documents").collect()] + AWKWARD
    path = tokens.vocabulary(name)
    coder = tokens.Encoder(path, lower)
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    for some in (slice(None), slice(len(texts) - len(AWKWARD), None), slice(0, 3)):
        ids, counts = coder.encode(texts[some])
        assert [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])] == want[some]
    tokens_most, tokens.MOST_PIECES = tokens.MOST_PIECES, 10
    for _ in range(3):  # pieces are forgotten and learnt again
        ids, counts = coder.encode(texts)
        assert [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])] == want
    tokens.MOST_PIECES = tokens_most
    assert coder.encode([None])[1].tolist() == [0] and coder.encode([])[1].tolist() == []


def test_added_tokens_get_their_ids():
    ids, _ = tokens.Encoder(tokens.vocabulary("byte_bpe_50k.json"), False).encode(["hello <|endoftext|> hi"])
    assert ids.tolist() == [31373, 220, 50256, 23105]
    ids, _ = tokens.Encoder(tokens.vocabulary("word_bpe_49k.json"), True).encode(["a <|startoftext|>"])
    assert ids.tolist() == [320, 49406]


def plain_ids(path, text, end):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids + [end]


def test_token_store_round_trip(spark):
    path = tokens.vocabulary("byte_bpe_50k.json")
    got = token_store.read(token_store.write(edge(spark, True).repartition(4), path, ranges=3, shard_tokens=500), with_ids=True).orderBy("start").collect()
    rows = sorted(EDGE, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    at = 0
    for r, (i, text, *_) in zip(got, rows, strict=True):
        ids = plain_ids(path, text, 0)
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32, r.ids) == (i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids)
        at += len(ids)
    assert token_store.read(token_store.write(empty(spark), path)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_grammar(seed):
    rng = np.random.default_rng(seed)
    counts = rng.integers(1, 90, 60)
    ids = rng.integers(0, (4, 50, 3000, 2)[seed], counts.sum()).astype(np.int32)
    ids[:200] = 1
    block = token_store.Shard.load(token_store.Shard.of([None, *range(59)], ids, counts, 50_000).dump())
    assert (np.concatenate([x for _, x in block.documents(most=16)]) == ids).all() and block.keys[:2] == [None, 0]
    start = np.cumsum(counts) - counts
    for doc in range(0, 60, 7):
        for lo, hi in ((0, 3), (2, 40), (5, 10**6), (4, 4)):
            assert block.span(doc, lo, hi).tolist() == ids[start[doc] : start[doc] + counts[doc]][lo:hi].tolist()
    if seed == 3:
        assert len(block.symbols) < len(ids) / 2
    # no pair of neighbours inside a document is left that stands often enough, and rules are distinct pairs
    left, bounds = {}, np.concatenate(([0], block.symbol_ends))
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        doc, at = block.symbols[lo:hi].tolist(), 0
        while at < len(doc) - 1:
            pair = (doc[at], doc[at + 1])
            left[pair] = left.get(pair, 0) + 1
            at += 2 if len(doc) > at + 2 and pair[0] == pair[1] == doc[at + 2] else 1
    assert max(left.values(), default=0) < token_store.LEAST and len({tuple(r) for r in block.rules.tolist()}) == len(block.rules)


def test_grammar_runs_to_the_end_on_copies():
    passage = np.random.default_rng(1).integers(0, 30_000, 5000)
    ids = np.concatenate([passage] * 13 + [np.random.default_rng(2).integers(0, 30_000, 20_000)])
    block = token_store.Shard.of([0], ids, np.array([len(ids)]), 50_000)
    assert len(block.symbols) < 20_100 and block.lengths.max() > 1000
    assert block.span(0, 4990, 5010).tolist() == ids[4990:5010].tolist()


def test_packing(spark):
    path = tokens.vocabulary("word_bpe_49k.json")
    rows = packing.pack(edge(spark, True), path, with_ids=True).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    for i, text, *_ in EDGE:
        ids = plain_ids(path, text, 1)
        pieces = sorted(by[i], key=lambda r: (r.sequence_id, r.offset)) if i == 4 else sorted(by[i], key=lambda r: r.piece)
        if i != 4:
            assert [x for p in pieces for x in p.ids] == ids and [p.start for p in pieces] == list(range(0, len(ids), 4096))
        assert all(p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes()) and p.length == len(p.ids) <= 4096 for p in pieces)
    assert len(by[4]) == 2
    full = {}
    for r in rows:
        full.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in full.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= 4096
    assert packing.pack(empty(spark), path).count() == 0


def test_best_fit():
    fit = packing.BestFit(10, 2)
    assert [fit.place(n) for n in (6, 7, 4, 3, 5, 10)] == [(0, 0), (1, 0), (0, 6), (1, 7), (2, 0), (3, 0)]
    fit = packing.BestFit(10, 2)
    # a third bin closes the fullest, so a piece of 3 doesn't reach it any more
    assert [fit.place(n)[0] for n in (7, 6, 5, 3, 4)] == [0, 1, 2, 1, 2]
    rng = np.random.default_rng(0)
    fit, sizes = packing.BestFit(), rng.integers(1, 3000, 5000)
    for n in sizes:
        fit.place(int(n))
    assert fit.n_bins < 1.02 * sizes.sum() / 4096 + 5
    with pytest.raises(ValueError, match="doesn't fit"):
        fit.place(0)


def test_warc(spark):
    html = [(1, "u", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "u\nv", None), (4, "u", ""), (5, "u", LONG), (5, "u", LONG), (None, "u", "<p>x</p>"), (7, "é", "\r\n\r\nWARC/1.1"), (9, "u", LONG)]
    pages = spark.createDataFrame(html, "page_id bigint, url string, html string").selectExpr("*", "1 as refers_to", "2 as payload", "3 as same")
    got = warc.read(warc.write(pages), with_payload=True).collect()
    assert len(got) == len(html)
    last = {}
    for i, _, h in html:
        last[h or ""] = max(last.get(h or "", -1), -1 if i is None else i)
    for r in got:
        payload = next(h or "" for i, _, h in html if i == r.page_id).encode()
        assert (r.payload_bytes, r.payload_digest) == (len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode())
        first = last[payload.decode()]
        assert (r.record_type, r.refers_to, r.payload) == (("response", None, payload) if r.page_id == first else ("revisit", first, None))
    assert warc.read(warc.write(pages.limit(0))).count() == 0
    assert {r.record_type for r in warc.read(warc.write(pages, min_bytes=1 << 30)).collect()} == {"response"}


def test_warc_damage():
    good = warc.record(1, "u", b"payload") + warc.record(2, "u", b"payload", refers_to=1)
    assert [(r[0], r[4], r[5]) for r in warc.parse(good)] == [(1, "response", None), (2, "revisit", 1)]
    assert list(warc.records(good, step=3)) == list(warc.records(good))
    for bad in (good[:-3], good[:40] + bytes([good[40] ^ 255]) + good[41:]):
        with pytest.raises(warc.BadRecord):
            list(warc.parse(bad))
    member = zlib.decompress(good, wbits=31)
    for broken in (member.replace(b"payload", b"paylord"), member[:-1], member.replace(b"Content-Length: ", b"Content-Length: 1", 1), b"HTTP/1.1\r\n\r\n"):
        with pytest.raises(warc.BadRecord):
            list(warc.parse(zlib.compress(broken, wbits=31)))


def foreign(kind, block, *more, length=None):
    head = b"WARC/1.0\r\nWARC-Type: %s\r\nWARC-Record-ID: <urn:uuid:b92e8444-34cf-472f-a86e-07b7845ecc05>\r\n" % kind + b"".join(m + b"\r\n" for m in more)
    return gzip.compress(head + b"Content-Length: %d\r\n\r\n" % (len(block) if length is None else length) + block + b"\r\n\r\n")


def test_warc_files_of_others(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n<p>hi</p>"
    kind = b"Content-Type: application/http; msgtype=response"
    files = {
        "a": foreign(b"warcinfo", b"software: x\r\n", b"Content-Type: application/warc-fields") + foreign(b"request", b"GET / HTTP/1.1\r\n\r\n", b"Content-Type: application/http; msgtype=request")
        + foreign(b"response", http, kind, b"WARC-Target-URI: http://x/", b"WARC-Payload-Digest: sha1:" + hashlib.sha1(b"<p>hi</p>").hexdigest().encode(), b"WARC-Block-Digest: md5:xyz"),
        "b": foreign(b"revisit", b"", b"WARC-Refers-To: <urn:uuid:1>", b"WARC-Payload-Digest: sha1:ABC", b"X-Folded: a\r\n b") + warc.record(7, "u", b"own"),
        "c": foreign(b"response", b"HTTP/1.1 200 OK\r\n\r\n" + bytes(3 << 20), kind),
    }
    for name, data in files.items():
        (tmp_path / f"{name}.warc.gz").write_bytes(data)
    (tmp_path / "other.txt").write_text("not an archive")
    got = sorted((r.record_type, r.page_id or 0, r.url, r.payload_bytes or 0, r.payload_digest, r.refers_to) for r in warc.read_files(spark, str(tmp_path), with_payload=True).collect())
    sha = warc.digest
    assert got == sorted([
        ("warcinfo", 0, "", 13, sha(b"software: x\r\n"), None), ("request", 0, "", 0, sha(b""), None), ("response", 0, "http://x/", 9, sha(b"<p>hi</p>"), None), ("revisit", 0, "", 0, "ABC", None),
        ("response", 7, "u", 3, sha(b"own"), None), ("response", 0, "", 3 << 20, sha(bytes(3 << 20)), None),
    ])
    for bad in (foreign(b"response", http, kind, length=3), foreign(b"response", http, kind, b"WARC-Payload-Digest: sha1:" + b"A" * 32), foreign(b"resource", b"x", b"WARC-Block-Digest: sha1:" + b"0" * 40)):
        with pytest.raises(warc.BadRecord):
            list(warc.parse(bad))


def plain_targets(sizes):
    weights = [(5.0, 2.0, 1.0)[i % 3] for i in range(len(sizes))]
    left, open_, out = 1.5 * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        share = {i: left * weights[i] / sum(weights[j] for j in open_) for i in open_}
        over = [i for i in open_ if share[i] >= 2 * sizes[i]]
        if not over:
            for i in open_:
                out[i] = share[i]
            break
        for i in over:
            out[i] = 2.0 * sizes[i]
            left -= out[i]
            open_.remove(i)
    return out


def test_targets(spark):
    for sizes in ([10, 20, 30, 40], [1000, 1, 1], [0, 5], [7], [1, 1, 1, 1000, 2, 3, 900], [0, 0]):
        rows = spark.createDataFrame([(f"={i:02}", n) for i, n in enumerate(sizes)], "skey string, source_size bigint")
        got = [r.target for r in mixing.targets(rows).orderBy("skey").collect()]
        assert got == pytest.approx(plain_targets(sizes))


def test_mix_edges(spark):
    labels = spark.createDataFrame([(5, 1), (7, 0), (7, 1), (None, 1)], "doc_id bigint, quality int")
    docs = edge(spark, True).drop("size").select("*", mixing.size_of().alias("size"))
    for buckets in (1, 4096):
        rows = mixing.mix(mixing.quality_weights(docs, labels), buckets=buckets).drop("text").collect()
        assert len(rows) == len(EDGE) and all(0 <= r.taken <= 2 * r.size for r in rows)
        for s in {r.source for r in rows}:
            own = [r for r in rows if r.source == s]
            assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own) / 2 + 1e-6
    clash = docs.withColumns({c: F.lit(c) for c in ("bucket", "skey", "before", "ahead", "epochs", "rest", "target", "source_size", "order", "id", "weight", "row")})
    rows = mixing.mix(mixing.quality_weights(clash, labels))
    assert set(rows.columns) == {*clash.columns, "quality_weight", *mixing.RESULTS}
    assert {(r.bucket, r.skey, r.before, r.ahead, r.epochs, r.rest, r.order, r.id, r.weight, r.row) for r in rows.collect()} == {("bucket", "skey", "before", "ahead", "epochs", "rest", "order", "id", "weight", "row")}
    assert all(isinstance(r.target, float) for r in rows.collect())
    none = mixing.quality_weights(empty(spark).select("*", mixing.size_of().alias("size")), labels)
    assert mixing.mix(none).count() == 0


@pytest.mark.parametrize("name", sorted(sql.ORACLES))
def test_queries_agree_with_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = queries.queries()[name](spark, SF), con.sql(sql.ORACLES[name])
    assert got.columns == want.columns and sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want.fetchall()))


def test_queries_run(spark):
    for name, query in queries.queries().items():
        assert query(spark, SF).count() > 0, name
