"""The seam fold by its properties, and table repair."""

import random
import re

import pandas as pd
import pytest

from quireflow.operators import merge, tables

SPACE = re.compile(r"\s+")


def cut(seed, marks=True):
    """A text of distinct words, and overlapping pieces of it."""
    rng = random.Random(seed)
    ends = ["", "", ",", ".", "，", "、"] if marks else [""]
    text = " ".join(f"w{seed}x{i}{rng.choice(ends)}" for i in range(rng.randint(60, 400)))
    pieces, at = [], 0
    while at < len(text):
        size = rng.randint(200, 500)
        pieces.append((at, text[at : at + size]))
        if at + size >= len(text):
            break
        at += size - rng.randint(30, 120)
    return text, pieces


def folded(texts, trims=None):
    return merge.fold(texts, ["body"] * len(texts), [True] * len(texts) if trims is None else trims, [str(i) for i in range(len(texts))])


@pytest.mark.parametrize("seed", range(25))
def test_overlapping_pieces_give_their_text_back(seed):
    text, pieces = cut(seed)
    got, removed = folded([p for _, p in pieces])
    assert SPACE.sub("", got) == SPACE.sub("", text)
    assert len(removed) == len(pieces) - 1
    # what was cut from a piece is what the piece before it ended with
    for (at, piece), (before, last), r in zip(pieces[1:], pieces, removed, strict=False):
        overlap = before + len(last) - at
        assert abs(r[2] - overlap) <= 3 and last.rstrip().endswith(piece.strip()[: r[2]].rstrip())


@pytest.mark.parametrize("seed", range(10))
def test_nothing_is_lost_where_nothing_may_be_cut(seed):
    _, pieces = cut(seed)
    texts = [p for _, p in pieces]
    got, removed = folded(texts, [False] * len(texts))
    assert not removed and SPACE.sub("", got) == SPACE.sub("", "".join(texts))


@pytest.mark.parametrize("seed", range(10))
def test_a_folded_text_stays_as_it_is(seed):
    got, _ = folded([p for _, p in cut(seed)[1]])
    assert folded([got]) == (got, []) and got.endswith("\n") and not got.endswith("\n\n")


def test_a_damaged_overlap_is_cut_by_likeness():
    text, _ = cut(3, marks=False)
    first, second = text[:400], text[300:700]
    got, removed = folded([first, second[:50] + "~" + second[51:]])
    assert len(removed) == 1 and abs(removed[0][2] - 100) <= 25 and abs(len(got.split()) - len(text[:700].split())) <= 4


def test_short_or_foreign_heads_are_kept():
    assert folded(["one two three", "three four"]) == ("one two three\n\nthree four\n", [])
    assert folded(["an open (bracket", "closes) here"])[0] == "an open (bracketcloses) here\n"
    assert folded(["", "  ", "x"])[0] == "x\n" and folded([""])[0] == ""


@pytest.mark.parametrize(("a", "b"), [("", ""), ("abab", "abab"), ("xaaa", "aaay"), ("a" * 30, "a" * 50), ("xyz", "abc")])
def test_exact_overlap(a, b):
    assert merge.exact_overlap(a, b) == next((k for k in range(min(len(a), len(b)), 0, -1) if a.endswith(b[:k])), 0)


def test_merge_over_frames(spark):
    again = "the shared band of both windows " * 3
    rows = [
        ("f", 1, "a", "above\n" + again, "body", 0, 0, 50, 200, {"bottom": 40}), ("f", 2, "b", again + "\nbelow", "body", 0, 160, 50, 360, {"top": 40}),
        ("g", 1, "c", "# Contents\n# 1 A heading of some length", "toc", 0, 0, 50, 200, {"bottom": 40}), ("g", 2, "d", "# 1 A heading of some length\ntext", "body", 0, 160, 50, 360, {"top": 40}),
        ("h", 1, "e", "covered (as far as", "body", 0, 0, 9, 9, {}), ("h", 2, "f", "named) and more.", "body", 0, 9, 9, 18, {}), ("i", 1, "g", None, "unknown", 0, 0, 1, 1, None),
    ]
    chunks = spark.createDataFrame(rows, "file_name string, rank int, chunk_id string, markdown string, block_type string, x0 int, y0 int, x1 int, y1 int, overlap map<string,int>")
    got = {r.file_name: r for r in merge.merge(merge.may_overlap(chunks)).collect()}
    assert got["f"].markdown.count(again.strip()) == 1 and got["f"].removed[0].chunk_id == "b" and "below" in got["f"].markdown
    assert got["g"].markdown.count("# 1 A heading of some length") == 2 and not got["g"].removed
    assert got["h"].markdown == "covered (as far asnamed) and more.\n" and got["i"].markdown == ""


def test_table_repair(spark):
    pair = "<table><tr><th>item</th><th>price</th></tr><tr><td>tea</td><td>3</td></tr></table>\n<table><tr><th>item</th><th>price</th></tr><tr><td>jam</td><td>4</td></tr></table>"
    given = ["<table><tr><td>p</td><td>q", "<table><tr><td>p</td><td></td><td>r</td></tr></table>", pair, "no table & nothing else", None]
    files = spark.createDataFrame(pd.DataFrame({"i": range(5), "markdown": given}), "i int, markdown string")
    got = {r.i: r for r in tables.repair(files).collect()}
    assert got[0].markdown == "<table><tr><td>p</td><td>q</td></tr></table>" and got[0].repaired_tags == 3
    assert "<td></td>" in got[1].markdown and got[1].repaired_tags == 0
    assert got[2].markdown.count("item") == 1 and "jam" in got[2].markdown and got[2].markdown.count("<table>") == 1
    assert got[3].markdown == given[3] and got[4].markdown is None


def test_repair_chain_and_escapes():
    t = "<table><tr><td>h</td></tr><tr><td>{}</td></tr></table>"
    got = tables.repair_text(t.format(1) + t.format(2) + " " + t.format(3) + "a & b<br>")
    assert got == "<table><tr><td>h</td></tr><tr><td>1</td></tr><tr><td>2</td></tr><tr><td>3</td></tr></table> a &amp; b<br/>"


MARKS = ["<table>", "</table>", "<tr>", "</tr>", "<td>", "</td>", "<th>", "</th>", "a", "b", " ", "\n"]
ODD = [*MARKS, "&", "&amp;", "&lt;x", "<", ">", "<br>", "<br/>", "<td/>", '<TD class="x y">', "<p>", "</p>", "<table border=1>", "<td a='1' b>", '<td a="&amp;">', "<!-- c -->", "<script>", "</script>", "<tbody>", "</tbody>", '<img src="q">', "&#65;", "&copy", "</x>", '<td a="1" a="2">', "< td>", "<b>", "</B>", "<td\n>"]


@pytest.mark.parametrize("seed", range(6))
def test_flat_repair_is_that_of_the_tree(seed):
    rng, plain, chained = random.Random(seed), 0, 0
    row = lambda cells: "<tr>" + "".join(f"<td>{x}</td>" for x in cells) + "</tr>"
    for _ in range(1500):
        if rng.random() < 0.5:
            text = "".join(rng.choice(rng.choice([MARKS, MARKS, ODD])) for _ in range(rng.randrange(20)))
        else:
            text = ""
            for _ in range(rng.randrange(1, 5)):
                rows = "".join(row(rng.choice([["h", "i"], ["1", "2"], ["a & b"]])) for _ in range(rng.randrange(4)))
                text += "<table>" + rng.choice(["", "<tbody>", "x"]) + rows + rng.choice(["", "</tbody>"]) + rng.choice(["</table>", "</TABLE>", ""]) + rng.choice(["", " ", "\n", "t", "&nbsp;"])
        flat = tables.Flat(text)
        plain += flat.plain
        got = tables.repair_text(text)
        assert got == tables.by_tree(text)
        chained += flat.plain and got.count("<table") < len(flat.ranges["table"])
    assert plain > 700 and chained > 20
