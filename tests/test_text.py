"""Text and HTML expressions against literals."""

import pytest
from pyspark.sql import functions as F

from quireflow.functions import html, text


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "s string").select(expression(F.col("s")).alias("r")).first().r


@pytest.mark.parametrize(
    ("given", "wanted"),
    [
        ("#Kapitel  \r\nText \t\n####Anhang B\n", "# Kapitel\nText\n#### Anhang B\n"),
        ("7.5 % von 12,345.00 EUR (Nr. X-0042)", "7.5 % von 12,345.00 EUR (Nr. X-0042)\n"),
        ("oben\nREQUEST FAILED (code 7)\nmitte\nserver error!\nunten", "oben\nmitte\nunten\n"),
        ("", ""), (None, ""), ("\n \n", ""), ("a\r\rb　\n\n", "a\n\nb\n"),
    ],
)
def test_normalize(spark, given, wanted):
    assert one(spark, given, text.normalize) == wanted


def test_heading_modes(spark):
    lines = "## A\n### A\n#######x\n##B"
    assert one(spark, lines, lambda s: text.normalize(s, "compat")) == "# # A\n## # A\n###### #x\n## B\n"
    assert one(spark, lines, lambda s: text.normalize(s, "fixed")) == "## A\n### A\n#######x\n## B\n"


def test_duplication_ratio(spark):
    assert one(spark, "ab\n ab \ncd\n\nab", text.duplication_ratio) == pytest.approx(4 / 8)
    assert one(spark, " \n", text.duplication_ratio) == 0.0


@pytest.mark.parametrize(("given", "toc"), [("# 目录\nVorwort", True), ("ein Satz\n目录", False), ("1 Anfang\n2 目录\n3.1 Ende\n", True), ("1 a\n2 b\n3 c\n目录", False), ("", False)])
def test_toc(spark, given, toc):
    assert one(spark, given, text.is_toc) is toc


@pytest.mark.parametrize(("given", "more"), [("siehe（Abschnitt", True), ("Ende。", False), ("a，", True), ("<td>x", True), ("", False), ("（a）b", False), ("x (", True)])
def test_goes_on(spark, given, more):
    assert one(spark, given, text.goes_on) is more


@pytest.mark.parametrize(("given", "inner"), [("```markdown\n# Kopf\n```", "# Kopf"), (" ```MD\nx```", "x"), ("a ```\nb\n```", "a ```\nb\n```")])
def test_unfence(spark, given, inner):
    assert one(spark, given, text.unfence) == inner


def test_html_predicates(spark):
    page = "<!DOCTYPE html><html><head></head><body>服务器繁忙</body></html>"
    assert one(spark, page, html.is_busy_page) and one(spark, page, html.is_full_page)
    assert one(spark, "<div>服务器繁忙</div>", html.is_busy_page) and not one(spark, "<div>服务器繁忙</div>", html.is_full_page)
    table = "<table><tr><td>Zelle</td></tr></table>"
    assert not one(spark, table, html.is_broken) and one(spark, "<table><tr><td>A", html.is_broken)
    assert one(spark, "<table><tr><td>A</td><td>B", html.missing_closings) == 3
    stats = html.table_stats(F.col("s"))
    row = spark.createDataFrame([("<table><tr><td>p</td><td>q</td><td></td></tr><tr><td> </td></tr></table>",)], "s string").select(*(v.alias(k) for k, v in stats.items())).first()
    assert (row.tr, row.td, row.empty_td) == (2, 4, 2)


def test_stem_and_lists(spark):
    assert [one(spark, s, text.stem) for s in ("a/b.tar.gz", "x", ".hidden", "c.png")] == ["b.tar", "x", ".hidden", "c"]
    assert one(spark, " a, ,b ", text.list_of) == ["a", "b"]
