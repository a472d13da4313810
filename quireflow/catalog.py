"""The registered queries over the document-restoration operators, with their DuckDB SQL.

Images, chunks and HTML that the tables lack are derived from them by plain arithmetic, the same way on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import html, text
from .operators import cache, chunking, evaluate, gate, layout, merge, ordering, profile, recognize, retry, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: White space as DuckDB SQL.
_WS = "(" + " || ".join(f"chr({ord(c)})" for c in text.WHITE) + ")"
_END = r"'\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{{85}}\x{{2028}}\x{{2029}}]'"
_LINES = f"list_filter(list_transform(regexp_split_to_array({{0}}, {_END}), lambda x: trim(x, {_WS})), lambda x: x <> '')"


def query(sql: str | None = None):
    def keep(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _lines(s: str) -> str:
    return _LINES.format(s)


def _ratio_sql(s: str) -> str:
    dup, total = f"(length(array_to_string({_lines(s)}, '')) - length(array_to_string(list_distinct({_lines(s)}), '')))", f"length(array_to_string({_lines(s)}, ''))"
    return f"(CASE WHEN {total} > 0 THEN {dup} / {total} ELSE 0 END)"


def _has(s: str, words) -> str:
    return "(" + " OR ".join(f"contains({s}, '{w}')" for w in words) + ")"


def _count(s: str, w: str) -> str:
    return f"((length({s}) - length(replace({s}, '{w}', ''))) // {len(w)})"


def _busy_sql(s: str) -> str:
    low = f"lower(trim({s}, {_WS}))"
    return f"({_has(low, html.BUSY_MARKS)} OR (contains({low}, '{html.BUSY_HOST}') AND contains({low}, '<html')))"


def _full_sql(s: str) -> str:
    low = f"lower(trim({s}, {_WS}))"
    return f"((starts_with({low}, '<!doctype html') OR starts_with({low}, '<html')) AND contains({low}, '<head') AND contains({low}, '<body'))"


def _broken_sql(s: str) -> str:
    return "(" + " OR ".join(f"{_count(f'lower({s})', f'<{t}')} > {_count(f'lower({s})', f'</{t}')}" for t in html.TABLE_TAGS) + ")"


# texts


@query(f"SELECT doc_id, CAST(length(trim(text, {_WS})) AS BIGINT) AS chars, round({_ratio_sql('text')}, 6) AS duplication_ratio, {_ratio_sql('text')} > 0.18 AS high_duplication FROM documents")
def duplication_gate(spark, sf):
    ratio = text.duplication_ratio(F.col("text"))
    return _t(spark, sf, "documents").select("doc_id", F.length(text.strip(F.col("text"))).cast("long").alias("chars"), F.round(ratio, 6).alias("duplication_ratio"), (ratio > gate.MAX_DUPLICATION).alias("high_duplication"))


_NORMAL = r"""
SELECT doc_id, CASE WHEN body = '' THEN '' ELSE body || chr(10) END AS markdown FROM (
  SELECT doc_id, regexp_replace(array_to_string(list_transform(list_filter(list_transform(
      string_split(replace(replace({text}, E'\r\n', E'\n'), E'\r', E'\n'), E'\n'), lambda x: rtrim(x, {ws})),
      lambda x: NOT regexp_matches(lower(x), 'empty response|api error|request failed|server error')),
      lambda x: regexp_replace(x, '{heading}', '\1 \2')), E'\n'), '\n+$', '') AS body FROM documents)
"""
_FIXED, _COMPAT = r"^(#{1,6})([^#\s].*)$", r"^(#{1,6})(\S.*)$"
_MARKED = "(CASE doc_id % 4 WHEN 0 THEN '##' WHEN 1 THEN '### ' WHEN 2 THEN '#' ELSE '' END || text || E'  \\r\\n#######x\\n\\n')"


@query(_NORMAL.format(text="text", ws=_WS, heading=_FIXED))
def normalize_documents(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", text.normalize(F.col("text")).alias("markdown"))


def _marked() -> Column:
    k = F.col("doc_id") % 4
    return F.concat(F.when(k == 0, "##").when(k == 1, "### ").when(k == 2, "#").otherwise(""), "text", F.lit("  \r\n#######x\n\n"))


@query(_NORMAL.format(text=_MARKED, ws=_WS, heading=_FIXED))
def heading_fixed(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", text.normalize(_marked(), "fixed").alias("markdown"))


@query(_NORMAL.format(text=_MARKED, ws=_WS, heading=_COMPAT))
def heading_compat(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", text.normalize(_marked(), "compat").alias("markdown"))


@query(r"""SELECT doc_id, CAST(len(string_split(t, chr(10))) AS BIGINT) AS n_lines, CAST(len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(lower(x), 'empty response|api error|request failed|server error'))) AS BIGINT) AS n_errors
FROM (SELECT doc_id, text || CASE WHEN doc_id % 3 = 0 THEN E'\nERROR: Empty Response from api\nkept' WHEN doc_id % 3 = 1 THEN E'\nserver errors' ELSE '' END AS t FROM documents)""")
def error_line_filter(spark, sf):
    k = F.col("doc_id") % 3
    t = F.concat("text", F.when(k == 0, "\nERROR: Empty Response from api\nkept").when(k == 1, "\nserver errors").otherwise(""))
    lines = F.split(t, "\n")
    return _t(spark, sf, "documents").select("doc_id", F.size(lines).cast("long").alias("n_lines"), F.size(F.filter(lines, text.is_error_line)).cast("long").alias("n_errors"))


_PAGE = "(CASE page_id % 4 WHEN 0 THEN html WHEN 1 THEN '  ' || upper(html) WHEN 2 THEN '服务器繁忙' || html ELSE replace(html, '</p>', '<td>') || '<table><tr>' END)"


@query(f"SELECT page_id, {_busy_sql(_PAGE)} AS busy, {_full_sql(_PAGE)} AS full_page, {_broken_sql(_PAGE)} AS broken FROM pages")
def html_page_gate(spark, sf):
    k = F.col("page_id") % 4
    page = F.when(k == 0, F.col("html")).when(k == 1, F.concat(F.lit("  "), F.upper("html"))).when(k == 2, F.concat(F.lit("服务器繁忙"), "html")).otherwise(F.concat(F.replace("html", F.lit("</p>"), F.lit("<td>")), F.lit("<table><tr>")))
    return _t(spark, sf, "pages").select("page_id", page.alias("page")).select("page_id", html.is_busy_page(F.col("page")).alias("busy"), html.is_full_page(F.col("page")).alias("full_page"), html.is_broken(F.col("page")).alias("broken"))


def _order_tables(spark, sf) -> DataFrame:
    cell = F.concat(F.lit("<tr><td>"), F.col("l_partkey").cast("string"), F.lit("</td><td> </td>"), F.when(F.col("l_linenumber") % 3 == 0, "<td class='q'>").otherwise("<td></td></tr>"))
    rows = _t(spark, sf, "lineitem").select("l_orderkey", F.struct("l_linenumber", cell.alias("cell")).alias("r"))
    return rows.groupBy("l_orderkey").agg(F.concat(F.lit("<TABLE>"), F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["cell"]), ""), F.when(F.col("l_orderkey") % 2 == 0, "</table>").otherwise("")).alias("markdown"))


_TABLES = """
  SELECT l_orderkey, '<TABLE>' || string_agg(cell, '' ORDER BY l_linenumber, cell) || CASE WHEN l_orderkey % 2 = 0 THEN '</table>' ELSE '' END AS t
  FROM (
    SELECT l_orderkey, l_linenumber, '<tr><td>' || l_partkey || '</td><td> </td>' || CASE WHEN l_linenumber % 3 = 0 THEN '<td class=''q''>' ELSE '<td></td></tr>' END AS cell
    FROM lineitem)
  GROUP BY l_orderkey"""


@query(rf"""SELECT l_orderkey, CAST(len(regexp_extract_all(t, '(?i)<tr\b')) AS INT) AS tr, CAST(len(regexp_extract_all(t, '(?i)<td\b')) AS INT) AS td, CAST(len(regexp_extract_all(t, '(?i)<td\b[^>]*>\s*</td>')) AS INT) AS empty_td,
CAST({' + '.join(rf"greatest(0, len(regexp_extract_all(lower(t), '<{x}\b')) - {_count('lower(t)', f'</{x}>')})" for x in html.TABLE_TAGS)} AS INT) AS missing, {_broken_sql('t')} AS broken FROM ({_TABLES})""")
def table_tag_balance(spark, sf):
    m = F.col("markdown")
    return _order_tables(spark, sf).select("l_orderkey", *(v.alias(k) for k, v in html.table_stats(m).items()), html.missing_closings(m).alias("missing"), html.is_broken(m).alias("broken"))


_TOC = """(CASE doc_id % 4
  WHEN 0 THEN '# 条款目录' || chr(10) || text
  WHEN 1 THEN '1 总则' || chr(10) || '2.1 保险 目录' || chr(10) || '3 责任' || chr(10) || text
  WHEN 2 THEN '1 a' || chr(10) || '2 b' || chr(10) || '3 c' || chr(10) || '目录'
  ELSE text END)"""


@query(f"""
  SELECT doc_id, CASE WHEN len(l) > 0 AND (contains(ltrim(l[1], '# '), '目录') OR (
           len(l) >= 3 AND len(list_filter(l[1:8], lambda x: regexp_matches(x, '^\\pN') AND regexp_matches(left(x, 8), '[. ]'))) >= 3
           AND len(list_filter(l[1:3], lambda x: contains(x, '目录'))) > 0)) THEN 'toc' ELSE 'body' END AS block_type
  FROM (SELECT doc_id, {_lines(_TOC)} AS l FROM documents)""")
def toc_mark(spark, sf):
    k, t, n = F.col("doc_id") % 4, F.col("text"), "\n"
    s = F.when(k == 0, F.concat(F.lit("# 条款目录\n"), t)).when(k == 1, F.concat(F.lit(n.join(["1 总则", "2.1 保险 目录", "3 责任", ""])), t)).when(k == 2, F.lit(n.join(["1 a", "2 b", "3 c", "目录"]))).otherwise(t)
    rows = _t(spark, sf, "documents").select("doc_id", s.alias("markdown"), F.lit("body").alias("block_type"))
    return ordering.mark_toc(rows).select("doc_id", "block_type")


# the gate


def _checked(spark, sf) -> DataFrame:
    k = F.col("doc_id") % 3
    kind = F.when(k == 0, "long_strip").when(k == 1, "table_page").otherwise("normal_page")
    body = F.when(F.col("doc_id") % 17 == 0, F.lit(" \n")).when(F.col("doc_id") % 13 == 0, F.concat(F.lit("<html><head><body>支付宝版权所有<td>"), "text")).otherwise(F.col("text"))
    files = _t(spark, sf, "documents").select("doc_id", body.alias("markdown"), kind.alias("doc_type"), (F.col("doc_id") % 10).alias("chunk_count"), (F.col("doc_id") % 4).alias("failed_chunks"), (F.col("doc_id") % 3).alias("rerun_count"))
    return gate.check_files(files)


_FILES = """
  SELECT doc_id, CASE WHEN doc_id % 17 = 0 THEN E' \\n' WHEN doc_id % 13 = 0 THEN '<html><head><body>支付宝版权所有<td>' || text ELSE text END AS t,
         ['long_strip', 'table_page', 'normal_page'][1 + doc_id % 3] AS doc_type, doc_id % 10 AS cc, doc_id % 4 AS fc, doc_id % 3 AS rerun_count
  FROM documents"""
_QUALITY = f"""SELECT *, list_filter([
  CASE WHEN chars = 0 THEN 'empty_output' WHEN chars < CASE doc_type WHEN 'long_strip' THEN 2000 WHEN 'table_page' THEN 5000 ELSE 0 END THEN 'too_short' END,
  CASE WHEN ratio > 0.18 THEN 'high_duplication' END, CASE WHEN busy THEN 'service_busy_html' END, CASE WHEN full_page THEN 'full_html_page' END,
  CASE WHEN broken THEN 'html_broken' END, CASE WHEN failure > 0.2 THEN 'api_failure_ratio_high' END], lambda x: x IS NOT NULL) AS risks FROM (
  SELECT doc_id, doc_type, rerun_count, length(trim(t, {_WS})) AS chars, {_ratio_sql('t')} AS ratio, {_busy_sql('t')} AS busy, {_full_sql('t')} AS full_page, {_broken_sql('t')} AS broken,
         CASE WHEN cc > 0 THEN fc / cc ELSE 0 END AS failure FROM ({_FILES}))"""


@query(f"""
  SELECT doc_id, CAST(chars AS BIGINT) AS chars, round(ratio, 6) AS duplication_ratio, round(failure, 6) AS api_failure_ratio,
         array_to_string(risks, ',') AS risks, len(risks) = 0 AS passed
  FROM ({_QUALITY})""")
def quality_report(spark, sf):
    return _checked(spark, sf).select("doc_id", F.col("chars").cast("long").alias("chars"), F.round("duplication_ratio", 6).alias("duplication_ratio"), F.round("api_failure_ratio", 6).alias("api_failure_ratio"), F.array_join("risks", ",").alias("risks"), "passed")


@query(f"SELECT risk, count(*) AS n FROM (SELECT unnest(risks) AS risk FROM ({_QUALITY})) GROUP BY risk")
def risk_counts(spark, sf):
    return gate.risk_counts(_checked(spark, sf))


@query(f"SELECT bool_and(len(risks) = 0) AS passed, count(*) AS file_count, count_if(len(risks) > 0) AS failed_count FROM ({_QUALITY})")
def run_summary(spark, sf):
    return gate.run_summary(_checked(spark, sf))


@query(f"SELECT doc_id, array_to_string(risks, ',') AS risks FROM ({_QUALITY}) WHERE len(risks) > 0")
def failed_files(spark, sf):
    return gate.failed_files(_checked(spark, sf).withColumnRenamed("doc_id", "file_name")).select(F.col("file_name").alias("doc_id"), F.array_join("risks", ",").alias("risks"))


@query(f"""SELECT doc_id, rerun, force AS force_api, 1.0::DOUBLE AS window_scale, CASE WHEN rerun AND list_contains(risks, 'too_short') THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END AS overlap_scale, 1.0::DOUBLE AS table_grid_scale,
CASE WHEN force OR (rerun AND list_contains(risks, 'api_failure_ratio_high')) THEN 1 ELSE 0 END AS concurrency, array_to_string(risks, ',') AS reasons FROM (
SELECT *, rerun AND (list_contains(risks, 'service_busy_html') OR list_contains(risks, 'full_html_page')) AS force FROM (SELECT *, len(risks) > 0 AND rerun_count < 2 AS rerun FROM ({_QUALITY})))""")
def retry_plan(spark, sf):
    planned = retry.plan(_checked(spark, sf))
    return planned.select("doc_id", "rerun", "force_api", F.col("window_scale").cast("double").alias("window_scale"), F.col("overlap_scale").cast("double").alias("overlap_scale"), F.col("table_grid_scale").cast("double").alias("table_grid_scale"), "concurrency", F.array_join("risks", ",").alias("reasons"))


@query("""SELECT CAST(sum(n) AS BIGINT) AS image_count, count_if(n > 1) AS duplicate_count, count_if(n > 1) = 0 AS passed FROM (SELECT md5(text) AS name, count(*) AS n FROM documents GROUP BY 1)""")
def input_gate(spark, sf):
    return gate.check_inputs(_t(spark, sf, "documents").select(F.md5(F.col("text").cast("binary")).alias("file_name"))).select("image_count", "duplicate_count", "passed")


@query("SELECT md5(text) AS file_name, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def duplicate_names(spark, sf):
    return gate.duplicate_names(_t(spark, sf, "documents").select(F.md5(F.col("text").cast("binary")).alias("file_name")))


@query("""SELECT doc_id AS file_name, 'expected' AS side FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT DISTINCT doc_id, 'actual' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)""")
def name_set_mismatch(spark, sf):
    return gate.name_difference(_t(spark, sf, "documents").withColumnRenamed("doc_id", "file_name"), _t(spark, sf, "labels").withColumnRenamed("doc_id", "file_name"))


@query("""SELECT (SELECT count(*) FROM labels) AS row_count, (SELECT count(*) FROM documents) AS expected_row_count, array_to_string(list_filter([CASE WHEN (SELECT count(*) FROM labels) <> (SELECT count(*) FROM documents) THEN 'csv_row_count' END,
CASE WHEN (SELECT count(DISTINCT doc_id) FROM labels) < (SELECT count(*) FROM labels) THEN 'csv_duplicate_file_name' END, CASE WHEN EXISTS (SELECT 1 FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) THEN 'csv_file_name_mismatch' END], lambda x: x IS NOT NULL), ',') AS risks""")
def submission_check(spark, sf):
    given = _t(spark, sf, "labels").select(F.col("doc_id").alias("file_name"), F.lit("x").alias("ground_truth"))
    return gate.check_submission(given, _t(spark, sf, "documents").select(F.col("doc_id").alias("file_name"))).select("row_count", "expected_row_count", F.array_join("risks", ",").alias("risks"))


# geometry


def _images(spark, sf) -> DataFrame:
    d = _t(spark, sf, "documents")
    return profile.profile(
        d.select(
            "doc_id", F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".png")).alias("file_name"), "source", F.sha1(F.col("text").cast("binary")).alias("image_sha1"),
            (800 + F.col("doc_id") % 40 * 200).cast("int").alias("width"), (600 + F.col("doc_id") * 7919 % 400 * 100).cast("int").alias("height"),
        )
    )


_IMAGES = """(SELECT *, CASE WHEN aspect >= 10 OR height >= 30000 THEN 'long_strip' WHEN pixels >= 15000000 AND aspect BETWEEN 1.25 AND 1.55 THEN 'table_page' ELSE 'normal_page' END AS doc_type,
CASE WHEN pixels >= 50000000 THEN 'extreme' WHEN pixels >= 20000000 THEN 'high' WHEN pixels >= 8000000 THEN 'medium' ELSE 'low' END AS risk_level FROM (
SELECT *, CAST(width AS BIGINT) * height AS pixels, greatest(width, height) / greatest(1, least(width, height)) AS aspect FROM (
SELECT doc_id, 'doc-' || doc_id || '.png' AS file_name, source, sha1(text) AS image_sha1, CAST(800 + doc_id % 40 * 200 AS INT) AS width, CAST(600 + doc_id * 7919 % 400 * 100 AS INT) AS height FROM documents)))"""


@query(f"SELECT file_name, width, height, pixels, round(aspect, 6) AS aspect, doc_type, risk_level FROM {_IMAGES}")
def profile_classify(spark, sf):
    return _images(spark, sf).select("file_name", "width", "height", "pixels", F.round("aspect", 6).alias("aspect"), "doc_type", "risk_level")


@query(f"""
  SELECT source, doc_type, count(*) AS n, round(quantile_cont(pixels / 1000000, 0.5), 6) AS median_megapixels,
         round(quantile_cont(pixels / 1000000, 0.9), 6) AS p90_megapixels, round(max(pixels / 1000000), 6) AS max_megapixels,
         round(quantile_cont(aspect, 0.5), 6) AS median_aspect, round(max(aspect), 6) AS max_aspect,
         CAST(count_if(pixels > 16777216) AS BIGINT) AS n_over_16m, CAST(count_if(pixels > 100000000) AS BIGINT) AS n_over_100m,
         CAST(sum((pixels + 3999999) // 4000000) AS BIGINT) AS chunks_4m, CAST(sum((pixels + 16777215) // 16777216) AS BIGINT) AS chunks_16m
  FROM {_IMAGES}
  GROUP BY source, doc_type""")
def size_stats(spark, sf):
    stats = profile.statistics(profile.budgets(_images(spark, sf)), "source", "doc_type")
    return stats.select(*(F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in stats.dtypes))


@query(f"SELECT file_name, width, height, pixels FROM {_IMAGES} ORDER BY pixels DESC, file_name LIMIT 5")
def size_extremes(spark, sf):
    return profile.extremes(_images(spark, sf), "pixels").select("file_name", "width", "height", "pixels")


_STRIPS = f"(SELECT * FROM {_IMAGES} WHERE doc_type = 'long_strip')"
_BANDS = "list_filter(list_transform(range(1, height // 977 + 1), lambda k: k * 977 + doc_id % 13 * 31 + 20), lambda m: m + 20 <= height)"
_WINDOWS = """WITH RECURSIVE w AS (
  SELECT file_name, width, height, c, 0 AS "row", 0 AS y0, {first} AS y1 FROM (SELECT *, {bands} AS c FROM {images})
  UNION ALL SELECT file_name, width, height, c, "row" + 1, greatest(y1 - 320, y0 + 1), {next} FROM w WHERE y1 < height)
SELECT file_name, "row", 0 AS x0, y0, width AS x1, y1, CASE WHEN y0 > 0 THEN 320 ELSE 0 END AS top, CASE WHEN y1 < height THEN 320 ELSE 0 END AS bottom FROM w"""


def _snap_sql(y: str) -> str:
    best = f"list_sort(list_transform(list_filter(c, lambda m: abs(m - ({y})) <= 320), lambda m: [abs(m - ({y})), m]))[1][2]"
    return f"CAST(CASE WHEN ({y}) >= height THEN height WHEN {best} IS NULL THEN {y} ELSE greatest(1, {best}) END AS INT)"


_CHUNK_COLUMNS = ("file_name", "row", "x0", "y0", "x1", "y1")


@query(_WINDOWS.format(images=_STRIPS, bands="CAST([] AS BIGINT[])", first="CAST(least(height, 4000) AS INT)", next="CAST(least(height, greatest(y1 - 320, y0 + 1) + 4000) AS INT)"))
def long_strip_chunks(spark, sf):
    cut = chunking.long_strip(_images(spark, sf).where("doc_type = 'long_strip'"))
    return cut.select(*_CHUNK_COLUMNS, F.col("overlap")["top"].alias("top"), F.col("overlap")["bottom"].alias("bottom"))


def _banded(spark, sf) -> DataFrame:
    k = F.sequence(F.lit(1), F.floor(F.col("height") / 977).cast("int"))
    at = lambda i: (i * 977 + F.col("doc_id") % 13 * 31).cast("int")
    bands = F.filter(F.transform(k, lambda i: F.struct(at(i).alias("s"), (at(i) + 40).alias("e"))), lambda b: b["e"] <= F.col("height"))
    return _images(spark, sf).where("doc_type = 'long_strip'").withColumn("bands", bands)


_SNAPPED = _WINDOWS.format(images=_STRIPS, bands=_BANDS, first=_snap_sql("4000"), next=_snap_sql("greatest(y1 - 320, y0 + 1) + 4000"))


@query(_SNAPPED)
def long_strip_snapped(spark, sf):
    cut = chunking.long_strip(_banded(spark, sf), bands="bands")
    return cut.select(*_CHUNK_COLUMNS, F.col("overlap")["top"].alias("top"), F.col("overlap")["bottom"].alias("bottom"))


_GRID = f"""(SELECT file_name, image_sha1, doc_type, width, height, r AS "row", c AS col, CAST(greatest(0, c * width // nc - CASE WHEN c > 0 THEN 160 ELSE 0 END) AS INT) AS x0, CAST(greatest(0, r * height // nr - CASE WHEN r > 0 THEN 220 ELSE 0 END) AS INT) AS y0,
CAST(least(width, (c + 1) * width // nc + CASE WHEN c < nc - 1 THEN 160 ELSE 0 END) AS INT) AS x1, CAST(least(height, (r + 1) * height // nr + CASE WHEN r < nr - 1 THEN 220 ELSE 0 END) AS INT) AS y1,
CASE WHEN c > 0 THEN 160 ELSE 0 END AS o_left, 160 AS o_right, CASE WHEN r > 0 THEN 220 ELSE 0 END AS o_top, 220 AS o_bottom
FROM (SELECT *, CAST(unnest(range(0, nc)) AS INT) AS c FROM (SELECT *, CAST(unnest(range(0, nr)) AS INT) AS r FROM (
SELECT *, CASE WHEN pixels <= 8000000 THEN 1 ELSE CAST(greatest(1, ceil(pixels / (nc * 4000000.0::DOUBLE))) AS INT) END AS nr
FROM (
  SELECT *, CASE WHEN pixels <= 8000000 THEN 1 ELSE CAST(greatest(1, ceil(sqrt(pixels / 4000000.0::DOUBLE))) AS INT) END AS nc
  FROM {_IMAGES} WHERE doc_type <> 'long_strip')))))"""


def _grid(spark, sf) -> DataFrame:
    return chunking.grid(_images(spark, sf).where("doc_type <> 'long_strip'"))


@query(f'SELECT file_name, "row", col, x0, y0, x1, y1, o_left, o_right, o_top, o_bottom FROM {_GRID}')
def table_grid_chunks(spark, sf):
    return _grid(spark, sf).select("file_name", "row", "col", "x0", "y0", "x1", "y1", *(F.col("overlap")[k].alias(f"o_{k}") for k in ("left", "right", "top", "bottom")))


@query(f"SELECT file_name, x0, y0, left(sha1(file_name || ':(' || x0 || ', ' || y0 || ', ' || x1 || ', ' || y1 || '):' || image_sha1), 16) AS chunk_id FROM {_GRID}")
def chunk_ids(spark, sf):
    return chunking.with_ids(_grid(spark, sf)).select("file_name", "x0", "y0", "chunk_id")


_PLAIN_STRIPS = _WINDOWS.format(
    images=_STRIPS, bands="CAST([] AS BIGINT[])", first="CAST(least(height, 4000) AS INT)", next="CAST(least(height, greatest(y1 - 320, y0 + 1) + 4000) AS INT)"
)


@query(f"""SELECT file_name, CAST(count(*) AS INT) AS n, string_agg(left(sha1(file_name || ':(' || x0 || ', ' || y0 || ', ' || x1 || ', ' || y1 || '):' || image_sha1), 16), ',' ORDER BY "row", col) AS ids
FROM {_GRID} GROUP BY file_name""")
def chunk_manifest(spark, sf):
    told = chunking.manifest(chunking.with_ids(_grid(spark, sf)))
    read = F.from_json("manifest", "file_name string, chunks array<struct<chunk_id:string,`row`:int,col:int>>")
    return told.select(read.alias("m")).select("m.file_name", F.size("m.chunks").alias("n"), F.array_join(F.col("m.chunks.chunk_id"), ",").alias("ids"))


#: A page of each document: its words are ink and its white space is not, a character a pixel, in a square; five blank rows; the same again.
_PAGE = """
  WITH d AS (SELECT doc_id, text, CAST(greatest(4, ceil(sqrt(length(text)))) AS BIGINT) AS w FROM documents),
  h AS (SELECT *, (length(text) + w - 1) // w AS h FROM d),
  px AS (
    SELECT doc_id, w, 2 * h + 5 AS h, (i % w) AS x, (i // w) + CASE half WHEN 0 THEN 0 ELSE h + 5 END AS y,
           CASE WHEN c = '' OR contains(chr(32) || chr(10), c) THEN 255 WHEN ord(c) > 126 THEN 126 ELSE ord(c) END AS g
    FROM (SELECT *, substr(text, i + 1, 1) AS c FROM (SELECT *, unnest(range(0, w * h)) AS i FROM h)), (SELECT unnest([0, 1]) AS half)
    UNION ALL
    SELECT doc_id, w, 2 * h + 5, x, h + y, 255 FROM (SELECT *, unnest(range(0, w)) AS x FROM h), (SELECT unnest(range(0, 5)) AS y)),
  r AS (SELECT doc_id, w, h, y AS i, avg(CAST(g < 245 AS INT)) AS share FROM px GROUP BY doc_id, w, h, y),
  c AS (SELECT doc_id, w, h, x AS i, avg(CAST(g < 245 AS INT)) AS share FROM px GROUP BY doc_id, w, h, x),
  rb AS (SELECT doc_id, h, min(i) AS s, max(i) + 1 AS e FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM r WHERE share <= 0.01) GROUP BY doc_id, h, k HAVING count(*) >= greatest(3, h // 100)),
  cb AS (SELECT doc_id, w, min(i) AS s, max(i) + 1 AS e FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM c WHERE share <= 0.01) GROUP BY doc_id, w, k HAVING count(*) >= greatest(3, w // 100)),
  ra AS (SELECT doc_id, max(h) AS h, min(i) FILTER (share > 0) AS y0, max(i) FILTER (share > 0) + 1 AS y1, avg(CAST(share > 0.35 AS INT)) AS heavy FROM r GROUP BY doc_id),
  ca AS (
    SELECT doc_id, max(w) AS w, min(i) FILTER (share > 0) AS x0, max(i) FILTER (share > 0) + 1 AS x1, avg(CAST(share > 0.35 AS INT)) AS heavy, avg(CAST(share > most AS INT)) AS dense
    FROM (SELECT *, greatest(0.03, avg(share) OVER (PARTITION BY doc_id) * 1.5) AS most FROM c) GROUP BY doc_id),
  flat AS (SELECT doc_id, stddev_pop(g) < 2 AS flat FROM px GROUP BY doc_id)"""


@query(_PAGE + """
SELECT ra.doc_id, CAST(coalesce(x0, 0) AS INT) AS x0, CAST(coalesce(y0, 0) AS INT) AS y0, CAST(coalesce(x1, w) AS INT) AS x1, CAST(coalesce(y1, h) AS INT) AS y1,
       coalesce((SELECT string_agg(s || '-' || e, ' ' ORDER BY s) FROM rb WHERE rb.doc_id = ra.doc_id), '') AS bands,
       coalesce((SELECT string_agg(s || '-' || e, ' ' ORDER BY s) FROM cb WHERE cb.doc_id = ra.doc_id), '') AS gaps,
       CASE WHEN dense > 0.05 AND EXISTS (SELECT 1 FROM cb WHERE cb.doc_id = ra.doc_id) THEN 2 ELSE 1 END AS column_count, round((ra.heavy + ca.heavy) / 2, 6) AS line_density
FROM ra JOIN ca ON ra.doc_id = ca.doc_id JOIN flat ON flat.doc_id = ra.doc_id WHERE NOT flat""")
def page_ink(spark, sf):
    """Layout hints of a page per document; pages of one shade aside, which the SQL leaves out."""
    d = _t(spark, sf, "documents").where("text rlike '[^ \\\\n]'")
    w = F.greatest(F.lit(4), F.ceil(F.sqrt(F.length("text")))).cast("int")
    d = d.select("doc_id", "text", w.alias("width")).withColumn("h", F.ceil(F.length("text") / F.col("width")).cast("int"))
    blank = F.lit("ÿ")
    half = F.rpad(F.regexp_replace(F.regexp_replace("text", "[ \n]", "ÿ"), "[^\\x00-\\x7eÿ]", "~"), F.col("width") * F.col("h"), blank)
    pixels = F.encode(F.concat(half, F.repeat(blank, 5 * F.col("width")), half), "ISO-8859-1")
    pages = d.select(F.col("doc_id").cast("string").alias("path"), (2 * F.col("h") + 5).alias("height"), "width", F.lit(1).alias("nChannels"), pixels.alias("data"))
    runs = lambda c: F.array_join(F.transform(c, lambda b: F.concat_ws("-", b["s"], b["e"])), " ")
    box = [F.col(f"crop_box.{k}").alias(k) for k in ("x0", "y0", "x1", "y1")]
    return layout.analyze(pages).select(F.col("path").cast("long").alias("doc_id"), *box, runs("horizontal_blank_bands").alias("bands"), runs("vertical_blank_bands").alias("gaps"), "column_count", F.round("table_line_density", 6).alias("line_density"))


@query(f"""
  SELECT doc_type, count(*) AS n, count(DISTINCT file_name) AS files, CAST(sum(x1 - x0) AS BIGINT) AS widths FROM {_GRID} GROUP BY 1
  UNION ALL
  SELECT 'long_strip', count(*), count(DISTINCT file_name), CAST(sum(x1 - x0) AS BIGINT) FROM ({_PLAIN_STRIPS})""")
def chunk_dispatch(spark, sf):
    return chunking.chunk(_images(spark, sf)).groupBy("doc_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("file_name").alias("files"), F.sum((F.col("x1") - F.col("x0")).cast("long")).alias("widths"))


@query(f"""
  WITH w AS ({_SNAPPED}),
  s AS (SELECT file_name, width, height FROM {_STRIPS}),
  g AS (
    SELECT w.*, s.width, s.height, max(y1) OVER (PARTITION BY w.file_name ORDER BY y0, y1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached
    FROM w JOIN s ON s.file_name = w.file_name)
  SELECT file_name, bool_and(y0 <= coalesce(reached, 0)) AND max(y1) = max(height) AS covered,
         bool_and(x0 >= 0 AND y0 >= 0 AND x1 <= width AND y1 <= height AND x0 < x1 AND y0 < y1) AS in_bounds
  FROM g GROUP BY file_name""")
def chunk_coverage(spark, sf):
    return chunking.coverage(chunking.long_strip(_banded(spark, sf), bands="bands"))


_SERIES = "SELECT doc_id, i, CASE WHEN (doc_id * 31 + i * i) % 11 < 8 THEN 0.0 ELSE 0.5 END AS density FROM documents, range(0, 120) AS r(i)"


@query(f"""SELECT doc_id, CAST(min(i) AS INT) AS s, CAST(max(i) + 1 AS INT) AS e FROM (SELECT doc_id, i, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS g FROM ({_SERIES}) WHERE density <= 0.01) GROUP BY doc_id, g HAVING count(*) >= 3""")
def blank_bands(spark, sf):
    rows = _t(spark, sf, "documents").select("doc_id", F.explode(F.sequence(F.lit(0), F.lit(119))).alias("i"))
    return layout.blank_bands(rows.withColumn("density", F.when((F.col("doc_id") * 31 + F.col("i") * F.col("i")) % 11 < 8, 0.0).otherwise(0.5)), "doc_id")


@query("""SELECT doc_id, s AS start_px, greatest(s, e) AS end_px FROM (SELECT doc_id, CAST(greatest(0, least(5000, round_even(doc_id % 300 * 2.5, 0))) AS INT) AS s, CAST(greatest(0, least(5000, round_even((doc_id % 300 + doc_id % 7) * 2.5, 0))) AS INT) AS e FROM documents)""")
def band_mapping(spark, sf):
    band = F.struct((F.col("doc_id") % 300).alias("s"), (F.col("doc_id") % 300 + F.col("doc_id") % 7).alias("e"))
    got = layout.to_original(band, F.lit(2.5), F.lit(5000))
    return _t(spark, sf, "documents").select("doc_id", got["s"].alias("start_px"), got["e"].alias("end_px"))


@query(f"""SELECT file_name, "row", col, row_number() OVER (PARTITION BY file_name ORDER BY CASE WHEN doc_type = 'table_page' THEN "row" END, CASE WHEN doc_type = 'table_page' THEN col END, y0, x0, "row" * 1000 + col) AS rank FROM (
SELECT file_name, doc_type, "row" - CASE WHEN col % 5 = 4 THEN 99 ELSE 0 END AS "row", col, x0, y0 FROM {_GRID}) WHERE NOT (doc_type = 'table_page' AND ("row" < 0 OR col < 0))""")
def reading_order(spark, sf):
    rows = _grid(spark, sf).withColumn("row", F.col("row") - F.when(F.col("col") % 5 == 4, 99).otherwise(0)).withColumn("ordinal", F.col("row") * 1000 + F.col("col"))
    return ordering.reading_order(rows).select("file_name", "row", "col", F.col("rank").cast("long").alias("rank"))


@query("""SELECT source, doc_id FROM (SELECT *, row_number() OVER (ORDER BY source, doc_id) AS m FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents) WHERE n <= 3) WHERE m <= 40""")
def per_source_limit(spark, sf):
    from .sources.readers import sample

    rows = _t(spark, sf, "documents").select(F.col("source").alias("dir_ord"), F.col("doc_id").alias("file_name"))
    return sample(rows, 3, 40).select(F.col("dir_ord").alias("source"), F.col("file_name").alias("doc_id"))


@query("SELECT doc_id, suffix_ok FROM (SELECT doc_id, lower(regexp_extract(n, '\\.([^./]+)$', 1)) IN ('png', 'jpg', 'jpeg', 'webp', 'bmp', 'tif', 'tiff') AS suffix_ok FROM (SELECT doc_id, source || ['.PNG', '.txt', '.jpeg', '.tiff.md', ''][1 + doc_id % 5] AS n FROM documents))")
def image_suffixes(spark, sf):
    from .sources.readers import is_image_name

    name = F.concat("source", F.element_at(F.array(*map(F.lit, (".PNG", ".txt", ".jpeg", ".tiff.md", ""))), (F.col("doc_id") % 5 + 1).cast("int")))
    return _t(spark, sf, "documents").select("doc_id", is_image_name(name).alias("suffix_ok"))


# caches, work lists, users


@query("SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_worklist(spark, sf):
    done = _t(spark, sf, "labels").select("doc_id", F.lit("").alias("markdown"))
    return cache.work_list(_t(spark, sf, "documents"), done, key="doc_id")[0].select("doc_id", "n_chars")


@query("""SELECT CAST(d.doc_id AS VARCHAR) AS chunk_id, sha1(d.text) AS response_sha1 FROM documents d JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id) WHERE d.doc_id % 2 = 0 AND d.doc_id % 3 <> 1 AND d.doc_id % 5 <> 2 AND d.doc_id % 7 <> 3 AND d.doc_id % 11 <> 4""")
def cache_validate(spark, sf):
    chunks = _t(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("chunk_id"), F.sha1(F.col("lang").cast("binary")).alias("image_sha1"), "doc_id")
    kept = _t(spark, sf, "documents").join(_t(spark, sf, "labels").select("doc_id").distinct(), "doc_id")
    k = F.col("doc_id")
    stored = kept.select(
        k.cast("string").alias("chunk_id"), F.when(k % 2 == 0, F.sha1(F.col("lang").cast("binary"))).otherwise("other").alias("image_sha1"), F.when(k % 3 == 1, "http://b").otherwise("http://a").alias("api_url"), (k % 5 != 2).alias("content_validated"),
        F.when(k % 7 == 3, 0).otherwise(1).alias("validator_version"), F.when(k % 11 == 4, "x").otherwise(F.sha1(F.col("text").cast("binary"))).alias("response_sha1"), F.col("text").alias("markdown"),
    )
    return cache.hits(chunks, stored, "http://a").select("chunk_id", cache.text_sha1().alias("response_sha1"))


@query("SELECT doc_id, ['u1', 'u2', 'u3'][1 + (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) % 3] AS user_id FROM documents")
def user_round_robin(spark, sf):
    turn = F.row_number().over(Window.partitionBy("source").orderBy("doc_id")) - 1
    return _t(spark, sf, "documents").select("doc_id", recognize.assigned_user(turn, ["u1", "u2", "u3"]).alias("user_id"))


@query("SELECT doc_id, CASE WHEN s IN (401, 403) THEN 'auth' WHEN s >= 500 THEN 'retryable' WHEN s >= 400 THEN 'error' ELSE 'ok' END AS outcome FROM (SELECT doc_id, [200, 401, 403, 404, 500, 503][1 + doc_id % 6] AS s FROM documents)")
def http_status_policy(spark, sf):
    status = F.element_at(F.array(*map(F.lit, (200, 401, 403, 404, 500, 503))), (F.col("doc_id") % 6 + 1).cast("int"))
    return _t(spark, sf, "documents").select("doc_id", recognize.status_class(status).alias("outcome"))


@query(f"""SELECT doc_id, CASE doc_id % 3 WHEN 2 THEN trim('x' || text, {_WS}) ELSE trim(text, {_WS}) END AS markdown FROM documents""")
def markdown_fence(spark, sf):
    k = F.col("doc_id") % 3
    s = F.when(k == 0, F.concat(F.lit("```markdown\n"), "text", F.lit("\n```\n"))).when(k == 1, F.concat(F.lit("  ```MD \n"), "text", F.lit("```"))).otherwise(F.concat(F.lit("x"), "text"))
    return _t(spark, sf, "documents").select("doc_id", text.unfence(s).alias("markdown"))


@query(f"SELECT doc_id, trim(text, {_WS}) AS markdown FROM documents")
def response_unwrap(spark, sf):
    chat = F.to_json(F.struct(F.array(F.struct(F.struct(F.concat(F.lit("```md\n"), "text", F.lit("\n```")).alias("content")).alias("message"))).alias("choices")))
    body = F.when(F.col("doc_id") % 3 == 0, F.to_json(F.struct(F.lit(True).alias("success"), F.struct(chat.alias("result")).alias("result")))).when(F.col("doc_id") % 3 == 1, F.to_json(F.struct(chat.alias("result")))).otherwise(chat)
    return recognize.unwrap_all(_t(spark, sf, "documents").select("doc_id", body.alias("body")), "body").select("doc_id", "markdown")


@query("""SELECT doc_id, CAST(least(doc_id % 5, 2) AS INT) AS rerun_count, doc_id % 5 <= 2 AS passed, CASE WHEN doc_id % 5 <= 2 THEN '' ELSE 'too_short' END AS risks FROM documents""")
def rerun_loop(spark, sf):
    """Each file passes at its own attempt, or never within the bound."""
    from .sources import sinks

    sinks.shared_dir(spark)  # rounds are checkpoints there
    risks = lambda ok: F.when(ok, F.array().cast("array<string>")).otherwise(F.array(F.lit("too_short")))
    first = F.col("doc_id") % 5 == 0
    files = _t(spark, sf, "documents").select("doc_id", risks(first).alias("risks"), first.alias("passed"), F.lit(0).alias("rerun_count"))

    def attempt(planned: DataFrame) -> DataFrame:
        ok = F.col("rerun_count") + 1 >= F.col("doc_id") % 5
        return planned.select("doc_id", risks(ok).alias("risks"), ok.alias("passed"))

    return retry.rerun_until(files, attempt).select("doc_id", "rerun_count", "passed", F.array_join("risks", ",").alias("risks"))


def _answer(fields: dict, user: str) -> tuple[int, str]:
    """A service that knows each document for one of five users, of whom there are three."""
    if user != f"u{fields['doc_id'] * 7 % 5}":
        return 503, "not mine"
    table = "<TABLE><tr><td>1</td></tr></TABLE>" if fields["doc_id"] % 4 == 1 else ""
    return 200, f"```md\n{table}{fields['text']}\n```"


@query(f"""SELECT doc_id, t < 3 AS ok, CASE WHEN t >= 3 THEN 'unknown' WHEN doc_id % 4 = 1 THEN 'table' ELSE 'body' END AS block_type, CAST(CASE WHEN t >= 3 THEN 3 ELSE (t - doc_id % 3 + 3) % 3 + 1 END AS INT) AS attempts,
'u' || CASE WHEN t >= 3 THEN (doc_id + 2) % 3 ELSE t END AS last_user, CASE WHEN t >= 3 THEN '' ELSE CASE WHEN doc_id % 4 = 1 THEN '<TABLE><tr><td>1</td></tr></TABLE>' || rtrim(text, {_WS}) ELSE trim(text, {_WS}) END END AS markdown
FROM (SELECT *, doc_id * 7 % 5 AS t FROM documents)""")
def recognition(spark, sf):
    """Requests in lanes by user, retried with the next user; what fails three times stays with an empty text."""
    from .sources import sinks

    sinks.shared_dir(spark)
    chunks = _t(spark, sf, "documents").select(F.col("doc_id").alias("ordinal"), "doc_id", "text")
    got = recognize.recognize(chunks, _answer, ["u0", "u1", "u2"], 6, 2, 2, sleep=lambda s: None)
    return got.select("doc_id", "ok", "block_type", F.size("log").alias("attempts"), F.element_at("log.user_id", -1).alias("last_user"), "markdown")


@query("""SELECT file_name, CAST(count(*) AS INT) AS chunk_count, CAST(count(*) FILTER (role = 'system') AS INT) AS failed_chunks
FROM (SELECT CAST(conv_id AS VARCHAR) AS file_name, role FROM conversations) GROUP BY file_name""")
def failed_chunks(spark, sf):
    """Texts of a conversation as a file's chunks, its system turns as failed ones."""
    from .plans.restore import texts_to_files

    rows = _t(spark, sf, "conversations").select(
        F.col("conv_id").cast("string").alias("file_name"), F.concat_ws("-", "conv_id", "turn").alias("chunk_id"), "text", (F.col("role") != "system").alias("ok"), F.lit("normal_page").alias("doc_type"), F.col("turn").cast("int").alias("row"),
        F.lit(0).alias("col"), F.col("turn").alias("ordinal"), F.lit(0).alias("x0"), F.col("turn").cast("int").alias("y0"), F.lit(1).alias("x1"), (F.col("turn") + 1).cast("int").alias("y1"), F.create_map(F.lit("top"), F.lit(0)).alias("overlap"),
    )
    chunks = rows.withColumn("markdown", F.when(F.col("ok"), F.col("text")).otherwise("")).withColumn("block_type", F.when(F.col("ok"), text.block_type(F.col("markdown"))).otherwise("unknown")).drop("text")
    return texts_to_files(chunks).select("file_name", "chunk_count", "failed_chunks")


# merging and evaluation


@query("""SELECT doc_id, k AS "row", CAST(k * 320 AS INT) AS y0, CAST(least(length(text), k * 320 + 400) AS INT) AS y1, substr(text, CAST(k * 320 + 1 AS BIGINT), 400) AS markdown FROM (
SELECT doc_id, text, CAST(unnest(range(0, CASE WHEN length(text) <= 400 THEN 1 ELSE CAST(ceil((length(text) - 80) / 320.0) AS INT) END)) AS INT) AS k FROM documents WHERE length(text) > 0)""")
def window_chunk_text(spark, sf):
    return chunking.text_windows(_t(spark, sf, "documents"))


def _text_chunks(spark, sf, noisy: bool = False) -> DataFrame:
    rows = chunking.text_windows(_t(spark, sf, "documents"), 400, 80)
    if noisy:
        # one character of the shared part is misread every 29
        rows = rows.withColumn("markdown", F.when(F.col("row") > 0, F.concat(F.left("markdown", F.lit(29)), F.lit("~"), F.substring("markdown", 31, 100_000))).otherwise(F.col("markdown")))
    size = F.lit(80)
    return rows.select(
        F.col("doc_id").cast("string").alias("file_name"), F.concat_ws("-", "doc_id", "row").alias("chunk_id"), "markdown", F.lit("body").alias("block_type"), F.lit(0).alias("x0"), "y0", F.lit(100).alias("x1"), "y1",
        "row", F.lit(0).alias("col"), F.col("row").alias("ordinal"), F.lit("normal_page").alias("doc_type"), F.create_map(F.lit("top"), F.when(F.col("row") > 0, size).otherwise(0)).alias("overlap"),
    )


def _merged(chunks: DataFrame, fuzzy: bool) -> DataFrame:
    got = merge.merge(merge.may_overlap(ordering.reading_order(chunks)), fuzzy=fuzzy)
    return got.select("file_name", "markdown", F.size("removed").alias("seams"), F.aggregate("removed", F.lit(0), lambda a, r: a + r["end"]).alias("removed_chars"))


def _fold_sql(chunks: str) -> str:
    """The fold of ordered chunks (file_name, n, trim, markdown) row by row; an overlap is the longest end of the text so far that begins the next."""
    more = lambda a, b: f"{_count('t', a)} > {_count('t', b)}"
    goes_on = f"(t <> '' AND ({' OR '.join(more(a, b) for a, b in merge.MARKS)} OR contains('{text.OPEN_ENDINGS}', right(t, 1))))"
    return f"""
  WITH RECURSIVE c AS ({chunks}),
  f AS (
    SELECT file_name, CAST(1 AS BIGINT) AS n, rtrim(markdown, {_WS}) AS t, CAST(0 AS BIGINT) AS seams, CAST(0 AS BIGINT) AS removed FROM c WHERE n = 1
    UNION ALL
    SELECT file_name, n, CASE WHEN cut > 0 AND rest = '' THEN t WHEN cut > 0 AND starts_with(rest, chr(10)) THEN t || rest WHEN {goes_on} THEN t || ltrim(rest, {_WS})
             WHEN rest = '' THEN t WHEN t = '' THEN ltrim(rest, {_WS}) ELSE t || chr(10) || chr(10) || ltrim(rest, {_WS}) END,
           seams + CAST(cut > 0 AS BIGINT), removed + cut
    FROM (
      SELECT *, substr(now, CAST(cut + 1 AS BIGINT)) AS rest
      FROM (
        SELECT *, CASE WHEN trim THEN coalesce(list_max(list_filter(range({merge.LEAST_EXACT}, least(length(ending), length(now), {merge.WINDOW_BODY}) + 1), lambda k: right(ending, k) = left(now, k))), 0) ELSE 0 END AS cut
        FROM (
          SELECT f.file_name, c.n, t, seams, removed, c.trim, trim(c.markdown, {_WS}) AS now, right(t, {merge.WINDOW_BODY}) AS ending
          FROM f JOIN c ON c.file_name = f.file_name AND c.n = f.n + 1))))
  SELECT file_name, CASE WHEN trim(t, {_WS}) = '' THEN '' ELSE trim(t, {_WS}) || chr(10) END AS markdown, CAST(seams AS INT) AS seams, CAST(removed AS INT) AS removed_chars
  FROM (SELECT *, max(n) OVER (PARTITION BY file_name) AS last FROM f) WHERE n = last"""


_CHUNKS = """
    SELECT CAST(doc_id AS VARCHAR) AS file_name, k + 1 AS n, k > 0 AS trim, substr(text, CAST(k * 320 + 1 AS BIGINT), 400) AS markdown
    FROM (SELECT doc_id, text, unnest(range(0, CASE WHEN length(text) <= 400 THEN 1 ELSE CAST(ceil((length(text) - 80) / 320.0) AS INT) END)) AS k FROM documents WHERE length(text) > 0)"""


@query(_fold_sql(_CHUNKS))
def seam_merge_exact(spark, sf):
    return _merged(_text_chunks(spark, sf), False)


@query()
def seam_merge_fuzzy(spark, sf):
    return _merged(_text_chunks(spark, sf, True), True)


_PLAIN_WINDOWS = _WINDOWS.format(
    images=_STRIPS, bands="CAST([] AS BIGINT[])", first="CAST(least(height, 4000) AS INT)", next="CAST(least(height, greatest(y1 - 320, y0 + 1) + 4000) AS INT)"
)


@query(f"""
  WITH k AS (SELECT *, CASE WHEN "row" % 7 = 6 THEN 'table' ELSE 'body' END AS kind FROM ({_PLAIN_WINDOWS})),
  c AS (
    SELECT *, lag(x0) OVER w AS a, lag(y0) OVER w AS b, lag(x1) OVER w AS c, lag(y1) OVER w AS d, lag(kind) OVER w AS before
    FROM k WINDOW w AS (PARTITION BY file_name ORDER BY "row"))
  SELECT file_name, "row", coalesce(kind = 'body' AND before = 'body' AND least(x1, c) > greatest(x0, a) AND least(y1, d) > greatest(y0, b), false) AS trim
  FROM c""")
def overlap_predicate(spark, sf):
    cut = chunking.long_strip(_images(spark, sf).where("doc_type = 'long_strip'")).withColumn("block_type", F.when(F.col("row") % 7 == 6, "table").otherwise("body"))
    return merge.may_overlap(cut, "row").select("file_name", "row", "trim")


_TURNS = """
    SELECT CAST(conv_id AS VARCHAR) AS file_name, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n, false AS trim, coalesce(text, '') AS markdown
    FROM conversations"""


@query(f"SELECT file_name, markdown, seams FROM ({_fold_sql(_TURNS)})")
def conversation_fold(spark, sf):
    rows = _t(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("file_name"), F.col("turn").alias("rank"), F.concat_ws("-", "conv_id", "turn").alias("chunk_id"), F.col("text").alias("markdown"), F.lit("body").alias("block_type"), F.lit(False).alias("trim"))
    return merge.merge(rows).select("file_name", "markdown", F.size("removed").alias("seams"))


#: A cell that stays open holds all rows after it, so it and its row are closed at the end, once each.
@query(rf"""
  SELECT l_orderkey, replace(replace(replace(t, '<TABLE>', '<table>'), '</table>', ''), '''q''', '"q"') || repeat('</td></tr>', {_count('t', 'class=')}) || '</table>' AS markdown,
         CAST({' + '.join(rf"greatest(0, len(regexp_extract_all(lower(t), '<{x}\b')) - {_count('lower(t)', f'</{x}>')})" for x in html.TABLE_TAGS)} AS INT) AS repaired_tags
  FROM ({_TABLES})""")
def table_repair(spark, sf):
    return tables.repair(_order_tables(spark, sf))


#: A table a line, with the line's flag as header and nothing, a blank or a letter before it; chains are islands of linked lines.
@query("""
  WITH l AS (
    SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_returnflag, CAST(l_partkey AS VARCHAR) || '<') AS n, l_returnflag AS h, l_partkey AS p,
           CASE l_linenumber % 4 WHEN 0 THEN 'x' WHEN 1 THEN ' ' ELSE '' END AS before
    FROM lineitem),
  k AS (SELECT *, coalesce(trim(before) = '' AND lag(h) OVER (PARTITION BY l_orderkey ORDER BY n) = h, false) AS linked FROM l),
  c AS (SELECT *, sum(CAST(NOT linked AS INT)) OVER (PARTITION BY l_orderkey ORDER BY n) AS chain FROM k),
  m AS (
    SELECT l_orderkey, n, before, linked, h, string_agg('<tr><td>' || p || '</td></tr>', '' ORDER BY n) OVER (PARTITION BY l_orderkey, chain) AS body
    FROM c)
  SELECT l_orderkey, string_agg(before || CASE WHEN linked THEN '' ELSE '<table><tr><td>' || h || '</td></tr>' || body || '</table>' END, '' ORDER BY n) AS markdown, 0 AS repaired_tags
  FROM m GROUP BY l_orderkey""")
def table_chains(spark, sf):
    before = F.when(F.col("l_linenumber") % 4 == 0, "x").when(F.col("l_linenumber") % 4 == 1, " ").otherwise("")
    one = F.concat(before, F.lit("<table><tr><td>"), "l_returnflag", F.lit("</td></tr><tr><td>"), F.col("l_partkey").cast("string"), F.lit("</td></tr></table>"))
    rows = _t(spark, sf, "lineitem").select("l_orderkey", F.struct("l_linenumber", one.alias("one")).alias("r"))
    return tables.repair(rows.groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["one"]), "").alias("markdown")))


#: DuckDB's levenshtein counts bytes, so SQL first gives every character beyond ASCII an ASCII one that no text holds.
_PAIRS = """
  WITH held AS (SELECT DISTINCT unnest(string_split(text, '')) AS c FROM benchmark),
  wide AS (SELECT c, row_number() OVER (ORDER BY c) AS n FROM held WHERE ord(c) > 127),
  free AS (
    SELECT chr(CAST(i AS INT)) AS f, row_number() OVER (ORDER BY i) AS n
    FROM range(1, 128) r(i) WHERE chr(CAST(i AS INT)) NOT IN (SELECT c FROM held)),
  spelt AS (SELECT coalesce(string_agg(c, '' ORDER BY n), '') AS old, coalesce(string_agg(f, '' ORDER BY n), '') AS new FROM wide JOIN free USING (n)),
  narrow AS (SELECT item_id, translate(text, old, new) AS text FROM benchmark, spelt)
  SELECT a.item_id, a.text AS p, b.text AS g
  FROM narrow a JOIN narrow b ON b.item_id = a.item_id + CASE WHEN a.item_id % 3 = 0 THEN 0 ELSE 1 END"""


def _evaluated(spark: SparkSession, sf: str) -> DataFrame:
    b = _t(spark, sf, "benchmark")
    pred = b.select("item_id", F.concat(F.col("item_id") + F.when(F.col("item_id") % 3 == 0, 0).otherwise(1), F.lit(".md")).alias("file_name"), F.col("text").alias("markdown"))
    return evaluate.evaluate(pred, b.select(F.concat("item_id", F.lit(".md")).alias("file_name"), F.col("text").alias("markdown")))[0]


def _distances(records: DataFrame) -> DataFrame:
    return records.select("item_id", F.col("edit_distance").cast("int").alias("edit_distance"), F.round("normalized_edit_distance", 6).alias("normalized_edit_distance"), F.round("length_ratio", 6).alias("length_ratio"))


def _summed(records: DataFrame) -> DataFrame:
    return evaluate.summary(records).select("file_count", F.round("mean_normalized_edit_distance", 6).alias("mean_normalized_edit_distance"))


@query(f"SELECT item_id, CAST(levenshtein(p, g) AS INT) AS edit_distance, round(levenshtein(p, g) / greatest(1, length(g)), 6) AS normalized_edit_distance, round(length(p) / greatest(1, length(g)), 6) AS length_ratio FROM ({_PAIRS})")
def eval_distance(spark, sf):
    return _distances(_evaluated(spark, sf))


@query(f"SELECT count(*) AS file_count, round(coalesce(avg(levenshtein(p, g) / greatest(1, length(g))), 0), 6) AS mean_normalized_edit_distance FROM ({_PAIRS})")
def eval_summary(spark, sf):
    return _summed(_evaluated(spark, sf))


@query("""SELECT key, max_by(gt, rn * 10 + n) AS gt_file FROM (SELECT doc_id AS rn, 'u' || doc_id % 300 || '.md' AS gt, unnest(k) AS key, unnest(range(0, len(k))) AS n FROM (
SELECT doc_id, list_concat(['u' || doc_id % 300, 'u' || doc_id % 300 || '.md'], CASE WHEN doc_id % 4 = 0 THEN CAST([] AS VARCHAR[]) ELSE list_transform(['', '.md', '.jpg', '.png'], lambda s: 'a' || doc_id % 450 || s) END) AS k FROM documents WHERE doc_id % 6 <> 5)) GROUP BY key""")
def mapping_expand(spark, sf):
    k = F.col("doc_id")
    uuid = F.when(k % 6 == 5, " ").otherwise(F.concat(F.lit(" u"), (k % 300).cast("string")))
    return evaluate.mapping_keys(_t(spark, sf, "documents").select(k.alias("row_no"), uuid.alias("uuid"), F.when(k % 4 == 0, F.lit(None)).otherwise(F.concat(F.lit("a"), (k % 450).cast("string"))).alias("afts_id")))


@query("""SELECT 'u' || doc_id AS uuid, CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'a, "' || doc_id || '"' END AS afts_id FROM documents WHERE doc_id % 6 <> 5""")
def mapping_file(spark, sf):
    """A mapping written with blanks around its fields and read back; rows without a uuid are skipped."""
    import uuid

    from .sources import readers, sinks

    path, k = f"{sinks.shared_dir(spark)}/mapping-{uuid.uuid4().hex}", F.col("doc_id")
    rows = _t(spark, sf, "documents").select(F.when(k % 6 == 5, "  ").otherwise(F.concat(F.lit(" u"), k, F.lit(" "))).alias(" uuid"), F.when(k % 4 == 0, F.lit(None)).otherwise(F.concat(F.lit('\ta, "'), k, F.lit('" '))).alias("afts_id"))
    rows.write.options(header=True, escape='"', quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return readers.read_mapping(spark, path).select("uuid", "afts_id")


@query("""SELECT '| source | n | n_chars |' AS line UNION ALL SELECT '| --- | --- | --- |'
UNION ALL SELECT '| ' || coalesce(source, '') || ' | ' || count(*) || ' | ' || format('{:,.2f}', CAST(sum(n_chars) AS DOUBLE)) || ' |' FROM documents GROUP BY source""")
def statistics_report(spark, sf):
    by = _t(spark, sf, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").cast("double").alias("n_chars"))
    return profile.pipe_table(by, by.columns).select("line")


@query("""SELECT doc_id, CASE WHEN m.doc_id IS NULL THEN 'missing' ELSE 'matched' END AS outcome FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) m USING (doc_id)""")
def eval_pairing(spark, sf):
    docs = _t(spark, sf, "documents").select("doc_id", F.concat("doc_id", F.lit(".md")).alias("file_name"), F.lit("x").alias("markdown"))
    gold = _t(spark, sf, "labels").select("doc_id").distinct().select(F.concat("doc_id", F.lit(".md")).alias("file_name"), F.lit("x").alias("markdown"))
    matched, missing = evaluate.pair(docs, gold)
    lost = missing.select(F.regexp_extract("file_name", r"(\d+)", 1).cast("long").alias("doc_id"), F.lit("missing").alias("outcome"))
    return matched.select("doc_id", F.lit("matched").alias("outcome")).unionByName(lost)


@query("SELECT doc_id, CAST(len(list_filter(list_transform(string_split(l, ','), lambda x: trim(x)), lambda x: x <> '')) AS INT) AS n FROM (SELECT doc_id, ' a, ,b' || repeat(',c', CAST(doc_id % 4 AS INT)) AS l FROM documents)")
def user_list(spark, sf):
    raw = F.concat(F.lit(" a, ,b"), F.repeat(F.lit(",c"), (F.col("doc_id") % 4).cast("int")))
    return _t(spark, sf, "documents").select("doc_id", F.size(text.list_of(raw)).alias("n"))


@query("SELECT doc_id, 'page.' || doc_id AS stem FROM documents")
def path_stem(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", text.stem(F.concat(F.lit("dir.x/page."), F.col("doc_id").cast("string"), F.lit(".png"))).alias("stem"))


@query("SELECT doc_id AS file_name, text AS ground_truth FROM documents")
def csv_publish(spark, sf):
    import uuid

    from .sources import readers, sinks

    path = f"{sinks.shared_dir(spark)}/published-{uuid.uuid4().hex}"
    files = _t(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("file_name"), F.col("text").alias("ground_truth"))
    sinks.write_csv(files, path, single=False)
    return readers.read_submission(spark, path).select(F.col("file_name").cast("long").alias("file_name"), F.coalesce("ground_truth", F.lit("")).alias("ground_truth"))
