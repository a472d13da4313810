"""Markdown text expressions.  Lengths and positions are code points."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters that count as white space, and those that end a line.
WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0                　"
LINE_END = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x85\\u2028\\u2029]"
#: Lines that hold one of these are service errors.
ERROR_LINES = ("empty response", "api error", "request failed", "server error")
#: Fixed value: the word that marks a table of contents.
TOC_WORD = "目录"
#: Heading marks run into their text. "compat" also splits runs that are already spaced; "fixed" leaves those alone.
HEADING = {"compat": r"(?U)(?s)^(#{1,6})(?!\s)(.+)\z", "fixed": r"(?U)(?s)^(#{1,6})(?![#\s])(.+)\z"}
#: A seam after one of these goes on without a blank line.
OPEN_ENDINGS = "，、：；-/"


def strip(s: Column) -> Column:
    return F.btrim(s, F.lit(WHITE))


def rstrip(s: Column) -> Column:
    return F.rtrim(s, F.lit(WHITE))


def lstrip(s: Column) -> Column:
    return F.ltrim(s, F.lit(WHITE))


def occurrences(s: Column, part: str) -> Column:
    """Non-overlapping occurrences of a literal."""
    return ((F.length(s) - F.length(F.replace(s, F.lit(part), F.lit("")))) / len(part)).cast("int")


def unify_newlines(s: Column) -> Column:
    return F.replace(F.replace(s, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def is_error_line(line: Column) -> Column:
    return F.lower(line).rlike("|".join(ERROR_LINES))


def space_heading(line: Column, mode: str = "fixed") -> Column:
    return F.regexp_replace(line, HEADING[mode], "$1 $2")


def normalize(s: Column, mode: str = "fixed") -> Column:
    """Newlines unified, lines right-stripped, error lines dropped, headings spaced, one newline at the end; empty stays empty."""
    lines = F.transform(F.split(unify_newlines(F.coalesce(s, F.lit(""))), "\n"), rstrip)
    lines = F.transform(F.filter(lines, lambda x: ~is_error_line(x)), lambda x: space_heading(x, mode))
    body = F.regexp_replace(F.array_join(lines, "\n"), "\\n+\\z", "")
    return F.when(body == "", F.lit("")).otherwise(F.concat(body, F.lit("\n")))


def lines_of(s: Column) -> Column:
    """Stripped lines that aren't blank."""
    return F.filter(F.transform(F.split(F.coalesce(s, F.lit("")), LINE_END), strip), lambda x: x != "")


def bind(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with ``value`` evaluated once: a lambda variable stands for it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def duplication_ratio(s: Column) -> Column:
    """Share of the characters in lines that stands in lines which repeat an earlier one: one pass over the row, no shuffle."""
    size = lambda lines: F.length(F.array_join(lines, ""))
    sizes = bind(lines_of(s), lambda lines: F.struct(size(lines).alias("all"), size(F.array_distinct(lines)).alias("once")))
    return bind(sizes, lambda n: F.when(n["all"] > 0, (n["all"] - n["once"]) / n["all"]).otherwise(F.lit(0.0)))


def block_type(s: Column) -> Column:
    return F.when(F.contains(F.lower(s), F.lit("<table")), F.lit("table")).otherwise(F.lit("body"))


def is_toc(s: Column) -> Column:
    """The first line names a table of contents, or three of the first eight are numbered and one of the first three names it."""
    lines = lines_of(s)
    first = strip(F.ltrim(F.get(lines, F.lit(0)), F.lit("# ")))
    head = F.slice(lines, 1, 8)
    numbered = F.filter(head, lambda x: x.rlike(r"^\p{Nd}") & F.left(x, F.lit(8)).rlike("[. ]"))
    listed = (F.size(lines) >= 3) & (F.size(numbered) >= 3) & F.exists(F.slice(lines, 1, 3), lambda x: F.contains(x, F.lit(TOC_WORD)))
    return (F.size(lines) > 0) & (F.coalesce(F.contains(first, F.lit(TOC_WORD)), F.lit(False)) | listed)


def goes_on(s: Column) -> Column:
    """Whether a text ends inside a bracket, a table cell or row, or after a mark that wants more."""
    t = rstrip(s)
    more = lambda a, b: occurrences(t, a) > occurrences(t, b)
    inside = more("（", "）") | more("(", ")") | more("<td", "</td>") | more("<tr", "</tr>")
    return (t != "") & (inside | F.contains(F.lit(OPEN_ENDINGS), F.right(t, F.lit(1))))


def unfence(s: Column) -> Column:
    """The inside of a text that is one fenced Markdown block; other texts stripped."""
    head = rf"(?i)\A```(?:markdown|md)?[{WHITE}]*\n"

    def opened(t: Column) -> Column:
        size = F.length(F.regexp_extract(t, head, 0))
        fenced = (size > 0) & t.endswith("```") & (F.length(t) >= size + 3)
        return F.when(fenced, strip(F.substring(t, size + 1, F.length(t) - size - 3))).otherwise(t)

    return bind(strip(s), opened)


def stem(name: Column) -> Column:
    """A file name without its last suffix; leading dots belong to the name."""
    base = F.regexp_extract(name, r"([^/]*)\z", 1)
    cut = F.regexp_extract(base, r"(?s)\A(.+)\.[^.]*\z", 1)
    return F.when(cut.rlike(r"[^.]") & ~base.endswith("."), cut).otherwise(base)


def list_of(s: Column) -> Column:
    """A comma-separated list: items stripped, blank ones dropped."""
    return F.filter(F.transform(F.split(F.coalesce(s, F.lit("")), ","), strip), lambda x: x != "")
