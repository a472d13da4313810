"""HTML expressions: forbidden pages, unbalanced tags, table statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bind, occurrences, strip

#: Any of these marks a page that a busy service sent instead of a result.
BUSY_MARKS = ("服务器繁忙", "顾客太多", "j_retry_link", "showtextwait", "支付宝版权所有")
BUSY_HOST = "alipayobjects.com"
TABLE_TAGS = ("table", "tr", "td", "th")


def _busy(low: Column) -> Column:
    marked = reduce(lambda a, b: a | b, (F.contains(low, F.lit(m)) for m in BUSY_MARKS))
    return marked | F.contains(low, F.lit(BUSY_HOST)) & F.contains(low, F.lit("<html"))


def _full(low: Column) -> Column:
    begins = low.startswith("<!doctype html") | low.startswith("<html")
    return begins & F.contains(low, F.lit("<head")) & F.contains(low, F.lit("<body"))


def _broken(low: Column) -> Column:
    more = reduce(lambda a, b: a | b, (occurrences(low, f"<{t}") > occurrences(low, f"</{t}") for t in TABLE_TAGS))
    return F.contains(low, F.lit("<t")) & more  # all of them begin so


def is_busy_page(s: Column) -> Column:
    return _busy(F.lower(strip(s)))


def is_full_page(s: Column) -> Column:
    return _full(F.lower(strip(s)))


def is_broken(s: Column) -> Column:
    """A table tag's openings outnumber its closings (by prefix: <th also counts <thead)."""
    return _broken(F.lower(s))


def faults(s: Column) -> Column:
    """(chars, busy, full, broken) of a text, stripped and folded once."""
    folded = lambda t: bind(F.lower(t), lambda low: F.struct(F.length(t).alias("chars"), _busy(low).alias("busy"), _full(low).alias("full"), _broken(low).alias("broken")))
    return bind(strip(s), folded)


def missing_closings(s: Column) -> Column:
    """Openings (whole tag names) without an exact closing tag, over the table tags."""
    low = F.lower(s)
    return reduce(lambda a, b: a + b, (F.greatest(F.lit(0), F.regexp_count(low, F.lit(rf"<{t}\b")) - occurrences(low, f"</{t}>")) for t in TABLE_TAGS)).cast("int")


def table_stats(s: Column) -> dict[str, Column]:
    count = lambda pattern: F.regexp_count(s, F.lit(pattern)).cast("int")
    return {"tr": count(r"(?i)<tr\b"), "td": count(r"(?i)<td\b"), "empty_td": count(r"(?i)<td\b[^>]*>\s*</td>")}
