"""Conversation structure repair: the cheapest edits that give a conversation a legal order of roles.

Legal orders form a small automaton: nothing, or one or no ``s`` followed by pairs ``u a``.  Edits weigh its arcs:
a row is kept, given the role that is due, or deleted; a row may be put in anywhere.  The weighted automaton is
nondeterministic, and is determinised lazily: scanning a conversation from its last row, what counts is the
vector of costs from each of its four states to the end, less their minimum, which is handed on as a weight.
Such normalised vectors are the states of the deterministic automaton; few occur, so they are numbered as they
turn up and transitions are kept in a table by (state, symbol), a row's symbol being its role initial and fault.

1. Scan: one look in the table per row, from last to first, gives the cost of the conversation, and each row
   the vector behind it.
2. Trace: back along the scan, so from first row to last, an edit whose cost is exactly the difference of the two
   vectors (a tight arc) belongs to a cheapest repair; of tight edits the one with the least letter is taken,
   and since different edits have different letters this is the ASCII-least audit.

Scale: damage and faults are expressions; copies are told by (conversation, role, text digest) sums, which
combine before the shuffle.  Then each conversation's rows are sorted in one partition and streamed twice.  A
conversation that holds a third of all rows is a long stream and never held: a row knows the vector behind it, and
of a conversation only the running hash and the audit stay.  That hash runs over all its rows in their order, so no
form of it can be split over tasks; what can be (texts, patterns, digests, copies) is.

Defined results: rows are taken by turn, nulls first, equal turns by role and text; in the rows null is one space,
in the damage rule's ``conv_id:turn`` too; null conversations are one conversation; rows equal in turn, role and text are
copies, of which one is the first; a role without letters has no initial, so no pair with it is legal; a text of
any length counts whole; further columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import table, written

#: Fixed by the contract: costs of edits, and what a truncated row adds unless it is deleted.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Faults in the order in which they count.
CLEAN, BLANK, DUPLICATE, CUT = range(4)
_ROLES = ("", "s", "u", "a")
_NAMES = {2: "user", 3: "assistant"}
#: States: nothing yet, after s, after u, after a. The state that a user or assistant row leads to, which is also the one that is due.
_DUE = (2, 2, 3, 2)
_NEVER = 1 << 20
_SPACES = " \t\n\x0b\x0c\r"


def _after(state: int, role: int) -> int | None:
    """The state behind a kept row of a role, if it is legal there."""
    return role if role and (role == _DUE[state] or role == 1 and state == 0) else None


class Repairs:
    """The lazily determinised automaton: vectors of costs to the end, numbered as they turn up, and the table of transitions."""

    def __init__(self) -> None:
        self.vectors: list[tuple[int, ...]] = []
        self.numbers: dict[tuple[int, ...], int] = {}
        self.table: dict[tuple[int, int], tuple[int, int]] = {}
        #: At the end: an empty or complete order costs nothing.
        self.end, self.end_weight = self._number([0, _NEVER, _NEVER, 0])

    def _number(self, costs: list[int]) -> tuple[int, int]:
        for _ in range(2):  # rows put in here: after u is one away from after a, all others from after u
            for q in (2, 3, 0, 1):
                costs[q] = min(costs[q], INSERT + costs[_DUE[q]])
        least = min(costs)
        vector = tuple(c - least for c in costs)
        if vector not in self.numbers:
            self.numbers[vector] = len(self.vectors)
            self.vectors.append(vector)
        return self.numbers[vector], least

    @staticmethod
    def edits(state: int, role: int, fault: int) -> list[tuple[str, int, int]]:
        """(letter, cost, state behind) of what may happen to a row, by letter."""
        found = [("D", DELETE, state)]
        if fault in (BLANK, DUPLICATE):
            return found
        extra = TRUNCATED if fault == CUT else 0
        kept = _after(state, role)
        return found + ([("K", extra, kept)] if kept is not None else []) + [("R", REROLE + extra, _DUE[state])]

    def step(self, behind: int, symbol: int) -> tuple[int, int]:
        """(number, weight) of the vector before a row, from the number of the one behind it; symbol: 4 * role + fault."""
        found = self.table.get((behind, symbol))
        if found is None:
            v = self.vectors[behind]
            costs = [min(cost + v[q2] for _, cost, q2 in self.edits(q, *divmod(symbol, 4))) for q in range(4)]
            found = self.table[behind, symbol] = self._number(costs)
        return found

    def tight(self, state: int, vector: tuple[int, ...], symbol: int | None = None, behind: tuple[int, ...] = (), weight: int = 0) -> tuple[str, int]:
        """(letter, state behind) of the least tight edit in front of a row, or at the end (no symbol: only rows put in)."""
        here = vector[state] + weight
        found = [(letter, q) for letter, cost, q in ([] if symbol is None else self.edits(state, *divmod(symbol, 4))) if cost + behind[q] == here]
        if vector[state] == INSERT + vector[_DUE[state]]:
            found.append(("I", _DUE[state]))
        return min(found)


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the contract's damage; nulls of role and text are one space."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))  # noqa: E731
    rows = rows.select("conv_id", F.col("turn").cast("bigint").alias("turn"), blank("role").alias("role"), blank("text").alias("text"), F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")).alias("h"))
    rows = rows.withColumn("h", F.col("h") % 20).where("h <> 0")
    text = F.when(F.col("h") == 1, F.lit("")).when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("h") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = rows.select("conv_id", "turn", F.when(F.col("h") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(times).alias("time"))
    return rows.drop("time")


def faults(rows: DataFrame) -> DataFrame:
    """Adds ``late`` (role and text stand in the conversation at a smaller turn), ``last`` (the text's last character that is not white space)."""
    digest = F.sha2(F.concat_ws(":", F.octet_length("role").cast("string"), F.col("role"), F.col("text")), 256)
    rows = rows.withColumn("same", F.unhex(digest))
    # nulls first: a null turn is the least
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"))
    twice = rows.groupBy("conv_id", "same").agg(F.min(turn).alias("first"), F.max(turn).alias("end")).where("first < end")
    twice = twice.select(F.col("conv_id").alias("c"), F.col("same").alias("s"), F.col("first"))
    met = rows.join(twice, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("same") == F.col("s")), "left")
    last = F.substring(F.rtrim("text", F.lit(_SPACES)), -1, 1)
    return met.select("conv_id", "turn", "role", "text", F.coalesce(turn > F.col("first"), F.lit(False)).alias("late"), last.alias("last"))


def placed(rows: DataFrame) -> DataFrame:
    """A conversation's rows in one partition, with ``nth``, ``symbol`` (role and fault) and ``legal`` (the pair with the row before)."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    copy = F.coalesce((F.lag("turn").over(order).eqNullSafe(F.col("turn"))) & (F.lag("role").over(order) == F.col("role")) & (F.lag("text").over(order) == F.col("text")), F.lit(False))
    nth = F.row_number().over(order)
    copy = copy & (nth > 1)
    initial = F.substring("role", 1, 1)
    fault = F.when(F.col("last") == "", F.lit(BLANK)).when(F.col("late") | copy, F.lit(DUPLICATE)).when(~F.col("last").isin(".", "!", "?"), F.lit(CUT)).otherwise(F.lit(CLEAN))
    role = F.when(initial == "s", F.lit(1)).when(initial == "u", F.lit(2)).when(initial == "a", F.lit(3)).otherwise(F.lit(0))
    legal = (nth == 1) | F.concat(F.substring(F.lag("role").over(order), 1, 1), initial).isin("su", "ua", "au")
    return rows.select("conv_id", "turn", "role", "text", nth.alias("nth"), (4 * role + fault).cast("int").alias("symbol"), legal.alias("legal"))


def _changes(keys: list) -> list[bool]:
    """Where a key differs from the one before it."""
    return [i == 0 or keys[i] != keys[i - 1] for i in range(len(keys))]


def scan(rows: DataFrame) -> DataFrame:
    """Adds ``behind`` (the vector behind each row) and ``cost`` (of the conversation from this row on, from its first state)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Repairs()
        before, state, total = object(), 0, 0
        for batch in batches:
            vectors, costs = [], []
            for key, symbol in zip(batch.column("conv_id").to_pylist(), batch.column("symbol").to_pylist(), strict=True):
                if key != before:
                    before, state, total = key, machine.end, machine.end_weight
                vectors.append(machine.vectors[state])
                state, weight = machine.step(state, symbol)
                total += weight
                costs.append(total + machine.vectors[state][0])
            behind = pa.FixedSizeListArray.from_arrays(pa.array(np.array(vectors, np.int32).ravel()), 4).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, behind, pa.array(costs, pa.int64())], [*batch.schema.names, "behind", "cost"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.sortWithinPartitions("conv_id", F.desc("nth")).mapInArrow(run, f"{kinds}, behind array<int>, cost bigint")


_RESULT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def trace(rows: DataFrame) -> DataFrame:
    """One row per conversation: gaps, faults, cost, audit and the hash of the repaired rows."""
    kind = to_arrow_type(rows.schema["conv_id"].dataType)
    names = ["conv_id", *_RESULT, "audit", "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Repairs()
        end = machine.vectors[machine.end]
        open_, done = None, []

        def close(c: dict) -> tuple:
            while end[c["state"]]:  # only rows put in lead to a legal end
                letter, c["state"] = machine.tight(c["state"], end)
                put(c, letter, _NAMES[c["state"]], "")
            gaps = 0 if c["low"] is None else min(c["high"] - c["low"] + 1 - c["turns"], (1 << 63) - 1)
            return (c["key"], gaps, *c["faults"][1:], c["illegal"], c["cost"], c["audit"].decode(), c["hash"].hexdigest())

        def put(c: dict, letter: str, role: str | None, text: str) -> None:
            c["audit"] += letter.encode()
            if role is not None:
                c["hash"].update((("\n" if c["some"] else "") + role + ":" + text).encode())
                c["some"] = True

        def flush() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True))
            done.clear()
            types = [kind, *[pa.int64()] * len(_RESULT), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for batch in batches:
            for key, turn, role, text, nth, symbol, legal, behind, cost in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if nth == 1:
                    if open_ is not None:
                        done.append(close(open_))
                    open_ = {"key": key, "low": None, "high": None, "turns": 0, "faults": [0] * 4, "illegal": 0, "cost": cost, "audit": bytearray(), "state": 0, "hash": hashlib.sha256(), "some": False}
                c = open_
                if turn is not None:
                    c["turns"] += turn != c["high"]
                    c["low"], c["high"] = turn if c["low"] is None else c["low"], turn
                c["faults"][symbol % 4] += 1
                c["illegal"] += not legal
                now, weight = machine.step(machine._number(list(behind))[0], symbol)
                letter = "I"
                while letter == "I":  # rows put in before this one
                    letter, c["state"] = machine.tight(c["state"], machine.vectors[now], symbol, behind, weight)
                    if letter == "I":
                        put(c, letter, _NAMES[c["state"]], "")
                put(c, letter, None if letter == "D" else _NAMES[c["state"]] if letter == "R" else role, text)
            if len(done) >= 1000:
                yield flush()
        if open_ is not None:
            done.append(close(open_))
        if done:
            yield flush()

    schema = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, " + ", ".join(f"{c} bigint" for c in _RESULT) + ", audit string, repaired_sha256 string"
    return rows.sortWithinPartitions("conv_id", "nth").mapInArrow(run, schema)


def repair(rows: DataFrame) -> DataFrame:
    """Repairs of all conversations of (conv_id, turn, role, text)."""
    return trace(scan(placed(faults(rows))))


def op11(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    found = repair(damaged(rows))
    all_ = rows.select(F.col("conv_id").alias("original")).distinct()
    met = all_.join(found, F.col("original").eqNullSafe(F.col("conv_id")), "left")
    nothing = {**dict.fromkeys(_RESULT, F.lit(0).cast("long")), "audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256(b"").hexdigest())}
    return met.select(F.col("original").alias("conv_id"), *(F.coalesce(c, v).alias(c) for c, v in nothing.items()))


def _oracle() -> str:
    """The same by SQL: the cheapest (cost, audit, text) of each state, row by row; crc32 from its table."""
    put = lambda b, state: f"{{'c': {b}.c + {INSERT}, 'a': {b}.a || 'I', 't': {b}.t || chr(10) || '{_NAMES[state]}:'}}"  # noqa: E731
    drop = lambda b: f"{{'c': {b}.c + {DELETE}, 'a': {b}.a || 'D', 't': {b}.t}}"  # noqa: E731
    keep = lambda b, role: f"{{'c': {b}.c + CASE WHEN r.i = '{role}' THEN r.extra ELSE {_NEVER} END, 'a': {b}.a || 'K', 't': {b}.t || chr(10) || r.role || ':' || r.text}}"  # noqa: E731
    turn = lambda b, state: f"{{'c': {b}.c + r.extra + {REROLE}, 'a': {b}.a || 'R', 't': {b}.t || chr(10) || '{_NAMES[state]}:' || r.text}}"  # noqa: E731
    none = f"{{'c': {_NEVER}, 'a': '', 't': ''}}"
    closed = f"""SELECT conv_id, n, b0, b1, b2, least(b3, {put("b2", 3)}) AS b3
      FROM (SELECT conv_id, n, b0, b1, least(b2, {put("b0", 2)}, {put("b1", 2)}, {put("b3", 2)}) AS b2, b3 FROM (%s) AS moved) AS half"""
    moved = f"""SELECT d.conv_id, d.n + 1 AS n, {drop("b0")} AS b0, least({drop("b1")}, {keep("b0", "s")}) AS b1,
        least({drop("b2")}, {turn("b0", 2)}, {turn("b1", 2)}, {turn("b3", 2)}, {keep("b0", "u")}, {keep("b1", "u")}, {keep("b3", "u")}) AS b2,
        least({drop("b3")}, {turn("b2", 3)}, {keep("b2", "a")}) AS b3
      FROM d JOIN r ON d.conv_id IS NOT DISTINCT FROM r.conv_id AND r.n = d.n + 1"""
    start = f"SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS n, {{'c': 0, 'a': '', 't': ''}} AS b0, {none} AS b1, {none} AS b2, {none} AS b3 FROM conversations"
    return rf"""
WITH RECURSIVE z AS (
  SELECT i, 0 AS k, i AS c FROM range(256) AS x(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM z WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM z WHERE k = 8),
o AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations),
h AS (
  SELECT o.*, xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(1, len(k) + 1), lambda i : CAST(ascii(substr(k, i, 1)) AS BIGINT))),
         lambda a, b : xor(a >> 8, crc.t[1 + (xor(a, b) & 255)]))) % 20 AS h
  FROM o, crc),
d0 AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN h = 3 THEN [1, 2] ELSE [1] END) AS time
  FROM h WHERE h <> 0),
d1 AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n, substr(role, 1, 1) AS i,
         regexp_extract(text, '([^ 	-])[ 	-]*$', 1) AS last
  FROM d0),
d2 AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) AS seen, lag(i) OVER (PARTITION BY conv_id ORDER BY n) || i AS pair FROM d1),
d3 AS (
  SELECT *, CASE WHEN last = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM d2),
r AS (
  SELECT conv_id, n, role, text, i, CASE fault WHEN 'truncated' THEN {TRUNCATED} WHEN '' THEN 0 ELSE {_NEVER} END AS extra FROM d3),
d AS (
  {closed % start}
  UNION ALL
  {closed % moved}),
s AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (n > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal, max(n) AS n
  FROM d3 GROUP BY conv_id),
c AS (
  SELECT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
         coalesce(illegal, 0) AS illegal, least(b0, b3) AS b
  FROM d LEFT JOIN s ON d.conv_id IS NOT DISTINCT FROM s.conv_id WHERE d.n = coalesce(s.n, 0))
SELECT conv_id, CAST(gaps AS BIGINT) AS gaps, CAST(blank AS BIGINT) AS blank, CAST(duplicate AS BIGINT) AS duplicate, CAST(truncated AS BIGINT) AS truncated,
       CAST(illegal AS BIGINT) AS illegal, CAST(b.c AS BIGINT) AS cost, b.a AS audit, sha256(substr(b.t, 2)) AS repaired_sha256
FROM c
"""


ORACLE = _oracle()
