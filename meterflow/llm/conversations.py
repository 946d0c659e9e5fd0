"""Faults of conversations and their cheapest repair.

Spark marks blank, truncated and repeated rows, deals conversations out and sorts each by
turn; a task then lets its rows stream by. One conversation needs one task, since a digest
of its repaired text has to see it in order, but that task holds its open edits only.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.llm import coalescing_viterbi as viterbi
from meterflow.llm.common import BATCH_ROWS

#: ASCII white space, and marks that end a sentence.
SPACE = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
#: Initials of roles that may follow each other.
LEGAL = ("su", "ua", "au")
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def damaged(rows: DataFrame) -> DataFrame:
    """Break rows by the checksum of `conv_id:turn`, the same ones on every run. Nulls in role and text become a space.

    Of 20 remainders 0 drops the row, 1 empties its text, 2 removes the marks that end
    sentences, 3 repeats the row, 4 makes its role user.
    """
    part = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return (
        rows.select("conv_id", "turn", part("role").alias("role"), part("text").alias("text"), kind.alias("kind"))
        .filter(F.col("kind") != 0)
        .select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), "kind")
        .withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .drop("kind", "copy")
    )


def _marked(rows: DataFrame) -> DataFrame:
    """With `fault` (blank, truncated, or empty) and `later`: role and text occur in an earlier turn too.

    First occurrences are found by an aggregate over digests and joined back, so that neither
    a long conversation nor a text repeated very often gathers in one task.
    """
    trimmed = F.rtrim("text", F.lit(SPACE))
    fault = F.when(trimmed == "", "blank").when(~F.substring(trimmed, -1, 1).isin(*ENDS), "truncated").otherwise("")
    digest = F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text").cast("binary"))
    slim = rows.select("conv_id", "turn", "role", "text", fault.alias("fault"), digest.alias("digest"))
    place: Column = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    first = slim.groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d")).agg(F.min(place).alias("first"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d"))
    return slim.join(first, same).select("conv_id", "turn", "role", "text", "fault", (place != F.col("first")).alias("later"))


def _in_order(rows: DataFrame) -> DataFrame:
    full = rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(name, F.lit(" ")).alias(name) for name in ("role", "text")],
    )
    order = ("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    return _marked(full).repartition("conv_id").sortWithinPartitions(*order)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


class _Counts:
    """What is counted while a conversation's rows come by in order."""

    def __init__(self):
        self.first = self.last = self.before = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def row(self, turn: int | None, role: str, text: str, fault: str, later: bool) -> str:
        """Count a row; returns its first fault."""
        if turn is not None and turn != self.last:
            self.turns += 1
            self.first = turn if self.first is None else self.first
            self.last = turn
        if fault != "blank" and (later or self.before == (turn, role, text)):
            fault = "duplicate"
        if fault:
            setattr(self, fault, getattr(self, fault) + 1)
        if self.before is not None and self.before[1][:1] + role[:1] not in LEGAL:
            self.illegal += 1
        self.before = (turn, role, text)
        return fault

    @property
    def gaps(self) -> int:
        return self.last - self.first + 1 - self.turns if self.turns else 0


def _repaired(batches: Iterator[pa.RecordBatch], begin, end) -> Iterator[tuple]:
    """Run every conversation's search; `begin` makes its sink, `end` tells what to return of it."""
    open_, counts, repair, sink = False, None, None, None
    current = None
    for conv_id, turn, role, text, fault, later in _rows(batches):
        if not open_ or conv_id != current:
            if open_:
                repair.finish()
                yield from end(current, counts, repair, sink)
            open_, current, counts, sink = True, conv_id, _Counts(), begin()
            repair = viterbi.Repair(sink)
        fault = counts.row(turn, role, text, fault, later)
        repair.row(role, text, fault in ("blank", "duplicate"), fault == "truncated")
        yield from end(current, None, None, sink)
    if open_:
        repair.finish()
        yield from end(current, counts, repair, sink)


class _Digest:
    """Keeps letters and a running digest of the repaired rows."""

    def __init__(self):
        self.letters, self.hash, self.empty = bytearray(), sha256(), True

    def __call__(self, letter: str, role: str | None, text: str | None) -> None:
        self.letters += letter.encode()
        if role is not None:
            self.hash.update(b"" if self.empty else b"\n")
            self.hash.update(f"{role}:{text}".encode())
            self.empty = False


class _Rows(list):
    """Keeps repaired rows until they are passed on."""

    place = 0

    def __call__(self, letter: str, role: str | None, text: str | None) -> None:
        if role is not None:
            self.append((self.place, role, text, letter))
            self.place += 1


def _batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == int(BATCH_ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def conversation_repairs(rows: DataFrame) -> DataFrame:
    """One row per conversation: its faults, the cheapest edits (`audit`, `cost`) and a digest of what they leave.

    `rows` has `conv_id`, `turn`, `role`, `text`. Rows come by turn, nulls first, those of one
    turn by role and text. Null roles and texts are read as a space; rows of a null id are
    one conversation. Of equally cheap repairs that with the least letters wins. A row that
    repeats role and text is a duplicate wherever it stands. An empty table gives no rows;
    other columns are ignored.
    """

    def end(conv_id, counts, repair, sink):
        if repair is not None:
            found = (counts.gaps, counts.blank, counts.duplicate, counts.truncated, counts.illegal, repair.cost)
            yield conv_id, *found, sink.letters.decode(), sink.hash.hexdigest()

    def task(batches):
        yield from _batched(_repaired(batches, _Digest, end), schema)

    ordered = _in_order(rows)
    kind = ordered.schema["conv_id"].dataType
    names = [*COUNTS, "audit", "repaired_sha256"]
    types = [*["long"] * len(COUNTS), "string", "string"]
    arrow = {"long": pa.int64(), "string": pa.string()}
    schema = pa.schema([("conv_id", _arrow_type(kind)), *[(n, arrow[t]) for n, t in zip(names, types)]])
    return ordered.mapInArrow(task, f"conv_id {kind.simpleString()}, " + ", ".join(map(" ".join, zip(names, types))))


def repaired_conversations(rows: DataFrame) -> DataFrame:
    """The repaired rows themselves: `conv_id`, `place` (from 0), `role`, `text` and the `edit` (K, R or I) behind each.

    Rows and ties as in `conversation_repairs`; a conversation whose rows are all deleted has none.
    """

    def end(conv_id, counts, repair, sink):
        for row in sink:
            yield conv_id, *row
        sink.clear()

    def task(batches):
        yield from _batched(_repaired(batches, _Rows, end), schema)

    ordered = _in_order(rows)
    kind = ordered.schema["conv_id"].dataType
    schema = pa.schema(
        [("conv_id", _arrow_type(kind)), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())]
    )
    return ordered.mapInArrow(task, f"conv_id {kind.simpleString()}, place long, role string, text string, edit string")


def _arrow_type(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def with_every_conversation(repairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The repairs, with a row of zeros for each conversation of `rows` that has none."""
    ids = rows.select(F.col("conv_id").alias("id")).distinct()
    joined = ids.join(repairs, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    return joined.select(
        F.col("id").alias("conv_id"),
        *[F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(sha256().hexdigest())).alias("repaired_sha256"),
    )


def _sql_way(state: str, price: str, letter: str, line: str = "''") -> str:
    return f"{{'cost': {state}.cost + {price}, 'audit': {state}.audit || '{letter}', 'text': {state}.text || {line}}}"


def _sql_row(state: str, to: str) -> str:
    """The way that adds the row itself, or one out of reach."""
    role = {"u": "user", "a": "assistant", "s": None}[to]
    kept = _sql_way(state, "extra", "K", "chr(10) || role || ':' || content")
    moved = _sql_way(state, "extra + 1", "R", f"chr(10) || '{role}:' || content") if role else "far"
    return f"CASE WHEN must_go THEN far WHEN initial = '{to}' THEN {kept} ELSE {moved} END"


def _sql_insert(state: str, role: str) -> str:
    return _sql_way(state, "5", "I", f"chr(10) || '{role}:'")


def _sql_least(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


SQL = rf"""
WITH RECURSIVE keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                          lambda x: ascii(x)::BIGINT) AS bytes
    FROM conversations),
kinds AS (
    SELECT conv_id, turn, role, text,
           xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, b: list_reduce(
               list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
               lambda x, y: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT) % 20 AS kind
    FROM keyed),
damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM kinds WHERE kind <> 0
    UNION ALL SELECT conv_id, turn, role, text FROM kinds WHERE kind = 3),
trimmed AS (
    SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS occurrence
    FROM damaged),
lines AS (
    SELECT conv_id, turn, role, text AS content, substr(role, 1, 1) AS initial,
           CASE WHEN trimmed = '' THEN 'blank' WHEN occurrence > 1 THEN 'duplicate'
                WHEN right(trimmed, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
           row_number() OVER in_order AS n, lag(substr(role, 1, 1)) OVER in_order AS initial_before
    FROM trimmed
    WINDOW in_order AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, occurrence)),
priced AS (
    SELECT *, fault IN ('blank', 'duplicate') AS must_go, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS extra FROM lines),
counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
           count_if(fault = 'blank')::BIGINT AS blank, count_if(fault = 'duplicate')::BIGINT AS duplicate,
           count_if(fault = 'truncated')::BIGINT AS truncated,
           count_if(initial_before || initial NOT IN ('su', 'ua', 'au'))::BIGINT AS illegal, max(n) AS n
    FROM priced GROUP BY conv_id),
ways AS (
    SELECT conv_id, 0::BIGINT AS n, {{'cost': 0, 'audit': '', 'text': ''}} AS s0, {{'cost': 1000000, 'audit': '', 'text': ''}} AS s1,
           {{'cost': 5, 'audit': 'I', 'text': chr(10) || 'user:'}} AS s2,
           {{'cost': 10, 'audit': 'II', 'text': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS s3
    FROM counted
    UNION ALL
    SELECT conv_id, n, s0, s1, c2 AS s2, {_sql_least("n3", _sql_insert("c2", "assistant"))} AS s3
    FROM (
        SELECT *, {_sql_least("n2", *[_sql_insert(s, "user") for s in ("s0", "s1", "n3")])} AS c2
        FROM (
            SELECT conv_id, n, {_sql_way("s0", "2", "D")} AS s0,
                   {_sql_least(_sql_way("s1", "2", "D"), _sql_row("s0", "s"))} AS s1,
                   {_sql_least(_sql_way("s2", "2", "D"), *[_sql_row(s, "u") for s in ("s0", "s1", "s3")])} AS n2,
                   {_sql_least(_sql_way("s3", "2", "D"), _sql_row("s2", "a"))} AS n3
            FROM (
                SELECT p.conv_id, p.n, p.role, p.content, p.initial, p.must_go, p.extra, w.s0, w.s1, w.s2, w.s3,
                       {{'cost': 2000000, 'audit': '', 'text': ''}} AS far
                FROM ways w JOIN priced p ON p.conv_id IS NOT DISTINCT FROM w.conv_id AND p.n = w.n + 1)))),
best AS (
    SELECT c.*, list_min([w.s0, w.s3]) AS way
    FROM counted c JOIN ways w ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.n = c.n)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(way.cost, 0)::BIGINT AS cost,
       coalesce(way.audit, '') AS audit, sha256(coalesce(substr(way.text, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN best b ON a.conv_id IS NOT DISTINCT FROM b.conv_id
"""
