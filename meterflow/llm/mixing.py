"""Mixing sources to target weights along a time-varying curriculum. DataFrame functions only.

Each source's documents form a stream in a fixed pseudo-random order, run through up to
`MAX_PASSES` times and ended at the document end nearest to the source's target. Every source has a weight
schedule over training time; its integral is the demand for the source's words up to a
time, so inverting the integral at a document's place in the stream gives the time at
which that document is due. Sorting by that time is the mixture.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.llm.common import fresh, stored, word_count

#: Prefix sums run over this many hash ranges of a source, then inside one range.
RANGES = 1024
MAX_PASSES = 2


@dataclass(frozen=True)
class Mix:
    """Weights by a source's place in code point order (repeating), each with its schedule.

    A schedule is the source's relative weight at the start and at the end of training,
    linear in between: the heavy sources fade out and the light ones fade in.
    """

    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    schedules: tuple[tuple[float, float], ...] = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
    share: float = 1.5
    cap: float = float(MAX_PASSES)


def _pick(values: tuple[float, ...], place: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (place % len(values) + 1).cast("int"))


def source_targets(sources: DataFrame, mix: Mix) -> DataFrame:
    """Targets of the sources (one row each, with `source` and `source_size`).

    A target is `least(cap, level * weight)`. Sources reach their caps in the order of
    cap / weight, so the level is found at the first source in that order that the rest of
    the demand, shared by the remaining weights, does not fill. Further on the shares only
    fall, so it is the largest share that fits.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_fill = Window.orderBy("fill", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        sources.withColumn("place", (F.row_number().over(by_name) - 1))
        .withColumn("weight", _pick(mix.weights, F.col("place")))
        .withColumn("cap", F.col("source_size") * F.lit(mix.cap))
        .withColumn("fill", F.col("cap") / F.col("weight"))
    )
    demand = F.sum("source_size").over(everything) * F.lit(mix.share)
    left = demand - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weights_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    levels = ranked.withColumn("level_here", left / weights_left)
    level = F.max(F.when(F.col("level_here") <= F.col("fill"), F.col("level_here"))).over(everything)
    return levels.select(
        "source",
        "source_size",
        "place",
        F.least(F.col("cap"), F.coalesce(level, F.lit(float("inf"))) * F.col("weight")).alias("target"),
    )


def _in_order(slim: DataFrame) -> DataFrame:
    """Add `before`, the words of a source's stream ahead of each document.

    A source may hold a third of all rows, so its running sum is not left to one task: it
    is taken over the sums of its hash ranges, then inside each range.
    """
    sums = slim.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    ahead = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col("source").alias("s"),
        F.col("range").alias("r"),
        F.coalesce(F.sum("range_size").over(ahead), F.lit(0)).alias("range_start"),
    )
    inside = (
        Window.partitionBy("source", "range").orderBy("shuffled", "doc_id", "digest")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    here = slim.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r"))
    return here.join(starts, same).withColumn("before", F.col("range_start") + F.col("inside")).drop("s", "r")


def _due(fraction: Column, begin: Column, end: Column) -> Column:
    """Time at which the integral of a linear weight from `begin` to `end` reaches a fraction of its whole."""
    area = fraction * (begin + end) / 2.0
    return 2.0 * area / (begin + F.sqrt(begin * begin + 2.0 * (end - begin) * area))


def _digest(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def _identity(digest: Column) -> Column:
    """128 bits that stand for a document's id, source and text."""
    return F.md5(F.to_json(F.struct("doc_id", "source", digest.alias("digest"))).cast("binary"))


def mix_plan(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """One row per document with its size, its source's size and target, and the words taken in each pass.

    `taken_1`, `taken_2` are the words of the first and second pass, `due_1`, `due_2` the
    training times in [0, 1]; a pass that takes nothing is due never (null). Documents are
    taken whole: the one in which a source's target lies is taken if at least half of it is
    ahead of the target, so a source's taken words miss its target by half a document at most.

    Null texts have size 0 and are not taken; null sources form one source, ordered last;
    a null id sorts before others with the same hash; equal rows are taken one after the
    other; an empty table gives an empty plan; other columns are ignored.
    """
    shuffled = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    slim = stored(
        docs.select(
            "doc_id",
            "source",
            word_count(F.col("text")).alias("size"),
            shuffled.alias("shuffled"),
            _digest(F.col("text")).alias("digest"),
        ).withColumn("range", (F.conv(F.substring("shuffled", 1, 8), 16, 10).cast("long") * RANGES / (1 << 32)).cast("int")),
        "mix",
    )
    totals = source_targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), mix)
    totals = totals.withColumnRenamed("source", "of")
    placed = _in_order(slim).join(totals, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    budget = F.round("target").cast("long")
    begin = _pick(tuple(b for b, _ in mix.schedules), F.col("place"))
    end = _pick(tuple(e for _, e in mix.schedules), F.col("place"))
    for number in range(1, MAX_PASSES + 1):
        start = F.col("before") + F.col("source_size") * (number - 1)
        taken = F.when((budget - start) * 2 >= F.col("size"), F.col("size")).otherwise(F.lit(0))
        due = _due(start / F.nullif(F.col("target"), F.lit(0.0)), begin, end)
        placed = placed.withColumn(f"taken_{number}", taken)
        placed = placed.withColumn(f"due_{number}", F.when(F.col(f"taken_{number}") > 0, due))
    taken = sum((F.col(f"taken_{n}") for n in range(2, MAX_PASSES + 1)), F.col("taken_1"))
    return placed.withColumn("taken", taken).select(
        "doc_id", "source", "digest", "size", "source_size", "target", "taken",
        *[f"{what}_{n}" for n in range(1, MAX_PASSES + 1) for what in ("taken", "due")],
    )


def mixed_documents(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mixture itself: a row for each time that a document is due, in training order.

    Documents left out disappear, others appear once or twice, whole and unchanged. Rows
    that agree in id, source and text are one document here, due as often as all of them
    together.
    """
    key, due = fresh(docs, "_mix_key", "_mix_due")
    passes = [F.struct(F.col(f"taken_{n}").alias("words"), F.col(f"due_{n}").alias("due")) for n in range(1, MAX_PASSES + 1)]
    slots = (
        mix_plan(docs, mix)
        .filter(F.col("taken") > 0)
        .select(_identity(F.col("digest")).alias(key), F.explode(F.array(*passes)).alias("slot"))
        .filter(F.col("slot.words") > 0)
        .select(key, F.col("slot.due").alias(due))
    )
    once = docs.withColumn(key, _identity(_digest(F.col("text")))).dropDuplicates([key])
    ordered = once.join(slots, key).repartitionByRange(F.col(due), F.col("doc_id")).sortWithinPartitions(due, "doc_id")
    return ordered.select(*[F.col(f"`{name}`") for name in docs.columns])


SQL = r"""
WITH slim AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
           md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS shuffled, md5(coalesce(text, '')) AS digest
    FROM documents),
ranked AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3
                WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
           1.5::DOUBLE - 0.5::DOUBLE * ((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3) AS schedule_begin,
           0.5::DOUBLE + 0.5::DOUBLE * ((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3) AS schedule_end
    FROM slim GROUP BY source),
levels AS (
    SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2.0::DOUBLE * source_size) OVER ahead, 0))
              / (sum(weight) OVER () - coalesce(sum(weight) OVER ahead, 0)) AS level_here
    FROM ranked
    WINDOW ahead AS (ORDER BY 2.0::DOUBLE * source_size / weight, encode(source) NULLS LAST
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
    SELECT source, source_size, schedule_begin, schedule_end,
           least(2.0::DOUBLE * source_size,
                 weight * (SELECT max(level_here) FROM levels WHERE level_here <= 2.0::DOUBLE * source_size / weight)) AS target
    FROM levels),
streams AS (
    SELECT s.doc_id, s.size, t.source_size, t.target, round(t.target)::BIGINT AS budget, t.schedule_begin, t.schedule_end,
           coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.shuffled, s.doc_id NULLS FIRST, s.digest
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
    FROM slim s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
areas AS (
    SELECT *,
           before::DOUBLE / nullif(target, 0) * (schedule_begin + schedule_end) / 2.0::DOUBLE AS area_1,
           (before + source_size)::DOUBLE / nullif(target, 0) * (schedule_begin + schedule_end) / 2.0::DOUBLE AS area_2,
           CASE WHEN 2 * (budget - before) >= size THEN size ELSE 0 END AS taken_1,
           CASE WHEN 2 * (budget - before - source_size) >= size THEN size ELSE 0 END AS taken_2
    FROM streams)
SELECT doc_id, size, source_size, round(target, 6) AS target, (taken_1 + taken_2)::BIGINT AS taken,
       CASE WHEN taken_1 > 0 THEN round(2.0::DOUBLE * area_1 / (schedule_begin + sqrt(
            schedule_begin * schedule_begin + 2.0::DOUBLE * (schedule_end - schedule_begin) * area_1)), 6) END AS due_1,
       CASE WHEN taken_2 > 0 THEN round(2.0::DOUBLE * area_2 / (schedule_begin + sqrt(
            schedule_begin * schedule_begin + 2.0::DOUBLE * (schedule_end - schedule_begin) * area_2)), 6) END AS due_2
FROM areas
"""
