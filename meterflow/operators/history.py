"""Row-ordered work over histories of any length.

A window partitioned by zone alone puts a zone's whole past into one task. The functions
here cut each history into chunks of time first and keep every result exactly as it would
be over the uncut history. Inputs hold at most one row per key and time bucket, so a chunk
has a known largest size. What still meets per key is a few rows of each chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from meterflow.config import GridConfig

_CHUNK, _VISITS = "_chunk", "_visits"


def _chunk_of(order: str, seconds: int) -> Column:
    return F.window(order, f"{seconds} seconds").getField("start")


def number_rows(df: DataFrame, keys: Sequence[str], order: str, chunk_s: int, name: str) -> DataFrame:
    """Number each key's rows from 0 in time order, without sorting a whole key in one task.

    Chunk sizes are summed up to give each chunk its first number. That number joins its
    chunk as a marker row in front of it, and the rows are counted on from there. Only
    the sizes, one row per key and chunk, meet in one place; null keys stay a group.
    """
    chunked = df.withColumn(_CHUNK, _chunk_of(order, chunk_s))
    # Counts every row. Reading all columns for it keeps this branch's plan equal to the
    # other's, so Spark computes `df` up to its last shuffle once and reuses that.
    every_row = F.count_if(F.hash(*df.columns) >= -(2**31))
    sizes = chunked.groupBy(*keys, _CHUNK).agg(every_row.alias("_size"))
    before = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    markers = sizes.select(*keys, _CHUNK, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*keys, _CHUNK).orderBy(F.col(order).asc_nulls_first())
    return (
        chunked.unionByName(markers, allowMissingColumns=True)
        .withColumn(name, F.first("_start").over(inside) + F.row_number().over(inside) - 2)
        .filter(F.col(order).isNotNull())
        .drop("_start", _CHUNK)
    )


def over_history(
    df: DataFrame,
    columns: Callable[[WindowSpec], dict[str, Column]],
    cfg: GridConfig,
    *,
    keys: Sequence[str] = ("zip_code",),
    order: str = "window_start",
    back: int = 0,
    ahead: int = 0,
    bounded: bool = False,
) -> DataFrame:
    """Add window columns that look at most `back` rows back and `ahead` rows ahead.

    `columns` gets the window (partition and order set) and returns the columns to add.
    Each chunk of a history is visited by the `back` rows before it and the `ahead` rows
    after it, wherever they lie; the visitors are dropped afterwards. `bounded=True` is
    for input whose rows per key are limited already, by a look-back filter or a row
    limit; it is not cut.
    """
    if bounded:
        return df.withColumns(columns(Window.partitionBy(*keys).orderBy(order)))

    chunked = df.withColumn(_CHUNK, _chunk_of(order, cfg.history_chunk_s)).withColumn(_VISITS, F.lit(False))
    gathered = chunked
    if back:
        gathered = gathered.unionByName(_visitors(chunked, keys, order, back, to_later=True))
    if ahead:
        gathered = gathered.unionByName(_visitors(chunked, keys, order, ahead, to_later=False))
    window = Window.partitionBy(*keys, _CHUNK).orderBy(order)
    return gathered.withColumns(columns(window)).filter(~F.col(_VISITS)).drop(_CHUNK, _VISITS)


def _visitors(chunked: DataFrame, keys: Sequence[str], order: str, reach: int, to_later: bool) -> DataFrame:
    """The `reach` rows at the edge of each chunk, once per neighbouring chunk whose frames reach them.

    A chunk with fewer rows gives all of them, so the edge rows of a key in time order have
    no gap next to a chunk border: the chunks met within `reach` edge rows are the hosts.
    The rank limit also applies before the shuffle, so only edge rows move.
    """
    forward, backward = F.col(order).asc(), F.col(order).desc()
    from_border = Window.partitionBy(*keys, _CHUNK).orderBy(backward if to_later else forward)
    edge_rows = chunked.withColumn("_rank", F.row_number().over(from_border)).filter(F.col("_rank") <= reach)
    beyond = Window.partitionBy(*keys).orderBy(forward if to_later else backward).rowsBetween(1, reach)
    hosts = F.array_except(F.collect_set(_CHUNK).over(beyond), F.array(_CHUNK))
    visits = edge_rows.drop("_rank").withColumn("_hosts", hosts)
    return visits.withColumn(_CHUNK, F.explode("_hosts")).withColumn(_VISITS, F.lit(True)).drop("_hosts")


def next_known(df: DataFrame, keys: Sequence[str], order: str, value: str, name: str, chunk_s: int) -> DataFrame:
    """Per row the first non-null `value` at or after it: a forward as-of lookup.

    Each chunk learns the first value of the next chunk that has one from a marker row
    behind its last row, so one window per chunk finds the answer. The windows run
    backward in time: their frames only grow, and each row is added to them once.
    """
    chunked = df.withColumn(_CHUNK, _chunk_of(order, chunk_s))
    firsts = chunked.groupBy(*keys, _CHUNK).agg(
        F.min_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias("_first")  # a number hashes, a struct sorts
    )
    later = Window.partitionBy(*keys).orderBy(F.col(_CHUNK).desc()).rowsBetween(Window.unboundedPreceding, -1)
    markers = firsts.select(*keys, _CHUNK, F.last("_first", ignorenulls=True).over(later).alias(value))
    inside = (
        Window.partitionBy(*keys, _CHUNK)
        .orderBy(F.col(order).desc_nulls_first())
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        chunked.unionByName(markers, allowMissingColumns=True)
        .withColumn(name, F.last(value, ignorenulls=True).over(inside))
        .filter(F.col(order).isNotNull())
        .drop(_CHUNK)
    )
