"""Connected components of a link table, by alternating large and small stars.

Every round writes its links into the shared scratch folder: that cuts the lineage, and a
lost executor costs one round at most. Nodes with very many links only meet aggregates
(combined before the shuffle) and joins that adaptive execution may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.session import scratch_path
from meterflow.sources.tables import delete


def components(links: DataFrame) -> DataFrame:
    """`(node, root)` for every node that has a link: root is the smallest node reachable.

    `links` has two columns of one orderable type, in any direction and with repeats; loops
    and links with a null end count for nothing. No links give no rows.
    """
    spark = links.sparkSession
    a, b = links.columns
    root = scratch_path(spark, "components")
    stars = links.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("root")).filter(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))
    )
    before, turn = None, 0
    while True:
        path = f"{root}/{turn}"
        stars.distinct().write.parquet(path)
        written = spark.read.schema(stars.schema).parquet(path)
        now = written.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first()
        if turn > 1:
            delete(spark, f"{root}/{turn - 2}")
        if now == before or now[0] == 0:
            return written
        before, turn = now, turn + 1
        stars = _small_star(_large_star(written))


def _large_star(links: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the smallest of its neighbours and itself."""
    both = links.unionByName(links.select(F.col("root").alias("node"), F.col("node").alias("root")))
    smallest = both.groupBy("node").agg(F.min("root").alias("least")).withColumn("least", F.least("least", "node"))
    return both.join(smallest, "node").filter(F.col("root") > F.col("node")).select(
        F.col("root").alias("node"), F.col("least").alias("root")
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    smallest = links.groupBy("node").agg(F.min("root").alias("least"))
    moved = links.join(smallest, "node").filter(F.col("root") > F.col("least"))
    return moved.select(F.col("root").alias("node"), F.col("least").alias("root")).unionByName(
        smallest.select("node", F.col("least").alias("root"))
    )
