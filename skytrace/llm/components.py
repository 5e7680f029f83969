"""Connected components of a link table, as Spark jobs.

Every task first joins up the links it holds (union-find over its partition)
and passes on one link a node. Then the large-star and the small-star step
(Kiveris et al., 2014) alternate until the links no longer change. Every step
aggregates with map-side combine and joins rows of two ids, so a node with
very many links is split by the engine's skew handling. Each round is written
to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


LINKS_A_TASK = 200_000


def _joined_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while root.setdefault(top, top) != top:
            top = root[top]
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    for b in batches:
        for x, y in zip(b["a"].tolist(), b["b"].tolist(), strict=True):
            x, y = find(x), find(y)
            if x != y:
                root[max(x, y)] = min(x, y)
    out = [(x, find(x)) for x in list(root)]
    yield pd.DataFrame([p for p in out if p[0] != p[1]], columns=["a", "b"], dtype="int64")


def _local(links: DataFrame) -> DataFrame:
    return links.mapInPandas(_joined_up, "a long, b long")


def _both(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame, tasks: int) -> DataFrame:
    near = _both(links)
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return near.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").coalesce(tasks)


def _small_star(links: DataFrame, tasks: int) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    met = down.join(least, "a")
    out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(met.select("a", F.col("m").alias("b")))
    return out.where("a <> b").coalesce(tasks).distinct().coalesce(tasks)


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.sum("b")).first())


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every node in ``links`` (a, b): its least reachable id."""
    now = written(_local(links.select("a", "b").where("a <> b")), "star")
    mark = _mark(now)
    while True:
        # Links are two numbers: a task takes many, whatever the session's
        # number of shuffle partitions.
        tasks = max(links.sparkSession.sparkContext.defaultParallelism, -(-mark[0] // LINKS_A_TASK))
        now = written(_local(_small_star(_large_star(now, tasks), tasks)), "star")
        new = _mark(now)
        if new == mark:
            break
        mark = new
    found = now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return found.unionByName(found.select(F.col("component").alias("id"), "component").distinct())
