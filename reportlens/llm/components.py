"""Connected components of a graph that is a DataFrame; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportlens.session import cut_lineage


def _up(rows: DataFrame, key: str, to: DataFrame) -> DataFrame:
    """``rows`` with ``key`` replaced by where ``to`` (id, up) sends it."""
    m = to.select(F.col("id").alias("_id"), F.col("up").alias("_up"))
    rest = [c for c in rows.columns if c != key]
    return rows.join(m, rows[key] == m["_id"], "left").select(F.coalesce("_up", key).alias(key), *rest)


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every id in ``links`` (a, b); root is the same for all ids
    that links connect.

    Each round sends every node to its smallest neighbour, follows that twice,
    and rewrites the links; links inside a node vanish. A round at least halves
    the nodes that still have links, so a few rounds do. Each round is a
    written table, so lost executors repeat no round.
    """
    links = cut_lineage(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    sent: list[DataFrame] = []
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = cut_lineage(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("up"))
                           .select("id", F.least("id", "up").alias("up")))
        sent.append(cut_lineage(_up(_up(near, "up", near), "up", near).select("id", "up")))
        moved = _up(_up(links, "a", sent[-1]), "b", sent[-1]).where("a <> b")
        links = cut_lineage(moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    if not sent:
        return links.select(F.col("a").alias("id"), F.col("b").alias("root"))
    out = sent[0]
    for m in sent[1:]:
        out = _up(out, "up", m)
    return cut_lineage(out.select("id", F.col("up").alias("root")))
