"""Connected components of a link table, distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import cut_lineage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, component): for every node of an undirected link its component's smallest node.

    Alternating large-star and small-star rounds: each node's neighbours are
    linked to the smallest node that it knows, until nothing changes.  A round is
    one partial aggregate and one join on the link table; no task ever holds a
    node's whole neighbourhood.  Self-links and repeated links do no harm; an empty
    table gives an empty result.  Each round is written to the checkpoint folder.
    """
    edges, size = _stored(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                          .where("u <> v").distinct(), None)
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: neighbours above u go to the smallest neighbour of u (or u itself)
        edges = _sized(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")), size)
        # small star: u's smaller neighbours, and u, go to the smallest of them
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        edges = edges.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v")
        edges, size = _stored(_sized(edges, size).distinct(), size)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    heads = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        heads.select("node", F.col("node").alias("component")))


PART_ROWS = 200_000


def _sized(df: DataFrame, rows: int) -> DataFrame:
    """At most one partition per PART_ROWS of ``rows``: small tables need few tasks and files."""
    return df.coalesce(1 + rows // PART_ROWS)


def _stored(df: DataFrame, rows: int | None) -> tuple[DataFrame, int]:
    """The table in the checkpoint folder, and its number of rows."""
    out = cut_lineage(df if rows is None else _sized(df, rows))
    return out, out.count()
