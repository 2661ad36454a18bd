"""Connected components of a pair table, by alternating star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from pairloom.operators.numbering import numbered, shuffled_order
from pairloom.session import discard, scratch_path, staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours onto the least vertex of each vertex's neighbourhood.

    The large star moves a vertex's greater neighbours, the small star its
    lesser neighbours and itself.  The least neighbour is an aggregate, so a
    hub's edges are reduced before the shuffle; joined back, a hub is a skewed
    key of the big side, which the adaptive skew join splits.
    """
    if large:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        moved = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        return moved.filter("a <> b").distinct()
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("low"))
    moved = down.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(low.select("a", F.col("low").alias("b"))).filter("a <> b").distinct()


def _all_stars(edges: DataFrame) -> bool:
    """Whether every vertex has one edge down at most, and none that has is reached itself.

    One aggregate over the vertices; a hub's edges are summed where they are.
    """
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("a").alias("vertex"), F.lit(1).cast("long").alias("down"), F.lit(0).cast("long").alias("up")),
        F.struct(F.col("b").alias("vertex"), F.lit(0).cast("long").alias("down"), F.lit(1).cast("long").alias("up")),
    )).alias("end")).select("end.*")
    degrees = ends.groupBy("vertex").agg(F.sum("down").alias("down"), F.sum("up").alias("up"))
    return degrees.filter("down > 1 OR (down > 0 AND up > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``(vertex, component)`` for edges ``(a, b)``; a component is named by its least vertex.

    Edges lead from the greater to the lesser vertex.  Every round is stored in
    the shared folder, so a lost executor costs one round, not the whole chain;
    the round before it is deleted.  Once all components are stars their
    centres are their least vertices, and no further round can change them.
    """
    spark = edges.sparkSession

    def stored(df: DataFrame) -> tuple[DataFrame, str]:
        path = scratch_path(spark, "components")
        df.write.parquet(path)
        return spark.read.parquet(path), path

    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current, path = stored(down.filter("a <> b").distinct())
    while not _all_stars(current):
        before = path
        current, path = stored(_star(_star(current, large=True), large=False))
        discard(spark, before)
    stars = current.select(F.col("a").alias("vertex"), F.col("b").alias("component"))
    return stars.union(stars.select(F.col("component"), F.col("component")).distinct())


def extended(stars: DataFrame, edges: DataFrame) -> DataFrame:
    """The components ``stars`` after new ``edges``, without a look at the edges they were made of.

    The ends of the new edges give way to the components they are in; only the
    small graph between those is gone over.  The least of some components' names
    is the least of all their vertices, so names are those of a full run.
    """
    of = stars.select(F.col("vertex").alias("end"), F.col("component").alias("of"))

    def raised(df: DataFrame, end: str) -> DataFrame:
        met = df.join(of, F.col(end) == F.col("end"), "left")
        return met.select(*[F.coalesce("of", end).alias(c) if c == end else F.col(c) for c in ("a", "b")])

    merged = components(raised(raised(edges.select("a", "b"), "a"), "b"))
    names = merged.select(F.col("vertex").alias("of"), F.col("component").alias("now"))
    renamed = stars.join(names, F.col("component") == F.col("of"), "left").select("vertex", F.coalesce("now", "component").alias("component"))
    return renamed.unionByName(merged.join(stars, "vertex", "left_anti").select("vertex", "component"))


def reduced(stars: DataFrame, gone: DataFrame, kept: DataFrame) -> DataFrame:
    """The components ``stars`` after the edges ``gone``, where ``kept`` are all the other edges they were made of.

    Components that lose no edge stay as they are; the kept edges of the others
    are gone over again.  A vertex without an edge is in no component.
    """
    ends = gone.select(F.explode(F.array("a", "b")).alias("vertex")).distinct()
    touched = staged(stars.join(ends, "vertex", "left_semi").select("component").distinct(), "touched")
    inside = stars.join(touched, "component", "left_semi").select(F.col("vertex").alias("a"))
    again = components(kept.select("a", "b").join(inside, "a", "left_semi"))
    return stars.join(touched, "component", "left_anti").select("vertex", "component").unionByName(again)


def pair_edges(pairs: DataFrame, id_1: str, id_2: str) -> DataFrame:
    """Edges between the records of a pair table.

    Ids are tagged with their column before they become vertices: the same text
    in both columns names two records.
    """
    for column in (id_1, id_2):
        if not isinstance(pairs.schema[column].dataType, T.StringType):
            raise TypeError(f"cluster numbers follow the digest of text ids, but {column} is no text")
    return pairs.select(F.concat(F.lit("1:"), F.col(id_1)).alias("a"), F.concat(F.lit("2:"), F.col(id_2)).alias("b"))


def numbered_clusters(pairs: DataFrame, found: DataFrame, id_1: str, id_2: str, name: str = "cluster_number") -> DataFrame:
    """Pairs with the dense number of their component among those ``found``.

    Clusters are numbered in the digest order of their name, which spreads the
    numbering over all tasks.
    """
    clusters = numbered(found.select("component").distinct(), shuffled_order(F.col("component")), ["component"], name)
    of_first = found.filter(F.col("vertex").startswith("1:")).join(clusters, "component").select(
        F.substring(F.col("vertex"), F.lit(3), F.length("vertex")).alias(id_1), name
    )
    return pairs.join(of_first, id_1, "left")


def cluster_number(pairs: DataFrame, id_1: str, id_2: str, name: str = "cluster_number") -> DataFrame:
    """Pairs with the dense number of their cluster."""
    return numbered_clusters(pairs, components(pair_edges(pairs, id_1, id_2)), id_1, id_2, name)
