"""Hard negatives by a multiway hyperplane tree with ranges of distances.

Vectors become whole numbers, so inner products and their windows are exact.
Padded by one component to one length, their inner product with an anchor orders
them as the distance does, and a window of inner products is an annulus of
distances around the anchor.

A node of the tree has up to WAYS split points; every vector below goes to the
nearest one, so the parts are bounded by the hyperplanes between split points.
For each split point the node keeps the least and the greatest distance to the
vectors of every part, its own and its siblings'.  A part whose range, seen
from any of the split points, does not meet the anchor's annulus holds nothing of
the window and is passed over.  Once the wanted number is found the annulus
shrinks to what is still nearer.  Leaves are searched exactly, and only there
inner products with ordinary vectors are computed.

The top node is fitted on a sample of at most SAMPLE vectors, in which split
points are chosen; its parts and their ranges cover all vectors.  Parts are
dealt to blocks of about BLOCK vectors, each with a tree of its own, stored as
one row.  A search sends an anchor to the blocks of those parts alone that its
annulus meets: first to its own part, where it finds a bound, then to the rest.
Blocks meet their anchors in groups of at most GROUP.

Defined results: rows with a null id, label or vector take no part, nor do
those with null or non-finite components, nor those whose whole-number vector is
longer than LONGEST, whose products could not be told apart.  Rows repeated for
an id count once, with the least label and vector.  Vectors are only compared
with those of their own number of components; a vector without components
scores 0 with its like.  Ties go to the smaller id.  An empty table gives no rows.
Other columns are not looked at.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from pairloom.session import staged

WAYS = 8
LEAF = 128
TOP_WAYS = 32
SAMPLE = 4096
BLOCK = 4096
#: Anchors that meet a block in one group at most (about).
GROUP = 16_384
SCALE = 256
#: Products of vectors up to this length are whole numbers that a double holds exactly.
LONGEST = 2.0**26
#: Distances are compared with this margin, as a share of the lengths, for their rounding.
_MARGIN = 1e-7
_ROUTED_AT_ONCE = 1_000
_NONE = np.iinfo(np.int64).max

BLOCKS = "size int, part int, block int, longest double, tree binary"
FOUND = "anchor_id long, place int, vec_id long, score long"


def whole_vectors(rows: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``(vec_id, label, vector, size)``: the rows that take part, components multiplied and rounded down."""
    vector = F.col(vector_col).cast("array<double>")
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LONGEST))
    good = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), vector.alias("raw")).filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(F.when(F.col("raw").isNotNull(), whole), F.lit(False))
    )
    made = good.select("vec_id", "label", F.transform("raw", lambda x: F.floor(x * scale).cast("double")).alias("vector"))
    long = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    once = made.filter(long <= LONGEST**2).groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("x"))
    return once.select("vec_id", "x.label", "x.vector", F.size("x.vector").alias("size"))


# ------------------------------------------------------------------------------- distances
def _distances(a: np.ndarray, b: np.ndarray, longest: float, padded: bool) -> np.ndarray:
    """Distances of all ``a`` to all ``b``, these padded to the length ``longest``, and ``a`` as well if it is ``padded``."""
    own, other = (a * a).sum(axis=1), (b * b).sum(axis=1)
    product = a @ b.T
    if padded:
        product += np.sqrt(np.clip(longest**2 - own, 0, None))[:, None] * np.sqrt(np.clip(longest**2 - other, 0, None))[None, :]
        own = np.full(len(a), longest**2)
    return np.sqrt(np.clip(own[:, None] + longest**2 - 2 * product, 0, None))


def _radius(norms: np.ndarray, longest: float, score: np.ndarray) -> np.ndarray:
    """How far a padded vector with this inner product lies from an anchor of this norm."""
    return np.sqrt(np.clip(norms**2 + longest**2 - 2 * score, 0, None))


def _met(to_points: np.ndarray, low: np.ndarray, high: np.ndarray, inner: np.ndarray, outer: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which parts each annulus may meet, and how near their vectors can be.

    ``to_points`` holds the distances of the anchors to the split points,
    ``low`` and ``high`` by split point and part the ranges of distances.
    """
    near = np.max(np.maximum(to_points[:, :, None] - high[None], low[None] - to_points[:, :, None]), axis=1)
    far = np.min(to_points[:, :, None] + high[None], axis=1)
    return (near <= (outer + margin)[:, None]) & (far >= (inner - margin)[:, None]), near


def _split_points(vectors: np.ndarray, ways: int, longest: float, seed: int) -> np.ndarray:
    """Some vectors that lie far apart: each is the farthest from those before, of a few candidates."""
    drawn = np.random.default_rng(seed).permutation(len(vectors))[: 3 * ways]
    chosen = [0]
    nearest = _distances(vectors[drawn], vectors[drawn[:1]], longest, True)[:, 0]
    while len(chosen) < ways and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _distances(vectors[drawn], vectors[drawn[chosen[-1:]]], longest, True)[:, 0])
    return vectors[drawn[chosen]]


def _ranges(distances: np.ndarray, part: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest distance from each split point (a column) to the vectors of each part."""
    low, high = np.full((distances.shape[1], parts), np.inf), np.full((distances.shape[1], parts), -np.inf)
    for j in np.unique(part).tolist():
        low[:, j], high[:, j] = distances[part == j].min(axis=0), distances[part == j].max(axis=0)
    return low, high


# ------------------------------------------------------------------------------------ tree
@dataclass
class Node:
    begin: int
    end: int
    points: np.ndarray | None = None
    low: np.ndarray | None = None
    high: np.ndarray | None = None
    parts: list[Node] | None = None


class Tree:
    """The vectors of a block, in the order of the leaves."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, ways: int = WAYS, leaf: int = LEAF) -> None:
        order = np.lexsort((ids,))
        vectors = vectors[order]
        self.longest = float(np.sqrt((vectors * vectors).sum(axis=1).max()))
        place = np.arange(len(ids))
        self.root = Node(0, len(ids))
        open_ = [self.root]
        while open_:
            node = open_.pop()
            size = node.end - node.begin
            if size <= leaf:
                continue
            mine = vectors[place[node.begin : node.end]]
            points = _split_points(mine, ways, self.longest, size)
            distances = _distances(mine, points, self.longest, True)
            part = distances.argmin(axis=1)
            counts = np.bincount(part, minlength=len(points))
            if counts.max() == size:  # nothing tells these vectors apart
                continue
            node.points, (node.low, node.high) = points, _ranges(distances, part, len(points))
            place[node.begin : node.end] = place[node.begin : node.end][np.argsort(part, kind="stable")]
            ends = node.begin + np.cumsum(counts)
            node.parts = [Node(int(e - n), int(e)) for e, n in zip(ends, counts, strict=True)]
            open_ += node.parts
        self.ids, self.labels, self.vectors = ids[order][place], labels[order][place], vectors[place]

    def search(self, asked: Asked, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids and scores of the first ``k`` of each window, and how many inner products that took."""
        best = np.full((len(asked.anchor), k), -np.inf)
        ids = np.full((len(asked.anchor), k), _NONE)
        norms = np.linalg.norm(asked.vectors, axis=1)[asked.anchor]
        inner, margin = _radius(norms, self.longest, asked.high), _MARGIN * (norms + self.longest)
        products = 0
        open_: list[tuple[Node, np.ndarray, np.ndarray]] = [(self.root, np.arange(len(asked.anchor)), np.zeros(len(asked.anchor)))]
        while open_:
            node, windows, near = open_.pop()
            least = np.maximum(asked.low[windows], best[windows, k - 1])
            outer = _radius(norms[windows], self.longest, least)
            on = near <= outer + margin[windows]
            windows, least, outer = windows[on], least[on], outer[on]
            if not len(windows) or node.begin == node.end:
                continue
            anchors, of = np.unique(asked.anchor[windows], return_inverse=True)
            if node.parts is not None:
                to_points = _distances(asked.vectors[anchors], node.points, self.longest, False)[of]
                products += len(anchors) * len(node.points)
                met, near = _met(to_points, node.low, node.high, inner[windows], outer, margin[windows])
                nearness = near.mean(axis=0)
                for j in np.argsort(-nearness, kind="stable").tolist():  # the nearest part on average is taken first
                    some = met[:, j]
                    if some.any():
                        open_.append((node.parts[j], windows[some], near[some, j]))
                continue
            there = slice(node.begin, node.end)
            products += len(anchors) * (node.end - node.begin)
            scores = (asked.vectors[anchors] @ self.vectors[there].T)[of]
            same = asked.labels[asked.anchor[windows]][:, None] == self.labels[there][None, :]
            fits = (same == asked.same) & (scores >= least[:, None]) & (scores <= asked.high[windows][:, None])
            fits &= asked.ids[asked.anchor[windows]][:, None] != self.ids[there][None, :]
            some = np.flatnonzero(fits.any(axis=1))
            if len(some):
                rows = windows[some]
                both = np.concatenate((best[rows], np.where(fits[some], scores[some], -np.inf)), axis=1)
                names = np.concatenate((ids[rows], np.broadcast_to(self.ids[there], scores[some].shape)), axis=1)
                order = np.lexsort((names, -both), axis=1)[:, :k]
                best[rows] = np.take_along_axis(both, order, axis=1)
                ids[rows] = np.take_along_axis(names, order, axis=1)
        return ids, best, products


@dataclass
class Asked:
    """Windows of inner products: of which anchor, from where to where; ``same`` asks for the anchor's own label."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    anchor: np.ndarray
    low: np.ndarray
    high: np.ndarray
    same: bool


def _asked(rows: pd.DataFrame, same: bool) -> Asked:
    """Rows of anchors, each with the list of its windows."""
    counts = rows["low"].map(len).to_numpy()
    return Asked(
        rows["vec_id"].to_numpy(), rows["label"].to_numpy(), np.stack(rows["vector"].to_numpy()).astype(float), np.repeat(np.arange(len(rows)), counts),
        np.concatenate(rows["low"].to_list()).astype(float), np.concatenate(rows["high"].to_list()).astype(float), same,
    )


# ----------------------------------------------------------------------------- index of Spark
@dataclass
class Top:
    """The top node: split points, ranges of distances to all parts, vectors of each part.  Part -1 is for vectors of other sizes."""

    size: int
    longest: float
    points: np.ndarray
    low: np.ndarray | None = None
    high: np.ndarray | None = None


@dataclass
class Index:
    """The stored blocks, the top node, and ``(size, part, blocks)``."""

    blocks: DataFrame
    top: Top | None
    sizes: DataFrame


def _fit(vectors: DataFrame, ways: int) -> Top | None:
    """Split points from a sample of the most frequent size of vectors, spread by the hash of the id."""
    sizes = vectors.groupBy("size").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)).alias("longest")
    )
    most = sizes.filter("size > 0").orderBy(F.desc("n"), "size").first()
    if most is None:
        return None
    share = min(1.0, 0.9 * SAMPLE / most["n"])
    drawn = F.pmod(F.xxhash64("vec_id", F.lit("split")), F.lit(1 << 30)) < share * (1 << 30)
    sample = vectors.filter((F.col("size") == most["size"]) & drawn).select("vec_id", "vector").limit(SAMPLE).collect()
    if not sample:
        return None
    found = np.array([r["vector"] for r in sorted(sample, key=lambda r: r["vec_id"])], dtype=float)
    longest = float(np.sqrt(most["longest"]))
    return Top(most["size"], longest, _split_points(found, ways, longest, 1))


def _parted(vectors: DataFrame, top: Top | None) -> DataFrame:
    """The vectors with ``part`` and the distances to all split points."""
    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            part, distances = np.full(len(batch), -1, dtype=np.int32), np.full(len(batch), None, dtype=object)
            mine = np.flatnonzero(batch["size"].to_numpy() == top.size) if top else np.zeros(0, dtype=np.int64)
            if len(mine):
                found = _distances(np.stack(batch["vector"].to_numpy()[mine]).astype(float), top.points, top.longest, True)
                part[mine] = found.argmin(axis=1)
                distances[mine] = list(found)
            yield batch.assign(part=part, distances=distances)

    return vectors.mapInPandas(deal, "vec_id long, label long, vector array<double>, size int, part int, distances array<double>")


def index(vectors: DataFrame, ways: int = TOP_WAYS, block: int = BLOCK) -> tuple[Index, DataFrame]:
    """The index of all :func:`whole_vectors`, and these with their parts, stored."""
    top = _fit(vectors, ways)
    parted = staged(_parted(vectors, top), "parted")
    if top is not None:
        each = parted.filter("part >= 0").select("part", F.posexplode("distances").alias("point", "distance"))
        found = each.groupBy("point", "part").agg(F.min("distance").alias("low"), F.max("distance").alias("high")).collect()  # points x parts
        top.low, top.high = np.full((2, len(top.points), len(top.points)), np.inf)
        top.high[:] = -np.inf
        for row in found:
            top.low[row["point"], row["part"]], top.high[row["point"], row["part"]] = row["low"], row["high"]
    sizes = staged(parted.groupBy("size", "part").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")), "sizes")
    dealt = parted.drop("distances").join(sizes, ["size", "part"]).withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit("block")), "blocks").cast("int"))

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        tree = Tree(group["vec_id"].to_numpy(), group["label"].to_numpy(), np.stack(group["vector"].to_numpy()).astype(float))
        first = group.iloc[0]
        return pd.DataFrame([{
            "size": first["size"], "part": first["part"], "block": first["block"], "longest": tree.longest, "tree": pickle.dumps(tree),
        }])

    blocks = staged(dealt.select("vec_id", "label", "vector", "size", "part", "block").groupBy("size", "part", "block").applyInPandas(grow, BLOCKS), "blocks")
    return Index(blocks, top, sizes), parted


def _routed(anchors: DataFrame, top: Top | None, home: bool | None) -> DataFrame:
    """Anchors with their windows, once for each part that one of them may meet.

    ``home`` asks for an anchor's own part alone; False for all others, None for all.
    """
    def sent(batch: pd.DataFrame) -> pd.DataFrame:
        mine = batch["size"].to_numpy() == (top.size if top else -1)
        out = [batch[~mine & (home is not False)].assign(to=-1)]
        rows = batch[mine]
        if len(rows):
            asked = _asked(rows, True)
            norms = np.linalg.norm(asked.vectors, axis=1)[asked.anchor]
            to_points = _distances(asked.vectors, top.points, top.longest, False)[asked.anchor]
            met, _ = _met(
                to_points, top.low, top.high, _radius(norms, top.longest, asked.high), _radius(norms, top.longest, asked.low),
                _MARGIN * (norms + top.longest),
            )
            parts = np.zeros((len(rows), len(top.points)), dtype=bool)
            np.logical_or.at(parts, asked.anchor, met)
            own = np.arange(len(top.points))[None, :] == rows["part"].to_numpy()[:, None]
            if home is not None:
                parts = own if home else parts & ~own
            which, to = np.nonzero(parts)
            out.append(rows.iloc[which].assign(to=to))
        return pd.concat(out).drop(columns="part").rename(columns={"to": "part"})

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), _ROUTED_AT_ONCE):
                yield sent(batch.iloc[start : start + _ROUTED_AT_ONCE])

    schema = "vec_id long, label long, vector array<double>, size int, low array<double>, high array<double>, part int"
    return anchors.select("vec_id", "label", "vector", "size", "part", "low", "high").mapInPandas(send, schema)


def search(found: Index, anchors: DataFrame, groups: int, same: bool, k: int, home: bool | None = None) -> DataFrame:
    """``(anchor_id, place, vec_id, score)``: the first ``k`` of each window in each block it meets; ``place`` is the window's in its anchor's list."""
    one_of = F.pmod(F.xxhash64("vec_id", F.lit("group")), F.lit(groups)).cast("int")
    sent = _routed(anchors, found.top, home).join(found.sizes, ["size", "part"])
    sent = sent.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("group", one_of)
    blocks = found.blocks.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def look(_, rows: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(block):
            return pd.DataFrame({"anchor_id": [], "place": [], "vec_id": [], "score": []})
        asked = _asked(rows, same)
        ids, scores, _ = pickle.loads(block["tree"].iloc[0]).search(asked, k)
        window, at = np.nonzero(np.isfinite(scores))
        first = np.concatenate(([0], np.cumsum(np.bincount(asked.anchor, minlength=len(rows)))))
        return pd.DataFrame({
            "anchor_id": asked.ids[asked.anchor[window]], "place": window - first[asked.anchor[window]],
            "vec_id": ids[window, at], "score": scores[window, at].astype(np.int64),
        })

    keys = ["size", "part", "block", "group"]
    return sent.groupBy(*keys).cogroup(blocks.groupBy(*keys)).applyInPandas(look, FOUND)


def _first(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


# -------------------------------------------------------------------------- hard negatives
def hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` from :func:`whole_vectors`.

    An anchor's positives are its nearest of the same label.  For each the
    nearest of other labels are returned whose score is at least ``least`` and
    at most ``most`` hundredths of the positive's.
    """
    found, parted = index(staged(vectors, "whole_vectors"))
    anchors = parted.filter(is_anchor).drop("distances")
    groups = max(1, -(-anchors.count() // GROUP))
    everything = [F.array(F.lit(x)).alias(name) for x, name in ((-np.inf, "low"), (np.inf, "high"))]
    own = staged(search(found, anchors.select("*", *everything), groups, True, positives, home=True), "own_part")
    # the last of the positives in the own part bounds what is looked for elsewhere
    bound = _first(own, positives).groupBy("anchor_id").agg(F.when(F.count(F.lit(1)) == positives, F.min("score")).alias("bound"))
    bounded = anchors.join(bound, F.col("vec_id") == F.col("anchor_id"), "left").select(
        *anchors.columns, F.array(F.coalesce(F.col("bound").cast("double"), F.lit(-np.inf))).alias("low"), everything[1],
    )
    nearest = staged(_first(own.unionByName(search(found, bounded, groups, True, positives, home=False)), positives), "positives")

    # hundredths rounded inwards, in whole numbers: (x - pmod(x, 100)) / 100 rounds down
    def down(x: Column) -> Column:
        return ((x - F.pmod(x, F.lit(100))) / 100).cast("long")

    score = F.col("score")
    windows = nearest.withColumn("low", -down(-least * score)).withColumn("high", down(most * score)).filter("low <= high")
    lists = windows.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score", "low", "high"))).alias("w"))
    asking = anchors.join(lists, F.col("vec_id") == F.col("anchor_id")).select(
        *anchors.columns, F.col("w.low").cast("array<double>").alias("low"), F.col("w.high").cast("array<double>").alias("high"),
    )
    met = _first(search(found, asking, groups, False, negatives), negatives)
    of = lists.select("anchor_id", F.posexplode("w").alias("place", "positive"))
    return met.join(of, ["anchor_id", "place"]).select(
        "anchor_id", F.col("positive.vec_id").alias("positive_id"), "rank", F.col("vec_id").alias("negative_id"),
        F.col("positive.score").alias("positive_score"), F.col("score").alias("negative_score"),
    )
