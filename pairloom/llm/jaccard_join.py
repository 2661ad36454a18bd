"""Self-join of documents by the Jaccard similarity of their word shingles, by chosen paths.

Documents with the same shingles are one text; only different texts are joined.
A text is named by a hash of its shingles.  It is embedded as TOKENS MinHash values, and each value at its place is a
token.  A run splits the texts by one token; a bucket with more than SMALL
texts is split again by one or two tokens that its path chooses, 1/threshold
on average, so that a pair at the threshold is expected in one child.  Buckets
of at most SMALL texts, and those after DEPTH splits, are searched through; the
latter in tiles of bounded size.  Runs are repeated until a pair at the
threshold would be missed with a probability of at most 1 - RECALL if they were
independent.  They draw on the same TOKENS values, so averaged over the equal
tokens of a pair at a similarity of 0.8 the miss is 2.1e-4 in buckets that are
split to the full depth, and none in buckets that are searched before; nearer
pairs are missed far less often.  Every link that is returned was checked on the
whole shingle sets.

A pair that meets in several buckets is counted in the first: each text brings
the list of its buckets, so that a bucket can tell.  A bucket returns a sum for
each text and a spanning forest of its links, never the links themselves.

Defined results: a null text counts as empty; texts without words are one
another's copies if they are equal and are linked to no other.  Repeated rows
are documents of their own, copies of each other.  Rows without an id are not
returned.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from pairloom.llm import shingles
from pairloom.operators.components import components
from pairloom.session import staged

THRESHOLD = 0.8
RECALL = 0.99999
TOKENS = 64
SMALL = 256
DEPTH = 4
TILE = 512
#: Texts are looked at on their whole sets from this estimate on: six standard deviations below the threshold.
ESTIMATE = 0.5

_U = np.uint64
_MULTIPLIERS = shingles.seeded(TOKENS, 9) | _U(1)
_RUN_BITS = 6
_BELOW_RUN = _U((1 << (63 - _RUN_BITS)) - 1)


def _two_children(threshold: float) -> float:
    """How often a bucket is split by a second token, so that 1/threshold are expected."""
    return min(1.0, 1 / threshold - 1)


def runs_needed(recall: float, threshold: float = THRESHOLD, depth: int = DEPTH) -> int:
    """Runs until a pair at the threshold is met with probability ``recall``, if all buckets are split ``depth`` times and runs are independent."""
    second, lost = _two_children(threshold), 0.0
    for _ in range(depth - 1):
        one = 1 - threshold * (1 - lost)
        lost = (1 - second) * one + second * one * one
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold * (1 - lost))))


# ------------------------------------------------------------------------------- prints
def _sets(texts: list[str | None]) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for part in shingles.chunks(texts):
        hashes, counts = shingles.shingle_hashes(texts[part])
        out += map(np.unique, np.split(hashes, np.cumsum(counts)[:-1]))
    return out


def _tokens(found: np.ndarray) -> np.ndarray:
    """MinHash values of a set: the upper halves of its least products."""
    least = [(found[i : i + 8192, None] * _MULTIPLIERS).min(axis=0) for i in range(0, len(found), 8192)]
    return (np.min(least, axis=0) >> _U(32)).astype("<u4")


def _key(text: str, found: np.ndarray) -> bytes:
    content = found.tobytes() if len(found) else b"without words" + text.encode("utf-8", "surrogatepass")
    return hashlib.blake2b(content, digest_size=8).digest()


def _prints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = [t or "" for t in batch["text"]]
        ids = batch["doc_id"].to_numpy()
        for part in shingles.chunks(texts):
            found = _sets(texts[part])
            keys = b"".join(map(_key, texts[part], found))
            tokens = [_tokens(x).tobytes() if len(x) else None for x in found]
            yield pd.DataFrame({"doc_id": ids[part], "text_id": np.frombuffer(keys, dtype="<i8"), "tokens": pd.Series(tokens, dtype=object)})


def texts_of(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, text_id)`` of all documents, and ``(text_id, first_id, copies, tokens)`` of all texts."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    prints = staged(rows.filter("doc_id IS NOT NULL").mapInPandas(_prints, "doc_id long, text_id long, tokens binary"), "prints")
    texts = prints.groupBy("text_id").agg(
        F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.min("tokens").alias("tokens")
    )
    return prints.select("doc_id", "text_id"), staged(texts, "texts")


# ------------------------------------------------------------------------------- paths
def _matrix(tokens: np.ndarray) -> np.ndarray:
    return np.frombuffer(b"".join(tokens), dtype="<u4").reshape(-1, TOKENS)


def _child(path: np.ndarray, place: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The path through one more token; the number of the run stays in front."""
    step = shingles.mix(path + (place.astype(_U) << _U(32)) + value.astype(_U))
    return (path & ~_BELOW_RUN) | (step & _BELOW_RUN)


def _first_paths(runs: int):
    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        start = np.arange(runs, dtype=_U) << _U(63 - _RUN_BITS)
        for batch in batches:
            if len(batch):
                values = _matrix(batch["tokens"].to_numpy())[:, :runs]
                paths = _child(np.broadcast_to(start, values.shape), np.broadcast_to(np.arange(runs), values.shape), values)
                yield pd.DataFrame({"path": paths.reshape(-1).astype(np.int64), "text_id": np.repeat(batch["text_id"].to_numpy(), runs)})

    return split


def _next_paths(second: float):
    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            paths, values = batch["path"].to_numpy().astype(_U), _matrix(batch["tokens"].to_numpy())
            draw, rows = shingles.mix(paths ^ _U(0xC0FFEE)), np.arange(len(paths))
            one = (draw % _U(TOKENS)).astype(np.int64)
            other = (one + 1 + ((draw >> _U(16)) % _U(TOKENS - 1)).astype(np.int64)) % TOKENS
            again = ((draw >> _U(32)) / float(1 << 32)) < second
            ids = batch["text_id"].to_numpy()
            yield pd.DataFrame({
                "path": np.concatenate([_child(paths, one, values[rows, one]), _child(paths, other, values[rows, other])[again]]).astype(np.int64),
                "text_id": np.concatenate([ids, ids[again]]),
            })

    return split


def buckets(texts: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """``(path, n, text_id)``: the buckets to search, of ``n`` texts each."""
    runs, schema = runs_needed(recall, threshold), "path long, text_id long"
    if runs > min(TOKENS, 1 << _RUN_BITS):
        raise ValueError("the target recall needs more runs than there are tokens")
    worded = texts.filter("tokens IS NOT NULL").select("text_id", "tokens")
    active, found = worded.mapInPandas(_first_paths(runs), schema), []
    for depth in range(1, DEPTH + 1):
        active = staged(active, "split")  # both sides of the join below read it
        # stored, so that both sides of the join are plain shuffles, whose hot paths Spark can split
        sizes = staged(active.groupBy("path").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "sizes")
        met = staged(active.join(sizes, "path"), "paths")
        last = depth == DEPTH
        found.append(met if last else met.filter(F.col("n") <= SMALL))
        big = met.filter(F.col("n") > SMALL)
        if last or big.isEmpty():
            break
        active = big.join(worded, "text_id").select("path", "text_id", "tokens").mapInPandas(_next_paths(_two_children(threshold)), schema)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.select("path", "n", "text_id")


def _tiled(rows: DataFrame) -> DataFrame:
    """Rows of large buckets dealt to tiles: each two texts of a bucket meet in one tile."""
    tiles = F.ceil(F.col("n") / TILE).cast("int")
    own = F.pmod(F.xxhash64("text_id"), tiles).cast("int")
    meeting = F.transform(
        F.sequence(F.lit(0), tiles - 1),
        lambda other: F.struct(F.least(own, other).alias("a"), F.greatest(own, other).alias("b"), own.alias("own")),
    )
    return rows.withColumn("tile", F.explode(meeting)).select("path", "tile.*", *[c for c in rows.columns if c not in ("path", "n")])


# ------------------------------------------------------------------------------- search
def _groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """Columns of each run of equal keys; the rows come sorted by them."""
    rest: dict[str, np.ndarray] | None = None
    for batch in batches:
        if not len(batch):
            continue
        columns = {c: batch[c].to_numpy() for c in batch.columns}
        if rest is not None:
            columns = {c: np.concatenate([rest[c], v]) for c, v in columns.items()}
        differs = np.zeros(len(columns[keys[0]]) - 1, dtype=bool)
        for key in keys:
            differs |= columns[key][1:] != columns[key][:-1]
        bounds = [0, *(np.flatnonzero(differs) + 1).tolist()]
        for a, b in zip(bounds, bounds[1:], strict=False):
            yield {c: v[a:b] for c, v in columns.items()}
        rest = {c: v[bounds[-1] :] for c, v in columns.items()}
    if rest is not None:
        yield rest


def _shared(lists: list[np.ndarray]) -> np.ndarray:
    """How many items each two sets have in common."""
    n = len(lists)
    of = np.repeat(np.arange(n), [len(x) for x in lists])
    items, place, times = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    several = times > 1
    column = np.cumsum(several) - 1
    kept = several[place]
    of, place = of[kept], column[place[kept]]
    out = np.zeros((n, n), dtype=np.float32)
    order = np.argsort(place, kind="stable")
    of, place = of[order], place[order]
    for low in range(0, int(several.sum()), 4096):
        a, b = np.searchsorted(place, (low, low + 4096))
        part = np.zeros((n, min(4096, int(several.sum()) - low)), dtype=np.float32)
        part[of[a:b], place[a:b] - low] = 1
        out += part @ part.T
    return out


def _own_pairs(group: dict[str, np.ndarray]) -> np.ndarray:
    """Which two texts meet in this bucket first, and in this tile."""
    path = group["path"][0]
    earlier = [b[b < path] for b in group["paths"]]
    own = group["own"]
    in_tile = (own[:, None] != own[None, :]) if group["a"][0] != group["b"][0] else np.ones((len(own), len(own)), dtype=bool)
    pairs = in_tile & (_shared(earlier) == 0)
    np.fill_diagonal(pairs, False)
    return pairs


def _likely(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of texts that have a pair of their own bucket, near enough by their tokens."""
    out: list[tuple] = []
    for group in _groups(batches, ["path", "a", "b"]):
        values = _matrix(group["tokens"])
        near = np.stack([(values == row).mean(axis=1) >= ESTIMATE for row in values])
        np.fill_diagonal(near, False)
        if near.any():
            kept = (near & _own_pairs(group)).any(axis=1)
            out += zip(*(group[c][kept].tolist() for c in ("path", "a", "b", "own", "text_id", "paths")), strict=True)
        if len(out) > 5000:
            yield pd.DataFrame(out, columns=["path", "a", "b", "own", "text_id", "paths"])
            out = []
    if out:
        yield pd.DataFrame(out, columns=["path", "a", "b", "own", "text_id", "paths"])


def _links(threshold: float):
    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """For each text of a bucket: the copies of the texts it is linked to, and the least text it is connected with."""
        out: list[pd.DataFrame] = []
        for group in _groups(batches, ["path", "a", "b"]):
            sets = [np.frombuffer(x, dtype=_U) for x in group["shingles"]]
            sizes, both = np.array([len(x) for x in sets]), _shared(sets)
            # as whole numbers, so that a pair exactly at the threshold is linked
            linked = (both >= np.ceil(threshold * (sizes[:, None] + sizes[None, :] - both) - 1e-6)) & _own_pairs(group)
            if not linked.any():
                continue
            ids = group["text_id"]
            root, before = ids.copy(), None
            while before is None or (root != before).any():
                before = root
                root = np.minimum(root, np.where(linked, root[None, :], np.iinfo(np.int64).max).min(axis=1))
            any_link = linked.any(axis=1)
            out.append(pd.DataFrame({"text_id": ids, "root": root, "links": linked @ group["copies"]})[any_link])
            if len(out) > 200:
                yield pd.concat(out)
                out = []
        if out:
            yield pd.concat(out)

    return check


def _shingle_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = [t or "" for t in batch["text"]]
        for part in shingles.chunks(texts):
            found = _sets(texts[part])
            keys = b"".join(map(_key, texts[part], found))
            yield pd.DataFrame({"text_id": np.frombuffer(keys, dtype="<i8"), "shingles": [s.tobytes() for s in found]})


def _by_bucket(rows: DataFrame) -> DataFrame:
    """Rows of a tile side by side in one partition."""
    keys = ["path", "a", "b"]
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys).sortWithinPartitions(*keys, "text_id")


def links(docs: DataFrame, texts: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """``(text_id, root, links)``: parts of each text's number of links, and of a spanning forest of all links."""
    found = staged(buckets(texts, threshold, recall), "buckets")
    lists = found.groupBy("text_id").agg(F.collect_list("path").alias("paths"))
    known = lists.join(texts.select("text_id", "tokens"), "text_id")
    kept = "path long, a int, b int, own int, text_id long, paths array<long>"
    likely = staged(_by_bucket(_tiled(found).join(known, "text_id")).mapInPandas(_likely, kept), "likely")
    wanted = likely.select("text_id").distinct().join(texts.select("text_id", "first_id", "copies"), "text_id")
    rows = docs.select(F.col("doc_id").cast("long").alias("first_id"), F.col("text").cast("string").alias("text"))
    sets = rows.join(wanted.select("first_id"), "first_id", "left_semi").mapInPandas(_shingle_sets, "text_id long, shingles binary")
    once = sets.groupBy("text_id").agg(F.first("shingles").alias("shingles"))
    with_sets = likely.join(once, "text_id").join(wanted.select("text_id", "copies"), "text_id")
    return _by_bucket(with_sets).mapInPandas(_links(threshold), "text_id long, root long, links long")


def classes(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """``(doc_id, class_id, n_links)`` for every document.

    ``class_id`` is the least id of the documents connected by links, copies
    included; ``n_links`` is the number of other documents with a similarity of
    at least the threshold, copies included.
    """
    members, texts = texts_of(docs)
    found = staged(links(docs, texts, threshold, recall), "links")
    sums = found.groupBy("text_id").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("text_id").alias("a"), F.col("root").alias("b")))
    about = (
        texts.select("text_id", "first_id", "copies").join(sums, "text_id", "left")
        .join(joined.select(F.col("vertex").alias("text_id"), "component"), "text_id", "left")
    )
    least = about.filter("component IS NOT NULL").groupBy("component").agg(F.min("first_id").alias("least"))
    named = about.join(least, "component", "left").select(
        "text_id", F.coalesce("least", "first_id").alias("class_id"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    return members.join(named, "text_id").select("doc_id", "class_id", "n_links")
