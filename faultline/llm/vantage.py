"""Nearest neighbours by vantage-point trees, one per shard.

The measure is the largest inner product. Vectors x of a shard are lifted to
(x, sqrt(R^2 - |x|^2)), R the largest norm of the shard, and a query q to
(q, 0); then |lifted x - lifted q|^2 = R^2 + |q|^2 - 2 x.q, so the nearest lifted vectors are
those of largest product, and distances obey the triangle inequality, which
prunes the tree. ``relax`` widens (below 1) or keeps (1) the reach within
which a subtree is still searched: a subtree is left out if the distance to
its border exceeds ``relax`` times the distance of the k-th vector found so
far. Factor 1 is exact.

Equal vectors of a shard are one point of its tree, which lists its smallest
ids; no more than k + 1 of them can be among a query's nearest.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from faultline.llm.common import materialize, ship

ship(__name__)

K = 20
SHARD_ROWS = 8192
LEAF = 256
QUERY_BLOCK = 1024
RELAX = 1.0
#: Slack on comparisons of products computed in different orders.
SLACK = 1e-9


# -- tree -------------------------------------------------------------------


class Tree:
    """A vantage-point tree over the distinct vectors of one shard.

    ``order`` lays the points out so that each subtree is a range; nodes are
    rows (start, end, inner, outer) with a vantage point (the first of the
    range) and the least and greatest distances of each half from it. A node
    without children is a leaf.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, leaf: int = LEAF):
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], np.ascontiguousarray(vectors[order])
        rows = vectors.view(np.dtype((np.void, vectors.shape[1] * 8))).ravel()
        _, first, place = np.unique(rows, return_index=True, return_inverse=True)
        by = np.argsort(place, kind="stable")
        starts = np.searchsorted(place[by], np.arange(len(first)))
        ends = np.r_[starts[1:], len(by)]
        self.points = vectors[first]
        self.ids = [ids[by[s : min(e, s + k + 1)]] for s, e in zip(starts, ends, strict=True)]
        norms = np.einsum("ij,ij->i", self.points, self.points)
        self.radius = float(np.sqrt(norms.max()))
        self.lift = np.sqrt(np.maximum(self.radius**2 - norms, 0.0))
        self.order = np.arange(len(self.points))
        self.nodes: list[tuple[int, int, int, int]] = []
        self.reach: list[tuple[float, float, float, float]] = []
        self.build(0, len(self.points), leaf)
        self.points, self.lift = self.points[self.order], self.lift[self.order]
        self.ids = [self.ids[i] for i in self.order]

    def build(self, start: int, end: int, leaf: int) -> int:
        node = len(self.nodes)
        self.nodes.append((start, end, -1, -1))
        self.reach.append((0.0, 0.0, 0.0, 0.0))
        if end - start <= leaf:
            return node
        part = self.order[start:end]
        # the point farthest from the first lies at a corner
        at = int(np.argmax(self.distances(part, part[0])))
        d = self.distances(part, part[at])
        part = np.r_[part[at], np.delete(part, at)]
        d = np.r_[0.0, np.delete(d, at)]
        by = np.r_[0, 1 + np.argsort(d[1:], kind="stable")]
        self.order[start:end] = part[by]
        d = d[by]
        middle = (1 + len(part)) // 2
        inner, outer = d[1:middle], d[middle:]
        a = self.build(start + 1, start + middle, leaf)
        b = self.build(start + middle, end, leaf)
        self.nodes[node] = (start, end, a, b)
        self.reach[node] = (inner.min(), inner.max(), outer.min(), outer.max())
        return node

    def distances(self, part: np.ndarray, at: int) -> np.ndarray:
        d = self.points[part] - self.points[at]
        return np.sqrt(np.einsum("ij,ij->i", d, d) + (self.lift[part] - self.lift[at]) ** 2)

    def search(self, queries: np.ndarray, found: Found, relax: float) -> None:
        """Offer every point that may be among the k nearest to ``found``."""
        if len(self.points):
            norms = np.einsum("ij,ij->i", queries, queries)
            self.visit(0, np.arange(len(queries)), queries, norms, found, relax)

    def visit(self, node, who, queries, norms, found, relax) -> None:
        start, end, inner, outer = self.nodes[node]
        if inner < 0:
            found.offer(who, queries[who] @ self.points[start:end].T, self.ids, start)
            return
        product = queries[who] @ self.points[start]
        found.offer(who, product[:, None], self.ids, start)
        square = self.radius**2 + norms[who] - 2 * product
        d = np.sqrt(np.maximum(square, 0.0))
        low_in, high_in, low_out, high_out = self.reach[node]
        to_in = np.maximum(np.maximum(d - high_in, low_in - d), 0.0)
        to_out = np.maximum(np.maximum(d - high_out, low_out - d), 0.0)
        near = to_in <= to_out
        for child, gap, mine in (
            (inner, to_in, near),
            (outer, to_out, ~near),
            (outer, to_out, near),
            (inner, to_in, ~near),
        ):
            least = found.least[who]
            far = np.sqrt(np.maximum(self.radius**2 + norms[who] - 2 * least, 0.0))
            go = mine & ((gap <= relax * far + SLACK) | np.isinf(least))
            if go.any():
                self.visit(child, who[go], queries, norms, found, relax)


class Found:
    """The k best (score, id) of each query so far, without its own id."""

    def __init__(self, own: np.ndarray, least: np.ndarray, k: int):
        self.own, self.k = own, k
        self.least = least.copy()
        self.scores: list[np.ndarray] = [np.zeros(0)] * len(own)
        self.held: list[np.ndarray] = [np.zeros(0, np.int64)] * len(own)

    def offer(self, who: np.ndarray, products: np.ndarray, ids: list, start: int) -> None:
        good = products >= (self.least[who] - SLACK * (1 + np.abs(self.least[who])))[:, None]
        good |= np.isinf(self.least[who])[:, None]
        for i in np.flatnonzero(good.any(axis=1)):
            q, at = who[i], np.flatnonzero(good[i])
            scores = np.repeat(products[i, at], [len(ids[start + j]) for j in at])
            names = np.concatenate([ids[start + j] for j in at])
            other = names != self.own[q]
            scores = np.r_[self.scores[q], scores[other]]
            names = np.r_[self.held[q], names[other]]
            if len(scores) > self.k:
                edge = np.partition(scores, -self.k)[-self.k]
                keep = scores >= edge - SLACK * (1 + abs(edge))
                scores, names = scores[keep], names[keep]
                self.least[q] = max(self.least[q], edge)
            elif len(scores) == self.k:
                self.least[q] = max(self.least[q], scores.min())
            self.scores[q], self.held[q] = scores, names


def dumped(tree: Tree) -> bytes:
    out = io.BytesIO()
    np.savez(
        out,
        points=tree.points,
        lift=tree.lift,
        radius=tree.radius,
        nodes=np.array(tree.nodes, np.int64).reshape(-1, 4),
        reach=np.array(tree.reach).reshape(-1, 4),
        ids=np.concatenate(tree.ids) if tree.ids else np.zeros(0, np.int64),
        n_ids=np.array([len(x) for x in tree.ids], np.int64),
    )
    return out.getvalue()


def loaded(data: bytes) -> Tree:
    with np.load(io.BytesIO(data), allow_pickle=False) as held:
        tree = Tree.__new__(Tree)
        tree.points, tree.lift, tree.radius = held["points"], held["lift"], float(held["radius"])
        tree.nodes = [tuple(x) for x in held["nodes"].tolist()]
        tree.reach = [tuple(x) for x in held["reach"].tolist()]
        tree.ids = np.split(held["ids"], np.cumsum(held["n_ids"])[:-1])
    return tree


def exact_products(query: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Inner products in double precision, added from the first component on."""
    return np.cumsum(points * query, axis=1)[:, -1]


# -- jobs -------------------------------------------------------------------


def valid(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, x): rows with an id and a finite, non-zero vector without nulls."""
    x = F.col(embedding).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    some = F.exists(x, lambda v: v != 0)
    return (
        vectors.where(F.col(vec_id).isNotNull() & finite & some)
        .select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("x"))
    )


def build_index(vectors: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(shard, width, tree): a written table with a tree per shard.

    Rows go to shards of about ``shard_rows`` by the hash of the id and of
    their repetition, vectors of one length to shards of their own.
    """
    sizes = vectors.groupBy(F.size("x").alias("width")).count().collect()
    shards = {int(r["width"]): -(-int(r["count"]) // shard_rows) for r in sizes}

    def build(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        tree = Tree(part["vec_id"].to_numpy(), np.stack(part["x"].to_numpy()), k)
        return pd.DataFrame({"shard": [key[1]], "width": [key[0]], "tree": [dumped(tree)]})

    if not shards:
        return vectors.sparkSession.createDataFrame([], "shard int, width int, tree binary")
    n = F.coalesce(*[F.when(F.size("x") == w, F.lit(s)) for w, s in shards.items()])
    dealt = vectors.select("vec_id", "x", F.size("x").alias("width")).withColumn(
        "shard", F.pmod(F.xxhash64("vec_id"), n).cast("int")
    )
    built = dealt.groupBy("width", "shard").applyInPandas(build, "shard int, width int, tree binary")
    return materialize(built, "vantage-index")


def search(
    index: DataFrame, queries: DataFrame, k: int = K, relax: float = RELAX
) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k nearest others.

    Queries travel in blocks to every shard of their width; a shard
    returns its k best for each, and the best of those are kept by a ranked
    window that Spark prunes before the shuffle.
    """
    n_blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    blocks = (
        queries.select("vec_id", "x", F.size("x").alias("width"))
        .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)))
        .groupBy("width", "block")
        .agg(F.collect_list(F.struct("vec_id", "x")).alias("q"))
    )
    # every block goes to every shard of its width, the trees stay where they are
    shards = index.groupBy("width").agg((F.max("shard") + 1).alias("n"))
    sent = blocks.join(shards, "width").withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.col("n") - 1))
    )
    asked = index.join(sent, ["width", "shard"]).select("tree", "q")

    def ask(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for data, rows in zip(part["tree"], part["q"], strict=True):
                own = np.array([r["vec_id"] for r in rows], np.int64)
                q = np.array([r["x"] for r in rows], np.float64)
                tree = loaded(data)
                found = Found(own, np.full(len(own), -np.inf), k)
                tree.search(q, found, relax)
                yield best(tree, own, q, found, k)

    hits = asked.mapInPandas(ask, "query_id long, vec_id long, score double")
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        hits.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def best(tree: Tree, own: np.ndarray, q: np.ndarray, found: Found, k: int) -> pd.DataFrame:
    """The k nearest of each query among those found, by exact product."""
    place = {}
    for i, names in enumerate(tree.ids):
        for n in names.tolist():
            place.setdefault(n, []).append(i)
    out = []
    for i, names in enumerate(found.held):
        # an id that repeats is a point for each of its vectors
        pairs = sorted({(n, p) for n in names.tolist() for p in place[n]})
        if not pairs:
            continue
        ids = np.array([n for n, _ in pairs], np.int64)
        scores = exact_products(q[i], tree.points[[p for _, p in pairs]])
        top = np.lexsort((ids, -scores))[:k]
        out.append(pd.DataFrame({"query_id": own[i], "vec_id": ids[top], "score": scores[top]}))
    if not out:
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"}
        )
    return pd.concat(out)


def nearest(
    vectors: DataFrame,
    k: int = K,
    every: int = 20,
    relax: float = RELAX,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """The k nearest of each row whose id is divisible by ``every``.

    Null ids, null, zero and non-finite vectors take no part, as query or as
    candidate. Fewer candidates give fewer ranks; vectors of another length
    are no candidates. Rows that repeat an id and a vector are one row; an id with
    several vectors is a candidate with each, and as a query it asks with
    its smallest vector. Ties go to the smaller id. An empty table gives no row.
    """
    points = valid(vectors, vec_id, embedding).distinct()
    points = materialize(points, "vantage-points")
    queries = (
        points.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("x").alias("x"))
    )
    return search(build_index(points, k), queries, k, relax)
