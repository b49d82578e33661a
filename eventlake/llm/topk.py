"""Exact top-k inner products by a dual-tree search over cover trees."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.llm.common import least_hashed, reliable
from eventlake.llm.vectors import farthest_first

K = 5
EVERY = 50
LEVELS = 256.0
# The bounded sample: centres of the upper level come from it, and first kth scores.
SAMPLE = 512
MAX_NODES = 16
# Rows of data and of queries that one task searches at a time: as many at least, more where a side
# would make over MAX_NODES blocks, and components of such a block at most.
BLOCK = 4096
LARGEST = 1 << 24
# One in so many rows is searched before the others, for kth scores that are near the last ones.
FIRST = 16
LEAF = 2048
TILE = 1024
FAN_OUT = 32
_SHRINK = 1.3
_LAST = np.iinfo(np.int64).max


@dataclass
class Node:
    """Points around one of them, all within ``radius``; children have centres far apart.

    ``start`` to ``end`` are the places of its rows in the order of the leaves.
    """

    rows: np.ndarray
    center: np.ndarray
    norm: float
    radius: float
    children: list[Node] = field(default_factory=list)
    start: int = 0
    end: int = 0


def _near(x: np.ndarray, squares: np.ndarray, center: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances by inner products, and how far they may be off."""
    square = float(center.astype(float) @ center.astype(float))
    far = squares + square - 2.0 * (x @ center).astype(float)
    return np.maximum(far, 0.0), 1e-12 * (squares + square)


def cover_tree(x: np.ndarray, rows: np.ndarray | None = None, center: int = 0) -> Node:
    """A cover tree of the rows of ``x``.

    A node's children are chosen farthest first, so the first keeps the parent's centre (nesting),
    all points lie within the children's radii (covering) and centres lie farther apart than those
    (separation), until the radius has shrunk or there are ``FAN_OUT``, less of a node of few leaves.
    Equal points make a leaf.
    """
    rows = np.arange(len(x)) if rows is None else rows
    own = x[rows]
    squares = np.einsum("ij,ij->i", own, own).astype(float)
    near, off = _near(own, squares, x[center])
    radius, middle = float(np.sqrt((near + off).max(initial=0.0))), x[center].astype(float)
    node = Node(rows, middle, float(np.linalg.norm(middle)), radius)
    if len(rows) <= LEAF or (near <= off).all():
        return node
    owner, centers, first = np.zeros(len(rows), dtype=np.int64), [center], near.max()
    most = min(FAN_OUT, 1 + 2 * len(rows) // LEAF)
    while near.max() > first / _SHRINK**2 and len(centers) < most:
        centers.append(int(rows[near.argmax()]))
        far, _ = _near(own, squares, x[centers[-1]])
        closer = far < near
        owner[closer] = len(centers) - 1
        near[closer] = far[closer]
    order = np.argsort(owner, kind="stable")
    parts = np.split(rows[order], np.cumsum(np.bincount(owner, minlength=len(centers)))[:-1])
    del own, squares, near, off
    node.children = [cover_tree(x, part, c) for part, c in zip(parts, centers, strict=True) if len(part)]
    return node


def _ordered(root: Node) -> np.ndarray:
    """The rows in the order of the leaves; each node is told its places in it."""
    leaves: list[np.ndarray] = []

    def visit(node: Node, at: int) -> int:
        node.start = at
        if not node.children:
            leaves.append(np.sort(node.rows))
        node.end = at + len(node.rows)
        for child in node.children:
            at = visit(child, at)
        return node.end

    visit(root, 0)
    return np.concatenate(leaves)


def ceiling(q: Node, d: Node) -> float:
    """No inner product of a point of ``q`` and one of ``d`` exceeds this."""
    most = float(q.center @ d.center) + q.norm * d.radius + d.norm * q.radius + q.radius * d.radius
    return most + abs(most) * 1e-9 + 1e-6


class Best:
    """The k best (score, key) so far of each query; ties go to the smaller key.

    Scores have ``kind``, in which they are exact. A place that is free has the least score.
    """

    def __init__(self, bounds: np.ndarray, k: int, kind: type = np.int64):
        whole = np.issubdtype(kind, np.integer)
        self.k, self.least = k, -_LAST if whole else -np.inf
        self.worst = np.where(np.isneginf(bounds), self.least, bounds).astype(kind)
        self.last = np.full(len(bounds), _LAST)
        self.scores = np.full((len(bounds), k), self.least, dtype=np.int64 if whole else np.float64)
        self.keys = np.full((len(bounds), k), _LAST)

    def offer(self, queries: slice, keys: np.ndarray, scores: np.ndarray, own: np.ndarray) -> None:
        """``scores`` of the queries, with keys ``own``, and the rows ``keys``."""
        if not scores.size:
            return
        worst = self.worst[queries]
        at = np.flatnonzero(scores.max(axis=1) >= worst)
        if not len(at):
            return
        some = scores[at]
        hits = np.flatnonzero(some >= worst[at, None])
        i, j = np.divmod(hits, len(keys))
        q, key, score = at[i], keys[j], some.ravel()[hits]
        good = (own[q] != key) & ((score > worst[q]) | (key < self.last[queries][q]))
        if good.any():
            self._take(q[good] + queries.start, key[good], score[good])

    def _take(self, q: np.ndarray, key: np.ndarray, score: np.ndarray) -> None:
        who, q = np.unique(q, return_inverse=True)
        q = np.concatenate([q, np.repeat(np.arange(len(who)), self.k)])
        key = np.concatenate([key, self.keys[who].ravel()])
        score = np.concatenate([score.astype(self.scores.dtype), self.scores[who].ravel()])
        order = np.lexsort((key, -score, q))
        starts = np.cumsum(np.bincount(q)) - np.bincount(q)
        order = order[np.arange(len(q)) - starts[q[order]] < self.k]
        self.scores[who], self.keys[who] = score[order].reshape(-1, self.k), key[order].reshape(-1, self.k)
        last = self.scores[who, -1]
        full = who[last > self.least]
        self.worst[full] = last[last > self.least]
        self.last[full] = self.keys[full, -1]

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, key, score) of what was found."""
        q, i = np.nonzero(self.scores > self.least)
        return q, self.keys[q, i], self.scores[q, i].astype(np.int64)


def _exact(q: np.ndarray, d: np.ndarray) -> type:
    """The fastest kind of number in which all inner products, and parts of them, are exact."""
    most = [float(np.linalg.norm(x.astype(float), axis=1).max(initial=0.0)) for x in (q, d)]
    return np.float32 if max(most) ** 2 < 2**24 else np.float64 if max(most) ** 2 < 2**52 else np.int64


def _few_copies(keys: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
    """Row numbers by key, without repeated rows, and of equal vectors those of the k + 1 least keys.

    A query's k best hold no others: all score alike, and only one may have the query's own key.
    """
    order = np.argsort(keys, kind="stable")
    if not x.shape[1]:
        same = np.zeros(len(x), dtype=np.int64)
    else:
        whole = np.ascontiguousarray(x).view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel()
        same = np.unique(whole, return_inverse=True)[1].ravel()
    order = order[np.argsort(same[order], kind="stable")]
    key, group = keys[order], same[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (group[1:] != group[:-1])
    order, group = order[new], group[new]
    counts = np.bincount(group)
    rank = np.arange(len(order)) - (np.cumsum(counts) - counts)[group]
    order = order[rank <= k]
    return order[np.argsort(keys[order], kind="stable")]


def dual_search(q: np.ndarray, q_keys: np.ndarray, bounds: np.ndarray, d: np.ndarray, d_keys: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of ``q``, key, score): the k best rows of ``d`` for each row of ``q`` that reach its bound.

    Node pairs are visited by falling ceiling; one below the worst kth score of its query node is
    pruned with all below it. Leaves are compared in whole numbers.
    """
    if not len(q) or not len(d):
        return (np.zeros(0, dtype=np.int64),) * 3
    kept = _few_copies(d_keys, d, k)
    d, d_keys, kind = d[kept], d_keys[kept], _exact(q, d)
    points = np.float32 if kind is np.float32 else np.float64
    roots = cover_tree(q.astype(points)), cover_tree(d.astype(points))
    orders = [_ordered(root) for root in roots]
    qs, ds = q[orders[0]].astype(kind), d[orders[1]].astype(kind)
    q_keys, d_keys, best = q_keys[orders[0]], d_keys[orders[1]], Best(bounds[orders[0]], k, kind)
    heap, n = [(-ceiling(*roots), 0, *roots)], 1
    while heap:
        most, _, a, b = heapq.heappop(heap)
        if -most < best.worst[a.start : a.end].min():
            continue
        if not a.children and not b.children:
            for i in range(a.start, a.end, TILE):
                rows = slice(i, min(i + TILE, a.end))
                for j in range(b.start, b.end, TILE):
                    cols = slice(j, min(j + TILE, b.end))
                    best.offer(rows, d_keys[cols], qs[rows] @ ds[cols].T, q_keys[rows])
            continue
        split_query = a.children and (not b.children or a.radius >= b.radius)
        for pair in [(c, b) for c in a.children] if split_query else [(a, c) for c in b.children]:
            heapq.heappush(heap, (-ceiling(*pair), n, *pair))
            n += 1
    row, key, score = best.found()
    return orders[0][row], key, score


def packed(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(key, x, is_query, dim) of (key, vector, is_query) with valid vectors only.

    Components are floor(component * LEVELS) as whole numbers of two bytes, of eight if any of the
    vector needs more; what exceeds these is the largest or least number.
    """
    lists = batch.column(1)
    sizes = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten()
    values = pc.fill_null(values, np.nan).to_numpy(zero_copy_only=False).astype(float)
    good = lists.is_valid().to_numpy(zero_copy_only=False).copy()
    bad = np.flatnonzero(~np.isfinite(values))
    starts = np.cumsum(sizes) - sizes
    good[np.searchsorted(starts + sizes, bad, side="right")] = False
    with np.errstate(invalid="ignore", over="ignore"):
        floor = np.floor(values * LEVELS)
        whole = np.where(np.abs(floor) < 2.0**63, floor, 0.0).astype(np.int64)
    whole[floor >= 2.0**63], whole[floor <= -(2.0**63)] = _LAST, -_LAST - 1
    at = np.flatnonzero(good)
    wide = np.zeros(len(sizes), dtype=bool)
    wide[np.searchsorted(starts + sizes, np.flatnonzero((whole > 32767) | (whole < -32768)), side="right")] = True
    short = np.where(wide[np.repeat(np.arange(len(sizes)), sizes)], 0, whole).astype("<i2").tobytes()
    x = [
        whole[s : s + n].astype("<i8").tobytes() if w else short[2 * s : 2 * (s + n)]
        for s, n, w in zip(starts[at].tolist(), sizes[at].tolist(), wide[at].tolist(), strict=True)
    ]
    part = batch.take(pa.array(at))
    columns = {"key": part.column(0), "x": pa.array(x, pa.binary()), "is_query": part.column(2)}
    return pa.RecordBatch.from_pydict(columns | {"dim": pa.array(sizes[at], pa.int32())})


def unpacked(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """Packed vectors as rows of a matrix, of two bytes a number if all are."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = column.to_pylist()
    if all(len(r) == 2 * dim for r in rows):
        return np.frombuffer(b"".join(rows), dtype="<i2").reshape(len(rows), dim)
    return np.array([np.frombuffer(r, dtype="<i2" if len(r) == 2 * dim else "<i8") for r in rows], dtype=np.int64)


def top_k(vectors: DataFrame, is_query: Column, key: str = "vec_id", vec: str = "embedding", k: int = K) -> DataFrame:
    """(query, rank, key, score): the ``k`` rows of the largest inner product for each query row.

    Components are whole numbers, so scores are exact and ties go to the smaller key. Candidates
    are all valid rows but those with the query's own key; fewer than ``k`` give fewer. Rows with a
    NULL key, and vectors that are NULL or hold NULL or non-finite components, take no part. Vectors
    are compared within their length. Rows that repeat key and vector count once. An empty table
    gives no row.

    The upper level of both trees is common: centres of a bounded sample, taken farthest first, so
    that a prefix serves queries and a longer one the data. Each node knows its covering radius,
    and each query a kth score from the sample. Pairs of upper nodes below those scores are
    dropped; the others are dealt out in blocks of a bounded number of rows of either side, however
    many rows a node has, and each pair of blocks is searched by cover trees of its own. Of large
    tables one row in ``FIRST`` is searched before the others, whose pairs are dropped by the kth
    scores of that. Blocks of data grow with the table, so queries are copied to about
    2 ``MAX_NODES`` of them until these are full, and rows to as many as there are blocks of queries.
    """
    rows = vectors.where(F.col(key).isNotNull())
    rows = rows.select(F.col(key).cast("long").alias("key"), F.col(vec).cast("array<double>").alias("x"), F.coalesce(is_query, F.lit(False)).alias("is_query"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(packed, batches)

    rows = reliable(rows.mapInArrow(pack, "key long, x binary, is_query boolean, dim int"))
    counts = {r["dim"]: r for r in rows.groupBy("dim").agg(F.count("*").alias("n"), F.count_if("is_query").alias("q")).collect()}
    schema = "query long, uid long, key long, score long"
    parts = [_search(rows.where(F.col("dim") == dim), dim, c["n"], c["q"], k, schema) for dim, c in sorted(counts.items()) if c["q"]]
    if not parts:
        parts = [rows.sparkSession.createDataFrame([], schema)]
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    return _ranked(found).where(F.col("rank") <= k).select("query", "rank", "key", "score")


def _ranked(found: DataFrame) -> DataFrame:
    order = Window.partitionBy("query", "uid").orderBy(F.col("score").desc(), F.col("key"))
    return found.withColumn("rank", F.row_number().over(order))


def _search(rows: DataFrame, dim: int, n: int, n_queries: int, k: int, schema: str) -> DataFrame:
    spark = rows.sparkSession
    few = least_hashed(rows, SAMPLE, "key").orderBy(F.xxhash64("key"), "key").limit(SAMPLE)
    few = few.select("key", "x").distinct().orderBy(F.xxhash64("key"), "key", "x").collect()
    keys, near = np.array([r["key"] for r in few], dtype=np.int64), unpacked(pa.array([bytes(r["x"]) for r in few], pa.binary()), dim)
    net = farthest_first(near.astype(float), MAX_NODES)
    centers = near[net].astype(float)
    # Rows of a block of either side, and nodes of the upper level.
    full = max(BLOCK, LARGEST // max(1, dim))
    size = {"q": full, "d": min(full, max(BLOCK, n // MAX_NODES))}
    n_nodes = {"q": max(1, min(len(net), n_queries // full)), "d": max(1, min(len(net), n // BLOCK))}
    center_squares = (centers**2).sum(1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = unpacked(batch.column(1), dim)
            x, asks = whole.astype(float), batch.column(2).to_numpy(zero_copy_only=False)
            squares = (x**2).sum(1)[:, None] + center_squares
            far = np.sqrt(np.maximum(squares - 2 * x @ centers.T, 0.0) + 1e-12 * squares)
            cols = {"key": batch.column(0), "x": batch.column(1), "is_query": batch.column(2)}
            for side in ("d", "q"):
                own = far[:, : n_nodes[side]]
                cols[f"{side}_node"] = pa.array(own.argmin(1).astype(np.int32))
                cols[f"{side}_far"] = pa.array(own.min(1))
            bound, ask = np.full(len(x), -np.inf), np.flatnonzero(asks)
            own_keys, kind = batch.column(0).to_numpy()[ask], _exact(whole[ask], near)
            best = Best(bound[ask], k, kind)
            for at in range(0, len(ask), TILE):
                some = slice(at, min(at + TILE, len(ask)))
                best.offer(some, keys, whole[ask[some]].astype(kind) @ near.T.astype(kind), own_keys[some])
            bound[ask] = np.where(best.worst > best.least, best.worst, -np.inf)
            yield pa.RecordBatch.from_pydict(cols | {"bound": pa.array(bound)})

    placed = reliable(
        rows.select("key", "x", "is_query").mapInArrow(
            place,
            "key long, x binary, is_query boolean, d_node int, d_far double, q_node int, q_far double, bound double",
        )
    )
    deal = F.xxhash64("key", "x")
    first = F.pmod(F.shiftright(deal, 32), F.lit(FIRST)) == 0
    queries = placed.where("is_query").dropDuplicates(["key", "x"]).withColumn("uid", deal)
    ids = ["q_node", "d_node", "q_block", "d_block"]

    def search(q: pa.Table, d: pa.Table) -> pa.Table:
        x = [unpacked(t["x"], dim) for t in (q, d)]
        row, key, score = dual_search(x[0], q["key"].to_numpy(), q["bound"].to_numpy(), x[1], d["key"].to_numpy(), k)
        columns = (q["key"].to_numpy()[row], q["uid"].to_numpy()[row], key, score)
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("query", "uid", "key", "score"), columns, strict=True)})

    def searched(queries: DataFrame, data: DataFrame) -> DataFrame:
        """The k best rows of each block of ``data`` for each query."""
        stats = {
            side: mine.groupBy(F.col(f"{side}_node").alias("node"))
            .agg(F.count("*").alias("n"), F.max(f"{side}_far").alias("radius"), F.min("bound").alias("bound"))
            .collect()
            for side, mine in (("q", queries), ("d", data))
        }
        node = lambda r: Node(np.zeros(0), centers[r["node"]], float(np.linalg.norm(centers[r["node"]])), r["radius"])
        pairs = [
            (a["node"], b["node"], -(-a["n"] // size["q"]), -(-b["n"] // size["d"]))
            for a in stats["q"]
            for b in stats["d"]
            if ceiling(node(a), node(b)) >= a["bound"]
        ]
        fields = [T.StructField(c, T.IntegerType(), False) for c in ("q_node", "d_node", "q_blocks", "d_blocks")]
        # At most MAX_NODES squared rows, whatever the input.
        pairs = F.broadcast(spark.createDataFrame(pairs, T.StructType(fields)))

        def dealt(mine: DataFrame, side: str, other: str, columns: list[str]) -> DataFrame:
            mine = mine.select(f"{side}_node", *columns).join(pairs, f"{side}_node")
            mine = mine.withColumn(f"{side}_block", F.pmod(deal, F.col(f"{side}_blocks")).cast("int"))
            mine = mine.withColumn(f"{other}_block", F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)))
            # Named anew, since both sides of the cogroup come from one table.
            return mine.select(*[F.col(c).alias(c) for c in ids + columns])

        asking = dealt(queries, "q", "d", ["key", "x", "bound", "uid"])
        asked = dealt(data, "d", "q", ["key", "x"])
        return asking.groupBy(*ids).cogroup(asked.groupBy(*ids)).applyInArrow(search, schema)

    if n // FIRST < BLOCK:
        return searched(queries, placed)
    queries = reliable(queries)
    early = reliable(searched(queries, placed.where(first)))
    kth = _ranked(early).where(F.col("rank") == k).select(F.col("uid").alias("uid"), F.col("query").alias("key"), F.col("score").cast("double").alias("kth"))
    queries = queries.join(kth, ["uid", "key"], "left").withColumn("bound", F.greatest("bound", "kth")).drop("kth")
    return early.union(searched(reliable(queries), placed.where(~first)))
