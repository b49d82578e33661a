"""Embedding near-duplicates by product quantisation: inverted lists, residual codes, exact rerank."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import components, reliable

THRESHOLD = 0.93
# The index is fitted on at most so many vectors; every vector is indexed.
SAMPLE = 8192
MAX_LISTS = 512
PER_LIST = 1024
CODE_WORDS = 64
SUBSPACE = 8
ROUNDS = 8
# Vectors of a label that one task compares with as many others: as many at least, more where a label
# would make over two blocks, and components of such a block at most.
BLOCK = 2048
LARGEST = 1 << 23
# Vectors that visit the lists at a time, and of a list that are compared with them.
TILE = 2048


@dataclass(frozen=True)
class Index:
    """Coarse centres, and the code words of each subspace's residuals: bounded arrays."""

    centers: np.ndarray
    cuts: list[np.ndarray]
    words: list[np.ndarray]

    def residuals(self, x: np.ndarray, lists: np.ndarray) -> np.ndarray:
        return x - self.centers[lists]

    def encode(self, residual: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and how far each residual is from what its code stands for."""
        codes = np.empty((len(residual), len(self.cuts)), dtype=np.uint8)
        error = np.zeros(len(residual))
        for m, (cut, words) in enumerate(zip(self.cuts, self.words, strict=True)):
            part = residual[:, cut]
            codes[:, m] = _squares(part, words).argmin(1)
            error += ((part - words[codes[:, m]]) ** 2).sum(1)
        return codes, np.sqrt(error)

    def decode(self, codes: np.ndarray, lists: np.ndarray) -> np.ndarray:
        """What the codes stand for: a product with it is the sum of a table's entries by code."""
        out = self.centers[lists]
        for m, (cut, words) in enumerate(zip(self.cuts, self.words, strict=True)):
            out[:, cut] += words[codes[:, m]]
        return out


def kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Lloyd's algorithm from evenly spaced rows; an empty cluster keeps its centre."""
    k = max(1, min(k, len(x)))
    centers = x[np.linspace(0, len(x) - 1, k).astype(np.int64)].copy()
    for _ in range(rounds):
        own = ((x**2).sum(1)[:, None] - 2 * x @ centers.T + (centers**2).sum(1)).argmin(1)
        sums, counts = np.zeros_like(centers), np.bincount(own, minlength=k)
        np.add.at(sums, own, x)
        centers[counts > 0] = sums[counts > 0] / counts[counts > 0][:, None]
    return centers


def fit(x: np.ndarray, n_lists: int) -> Index:
    """An index from a bounded sample of unit vectors."""
    centers = kmeans(x, n_lists)
    own = _squares(x, centers).argmin(1)
    cuts = np.array_split(np.arange(x.shape[1]), max(1, -(-x.shape[1] // SUBSPACE)))
    residual = x - centers[own]
    return Index(centers, cuts, [kmeans(residual[:, cut], CODE_WORDS) for cut in cuts])


def _squares(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances by products; of unit vectors and means of them off by 1e-14 or less."""
    return np.maximum((x**2).sum(1)[:, None] - 2 * x @ centers.T + (centers**2).sum(1), 0.0)


def unit(x: np.ndarray) -> np.ndarray:
    """Scaled to length 1, without overflow or underflow on the way."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Side:
    """The vectors of a block: units in single precision, lists, codes and what these stand for.

    They lie in the order of their lists; ``lists`` has (list, start, end, radius) of each.
    """

    def __init__(self, index: Index, nodes: np.ndarray, counts: np.ndarray, x: np.ndarray, threshold: float):
        own = np.empty(len(x), dtype=np.int64)
        off = np.empty(len(x))
        for a in range(0, len(x), TILE):
            far = _squares(unit(x[a : a + TILE].astype(float)), index.centers)
            own[a : a + TILE], off[a : a + TILE] = far.argmin(1), np.sqrt(far.min(1))
        order = np.argsort(own, kind="stable")
        self.nodes, self.counts, self.x = nodes[order], counts[order].astype(float), x[order]
        own, off = own[order], off[order]
        edges = np.flatnonzero(np.diff(own, prepend=-1, append=len(index.centers)))
        self.lists = [(int(own[a]), int(a), int(b), float(off[a:b].max())) for a, b in zip(edges, edges[1:], strict=False)]
        self.units = np.empty(x.shape, dtype=np.float32)
        self.decoded = np.empty(x.shape, dtype=np.float32)
        self.least = np.empty(len(x), dtype=np.float32)
        reach = np.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6
        for a in range(0, len(x), TILE):
            some = slice(a, a + TILE)
            units = unit(self.x[some].astype(float))
            codes, error = index.encode(index.residuals(units, own[some]))
            coded = index.decode(codes, own[some])
            self.units[some], self.decoded[some] = units, coded
            # A linked vector is within reach of the exact one, so within reach + error of the coded.
            self.least[some] = (1 + (coded**2).sum(1) - (reach + error) ** 2) / 2 - _off(x.shape[1])

    def exact(self, rows: np.ndarray) -> np.ndarray:
        return unit(self.x[rows].astype(float))


def _off(dim: int) -> float:
    """How far a product of unit vectors in single precision may be off, and more."""
    return (dim + 16) * 2.0**-22


def linked(q: Side, rows: np.ndarray | slice, x: Side, start: int, end: int, threshold: float) -> np.ndarray | None:
    """Which of the rows of ``q`` and of ``x`` from ``start`` to ``end`` have a cosine of ``threshold`` or more.

    The codes' distance is off by the code's own error at most, so the filter loses none. What
    passes it is compared by products in single precision, and where these are too near the
    threshold to tell, the exact cosine in double precision decides. None if no pair links.
    """
    mine, off = q.units[rows], _off(q.x.shape[1])
    near = mine @ x.decoded[start:end].T >= x.least[start:end]
    passed = np.count_nonzero(near)
    if not passed:
        return None
    numbers = np.arange(len(q.x))[rows]
    if 64 * passed < near.size:
        left, right = np.divmod(np.flatnonzero(near), end - start)
        cosine = np.einsum("ij,ij->i", mine[left], x.units[start + right])
        maybe = cosine >= threshold - off
        if not maybe.any():
            return None
        left, right, cosine = left[maybe], right[maybe], cosine[maybe]
        near[:] = False
        near[left, right] = True
        close = cosine < threshold + off
        left, right = left[close], right[close]
    else:
        cosine = mine @ x.units[start:end].T
        near &= cosine >= threshold - off
        if not np.count_nonzero(near):
            return None
        left, right = np.divmod(np.flatnonzero(near & (cosine < threshold + off)), end - start)
    for a in range(0, len(left), 1 << 16):
        i, j = left[a : a + (1 << 16)], right[a : a + (1 << 16)]
        near[i, j] = np.einsum("ij,ij->i", q.exact(numbers[i]), x.exact(start + j)) >= threshold
    return near if near.any() else None


def visited(far: np.ndarray, radii: np.ndarray, gaps: np.ndarray, threshold: float) -> np.ndarray:
    """Which lists may hold a vector that links: a matrix of rows by lists, False for none that may.

    ``far`` holds distances to the centres, ``radii`` how far each list's rows are from its centre
    at most, ``gaps`` the distances between centres. A linked vector is within ``reach``, so a list
    is passed by only if its ball is farther than that, or if its cell is: rows of a list are
    nearer to its centre than to this vector's nearest one, so they lie behind the plane halfway.
    """
    reach = np.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6
    own, least = far.argmin(1), far.min(1)
    ball = far - radii <= reach
    cell = far**2 - least[:, None] ** 2 <= 2 * reach * gaps[own] + 1e-6
    return ball & cell


class Forest:
    """A spanning forest of links, found tile by tile: as many components, and less edges than nodes."""

    def __init__(self, n: int):
        self.parent = np.arange(n)
        self.edges: list[tuple[int, int]] = []

    def roots(self, nodes: np.ndarray) -> np.ndarray:
        found = self.parent[nodes]
        while (above := self.parent[found]).tolist() != found.tolist():
            found = above
        self.parent[nodes] = found
        return found

    def add(self, near: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
        """The links of a tile: each round joins what has a link to another component with one."""
        rows, cols = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
        sides = near[np.ix_(rows, cols)], left[rows], right[cols]
        while sides[0].size:
            near, left, right = sides
            other = near & (self.roots(left)[:, None] != self.roots(right)[None, :])
            some = np.flatnonzero(other.any(axis=1))
            for a, b in zip(left[some].tolist(), right[other[some].argmax(axis=1)].tolist(), strict=True):
                ra, rb = self._root(a), self._root(b)
                if ra != rb:
                    self.parent[max(ra, rb)] = min(ra, rb)
                    self.edges.append((a, b))
            # Next it is the other side's turn, else a row that all have in common joins one a round.
            sides = near[some].T, right, left[some]

    def _root(self, v: int) -> int:
        while (above := int(self.parent[v])) != v:
            self.parent[v] = self.parent[above]
            v = above
        return v


def compare(index: Index, q: Side, x: Side | None, threshold: float) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Links of each row of ``q`` and of ``x``, and the ends of a forest's edges; without ``x``, of ``q`` with itself."""
    own, x = x is None, q if x is None else x
    gaps = np.sqrt(_squares(index.centers, index.centers))
    radii = np.full(len(index.centers), -np.inf)  # a list without rows here is never visited
    for at, _, _, radius in x.lists:
        radii[at] = radius
    links, tree = [np.zeros(len(side.x)) for side in ([q] if own else [q, x])], Forest(len(q.x) + (0 if own else len(x.x)))
    for a in range(0, len(q.x), TILE):
        rows = np.arange(a, min(a + TILE, len(q.x)))
        seen = visited(np.sqrt(_squares(q.exact(rows), index.centers)), radii, gaps, threshold)
        end = int(rows[-1]) + 1
        for first, last, asked in _visits(x.lists, seen):
            who = rows[asked]
            # In one block, rows meet those before them when these ask.
            parts = [(max(first, a), min(last, end)), (max(first, end), last)] if own else [(first, last)]
            for start, stop in [(i, min(i + TILE, z)) for f, z in parts for i in range(f, z, TILE)]:
                near = linked(q, slice(a, end) if len(who) == len(rows) else who, x, start, stop, threshold)
                if near is None:
                    continue
                once = own and start < end
                if once:
                    near &= who[:, None] != np.arange(start, stop)[None, :]
                links[0][who] += near @ x.counts[start:stop]
                if not once:
                    links[-1][start:stop] += q.counts[who] @ near
                tree.add(near, who, np.arange(start, stop) + (0 if own else len(q.x)))
    both = q.nodes if own else np.concatenate([q.nodes, x.nodes])
    edges = np.array(tree.edges, dtype=np.int64).reshape(-1, 2)
    return links, both[edges[:, 0]], both[edges[:, 1]]


def _visits(lists: list[tuple[int, int, int, float]], seen: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(start, end, who visits): neighbouring lists that most rows visit are one, up to TILE vectors."""
    first = last = 0
    for at, start, end, _ in lists:
        who = np.flatnonzero(seen[:, at])
        if 2 * len(who) >= len(seen):
            if last != start or end - first > TILE:
                if last > first:
                    yield first, last, np.arange(len(seen))
                first = start
            last = end
        elif len(who):
            yield start, end, who
    if last > first:
        yield first, last, np.arange(len(seen))


def packed(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(key, x, label, dim) of (key, vector, label); x and dim are NULL where nothing can be linked.

    Components take four bytes if all of a vector are the same in single precision, else eight.
    """
    lists, keep = batch.column(1), batch.column(2).is_valid().to_numpy(zero_copy_only=False).copy()
    sizes = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    # Adding zero makes a zero of a negative one.
    values = pc.fill_null(lists.flatten(), np.nan).to_numpy(zero_copy_only=False).astype(float) + 0.0
    with np.errstate(over="ignore", invalid="ignore"):
        single = values.astype("<f4")
    ends = np.cumsum(sizes)
    row = np.repeat(np.arange(len(sizes)), sizes)
    keep &= np.bincount(row[values != 0], minlength=len(sizes)) > 0
    keep[row[~np.isfinite(values)]] = False
    wide = np.zeros(len(sizes), dtype=bool)
    wide[row[single != values]] = True
    short = single.tobytes()
    x = [
        (values[e - n : e].astype("<f8").tobytes() if w else short[4 * (e - n) : 4 * e]) if k else None
        for e, n, w, k in zip(ends.tolist(), sizes.tolist(), wide.tolist(), keep.tolist(), strict=True)
    ]
    dims = pa.array(sizes.astype(np.int32), mask=~keep)
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.binary()), batch.column(2), dims], names=["key", "x", "label", "dim"])


def unpacked(rows: list[bytes], dim: int) -> np.ndarray:
    """Packed vectors as rows of a matrix, in single precision if all are."""
    if all(len(r) == 4 * dim for r in rows):
        return np.frombuffer(b"".join(rows), dtype="<f4").reshape(len(rows), dim)
    return np.array([np.frombuffer(r, dtype="<f4" if len(r) == 4 * dim else "<f8") for r in rows], dtype=float).reshape(len(rows), dim)


def near_duplicates(
    vectors: DataFrame,
    key: str = "vec_id",
    vec: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per row of ``vectors``: (key, n_links, component), component the least key reachable.

    Rows link if their labels are equal and not NULL, their vectors as long, and their cosine is
    ``threshold`` or more. Vectors that are NULL, zero, empty or hold NULL or non-finite components
    link with nothing, and are components of their own, as are rows without a label. Equal vectors
    of a label are one node with a count, so a group of copies adds one; a row links with each of
    its copies, and repeated rows with each other. A NULL key is never a component unless it stands
    alone. An empty table gives no row.

    Vectors of a label are dealt out in blocks of a bounded number of rows, at most two until these
    are full, and each pair of blocks is compared by one task, once: a vector is copied to as many
    tasks as its label has blocks, however many lists it visits. In a task a vector visits every
    list that may hold one linked with it, see ``visited``, so no pair is lost, however many lists
    there are. A task gives each vector a count and a spanning forest of its links: their number
    grows with the rows, not with the pairs. Vectors are told apart by hashes of 64 bits outside of
    the tasks.
    """
    rows = vectors.select(F.col(key).cast("long").alias("key"), F.col(vec).cast("array<double>").alias("x"), F.col(label).alias("label"))
    kind = rows.schema["label"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(packed, batches)

    rows = rows.mapInArrow(pack, f"key long, x binary, label {kind}, dim int")
    rows = reliable(rows.withColumn("node", F.when(F.col("dim").isNotNull(), F.xxhash64("label", "x", "dim"))))
    good = rows.where("dim IS NOT NULL")
    dims = {r["dim"]: r["n"] for r in good.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    found = [_links(good.where(F.col("dim") == dim), dim, n, threshold) for dim, n in sorted(dims.items())]
    empty = rows.sparkSession.createDataFrame([], "a long, b long, n long")
    facts = empty
    for part in found:
        facts = facts.union(part)
    facts = reliable(facts)
    # A fact with b is an edge, one without is a count of links.
    rooted = components(facts.where("b IS NOT NULL").select("a", "b"))
    counted = facts.where("n IS NOT NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    nodes = good.groupBy("node").agg(F.count("*").alias("n"), F.min("key").alias("first"))
    named = nodes.join(counted, "node", "left").join(rooted, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("first").alias("least"))
    named = named.join(least, "component").select(
        "node", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), "least"
    )
    linked = good.select("key", "node").join(named, "node").select("key", F.col("links").alias("n_links"), F.col("least").alias("component"))
    alone = rows.where("dim IS NULL").select("key", F.lit(0).cast("long"), F.col("key"))
    return linked.union(alone)


def _links(rows: DataFrame, dim: int, n: int, threshold: float) -> DataFrame:
    hashed = F.xxhash64("node")
    top = rows.select(hashed.alias("h")).distinct().orderBy("h").limit(SAMPLE).agg(F.max("h")).first()[0]
    few = rows.where(hashed <= top).groupBy("node").agg(F.min("x").alias("x")).orderBy(hashed, "node").limit(SAMPLE).collect()
    index = fit(unit(unpacked([bytes(r["x"]) for r in few], dim).astype(float)), min(MAX_LISTS, -(-n // PER_LIST)))
    full = max(BLOCK, LARGEST // dim)
    nodes = rows.groupBy("label", "node", "x").agg(F.count("*").alias("n"))
    size = F.least(F.lit(full), F.greatest(F.lit(BLOCK), F.ceil(F.col("held") / 2)))
    blocks = rows.groupBy("label").agg(F.count("*").alias("held")).select("label", F.ceil(F.col("held") / size).cast("int").alias("blocks"))
    mine = F.pmod(hashed, F.col("blocks")).cast("int")
    dealt = nodes.join(reliable(blocks), "label").withColumn("mine", mine)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("label", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "mine", "node", "x", "n")

    def search(block: pa.Table) -> pa.Table:
        sides = []
        low, high = block["low"][0].as_py(), block["high"][0].as_py()
        for at in dict.fromkeys((low, high)):
            part = block.filter(pc.equal(block["mine"], at))
            if part.num_rows:
                x = unpacked(part["x"].to_pylist(), dim)
                sides.append(Side(index, part["node"].to_numpy(), part["n"].to_numpy(), x, threshold))
        if not sides or len(sides) == 1 and low != high:
            return pa.table({c: pa.array([], pa.int64()) for c in ("a", "b", "n")})
        links, a, b = compare(index, sides[0], sides[1] if low != high else None, threshold)
        some = [np.flatnonzero(n) for n in links]
        who = np.concatenate([s.nodes[i] for s, i in zip(sides, some, strict=True)])
        n = np.concatenate([n[i] for n, i in zip(links, some, strict=True)]).astype(np.int64)
        none = lambda k: pa.nulls(k, pa.int64())
        parts = {"a": [pa.array(who), pa.array(a)], "b": [none(len(who)), pa.array(b)], "n": [pa.array(n), none(len(a))]}
        return pa.table({c: pa.concat_arrays(p) for c, p in parts.items()})

    return dealt.groupBy("label", "low", "high").applyInArrow(search, "a long, b long, n long")
