"""Ranked lexical search: the best documents of each query, by buckets of vector lengths.

A document is a vector of impacts: for each term, its weight times its saturated frequency. A
query is a set of terms, and a document's score the sum of its impacts at them. Documents are
ordered by the length of their vectors and searched in buckets of like lengths, longest first,
against the worst score that a query's best documents have so far. By Cauchy-Schwarz no document
of a bucket reaches that score if the bucket's greatest length times the query's length does not.
Inside a bucket, the impacts at a query's weightiest terms are summed, and the rest is bounded by
what is left of the vector's length and by the bucket's greatest impact at each other term. What
survives is scored exactly, in integers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.common import reliable

TOP = 10
# The constants of the score.
_SCALE, _TF, _LENGTH, _BASE, _SHARE = 1_000_000_000, 1_000, 8, 100, 90
# All bytes but letters, digits and those of characters beyond ASCII end a term; A-Z become a-z.
_TERMS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)
# A block of queries is what one pass over the documents answers: about so many, of about so many terms.
QUERIES_IN_BLOCK, TERMS_IN_BLOCK = 1024, 1 << 16
# The longest vectors, by this share of all, give the first scores to beat.
FIRST_SHARE = 0.02
# Documents in a bucket, and how many of a query's terms are summed before the rest is bounded.
BUCKET, FOCUS = 2048, 12
# Bounds are computed in floating point, with this much to spare.
_SLACK = 1 + 1e-9


def terms(text: str | None) -> list[bytes]:
    """All terms of a text, in order."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERMS).split()


@dataclass
class Block:
    """Queries of one pass: their terms in one list (query of each, term of each), and the weights."""

    query: np.ndarray
    term: np.ndarray
    weight: np.ndarray
    n_queries: int

    def __post_init__(self) -> None:
        order = np.argsort(self.term, kind="stable")
        self.query, self.term = self.query[order], self.term[order]
        counts = np.bincount(self.term, minlength=len(self.weight))
        self.first = np.concatenate(([0], np.cumsum(counts)))
        live = self.weight[self.term] > 0
        self.size = np.bincount(self.query[live], minlength=self.n_queries)
        # The weightiest terms of each query.
        ranked = np.lexsort((-self.weight[self.term], self.query))
        rank = np.empty(len(ranked), dtype=np.int64)
        starts = np.concatenate(([0], np.cumsum(np.bincount(self.query, minlength=self.n_queries))))
        rank[ranked] = np.arange(len(ranked)) - starts[self.query[ranked]]
        self.focus = rank < FOCUS
        self.rest = np.maximum(self.size - np.bincount(self.query[self.focus & live], minlength=self.n_queries), 0)

    def meet(self, row: np.ndarray, term: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, place in the list of the query terms, impact) for every term a document and a query share."""
        n = self.first[term + 1] - self.first[term]
        before = np.cumsum(n) - n
        place = np.arange(n.sum()) - np.repeat(before - self.first[term], n)
        return np.repeat(row, n), place, np.repeat(x, n)


class Best:
    """The best documents of each query so far, and the score that a document must reach."""

    def __init__(self, n_queries: int, k: int, floor: np.ndarray):
        self.k, self.floor, self.n = k, floor.astype(np.float64), n_queries
        self.query = np.zeros(0, dtype=np.int64)
        self.score = np.zeros(0, dtype=np.int64)
        self.key = np.zeros(0, dtype=np.int64)
        self.null = np.zeros(0, dtype=bool)

    def add(self, query: np.ndarray, score: np.ndarray, key: np.ndarray, null: np.ndarray) -> None:
        query, score = np.append(self.query, query), np.append(self.score, score)
        key, null = np.append(self.key, key), np.append(self.null, null)
        order = np.lexsort((key, null, -score, query))
        query, score, key, null = query[order], score[order], key[order], null[order]
        starts = np.concatenate(([0], np.cumsum(np.bincount(query, minlength=self.n))))
        rank = np.arange(len(query)) - starts[query]
        worst = rank == self.k - 1
        self.floor[query[worst]] = np.maximum(self.floor[query[worst]], score[worst])
        kept = rank < self.k
        self.query, self.score, self.key, self.null = query[kept], score[kept], key[kept], null[kept]


def search_bucket(block: Block, best: Best, key, null, length, row, term, x) -> int:
    """Search one bucket of documents; ``row``, ``term``, ``x`` list their impacts.

    Returns how many pairs of a document and a query were scored exactly.
    """
    if not len(row):
        return 0
    top, floor = length.max(), best.floor
    alive = (block.size > 0) & (np.sqrt(block.size) * top * _SLACK >= floor)
    most = np.zeros(len(block.weight), dtype=np.int64)
    np.maximum.at(most, term, x)
    reach = np.bincount(block.query, weights=most[block.term], minlength=block.n_queries)
    alive &= (reach > 0) & (reach * _SLACK >= floor)
    if not alive.any():
        return 0
    # Coordinates: exact sums at the weightiest terms, the rest bounded in two ways.
    n = len(key)
    at, place, value = block.meet(row, term, x)
    query = block.query[place]
    used = alive[query]
    at, place, value, query = at[used], place[used], value[used], query[used]
    cell = at * block.n_queries + query
    focus = block.focus[place]
    cells = n * block.n_queries
    part = np.bincount(cell[focus], weights=value[focus], minlength=cells).reshape(n, -1)
    square = np.bincount(cell[focus], weights=value[focus].astype(np.float64) ** 2, minlength=cells).reshape(n, -1)
    left = np.sqrt(np.maximum(length[:, None] ** 2 * _SLACK - square, 0)) * np.sqrt(block.rest)
    outside = ~block.focus
    others = np.bincount(block.query[outside], weights=most[block.term[outside]], minlength=block.n_queries)
    bound = (part + np.minimum(left, others)) * _SLACK
    wanted = ((bound >= floor) & (bound > 0) & alive).ravel()
    kept = wanted[cell]
    cell, value = cell[kept], value[kept]
    if not len(cell):
        return 0
    hit, slot = np.unique(cell, return_inverse=True)
    score = np.zeros(len(hit), dtype=np.int64)
    np.add.at(score, slot, value)
    doc, query = hit // block.n_queries, hit % block.n_queries
    good = (score > 0) & (score >= floor[query])
    best.add(query[good], score[good], key[doc[good]], null[doc[good]])
    return len(hit)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row of each value, value) of a column of lists."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    return np.repeat(np.arange(len(column)), sizes), column.flatten().to_numpy(zero_copy_only=False)


def _lists(rows: list[list[int]], kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array([v for r in rows for v in r], kind))


def _counted(docs: DataFrame, vocabulary: dict[bytes, int], key: str, text: str) -> DataFrame:
    """(key, n, term, tf): terms of each document with any, and its frequencies of the queries' terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.keys()
        for batch in batches:
            keys, sizes, ids, tfs = [], [], [], []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = terms(t.as_py())
                if found:
                    counts = Counter(found)
                    shared = sorted(vocabulary[w] for w in counts.keys() & known)
                    names = {vocabulary[w]: c for w, c in counts.items() if w in known}
                    keys.append(k)
                    sizes.append(len(found))
                    ids.append(shared)
                    tfs.append([names[i] for i in shared])
            columns = [pa.array(keys, pa.int64()), pa.array(sizes, pa.int64())]
            columns += [_lists(ids, pa.int32()), _lists(tfs, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "n", "term", "tf"])

    rows = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, "key long, n long, term array<int>, tf array<long>")


def _vectors(counted: DataFrame, weight: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """(key, length, term, x): the impact vectors, at the queries' terms, of documents that have one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(1).to_numpy()
            row, term = _flat(batch.column(2))
            _, tf = _flat(batch.column(3))
            mean = _BASE - _SHARE + (_SHARE * n * n_docs) // n_terms
            x = weight[term] * ((_SCALE * tf) // (_TF * tf + _LENGTH * mean[row]))
            length = np.sqrt(np.bincount(row, weights=x.astype(np.float64) ** 2, minlength=len(n)))
            some = x > 0
            offsets = np.concatenate(([0], np.cumsum(np.bincount(row[some], minlength=len(n))))).astype(np.int32)
            lists = [
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(v))
                for v in (term[some].astype(np.int32), x[some].astype(np.int64))
            ]
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(length), *lists], names=["key", "length", "term", "x"]
            )
            yield out.filter(pa.array(length > 0))

    return counted.mapInArrow(run, "key long, length double, term array<int>, x array<long>")


def _searched(vectors: DataFrame, block: Block, floor: np.ndarray, k: int) -> DataFrame:
    """(query, score, key, scored) of each task's best documents, whose scores reach ``floor``.

    ``scored`` is set on one row of a task: the pairs that were scored exactly there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, scored = Best(block.n_queries, k, floor), 0
        for batch in batches:
            for start in range(0, batch.num_rows, BUCKET):
                part = batch.slice(start, BUCKET)
                keys = part.column(0)
                null = np.array(keys.is_null())
                length = part.column(1).to_numpy()
                row, term = _flat(part.column(2))
                _, x = _flat(part.column(3))
                key = keys.fill_null(0).to_numpy()
                scored += search_bucket(block, best, key, null, length, row, term, x)
        keys = pa.array(best.key, mask=best.null)
        counts = np.zeros(len(best.query), dtype=np.int64)
        counts[:1] = scored
        names = ["query", "score", "key", "scored"]
        yield pa.RecordBatch.from_arrays([pa.array(best.query), pa.array(best.score), keys, pa.array(counts)], names=names)

    return vectors.mapInArrow(run, "query long, score long, key long, scored long")


def _best(rows: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each query, with their rank. Map tasks cut their rows first."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _block(named: list, df: dict[int, int], size: int, n_docs: int) -> Block:
    weight = np.zeros(size, dtype=np.int64)
    for term, held in df.items():
        weight[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held + 1)))
    query = np.array([q for q, ids in enumerate(named) for _ in ids], dtype=np.int64)
    term = np.array([i for ids in named for i in ids], dtype=np.int64)
    return Block(query, term, weight, len(named))


def search(
    docs: DataFrame,
    queries: DataFrame,
    k: int = TOP,
    *,
    key: str = "doc_id",
    text: str = "text",
    query_key: str = "item_id",
    query_text: str = "text",
) -> DataFrame:
    """(query_key, rank, key, score): the ``k`` best documents of each row of ``queries``.

    Only scores above 0 count; equal scores go by the key, NULL last, and rows of one key and text by
    nothing. Queries without a term that any document has give no row, nor do NULL and empty texts;
    repeated rows of ``queries`` are queries of their own. Empty tables give no row. Other columns
    are not looked at.

    Queries are answered in blocks, each by one pass over the documents: only a block's terms and its
    scores to beat are sent to the tasks. Of a document only its length and the frequencies of the
    block's terms are kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms(t.as_py()))) for t in batch.column(1)]
            columns = [batch.column(0), pa.array(found, pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "terms"])

    asked = queries.select(F.col(f"`{query_key}`").cast("long").alias("item"), F.col(f"`{query_text}`").alias("text"))
    asked = reliable(asked.mapInArrow(run, "item long, terms array<binary>").where(F.size("terms") > 0))
    n_items, n_terms = asked.agg(F.count("*"), F.sum(F.size("terms"))).first()
    blocks = max(-(-n_items // QUERIES_IN_BLOCK), -(-(n_terms or 0) // TERMS_IN_BLOCK), 1)
    numbered = asked.withColumn("block", F.pmod(F.xxhash64("item", "terms"), F.lit(blocks)))
    out = None
    for i in range(blocks):
        # A block is bounded by its share of the queries and of their terms.
        part = numbered.where(F.col("block") == i).select("item", "terms").collect()
        found = _answer(docs, part, k, key, text) if part else _nothing(docs)
        out = found if out is None else out.unionByName(found)
    return out


def _nothing(docs: DataFrame) -> DataFrame:
    return docs.sparkSession.createDataFrame([], "item long, rank int, key long, score long")


def _answer(docs: DataFrame, asked: list, k: int, key: str, text: str) -> DataFrame:
    """One block of queries against all documents."""
    spark = docs.sparkSession
    words = sorted({bytes(w) for r in asked for w in r["terms"]})
    vocabulary = {w: i for i, w in enumerate(words)}
    named = [[vocabulary[bytes(w)] for w in r["terms"]] for r in asked]
    counted = reliable(_counted(docs, vocabulary, key, text))
    n_docs, n_terms = counted.agg(F.count("*"), F.sum("n")).first()
    held = counted.select(F.explode("term").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    block = _block(named, {r["term"]: r["df"] for r in held.collect()}, len(words), n_docs)  # as many as terms
    vectors = _vectors(counted, block.weight, n_docs, n_terms or 1)
    # Ordered by length; equal lengths are dealt out by the key and a hash of the vector.
    ordered = vectors.repartitionByRange(F.desc("length"), "key", F.xxhash64("term", "x"))
    ordered = reliable(ordered.sortWithinPartitions(F.desc("length")))
    cut = ordered.agg(F.percentile_approx("length", F.lit(1 - FIRST_SHARE), F.lit(1000))).first()[0]
    if cut is None:
        return _nothing(docs)
    longest, others = F.col("length") >= cut, F.col("length") < cut
    first = reliable(_searched(ordered.where(longest), block, np.zeros(len(asked)), k))
    first = _best(first.select("query", "score", "key"), k)
    beat = first.where(F.col("rank") == k).select("query", "score").collect()  # one row a query of the block
    floor = np.zeros(len(asked))
    for row in beat:
        floor[row["query"]] = row["score"]
    rest = _searched(ordered.where(others), block, floor, k)
    best = reliable(_best(first.select("query", "score", "key").union(rest.select("query", "score", "key")), k))
    items = spark.createDataFrame([(q, r["item"]) for q, r in enumerate(asked)], "query long, item long")
    return best.join(items, "query").select("item", "rank", "key", "score")
