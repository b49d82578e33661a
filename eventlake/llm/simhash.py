"""SimHash near-duplicates: fingerprints of word shingles, linked through pigeonhole blocks."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import components, least_rows, reliable, text_hash

SHINGLE = 3
DISTANCE = 2
BITS = 64
# Fixed value: the seed of the shingle hash.
SEED = 42
# A block with more fingerprints than this is not joined with itself but cut again, see `links`.
HOT_BLOCK = 256
# Hashes of one text that are held as bits at a time, to bound memory on very long texts.
_SLICE = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Majority vote of the bits of all shingle hashes; 0 without a word."""
    if not text:
        return 0
    # On bytes, lower() and split() know A-Z and the six ASCII blanks only, as the contract does.
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), dtype="<u8", count=len(words) - shingle + 1)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), _SLICE):
        part = hashes[at : at + _SLICE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp): the fingerprint of each row as a signed long. No shuffle."""
    schema = pa.schema([("key", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py()) for t in batch.column(1)], dtype=np.uint64)
            yield pa.record_batch([batch.column(0), pa.array(found.view(np.int64))], schema=schema)

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, "key long, fp long")


def _masks(blocks: int, intact: int, bits: list[int]) -> list[int]:
    """Bit masks of every choice of ``intact`` out of ``blocks`` even cuts of ``bits``."""
    cuts = [sum(1 << b for b in part) for part in np.array_split(bits, blocks)]
    return [_signed(sum(choice)) for choice in combinations(map(int, cuts), intact)]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs (u, v), u < v, that link all distinct ``fp`` within ``distance`` bits as they should be.

    A fingerprint is cut into ``distance + 2`` blocks. Two that differ in at most ``distance`` bits
    agree in two whole blocks at least, so each choice of two blocks is a key: candidates share a
    key, and the join verifies their distance. A key that many fingerprints share would make the
    join quadratic. Such a key's members are cut again, by all single-bit changes of the rest: two
    that differ in at most two bits have a neighbour in common, and all neighbours of one value are
    within two bits of each other, so each is linked to the least of them. That is exact too, and
    linear: no cap, no lost link (for ``distance`` 2; other distances only know the first way).
    """
    masks = _masks(distance + 2, 2, list(range(BITS)))
    fps = fps.select("fp").distinct()
    keys = [
        F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(m)).alias("k"))
        for i, m in enumerate(masks)
    ]
    keyed = fps.select("fp", F.explode(F.array(*keys)).alias("b")).select("fp", "b.i", "b.k")
    if distance != 2:
        return _verified(keyed, distance)
    sizes = keyed.groupBy("i", "k").agg(F.count("*").alias("n")).where("n > 1")
    shared = reliable(keyed.join(sizes, ["i", "k"]))
    close = _verified(shared.where(F.col("n") <= HOT_BLOCK), distance)
    # The middle of two fingerprints agrees with both in the key's blocks, so only the other bits
    # are changed; a fingerprint is its own neighbour, too.
    rest = F.element_at(F.array(*[F.lit(~m) for m in masks]), F.col("i") + 1)
    single = F.array(*[F.lit(_signed(1 << b)) for b in range(BITS)])
    changed = F.filter(single, lambda bit: bit.bitwiseAND(rest) != 0)
    near = F.concat(F.array(F.col("fp")), F.transform(changed, lambda bit: F.col("fp").bitwiseXOR(bit)))
    middle = shared.where(F.col("n") > HOT_BLOCK).select("fp", F.explode(near).alias("middle"))
    least = middle.groupBy("middle").agg(F.min("fp").alias("least"), F.max("fp").alias("most")).where("least <> most")
    hot = middle.join(least, "middle").where("fp <> least").select(F.col("least").alias("u"), F.col("fp").alias("v"))
    return close.union(hot).distinct()


def _verified(keyed: DataFrame, distance: int) -> DataFrame:
    a, b = keyed.select("i", "k", F.col("fp").alias("u")), keyed.select("i", "k", F.col("fp").alias("v"))
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance
    return a.join(b, ["i", "k"]).where((F.col("u") < F.col("v")) & near).select("u", "v").distinct()


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", distance: int = DISTANCE) -> DataFrame:
    """One row per row of ``docs``: (key, fp, component), component the least key reachable.

    Rows with equal fingerprints are one node, however many they are, so a group of copies adds
    one fingerprint. NULL and wordless texts have fingerprint 0 and are linked like others; rows
    with equal keys stay apart; a NULL key is never a component unless it stands alone. An empty
    table gives no row.
    """
    prints = reliable(fingerprints(docs, key, text))
    nodes = reliable(prints.groupBy("fp").agg(F.min("key").alias("first")))
    rooted = components(links(nodes, distance)).withColumnRenamed("node", "fp")
    nodes = nodes.join(rooted, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = nodes.groupBy("component").agg(F.min("first").alias("least"))
    named = nodes.join(least, "component").select("fp", "least")
    return prints.join(named, "fp").select("key", "fp", F.col("least").alias("component"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate component: that of the least key, NULL the last.

    Keys only order rows: other texts with the same or no key are documents of their own. Of several
    rows with the least key the one of the least text hash stays, of equal ones any. Other columns stay
    as they are, whatever they are called.
    """
    rows = docs.select(
        F.col(f"`{key}`").cast("long").alias("key"), text_hash(text).alias("hash"), F.col(f"`{text}`").alias("text")
    )
    named = classes(rows, "hash", "text").select(F.col("key").alias("hash"), "component").distinct()
    return least_rows(docs, rows.select("key", "hash").distinct().join(named, "hash"), key, text)
