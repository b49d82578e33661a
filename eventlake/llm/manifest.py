"""Merkle manifest of a dataset: one digest for a table, and proofs for each of its rows.

Rows of a group are leaves of a tree in which every eight consecutive nodes are hashed to their
parent; the groups' roots are the leaves of a last tree. A tree is built in rounds of aligned
blocks: a task makes the three levels above 512 neighbours, and only the blocks' roots go on to the
next round. A changed row makes a version of the tree that shares all nodes but the ancestors of
its leaf: those are copied inside its block, and on through the upper rounds along the path that
the block is sent, so versions cost their own depth and never meet in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.common import reliable

# Fixed value: the letters that the contract's change lower-cases.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ARITY = 8
# A block is this many levels of the tree.
LEVELS = 3
BLOCK_BITS = 9
_HEX = 64


def digest(text: str) -> str:
    """Lower-case hex sha256."""
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(fields: Sequence[Column]) -> Column:
    """The digest of a row: ``-`` for a NULL, else the length in bytes, a colon and the value."""
    texts = [f.cast("string") for f in fields]
    sized = [F.concat(F.octet_length(t).cast("string"), F.lit(":"), t) for t in texts]
    return F.sha2(F.concat(*[F.coalesce(s, F.lit("-")) for s in sized]).cast("binary"), 256)


def depth(n: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def above(nodes: list[str]) -> list[str]:
    """The parents of consecutive nodes."""
    joined, run = "".join(nodes), ARITY * _HEX
    return [digest(joined[at : at + run]) for at in range(0, len(joined), run)]


def block_levels(nodes: list[str], n: int) -> list[list[str]]:
    """The nodes of one block level by level; ``n`` nodes are on the lowest level of its whole tree."""
    levels = [nodes]
    for _ in range(min(depth(n), LEVELS)):
        levels.append(above(levels[-1]))
    return levels


def siblings(levels: list[list[str]]) -> Iterator[list[str]]:
    """For each node of the lowest level: what stands before and after its path, level by level."""
    joined = ["".join(level) for level in levels[:-1]]
    for i in range(len(levels[0])):
        path = []
        for level in joined:
            first = i // ARITY * ARITY
            path.append(level[first * _HEX : i * _HEX])
            path.append(level[(i + 1) * _HEX : (first + ARITY) * _HEX])
            i //= ARITY
        yield path


def copies(changed: str, path: list[str]) -> list[str]:
    """The nodes that a version copies: the changed leaf and its ancestors up to the root."""
    out = [changed]
    for before, after in zip(path[::2], path[1::2], strict=True):
        out.append(digest(before + out[-1] + after))
    return out


def _ordered(table: pa.Table) -> pa.Table:
    return table.sort_by("pos").combine_chunks()


def _n_above(n: int) -> int:
    return -(-n >> BLOCK_BITS) if n > 0 else 0


def _positions(rows: DataFrame, group: str, order: Sequence[Column]) -> DataFrame:
    """``rows`` with ``pos``, the place in its group, and ``n``, the size of the group.

    Rows are sorted into ranges, a group's rows into as many as it needs. Only the counts of
    (range, group) are summed up over the ranges: no group is ever in one task.
    """
    ranged = rows.repartitionByRange(F.col(group), *order).sortWithinPartitions(F.col(group), *order)
    ranged = reliable(ranged.withColumn("at", F.monotonically_increasing_id()))
    ranged = ranged.withColumn("range", F.shiftright("at", 33))
    counts = ranged.groupBy("range", group).agg(F.count("*").alias("held"), F.min("at").alias("first"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "range",
        group,
        (F.coalesce(F.sum("held").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("held").over(whole).alias("n"),
    )
    placed = ranged.join(counts, ["range", group]).withColumn("pos", F.col("at") + F.col("shift"))
    return reliable(placed.drop("at", "range", "shift"))


def _parents(nodes: DataFrame) -> DataFrame:
    """One round up: (g, pos, n, digest) of every block's root."""

    def run(block: pa.Table) -> pa.Table:
        block = _ordered(block)
        n = block["n"][0].as_py()
        root = block_levels(block["digest"].to_pylist(), n)[-1]
        if len(root) != 1:
            raise AssertionError("a block has one root")
        at = block["pos"][0].as_py() >> BLOCK_BITS
        return pa.table({"g": block["g"][:1], "pos": [at], "n": [_n_above(n)], "digest": root})

    nodes = nodes.select("g", "pos", "n", "digest").withColumn("block", F.shiftright("pos", BLOCK_BITS))
    return nodes.groupBy("g", "block").applyInArrow(run, "g string, pos long, n long, digest string")


def _paths(nodes: DataFrame, upper: DataFrame) -> DataFrame:
    """One round down: (g, pos, path, tops) of ``nodes``, whose blocks have theirs in ``upper``."""

    def run(block: pa.Table, over: pa.Table) -> pa.Table:
        block = _ordered(block)
        levels = block_levels(block["digest"].to_pylist(), block["n"][0].as_py())
        rest, tops = over["path"][0].as_py(), over["tops"][0].as_py()
        return pa.table(
            {
                "g": block["g"],
                "pos": block["pos"],
                "path": pa.array([p + rest for p in siblings(levels)], pa.list_(pa.string())),
                "tops": pa.array([tops] * block.num_rows, pa.list_(pa.string())),
            }
        )

    return _met(nodes.select("g", "pos", "n", "digest"), upper, run, "g string, pos long, path array<string>, tops array<string>")


def _met(nodes: DataFrame, upper: DataFrame, run: Callable, schema: str) -> DataFrame:
    nodes = nodes.withColumn("block", F.shiftright("pos", BLOCK_BITS)).groupBy("g", "block")
    upper = upper.select("g", F.col("pos").alias("block"), "path", "tops").groupBy("g", "block")
    return nodes.cogroup(upper).applyInArrow(run, schema)


def _rounds(nodes: DataFrame) -> list[DataFrame]:
    """``nodes`` and the rounds above them, up to one node a group."""
    most = nodes.agg(F.max("n")).first()[0]
    rounds = [nodes]
    while most is not None and (most > 1 or len(rounds) == 1):
        rounds.append(reliable(_parents(rounds[-1])))
        most = _n_above(most)
    return rounds


def _down(rounds: list[DataFrame], paths: DataFrame) -> DataFrame:
    """Paths of the blocks of the lowest round, from those of the top nodes."""
    for nodes in rounds[-2:0:-1]:
        paths = reliable(_paths(nodes, paths))
    return paths


@dataclass(frozen=True)
class Manifest:
    """A built tree: the placed rows, the rounds of each group's tree, and those over the groups."""

    leaves: DataFrame
    rounds: list[DataFrame] = field(repr=False)
    tops: list[DataFrame] = field(repr=False)

    def root(self) -> str | None:
        """The digest of the whole table; None of an empty one."""
        row = self.tops[-1].select("digest").first()
        return row["digest"] if row else None

    def subroots(self) -> DataFrame:
        """(group, digest) of each group."""
        return self.rounds[-1].select(_group_of(F.col("g")).alias("group"), "digest")

    def nodes(self) -> DataFrame:
        """(group, level, pos, digest): every node of the groups' trees, leaves at level 0."""
        found = None
        for i, nodes in enumerate(self.rounds[:-1]):
            blocks = nodes.select("g", "pos", "n", "digest").withColumn("block", F.shiftright("pos", BLOCK_BITS))
            blocks = blocks.groupBy("g", "block")
            some = blocks.applyInArrow(_shown_above(LEVELS * i), "g string, level int, pos long, digest string")
            found = some if found is None else found.unionByName(some)
        return found.select(_group_of(F.col("g")).alias("group"), "level", "pos", "digest")

    def proofs(self) -> DataFrame:
        """One row of each row of the table: (key, group, pos, leaf, subroot, root, proof, changed,
        copied, folded_root, verified).

        ``proof`` is all siblings from the leaf to the root, as one text. ``changed`` is the leaf of
        the changed row; where it differs, ``copied`` has the nodes of the version that it makes, from
        the leaf to the root, and is NULL elsewhere. ``folded_root`` is the root that the leaf, changed
        or not, and the siblings lead to.
        """

        def run(block: pa.Table, over: pa.Table) -> pa.Table:
            block = _ordered(block)
            leaves, others = block["digest"].to_pylist(), block["changed"].to_pylist()
            levels = block_levels(leaves, block["n"][0].as_py())
            rest, tops = over["path"][0].as_py(), over["tops"][0].as_py()
            proofs, versions, folded = [], [], []
            for mine, other, path in zip(leaves, others, siblings(levels), strict=True):
                path = path + rest
                nodes = copies(other, path)
                proofs.append("".join(path))
                versions.append(nodes if other != mine else None)
                folded.append(nodes[-1])
            n = block.num_rows
            return pa.table(
                {
                    "key": block["key"],
                    "g": block["g"],
                    "pos": block["pos"],
                    "leaf": block["digest"],
                    "subroot": pa.array([tops[0]] * n, pa.string()),
                    "root": pa.array([tops[-1]] * n, pa.string()),
                    "proof": pa.array(proofs, pa.string()),
                    "changed": block["changed"],
                    "copied": pa.array(versions, pa.list_(pa.string())),
                    "folded_root": pa.array(folded, pa.string()),
                }
            )

        above_all = _down(self.tops, self._apex())
        own = self.tops[0].select("g", "pos", "n", "digest", "member")
        paths = _paths_of_groups(own, above_all)
        paths = _down(self.rounds, reliable(paths))
        schema = (
            "key long, g string, pos long, leaf string, subroot string, root string, proof string, "
            "changed string, copied array<string>, folded_root string"
        )
        rows = _met(self.leaves.select("key", "g", "pos", "n", "digest", "changed"), paths, run, schema)
        verified = (F.col("folded_root") == F.col("root")).alias("verified")
        return rows.select("key", _group_of(F.col("g")).alias("group"), *rows.columns[2:], verified)

    def _apex(self) -> DataFrame:
        """The root has no siblings."""
        return self.tops[-1].select(
            "g", "pos", F.array().cast("array<string>").alias("path"), F.array("digest").alias("tops")
        )


def _paths_of_groups(nodes: DataFrame, upper: DataFrame) -> DataFrame:
    """(g, pos, path, tops) of each group's root, ``tops`` its own digest and that of the whole."""

    def run(block: pa.Table, over: pa.Table) -> pa.Table:
        block = _ordered(block)
        levels = block_levels(block["digest"].to_pylist(), block["n"][0].as_py())
        rest, tops = over["path"][0].as_py(), over["tops"][0].as_py()
        names = block["digest"].to_pylist()
        return pa.table(
            {
                "g": block["member"],
                "pos": pa.array([0] * block.num_rows, pa.int64()),
                "path": pa.array([p + rest for p in siblings(levels)], pa.list_(pa.string())),
                "tops": pa.array([[name, tops[-1]] for name in names], pa.list_(pa.string())),
            }
        )

    return _met(nodes, upper, run, "g string, pos long, path array<string>, tops array<string>")


def _shown_above(base: int) -> Callable[[pa.Table], pa.Table]:
    """The nodes of a block whose lowest level is ``base``."""

    def run(block: pa.Table) -> pa.Table:
        block = _ordered(block)
        first, n = block["pos"][0].as_py(), block["n"][0].as_py()
        levels = block_levels(block["digest"].to_pylist(), n)
        # A block's root is the next round's node, but that of a whole tree; a lone node came up so.
        shown = levels if _n_above(n) == 1 else levels[:-1]
        shown = [] if base and n == 1 else shown
        rows = [(base + at, (first >> 3 * at) + j, node) for at, level in enumerate(shown) for j, node in enumerate(level)]
        columns = list(zip(*rows, strict=True)) or [[], [], []]
        kinds = (pa.int32(), pa.int64(), pa.string())
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        name = pa.array([block["g"][0].as_py()] * len(rows), pa.string())
        return pa.Table.from_arrays([name, *arrays], names=["g", "level", "pos", "digest"])

    return run


def _group_name(group: Column) -> Column:
    """A name for each group that is never NULL, in the order of the groups, NULL first."""
    return F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), group.cast("string")))


def _group_of(name: Column) -> Column:
    return F.when(name != "", F.expr("substring(g, 2)"))


def build(
    docs: DataFrame,
    *,
    order: str,
    group: str,
    fields: Sequence[str],
    changed: dict[str, Column] | None = None,
) -> Manifest:
    """The manifest of ``docs``: leaves hash ``fields``, ascend by ``order`` within each ``group``.

    ``changed`` has, by name, expressions for fields of another version of each row; ``proofs`` holds
    those rows against the tree. NULL is a group and a value like others and the first one of an
    order. Rows of equal order ascend by their leaves; repeated rows are leaves of their own. Only
    the named columns are looked at, whatever the others are called. A text of any length is hashed
    where it is read, and only digests are moved. An empty table has no rows and no root.
    """
    now = {f: F.col(f"`{f}`") for f in fields}
    other = {**now, **(changed or {})}
    rows = docs.select(
        F.col(f"`{order}`").cast("long").alias("key"),
        _group_name(F.col(f"`{group}`")).alias("g"),
        leaf(list(now.values())).alias("digest"),
        leaf([other[f] for f in fields]).alias("changed"),
    )
    keyed = [F.asc_nulls_first("key"), F.col("digest"), F.col("changed")]
    leaves = _positions(reliable(rows), "g", keyed)
    rounds = _rounds(leaves)
    if len(rounds) == 1:  # no row at all
        rounds.append(rounds[0].select("g", "pos", "n", "digest"))
    groups = rounds[-1].select(F.lit("").alias("g"), F.col("g").alias("member"), "digest")
    tops = _rounds(_positions(groups, "g", [F.col("member")]))
    if len(tops) == 1:
        tops.append(tops[0].select("g", "pos", "n", "digest"))
    return Manifest(leaves, rounds, tops)
