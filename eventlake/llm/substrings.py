"""Exact repeated substrings by difference-cover samples: names, longer names, merged suffixes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import reliable
from eventlake.session import scratch_dir

WINDOW = 200
# A perfect difference set. Every shift modulo PERIOD is the difference of two of
# its members, so wherever two equal strings lie, some place within PERIOD bytes of their starts
# is sampled in both.
PERIOD = 133
COVER = (1, 10, 11, 13, 27, 31, 68, 75, 83, 110, 115, 121)
# Bytes of text that are worked on at a time, and of a part, the unit of the lookups.
BATCH = 1 << 20
PART = 8 << 20
# Bytes of text for each bucket of the working table; hashes for each task of a lookup.
BUCKET_BYTES = 13 << 20
NAMES_PER_TASK = 1 << 20
_PART_BITS = 20

# What travels of a hash in each round. A name of round 0 only makes a place worth a closer look,
# so a few that agree by chance (one in thousands, at any size of the input, since the number of
# tasks grows with it) cost little; what decides is told apart by all 64 bits.
_WIDTHS = ("<u4", "<u8", "<u8")
_FIRST, _REPEATED = 1, 2
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class Hashes:
    """Hashes of all substrings of a buffer, any length in constant time: 64 bits, polynomial."""

    base = 0xD6E8FEB86659FD93
    values = np.random.default_rng(200).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    powers = inverse = np.ones(1, dtype=np.uint64)

    def __init__(self, buffer: np.ndarray):
        n = len(buffer)
        if len(Hashes.powers) <= n:
            for name, b in (("powers", self.base), ("inverse", pow(self.base, -1, 1 << 64))):
                steps = np.full(n + 1, b, dtype=np.uint64)
                steps[0] = 1
                setattr(Hashes, name, np.multiply.accumulate(steps))
        self.buffer = buffer
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self.values[buffer] * self.powers[:n], out=self.sums[1:])

    def at(self, starts: np.ndarray, length: int) -> np.ndarray:
        h = (self.sums[starts + length] - self.sums[starts]) * self.inverse[starts]
        h ^= h >> np.uint64(29)
        h *= _MULTIPLIER
        return h ^ (h >> np.uint64(32))

    def deal(self, starts: np.ndarray, length: int) -> np.ndarray:
        """Another hash, of a few bytes of the substrings, to deal them to tasks by."""
        mix = np.zeros(len(starts), dtype=np.uint64)
        for i in range(0, length, max(1, length // 6)):
            mix = (mix ^ self.buffer[starts + i]) * _MULTIPLIER
            mix ^= mix >> np.uint64(32)
        return mix


class Batch:
    """Some whole documents in one buffer, and what the lookups have told about them so far.

    ``lists`` gives, round by round, the substrings to look up; each round needs the answers to
    those before it. All of it is a function of the documents, so any task can take it up again.
    """

    def __init__(self, lengths: np.ndarray, blob: bytes, window: int = WINDOW):
        self.window, self.name = window, window - PERIOD + 1
        self.n, self.lengths = len(blob), lengths
        self.hashes = Hashes(np.frombuffer(blob, dtype=np.uint8))
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)
        self.starts = starts
        place = np.arange(self.n) - np.repeat(starts, lengths)
        self.left = np.repeat(lengths, lengths) - place
        sampled = np.zeros(PERIOD, dtype=bool)
        sampled[list(COVER)] = True
        self.samples = np.flatnonzero(sampled[place % PERIOD] & (self.left >= self.name))
        self.place = place

    def _reach(self, marked: np.ndarray) -> np.ndarray:
        """True at the starts of windows that have a marked place within ``PERIOD`` bytes."""
        sums = np.zeros(self.n + PERIOD + 1, dtype=np.int32)
        sums[1 : self.n + 1][marked] = 1
        np.cumsum(sums, out=sums)
        return (sums[PERIOD : self.n + PERIOD] > sums[: self.n]) & (self.left >= self.window)

    def lists(self, answers: list[np.ndarray]) -> tuple[np.ndarray, int]:
        """(starts, length) of the substrings of the round after ``answers``; or the windows found.

        Round 0 names the samples: strings that share a window share a name of ``name`` bytes at a
        common sample. Round 1 names the samples again by all the bytes of the ``PERIOD`` windows
        around them: one repeated name settles them all. Round 2 merges what is left: windows near
        a repeated name of round 0 that no name of round 1 settled, together with the windows of
        the first of each class that was settled, by their whole ``window`` bytes.
        """
        if not answers:
            return self.samples, self.name
        named = self.samples[(answers[0] & _REPEATED) > 0]
        whole = (self.place[named] >= PERIOD - 1) & (self.left[named] >= self.window)
        long = named[whole] - (PERIOD - 1)
        if len(answers) == 1:
            return long, PERIOD - 1 + self.window
        repeated = (answers[1] & _REPEATED) > 0
        settled = self._reach(long[repeated] + PERIOD - 1)
        first = self._reach(long[repeated & ((answers[1] & _FIRST) > 0)] + PERIOD - 1)
        rest = np.flatnonzero((self._reach(named) & ~settled) | first)
        if len(answers) == 2:
            return rest, self.window
        settled[rest[(answers[2] & _REPEATED) > 0]] = True
        return np.flatnonzero(settled), self.window

    def removed(self, answers: list[np.ndarray]) -> np.ndarray:
        """A flag for each byte: covered by a window that also starts elsewhere."""
        starts, length = self.lists(answers)
        edges = np.zeros(self.n + 1, dtype=np.int32)
        np.add.at(edges, starts, 1)
        np.add.at(edges, starts + length, -1)
        return np.cumsum(edges[:-1]) > 0


class Asked:
    """The distinct hashes of a batch's list, dealt to tasks, and the way back to the list."""

    def __init__(self, batch: Batch, answers: list[np.ndarray], tasks: int):
        starts, length = batch.lists(answers)
        hashes = batch.hashes.at(starts, length)
        self.n = len(starts)
        _, where, self.back, counts = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
        self.twice = counts > 1
        # The place of a class's first member, to tell it from the others.
        self.first = np.zeros(self.n, dtype=bool)
        self.first[where] = True
        task = (batch.hashes.deal(starts[where], length) % np.uint64(tasks)).astype(np.int64)
        self.order = np.argsort(task, kind="stable")
        self.task, self.hashes = task[self.order], hashes[where][self.order]

    def answer(self, found: dict[int, bytes]) -> np.ndarray:
        """Flags for the list, from the flags that the tasks sent back."""
        flags = np.zeros(len(self.order), dtype=np.uint8)
        for task, blob in found.items():
            flags[np.searchsorted(self.task, task) : np.searchsorted(self.task, task, "right")] = np.frombuffer(blob, dtype=np.uint8)
        own = np.zeros(len(self.order), dtype=np.uint8)
        own[self.order] = flags
        own |= self.twice.astype(np.uint8) * np.uint8(_REPEATED)
        out = own[self.back]
        return np.where(self.first, out, out & ~np.uint8(_FIRST))


_ROWS = "part long, batch int, keys array<bigint>, lengths array<bigint>, blob binary"


def _batched(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Documents as rows of whole-text batches; a longer document is a batch of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, size = TaskContext.get().partitionId() << _PART_BITS, 0, 0
        keys: list[int | None] = []
        texts: list[bytes] = []

        def row() -> pa.RecordBatch:
            lengths = [len(t) for t in texts]
            columns = {"part": [part], "batch": [n], "keys": [keys], "lengths": [lengths], "blob": [b"".join(texts)]}
            kinds = (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
            return pa.RecordBatch.from_pydict({c: pa.array(v, k) for (c, v), k in zip(columns.items(), kinds, strict=True)})

        held = 0
        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = (t.as_py() or "").encode("utf-8", "surrogatepass")
                if texts and held + len(raw) > BATCH:
                    yield row()
                    size, n = size + held, n + 1
                    keys, texts, held = [], [], 0
                    if size >= PART:
                        part, n, size = part + 1, 0, 0
                keys.append(k)
                texts.append(raw)
                held += len(raw)
        if texts:
            yield row()

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, _ROWS)


def _told(table: pa.Table) -> dict[int, dict[int, dict[int, bytes]]]:
    """Answers by batch, round and task."""
    told: dict[int, dict[int, dict[int, bytes]]] = {}
    for r in table.select(["batch", "round", "task", "flags"]).to_pylist():
        told.setdefault(r["batch"], {}).setdefault(r["round"], {})[r["task"]] = r["flags"]
    return told


def _resumed(row: dict, told: dict, rounds: int, tasks: list[int], window: int) -> tuple[Batch, list[np.ndarray]]:
    """A batch with its answers of the first ``rounds`` rounds."""
    batch = Batch(np.array(row["lengths"], dtype=np.int64), row["blob"], window)
    answers: list[np.ndarray] = []
    for i in range(rounds):
        answers.append(Asked(batch, answers, tasks[i]).answer(told.get(row["batch"], {}).get(i, {})))
    return batch, answers


def _ask(blobs: DataFrame, told: DataFrame | None, tasks: list[int], window: int) -> DataFrame:
    """(task, part, batch, hashes): the next round's distinct hashes of each batch."""
    rounds = len(tasks) - 1
    schema = "task long, part long, batch int, hashes binary"

    def asked(row: dict, found: dict) -> Iterator[dict]:
        ask = Asked(*_resumed(row, found, rounds, tasks, window), tasks[-1])
        cuts = np.flatnonzero(np.diff(ask.task)) + 1
        for task, part in zip(np.split(ask.task, cuts), np.split(ask.hashes, cuts), strict=True):
            if len(part):
                yield {"task": int(task[0]), "part": row["part"], "batch": row["batch"], "hashes": part.astype(_WIDTHS[rounds]).tobytes()}

    def arrow(rows: Iterator[dict]) -> pa.Table:
        kinds = [("task", pa.int64()), ("part", pa.int64()), ("batch", pa.int32()), ("hashes", pa.binary())]
        return pa.Table.from_pylist(list(rows), schema=pa.schema(kinds))

    if told is None:

        def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    yield from arrow(asked(batch.slice(i, 1).to_pylist()[0], {})).to_batches()

        return blobs.mapInArrow(first, schema)

    def later(mine: pa.Table, answers: pa.Table) -> pa.Table:
        found = _told(answers)
        parts = [arrow(asked(mine.slice(i, 1).to_pylist()[0], found)) for i in range(mine.num_rows)]
        return pa.concat_tables(parts) if parts else arrow(iter(()))

    return blobs.groupBy("part").cogroup(told.groupBy("part")).applyInArrow(later, schema)


def _lookup(asked: DataFrame, this: int) -> DataFrame:
    """(part, batch, round, task, flags) for each row of ``asked``: a flag for each of its hashes.

    A task gets each hash at most once from a batch, so a passage that most documents hold is as
    many hashes there as there are batches. Sorting brings equal names together; the first batch
    of a class is marked.
    """

    def match(table: pa.Table) -> pa.Table:
        table = table.sort_by([("part", "ascending"), ("batch", "ascending")])
        blobs = table["hashes"].to_pylist()
        hashes = np.frombuffer(b"".join(blobs), dtype=_WIDTHS[this])
        order = np.argsort(hashes, kind="stable")
        ranked = hashes[order]
        same = ranked[1:] == ranked[:-1]
        flags = np.zeros(len(hashes), dtype=np.uint8)
        flags[order[1:][same]] = _REPEATED
        flags[order[:-1][same]] |= np.uint8(_REPEATED)
        flags[order[np.concatenate(([True], ~same))]] |= np.uint8(_FIRST)
        cuts = np.cumsum([len(b) // hashes.itemsize for b in blobs])[:-1]
        return pa.table(
            {
                "part": table["part"],
                "batch": table["batch"],
                "round": pa.array([this] * len(blobs), pa.int32()),
                "task": table["task"],
                "flags": pa.array([f.tobytes() for f in np.split(flags, cuts)], pa.binary()),
            }
        )

    return asked.groupBy("task").applyInArrow(match, "part long, batch int, round int, task long, flags binary")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: (key, n_bytes, spans, kept).

    ``spans`` are the maximal runs (start, end) of UTF-8 bytes covered by a string of ``window``
    bytes that also starts anywhere else, overlapping or not, in this text or another; ``kept`` are
    the other bytes. Strings are judged on the input and never cross texts. A NULL text is empty;
    repeated rows are copies of each other, with their NULL or equal keys; an empty table gives no
    row. ``window`` is more than ``PERIOD``.

    The texts are written once, in batches, to a bucketed table in the shared folder, and stay
    where they are: only hashes travel, and the answers to them. That is a difference-cover
    suffix sort cut off at ``window`` bytes: names of the sampled places' prefixes by sorting, names
    of longer ones from those that repeat, then the merge of the remaining suffixes with adjacent
    equal prefixes. What decides are
    hashes of 64 bits, compared only among strings that agree in some of their bytes, too.
    """
    if window <= PERIOD:
        raise ValueError(f"window must be more than {PERIOD}")
    spark = docs.sparkSession
    name = f"eventlake_{uuid.uuid4().hex}"
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    buckets = int(max(8, min(100_000, size // BUCKET_BYTES)))
    writer = _batched(docs, key, text).write.format("parquet").option("compression", "zstd")
    writer = writer.option("path", scratch_dir(spark, "substrings")).bucketBy(buckets, "part")
    writer.saveAsTable(name)
    blobs = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # an external one: its files stay, and nothing is left in the catalog
    # A window's first places are sampled at nearly a tenth of all; what repeats is less than that.
    tasks, told = [], None
    for i in range(3):
        tasks.append(int(max(16, size // 13 // NAMES_PER_TASK)))
        answers = reliable(_lookup(_ask(blobs, told, list(tasks), window), i))
        told = answers if told is None else told.union(answers)

    def cut(mine: pa.Table, answers: pa.Table) -> pa.Table:
        found, out = _told(answers), []
        for i in range(mine.num_rows):
            row = mine.slice(i, 1).to_pylist()[0]
            batch, all_answers = _resumed(row, found, len(tasks), tasks, window)
            gone = batch.removed(all_answers)
            raw = np.frombuffer(row["blob"], dtype=np.uint8)
            for k, start, length in zip(row["keys"], batch.starts, batch.lengths, strict=True):
                own = gone[start : start + length]
                edges = np.flatnonzero(np.diff(np.concatenate(([False], own, [False])).astype(np.int8)))
                spans = [{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)]
                out.append({"key": k, "n_bytes": int(length), "spans": spans, "kept": raw[start : start + length][~own].tobytes()})
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        kinds = [("key", pa.int64()), ("n_bytes", pa.int64()), ("spans", pa.list_(span)), ("kept", pa.binary())]
        return pa.Table.from_pylist(out, schema=pa.schema(kinds))

    schema = "key long, n_bytes long, spans array<struct<start: bigint, end: bigint>>, kept binary"
    return blobs.groupBy("part").cogroup(told.groupBy("part")).applyInArrow(cut, schema)
