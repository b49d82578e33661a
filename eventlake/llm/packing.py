"""Hierarchical multi-length packing of documents into training sequences."""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.tokens import word_bpe

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
WINDOWS = (128, 256, 512, 1024, 2048)
# Tokens that a task collects before it packs, and keeps back for the next round.
POOL = 1 << 20
REST = 1 << 14
# Tokens of a step group: every full group of sequences has exactly so many.
STEP = 1 << 16
_FLUSH = 2000
_PART = 33

SCHEMA = (
    "sequence_id long, window int, n_tokens int, step_id long, ids binary, "
    "pieces array<struct<key: long, start: long, length: long, doc_tokens: long, offset: long>>"
)
_PIECE = pa.struct([(n, pa.int64()) for n in ("key", "start", "length", "doc_tokens", "offset")])
_ARROW = pa.schema(
    [
        ("sequence_id", pa.int64()),
        ("window", pa.int32()),
        ("n_tokens", pa.int32()),
        ("step_id", pa.int64()),
        ("ids", pa.binary()),
        ("pieces", pa.list_(_PIECE)),
    ]
)


class Piece:
    """Some consecutive ids of a document."""

    __slots__ = ("key", "start", "ids", "total")

    def __init__(self, key: int | None, start: int, ids: np.ndarray, total: int):
        self.key, self.start, self.ids, self.total = key, start, ids, total

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.key, self.start, self.ids[:n], self.total),
            Piece(self.key, self.start + n, self.ids[n:], self.total),
        )


class Packer:
    """Packs the documents of one task, holding some ``POOL`` tokens at most at a time.

    A document's full windows of the largest size leave at once. What is left of it is routed to
    the smallest window that holds it. From the longest on, each such rest opens a window of its
    tier, whose gap the longest fitting rests of the same and shorter tiers fill; a last gap takes
    the start of the shortest rest. So all windows are full but for the task's very last tokens,
    which go to windows of falling size and one padded sequence.
    """

    def __init__(self, windows: tuple[int, ...] = WINDOWS, pool: int = POOL, step: int = STEP):
        self.windows, self.pool, self.rest, self.step = windows, pool, min(REST, pool // 4), step
        self.rests: list[tuple[int, int, Piece]] = []
        self.held = self.arrivals = 0
        self.done: list[tuple[int, list[Piece]]] = []

    def add(self, key: int | None, ids: np.ndarray) -> None:
        largest, at = self.windows[-1], 0
        while len(ids) - at >= largest:
            self.done.append((largest, [Piece(key, at, ids[at : at + largest], len(ids))]))
            at += largest
        if at < len(ids):
            self._put(Piece(key, at, ids[at:].copy(), len(ids)))
        if self.held >= self.pool:
            self._pack(self.rest)

    def finish(self) -> None:
        self._pack(0)

    def _put(self, piece: Piece) -> None:
        # By length, then by order of arrival.
        insort(self.rests, (len(piece.ids), self.arrivals, piece), key=lambda r: r[:2])
        self.arrivals += 1
        self.held += len(piece.ids)

    def _take(self, at: int) -> Piece:
        length, _, piece = self.rests.pop(at)
        self.held -= length
        return piece

    def _pack(self, keep: int) -> None:
        while self.rests and self.held > keep:
            first = self._take(len(self.rests) - 1)
            window = next(w for w in self.windows if w >= len(first.ids))
            pieces, gap = [first], window - len(first.ids)
            while gap and self.rests:
                at = bisect_right(self.rests, gap, key=lambda r: r[0]) - 1
                if at < 0:
                    head, tail = self._take(0).cut(gap)
                    self._put(tail)
                    pieces.append(head)
                    gap = 0
                else:
                    pieces.append(self._take(at))
                    gap -= len(pieces[-1].ids)
            if not gap:
                self.done.append((window, pieces))
            elif keep:
                for piece in pieces:
                    self._put(piece)
                return
            else:
                self._tail(pieces)

    def _tail(self, pieces: list[Piece]) -> None:
        """The task's last tokens: full windows of falling size, the rest padded to the largest."""
        left = sum(len(p.ids) for p in pieces)
        while left:
            window = next((w for w in reversed(self.windows) if w <= left), None)
            room, part = window or left, []
            left -= room
            while room:
                piece = pieces.pop(0)
                if len(piece.ids) > room:
                    piece, rest = piece.cut(room)
                    pieces.insert(0, rest)
                part.append(piece)
                room -= len(piece.ids)
            self.done.append((window or self.windows[-1], part))


class Steps:
    """Deals sequences to step groups of equal token counts, the fullest that has room first."""

    def __init__(self, size: int):
        self.size, self.open, self.n = size, [], 0

    def place(self, window: int) -> int:
        fits = [g for g in self.open if g[0] >= window]
        group = min(fits) if fits else [self.size, self.n]
        if not fits:
            self.open.append(group)
            self.n += 1
        group[0] -= window
        if not group[0]:
            self.open.remove(group)
        return group[1]


def pack(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    vocabulary: str | None = None,
    end_id: int = END_ID,
    windows: tuple[int, ...] = WINDOWS,
) -> DataFrame:
    """Sequences of whole tables and texts: ``SCHEMA``, ids as little-endian unsigned 32-bit.

    Every task packs its own rows, so there is no shuffle, and no task holds more than its pool
    and one document. A NULL or empty text has the end id alone; repeated rows are packed each; an
    empty table gives no row. ``window`` is what a sequence is padded to, its own length wherever
    that is one of ``windows``.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << _PART
        encoder, packer, steps, n = word_bpe(path), Packer(windows), Steps(STEP), 0

        def flush() -> pa.RecordBatch:
            nonlocal n
            rows = []
            for window, pieces in packer.done:
                ids, spans, offset = b"".join(p.ids.tobytes() for p in pieces), [], 0
                for p in pieces:
                    spans.append(
                        {"key": p.key, "start": p.start, "length": len(p.ids), "doc_tokens": p.total, "offset": offset}
                    )
                    offset += len(p.ids)
                rows.append(
                    {
                        "sequence_id": part + n,
                        "window": window,
                        "n_tokens": offset,
                        "step_id": part + steps.place(window),
                        "ids": ids,
                        "pieces": spans,
                    }
                )
                n += 1
            packer.done = []
            return pa.RecordBatch.from_pylist(rows, schema=_ARROW)

        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(encoder.encode(t.as_py() or ""), np.uint32(end_id)).astype("<u4")
                packer.add(k, ids)
                if len(packer.done) >= _FLUSH:
                    yield flush()
        packer.finish()
        if packer.done:
            yield flush()

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def pieces(sequences: DataFrame) -> DataFrame:
    """One row per piece of the sequences, with its ids."""
    rows = sequences.select("sequence_id", "window", "n_tokens", "step_id", "ids", F.explode("pieces").alias("p"))
    ids = F.expr("substring(ids, CAST(p.offset * 4 + 1 AS INT), CAST(p.length * 4 AS INT))")
    return rows.select("sequence_id", "window", "n_tokens", "step_id", "p.*", ids.alias("ids"))
