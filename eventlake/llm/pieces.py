"""SentencePiece BPE encoding that keeps offsets, and decoding.

A text is normalised by longest prefixes of the model's compiled character map, and each byte of
the result remembers where in the text it came from. Byte pairs are merged over the normalised
text, and every piece is projected back to the bytes of the text that it stands for. Texts never
leave their task and nothing is shuffled.
"""

from __future__ import annotations

import codecs
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The sign that stands for a blank, what the unknown piece is decoded to, the kinds
# of pieces, and the field numbers of a model file that are read here.
BLANK = "▁"
_BLANK = BLANK.encode()
_UNKNOWN_TEXT = " ⁇ ".encode()
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_MODEL_TYPE, _BPE, _SUFFIX = 3, 2, 24
_CHARMAP, _DUMMY, _SQUEEZE, _ESCAPE = 2, 3, 4, 5

# Longer runs without a blank are merged with a heap: the other way is quadratic in them.
LONG_WORD = 256
# Bytes of text that are encoded before their rows are handed on, to bound memory.
_HANDED_ON = 2 << 20


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(message):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
            continue
        size = number() if kind == 2 else {1: 8, 5: 4}[kind]
        yield tag >> 3, message[at : at + size]
        at += size


class CharacterMap:
    """Replacements of byte strings, from a compiled map: a double-array trie and its texts.

    A unit of the trie holds a label (8 bits and the top bit), whether a value follows (bit 8), and
    the offset of its children (bits 10 and up, times 256 if bit 9 is set).
    """

    def __init__(self, blob: bytes):
        self.units: list[int] = []
        self.texts = b""
        self.starts = None
        if blob:
            size = int.from_bytes(blob[:4], "little")
            self.units = np.frombuffer(blob[4 : 4 + size], dtype="<u4").tolist()
            self.texts = blob[4 + size :]
            root = self._children(0, self.units[0])
            firsts = [b for b in range(256) if self.units[root ^ b] & 0x800000FF == b]
            self.starts = re.compile(b"[" + b"".join(re.escape(bytes([b])) for b in firsts) + b"]")

    @staticmethod
    def _children(at: int, unit: int) -> int:
        return at ^ ((unit >> 10) << ((unit & 0x200) >> 6))

    def longest(self, text: bytes, start: int) -> tuple[int, bytes] | None:
        """End and replacement of the longest key that ``text`` has at ``start``."""
        units, found = self.units, None
        node = self._children(0, units[0])
        for at in range(start, len(text)):
            node ^= text[at]
            unit = units[node]
            if unit & 0x800000FF != text[at]:
                break
            node = self._children(node, unit)
            if unit & 0x100:
                found = (at + 1, units[node] & 0x7FFFFFFF)
        if found is None:
            return None
        end, value = found
        return end, self.texts[value : self.texts.index(b"\0", value)]


@dataclass(frozen=True)
class Encoded:
    """Ids of a text, and of each piece the bytes ``start`` to ``end`` of the text that it covers."""

    ids: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


class Model:
    """A SentencePiece BPE model with byte fallback, read from its file."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self._read(file.read())
        self._prepare()

    # -- the file --------------------------------------------------------------------------

    def _read(self, content: bytes) -> None:
        self.pieces: list[tuple[str, float, int]] = []
        trainer: dict = {}
        spec: dict = {}
        for field, value in _fields(content):
            if field == _PIECES:
                piece = dict(_fields(value))
                score = float(np.frombuffer(piece.get(2, bytes(4)), dtype="<f4")[0])
                self.pieces.append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
            elif field == _TRAINER:
                trainer = dict(_fields(value))
            elif field == _NORMALIZER:
                spec.update(_fields(value))
        kinds = {kind for _, _, kind in self.pieces}
        byte_ids = [i for i, (_, _, kind) in enumerate(self.pieces) if kind == BYTE]
        if trainer.get(_MODEL_TYPE) != _BPE or len(byte_ids) != 256 or kinds & {USER, UNUSED} or trainer.get(_SUFFIX):
            raise ValueError("not a BPE model with byte fallback, blanks before words and plain pieces only")
        self.charmap = CharacterMap(spec.get(_CHARMAP, b""))
        self.dummy = bool(spec.get(_DUMMY, 1))
        self.squeeze = bool(spec.get(_SQUEEZE, 1))
        if not spec.get(_ESCAPE, 1):
            raise ValueError("blanks are not escaped in this model")
        self.byte_id = {int(self.pieces[i][0][1:-1], 16): i for i in byte_ids}

    def _prepare(self) -> None:
        """Ranks for merging, ids of what comes out of it, and texts for decoding."""
        normal = {p: (s, i) for i, (p, s, kind) in enumerate(self.pieces) if kind == NORMAL}
        self.score = {p: s for p, (s, _) in normal.items()}
        self.id = {p: i for p, (_, i) in normal.items()}
        blanks = [p for p in normal if len(p) > 1 and not p.strip(BLANK)]
        words = sorted((p for p in normal if len(p) > 1 and p.strip(BLANK)), key=lambda p: -self.score[p])
        scores = [self.score[p] for p in words]
        # Words can be merged apart from each other if no piece crosses the blank between them, in
        # the order of ranks if no two scores are equal, and before all runs of blanks if those
        # have the least scores. Otherwise the whole text is merged with a heap.
        self.by_words = (
            all(BLANK not in p[1:] for p in words)
            and len(set(scores)) == len(scores)
            and BLANK in normal
            and (not blanks or not scores or max(self.score[p] for p in blanks) < scores[-1])
        )
        # Merging starts at characters: their bytes are put together before all other merges.
        wide = sorted({c for p in normal for c in p if ord(c) > 0x7F})
        parts = sorted({c.encode()[:n] for c in wide for n in range(2, len(c.encode()))})
        tokens = [bytes([b]) for b in range(256)] + parts + [c.encode() for c in wide] + [p.encode() for p in words]
        self.merges = tiktoken.Encoding(
            "pieces",
            pat_str=f"{BLANK}?[^{BLANK}]+|{BLANK}",
            mergeable_ranks={t: rank for rank, t in enumerate(tokens)},
            special_tokens={},
        )
        self.long_word = re.compile(f"[^{BLANK}]{{{LONG_WORD + 1}}}")
        out = [self._ids_of(token) for token in tokens]
        self.token_ids = np.array([ids[0] for ids in out], dtype=np.int32)
        self.token_many = {rank: ids for rank, ids in enumerate(out) if len(ids) > 1}
        self.token_is_many = np.array([len(ids) > 1 for ids in out])
        self._runs: dict[int, list[int]] = {}
        sizes = [1 if kind == BYTE else len(p.encode()) for p, _, kind in self.pieces]
        self.sizes = np.array(sizes, dtype=np.int64)
        self.leads = [kind == NORMAL and p.startswith(BLANK) for p, _, kind in self.pieces]
        self.texts = [self._text_of(p, kind) for p, _, kind in self.pieces]

    def _ids_of(self, token: bytes) -> list[int]:
        """The id of a piece, or of each of its bytes."""
        try:
            piece = token.decode()
        except UnicodeDecodeError:
            piece = ""
        return [self.id[piece]] if piece in self.id else [self.byte_id[b] for b in token]

    def _text_of(self, piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[1:-1], 16)])
        if kind == UNKNOWN:
            return _UNKNOWN_TEXT
        return b"" if kind == CONTROL else piece.replace(BLANK, " ").encode()

    # -- encoding --------------------------------------------------------------------------

    def normalise(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised text, and for each of its bytes, and its end, the place in ``text``.

        All bytes of a character, or of a replacement, come from where it starts.
        """
        if not text:
            return b"", np.zeros(1, dtype=np.int64)
        chunks, places, at, starts = [], [], 0, self.charmap.starts
        while at < len(text):
            key = starts.search(text, at) if starts else None
            plain = key.start() if key else len(text)
            hit = self.charmap.longest(text, plain) if key else None
            if key and hit is None:
                # A character that begins some key, but none of them is here.
                plain += 1
                while plain < len(text) and text[plain] & 0xC0 == 0x80:
                    plain += 1
            if plain > at:
                chunks.append(text[at:plain])
                places.append(_characters(chunks[-1]) + at)
            at = plain
            if hit:
                end, replacement = hit
                chunks.append(replacement)
                places.append(np.full(len(replacement), at, dtype=np.int64))
                at = end
        out = np.frombuffer(b"".join(chunks), dtype=np.uint8)
        origin = np.concatenate([*places, [len(text)]]).astype(np.int64)
        if self.squeeze:
            blank = out == 0x20
            kept = ~(blank & np.concatenate(([True], blank[:-1])))
            words = np.flatnonzero(~blank)
            end = int(words[-1]) + 1 if len(words) else 0
            if end < len(out):
                kept[end:] = False
                origin[-1] = origin[end]
            out, origin = out[kept], origin[np.append(kept, True)]
            if not len(out):
                return b"", origin[-1:]
        widths = np.where(out == 0x20, len(_BLANK), 1)
        origin = np.append(np.repeat(origin[:-1], widths), origin[-1])
        escaped = out.tobytes().replace(b" ", _BLANK)
        if self.dummy:
            return _BLANK + escaped, np.concatenate((np.repeat(origin[:1], len(_BLANK)), origin))
        return escaped, origin

    def encode(self, text: str | None) -> Encoded:
        """Ids and spans. An empty or NULL text has none."""
        normal, origin = self.normalise((text or "").encode())
        ids = self._merged(normal.decode()) if normal else np.zeros(0, dtype=np.int32)
        ends = np.cumsum(self.sizes[ids])
        if len(ids) and ends[-1] != len(normal):
            raise AssertionError("the pieces do not make up the normalised text")
        begins = ends - self.sizes[ids]
        return Encoded(ids, origin[begins].astype(np.int32), origin[ends].astype(np.int32))

    def _merged(self, text: str) -> np.ndarray:
        if not self.by_words:
            return np.array(self._heap_merged(text), dtype=np.int32)
        if len(text) <= LONG_WORD or not self.long_word.search(text):
            tokens = self.merges.encode_ordinary(text)
        else:
            tokens = []
            for word in re.findall(f"{BLANK}?[^{BLANK}]+|{BLANK}", text):
                if len(word) > LONG_WORD:
                    tokens.extend(-1 - i for i in self._heap_merged(word))
                else:
                    tokens.extend(self.merges.encode_ordinary(word))
        return self._joined_blanks(np.array(tokens, dtype=np.int64))

    def _joined_blanks(self, tokens: np.ndarray) -> np.ndarray:
        """Ids of merged words; negative tokens are ids already. Then runs of blanks are merged."""
        ids = np.where(tokens < 0, -1 - tokens, self.token_ids[np.maximum(tokens, 0)]).astype(np.int32)
        many = self.token_is_many[np.maximum(tokens, 0)] & (tokens >= 0)
        blank = ids == self.id.get(BLANK, -1)
        beside = np.zeros(len(ids) + 1, dtype=bool)
        beside[1:-1] = blank[1:] & blank[:-1]
        marks = np.flatnonzero(many | beside[1:] | beside[:-1]).tolist()
        if not marks:
            return ids
        out, at, i = [], 0, 0
        while i < len(marks):
            out.append(ids[at : marks[i]])
            first = i
            if many[marks[i]]:
                out.append(self.token_many[int(tokens[marks[i]])])
            else:
                while i + 1 < len(marks) and marks[i + 1] == marks[i] + 1 and blank[marks[i + 1]]:
                    i += 1
                out.append(self._blank_run(i - first + 1))
            at = marks[i] + 1
            i += 1
        return np.concatenate([*out, ids[at:]]).astype(np.int32)

    def _blank_run(self, n: int) -> list[int]:
        if n not in self._runs:
            self._runs[n] = self._heap_merged(BLANK * n)
        return self._runs[n]

    def _heap_merged(self, text: str) -> list[int]:
        """The pair of the highest score is merged first, of equal ones the leftmost."""
        symbols = list(text)
        after = [*range(1, len(symbols)), -1]
        before = list(range(-1, len(symbols) - 1))
        waiting: list[tuple[float, int, int, int]] = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right >= 0:
                merged = symbols[left] + symbols[right]
                if merged in self.score:
                    heapq.heappush(waiting, (-self.score[merged], left, right, len(merged)))

        for left in range(len(symbols) - 1):
            offer(left, left + 1)
        while waiting:
            _, left, right, size = heapq.heappop(waiting)
            if not symbols[left] or not symbols[right] or len(symbols[left]) + len(symbols[right]) != size:
                continue
            symbols[left] += symbols[right]
            symbols[right] = ""
            after[left] = after[right]
            if after[left] >= 0:
                before[after[left]] = left
            offer(before[left], left)
            offer(left, after[left])
        return [i for symbol in symbols if symbol for i in self._ids_of(symbol.encode())]

    # -- decoding --------------------------------------------------------------------------

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the blank that was put before the text goes.

        Bytes of byte pieces that make no character are replaced one by one.
        """
        texts = self.texts
        parts = [texts[i] for i in ids]
        if self.dummy or self.squeeze:
            for at, i in enumerate(ids):
                if self.leads[i]:
                    parts[at] = parts[at][1:]
                if parts[at] or (self.leads[i] and not self.squeeze):
                    break
        joined = b"".join(parts)
        try:
            return joined.decode()
        except UnicodeDecodeError:
            return joined.decode(errors="bytewise")


def _bytewise(error: UnicodeDecodeError) -> tuple[str, int]:
    return "\ufffd", error.start + 1


codecs.register_error("bytewise", _bytewise)


def _characters(text: bytes) -> np.ndarray:
    """For each byte the place where its character starts."""
    at = np.arange(len(text), dtype=np.int64)
    inside = np.frombuffer(text, dtype=np.uint8) & 0xC0 == 0x80
    return np.maximum.accumulate(np.where(inside, 0, at)) if inside.any() else at


@lru_cache(maxsize=2)
def model(path: str) -> Model:
    """One model for each Python worker."""
    return Model(path)


def _slices(batch: pa.RecordBatch, column: int, width: int = 0) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with a bounded number of bytes, or a single row.

    ``width`` is that of a list's values, 0 for texts.
    """
    values = batch.column(column)
    lengths = pc.list_value_length(values) if width else pc.binary_length(values)
    sizes = lengths.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) * (width or 1)
    part = np.cumsum(sizes) // _HANDED_ON
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for start, end in zip(edges, edges[1:], strict=False):
        if end > start:
            yield batch.slice(start, end - start)


def _ints(rows: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    values = np.concatenate([*rows, np.zeros(0, dtype=np.int32)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", *, decoded: bool = False) -> DataFrame:
    """(key, ids, starts, ends) of each row of ``docs``: one span of bytes for each id.

    Spans follow each other without gaps; blanks that normalisation adds have empty ones, and of a
    character that is spelled in bytes the last byte has the span. A NULL or empty text has no ids.
    Equal or NULL keys stay rows of their own, other columns are not looked at, an empty table gives
    no row. A text is held by one task, with about 30 bytes a byte of it. ``path`` is the model file,
    in the same place on every worker. ``decoded`` adds a column of that name, what the ids spell, as
    ``decode`` gives it, without sending them to Python again. No shuffle.
    """
    names = ["key", "ids", "starts", "ends"] + ["decoded"] * decoded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path)
        for batch in batches:
            for part in _slices(batch, 1):
                rows = [pieces.encode(t.as_py()) for t in part.column(1)]
                columns = [part.column(0), *(_ints([getattr(r, name) for r in rows]) for name in names[1:4])]
                if decoded:
                    columns.append(pa.array([pieces.decode(r.ids.tolist()) for r in rows], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("text"))
    schema = "key long, ids array<int>, starts array<int>, ends array<int>" + ", decoded string" * decoded
    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(key, decoded): the text that the ``ids`` of each row of ``encoded`` spell. No shuffle.

    NULL or no ids spell the empty text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path)
        for batch in batches:
            for part in _slices(batch, 1, pa.int32().byte_width):
                texts = [pieces.decode(i.as_py() or []) for i in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["key", "decoded"])

    return encoded.select("key", "ids").mapInArrow(run, "key long, decoded string")
