"""Packing tokenised documents into sequences by length patterns and non-negative least squares.

The histogram of piece lengths, at most one row per possible length, is all the driver sees.
Patterns of few documents that fill a sequence are enumerated on coarse lengths, their repeat
counts are fitted to the histogram by non-negative least squares and rounded down, and what is
left goes to the smallest room it fits, longest first. The result is a short table: the n-th to
m-th piece of a length go to these sequences, at this offset. Every piece finds its place in it
by its length and its number among the pieces of that length.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from zonepulse.llm.common import table
from zonepulse.session import stash

CAPACITY = 4096
END_ID = 1
#: Coarse lengths of the patterns: this many steps fill a sequence.
STEPS = 64
MOST_IN_PATTERN = 4
_SIGNS = ".,;:!?*%&#$"


class _Words(dict):
    """Ids of a word as little-endian 32-bit numbers; emptied when it has grown large.

    White space is dropped by the tokenizer and no token crosses it, so a text's ids are those
    of its words in a row. ASCII letters are lower-cased by the tokenizer, a run of signs after
    letters is tokenised on its own, and small ASCII letters pass its steps before the model
    unchanged.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model

    def __missing__(self, word: str) -> bytes:
        if len(self) > 400_000:
            self.clear()
        bare = word.rstrip(_SIGNS)
        if len(bare) < len(word) and bare.isalpha():
            ids = self[bare] + self[word[len(bare) :]]
        elif word.isascii() and word.lower() != word:
            ids = self[word.lower()]
        elif word.isascii() and word.isalpha():
            ids = np.array([t.id for t in self.model.tokenize(word)], "<u4").tobytes()
        else:
            ids = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        self[word] = ids
        return ids


_LOADED: dict[str, _Words] = {}


def token_ids(text: str, path: str) -> bytes:
    """Ids of a whole text, as little-endian 32-bit numbers."""
    if path not in _LOADED:
        _LOADED[path] = _Words(path)
    return b"".join(map(_LOADED[path].__getitem__, text.replace("\n", " ").split(" ")))


def token_pieces(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(key, piece, start, length, ids, part, place): documents cut into pieces of at most `capacity` ids.

    `ids` holds little-endian 32-bit numbers. Each document ends with `end_id`; a null text
    counts as empty and gives that id alone. `place` numbers the pieces of equal length in a part.
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, places = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in batches:
            for first in range(0, len(batch), 400):
                some, rows = batch.iloc[first : first + 400], []
                for value, body in zip(some["key"], some["body"]):
                    ids = token_ids(body or "", path) + end
                    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                        cut = ids[at : at + 4 * capacity]
                        n = len(cut) // 4
                        rows.append((value, piece, at // 4, n, cut, part, places[n]))
                        places[n] += 1
                frame = pd.DataFrame(rows, columns=["key", "piece", "start", "length", "ids", "part", "place"])
                yield frame.astype({"key": "Int64"})

    slim = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("body"))
    schema = "key long, piece int, start long, length long, ids binary, part int, place long"
    return slim.mapInPandas(run, schema).withColumnRenamed("key", key)


def patterns(steps: int = STEPS, most: int = MOST_IN_PATTERN) -> list[tuple[int, ...]]:
    """Multisets of 2 to `most` coarse lengths, largest first, that fill a sequence."""

    def parts(total: int, n: int, top: int) -> Iterator[tuple[int, ...]]:
        if n == 1:
            if total <= top:
                yield (total,)
            return
        for first in range(min(top, total - n + 1), (total - 1) // n, -1):
            for rest in parts(total - first, n - 1, first):
                yield (first, *rest)

    return [p for n in range(2, most + 1) for p in parts(steps, n, steps)]


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 with least |a x - b|: columns join while they help, and leave when they turn negative."""
    x = np.zeros(a.shape[1])
    inside = np.zeros(a.shape[1], bool)
    limit = 1e-9 * max(1.0, float(np.abs(b).max(initial=0))) * a.shape[0]
    for _ in range(3 * a.shape[0] + 100):
        slope = np.where(inside, -np.inf, a.T @ (b - a @ x))
        best = int(slope.argmax())
        if slope[best] <= limit:
            break
        inside[best] = True
        while True:
            at = np.flatnonzero(inside)
            fit = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if (fit > 0).all():
                x[:] = 0
                x[at] = fit
                break
            low = fit <= 0
            reach = float((x[at][low] / np.maximum(x[at][low] - fit[low], 1e-300)).min())
            x[at] += reach * (fit - x[at])
            inside[at[x[at] <= 1e-12]] = False
            x[~inside] = 0
            if not inside.any():
                break
    return x


class _Plan:
    """Places given to runs of pieces: (length, first number, first sequence, offset, how many)."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = dict(counts)
        self.given = dict.fromkeys(counts, 0)
        self.capacity, self.sequences = capacity, 0
        self.rows: list[tuple[int, int, int, int, int]] = []
        self.rooms: list[int] = []
        self.open: dict[int, list[tuple[int, int]]] = {}

    def start(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def put(self, length: int, n: int, first: int, room: int) -> int:
        """n pieces of a length into sequences from `first` on, each with `room` left; the room after."""
        self.rows.append((length, self.given[length], first, self.capacity - room, n))
        self.given[length] += n
        self.left[length] -= n
        return room - length

    def keep(self, first: int, n: int, room: int) -> None:
        if room and n:
            if room not in self.open:
                bisect.insort(self.rooms, room)
                self.open[room] = []
            self.open[room].append((first, n))

    def take(self, length: int) -> tuple[int, int, int] | None:
        """Sequences with the smallest room that holds the length."""
        at = bisect.bisect_left(self.rooms, length)
        if at == len(self.rooms):
            return None
        room = self.rooms[at]
        first, n = self.open[room].pop()
        if not self.open[room]:
            del self.open[room]
            self.rooms.pop(at)
        return first, n, room


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY, steps: int = STEPS) -> tuple[np.ndarray, int]:
    """Rows (length, first number, first sequence, offset, how many), and the number of sequences.

    A pattern places all its documents but the smallest, which is left to the exact room: so
    the coarse lengths only decide which large ones meet.
    """
    plan = _Plan({n: c for n, c in counts.items() if c}, capacity)
    coarse = lambda n: -(-n * steps // capacity)
    cells: dict[int, list[int]] = {}
    for length in sorted(plan.left):
        cells.setdefault(coarse(length), []).append(length)
    shapes = [p for p in patterns(steps) if all(c in cells for c in p)]
    if shapes:
        a = np.zeros((steps, len(shapes)))
        for col, shape in enumerate(shapes):
            for cell in shape:
                a[cell - 1, col] += 1
        b = np.array([float(sum(plan.left[n] for n in cells.get(c, ()))) for c in range(1, steps + 1)])
        for shape, repeats in sorted(zip(shapes, np.floor(nnls(a, b) + 1e-9).astype(np.int64)), key=lambda s: (len(s[0]), s)):
            for cell in set(shape):
                there = sum(plan.left[n] for n in cells[cell])
                repeats = min(repeats, there // shape.count(cell))
            if not repeats:
                continue
            groups = [(plan.start(int(repeats)), int(repeats), capacity)]
            for cell in shape[:-1]:
                filled = []
                for first, n, room in groups:
                    while n:
                        while not plan.left[cells[cell][-1]]:
                            cells[cell].pop()
                        length = cells[cell][-1]
                        some = min(n, plan.left[length])
                        filled.append((first, some, plan.put(length, some, first, room)))
                        first, n = first + some, n - some
                groups = filled
            for group in groups:
                plan.keep(*group)
    for length in sorted(plan.left, reverse=True):
        while plan.left[length]:
            n, found = plan.left[length], plan.take(length)
            if found:
                first, wide, room = found
                some = min(n, wide)
                plan.keep(first + some, wide - some, room)
                plan.keep(first, some, plan.put(length, some, first, room))
                continue
            each = capacity // length
            for pieces, n in ((each, n // each), (n % each, 1 if n % each else 0)):
                if n:
                    first, room = plan.start(n), capacity
                    for _ in range(pieces):
                        room = plan.put(length, n, first, room)
                    plan.keep(first, n, room)
    rows = np.array(sorted(plan.rows), np.int64).reshape(-1, 5)
    return rows, plan.sequences


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces (length, part, place, ...); pass a stored frame.

    Only the histogram, at most `capacity` rows, comes to the driver. A piece's number among
    those of its length is its place in its part and the count of the parts before, so a length
    that very many pieces have is never in one task.
    """
    per = stash(pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "lengths")
    counts = {r["length"]: r["n"] for r in per.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows, _ = plan_packing(counts, capacity)
    base = np.int64(1 << 40)
    starts = rows[:, 0] * base + rows[:, 1]

    def place(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            number = batch["place"].to_numpy() + batch.pop("before").to_numpy()
            at = np.searchsorted(starts, batch["length"].to_numpy() * base + number, side="right") - 1
            yield batch.assign(sequence_id=rows[at, 2] + number - rows[at, 1], offset=rows[at, 3])

    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = per.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = pieces.join(stash(before, "before"), ["length", "part"]).select(*pieces.columns, "before")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return numbered.mapInPandas(place, f"{schema}, sequence_id long, offset long")


def op5_pattern_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed_documents(table(spark, folder, "documents"))


def packed_documents(docs: DataFrame) -> DataFrame:
    pieces = token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    slim = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    packed = pack(stash(slim, "pieces"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
