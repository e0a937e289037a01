"""Token ids of a corpus in compressed binary files, each a wavelet matrix over a run of documents.

A file keeps the ids of consecutive documents as bit planes, highest bit first. After each plane
the ids with a 0 there move before those with a 1, both in their order, so a position is followed
from plane to plane by counting bits before it (rank), and back by finding the k-th bit (select).
Planes are cut into blocks that are compressed one by one; a directory holds each block's place
and the ones before it. One file thus answers without being unpacked as a whole: the id at a
position, how often an id occurs in a range, and where its k-th occurrence is.

Spark's text sink writes one file per row, so files go to any store that Spark can write to.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from zonepulse.llm import bytelevel
from zonepulse.llm.common import table
from zonepulse.session import scratch_path, stash

MAGIC = b"ZPWAVE01"
#: Bits per block: what one lookup unpacks.
BLOCK = 1 << 15
#: Ids per file, unless one document has more; a task holds one file's ids.
PER_FILE = 4_000_000
END_ID = 2


def pack(ids: np.ndarray, bits: int, header: dict, sections: dict[str, np.ndarray]) -> bytes:
    """File content of `ids`, each below 2**bits, with further int64 columns of the caller's."""
    squeeze = zstandard.ZstdCompressor(level=3).compress
    level = ids.astype(np.uint16 if bits <= 16 else np.uint32)
    zeros, stops, ones, blocks, at = [], [], [], [], 0
    for plane in reversed(range(bits)):
        low, high, before = [], [], 0
        for first in range(0, len(level), BLOCK):
            part = level[first : first + BLOCK]
            bit = (part & level.dtype.type(1 << plane)) != 0
            low.append(part[np.flatnonzero(~bit)])
            high.append(part[np.flatnonzero(bit)])
            blocks.append(squeeze(np.packbits(bit).tobytes()))
            at += len(blocks[-1])
            stops.append(at)
            ones.append(before)
            before += len(high[-1])
        zeros.append(len(level) - before)
        level = np.concatenate([level[:0], *low, *high])
    columns = {"stops": np.array(stops, "<i8"), "ones": np.array(ones, "<i8"), **sections}
    stored = {name: squeeze(np.asarray(column, "<i8").tobytes()) for name, column in columns.items()}
    head = json.dumps(
        {**header, "n": len(ids), "bits": bits, "block": BLOCK, "zeros": zeros, "sections": [[k, len(v)] for k, v in stored.items()]}
    ).encode()
    return b"".join([MAGIC, len(head).to_bytes(4, "little"), head, *stored.values(), *blocks])


class WaveletMatrix:
    """Reads a file's content; blocks are unpacked when a lookup meets them."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token file")
        start = 12 + int.from_bytes(data[8:12], "little")
        self.header = json.loads(data[12:start])
        self.n, self.bits, self.block, self.zeros = (self.header[k] for k in ("n", "bits", "block", "zeros"))
        self.sections: dict[str, np.ndarray] = {}
        self._open = zstandard.ZstdDecompressor().decompress
        for name, size in self.header["sections"]:
            self.sections[name] = np.frombuffer(self._open(data[start : start + size]), "<i8") if size else np.zeros(0, "<i8")
            start += size
        self.data, self.start = data, start
        self.per_plane = -(-self.n // self.block)
        self.known: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _raw(self, block: int) -> bytes:
        first = self.start + (int(self.sections["stops"][block - 1]) if block else 0)
        return self._open(self.data[first : self.start + int(self.sections["stops"][block])])

    def _bits(self, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Bits of a block, and the ones before each of its places."""
        if block not in self.known:
            if len(self.known) > 256:
                self.known.clear()
            bits = np.unpackbits(np.frombuffer(self._raw(block), np.uint8))
            self.known[block] = bits, np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])
        return self.known[block]

    def _rank(self, plane: int, place: int) -> int:
        """Ones of a plane before a place."""
        if place >= self.n:
            return self.n - self.zeros[plane]
        block = plane * self.per_plane + place // self.block
        return int(self.sections["ones"][block] + self._bits(block)[1][place % self.block])

    def _select(self, plane: int, bit: int, k: int) -> int:
        """Place of the k-th (from 0) 1 or 0 of a plane."""
        first = plane * self.per_plane
        before = self.sections["ones"][first : first + self.per_plane]
        if not bit:
            before = np.arange(self.per_plane) * self.block - before
        block = int(np.searchsorted(before, k, side="right")) - 1
        bits = self._bits(first + block)[0]
        return block * self.block + int(np.flatnonzero(bits == bit)[k - int(before[block])])

    def access(self, place: int) -> int:
        """The id at a place."""
        if not 0 <= place < self.n:
            raise IndexError(place)
        out = 0
        for plane in range(self.bits):
            block = plane * self.per_plane + place // self.block
            bit = int(self._bits(block)[0][place % self.block])
            ones = self._rank(plane, place)
            place = self.zeros[plane] + ones if bit else place - ones
            out = out << 1 | bit
        return out

    def _span(self, token: int, start: int, stop: int) -> tuple[int, int]:
        """Where the ids equal to `token` of a range lie after the last plane."""
        if token >> self.bits:
            return 0, 0
        for plane in range(self.bits):
            low, high = self._rank(plane, start), self._rank(plane, stop)
            if token >> (self.bits - 1 - plane) & 1:
                start, stop = self.zeros[plane] + low, self.zeros[plane] + high
            else:
                start, stop = start - low, stop - high
            if start >= stop:
                return 0, 0
        return start, stop

    def count(self, token: int, start: int = 0, stop: int | None = None) -> int:
        """How often an id occurs in [start, stop)."""
        first, last = self._span(token, max(0, start), self.n if stop is None else min(stop, self.n))
        return last - first

    def find(self, token: int, k: int = 0) -> int:
        """Place of the k-th occurrence of an id, from 0; -1 if there is none."""
        first, last = self._span(token, 0, self.n)
        if not 0 <= k < last - first:
            return -1
        place = first + k
        for plane in reversed(range(self.bits)):
            bit = token >> (self.bits - 1 - plane) & 1
            place = self._select(plane, bit, place - self.zeros[plane] if bit else place)
        return place

    def ids(self) -> np.ndarray:
        """All ids: the moves after each plane are undone, last plane first."""
        level = np.zeros(self.n, np.uint16 if self.bits <= 16 else np.uint32)
        for plane in reversed(range(self.bits)):
            out, low, high = np.empty_like(level), 0, self.zeros[plane]
            mark = level.dtype.type(1 << (self.bits - 1 - plane))
            for block in range(self.per_plane):
                part = out[block * self.block : (block + 1) * self.block]
                raw = np.frombuffer(self._raw(plane * self.per_plane + block), np.uint8)
                bit = np.unpackbits(raw, count=len(part)).view(bool)
                zero, one = np.flatnonzero(~bit), np.flatnonzero(bit)
                part[zero], part[one] = level[low : low + len(zero)], level[high : high + len(one)] | mark
                low, high = low + len(zero), high + len(one)
            level = out
        return level


def write_files(docs: DataFrame, path: str, tokenizer: str, text: str = "text", key: str = "doc_id", end_id: int = END_ID, per_file: int = PER_FILE) -> None:
    """Writes the ids of all texts, each followed by `end_id`, in ascending order of `key`.

    A null text is an empty one and gives `end_id` alone; a null key comes first. Rows with one
    key come in the order of their texts' hashes, copies in any. Ranges are cut on all of that
    and a repeatable draw, so a key that very many rows share is spread over files. Other columns
    are left out. A file holds `per_file` ids or one longer document. An empty table gives none.
    """

    def files(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bytelevel.loaded(tokenizer)
        bits = max(end_id, encoder.tokenizer.get_vocab_size() - 1).bit_length()
        end, part, seq = np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId(), 0
        keys: list[int | None] = []
        parts: list[bytes] = []
        held = 0

        def file() -> pa.RecordBatch:
            known = [k is not None for k in keys]
            sections = {
                "keys": np.array([k or 0 for k in keys], "<i8"), "known": np.array(known, "<i8"),
                "lengths": np.array([len(p) // 4 for p in parts], "<i8"),
            }
            content = pack(np.frombuffer(b"".join(parts), "<u4"), bits, {"part": part, "seq": seq, "end": end_id}, sections)
            return pa.record_batch([pa.array([content], pa.binary())], ["content"])

        for batch in batches:
            for k, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.encode(body.as_py() or "") + end
                if keys and held + len(ids) // 4 > per_file:
                    yield file()
                    keys, parts, held, seq = [], [], 0, seq + 1
                keys.append(k)
                parts.append(ids)
                held += len(ids) // 4
        if keys:
            yield file()

    slim = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("body"))
    slim = slim.withColumns({"hash": F.xxhash64("body"), "draw": F.rand(13)})
    by = ["key", "hash", "draw"]
    dealt = slim.repartitionByRange(*by).sortWithinPartitions(*by).select("key", "body")
    content = dealt.mapInArrow(files, "content binary").select(F.col("content").cast("string"))
    content.write.option("maxRecordsPerFile", 1).option("lineSep", "\n").text(path)


def _contents(spark: SparkSession, path: str) -> DataFrame:
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return found.where("length > 0").select("content")


def read_documents(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(part, seq, doc_id, first, n_tokens, ids_crc32[, ids]) of every document in the files.

    (part, seq) orders the files and `first` is the place in the file. `ids` and their checksum
    are over little-endian unsigned 32-bit numbers.
    """

    def read(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                matrix = WaveletMatrix(bytes(content))
                ids, lengths = matrix.ids().astype("<u4"), matrix.sections["lengths"]
                stops = np.cumsum(lengths)
                data = [ids[a:b].tobytes() for a, b in zip(stops - lengths, stops)]
                frame = pd.DataFrame({
                    "part": matrix.header["part"], "seq": matrix.header["seq"],
                    "doc_id": pd.array(matrix.sections["keys"], "Int64"), "first": stops - lengths,
                    "n_tokens": lengths, "ids_crc32": [zlib.crc32(d) for d in data],
                })
                frame.loc[matrix.sections["known"] == 0, "doc_id"] = pd.NA
                yield frame.assign(ids=data) if with_ids else frame

    schema = "part int, seq int, doc_id long, first long, n_tokens long, ids_crc32 long"
    return _contents(spark, path).mapInPandas(read, schema + (", ids binary" if with_ids else ""))


def with_starts(documents: DataFrame) -> DataFrame:
    """Adds `start`: the ids of all documents before, in the order of files and places.

    Lengths are summed per file, files per part, and only one row per part in one task.
    """
    files = documents.groupBy("part", "seq").agg(F.sum("n_tokens").alias("n"))
    earlier = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = files.withColumn("base", earlier(Window.partitionBy("part").orderBy("seq"))).drop("n")
    parts = files.groupBy("part").agg(F.sum("n").alias("n")).withColumn("shift", earlier(Window.orderBy("part"))).drop("n")
    spans = within.join(parts, "part").select("part", "seq", (F.col("base") + F.col("shift")).alias("base"))
    return documents.join(spans, ["part", "seq"]).withColumn("start", F.col("base") + F.col("first")).drop("base")


def count_tokens(spark: SparkSession, path: str, tokens: Sequence[int]) -> DataFrame:
    """(token, n): occurrences of each of `tokens` in all files, by rank alone."""

    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                matrix = WaveletMatrix(bytes(content))
                yield pd.DataFrame({"token": list(tokens), "n": [matrix.count(t) for t in tokens]})

    return _contents(spark, path).mapInPandas(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def find_tokens(spark: SparkSession, path: str, token: int) -> DataFrame:
    """(part, seq, doc_id, place): every occurrence of a token, by select; `place` is in its document."""

    def find(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                matrix = WaveletMatrix(bytes(content))
                stops = np.cumsum(matrix.sections["lengths"])
                for first in range(0, matrix.count(token), 10_000):
                    last = min(first + 10_000, matrix.count(token))
                    places = np.array([matrix.find(token, k) for k in range(first, last)], np.int64)
                    doc = np.searchsorted(stops, places, side="right")
                    frame = pd.DataFrame({
                        "part": matrix.header["part"], "seq": matrix.header["seq"],
                        "doc_id": pd.array(matrix.sections["keys"][doc], "Int64"),
                        "place": places - (stops - matrix.sections["lengths"])[doc],
                    })
                    frame.loc[matrix.sections["known"][doc] == 0, "doc_id"] = pd.NA
                    yield frame

    return _contents(spark, path).mapInPandas(find, "part int, seq int, doc_id long, place long")


def op13_wavelet_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files: its place in the corpus, its number of ids and their checksum.

    Null texts count as empty, null ids come first, rows that share an id come one after the
    other in the order of their texts' hashes; an empty table gives no rows.
    """
    path = scratch_path(spark, "tokens")
    write_files(table(spark, folder, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    documents = stash(read_documents(spark, path, with_ids=False), "token-documents")
    return with_starts(documents).select("doc_id", "start", "n_tokens", "ids_crc32")
