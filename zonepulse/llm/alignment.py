"""Alignment of two tokenizers' tokens over one text by coalescing their byte intervals.

The tokens of both tokenizers are intervals of one text's bytes. Sorted by start, a token opens a
new group where it starts at or after the furthest end so far: there tokens of both sides end. In
a group the overlapping pairs are found by expanding each token's range of partners.

Tokens that end together share their last bytes, so the shorter one's bytes end the longer one's:
which pairs can be linked follows from the two vocabularies alone. Each possible pair has a fixed
place in one array, some 560,000 for the public files, and counts over a whole corpus fit in it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator, Sequence
from functools import cached_property

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession, functions as F

from zonepulse.llm import bytelevel
from zonepulse.llm.common import table
from zonepulse.session import stash

#: Bytes of text whose tokens are aligned together, unless one text has more.
AT_ONCE = 500_000
SPACE = "▁"


def coalesce(start: np.ndarray, end: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Group number of every interval, from 0 in the order of starts."""
    order = np.lexsort((side, start))
    group = np.zeros(len(start), np.int64)
    if len(start):
        reach = np.maximum.accumulate(end[order])
        group[order[1:]] = np.cumsum(start[order[1:]] >= reach[:-1])
    return group


def overlaps(start_a: np.ndarray, end_a: np.ndarray, start_b: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (a, b) of all pairs that share a byte; each side is in order and without overlaps."""
    first = np.searchsorted(end_b, start_a, side="right")
    n = np.searchsorted(start_b, end_a, side="left") - first
    a = np.repeat(np.arange(len(start_a)), n)
    return a, np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)


class Tokenizers:
    """Side A: a byte-level file, given a space before the text. Side B: a SentencePiece file, which adds one."""

    def __init__(self, path_a: str, path_b: str):
        self.a = bytelevel.loaded(path_a, plain=True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte = {letter: b for b, letter in enumerate(bytelevel.byte_letters())}
        vocabulary = self.a.tokenizer.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for name, i in vocabulary.items():
            self.bytes_a[i] = bytes(byte[c] for c in name) if all(c in byte for c in name) else name.encode()
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.n_ids = max(len(self.bytes_a), len(self.bytes_b))
        self.length_a, self.length_b = (np.array([len(t) for t in side], np.int64) for side in (self.bytes_a, self.bytes_b))
        self.single = np.array([self.b.is_byte(i) for i in range(len(self.bytes_b))])
        # Places of pairs: (a, length of b) where b ends a, then (b, length of a) where a is the
        # shorter, then a alone where b is the piece of a's last byte.
        self.place_a = np.cumsum(self.length_a) - self.length_a - 1
        self.place_b = self.length_a.sum() + np.cumsum(self.length_b) - self.length_b - 1
        self.place_single = int(self.length_a.sum() + self.length_b.sum())
        self.n_places = self.place_single + len(self.bytes_a)

    def _piece(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(re.fullmatch(r"<0x(..)>", self.b.id_to_piece(i))[1], 16)])
        return self.b.id_to_piece(i).replace(SPACE, " ").encode()

    @cached_property
    def digits(self) -> list[bytes]:
        """Decimal ids before each of the three signs of a group's text, all of one sign in a row."""
        return [b"%d%s" % (i, sign) for sign in (b",", b"|", b";") for i in range(self.n_ids)]

    def places(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The fixed place of each pair of ids that end together."""
        la, lb = self.length_a[a], self.length_b[b]
        found = np.where(lb <= la, self.place_a[a] + lb, self.place_b[b] + la)
        return np.where(self.single[b], self.place_single + a, found)

    def b_of_places(self) -> np.ndarray:
        """The B id of every place, -1 where no pair has it."""
        out = np.full(self.n_places, -1, np.int64)
        ids = {t: i for i, t in enumerate(self.bytes_b) if t and not self.single[i] and not self.b.is_control(i) and not self.b.is_unknown(i)}
        bytes_ = {t: i for i, t in enumerate(self.bytes_b) if self.single[i]}
        for a, t in enumerate(self.bytes_a):
            for n in range(1, len(t) + 1):
                out[self.place_a[a] + n] = ids.get(t[-n:], -1)
            out[self.place_single + a] = bytes_.get(t[-1:], -1)
        for b in ids.values():
            out[self.place_b[b] + 1 : self.place_b[b] + self.length_b[b]] = b
        return out

    def encode(self, texts: Sequence[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both sides; none on either for a null or empty text, or one that a side does not give back."""
        none = np.zeros(0, np.int64)
        side_a, side_b = [], []
        for text, ids in zip(texts, self.b.encode([t or "" for t in texts], num_threads=1)):
            a = np.frombuffer(self.a.encode(" " + text), "<u4").astype(np.int64) if text else none
            # Side A has a token for every byte and loses none, so its length tells.
            want = b" " + (text or "").encode()
            keep = bool(text) and self.length_a[a].sum() == len(want) and b"".join(map(self.bytes_b.__getitem__, ids)) == want
            side_a.append(a if keep else none)
            side_b.append(np.array(ids, np.int64) if keep else none)
        return side_a, side_b


class Aligned:
    """The tokens of several texts, one text's bytes after another's, in groups."""

    def __init__(self, tokenizers: Tokenizers, texts: Sequence[str | None]):
        self.tokenizers = tokenizers
        side_a, side_b = tokenizers.encode(texts)
        self.n_a, self.n_b = (np.array([len(x) for x in side], np.int64) for side in (side_a, side_b))
        self.a, self.b = (np.concatenate([np.zeros(0, np.int64), *side]) for side in (side_a, side_b))
        # Both sides of a text have the same bytes, so ends agree across texts.
        self.end_a, self.end_b = np.cumsum(tokenizers.length_a[self.a]), np.cumsum(tokenizers.length_b[self.b])
        self.start_a, self.start_b = self.end_a - tokenizers.length_a[self.a], self.end_b - tokenizers.length_b[self.b]
        starts, ends = np.concatenate([self.start_a, self.start_b]), np.concatenate([self.end_a, self.end_b])
        group = coalesce(starts, ends, np.repeat([0, 1], [len(self.a), len(self.b)]))
        self.group_a, self.group_b = group[: len(self.a)], group[len(self.a) :]
        #: Last token of each side in its group: these end together.
        self.last_a = np.flatnonzero(np.diff(self.group_a, append=-1))
        self.last_b = np.flatnonzero(np.diff(self.group_b, append=-1))
        doc = np.repeat(np.arange(len(texts)), self.n_a)
        self.n_groups = np.bincount(doc[self.last_a], minlength=len(texts))

    def links(self) -> np.ndarray:
        """Place of each pair that ends together, in the order of texts and ends."""
        return self.tokenizers.places(self.a[self.last_a], self.b[self.last_b])

    def digests(self) -> list[str]:
        """SHA-256 of every text's groups as ids; an empty string without tokens."""
        words = self.tokenizers.digits
        n = len(self.last_a)
        in_a, in_b = np.bincount(self.group_a, minlength=n), np.bincount(self.group_b, minlength=n)
        at_a = np.arange(len(self.a)) + (np.cumsum(in_b) - in_b)[self.group_a]
        at_b = np.arange(len(self.b)) + np.cumsum(in_a)[self.group_b]
        size = self.tokenizers.n_ids
        key = np.empty(len(self.a) + len(self.b), np.int64)
        key[at_a], key[at_b] = self.a, self.b
        key[at_a[self.last_a]] += size
        key[at_b[self.last_b]] += 2 * size
        out, at = [], 0
        for n in (self.n_a + self.n_b).tolist():
            joined = b"".join(map(words.__getitem__, key[at : at + n].tolist()))
            out.append(hashlib.sha256(joined[:-1]).hexdigest() if n else "")
            at += n
        return out


_LOADED: dict[tuple[str, str], Tokenizers] = {}


def loaded(path_a: str, path_b: str) -> Tokenizers:
    if (path_a, path_b) not in _LOADED:
        _LOADED[path_a, path_b] = Tokenizers(path_a, path_b)
    return _LOADED[path_a, path_b]


def _by_bytes(texts: Sequence[str | None]) -> Iterator[tuple[int, int]]:
    """Runs of texts of about AT_ONCE bytes."""
    first, held = 0, 0
    for n, text in enumerate(texts):
        held += len(text or "")
        if held >= AT_ONCE:
            yield first, n + 1
            first, held = n + 1, 0
    if first < len(texts):
        yield first, len(texts)


def aligned_spans(docs: DataFrame, path_a: str, path_b: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, group, start, end, a, b, pairs): every group with its bytes, ids and overlapping pairs.

    Bytes count in the text with a space before it. `pairs` lists (place in a, place in b, whether
    both end together). Texts that are null, empty or not given back by a side have no groups.
    """

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t if isinstance(t, str) else None for t in batch["body"]]
            for first, stop in _by_bytes(texts):
                it = Aligned(loaded(path_a, path_b), texts[first:stop])
                a, b = overlaps(it.start_a, it.end_a, it.start_b, it.end_b)
                n = len(it.last_a)
                edge_a, edge_b, edge = (np.searchsorted(x, np.arange(n + 1)) for x in (it.group_a, it.group_b, it.group_a[a]))
                doc = np.repeat(np.arange(stop - first), it.n_groups)
                opens = np.cumsum(it.n_groups) - it.n_groups
                rows = []
                for g in range(n):
                    fa, fb, pairs = edge_a[g], edge_b[g], slice(edge[g], edge[g + 1])
                    base = it.start_a[edge_a[opens[doc[g]]]]
                    ends = it.end_a[a[pairs]] == it.end_b[b[pairs]]
                    rows.append((
                        batch["key"].iloc[first + doc[g]], g - opens[doc[g]], it.start_a[fa] - base, it.end_a[it.last_a[g]] - base,
                        it.a[fa : edge_a[g + 1]].tolist(), it.b[fb : edge_b[g + 1]].tolist(),
                        [{"a": int(x - fa), "b": int(y - fb), "ends": bool(e)} for x, y, e in zip(a[pairs], b[pairs], ends)],
                    ))
                    if len(rows) == 10_000:
                        yield _spans(rows)
                        rows = []
                if rows:
                    yield _spans(rows)

    slim = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("body"))
    schema = "key long, group long, start long, end long, a array<int>, b array<int>, pairs array<struct<a int, b int, ends boolean>>"
    return slim.mapInPandas(run, schema).withColumnRenamed("key", key)


def _spans(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["key", "group", "start", "end", "a", "b", "pairs"]).astype({"key": "Int64"})


def aligned_documents(docs: DataFrame, path_a: str, path_b: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_a, n_b, n_groups, groups_sha256, links): one row per row of `docs`.

    `links` holds the places of the pairs that end together, as little-endian unsigned 32-bit
    numbers. Null keys and repeated rows are kept as they are; other columns are left out.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for first, stop in _by_bytes(texts):
                it = Aligned(loaded(path_a, path_b), texts[first:stop])
                links, at = it.links().astype("<u4"), np.cumsum(it.n_groups)
                yield pa.record_batch(
                    [
                        batch.column(0).slice(first, stop - first), pa.array(it.n_a), pa.array(it.n_b), pa.array(it.n_groups),
                        pa.array(it.digests(), pa.string()), pa.array([links[x:y].tobytes() for x, y in zip(at - it.n_groups, at)], pa.binary()),
                    ],
                    ["key", "n_a", "n_b", "n_groups", "groups_sha256", "links"],
                )

    slim = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("body"))
    schema = "key long, n_a long, n_b long, n_groups long, groups_sha256 string, links binary"
    return slim.mapInArrow(run, schema).withColumnRenamed("key", key)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(place, n): how often each pair is linked in the whole corpus.

    Every task sums its own pairs first, so at most all possible pairs leave it.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, np.int64)
        for batch in batches:
            for links in batch.column(0):
                seen = np.bincount(np.frombuffer(links.as_py(), "<u4"), minlength=len(counts))
                seen[: len(counts)] += counts
                counts = seen
        place = np.flatnonzero(counts)
        for first in range(0, len(place), 100_000):
            some = place[first : first + 100_000]
            yield pa.record_batch([pa.array(some), pa.array(counts[some])], ["place", "n"])

    return aligned.select("links").mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))


def with_link_scores(aligned: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Adds n_links, n_best and count_sum to stored `aligned` documents and drops `links`.

    The counts of all possible pairs, one number for each, go to every task: their size is set
    by the two vocabularies and does not grow with the corpus.
    """
    spark = aligned.sparkSession
    tokenizers = loaded(path_a, path_b)
    known = pair_counts(aligned).toPandas()
    counts, b = np.zeros(tokenizers.n_places, np.int64), tokenizers.b_of_places()
    counts[known["place"].to_numpy(np.int64)] = known["n"].to_numpy(np.int64)
    highest = np.zeros(len(tokenizers.bytes_b) + 1, np.int64)
    np.maximum.at(highest, b, counts)
    sent = spark.sparkContext.broadcast((counts, (counts > 0) & (counts == highest[b])))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, best = sent.value
        for batch in batches:
            links = [np.frombuffer(x.as_py(), "<u4") for x in batch.column("links")]
            scores = [[len(x) for x in links], [int(best[x].sum()) for x in links], [int(counts[x].sum()) for x in links]]
            kept = batch.drop_columns(["links"])
            yield pa.record_batch(
                [*kept.columns, *[pa.array(s, pa.int64()) for s in scores]], [*kept.schema.names, "n_links", "n_best", "count_sum"]
            )

    fields = [f"`{name}` {kind}" for name, kind in aligned.dtypes if name != "links"]
    return aligned.mapInArrow(run, ", ".join([*fields, "n_links long", "n_best long", "count_sum long"]))


def op11_interval_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: tokens, groups, links and their corpus-wide counts.

    Null and empty texts, and those a tokenizer does not give back, have zeros and no digest.
    Null ids and repeated rows keep a row each; an empty table gives no rows.
    """
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    aligned = stash(aligned_documents(table(spark, folder, "documents"), a, b), "aligned")
    done = with_link_scores(aligned, a, b)
    return done.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
