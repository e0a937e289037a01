"""Near-duplicate classes by Order MinHash and banded alignment.

Every text gives a few sketches. A sketch samples the word k-mers of least hash, labelled with
their occurrence so that repeats count, and keeps them in text order; equal sketches are likelier
the closer the texts are in edit distance. Texts that share a sketch meet in a bucket. All members
are aligned with the bucket's first one, linked texts become one component, and small buckets
that still hold several components compare one text of each. This joins nearly all copies.

What sketches miss is found exactly. Texts within the edit distance share a known number of word
pairs, so if the pairs of each text are put in one order, the rare ones first, two such texts
share two among their first few, at places that the edits allow. Texts of different components
that do are aligned, each member by itself: the classes are those of all pairs of texts. Where few
texts share a word pair, they meet by join, once for each stretch they share. Texts that share one
with many others are compared block by block. Word pairs are dealt with a slice of them at a time,
so that not all of their rows lie on disk at once.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from zonepulse.llm.common import components, number_all, table
from zonepulse.session import send_few, shuffles_removed, stash

SHINGLE = 5
SKETCHES = 32
SAMPLED = 3
SIMILARITY = 0.8
#: Buckets with more components than this are left to the exact search.
SMALL = 24
#: Counts of word pairs over all texts are given per so many texts, and bits of a pair's code that
#: name the slot it is counted in. Both only bear on how many texts meet: any order gives the same
#: classes. Pairs that seem rare but are not are what makes texts meet, so slots are many.
ORDER_TEXTS = 60_000
ORDER_BITS = 24
#: Bits of a word's code that name the slot it is counted in, and steps of such a count's logarithm.
WORD_BITS = 20
WORD_STEPS = 12
#: Counts of word pairs below this tell nothing, as pairs of other texts fall into the same slot.
RARE = 4
#: Texts that share one of their first word pairs meet by join; those of more than this by blocks.
MANY = 64
#: Texts of a block.
BLOCK = 128
#: First k-mers that two similar texts share at least, if they share so many at all: one is often met by chance.
MET = 2
#: Slices of the k-mers, one after the other on disk; a power of 2.
SLICES = 4
#: Pairs of blocks whose profiles move at once, some 200 kB each.
BLOCKS_AT_ONCE = 8192
#: Ids that are sent to every task to pick out their texts (a hash table of some 100 MB); if more
#: are asked for, texts and ids meet by shuffle.
IDS_SENT = 5_000_000
#: Least and most slots of a text's word counts by which pairs are told apart before their texts move; powers of 2.
PROFILE = 128, 4096
#: Texts whose codes, and slots of pairs whose profiles, a task holds at once.
TEXTS_HELD = 1_000
SLOTS_HELD = 1_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)


#: Bytes of words: digits, lower-case letters and everything outside ASCII.
_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])
_BASE = 0x9E3779B97F4A7C15
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, n of each at least."""
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(max(n, 1 << 16), base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS


def word_codes(text: str) -> np.ndarray:
    """64-bit codes of the words of a text, in order: equal words have equal codes.

    All words are hashed at once from sums over the bytes before their ends and starts.
    """
    data = np.frombuffer(text.lower().encode(), np.uint8)
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _WORD[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    power, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
    return _mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def labelled_kmers(codes: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """Codes of the k-mers in text order; the second, third, ... occurrence of one has other codes.

    A text of fewer than k words has one k-mer, all of it.
    """
    return _labelled(codes, k)[0]


def _labelled(codes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """labelled_kmers, and whether each is one of several equal k-mers."""
    n = max(1, len(codes) - k + 1)
    grams = np.zeros(n, np.uint64)
    for i in range(min(k, len(codes))):
        grams = grams * _MIX + codes[i : i + n]
    grams = _mixed(grams)
    ranked = np.sort(grams)
    again = ranked[1:] == ranked[:-1]
    if not again.any():
        return grams, np.zeros(n, bool)
    twice = ranked[1:][again]
    several = twice[np.minimum(np.searchsorted(twice, grams), len(twice) - 1)] == grams
    places = np.flatnonzero(several)
    places = places[np.argsort(grams[places], kind="stable")]
    ranked, at = grams[places], np.arange(len(places))
    new = np.r_[True, ranked[1:] != ranked[:-1]]
    seen = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64)
    grams[places] = np.where(seen > 0, _mixed(ranked + seen * _MIX), ranked)
    return grams, several


def order_sketches(kmers: np.ndarray, sketches: int = SKETCHES, sampled: int = SAMPLED) -> np.ndarray:
    """One code per sketch: its sampled k-mers, combined in text order."""
    seeds = _mixed(np.arange(1, sketches + 1, dtype=np.uint64) * _MIX)
    out = np.empty(sketches, np.uint64)
    step = max(1, 500_000 // len(kmers))
    for first in range(0, sketches, step):
        some = seeds[first : first + step, None]
        hashes = (kmers[None, :] ^ some) * (some | np.uint64(1))
        hashes ^= hashes >> np.uint64(32)
        at = np.arange(len(some))
        picks = []
        for _ in range(min(sampled, len(kmers))):
            low = hashes.argmin(axis=1)
            picks.append(low)
            hashes[at, low] = np.uint64(0xFFFFFFFFFFFFFFFF)
        code = some[:, 0].copy()
        for place in np.sort(np.stack(picks), axis=0):
            code = _mixed(code * _MIX + kmers[place])
        out[first : first + step] = code
    return out


def _gram(similarity: float) -> int:
    """Words of the k-mers of the exact search: two, or one where similar texts may share no two in a row."""
    return 2 if similarity >= 0.75 else 1


def first_kmers(codes: np.ndarray, similarity: float, often: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The k-mers of which any two similar texts share MET, unless their words are equal, and their places, both in text order.

    An edit changes at most k of the k-mers, so texts whose longer one has n words keep
    n - k + 1 - k * edits of them, at least `shared` for any n that a similar text can have. In a
    common order the first MET that both keep lie among all but the last shared - MET of each text.
    Texts that may keep fewer than MET share one at least, and all k-mers of theirs are taken.
    The order is by `often`, the counts of slots that the leading bits of a k-mer name, if they tell
    anything, then by how common its words are, then by k-mer.

    A place is that of the k-mer's first word; -1 - place if the text has the k-mer several times,
    as another text may then have kept another one than that of equal code.
    """
    n, k = len(codes), _gram(similarity)
    longer = np.arange(n, int(n / similarity + 1e-6) + 2)
    edits = ((1 - similarity) * longer + 1e-9).astype(np.int64)
    shared = (longer - k + 1 - k * edits)[edits > 0]
    if n < k or not len(shared):
        return np.empty(0, np.uint64), np.empty(0, np.int32)
    grams, several = _labelled(codes, k)
    count = often[grams >> np.uint64(64 - ORDER_BITS)].astype(np.uint64)
    words = common[codes >> np.uint64(64 - WORD_BITS)].astype(np.uint64)
    words = sum(words[i : i + len(grams)] for i in range(k))
    order = (np.where(count < RARE, np.uint64(0), count) << np.uint64(56)) | (words << np.uint64(46)) | (grams >> np.uint64(18))
    least = max(1, int(shared.min()))
    at = np.sort(np.argsort(order)[: len(grams) - least + min(MET, least)])
    return grams[at], np.where(several[at], -1 - at, at).astype(np.int32)


def order_counts(docs: DataFrame, text: str, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """How many k-mers of all texts fall into each slot, 255 at most, and of words the logarithm of that.

    K-mers of more than ORDER_TEXTS texts are counted in units that keep what is left of a count
    alike for more texts. A slice is 65,536 slots, first those of k-mers; a task adds up all of its
    texts and sends each byte of the counts that is not 0 everywhere, compressed.
    """
    body = F.col(f"`{text}`")
    unit = max(1, docs.count() / ORDER_TEXTS)
    n_grams, n_words = 1 << (ORDER_BITS - 16), 1 << (WORD_BITS - 16)

    def count(found: np.ndarray, codes: list[np.ndarray], bits: int) -> None:
        slots, n = np.unique((np.concatenate(codes) >> np.uint64(64 - bits)).astype(np.uint32), return_counts=True)
        found[slots] += n.astype("<u4")

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = np.zeros((n_grams + n_words, 1 << 16), "<u4")
        for batch in _some(batches):
            words = [word_codes(body) for body in batch["body"]]
            count(found[:n_grams].reshape(-1), [labelled_kmers(codes, _gram(similarity)) for codes in words], ORDER_BITS)
            count(found[n_grams:].reshape(-1), words, WORD_BITS)
        for i, counts in enumerate(found):
            planes = counts.view(np.uint8).reshape(-1, 4).T
            sent = [(i, p, zlib.compress(plane.tobytes(), 1)) for p, plane in enumerate(planes) if plane.any()]
            yield pd.DataFrame(sent, columns=["slice", "plane", "counts"])

    def add(part: pd.DataFrame) -> pd.DataFrame:
        found = np.zeros(1 << 16, np.int64)
        for plane, counts in zip(part["plane"], part["counts"]):
            found += np.frombuffer(zlib.decompress(counts), np.uint8).astype(np.int64) << (8 * plane)
        if part["slice"].iloc[0] < n_grams:
            kept = np.minimum(found / unit, 255).astype("<u2")
        else:
            kept = (WORD_STEPS * np.log2(found + 1)).astype("<u2")
        return pd.DataFrame({"slice": part["slice"][:1], "n": [kept.tobytes()]})

    sent = docs.where(body.isNotNull()).select(body.alias("body")).mapInPandas(run, "slice int, plane int, counts binary")
    grams, words = np.zeros((n_grams, 1 << 16), np.uint8), np.zeros((n_words, 1 << 16), np.uint16)
    for row in sent.groupBy("slice").applyInPandas(add, "slice int, n binary").collect():
        i, counts = row["slice"], np.frombuffer(row["n"], "<u2")
        if i < n_grams:
            grams[i] = counts
        else:
            words[i - n_grams] = counts
    return grams.reshape(-1), words.reshape(-1)


def slot_counts(docs: DataFrame, text: str, similarity: float) -> np.ndarray:
    """The k-mers' part of order_counts."""
    return order_counts(docs, text, similarity)[0]


def _some(batches: Iterable[pd.DataFrame], rows: int = TEXTS_HELD) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for first in range(0, len(batch), rows):
            yield batch.iloc[first : first + rows]


def sketch_table(docs: DataFrame, text: str, key: str, k: int, sketches: int, sampled: int, similarity: float = SIMILARITY) -> DataFrame:
    """(id, same, words, sketches, firsts_i, tails_i, places_i): `same` is equal for texts of equal words (or equal texts without words).

    A null text has no `same`; a text without words has no sketches. `firsts_i` and `places_i` are those of
    first_kmers in slice i, of each code the leading 32 bits and, in `tails_i`, the 8 bits after them: texts
    that meet by chance in these are aligned for nothing, which 40 bits keep rare and the tables small.
    """
    kinds = {"firsts": "array<int>", "tails": "array<tinyint>", "places": "array<int>"}
    sliced = {f"{name}_{i}": kind for i in range(SLICES) for name, kind in kinds.items()}
    order = docs.sparkSession.sparkContext.broadcast(order_counts(docs, text, similarity))

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _some(batches):
            rows = []
            for value, body in zip(batch["id"], batch["body"]):
                if body is None:
                    rows.append((value, None, 0, [], *([] for _ in sliced)))
                    continue
                codes = word_codes(body)
                plain = codes.tobytes() if len(codes) else b"\0" + body.encode()
                found = order_sketches(labelled_kmers(codes, k), sketches, sampled).view(np.int64) if len(codes) else []
                first, at = first_kmers(codes, similarity, *order.value)
                of = (first >> np.uint64(65 - SLICES.bit_length())).astype(np.uint8)
                dealt = np.argsort(of, kind="stable")
                first, at, stops = first[dealt], at[dealt], [0, *np.cumsum(np.bincount(of, minlength=SLICES))]
                lead, tail = (first >> np.uint64(32)).astype(np.uint32).view(np.int32), (first >> np.uint64(24)).astype(np.uint8).view(np.int8)
                parts = [column[stops[i] : stops[i + 1]] for i in range(SLICES) for column in (lead, tail, at)]
                rows.append((value, hashlib.blake2b(plain, digest_size=16).digest(), len(codes), found, *parts))
            frame = pd.DataFrame(rows, columns=["id", "same", "words", "sketches", *sliced])
            yield frame.astype({"id": "Int64"})

    slim = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("body"))
    return slim.mapInPandas(run, ", ".join(["id long, same binary, words int, sketches array<long>", *(f"{c} {kind}" for c, kind in sliced.items())]))


def banded_distances(pairs: list[tuple[np.ndarray, np.ndarray]], band: int) -> np.ndarray:
    """Cost of the best alignment of each pair's words within `band` diagonals of the main one.

    It is the edit distance if it is at most `band`, and never less than that.

    One row of all pairs' tables is filled at a time, over the diagonals within the band. A
    step to the right depends on the cell before it: a running minimum along the row.
    """
    far = np.int32(1 << 28)
    n = np.array([len(a) for a, _ in pairs])
    m = np.array([len(b) for _, b in pairs])
    rows, width = int(n.max()), 2 * band + 1
    left = np.zeros((len(pairs), max(rows, 1)), np.uint64)
    right = np.zeros((len(pairs), max(rows + width, int(m.max()) + band + 1)), np.uint64)
    for p, (a, b) in enumerate(pairs):
        left[p, : len(a)] = a
        right[p, band : band + len(b)] = b
    steps = np.arange(width, dtype=np.int32)
    cells = np.broadcast_to(np.where(steps >= band, steps - band, far), (len(pairs), width)).astype(np.int32)
    out = np.full(len(pairs), far)
    end = m - n + band
    reached = (end >= 0) & (end < width)
    for row in range(rows + 1):
        if row:
            step = cells + (left[:, row - 1 : row] != right[:, row - 1 : row - 1 + width])
            step[:, :-1] = np.minimum(step[:, :-1], cells[:, 1:] + 1)
            cells = np.minimum.accumulate(step - steps, axis=1) + steps
        done = np.flatnonzero(reached & (n == row))
        if len(done):
            out[done] = cells[done, end[done]]
    return out


def _trimmed(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without common words at both ends, which no distance depends on."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    head = int(differ[0]) if len(differ) else n
    a, b = a[head:], b[head:]
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[len(a) - n :][::-1] != b[len(b) - n :][::-1])
    tail = int(differ[0]) if len(differ) else n
    return a[: len(a) - tail], b[: len(b) - tail]


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """Words in common, as bags."""
    x, nx = np.unique(a, return_counts=True)
    y, ny = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    return int(np.minimum(nx[i], ny[j]).sum())


def _cost(a: np.ndarray, b: np.ndarray) -> int:
    """The cost of one alignment, which the edit distance is not above.

    It follows words that b has once, in order, as far ahead as the one before or after them, and
    what comes after each of them up to the next, at the same distance.
    """
    if not len(a) or not len(b):
        return max(len(a), len(b))
    order = np.argsort(b)
    ranked = b[order]
    once = np.r_[True, ranked[1:] != ranked[:-1], True]
    once = once[1:] & once[:-1]
    at = np.minimum(np.searchsorted(ranked, a), len(b) - 1)
    p = np.flatnonzero((ranked[at] == a) & once[at])
    q = order[at[p]]
    alike = np.r_[False, np.diff(q - p) == 0, False]
    kept = (alike[1:] | alike[:-1])[: len(p)]
    p, q = p[kept], q[kept]
    ahead = q > np.r_[-1, np.maximum.accumulate(q)][: len(q)]
    p, q = np.r_[-1, p[ahead], len(a)], np.r_[-1, q[ahead], len(b)]
    i = np.arange(len(a))
    last = np.searchsorted(p, i, "right") - 1
    j = q[last] + i - p[last]
    i, j = i[j < q[last + 1]], j[j < q[last + 1]]
    return int(np.maximum(np.diff(p), np.diff(q)).sum()) - 1 - int((a[i] == b[j]).sum())


def similar_pairs(pairs: list[tuple[np.ndarray, np.ndarray]], similarity: float) -> list[bool]:
    """Whether each pair's similarity (1 - edit distance / longer length) suffices.

    Pairs whose bags of words differ too much are out at once, those that a first alignment shows
    to be near enough are in; the others are aligned in bands that widen until an alignment is good
    enough or the band holds every one that could be.
    """
    out = [False] * len(pairs)
    open_ = []
    for p, (a, b) in enumerate(pairs):
        longer = max(len(a), len(b))
        most = int((1 - similarity) * longer + 1e-9)
        if longer - min(len(a), len(b)) > most:
            continue
        x, y = _trimmed(a, b)
        if _cost(x, y) <= most:
            out[p] = True
        elif max(len(x), len(y)) - _shared(x, y) <= most:
            open_.append((p, x, y, most))
    band = 8
    while open_:
        open_.sort(key=lambda o: len(o[1]))
        later, first = [], 0
        while first < len(open_):
            some = [open_[first]]
            room = 4_000_000 // (2 * band + 1)
            while first + len(some) < len(open_) and len(some) < 128:
                more = open_[first + len(some)]
                if (len(some) + 1) * (2 * band + 1) > room or len(more[1]) > 2 * len(some[0][1]) + 32:
                    break
                some.append(more)
            first += len(some)
            for (p, x, y, most), distance in zip(some, banded_distances([(o[1], o[2]) for o in some], band)):
                if distance <= most:
                    out[p] = True
                elif band < most:
                    later.append((p, x, y, most))
        open_, band = later, band * 4
    return out


def word_profile(codes: np.ndarray) -> np.ndarray:
    """How many words fall into each slot, 255 at most; a text has half as many slots as words, or up to twice that.

    An edit changes the counts of two texts' slots by 2 in sum at most, so half the sum of their
    differences, the difference in length added, is never more than their edit distance. That
    holds for neighbouring slots added up as well, if one text has more slots.
    """
    size = min(max(1 << (len(codes).bit_length() - 1) if len(codes) else 1, PROFILE[0]), PROFILE[1])
    found = np.bincount((codes >> np.uint64(65 - size.bit_length())).astype(np.int64), minlength=size)
    return np.minimum(found, 255).astype(np.uint8)


def _profiles(texts: DataFrame) -> DataFrame:
    """(node, n, slots): length and profile of each text."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _some(batches):
            codes = [word_codes(text) for text in batch["text"]]
            yield pd.DataFrame({"node": batch["node"], "n": [len(c) for c in codes], "slots": [word_profile(c).tobytes() for c in codes]})

    return stash(texts.mapInPandas(run, "node long, n int, slots binary"), "profiles")


def _slots(column: pd.Series, size: int) -> np.ndarray:
    """Profiles of equally many slots, added up to `size` slots."""
    slots = np.frombuffer(b"".join(column), np.uint8).reshape(len(column), size, -1)
    return slots.sum(axis=2, dtype=np.int16)


def _allowed(a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray, similarity: float) -> np.ndarray:
    """Whether the slots a and b of texts of n and m words allow the similarity."""
    least = (np.abs(a - b).sum(axis=1, dtype=np.int64) + np.abs(n - m)) // 2
    return least <= ((1 - similarity) * np.maximum(n, m) + 1e-9).astype(np.int64)


def may_be_similar(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Those of the pairs (a, b) whose word counts allow the similarity: no similar pair is left out.

    What moves for a pair is a profile, not a text.
    """

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            alike = batch.groupby([batch["slots_a"].str.len(), batch["slots_b"].str.len()])
            for sizes, some in ((sizes, some) for sizes, rows in alike for some in _some([rows], SLOTS_HELD // max(sizes))):
                a, b = (_slots(some[c], min(sizes)) for c in ("slots_a", "slots_b"))
                yield some[["a", "b"]][_allowed(a, some["n_a"].to_numpy(), b, some["n_b"].to_numpy(), similarity)]

    known = _profiles(texts)
    a, b = (known.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("slots").alias(f"slots_{x}")) for x in "ab")
    return pairs.select("a", "b").join(b, "b").join(a, "a").mapInPandas(run, "a long, b long")


def verify(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """(a, b, similar) of the pairs (a, b): texts meet by join, and are aligned a batch at a time."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: dict[int, np.ndarray] = {}

        def codes(key: int, text: str) -> np.ndarray:
            if key not in kept:
                if len(kept) > 500:
                    kept.clear()
                kept[key] = word_codes(text)
            return kept[key]

        for batch in batches:
            for first in range(0, len(batch), 256):
                some = batch.iloc[first : first + 256]
                both = [(codes(a, x), codes(b, y)) for a, b, x, y in zip(some["a"], some["b"], some["text_a"], some["text_b"])]
                yield pd.DataFrame({"a": some["a"], "b": some["b"], "similar": similar_pairs(both, similarity)})

    b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    return pairs.select("a", "b").join(b, "b").join(a, "a").select("a", "b", "text_a", "text_b").mapInPandas(
        run, "a long, b long, similar boolean"
    )


class _Links:
    """What has been compared so far, the links found, and the components of those followed."""

    def __init__(self, texts: DataFrame, similarity: float):
        self.texts, self.similarity = texts, similarity
        self.tried: DataFrame | None = None
        self.labels: DataFrame | None = None
        self.fresh: list[DataFrame] = []

    def texts_of(self, pairs: DataFrame) -> DataFrame:
        """(node, text) of the texts in `pairs`, one row each. Other texts do not move if the ids can be sent."""
        return self.texts_named(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct())

    def texts_named(self, nodes: DataFrame) -> DataFrame:
        nodes = stash(nodes, "nodes")
        wanted = F.broadcast(nodes) if nodes.count() <= IDS_SENT else nodes
        return self.texts.join(wanted, "node", "left_semi").dropDuplicates(["node"])

    def add(self, pairs: DataFrame, profiled: bool = False) -> None:
        """Verifies the new ones among `pairs` (a, b, words_a, words_b) whose lengths allow the similarity.

        `profiled`: most are unlike, so their word counts are compared first.
        """
        fits = F.least("words_a", "words_b") >= F.greatest("words_a", "words_b") * (self.similarity - 1e-9)
        pairs = pairs.where(fits).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
        if self.tried is not None:
            pairs = pairs.join(self.tried.select("a", "b"), ["a", "b"], "left_anti")
        pairs = stash(pairs, "pairs")
        if profiled and not pairs.isEmpty():
            pairs = stash(may_be_similar(pairs, self.texts_of(pairs), self.similarity), "pairs")
        if pairs.isEmpty():
            return
        found = stash(verify(pairs, stash(self.texts_of(pairs), "texts"), self.similarity), "verified")
        self.tried = found if self.tried is None else self.tried.unionByName(found)
        self.fresh.append(found.where("similar").select("a", "b"))

    def follow(self) -> None:
        """Takes the links found since the last call into the components."""
        if self.fresh:
            self.labels = components(reduce(DataFrame.unionByName, self.fresh), self.labels)
            self.fresh = []

    def with_component(self, members: DataFrame) -> DataFrame:
        if self.labels is None:
            return members.withColumn("comp", F.col("node"))
        labels = self.labels.withColumnRenamed("id", "node")
        return members.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def _shared_buckets(buckets: DataFrame) -> DataFrame:
    """Members (bucket, node, words) of buckets with two texts or more, with the bucket's first text."""
    groups = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("first"))
    groups = stash(groups.where("n > 1").select("bucket", "first"), "groups")
    return stash(buckets.join(groups, "bucket").select("bucket", "node", "words", "first"), "members")


def _star(members: DataFrame) -> DataFrame:
    """Every member next to its bucket's first text."""
    centres = members.where("first = node").select("bucket", F.col("words").alias("words_a")).dropDuplicates(["bucket"])
    others = members.where("first <> node").select("bucket", F.col("first").alias("a"), F.col("node").alias("b"), F.col("words").alias("words_b"))
    return others.join(centres, "bucket").drop("bucket")


def _apart(nodes: DataFrame, similarity: float) -> DataFrame:
    """Places of the first k-mers that texts (node, words, firsts, tails, places, comp) of different components share, and of how many texts (n).

    Without those that no other text of a fitting length has: the next one in length tells.
    """
    first = nodes.select("node", "words", "comp", "tails", "places", F.posexplode("firsts").alias("i", "first"))
    gram = F.col("first").cast("long") * 256 + F.col("tails")[F.col("i")]
    first = first.select("node", "words", "comp", F.col("places")[F.col("i")].alias("place"), gram.alias("gram"))
    all_of = Window.partitionBy("gram")
    met = first.select("*", F.count(F.lit(1)).over(all_of).alias("n"), F.min("comp").over(all_of).alias("lo"), F.max("comp").over(all_of).alias("hi"))
    by_length = all_of.orderBy("words")
    met = met.where("lo < hi").select("*", F.lag("words").over(by_length).alias("shorter"), F.lead("words").over(by_length).alias("longer"))
    least = similarity - 1e-9
    fits = (F.col("shorter") >= F.col("words") * least) | (F.col("words") >= F.col("longer") * least)
    return stash(met.where(fits).select("node", "words", "comp", "place", "gram", "n"), "met")


def _joined(few: DataFrame, similarity: float) -> DataFrame:
    """Pairs of texts of different components that share MET k-mers of `few` at places that the edits allow, or one if similar texts of their lengths may share no more.

    A k-mer that a text has once, kept by both, has as many words before and after it in both but
    for inserted and deleted ones. If the k-mer before it in `few` is the same and as far away, the
    two meet there, or before it: a row is made once for each stretch, and counts as two if the
    stretch goes on.
    """
    spot = F.when(F.col("place") < 0, -1 - F.col("place")).otherwise(F.col("place"))
    in_text = Window.partitionBy("node", "words").orderBy("spot", "gram")
    few = few.select("node", "words", "comp", "gram", (F.col("place") >= 0).alias("once"), spot.alias("spot"))
    before, gap = F.lag("gram").over(in_text), F.col("spot") - F.lag("spot").over(in_text)
    after, step = F.lead("gram").over(in_text), F.lead("spot").over(in_text) - F.col("spot")
    linked = F.when(F.col("once") & before.isNotNull(), F.xxhash64(before, gap)).alias("before")
    goes_on = F.when(F.lead("once").over(in_text), F.xxhash64(after, step)).alias("after")
    few = stash(few.select("*", linked, goes_on), "few")
    fits = F.least("words_a", "words_b") >= F.greatest("words_a", "words_b") * (similarity - 1e-9)
    other = (F.col("node_a") < F.col("node_b")) & (F.col("comp_a") != F.col("comp_b")) & fits
    ahead = F.col("spot_a") - F.col("spot_b")
    moved = F.abs(ahead) + F.abs(F.col("words_a") - F.col("words_b") - ahead)
    near = ~F.col("once_a") | ~F.col("once_b") | (moved <= (1 - similarity) * F.greatest("words_a", "words_b") + 1e-9)
    again = F.coalesce(F.col("before_a") == F.col("before_b"), F.lit(False))
    meets = F.when(F.col("after_a") == F.col("after_b"), 2).otherwise(1)
    pair, rows = ["a", "b", "words_a", "words_b"], []
    for i in range(SLICES):
        some = few.where(_slice_of("gram") == i)
        a, b = (some.select("gram", *[F.col(c).alias(f"{c}_{x}") for c in few.columns if c != "gram"]) for x in "ab")
        met = a.join(b, (a["gram"] == b["gram"]) & other & near & ~again)
        met = met.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"), "words_a", "words_b", meets.alias("meets"))
        rows.append(stash(met.groupBy(pair).agg(F.sum("meets").alias("meets")), "met_in"))
    k, longer = _gram(similarity), F.greatest("words_a", "words_b")
    keep = longer - k + 1 - k * F.floor((1 - similarity) * longer + 1e-9)
    found = reduce(DataFrame.unionByName, rows).groupBy(pair).agg(F.sum("meets").alias("meets"))
    return found.where((F.col("meets") >= MET) | (keep < MET)).select(pair)


def _slice_of(gram: str) -> Column:
    """The slice of the 40 leading bits of a k-mer, as _apart gives them."""
    return F.shiftright(F.col(gram), 41 - SLICES.bit_length()).bitwiseAND(SLICES - 1)


def _by_blocks(many: DataFrame, links: _Links, similarity: float) -> DataFrame:
    """Pairs of texts of different components whose word counts allow the similarity, of those that share a k-mer of `many`.

    Texts whose rarest such k-mer is the same lie together. Blocks that share a k-mer are compared
    whole, so each text moves once per block and not once per text or k-mer it meets.
    """

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        same = part["x"].iloc[0] == part["y"].iloc[0]
        size = part["slots"].str.len()
        out = [(np.empty(0, np.int64),) * 4]
        for p, a in part[part["x"] == part["block"]].groupby(size):
            for q, b in part[part["y"] == part["block"]].groupby(size):
                slots_a, slots_b = _slots(a["slots"], min(p, q)), _slots(b["slots"], min(p, q))
                nodes, words, comps = (b[c].to_numpy() for c in ("node", "n", "comp"))
                for i, (node, n, comp) in enumerate(zip(a["node"], a["n"], a["comp"])):
                    yes = _allowed(slots_a[i : i + 1], np.array([n]), slots_b, words, similarity) & (comps != comp)
                    at = np.flatnonzero(yes & (nodes > node) if same else yes)
                    out.append((np.full(len(at), node), nodes[at], np.full(len(at), n), words[at]))
        return pd.DataFrame(dict(zip(("a", "b", "words_a", "words_b"), map(np.concatenate, zip(*out)))))

    texts = many.groupBy("node").agg(F.min("words").alias("words"), F.min("comp").alias("comp"), F.min_by("gram", F.struct("n", "gram")).alias("home"))
    placed, _ = number_all(stash(texts, "crowd"), ["home", "comp", "words", "node"], "at")
    blocks = stash(placed.select("node", "words", "comp", F.expr(f"at div {BLOCK}").alias("block")), "blocks")
    spans = blocks.groupBy("block").agg(F.min("words").alias("lo"), F.max("words").alias("hi"), F.min("comp").alias("c0"), F.max("comp").alias("c1"))
    grams = stash(many.select("node", "gram").join(blocks.select("node", "block"), "node").select("block", "gram").distinct(), "grams")
    x, y = (grams.select("gram", F.col("block").alias(c)) for c in "xy")
    pairs = x.join(y, "gram").where("x <= y").select("x", "y").distinct()
    for c in "xy":
        pairs = pairs.join(spans.select(F.col("block").alias(c), *[F.col(v).alias(f"{v}_{c}") for v in ("lo", "hi", "c0", "c1")]), c)
    least = similarity - 1e-9
    fit = (F.col("hi_x") >= F.col("lo_y") * least) & (F.col("hi_y") >= F.col("lo_x") * least)
    pairs = stash(pairs.where(fit & (F.least("c0_x", "c0_y") < F.greatest("c1_x", "c1_y"))).select("x", "y"), "block_pairs")
    known = blocks.select("node", "comp", "block").join(_profiles(links.texts_named(blocks.select("node"))), "node")
    runs, found = max(1, -(-pairs.count() // BLOCKS_AT_ONCE)), []
    known = stash(known, "known") if runs > 1 else known
    for i in range(runs):
        some = pairs.where(F.pmod(F.xxhash64("x", "y"), F.lit(runs)) == i)
        ends = some.select("x", "y", F.explode(F.array_distinct(F.array("x", "y"))).alias("block"))
        alike = ends.join(known, "block").groupBy("x", "y").applyInPandas(compare, "a long, b long, words_a int, words_b int")
        found.append(stash(alike, "alike") if runs > 1 else alike)
    return reduce(DataFrame.unionByName, found)


def _classes(docs: DataFrame, text: str, key: str, similarity: float, shingle: int, sketches: int, sampled: int, small: int) -> tuple[DataFrame, DataFrame]:
    """The sketch table, and (same, exact_id, class_id) of what is in it."""
    signed = stash(sketch_table(docs, text, key, shingle, sketches, sampled, similarity), "sketches")
    firsts = stash(signed.where("same IS NOT NULL").groupBy("same").agg(F.min("id").alias("node")), "firsts")
    on = (signed["same"] == firsts["same"]) & (signed["id"] == firsts["node"])
    reps = signed.where("words > 0").join(firsts, on).select("node", "words", "sketches").dropDuplicates(["node"])
    exploded = reps.select("node", "words", F.explode("sketches").alias("bucket"))
    members = _shared_buckets(exploded)
    texts = docs.select(F.col(f"`{key}`").cast("long").alias("node"), F.col(f"`{text}`").alias("text"))
    links = _Links(texts, similarity)
    links.add(_star(members))
    links.follow()
    one = links.with_component(members).groupBy("bucket", "comp").agg(F.min("node").alias("node"), F.min_by("words", "node").alias("words"))
    one = stash(one, "one")
    several = one.groupBy("bucket").agg(F.count(F.lit(1)).alias("comps"))
    few = one.join(several.where(F.col("comps").between(2, small)).select("bucket"), "bucket")
    left = few.select("bucket", F.col("node").alias("a"), F.col("words").alias("words_a"))
    right = few.select("bucket", F.col("node").alias("b"), F.col("words").alias("words_b"))
    links.add(left.join(right, "bucket").where("a < b").drop("bucket"))
    links.follow()
    named = stash(links.with_component(firsts), "named")
    # One join of the k-mers of each slice, in the rows they were written to, with what is small.
    slices = []
    for i in range(SLICES):
        columns = [F.col(f"{name}_{i}").alias(name) for name in ("firsts", "tails", "places")]
        firsts_of = signed.where("words > 0").select("id", "words", *columns, F.col("same").alias("of"))
        nodes = firsts_of.join(named, (F.col("of") == F.col("same")) & (F.col("id") == F.col("node")))
        slices.append(_apart(nodes, similarity))
    met = reduce(DataFrame.unionByName, slices)
    links.add(_joined(met.where(F.col("n") <= MANY), similarity), profiled=True)
    many = met.where(F.col("n") > MANY)
    if not many.isEmpty():
        links.add(_by_blocks(many, links, similarity))
    links.follow()
    named = links.with_component(firsts)
    return signed, stash(named.select("same", F.col("node").alias("exact_id"), F.col("comp").alias("class_id")), "classes")


def near_duplicates(
    docs: DataFrame, text: str = "text", key: str = "doc_id", similarity: float = SIMILARITY, shingle: int = SHINGLE,
    sketches: int = SKETCHES, sampled: int = SAMPLED, small: int = SMALL,
) -> DataFrame:
    """(key, class_id, exact_id) of every row: class_id is the smallest key of its class.

    Texts of equal words (letters' case and signs aside) are one class at once, named by
    exact_id. Texts are linked if their word edit distance is at most 1 - similarity of the
    longer one, whether they share a sketch or not; a class is what links connect. Words are lower-cased runs
    of ASCII letters, digits and all that is not ASCII. A row without text is a class of its own, texts without words are
    alike only if equal, a text shorter than the shingle is one shingle. Rows without key get
    null ids; rows that share a key share a class. An empty table gives no rows.
    """
    with shuffles_removed(docs.sparkSession):
        signed, named = _classes(docs, text, key, similarity, shingle, sketches, sampled, small)
    out = signed.select("id", "same").join(named, "same", "left")
    alone = F.col("same").isNull()
    return out.select(
        F.col("id").alias(key), F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("id")).otherwise(F.col("exact_id")).alias("exact_id"),
    )


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """The documents without those of a class but its smallest key; a repeated row stays once."""
    classes = near_duplicates(docs, text, key, **options)
    dropped = classes.where(F.col(key) != F.col("class_id")).select(key).distinct()
    return docs.join(dropped, key, "left_anti").select(*docs.columns).dropDuplicates([key, text])


def op1_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    send_few(spark)
    found = near_duplicates(table(spark, folder, "documents"))
    return found.withColumn("kept", F.col("doc_id") == F.col("class_id"))
