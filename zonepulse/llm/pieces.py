"""SentencePiece encoding and decoding with a batched Viterbi search in numpy.

The model file is a byte-pair one: its encoding of a word is the only path through the word's
pieces in which every piece may follow the one before, that is, no merge the model ranks higher
would have joined letters across their border. So the lattice's arcs score 0 if they may follow
and minus infinity if not, and Viterbi search finds that path. Words of equal length advance
together: hashes of their substrings are looked up among the sorted hashes of all pieces, and
the best arc into each place is stored as a backpointer.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame, SparkSession, functions as F

from zonepulse.llm.common import table

SPACE = "▁"
_BASE = 0x9E3779B97F4A7C15
_BACK = np.uint64(pow(_BASE, -1, 1 << 64))
_BASE = np.uint64(_BASE)


class Pieces:
    """Pieces of a model file, and which may follow which."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        names = {model.id_to_piece(i): i for i in plain}
        #: Pieces of spaces alone join last, and are joined after the search.
        self.spaces = {len(name): i for name, i in names.items() if name.strip(SPACE) == ""}
        words = {name: i for name, i in names.items() if name.strip(SPACE) or name == SPACE}
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.unknown = n
        # Rank of a piece's last merge, -1 for single letters; the pieces that merge joins.
        self.rank = np.full(n + 1, -1, np.int64)
        self.left, self.right = np.arange(n + 1), np.arange(n + 1)
        order = sorted((name for name in words if len(name) > 1), key=lambda name: (-model.get_score(words[name]), words[name]))
        for rank, name in enumerate(order):
            self.rank[words[name]] = rank
        joins = {}
        for name in order:
            for cut in range(1, len(name)):
                a, b = words.get(name[:cut]), words.get(name[cut:])
                if a is not None and b is not None:
                    joins[a * (n + 1) + b] = self.rank[words[name]]
        self.join_keys = np.array(sorted(joins), np.int64)
        self.join_ranks = np.array([joins[k] for k in self.join_keys.tolist()], np.int64)
        # Shorter pieces come first, as the halves of a piece must be known before it.
        self.longest = max(map(len, words))
        sizes: dict[int, list[str]] = {}
        for name in order:
            sizes.setdefault(len(name), []).append(name)
        for size, open_ in sorted(sizes.items()):
            for cut in range(1, size):
                halves = [(words[name], words.get(name[:cut], n), words.get(name[cut:], n)) for name in open_]
                whole, a, b = np.array(halves, np.int64).T
                rank = self.rank[whole]
                fits = (a < n) & (b < n) & (self.rank[a] < rank) & (self.rank[b] < rank)
                self.left[whole[fits]], self.right[whole[fits]] = a[fits], b[fits]
                fits[fits] = self._follows(a[fits], b[fits], rank[fits])
                open_ = [name for name, found in zip(open_, fits) if not found]
                if not open_:
                    break
        codes = np.array([self._hash([ord(c) for c in name]) for name in words], np.uint64)
        sort = np.argsort(codes)
        self.codes, self.ids = codes[sort], np.fromiter(words.values(), np.int64, len(words))[sort]
        if len(np.unique(codes)) < len(codes):
            raise ValueError("two pieces have one hash")
        #: Whether any piece's code has these first bits; most substrings are out by that.
        self.begins = np.zeros(1 << 20, bool)
        self.begins[codes >> np.uint64(44)] = True
        text = {i: name.replace(SPACE, " ").encode() for name, i in names.items()}
        text |= {i: bytes([b]) for b, i in enumerate(self.bytes)}
        self.text = [text.get(i, b"") for i in range(n)]
        self.known: dict[str, bytes] = {}

    @staticmethod
    def _hash(points: list[int]) -> int:
        code, power = 0, 1
        for point in points:
            code = (code + (point + 1) * power) & 0xFFFFFFFFFFFFFFFF
            power = power * int(_BASE) & 0xFFFFFFFFFFFFFFFF
        return code

    def _joined(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the piece that a and b make, or a rank beyond all."""
        keys = a * (self.unknown + 1) + b
        at = np.minimum(np.searchsorted(self.join_keys, keys), len(self.join_keys) - 1)
        return np.where(self.join_keys[at] == keys, self.join_ranks[at], 1 << 40)

    def _follows(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether pieces a and b stay apart side by side.

        The later of their last merges is undone, again and again; at each step, a merge across
        the border that ranks before the one undone would have come first. Of equal merges the
        left one comes first.
        """
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), 1 << 39) if limit is None else limit.copy()
        apart, open_ = np.ones(len(a), bool), np.arange(len(a))
        while len(open_):
            x, y = a[open_], b[open_]
            crossed = self._joined(x, y) < limit[open_]
            apart[open_[crossed]] = False
            rx, ry = self.rank[x], self.rank[y]
            on = ~crossed & ((rx >= 0) | (ry >= 0))
            undo_left = on & (rx > ry)
            undo_right = on & ~undo_left
            at = open_[undo_left]
            limit[at], a[at] = rx[undo_left], self.right[x[undo_left]]
            at = open_[undo_right]
            limit[at], b[at] = ry[undo_right] + 1, self.left[y[undo_right]]
            open_ = open_[on]
        return apart

    def follows(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        pairs, back = np.unique(a * (self.unknown + 1) + b, return_inverse=True)
        return self._follows(*np.divmod(pairs, self.unknown + 1))[back]

    def search(self, words: list[str]) -> list[bytes]:
        """Ids of words of one length, as little-endian 32-bit numbers."""
        length, n = len(words[0]), len(words)
        points = np.array([[ord(c) for c in w] for w in words], np.uint64).reshape(n, length)
        power = np.multiply.accumulate(np.r_[np.uint64(1), np.full(length, _BASE)])
        inverse = np.multiply.accumulate(np.r_[np.uint64(1), np.full(length, _BACK)])
        sums = np.zeros((n, length + 1), np.uint64)
        np.cumsum((points + np.uint64(1)) * power[:length], axis=1, out=sums[:, 1:])
        last = np.full((n, length + 1), -1, np.int64)
        back = np.zeros((n, length + 1), np.int64)
        for end in range(1, length + 1):
            starts = np.arange(max(0, end - self.longest), end)
            codes = (sums[:, end : end + 1] - sums[:, starts]) * inverse[starts]
            likely = self.begins[codes >> np.uint64(44)]
            some = codes[likely]
            at = np.minimum(np.searchsorted(self.codes, some), len(self.codes) - 1)
            piece = np.full(codes.shape, -1)
            piece[likely] = np.where(self.codes[at] == some, self.ids[at], -1)
            piece[:, -1] = np.where(piece[:, -1] < 0, self.unknown, piece[:, -1])
            row, col = np.nonzero((piece >= 0) & ((starts == 0) | (last[:, starts] >= 0)))
            here, before = piece[row, col], last[row, starts[col]]
            score = np.full(piece.shape, -np.inf)
            fits = starts[col] == 0
            inner = np.flatnonzero(~fits)
            fits[inner] = self.follows(before[inner], here[inner])
            score[row[fits], col[fits]] = 0.0
            best = score.argmax(axis=1)
            found = score[np.arange(n), best] == 0.0
            last[found, end] = piece[found, best[found]]
            back[found, end] = starts[best[found]]
        # All words are followed back at once; the places of those already at their start are -1.
        rows, end, steps = np.arange(n), np.full(n, length), []
        while end.any():
            steps.append(np.where(end > 0, last[rows, end], -1))
            end = np.where(end > 0, back[rows, end], 0)
        ids = np.stack(steps[::-1], axis=1).astype("<i4")
        used = ids >= 0
        data, ends = ids[used].tobytes(), 4 * np.cumsum(used.sum(axis=1))
        out = [data[first:stop] for first, stop in zip([0, *ends.tolist()], ends.tolist())]
        for w in np.flatnonzero((ids == self.unknown).any(axis=1)).tolist():
            out[w] = self._bytes(words[w], ids[w][used[w]])
        return out

    def _bytes(self, word: str, ids: np.ndarray) -> bytes:
        """Unknown letters become the pieces of their bytes."""
        out, at = [], 0
        for i in ids.tolist():
            if i == self.unknown:
                out += [self.bytes[b] for b in word[at].encode()]
                at += 1
            else:
                out.append(i)
                at += len(self.text[i].decode())
        return np.array(out, "<i4").tobytes()

    def learn(self, words: set[str]) -> None:
        """Searches the words that are new, those of equal length together."""
        if len(self.known) > 400_000:
            self.known.clear()
        lengths: dict[int, list[str]] = {}
        for word in words - self.known.keys():
            lengths.setdefault(len(word), []).append(word)
        for length, some in lengths.items():
            step = max(1, 200_000 // (length + 1))
            for first in range(0, len(some), step):
                part = some[first : first + step]
                self.known.update(zip(part, self.search([SPACE + w for w in part])))

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text; words not yet learned are searched."""
        if not text:
            return np.zeros(0, np.int32)
        parts = _words(text)
        if not all(map(self.known.__contains__, parts)):
            self.learn(set(parts))
        return self._join_spaces(np.frombuffer(b"".join(map(self.known.__getitem__, parts)), "<i4"))

    def _join_spaces(self, ids: np.ndarray) -> np.ndarray:
        """Runs of lone spaces become the longest pieces of spaces, from the left."""
        space = ids == self.spaces[1]
        if not (space[1:] & space[:-1]).any():
            return ids
        edges = np.flatnonzero(np.diff(space, prepend=False, append=False))
        starts, lengths = edges[::2], edges[1::2] - edges[::2]
        place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        longest = max(self.spaces)
        left = np.minimum(np.repeat(lengths, lengths) - place, longest)
        sizes = np.array([self.spaces.get(i, 0) for i in range(longest + 1)], np.int32)
        out, keep, at = ids.copy(), np.ones(len(ids), bool), np.repeat(starts, lengths) + place
        out[at], keep[at] = sizes[left], place % longest == 0
        return out[keep]

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.text.__getitem__, ids)).decode(errors="replace").removeprefix(" ")


def _words(text: str) -> list[str]:
    return text.replace(SPACE, " ").split(" ")


_LOADED: dict[str, Pieces] = {}


def loaded(path: str) -> Pieces:
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def encode_texts(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, ids, decoded): piece ids of every text, as little-endian 32-bit numbers, and the text they give.

    A null text is an empty one. Lone surrogates cannot occur in a Spark string; a literal
    U+2581 is a space to the model and comes back as one.
    """

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = loaded(path)
        for batch in batches:
            for first in range(0, len(batch), 1_000):
                some, rows = batch.iloc[first : first + 1_000], []
                texts = [body or "" for body in some["body"]]
                pieces.learn({word for body in texts for word in _words(body)})
                for value, body in zip(some["key"], texts):
                    ids = pieces.encode(body)
                    rows.append((value, ids.astype("<u4").tobytes(), pieces.decode(ids.tolist())))
                yield pd.DataFrame(rows, columns=["key", "ids", "decoded"]).astype({"key": "Int64"})

    slim = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("body"))
    return slim.mapInPandas(run, "key long, ids binary, decoded string").withColumnRenamed("key", key)


def op9_batched_viterbi(spark: SparkSession, folder: str) -> DataFrame:
    done = encode_texts(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return done.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_ids"), F.crc32("ids").alias("ids_crc32"),
        F.crc32(F.col("decoded").cast("binary")).alias("decoded_crc32"),
    )
