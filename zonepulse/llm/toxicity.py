"""Toxicity of texts after undoing disguises of words with a noisy channel.

A character language model is counted from all texts. A token that looks disguised (signs or
digits for letters, stretched letters, letters set apart) becomes a lattice: each written sign
may stand for several letters, a repeat or a separator may stand for none, each at a cost.
Viterbi decoding finds the likeliest word under the language model. The restored words and
their stems are scored with weights learned from labelled texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from zonepulse.llm.common import table
from zonepulse.llm.neardup import labelled_kmers, word_codes
from zonepulse.session import stash

#: Labelled rows that the weights are fitted on, in expectation.
FIT_ROWS = 20_000
#: Features considered, the surest first, and the size of the model.
MOST_FEATURES = 5_000
#: A feature lies this many standard errors above zero, this share of its texts are toxic, and
#: this share of the toxic texts have it.
SURE, LEAST_SHARE, LEAST_PART = 3.2, 0.9, 0.01
#: What each feature after the strongest adds to a text's log odds.
MORE = 0.5
#: Beginnings of words that are features besides the words: many toxic words share a stem.
STEMS = (4, 5, 6, 7)
THRESHOLD = 0.7

#: Letters that a written sign may stand for, besides itself.
STANDS_FOR = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
    "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "<": "c",
}
SEPARATORS = " .-_*~'`,/"
SWAP, SKIP_REPEAT, SKIP_SEPARATOR = 0.5, 0.7, 0.2

_STRIP = " .,;:!?*%&#$\"'()[]{}|<>/\\-_~`…«»“”’‘¿¡@+"
_PLAIN = re.compile(r"[^\W\d_]+")
_STRETCHED = re.compile(r"([^\W\d_])\1\1")
_APART = re.compile(r"(?<![^\s])[^\s](?:[ ][^\s]){2,}(?![^\s])")
_LETTER = re.compile(r"[^\W\d_]")
_INNER = re.compile(r"^[^\W_](?:[ .\-_*~'`,/]+[^\W_])+$")
_RUN = re.compile(r"(.)\1{8,}")
_SIGNS = "".join(map(re.escape, STANDS_FOR))
_BESIDE = re.compile(rf"[{_SIGNS}][^\W\d_]|[^\W\d_][{_SIGNS}]")
_EDGE = "\0"


def features(word: str) -> list[str]:
    """A word and its stems, which end in a dash."""
    return [word, *[word[:n] + "-" for n in STEMS if len(word) >= n]]


@dataclass
class Model:
    """Counts of letter triples, log odds of texts with each feature, and of texts without any."""

    triples: dict[str, int]
    weights: dict[str, float]
    base: float
    pairs: Counter = field(default_factory=Counter)
    letters: int = 1
    seen: dict[str, str] = field(default_factory=dict)
    known: dict[str, tuple[str, ...]] = field(default_factory=dict)
    heads: set[str] = field(default_factory=set)

    def __post_init__(self):
        for gram, n in self.triples.items():
            self.pairs[gram[:2]] += n
        self.heads = {f[:n] for f in self.weights for n in range(1, len(f) + 1)}
        self.letters = len({c for gram in self.triples for c in gram}) + 1

    def cost(self, gram: str) -> float:
        return -np.log((self.triples.get(gram, 0) + 0.05) / (self.pairs.get(gram[:2], 0) + 0.05 * self.letters))

    def hits(self, token: str) -> tuple[str, ...]:
        """Weighted features of the words behind a token, which is decoded if it looks disguised."""
        found = self.known.get(token)
        if found is None:
            if len(self.known) > 300_000:
                self.known.clear()
            words = set(plain_words(token))
            core = token.strip(_STRIP)
            # A sign next to a letter may be a letter of the word, also its first or last.
            odd = _BESIDE.search(token) or _STRETCHED.search(core) if core.isalpha() else _disguised(token)
            if odd:
                forms = _forms(_RUN.sub(lambda m: m[1] * 8, token))
                words |= {decode(form, self) for form in forms if len(form) > 2 and may_hit(form, self)}
                if _APART.fullmatch(token) and may_hit(token, self, anywhere=True):
                    words |= set(decode_words(token, self))
            found = self.known[token] = tuple(sorted({f for w in words for f in features(w) if f in self.weights}))
        return found


def _forms(token: str) -> set[str]:
    """A token, and it without the signs around it, of which those next to it may be its own."""
    core = token.strip(_STRIP)
    first = last = len(token) - len(token.lstrip(_STRIP)) if core else 0
    end = final = first + len(core)
    while first and token[first - 1] in STANDS_FOR:
        first -= 1
    while final < len(token) and token[final] in STANDS_FOR:
        final += 1
    return {token, *[token[a:b] for a in range(first, last + 1) for b in range(end, final + 1)]}


def _arcs(sign: str, previous: str) -> list[tuple[str, float]]:
    """Letters that a sign may stand for, or none, and their costs."""
    arcs = [(sign, 0.0)] if _LETTER.match(sign) else []
    arcs += [(letter, SWAP) for letter in STANDS_FOR.get(sign, "")]
    if sign in SEPARATORS:
        arcs.append(("", SKIP_SEPARATOR))
    elif sign == previous:
        arcs.append(("", SKIP_REPEAT))
    return arcs or [("", 4.0)]


def may_hit(token: str, model: Model, anywhere: bool = False) -> bool:
    """Whether any path of a token's lattice spells a weighted word or stem, from its start or anywhere."""
    heads, previous = {""}, ""
    for sign in token:
        further = {""} if anywhere else set()
        for letter, _ in _arcs(sign, previous):
            further |= {h + letter for h in heads if not letter or h + letter in model.heads}
        if any(h + "-" in model.weights or anywhere and h in model.weights for h in further):
            return True
        if not further:
            return False
        heads, previous = further, sign
    return any(h in model.weights for h in heads)


def decode_words(run: str, model: Model) -> list[str]:
    """Likeliest words behind letters set apart: a word may end, and the next one start, at each space.

    A path keeps the word it writes and a chain of those before. Weighted words are preferred.
    """
    paths: dict[str, tuple[float, str, tuple | None]] = {_EDGE * 2: (0.0, "", None)}
    ended = lambda state, cost, word: cost + model.cost(state + _EDGE) - (8.0 if word in model.weights else 0.0)
    previous = ""
    for sign in run:
        further: dict[str, tuple[float, str, tuple | None]] = {}
        for state, (cost, word, before) in paths.items():
            steps = []
            for letter, price in _arcs(sign, previous):
                step = cost + price + (model.cost(state + letter) if letter else 0.0)
                steps.append(((state + letter)[-2:], (step, word + letter, before)))
            if sign == " " and word:
                steps.append((_EDGE * 2, (ended(state, cost, word) + SKIP_SEPARATOR, "", (word, before))))
            for then, path in steps:
                if then not in further or path[:2] < further[then][:2]:
                    further[then] = path
        paths, previous = further, sign
    state, (_, word, before) = min(paths.items(), key=lambda p: (ended(p[0], *p[1][:2]), p[1][1]))
    words = [word] if word else []
    while before is not None:
        words.append(before[0])
        before = before[1]
    return words[::-1]


def decode(token: str, model: Model) -> str:
    """Likeliest word behind a token. States are the last two letters written so far."""
    if token in model.seen:
        return model.seen[token]
    paths: dict[str, tuple[float, str]] = {_EDGE * 2: (0.0, "")}
    previous = ""
    for sign in token:
        arcs = _arcs(sign, previous)
        further: dict[str, tuple[float, str]] = {}
        for state, (cost, word) in paths.items():
            for letter, price in arcs:
                step = cost + price + (model.cost(state + letter) if letter else 0.0)
                then = (state + letter)[-2:]
                if then not in further or (step, word + letter) < further[then]:
                    further[then] = (step, word + letter)
        paths, previous = further, sign
    known = model.weights
    # A path that ends in a weighted word is preferred, as the word is likelier than its letters.
    best = min(paths.items(), key=lambda p: (p[1][0] + model.cost(p[0] + _EDGE) - (8.0 if p[1][1] in known else 0.0), p[1][1]))
    if len(model.seen) > 200_000:
        model.seen.clear()
    model.seen[token] = best[1][1]
    return best[1][1]


def _disguised(token: str) -> bool:
    if not _LETTER.search(token) and not any(c in STANDS_FOR for c in token):
        return False
    return bool(_STRETCHED.search(token) or _INNER.match(token) or any(c in STANDS_FOR for c in token))


def plain_words(token: str) -> list[str]:
    core = token.strip(_STRIP)
    return [core] if core.isalpha() else _PLAIN.findall(core)


def score_text(text: str | None, model: Model) -> tuple[float, int]:
    """Probability that a text is labelled toxic, and how many weighted features it has."""
    low = (text or "").lower()
    apart = set(_APART.findall(low))
    # A word of one letter may stand next to letters set apart.
    apart |= {run[a : len(run) - b] for run in apart for a in (0, 2) for b in (0, 2) if len(run) - a - b >= 5}
    found = {f for token in (*set(low.split()), *apart) for f in model.hits(token)}
    log_odds = max(model.weights[f] for f in found) + MORE * (len(found) - 1) if found else model.base
    return float(1 / (1 + np.exp(-min(log_odds, 30.0)))), len(found)


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", rows: int = FIT_ROWS) -> Model:
    """Letter triples of all texts, and weights of words and stems from about `rows` labelled ones.

    Those are drawn by a hash of the key. One pass: each task counts triples over its distinct
    words and, for drawn texts, features by label. Toxic texts count once for all that share
    their least 5-gram, or words that only come along in copies of one text would be learned.
    The driver gets the triples and the surest features. Labels other than 0 and 1, and keys
    labelled both ways, are left out.
    """
    known = labels.select(F.col(f"`{key}`").alias("k"), F.col(f"`{label}`").alias("y")).where("k IS NOT NULL AND y IN (0, 1)")
    known = known.groupBy("k").agg(F.min("y").alias("y"), F.max("y").alias("other")).where("y = other").select("k", "y")
    share = min(1.0, rows / max(1, known.count()))
    drawn = F.pmod(F.xxhash64("k", F.lit("fit")), F.lit(1 << 20)) < int(share * (1 << 20)) if share < 1 else F.lit(True)
    # About `rows` rows, whatever the size of the input.
    drawn_rows = F.broadcast(known.where(drawn))
    both = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("body")).join(drawn_rows, "k", "left")
    both = both.select("body", "y")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        triples, words = Counter(), {0: Counter(), 1: Counter()}
        for batch in batches:
            tokens = Counter()
            # One text at a time, so a task never holds a batch of them as Python strings.
            for body, y in zip(batch["body"], batch["y"]):
                body, y = body.as_py(), y.as_py()
                if body is None:
                    continue
                tokens.update(body.lower().split())
                if y is not None:
                    found = {f for t in set(body.lower().split()) for w in plain_words(t) for f in features(w)}
                    words[int(y)].update(found)
                    words[int(y)][""] += 1
                    if y == 1 and len(codes := word_codes(body)):
                        family = int(labelled_kmers(codes).min() >> np.uint64(1))
                        yield _rows(3, [(f, family) for f in found])
            for token, n in tokens.items():
                core = token.strip(_STRIP)
                if core.isalpha() and all(c < "\u0250" for c in core):
                    edged = _EDGE * 2 + core + _EDGE
                    for i in range(len(edged) - 2):
                        triples[edged[i : i + 3]] += n
        for kind, found in ((2, triples), *words.items()):
            rows = list(found.items())
            for first in range(0, len(rows), 20_000):
                yield _rows(kind, rows[first : first + 20_000])

    counted = stash(both.mapInArrow(count, "kind int, word string, n long"), "counted")
    triples = {r["word"]: r["n"] for r in counted.where("kind = 2").groupBy("word").agg(F.sum("n").alias("n")).collect()}
    by = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("n")).otherwise(0))
    sums = counted.where("kind < 2").groupBy("word").agg(by(1).alias("n1"), by(0).alias("n0"))
    total = sums.where("word = ''").first()
    all1, all0 = (total["n1"], total["n0"]) if total else (0, 0)
    families = counted.where("kind = 3").distinct().groupBy("word").agg(F.count(F.lit(1)).alias("own"))
    above = F.log((F.col("own") + 0.5) / (all1 + 1)) - F.log((F.col("n0") + 0.5) / (all0 + 1))
    sure = above / F.sqrt(1 / (F.col("own") + 0.5) + 1 / (F.col("n0") + 0.5))
    fine = (F.col("n1") >= LEAST_SHARE * (F.col("n1") + F.col("n0"))) & (sure >= SURE) & (F.col("own") >= LEAST_PART * all1)
    top = sums.where("word <> '' AND n1 > 1").join(families, "word").where(fine)
    top = top.select("word", F.log((F.col("n1") + 0.5) / (F.col("n0") + 0.5)).alias("weight"), sure.alias("sure"))
    weights = {r["word"]: r["weight"] for r in top.orderBy(F.desc("sure"), "word").limit(MOST_FEATURES).collect()}
    return Model(triples, weights, float(np.log((0.02 * all1 + 1) / (all0 + 100))))


def _rows(kind: int, rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array([kind] * len(rows), pa.int32()), pa.array([w for w, _ in rows], pa.string()), pa.array([n for _, n in rows], pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["kind", "word", "n"])


def toxicity(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds score, predicted (1 from the threshold on) and signs (weighted features found); columns of those names are replaced.

    A null text scores as an empty one. Nothing but the text counts.
    """
    added = ("score", "predicted", "signs")

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [score_text(body, model) for body in batch[text]]
            batch = batch.drop(columns=[c for c in added if c in batch])
            scores = [s for s, _ in found]
            yield batch.assign(score=scores, predicted=[int(s >= THRESHOLD) for s in scores], signs=[n for _, n in found])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name not in added)
    return docs.mapInPandas(run, f"{schema}, score double, predicted int, signs int")


def held_out(key: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def op7_noisy_channel(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = fit(docs, labels.where(~held_out()))
    found = toxicity(docs.select("doc_id", held_out().alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "score", "predicted", "signs")


def keep_harmless(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Documents that are not predicted toxic, with their own columns.

    Only texts go to Python, each batch once, and only a flag comes back: the columns keep
    their values, and an executor holds no second copy of them.
    """

    @F.arrow_udf("boolean")
    def harmless(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for bodies in batches:
            yield pa.array([score_text(body.as_py(), model)[0] < THRESHOLD for body in bodies], pa.bool_())

    return docs.where(harmless(F.col(f"`{text}`")))
