"""Language identification with error-correcting output codes.

Each language has a codeword of signs. A binary classifier per bit, linear in the shares of
hashed byte trigrams, tells the languages with + from those with -. Decoding sums, for each
language, the losses of its bits, weighted by how well each bit's classifier knows that
language; the nearest codeword wins, and a narrow lead is flagged.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from zonepulse.llm.common import table

CELLS = 1 << 12
UNKNOWN = "und"
#: Scores below this are ambiguous.
CLEAR = 0.6
_KEPT = np.array([b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 0 for b in range(256)], np.uint32)
_LETTER = re.compile(r"[^\W\d_]")


def gram_counts(text: str) -> np.ndarray:
    """Counts of the text's hashed byte trigrams that have a letter in the middle."""
    data = np.zeros(len(raw := text.lower().encode()) + 2, np.uint32)
    data[1:-1] = _KEPT[np.frombuffer(raw, np.uint8)]
    grams = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
    cells = (grams[data[1:-1] != 0] * np.uint32(2654435761)) >> np.uint32(20)
    return np.bincount(cells, minlength=CELLS)


def codewords(n: int) -> np.ndarray:
    """Signs (languages x bits): every split of few languages, else hashed splits that all differ."""
    if n <= 1:
        return np.ones((n, 1), int)
    if n <= 6:
        splits = [(1, *rest) for rest in itertools.product((1, -1), repeat=n - 1) if -1 in rest]
        return np.array(splits).T
    splits, seed = [], 0
    while len(splits) < 15 * int(np.ceil(np.log2(n))):
        split = tuple(1 if xxhash.xxh64_intdigest(f"{seed}-{k}") & 1 else -1 for k in range(n))
        if len(set(split)) == 2 and split not in splits and tuple(-x for x in split) not in splits:
            splits.append(split)
        seed += 1
    return np.array(splits).T


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray
    trust: np.ndarray

    def decode(self, counts: np.ndarray) -> tuple[int, float]:
        """Index of the nearest codeword, and a score that grows with its lead."""
        margin = (counts / max(1, counts.sum())) @ self.weights
        losses = (self.trust * np.exp(-np.clip(self.codes * margin * 2, -30, 30))).sum(axis=1)
        near = np.exp(-(losses - losses.min()) * 4)
        best = int(losses.argmin())
        return best, float(near[best] / near.sum())

    def tell(self, text: str | None) -> tuple[str, float]:
        """A text's language and score: `und` with 0 if it has no letter or nothing was learned."""
        if text is None or not self.languages or not _LETTER.search(text):
            return UNKNOWN, 0.0
        best, score = self.decode(gram_counts(text))
        return self.languages[best], score


def train(counts: dict[str, np.ndarray]) -> Model:
    """Classifiers from the trigram counts of each language, which all weigh the same."""
    languages = sorted(counts)
    share = np.array([(counts[k] + 0.1) / (counts[k].sum() + 0.1 * CELLS) for k in languages]).reshape(-1, CELLS)
    codes = codewords(len(languages))
    weights = []
    for bit in codes.T:
        plus = share[bit > 0].mean(axis=0)
        minus = share[bit < 0].mean(axis=0) if (bit < 0).any() else np.full(CELLS, 1 / CELLS)
        weights.append(np.log(plus / minus))
    weights = np.array(weights).T.reshape(CELLS, -1)
    trust = np.maximum(codes * (share @ weights), 1e-3)
    return Model(languages, codes, weights, trust / np.maximum(trust.sum(axis=1, keepdims=True), 1e-9))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Model from all rows with a text and a language; each task sums up its counts first.

    The driver gets one count per language and cell.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            # One text at a time, so a task never holds a batch of them as Python strings.
            for label, body in zip(batch["label"], batch["body"]):
                label = label.as_py()
                if label not in sums:
                    sums[label] = np.zeros(CELLS, np.int64)
                sums[label] += gram_counts(body.as_py())
        for label, found in sums.items():
            at = np.flatnonzero(found)
            columns = [pa.array([label] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(found[at])]
            yield pa.RecordBatch.from_arrays(columns, ["label", "cell", "n"])

    rows = docs.select(F.col(f"`{lang}`").alias("label"), F.col(f"`{text}`").alias("body")).where("label IS NOT NULL AND body IS NOT NULL")
    sums = rows.mapInArrow(count, "label string, cell int, n long").groupBy("label", "cell").agg(F.sum("n").alias("n")).collect()
    counts: dict[str, np.ndarray] = {}
    for r in sums:
        counts.setdefault(r["label"], np.zeros(CELLS))[r["cell"]] = r["n"]
    return train(counts)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds lang_pred, score and ambiguous; columns of those names are replaced.

    A null text or one without letters is `und` with score 0, as is every text if the model has
    no language. Equal texts get equal results, nothing but the text counts.
    """

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            told = [model.tell(body) for body in batch[text]]
            labels, scores = [k for k, _ in told], [s for _, s in told]
            batch = batch.drop(columns=[c for c in ("lang_pred", "score", "ambiguous") if c in batch])
            yield batch.assign(lang_pred=labels, score=scores, ambiguous=[s < CLEAR for s in scores])

    kept = [f for f in docs.schema if f.name not in ("lang_pred", "score", "ambiguous")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return docs.mapInPandas(run, f"{schema}, lang_pred string, score double, ambiguous boolean")


def held_out(key: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def op8_output_codes(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = fit(docs.where(~held_out()))
    found = identify(docs.select("doc_id", held_out().alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


def keep_identified(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Documents whose language the model can tell, with their own columns: those without a letter go.

    Only texts go to Python, each batch once, and only a language comes back.
    """

    @F.arrow_udf("string")
    def language(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for bodies in batches:
            yield pa.array([model.tell(body.as_py())[0] for body in bodies], pa.string())

    return docs.where(language(F.col(f"`{text}`")) != UNKNOWN)
