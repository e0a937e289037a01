"""Shards cut from a Hilbert curve over several metadata dimensions. DataFrame functions only.

Rows are placed on a Hilbert curve over quantised dimensions, sorted by their place on it, and
cut into runs of equal row counts. A run covers a compact part of every dimension, so files
written from it can be skipped by minimum and maximum of each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from zonepulse.llm.common import number_all, table
from zonepulse.session import stash

BITS = 6
SHARDS = 8


def curve_steps(dims: int) -> tuple[list[int], list[int]]:
    """Digit and next state for each (state, cell corner) of the curve in `dims` dimensions.

    A state is an entry corner and a direction; a corner's digit is the inverse Gray code of
    the corner seen from that state.
    """
    size = 1 << dims
    turn = lambda x, n: ((x << (n % dims)) | (x >> (dims - n % dims))) & (size - 1)

    def place(gray: int) -> int:
        digit = 0
        while gray:
            digit ^= gray
            gray >>= 1
        return digit

    def ones(x: int) -> int:
        return ones(x >> 1) + 1 if x & 1 else 0

    digits, states = [], []
    for state in range(size * dims):
        entry, direction = divmod(state, dims)
        for corner in range(size):
            digit = place(turn(corner ^ entry, dims - (direction + 1) % dims))
            even = (digit - 1) // 2 * 2 if digit else 0
            start = even ^ (even >> 1)
            along = 0 if digit == 0 else ones(digit if digit & 1 else digit - 1) % dims
            digits.append(digit)
            states.append((entry ^ turn(start, direction + 1)) * dims + (direction + along + 1) % dims)
    return digits, states


def hilbert_index(cells: Sequence[Column], bits: int = BITS) -> Column:
    """Place on the curve of a point whose coordinates are whole numbers below 2**bits.

    The top bits are consumed first; one fold over the bit levels carries (place, state).
    """
    dims = len(cells)
    digits, states = curve_steps(dims)
    digit_of, state_of = F.lit(digits), F.lit(states)
    levels = F.array(*[F.lit(level) for level in reversed(range(bits))])

    def step(done: Column, level: Column) -> Column:
        corner = F.lit(0)
        for n, cell in enumerate(cells):
            bit = F.when(cell.bitwiseAND(F.element_at(F.lit([1 << i for i in range(bits)]), level + 1)) != 0, 1 << n)
            corner = corner + bit.otherwise(0)
        at = done["state"] * (1 << dims) + corner + 1
        return F.struct(
            (done["place"] * (1 << dims) + F.element_at(digit_of, at)).alias("place"),
            F.element_at(state_of, at).alias("state"),
        )

    start = F.struct(F.lit(0).cast("long").alias("place"), F.lit(0).alias("state"))
    return F.aggregate(levels, start, step, lambda done: done["place"])


def quantise_label(col: Column, bits: int = BITS) -> Column:
    """Cell of a text value: the same for equal values; null has a cell of its own."""
    return F.coalesce(F.pmod(F.crc32(col), F.lit((1 << bits) - 1)) + 1, F.lit(0)).cast("int")


def quantise_size(col: Column, per_doubling: int = 3, bits: int = BITS) -> Column:
    """Cell of a size from 1 up: a few steps for each doubling, all the largest in the last."""
    return F.least(F.floor(F.log2(col) * per_doubling), F.lit((1 << bits) - 1)).cast("int")


def hilbert_shards(
    df: DataFrame, text: str = "text", key: str = "doc_id", labels: Sequence[str] = ("source", "lang"),
    shards: int = SHARDS, bits: int = BITS,
) -> DataFrame:
    """Each row's size, checksum, place on the curve, shard and slot; shard sizes in rows differ by one at most.

    Dimensions are the text's size and the given label columns. Rows with the same place are
    ordered by checksum, size and key, so equal texts with equal labels lie side by side. A
    null text counts as empty (size 1), a null label or key sorts first, repeated rows each
    take a slot, an empty table gives no rows; other columns are ignored.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    size = F.octet_length(body).cast("long") + 1
    cells = [quantise_size(size, bits=bits), *[quantise_label(F.col(f"`{c}`"), bits) for c in labels]]
    slim = stash(
        df.select(
            F.col(f"`{key}`").alias(key), size.alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"),
            *[c.alias(f"cell_{n}") for n, c in enumerate(cells)],
        ),
        "sizes",
    )
    curve = hilbert_index([F.col(f"cell_{n}") for n in range(len(cells))], bits)
    slim = slim.select(key, "size", "text_crc32", curve.alias("curve"))
    placed, total = number_all(slim, ["curve", "text_crc32", "size", key], "position")
    shard = F.expr(f"position * {shards} div {max(total, 1)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard).withColumn("slot", (F.col("position") - first).cast("long"))


def op4_hilbert_sharding(spark: SparkSession, folder: str) -> DataFrame:
    done = hilbert_shards(table(spark, folder, "documents"))
    return done.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        "slot", F.lit(None).cast("int").alias("grown_shard"), "curve",
    )
