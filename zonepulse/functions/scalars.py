"""Casts, defaults, safe arithmetic, rules and message codecs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from zonepulse.functions import fixed


def as_col(value) -> Column:
    """A column for a name, a column as it is."""
    return F.col(value) if isinstance(value, str) else value


# --- casts and defaults -------------------------------------------------------------------

def cast_to(col, dtype: str, safe: bool = False) -> Column:
    col = as_col(col)
    return col.try_cast(dtype) if safe else col.cast(dtype)


def to_number(col) -> Column:
    """Tolerant parse: anything that is no number becomes NULL."""
    return as_col(col).try_cast("double")


def falsy_default(col, default, kind: str = "string") -> Column:
    """`default` where the value is NULL, empty (text) or zero (number)."""
    col = as_col(col)
    empty = col == F.lit("") if kind == "string" else col == F.lit(0)
    return F.when(col.isNull() | empty, F.lit(default)).otherwise(col)


def missing_default(col, default) -> Column:
    """`default` only where the value is NULL; '' and 0 stay."""
    return F.coalesce(as_col(col), F.lit(default))


def flag(col) -> Column:
    """Integer flag to boolean; NULL and unparsable text are False."""
    return F.coalesce(as_col(col).try_cast("int") == 1, F.lit(False))


# --- arithmetic ---------------------------------------------------------------------------

def round_to(col, digits: int) -> Column:
    """Half-up rounding of the number as it is written (2.675 gives 2.68), as double."""
    return F.round(as_col(col).cast("double"), digits)


def safe_div(a, b) -> Column:
    """a / b, NULL where b is zero."""
    return F.try_divide(as_col(a), as_col(b))


def f_to_c(col) -> Column:
    return round_to((as_col(col).cast("double") - 32.0) * 5.0 / 9.0, 2)


def inch_to_mm(col) -> Column:
    return round_to(as_col(col).cast("double") * 25.4, 2)


def per_area(n, km2: float = fixed.CELL_AREA_KM2) -> Column:
    return as_col(n).cast("double") / F.lit(km2)


def earnings(*cols) -> Column:
    """Sum of the parts; NULL if any part is NULL."""
    total = as_col(cols[0])
    for col in cols[1:]:
        total = total + as_col(col)
    return total


def pct(part, whole) -> Column:
    """part / whole * 100 where whole > 0, else 0."""
    part, whole = as_col(part).cast("double"), as_col(whole).cast("double")
    return F.when(whole > 0, part / whole * 100.0).otherwise(F.lit(0.0))


def speed_mph(distance, seconds) -> Column:
    """Distance per hour; NULL for a zero duration."""
    hours = as_col(seconds) / F.lit(3600.0)
    return as_col(distance).cast("double") / F.nullif(hours, F.lit(0.0))


def rush_ratio(morning, evening, average) -> Column:
    """(morning + evening) / average with missing bands as 0 and a missing average as 1."""
    top = F.coalesce(as_col(morning), F.lit(0.0)) + F.coalesce(as_col(evening), F.lit(0.0))
    return F.try_divide(top, F.coalesce(as_col(average), F.lit(1.0)))


DRAW_BITS = 60


def draw(seed: int, *keys) -> Column:
    """Whole number below 2^60 from the MD5 of seed and keys as text, joined by bars; unknown
    keys count as empty. A task that runs again draws the same, and so does any other engine."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(as_col(k).cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, DRAW_BITS // 4), 16, 10).cast("long")


def uniform(seed: int, *keys) -> Column:
    """Uniform number in [0, 1), a draw of the keys."""
    return draw(seed, *keys) / F.lit(float(1 << DRAW_BITS))


def jitter(col, noise: float, seed: int, keys) -> Column:
    """Multiply by a uniform factor in [1 - noise, 1 + noise), drawn per row from `keys`; noise 0
    leaves the value alone."""
    col = as_col(col)
    if not noise:
        return col
    return col.cast("double") * (1.0 + (uniform(seed, *keys) - 0.5) * 2.0 * noise)


def scale_between(ratio, low: float, high: float) -> Column:
    return F.lit(float(low)) + F.lit(float(high - low)) * as_col(ratio)


# --- rules --------------------------------------------------------------------------------

def case(branches: Sequence[tuple[Column, object]], otherwise=None) -> Column:
    """Searched CASE; the first branch whose condition holds wins."""
    expr = None
    for cond, value in branches:
        value = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    otherwise = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    return expr.otherwise(otherwise)


def in_band(hour, band: tuple[int, int], wrap: bool = False) -> Column:
    """Inclusive hour band. A band whose start exceeds its end is empty unless `wrap`."""
    hour, (start, end) = as_col(hour), band
    if wrap and start > end:
        return (hour >= start) | (hour <= end)
    return hour.between(start, end)


def band_flag(condition, hour, bands=(fixed.MORNING_RUSH, fixed.EVENING_RUSH)) -> Column:
    """1 where the condition holds inside one of the bands, else 0 (also for NULL)."""
    inside = in_band(hour, bands[0])
    for band in bands[1:]:
        inside = inside | in_band(hour, band)
    return F.when(as_col(condition) & inside, 1).otherwise(0)


def recency_score(days, tiers=fixed.RECENCY_TIERS) -> Column:
    days = as_col(days)
    return case([(days <= limit, score) for limit, score in tiers], 1)


def rfm_segment(r, f, m) -> Column:
    """Best segment first; the order of the rules matters."""
    r, f, m = as_col(r), as_col(f), as_col(m)
    gold, silver, bronze, watch, dead = fixed.SEGMENTS
    strong = F.least(r, f, m)
    return case(
        [
            (strong >= 4, gold),
            (strong >= 3, silver),
            ((r >= 2) & (f >= 3), bronze),
            ((r <= 2) & (F.greatest(f, m) >= 3), watch),
        ],
        dead,
    )


def demand_level(x, maximum) -> Column:
    """Level by share of the maximum; a zero maximum has no levels."""
    x, maximum = as_col(x), as_col(maximum)
    ratio = F.try_divide(x.cast("double"), maximum.cast("double"))
    return case(
        [(maximum == 0, "No Demand"), *[(ratio < bound, name) for bound, name in fixed.DEMAND_LEVELS]],
        "Very High",
    )


def marker_size(x, maximum, low=fixed.MARKER_SIZE[0], high=fixed.MARKER_SIZE[1]) -> Column:
    """Size between `low` and `high` by share of the maximum; `low` when the maximum is zero."""
    ratio = F.coalesce(F.try_divide(as_col(x).cast("double"), as_col(maximum).cast("double")), F.lit(0.0))
    return scale_between(ratio, low, high)


def surge(demand, tiers=fixed.SURGE_TIERS) -> Column:
    demand = as_col(demand)
    return case([(demand > bound, factor) for bound, factor in tiers], 1.0)


def lookup(col, mapping: Mapping) -> Column:
    """Code to name through a literal map; unknown codes are NULL."""
    pairs = [F.lit(part) for item in mapping.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), as_col(col))


def place_label(zone, borough, missing: str = "Unknown Location") -> Column:
    zone = as_col(zone)
    joined = F.concat(zone, F.lit(", "), F.coalesce(as_col(borough), F.lit("")))
    return F.when(zone.isNotNull(), joined).otherwise(F.lit(missing))


# --- text and JSON ------------------------------------------------------------------------

def has_word(col, word: str) -> Column:
    return F.coalesce(F.lower(as_col(col)).contains(word), F.lit(False))


def in_words(col, words: Sequence[str]) -> Column:
    return F.coalesce(F.lower(as_col(col)).isin(*words), F.lit(False))


def json_field(col, path: str, dtype: str = "string") -> Column:
    """One value out of a JSON text; for several fields parse once with from_json instead."""
    value = F.get_json_object(as_col(col), path)
    return value if dtype == "string" else value.try_cast(dtype)


def number_text(col, scale: int = 9) -> Column:
    """Decimal as text without trailing zeros: 12.5000 -> 12.5, 100.0000 -> 100."""
    text = as_col(col).cast(f"decimal(28,{scale})").cast("string")
    return F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))


def stamp_text(ts) -> Column:
    """UTC timestamp as text, e.g. 2025-01-01 07:30:00+00."""
    return F.concat(as_col(ts).cast("string"), F.lit("+00"))


def surrogate_key(*cols) -> Column:
    """md5 of the '-'-joined texts, NULLs replaced by a marker. Not unique by itself."""
    texts = [F.coalesce(as_col(c).cast("string"), F.lit(fixed.NULL_KEY)) for c in cols]
    return F.md5(F.concat_ws("-", *texts))


def encode_message(*cols) -> Column:
    """Columns as base64 of their JSON text, on one line."""
    text = F.to_json(F.struct(*[as_col(c) for c in cols]), {"ignoreNullFields": "true"})
    return base64_text(text)


def base64_text(text) -> Column:
    """UTF-8 text as one line of base64 (the built-in breaks lines after 76 characters)."""
    return F.regexp_replace(F.base64(F.encode(as_col(text), "UTF-8")), r"[\r\n]", "")


def decode_text(col) -> Column:
    """base64 to UTF-8 text; NULL where the payload is neither."""
    return F.try_validate_utf8(F.try_to_binary(as_col(col), F.lit("base64")).cast("string"))
