"""Column expressions for parsing, codes, ratios, labels and hashes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnLike = str | Column


def _c(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- tolerant parsing --------------------------------------------------------

def safe_float(c: ColumnLike) -> Column:
    """Text to double, null where it is no number (Java's ``1d``/``1f`` forms are none)."""
    c = _c(c).cast("string")
    suffixed = c.rlike(r"^\s*[+-]?[0-9.][0-9.eE+-]*[dDfF]\s*$")
    return F.when(~suffixed, c.try_cast("double"))


def number(df: DataFrame, name: str) -> Column:
    """A column as double: a plain cast if it is numeric, tolerant parsing if it is text."""
    if isinstance(df.schema[name].dataType, T.NumericType):
        return F.col(name).cast("double")
    return safe_float(name)


def safe_int(c: ColumnLike) -> Column:
    """Text to bigint; decimals are cut towards zero, anything else is null."""
    c = _c(c).cast("string")
    whole = F.when(c.rlike(r"^\s*[+-]?[0-9]+\s*$"), c.try_cast("bigint"))
    return F.coalesce(whole, safe_float(c).try_cast("bigint"))


def typed(types: Mapping[str, str]) -> list[Column]:
    """Select list of ``try_cast(name AS type)``."""
    return [
        (safe_float(n) if t == "double" else F.col(n).try_cast(t)).alias(n)
        for n, t in types.items()
    ]


def present(c: ColumnLike) -> Column:
    """Not null and not the empty string."""
    return F.nullif(_c(c).cast("string"), F.lit("")).isNotNull()


def null_to_empty(c: ColumnLike) -> Column:
    """Strings as a text-only client shows them: null, None, nan and NaT become ``''``."""
    c = _c(c)
    return F.when(c.isNull() | c.isin("None", "nan", "NaT"), F.lit("")).otherwise(c)


# -- codes and names ---------------------------------------------------------

def identifier(c: ColumnLike) -> Column:
    """A lower-case column identifier made from a free-text name."""
    clean = F.regexp_replace(_c(c), r"[^\p{L}\p{N}_]", "_")
    clean = F.regexp_replace(clean, "_+", "_")
    return F.lower(F.when(clean.rlike("^[0-9]"), F.concat(F.lit("t_"), clean)).otherwise(clean))


def strip_fips(c: ColumnLike, missing: str | None = "") -> Column:
    """Drop leading zeros; all zeros give ``'0'``, null gives ``missing``."""
    short = F.regexp_replace(_c(c), "^0+", "")
    return F.coalesce(F.when(short == "", F.lit("0")).otherwise(short), F.lit(missing))


def pad_fips(c: ColumnLike, width: int) -> Column:
    """Left-pad a code with zeros; longer codes are kept whole."""
    text = _c(c).cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def state_prefix(county: ColumnLike) -> Column:
    """State part of a five-digit county code."""
    return F.substring(pad_fips(county, 5), 1, 2)


def relabel(c: ColumnLike, mapping: Mapping[str, str], fallback: ColumnLike | None = None) -> Column:
    """Look a code up in a small fixed table."""
    c = _c(c)
    pairs = F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])
    found = F.when(c.isNotNull(), F.try_element_at(pairs, c))
    return found if fallback is None else F.coalesce(found, _c(fallback))


def zip_prefix(c: ColumnLike, n: int = 3) -> Column:
    return F.substring(_c(c), 1, n)


def concat_label(a: ColumnLike, b: ColumnLike, sep: str = " - ") -> Column:
    return F.concat(_c(a), F.lit(sep), _c(b))


def content_hash(endpoint: ColumnLike, year: ColumnLike, payload: ColumnLike) -> Column:
    """SHA-256 of ``endpoint_year_payload``."""
    parts = F.concat(_c(endpoint), F.lit("_"), _c(year).cast("string"), F.lit("_"), _c(payload))
    return F.sha2(parts, 256)


# -- arithmetic --------------------------------------------------------------

def round_to(c: ColumnLike, digits: int) -> Column:
    """Round the binary value scaled by a power of ten, halves away from zero.

    ``round(c, digits)`` rounds the decimal text of a double, so 8.575 (which is a little
    less) gives 8.58; scaled it gives 8.57, as it does for the tools that read the results.
    """
    scale = F.lit(float(10**digits))
    return F.round(_c(c).cast("double") * scale) / scale


def midpoint(high: ColumnLike, low: ColumnLike) -> Column:
    """Mean of both ends, or the one that exists."""
    high, low = _c(high), _c(low)
    return F.coalesce((high + low) / F.lit(2.0), high, low)


def null_safe_sum(*parts: ColumnLike) -> Column:
    """Sum with nulls as zero."""
    total = F.coalesce(_c(parts[0]), F.lit(0))
    for p in parts[1:]:
        total = total + F.coalesce(_c(p), F.lit(0))
    return total


def ratio(part: ColumnLike, per: ColumnLike, digits: int = 2) -> Column:
    """Rounded quotient, null where either is missing or the divisor is zero."""
    return round_to(F.try_divide(_c(part), _c(per)), digits)


def pct_of(part: ColumnLike, whole: ColumnLike) -> Column:
    """Percentage, 0 where it is undefined."""
    return F.coalesce(F.try_divide(_c(part), _c(whole)) * 100, F.lit(0.0))


def diversity(parts: Sequence[ColumnLike], total: ColumnLike, empty_is_null: bool = False) -> Column:
    """One minus the sum of squared shares; an empty total scores 1.0 unless told otherwise."""
    shares = [F.try_divide(_c(p), _c(total)) for p in parts]
    squares = shares[0] * shares[0]
    for s in shares[1:]:
        squares = squares + s * s
    return F.lit(1.0) - (squares if empty_is_null else F.coalesce(squares, F.lit(0.0)))


def band(c: ColumnLike, edges: Sequence[float], labels: Sequence[str], missing: str | None = None) -> Column:
    """Step label: ``labels[i]`` for values from ``edges[i-1]`` up to, not including, ``edges[i]``."""
    c = _c(c)
    out = F.when(c.isNull(), F.lit(missing))
    for edge, label in zip(edges, labels):
        out = out.when(c < F.lit(edge), F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def cost(tokens_in: ColumnLike, tokens_out: ColumnLike, usd_in: float, usd_out: float) -> Column:
    """Price of token counts, given prices per million."""
    million = F.lit(1_000_000.0)
    return _c(tokens_in) / million * F.lit(usd_in) + _c(tokens_out) / million * F.lit(usd_out)


def utc_day(ts: ColumnLike) -> Column:
    """``YYYY-MM-DD`` of a timestamp (the session time zone is UTC)."""
    return F.date_format(_c(ts), "yyyy-MM-dd")


def point_feature(lon: ColumnLike, lat: ColumnLike, properties: Mapping[str, ColumnLike]) -> Column:
    """GeoJSON point feature as text; null properties stay as JSON null."""
    shape = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(
            F.lit("Point").alias("type"), F.array(_c(lon), _c(lat)).alias("coordinates")
        ).alias("geometry"),
        F.struct(*[_c(v).alias(k) for k, v in properties.items()]).alias("properties"),
    )
    return F.to_json(shape, {"ignoreNullFields": "false"})
