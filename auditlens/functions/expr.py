"""Column expressions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

HASH_DIGITS = 13  # 52 bits: exact in a double
HASH_RANGE = float(16**HASH_DIGITS)


def tidy(c, digits: int = 6) -> Column:
    """Round for reporting; adding zero turns -0.0 into 0.0."""
    return F.round(c, digits) + F.lit(0.0)


def ratio(num, den) -> Column:
    """Division that yields NULL when the denominator is 0 or NULL."""
    num, den = _col(num), _col(den)
    return F.when(den != 0, num / den)


def ratio0(num, den) -> Column:
    """Division that yields 0 when the denominator is 0."""
    return F.coalesce(ratio(num, den), F.lit(0.0))


def hash_long(*parts, digits: int = HASH_DIGITS) -> Column:
    """Reproducible pseudo-random integer of ``digits`` hex digits from the given parts.

    The same number comes out in any engine that has md5, whatever the partitioning.
    """
    text = F.concat_ws("|", *[_col(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def hash_unit(*parts) -> Column:
    """Reproducible draw from [0, 1)."""
    return hash_long(*parts) / F.lit(HASH_RANGE)


def is_floating(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.DoubleType, T.FloatType))


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def is_infinite(c) -> Column:
    return F.abs(_col(c)) == F.lit(float("inf"))


def finite_or_null(c) -> Column:
    """NaN and +-inf become NULL."""
    c = _col(c)
    return F.when(F.isnan(c) | is_infinite(c), None).otherwise(c)


def finite_or_zero(c) -> Column:
    """NaN, +-inf and NULL become 0."""
    return F.coalesce(finite_or_null(c), F.lit(0.0))


def clip(c, lo: float, hi: float) -> Column:
    """NULL stays NULL (``least`` and ``greatest`` alone would skip it)."""
    c = _col(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def sigmoid(c) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_col(c)))


def decide(score, threshold) -> Column:
    """1 at or above the threshold, else 0."""
    return (_col(score) >= threshold).cast("int")


# The character classes of the name sanitiser.
BRACKETS = r"[<>\[\](){}]"
NON_WORD = r"[^a-zA-Z0-9_]"
UNDERSCORES = r"_+"
ONLY_DIGITS = r"^[0-9]+$"


def clean_name(c, position) -> Column:
    """Identifier-safe text; ``feature_<position>`` when nothing but digits is left."""
    text = F.regexp_replace(F.regexp_replace(_col(c), BRACKETS, "_"), NON_WORD, "_")
    text = F.trim(F.regexp_replace(text, UNDERSCORES, "_"), F.lit("_"))
    empty = (text == "") | text.rlike(ONLY_DIGITS)
    return F.when(empty, F.concat(F.lit("feature_"), _col(position).cast("string"))).otherwise(text)


def even_grid(lo, hi, points: int) -> Column:
    """Array of ``points`` evenly spaced values; the last one is exactly ``hi``."""
    lo, hi = _col(lo), _col(hi)
    last = points - 1
    inner = F.transform(F.sequence(F.lit(0), F.lit(last - 1)), lambda i: lo + i * ((hi - lo) / last))
    return F.concat(inner, F.array(hi))


def uniform_bin(value, lo, hi, bins: int) -> Column:
    """Zero-based histogram bin, left-closed, the top edge inside the last bin."""
    value, lo, hi = _col(value), _col(lo), _col(hi)
    raw = F.floor((value - lo) / ((hi - lo) / bins)).cast("int")
    return F.when(hi == lo, F.lit(0)).otherwise(F.least(F.greatest(raw, F.lit(0)), F.lit(bins - 1)))


def cubic_basis(value, lo: float, hi: float, splines: int) -> list[Column]:
    """The ``splines`` cubic B-splines on uniform knots over [lo, hi], as closed forms.

    With segment width h and t = (value - lo) / h, spline j is the standard cubic bump
    centred at knot j - 1; values outside the range are held at the border.
    """
    scale = (splines - 3) / (hi - lo) if hi > lo else 0.0
    value = _col(value)
    held = F.least(F.greatest(value, F.lit(lo)), F.lit(hi))
    t = F.when(value.isNotNull(), (held - F.lit(lo)) * F.lit(scale))
    out = []
    for j in range(splines):
        d = F.abs(t - F.lit(float(j - 1)))
        near = (F.lit(4.0) - 6.0 * d * d + 3.0 * d * d * d) * F.lit(1 / 6)
        far = (2.0 - d) * (2.0 - d) * (2.0 - d) * F.lit(1 / 6)
        out.append(F.when(d < 1.0, near).when(d < 2.0, far).when(d.isNotNull(), F.lit(0.0)))
    return out


def constant_rows(rows: list, element: str) -> Column:
    """A constant array column; ``element`` is a type, or the fields of a struct for dicts.

    Written as one SQL literal: Spark folds it to a constant, and it is far quicker to build
    than thousands of nested columns.
    """
    fields = [f.strip().split() for f in element.split(",")]

    def literal(v, kind):
        if v is None:
            return f"CAST(NULL AS {kind})"
        if isinstance(v, str):
            return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return f"{float(v)!r}D" if kind == "double" else str(v)

    if rows and isinstance(rows[0], dict):
        items = ["named_struct(" + ", ".join(f"'{n}', {literal(r[n], k)}" for n, k in fields) + ")" for r in rows]
    else:
        items = [literal(v, element) for v in rows]
    return F.expr("array(" + ", ".join(items) + ")")


def _col(c) -> Column:
    if isinstance(c, Column):
        return c
    return F.col(c) if isinstance(c, str) else F.lit(c)
