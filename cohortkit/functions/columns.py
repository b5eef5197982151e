"""Column expressions.  Built-in functions only, so they stay in codegen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def url_key(url: Column | str) -> Column:
    """Second-to-last ``/`` segment of a URL (A9); NULL when there is none."""
    return F.try_element_at(F.split(_c(url), "/"), F.lit(-2))


def row_sum(cols: Sequence[Column | str]) -> Column:
    """Sum of columns; NULL if any input is NULL (like Python ``sum``)."""
    return reduce(lambda a, b: a + b, [_c(c) for c in cols])


def row_mean(cols: Sequence[Column | str]) -> Column:
    """Mean over a fixed list of columns (H1): ``sum(cols) / n``."""
    return row_sum(cols) / F.lit(len(cols))


def array_size(arr: Column | str) -> Column:
    """Number of elements as bigint; NULL for a NULL array in every session
    mode (the legacy, non-ANSI ``size(NULL)`` is -1)."""
    arr = _c(arr)
    return F.when(arr.isNotNull(), F.size(arr)).cast("bigint")


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """``num / den`` as double, NULL for a zero or NULL divisor (H3)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def clean_name(name: Column | str) -> Column:
    """Column-name cleaning on data: ``-`` becomes ``_`` (H4)."""
    return F.replace(_c(name), F.lit("-"), F.lit("_"))


def capitalize_first(s: Column | str) -> Column:
    """First character upper case, the rest lower case (not ``initcap``)."""
    s = _c(s)
    return F.concat(F.upper(F.substring(s, 1, 1)), F.lower(F.substring(s, 2, 1 << 30)))


def pretty_label(label: Column | str) -> Column:
    """Readable label for an aggregate column name (H5).

    Removes ``avg``, turns ``_`` into spaces, drops parentheses, then
    capitalizes the first character and lowers the rest.
    """
    s = F.replace(_c(label), F.lit("avg"), F.lit(""))
    s = F.replace(s, F.lit("_"), F.lit(" "))
    s = F.regexp_replace(s, r"[()]", "")
    return capitalize_first(s)


def lookup_measure(measures: Column | str, name: str) -> Column:
    """Value of the first measure called ``name``; NULL when absent.

    Looks up by name instead of by position, so reordered or missing
    measures cannot shift values into the wrong column.  The lists of names and
    values are made once for all lookups of a row, in generated code.
    """
    m = _c(measures)
    return F.get(m["value"], F.array_position(m["name"], F.lit(name)).cast("int") - 1)


def extreme(value: Column, keys: Mapping[str, Column], high: bool) -> Column:
    """Aggregate: the struct ``(keys, value)`` of the row with the highest
    (lowest) value, ties to the lowest first key; null if all values are null.
    One struct per row is made and compared, the value in front."""
    ranked = F.struct((-value if high else value).alias("v"), *[k.alias(n) for n, k in keys.items()])
    best = F.min(F.when(value.isNotNull(), ranked))
    held = -best["v"] if high else best["v"]
    return F.when(best.isNotNull(), F.struct(*[best[n].alias(n) for n in keys], held.alias("value")))


def dense_cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine of two numeric arrays of equal length (I5); NULL on a zero norm."""
    a = F.transform(_c(a), lambda x: x.cast("double"))
    b = F.transform(_c(b), lambda x: x.cast("double"))
    zero = F.lit(0.0).cast("double")
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), zero, lambda acc, x: acc + x)
    na = F.aggregate(a, zero, lambda acc, x: acc + x * x)
    nb = F.aggregate(b, zero, lambda acc, x: acc + x * x)
    return F.try_divide(dot, F.sqrt(na) * F.sqrt(nb))
