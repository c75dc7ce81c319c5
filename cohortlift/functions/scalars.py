"""Column builders: parsing, flags, ratios, bins and keys.

All of them stay inside the JVM and none throws under ANSI mode.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-6


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def num(c: str | Column) -> Column:
    """Number or NULL: text that is no number becomes NULL, and so does NaN."""
    value = col(c).try_cast("double")
    return F.when(~F.isnan(value), value)


def z(c: str | Column, fill: float = 0.0) -> Column:
    return F.coalesce(num(c), F.lit(float(fill)))


def flag(condition: Column) -> Column:
    """0/1; a NULL comparison is 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def is_missing(c: str | Column) -> Column:
    return col(c).isNull().cast("int")


def count_from_text(c: str | Column, mapping: Mapping[str, float]) -> Column:
    """Exact dictionary parse; any other text is NULL."""
    return lookup(c, mapping)


def count_from_digits(c: str | Column, known: Mapping[str, float] | None = None) -> Column:
    """First run of digits; NULL when there is none.

    ``known`` texts, whose value must be their digits, are matched first, which costs less than the pattern.
    """
    text = col(c).cast("string")
    found = F.regexp_substr(text, F.lit("[0-9]+")).try_cast("int")
    if not known:
        return found
    fast = None
    for key, value in known.items():
        same = text == key
        fast = F.when(same, F.lit(int(value))) if fast is None else fast.when(same, F.lit(int(value)))
    return fast.otherwise(found)


def censored(c: str | Column, marks: Sequence[str], legacy: bool = False) -> Column:
    """1 when the count text holds a mark of right-censoring; ``legacy`` looks for all marks as one literal text."""
    text = col(c).cast("string")
    wanted = ["|".join(marks)] if legacy else marks
    return flag(reduce(or_, (F.contains(text, F.lit(m)) for m in wanted)))


def lookup(c: str | Column, mapping: Mapping, default: float | None = None) -> Column:
    """Literal map lookup; a key outside the map gives ``default``."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), col(c))
    return found if default is None else F.coalesce(found, F.lit(default))


def has_token(c: str | Column, token: str) -> Column:
    return flag(F.contains(col(c), F.lit(token)))


def ratio(a: Column, b: Column, plus: float = EPS) -> Column:
    return F.try_divide(a, b + F.lit(plus))


def clipped_difference(a: Column, b: Column) -> Column:
    """max(a - b, 0), NULL when an operand is NULL."""
    gap = a - b
    return F.when(gap < 0, F.lit(0.0)).otherwise(gap)


def null_count_sql(columns: Sequence[str]) -> str:
    return " + ".join(f"CAST(`{c}` IS NULL AS INT)" for c in columns) or "0"


def null_count(columns: Sequence[str]) -> Column:
    """Missing values in the row over an explicit list, as one parsed expression."""
    return F.expr(null_count_sql(columns))


def any_null(columns: Sequence[str]) -> Column:
    return reduce(or_, (col(c).isNull() for c in columns), F.lit(False)).cast("int")


def row_sum(columns: Sequence[str]) -> Column:
    return reduce(add, (z(c) for c in columns), F.lit(0.0))


def band(c: Column, edges: Sequence[float], labels: Sequence[str], limits: tuple[float, float]) -> Column:
    """Right-closed bins between ``limits``; NULL outside of them."""
    low, high = limits
    label = F.when((c <= low) | (c > high), F.lit(None).cast("string"))
    for edge, text in zip(edges, labels):
        label = label.when(c <= edge, F.lit(text))
    return label.when(c.isNotNull(), F.lit(labels[-1]))


def first_match(branches: Iterable[tuple[Column, str]], default: str) -> Column:
    result = None
    for condition, text in branches:
        result = F.when(condition, F.lit(text)) if result is None else result.when(condition, F.lit(text))
    return result.otherwise(F.lit(default))


def text_or_null(c: str | Column) -> Column:
    """Placeholder texts of a missing value become NULL."""
    text = col(c).cast("string")
    return F.when(~text.isin("nan", "None"), text)


def text_or(c: str | Column, placeholder: str) -> Column:
    return F.coalesce(text_or_null(c), F.lit(placeholder))


def combo_key(columns: Sequence[str | Column], separator: str = "_") -> Column:
    """Concatenated key; a NULL part reads 'nan'."""
    parts = [F.coalesce(col(c).cast("string"), F.lit("nan")) for c in columns]
    return F.concat_ws(separator, *parts)


def clip01(c: str | Column) -> Column:
    return F.least(F.greatest(col(c), F.lit(0.0)), F.lit(1.0))
