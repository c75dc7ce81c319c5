"""Cleaning: casting, domain rules and sentinels, one select per profile.

``raw``   keeps missing values as NULL and splits multi-valued text into flags.
``clean`` applies the domain rules, writes sentinels and fills train medians.

Both are row-local, so the same call serves a batch and a stream.  Missing optional columns
skip what depends on them; :func:`skipped` says which.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from cohortlift import schema as S
from cohortlift.functions import sql_text as Q

CLEAN_INPUTS = {
    **{flag: (source,) for source, flag in S.CENSOR_FLAGS.items()},
    "age_ord": ("age_band",),
    "age_median": ("age_band",),
    "is_DI": ("treatment_type",),
    "no_transfer": ("embryos_transferred", "day_transfer"),
    "miss_gene_test": S.GENE_TEST_COLUMNS,
    **{f"{name}_raw": (day,) for name, day in S.MISSING_DAYS.items()},
    **{f"{c}__isnan": (c,) for c in S.MISSING_FLAGS},
    **{name: ("embryo_reason",) for name in S.REASON_TOKENS_CLEAN},
}


def skipped(df: DataFrame) -> dict[str, list[str]]:
    """Cleaned columns that cannot be made from ``df``, with the columns they miss."""
    have = set(df.columns)
    gaps = {name: [c for c in needs if c not in have] for name, needs in CLEAN_INPUTS.items()}
    return {name: missing for name, missing in gaps.items() if missing}


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop the listed columns that exist."""
    return df.drop(*[c for c in columns if c in df.columns])


def shared_columns(train: DataFrame, test: DataFrame) -> list[str]:
    """Columns present on both sides, in train order."""
    have = set(test.columns)
    return [c for c in train.columns if c in have]


def source_columns(df: DataFrame) -> list[str]:
    """Registry columns of ``df`` other than identity and target."""
    have = set(df.columns)
    return [c.name for c in S.COLUMNS if c.name in have and c.group not in ("identity", "target")]


def fix_embryos(total: str, transferred: str, stored: str) -> str:
    return f"greatest({Q.z(total)}, {Q.z(transferred)} + {Q.z(stored)})"


def fix_icsi_embryos(embryos: str, eggs: str) -> str:
    return f"least({Q.z(embryos)}, {Q.z(eggs)})"


def zero_when(condition: str, c: str) -> str:
    """Structural zero: NULL becomes 0 where the condition holds."""
    return f"CASE WHEN {condition} THEN coalesce({Q.finite(c)}, 0D) ELSE {Q.finite(c)} END"


def sentinel_when_zero(count: str, day: str, only_null: bool = False) -> str:
    """-1 where the paired count is 0 or NULL; ``only_null`` keeps a day that is present."""
    absent = f"coalesce({Q.finite(count)}, 0D) = 0"
    if only_null:
        absent += f" AND {Q.finite(day)} IS NULL"
    return f"CASE WHEN {absent} THEN -1D ELSE {Q.finite(day)} END"


def sentinel_without_pregnancy(pregnancies: str, years: str) -> str:
    """Optional rule: no pregnancy so far and unknown years become -1."""
    none = f"({Q.count_from_digits(pregnancies, S.COUNT_TEXT)}) = 0"
    return f"CASE WHEN {none} AND {Q.finite(years)} IS NULL THEN -1D ELSE {Q.finite(years)} END"


def mask_frozen(thawed: str, c: str) -> str:
    """-1 on frozen-embryo cycles, else the count with NULL as 0."""
    return f"CASE WHEN {Q.num(thawed)} > 0 THEN -1D ELSE {Q.z(c)} END"


def _plain(df: DataFrame) -> dict[str, str]:
    """The columns as they are; numbers come as double, and NaN as NULL."""
    floats = {f.name for f in df.schema if f.dataType.typeName() in ("double", "float")}
    return {c: Q.finite(f"`{c}`") if c in S.NUMERIC or c in floats else f"`{c}`" for c in df.columns}


def _select(df: DataFrame, out: Mapping[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{e} AS `{n}`" for n, e in out.items()])


def _clean_raw(df: DataFrame) -> DataFrame:
    have = set(df.columns)
    out = {c: e for c, e in _plain(df).items() if c not in ("specific_type", "embryo_reason")}
    out.update({c: Q.either(f"CAST({c} AS STRING)", S.COUNT_TEXT) for c in S.COUNTS if c in have})
    if "age_band" in have:
        out["age_num"] = Q.either("age_band", S.AGE_MEDIAN)
        out["age_ord"] = f"CAST({Q.either('age_band', S.AGE_ORDINAL)} AS INT)"
    for c in ("egg_donor_age", "sperm_donor_age"):
        if c in have:
            out[f"{c}_num"] = Q.either(c, S.DONOR_AGE)
    if "specific_type" in have:
        out.update({f"has_{t}": Q.has_token("specific_type", t) for t in S.PROCEDURE_TOKENS})
    if "embryo_reason" in have:
        out.update({n: Q.has_token("embryo_reason", t) for n, t in S.REASON_TOKENS.items()})
    out.update({f"{c}__isnan": Q.is_missing(Q.finite(c)) for c in S.MISSING_FLAGS if c in have})
    return _select(df, out)


def _clean_rules(
    df: DataFrame,
    medians: Mapping[str, float],
    legacy: bool,
    only_null: bool,
    years_rule: bool,
) -> DataFrame:
    have = set(df.columns)
    plain = _plain(df)
    out = {c: e for c, e in plain.items() if c not in S.DROPPED}
    out.update({c: Q.count_from_digits(c, S.COUNT_TEXT) for c in S.COUNTS if c in have})
    out.update({n: Q.censored(c, S.CENSOR_MARKS, legacy) for c, n in S.CENSOR_FLAGS.items() if c in have})
    if "age_band" in have:
        out["age_ord"] = f"CAST({Q.either('age_band', S.AGE_ORDINAL)} AS INT)"
        out["age_median"] = Q.either("age_band", S.AGE_MEDIAN, Q.real(S.AGE_WHEN_UNKNOWN))
    if "treatment_type" in have:
        is_di = "treatment_type = 'DI'"
        out["is_DI"] = Q.flag(is_di)
        out.update(
            {c: zero_when(is_di, c) for c in S.DI_ZERO_COLUMNS if c in have and not (legacy and c == "icsi_stored")}
        )
    out.update({f"{n}_raw": Q.is_missing(Q.finite(d)) for n, d in S.MISSING_DAYS.items() if d in have})
    for count, day in S.SENTINEL_DAYS.items():
        if count in have and day in have:
            out[day] = sentinel_when_zero(count, day, only_null)
    if "no_transfer" not in have and {"embryos_transferred", "day_transfer"} <= have:
        out["no_transfer"] = Q.flag(f"coalesce({Q.finite('embryos_transferred')}, 0D) = 0")
    if years_rule and {"n_pregnancies", "years_trying"} <= have:
        out["years_trying"] = sentinel_without_pregnancy("n_pregnancies", "years_trying")
    out.update({c: f"CAST(coalesce({Q.finite(c)}, 0D) AS INT)" for c in ("pgd", "pgs") if c in have})
    if set(S.GENE_TEST_COLUMNS) <= have:
        missing = " OR ".join(f"{Q.finite(c)} IS NULL" for c in S.GENE_TEST_COLUMNS)
        out["miss_gene_test"] = "0" if legacy else f"CAST({missing} AS INT)"
    out.update({f"{c}__isnan": Q.is_missing(Q.finite(c)) for c in S.MISSING_FLAGS if c in have})
    out["n_missing_row"] = " + ".join(Q.is_missing(plain[c]) for c in source_columns(df)) or "0"
    if "embryo_reason" in have:
        out.update({n: Q.has_token("embryo_reason", t) for n, t in S.REASON_TOKENS_CLEAN.items()})
    out.update(
        {c: f"coalesce({out[c]}, {Q.real(m)})" for c, m in medians.items() if c in out and m is not None}
    )
    return _select(df, out)


def clean(
    df: DataFrame,
    profile: str = "clean",
    medians: Mapping[str, float] | None = None,
    *,
    legacy: bool = False,
    only_null: bool = False,
    years_rule: bool = False,
) -> DataFrame:
    """Clean a cycle table.  ``medians`` comes from ``fit.as_dict(fit_medians(train, ...))``."""
    if profile == "raw":
        return _clean_raw(df)
    if profile != "clean":
        raise ValueError(f"unknown profile {profile!r}")
    if medians is None:
        raise ValueError("the clean profile needs fitted medians")
    return _clean_rules(df, medians, legacy, only_null, years_rule)
