"""Feature catalogue: each feature is declared once as a SQL expression over named inputs.

``derive`` orders the features by what they need and adds each dependency layer with one select.
Expressions are text because one parsed expression costs the driver far less than a hundred column calls.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from cohortlift import schema as S
from cohortlift.functions.sql_text import at_least_zero, bins, either, flag, null_count, num, ratio, real, text, z
from cohortlift.operators import clean as C


@dataclass(frozen=True)
class Feature:
    name: str
    level: str  # base < v3 < full
    needs: tuple[str, ...]
    sql: str


RAW: dict[str, Feature] = {}
CLEAN: dict[str, Feature] = {}
LEVELS = {"raw": ("base", "v3", "full"), "clean": ("v3", "full")}


DONATED = f"coalesce(egg_source = {text(S.DONATED)}, false)"
USED = f"({z('embryos_transferred')} + {z('embryos_stored')})"


def age_scale(low: float | None = None) -> str:
    age = z("real_age_num", 35)
    return f"({age if low is None else f'greatest({age}, {real(low)})'} / 35D)"


def suitability(male: str, profile: str) -> str:
    adequate, overused, underserved, neither = (text(t) for t in S.SUITABILITY_LABELS[profile])
    return (
        f"CASE WHEN {male} AND is_ICSI = 1 THEN {adequate} WHEN is_ICSI = 1 THEN {overused} "
        f"WHEN {male} THEN {underserved} ELSE {neither} END"
    )


def success_prior(kind: str) -> str:
    """Prior success rate by age, with one value for donated eggs."""
    if kind == "published":
        own, donated = either("age_ord", S.PUBLISHED_PRIOR, real(S.PUBLISHED_PRIOR_DEFAULT)), S.PUBLISHED_DONOR_PRIOR
    else:
        own, donated = either("age_band", S.MEASURED_PRIOR), S.MEASURED_DONOR_PRIOR
    return f"CASE WHEN {DONATED} THEN {real(donated)} ELSE {own} END"


# --- catalogue -----------------------------------------------------------------------------------


def _raw(name: str, level: str, needs: str, sql: str) -> None:
    RAW[name] = Feature(name, level, tuple(needs.split()), sql)


def _clean(name: str, level: str, needs: str, sql: str) -> None:
    CLEAN[name] = Feature(name, level, tuple(needs.split()), sql)


def _both(name: str, raw_level: str, clean_level: str, needs: str, sql: str) -> None:
    _raw(name, raw_level, needs, sql)
    _clean(name, clean_level, needs, sql)


# Ratios of history and embryo counts: raw keeps a NULL operand, clean reads it as 0.
for _name, _a, _b in (
    ("past_preg_rate", "n_pregnancies", "n_cycles"),
    ("past_birth_rate", "n_births", "n_pregnancies"),
    ("ivf_preg_rate", "n_ivf_pregnancies", "n_ivf_cycles"),
    ("embryo_transfer_ratio", "embryos_transferred", "embryos_total"),
    ("embryo_stored_ratio", "embryos_stored", "embryos_total"),
    ("icsi_ratio", "icsi_eggs", "mixed_eggs"),
):
    _raw(_name, "base", f"{_a} {_b}", ratio(num(_a), num(_b)))
    _clean(_name, "v3", f"{_a} {_b}", ratio(z(_a), z(_b)))

_raw("age_x_transferred", "base", "age_num embryos_transferred", f"age_num * {num('embryos_transferred')}")
_clean("age_x_transferred", "v3", "age_median embryos_transferred",
       f"{z('age_median', S.AGE_WHEN_UNKNOWN)} * {z('embryos_transferred')}")
_raw("gap_transfer_minus_pickup", "base", "day_transfer day_egg_pickup",
     f"{num('day_transfer')} - {num('day_egg_pickup')}")

# Shared domain set.
_both("days_mix_to_transfer", "v3", "v3", "day_transfer day_egg_mix", f"{num('day_transfer')} - {num('day_egg_mix')}")
_raw("real_age_num", "v3", "age_num egg_source egg_donor_age_num",
     f"CASE WHEN {DONATED} THEN egg_donor_age_num ELSE age_num END")
_clean("real_age_num", "v3", "age_median egg_source egg_donor_age",
       f"CASE WHEN {DONATED} THEN {either('egg_donor_age', S.DONOR_AGE)} ELSE age_median END")
_both("log_n_embryo", "v3", "v3", "embryos_total", f"log1p({z('embryos_total')})")
_raw("miss_gene_test", "v3", "pgs pgd pgt_used",
     "CAST(" + " OR ".join(f"{c} IS NULL" for c in S.GENE_TEST_COLUMNS) + " AS INT)")
_raw("age_x_embryo_ratio", "v3", "age_num embryo_transfer_ratio", "age_num * embryo_transfer_ratio")
_clean("age_x_embryo_ratio", "v3", "age_median embryo_transfer_ratio",
       f"{z('age_median', S.AGE_WHEN_UNKNOWN)} * embryo_transfer_ratio")
for _t in S.PROCEDURE_TOKENS:
    _clean(f"has_{_t}", "v3", "specific_type", flag(f"contains(specific_type, {text(_t)})"))

# Missingness.
for _name, _day in S.MISSING_DAYS.items():
    _raw(_name, "full", _day, f"CAST({_day} IS NULL AS INT)")
    _clean(_name, "v3", f"{_name}_raw", f"{_name}_raw")

# History.
_both("ever_delivered", "full", "full", "n_births", flag(f"{num('n_births')} > 0"))
_both("repeated_3plus", "full", "full", "n_cycles", flag(f"{num('n_cycles')} >= 3"))
_raw("is_first_attempt", "full", "n_cycles", flag(f"{num('n_cycles')} = 0"))
_clean("is_first_attempt", "full", "n_cycles", flag(f"{z('n_cycles')} = 0"))
_raw("prev_birth_rate", "full", "n_births n_pregnancies", ratio(z("n_births"), z("n_pregnancies"), 1))
_both("miscarriage_count", "full", "v3", "n_births n_pregnancies",
      at_least_zero(f"({z('n_pregnancies')} - {z('n_births')})"))
_both("has_miscarriage", "full", "v3", "miscarriage_count", flag("miscarriage_count > 0"))
_both("miscarriage_rate", "full", "v3", "miscarriage_count n_pregnancies",
      ratio("miscarriage_count", z("n_pregnancies")))
_both("long_infertility", "full", "v3", "years_trying", flag(f"{num('years_trying')} >= 7"))
_both("censored_cycles", "full", "v3", "n_cycles", flag(f"{num('n_cycles')} = 6"))
_both("censored_preg", "full", "v3", "n_pregnancies", flag(f"{num('n_pregnancies')} = 6"))
_both("infertility_complexity", "full", "v3", " ".join(S.CAUSES),
      f"CAST({' + '.join(z(c) for c in S.CAUSES)} AS INT)")
_raw("cumulative_failure_burden", "full", "n_cycles n_pregnancies",
     at_least_zero(f"({z('n_cycles')} - {z('n_pregnancies')})"))
_raw("clinic_veteran", "full", "n_clinic_cycles", flag(f"{num('n_clinic_cycles')} >= 3"))

# Embryo yields.
_raw("maturity_rate", "full", "icsi_eggs fresh_eggs", ratio(z("icsi_eggs"), z("fresh_eggs"), 1))
_raw("mature_oocyte_rate", "full", "maturity_rate", "maturity_rate")
_clean("ratio_maturity", "full", "icsi_eggs fresh_eggs", ratio(z("icsi_eggs"), z("fresh_eggs"), 1))
_both("is_ICSI", "full", "full", "icsi_eggs", flag(f"{num('icsi_eggs')} > 0"))
_raw("icsi_fert_rate", "full", "icsi_embryos icsi_eggs", ratio(z("icsi_embryos"), z("icsi_eggs"), 1))
_clean("ratio_icsi_success", "full", "is_ICSI icsi_embryos icsi_eggs",
       f"CASE WHEN is_ICSI = 1 THEN {ratio(z('icsi_embryos'), z('icsi_eggs'), 1)} END")
_raw("transferable_rate", "full", "embryos_transferred embryos_stored embryos_total",
     ratio(USED, z("embryos_total"), 1))
_raw("adoption_rate", "full", "embryos_transferred embryos_stored", ratio(z("embryos_transferred"), USED, 1))
_raw("icsi_failures", "full", "icsi_eggs icsi_embryos", at_least_zero(f"({z('icsi_eggs')} - {z('icsi_embryos')})"))
_raw("icsi_share", "full", "icsi_eggs embryos_total", ratio(z("icsi_eggs"), z("embryos_total"), 1))
_raw("transfer_cancelled", "full", "embryos_transferred", flag(f"{num('embryos_transferred')} = 0"))
_clean("transfer_cancelled", "full", "embryos_transferred", flag(f"{z('embryos_transferred')} = 0"))
_clean("ratio_embryo_yield", "full", "embryos_total fresh_eggs", ratio(z("embryos_total"), z("fresh_eggs"), 1))
_clean("ratio_transfer_density", "full", "embryos_transferred embryos_total",
       ratio(z("embryos_transferred"), z("embryos_total"), 1))

# Repaired totals and the rates built on them.
_raw("embryos_fixed", "full", "embryos_total embryos_transferred embryos_stored",
     f"greatest({z('embryos_total')}, {USED})")
_raw("icsi_embryos_fixed", "full", "icsi_embryos icsi_eggs", f"least({z('icsi_embryos')}, {z('icsi_eggs')})")
_raw("egg_to_embryo_rate", "full", "embryos_fixed fresh_eggs", ratio("embryos_fixed", z("fresh_eggs"), 1))
_raw("icsi_success_rate", "full", "icsi_embryos_fixed icsi_eggs", ratio("icsi_embryos_fixed", z("icsi_eggs"), 1))
_raw("embryo_utilization_rate", "full", "embryos_transferred embryos_stored embryos_fixed",
     ratio(USED, "embryos_fixed", 1))
_raw("total_pipeline_efficiency", "full", "embryos_transferred embryos_stored fresh_eggs",
     ratio(USED, z("fresh_eggs"), 1))
_both("is_FET", "full", "full", "embryos_thawed", flag(f"{num('embryos_thawed')} > 0"))
for _name, _source in (("fresh_fet_adj", "fresh_eggs"), ("mixed_fet_adj", "mixed_eggs")):
    _raw(_name, "full", f"is_FET {_source}", f"CASE WHEN is_FET = 1 THEN -1D ELSE {z(_source)} END")
_raw("arrested_embryo_count", "full", "embryos_fixed embryos_transferred embryos_stored",
     at_least_zero(f"(embryos_fixed - {USED})"))
_raw("arrested_embryo_rate", "full", "arrested_embryo_count embryos_fixed",
     ratio("arrested_embryo_count", "embryos_fixed"))
_raw("total_fertilization_failure", "full", "fresh_eggs embryos_total",
     flag(f"{num('fresh_eggs')} > 0 AND {z('embryos_total')} = 0"))
_raw("all_embryos_arrested", "full", "embryos_total embryos_transferred embryos_stored",
     flag(f"{num('embryos_total')} > 0 AND {z('embryos_transferred')} = 0 AND {z('embryos_stored')} = 0"))
_raw("elective_freeze", "full", "embryos_transferred embryos_stored",
     flag(f"{z('embryos_transferred')} = 0 AND {num('embryos_stored')} > 0"))
_raw("age_normalized_efficiency", "full", "egg_to_embryo_rate real_age_num", f"egg_to_embryo_rate * {age_scale()}")
_raw("age_normalized_pipeline", "full", "total_pipeline_efficiency real_age_num",
     f"total_pipeline_efficiency * {age_scale()}")
_clean("age_normalized_efficiency", "v3", "embryos_total fresh_eggs real_age_num",
       f"{ratio(z('embryos_total'), z('fresh_eggs'), 1)} * {age_scale(18)}")
_clean("age_normalized_pipeline", "v3", "embryos_transferred embryos_stored fresh_eggs real_age_num",
       f"{ratio(USED, z('fresh_eggs'), 1)} * {age_scale(18)}")

# Treatment suitability and bins.
_raw("male_factor", "full", "cause_male_primary cause_male_secondary cause_male_factor",
     flag(" OR ".join(f"{z(c)} = 1" for c in ("cause_male_primary", "cause_male_secondary", "cause_male_factor"))))
_raw("suitability", "full", "male_factor is_ICSI", suitability("male_factor = 1", "raw"))
_clean("suitability", "full", "cause_male_factor is_ICSI",
       suitability(f"CAST({z('cause_male_factor')} AS INT) = 1", "clean"))
_raw("icsi_suitable", "full", "male_factor is_ICSI", flag("male_factor = 1 AND is_ICSI = 1"))
_clean("proper_icsi_match", "full", "cause_male_factor icsi_eggs",
       flag(f"{num('cause_male_factor')} = 1 AND {num('icsi_eggs')} > 0"))
for _name, _source, (_edges, _labels) in (
    ("embryo_group", "embryos_total", S.EMBRYO_BINS),
    ("icsi_egg_group", "icsi_eggs", S.ICSI_EGG_BINS),
):
    _raw(_name, "full", _source, bins(num(_source), _edges, _labels, S.BIN_LIMITS["raw"]))
    _clean(_name, "full", _source, f"coalesce({bins(z(_source), _edges, _labels, S.BIN_LIMITS['clean'])}, 'nan')")

# Interactions.
_raw("age_x_procs", "full", "age_num n_cycles", f"{z('age_num')} * {z('n_cycles')}")
_clean("age_x_procedure", "full", "age_median n_cycles", f"{z('age_median', S.AGE_WHEN_UNKNOWN)} * {z('n_cycles')}")
_raw("age_x_log_embryo", "full", "age_num log_n_embryo", f"{z('age_num')} * log_n_embryo")
_raw("icsi_fert_x_male", "full", "icsi_fert_rate male_factor", "icsi_fert_rate * male_factor")

# Consistency and clinical flags.
_raw("is_mismatch_icsi", "full", "male_factor is_ICSI", flag("male_factor != is_ICSI"))
_raw("is_split_strategy", "full", "mixed_eggs icsi_eggs", flag(f"{num('mixed_eggs')} > 0 AND {num('icsi_eggs')} > 0"))
_raw("is_donor_sperm", "full", "donor_mixed_eggs", flag(f"{num('donor_mixed_eggs')} > 0"))
_both("is_elective_SET", "full", "v3", "embryos_transferred embryos_total",
      flag(f"{num('embryos_transferred')} = 1 AND {num('embryos_total')} > 1"))
_both("high_ovarian_response", "full", "full", "fresh_eggs", flag(f"{num('fresh_eggs')} > 20"))
_clean("low_ovarian_response", "full", "fresh_eggs", flag(f"{z('fresh_eggs')} <= 3"))
_raw("is_egg_optimal", "full", "fresh_eggs", flag(f"{num('fresh_eggs')} BETWEEN 10 AND 20"))
_clean("eggs_optimal", "full", "fresh_eggs", flag(f"{num('fresh_eggs')} BETWEEN 10 AND 20"))
_both("is_blastocyst_by_day", "full", "full", "day_transfer", flag(f"{num('day_transfer')} >= 5"))
_both("bast_transfer", "full", "full", "is_blastocyst_by_day", "is_blastocyst_by_day")
_raw("icsi_above_avg_success", "full", "is_ICSI icsi_fert_rate", flag("is_ICSI = 1 AND icsi_fert_rate >= 0.7D"))
_clean("icsi_above_avg_success", "full", "is_ICSI ratio_icsi_success",
       f"CASE WHEN is_ICSI = 1 THEN {flag('ratio_icsi_success >= 0.7D')} END")
_raw("is_DI", "full", "treatment_type", flag("treatment_type = 'DI'"))
_raw("proven_fertility_older", "full", "age_num ever_delivered", flag("age_num >= 40 AND ever_delivered = 1"))
_raw("dor_young", "full", "fresh_eggs age_num", flag(f"{z('fresh_eggs')} <= 3 AND age_num < 35"))
_raw("pgt_elder", "full", "age_num pgs pgd", flag(f"age_num >= 40 AND ({z('pgs')} = 1 OR {z('pgd')} = 1)"))
_raw("male_severe", "full", "cause_sperm_conc cause_sperm_motility cause_sperm_morph",
     flag(f"{z('cause_sperm_conc')} + {z('cause_sperm_motility')} + {z('cause_sperm_morph')} >= 2"))
_raw("donor_age_advantage", "full", "age_num egg_donor_age_num egg_source",
     f"CASE WHEN {DONATED} THEN {z('age_num', S.AGE_WHEN_UNKNOWN)} "
     f"- {z('egg_donor_age_num', S.DONOR_AGE_WHEN_UNKNOWN)} ELSE 0D END")
_raw("triple_positive", "full", "age_num is_blastocyst_by_day is_egg_optimal",
     flag("age_num < 40 AND is_blastocyst_by_day = 1 AND is_egg_optimal = 1"))
_raw("blast_eset", "full", "is_blastocyst_by_day is_elective_SET",
     flag("is_blastocyst_by_day = 1 AND is_elective_SET = 1"))
_clean("eset_blast", "full", "single_transfer day_transfer",
       flag(f"{num('single_transfer')} = 1 AND {num('day_transfer')} >= 5"))
_clean("elderly_donor_egg", "full", "age_ord egg_source", flag(f"{DONATED} AND age_ord >= 3"))
_clean("flag_logic_error", "full", "is_FET embryos_transferred embryos_total",
       flag(f"is_FET = 0 AND {z('embryos_transferred')} > {z('embryos_total')}"))
_raw("age_success_prior", "full", "age_ord egg_source", success_prior("published"))
_clean("age_success_prior", "full", "age_band egg_source", success_prior("measured"))

# NULL-able columns that the row-wise missing count of the raw profile looks at besides the source columns.
RAW_COUNTED = (
    "age_num", "egg_donor_age_num", "sperm_donor_age_num", "past_preg_rate", "past_birth_rate",
    "ivf_preg_rate", "embryo_transfer_ratio", "embryo_stored_ratio", "icsi_ratio", "age_x_transferred",
    "gap_transfer_minus_pickup", "days_mix_to_transfer", "real_age_num", "age_x_embryo_ratio",
)


def catalogue(profile: str, level: str) -> dict[str, Feature]:
    levels = LEVELS[profile]
    if level not in levels:
        raise ValueError(f"level {level!r} is not one of {levels}")
    allowed = set(levels[: levels.index(level) + 1])
    table = RAW if profile == "raw" else CLEAN
    return {n: f for n, f in table.items() if f.level in allowed}


def _with(df: DataFrame, new: dict[str, str]) -> DataFrame:
    keep = [f"`{c}`" for c in df.columns if c not in new]
    return df.selectExpr(*keep, *[f"{e} AS `{n}`" for n, e in new.items()])


def _resolve(have: Iterable[str], features: dict[str, Feature]) -> tuple[list[list[Feature]], dict[str, list[str]]]:
    """Dependency layers, and the features left out with the columns they miss."""
    known, todo, layers = set(have), dict(features), []
    while todo:
        ready = [f for f in todo.values() if known.issuperset(f.needs)]
        if not ready:
            return layers, {f.name: [n for n in f.needs if n not in known] for f in todo.values()}
        layers.append(ready)
        for f in ready:
            del todo[f.name]
        known |= {f.name for f in ready}
    return layers, {}


def skipped(df: DataFrame, profile: str, level: str = "full") -> dict[str, list[str]]:
    """Features that ``derive`` would leave out, with the columns they miss."""
    return _resolve(df.columns, catalogue(profile, level))[1]


def derive(df: DataFrame, level: str = "full", profile: str = "clean", *, legacy: bool = False) -> DataFrame:
    """Add the features of a level to a cleaned table.

    ``legacy`` (clean profile) takes missing flags and the row-wise missing count after sentinels and
    medians instead of from the source columns.
    """
    source = df.columns
    layers, _ = _resolve(source, catalogue(profile, level))
    out = df
    for layer in layers:
        out = _with(out, {f.name: f.sql for f in layer})
    if profile == "raw" and level == "full":
        counted = C.source_columns(df) + [c for c in RAW_COUNTED if c in out.columns]
        out = _with(out, {"n_missing_row": null_count(counted)})
    if profile == "clean" and legacy:
        seen = [c for c in source if c not in S.NOT_FEATURES and c != "n_missing_row"]
        seen += [f.name for layer in layers for f in layer if f.level == "v3" and f.name not in S.MISSING_DAYS]
        flags = {n: f"CAST({d} IS NULL AS INT)" for n, d in S.MISSING_DAYS.items() if d in source}
        out = _with(
            out.drop(*[n for n in S.MISSING_DAYS if n not in flags]), {**flags, "n_missing_row": null_count(seen)}
        )
    return out
