"""Feature queries: one per family, and the whole catalogue of both profiles."""

from __future__ import annotations

from cohortlift import schema as S
from cohortlift.operators.features import CLEAN, RAW, catalogue, derive
from cohortlift.plans.base import (
    cleaned, query, raw, rounded, sql_cleaned, sql_map, sql_null_count, sql_raw, with_cycles,
)

E = "1e-6"


def _c(x: str, fill: str = "0") -> str:
    return f"coalesce({x}, {fill})"


def _f(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


FRESH, TOTAL, EGGS, ICSI = _c("fresh_eggs"), _c("embryos_total"), _c("icsi_eggs"), _c("icsi_embryos")
TRF, STORED, MIXED, THAWED = _c("embryos_transferred"), _c("embryos_stored"), _c("mixed_eggs"), _c("embryos_thawed")
CYC, PREG, BIRTH = _c("n_cycles"), _c("n_pregnancies"), _c("n_births")
LOST = f"greatest({PREG} - {BIRTH}, 0)"
CAUSE_SUM = "CAST(" + " + ".join(_c(c) for c in S.CAUSES) + " AS INTEGER)"
MALE = f"({_c('cause_male_primary')} = 1 OR {_c('cause_male_secondary')} = 1 OR {_c('cause_male_factor')} = 1)"


def _bins(x: str, edges, labels, high: int) -> str:
    a, b, c = edges
    return (
        f"CASE WHEN {x} > {high} OR {x} < 0 THEN NULL WHEN {x} <= {a} THEN '{labels[0]}' WHEN {x} <= {b} "
        f"THEN '{labels[1]}' WHEN {x} <= {c} THEN '{labels[2]}' WHEN {x} IS NOT NULL THEN '{labels[3]}' END"
    )


# Expected values of the raw profile, in steps that build on each other.
RAW_SQL = [
    {
        "past_preg_rate": f"n_pregnancies / (n_cycles + {E})",
        "past_birth_rate": f"n_births / (n_pregnancies + {E})",
        "ivf_preg_rate": f"n_ivf_pregnancies / (n_ivf_cycles + {E})",
        "embryo_transfer_ratio": f"embryos_transferred / (embryos_total + {E})",
        "embryo_stored_ratio": f"embryos_stored / (embryos_total + {E})",
        "icsi_ratio": f"icsi_eggs / (mixed_eggs + {E})",
        "age_x_transferred": "age_num * embryos_transferred",
        "gap_transfer_minus_pickup": "day_transfer - day_egg_pickup",
        "days_mix_to_transfer": "day_transfer - day_egg_mix",
        "real_age_num": f"CASE WHEN egg_source = '{S.DONATED}' THEN egg_donor_age_num ELSE age_num END",
        "log_n_embryo": f"ln(1 + {TOTAL})",
        "miss_gene_test": _f("pgs IS NULL OR pgd IS NULL OR pgt_used IS NULL"),
        "missing_day_transfer": _f("day_transfer IS NULL"),
        "missing_day_pickup": _f("day_egg_pickup IS NULL"),
        "missing_day_mix": _f("day_egg_mix IS NULL"),
        "ever_delivered": _f("n_births > 0"),
        "repeated_3plus": _f("n_cycles >= 3"),
        "is_first_attempt": _f("n_cycles = 0"),
        "prev_birth_rate": f"{BIRTH} / ({PREG} + 1)",
        "miscarriage_count": LOST,
        "has_miscarriage": _f(f"{LOST} > 0"),
        "miscarriage_rate": f"{LOST} / ({PREG} + {E})",
        "long_infertility": _f("years_trying >= 7"),
        "censored_cycles": _f("n_cycles = 6"),
        "censored_preg": _f("n_pregnancies = 6"),
        "infertility_complexity": CAUSE_SUM,
        "cumulative_failure_burden": f"greatest({CYC} - {PREG}, 0)",
        "clinic_veteran": _f("n_clinic_cycles >= 3"),
        "maturity_rate": f"{EGGS} / ({FRESH} + 1)",
        "mature_oocyte_rate": f"{EGGS} / ({FRESH} + 1)",
        "icsi_fert_rate": f"{ICSI} / ({EGGS} + 1)",
        "transferable_rate": f"({TRF} + {STORED}) / ({TOTAL} + 1)",
        "adoption_rate": f"{TRF} / ({TRF} + {STORED} + 1)",
        "is_ICSI": _f(f"{EGGS} > 0"),
        "icsi_failures": f"greatest({EGGS} - {ICSI}, 0)",
        "icsi_share": f"{EGGS} / ({TOTAL} + 1)",
        "transfer_cancelled": _f("embryos_transferred = 0"),
        "male_factor": _f(MALE),
        "embryo_group": _bins("embryos_total", *S.EMBRYO_BINS, 1000),
        "icsi_egg_group": _bins("icsi_eggs", *S.ICSI_EGG_BINS, 1000),
        "embryos_fixed": f"greatest({TOTAL}, {TRF} + {STORED})",
        "icsi_embryos_fixed": f"least({ICSI}, {EGGS})",
        "total_pipeline_efficiency": f"({TRF} + {STORED}) / ({FRESH} + 1)",
        "is_FET": _f(f"{THAWED} > 0"),
        "is_split_strategy": _f(f"{MIXED} > 0 AND {EGGS} > 0"),
        "is_donor_sperm": _f("donor_mixed_eggs > 0"),
        "is_elective_SET": _f(f"{TRF} = 1 AND {TOTAL} > 1"),
        "high_ovarian_response": _f(f"{FRESH} > 20"),
        "is_egg_optimal": _f(f"{FRESH} >= 10 AND {FRESH} <= 20"),
        "is_blastocyst_by_day": _f("day_transfer >= 5"),
        "bast_transfer": _f("day_transfer >= 5"),
        "is_DI": _f("treatment_type = 'DI'"),
        "dor_young": _f(f"{FRESH} <= 3 AND {_c('age_num', '99')} < 35"),
        "pgt_elder": _f(f"{_c('age_num')} >= 40 AND (pgs = 1 OR pgd = 1)"),
        "male_severe": _f(
            f"{_c('cause_sperm_conc')} + {_c('cause_sperm_motility')} + {_c('cause_sperm_morph')} >= 2"
        ),
        "total_fertilization_failure": _f(f"{FRESH} > 0 AND {TOTAL} = 0"),
        "all_embryos_arrested": _f(f"{TOTAL} > 0 AND {TRF} = 0 AND {STORED} = 0"),
        "elective_freeze": _f(f"{TRF} = 0 AND {STORED} > 0"),
        "donor_age_advantage": f"CASE WHEN egg_source = '{S.DONATED}' THEN {_c('age_num', '36')} - "
                               f"{_c('egg_donor_age_num', '28')} ELSE 0.0E0 END",
        "age_success_prior": f"CAST(CASE WHEN egg_source = '{S.DONATED}' THEN 0.38 ELSE "
                             f"{sql_map('age_ord', S.PUBLISHED_PRIOR, '0.17')} END AS DOUBLE)",
        "age_x_procs": f"{_c('age_num')} * {CYC}",
    },
    {
        "age_x_embryo_ratio": "age_num * embryo_transfer_ratio",
        "suitability": "CASE WHEN male_factor = 1 AND is_ICSI = 1 THEN 'AdequateICSI' WHEN male_factor = 0 AND "
                       "is_ICSI = 1 THEN 'OverusedICSI' WHEN male_factor = 1 AND is_ICSI = 0 THEN 'UnderservedICSI' "
                       "ELSE 'Neither' END",
        "icsi_suitable": _f("male_factor = 1 AND is_ICSI = 1"),
        "age_x_log_embryo": f"{_c('age_num')} * log_n_embryo",
        "icsi_fert_x_male": "icsi_fert_rate * male_factor",
        "egg_to_embryo_rate": f"embryos_fixed / ({FRESH} + 1)",
        "icsi_success_rate": f"icsi_embryos_fixed / ({EGGS} + 1)",
        "embryo_utilization_rate": f"({TRF} + {STORED}) / (embryos_fixed + 1)",
        "fresh_fet_adj": f"CASE WHEN is_FET = 1 THEN -1 ELSE {FRESH} END",
        "mixed_fet_adj": f"CASE WHEN is_FET = 1 THEN -1 ELSE {MIXED} END",
        "is_mismatch_icsi": _f("male_factor <> is_ICSI"),
        "age_normalized_pipeline": f"total_pipeline_efficiency * ({_c('real_age_num', '35')} / 35)",
        "icsi_above_avg_success": _f("is_ICSI = 1 AND icsi_fert_rate >= 0.70"),
        "proven_fertility_older": _f(f"{_c('age_num')} >= 40 AND ever_delivered = 1"),
        "arrested_embryo_count": f"greatest(embryos_fixed - {TRF} - {STORED}, 0)",
        "triple_positive": _f(f"{_c('age_num', '99')} < 40 AND day_transfer >= 5 AND {FRESH} BETWEEN 10 AND 20"),
        "blast_eset": _f("day_transfer >= 5 AND is_elective_SET = 1"),
    },
    {
        "age_normalized_efficiency": f"egg_to_embryo_rate * ({_c('real_age_num', '35')} / 35)",
        "arrested_embryo_rate": f"arrested_embryo_count / (embryos_fixed + {E})",
    },
]
AGE36 = _c("age_median", "36")
CLEAN_SQL = [
    {
        "past_preg_rate": f"{PREG} / ({CYC} + {E})",
        "past_birth_rate": f"{BIRTH} / ({PREG} + {E})",
        "ivf_preg_rate": f"{_c('n_ivf_pregnancies')} / ({_c('n_ivf_cycles')} + {E})",
        "embryo_transfer_ratio": f"{TRF} / ({TOTAL} + {E})",
        "embryo_stored_ratio": f"{STORED} / ({TOTAL} + {E})",
        "icsi_ratio": f"{EGGS} / ({MIXED} + {E})",
        "age_x_transferred": f"{AGE36} * {TRF}",
        "days_mix_to_transfer": "day_transfer - day_egg_mix",
        "real_age_num": f"CASE WHEN egg_source = '{S.DONATED}' THEN "
                        f"CAST({sql_map('egg_donor_age', S.DONOR_AGE)} AS DOUBLE) ELSE age_median END",
        "log_n_embryo": f"ln(1 + {TOTAL})",
        **{f"has_{t}": _f(f"specific_type LIKE '%{t}%'") for t in S.PROCEDURE_TOKENS},
        **{n: f"{n}_raw" for n in S.MISSING_DAYS},
        "is_elective_SET": _f(f"{TRF} = 1 AND {TOTAL} > 1"),
        "miscarriage_count": f"CAST({LOST} AS DOUBLE)",
        "has_miscarriage": _f(f"{LOST} > 0"),
        "miscarriage_rate": f"{LOST} / ({PREG} + {E})",
        "infertility_complexity": CAUSE_SUM,
        "long_infertility": _f("years_trying >= 7"),
        "censored_cycles": _f("n_cycles = 6"),
        "censored_preg": _f("n_pregnancies = 6"),
        "ever_delivered": _f(f"{BIRTH} > 0"),
        "repeated_3plus": _f(f"{CYC} >= 3"),
        "is_first_attempt": _f(f"{CYC} = 0"),
        "is_FET": _f(f"{THAWED} > 0"),
        "eset_blast": _f("single_transfer = 1 AND day_transfer >= 5"),
        "elderly_donor_egg": _f(f"age_ord >= 3 AND egg_source = '{S.DONATED}'"),
        "ratio_maturity": f"{EGGS} / ({FRESH} + 1)",
        "is_ICSI": _f(f"{EGGS} > 0"),
        "ratio_icsi_success": f"CASE WHEN {EGGS} > 0 THEN {ICSI} / ({EGGS} + 1) END",
        "ratio_embryo_yield": f"{TOTAL} / ({FRESH} + 1)",
        "ratio_transfer_density": f"{TRF} / ({TOTAL} + 1)",
        "eggs_optimal": _f(f"{FRESH} BETWEEN 10 AND 20"),
        "low_ovarian_response": _f(f"{FRESH} <= 3"),
        "high_ovarian_response": _f(f"{FRESH} > 20"),
        "proper_icsi_match": _f(f"{_c('cause_male_factor')} = 1 AND {EGGS} > 0"),
        "age_x_procedure": f"{AGE36} * {CYC}",
        "is_blastocyst_by_day": _f("day_transfer >= 5"),
        "bast_transfer": _f("day_transfer >= 5"),
        "embryo_group": _c(_bins(TOTAL, *S.EMBRYO_BINS, 9999), "'nan'"),
        "icsi_egg_group": _c(_bins(EGGS, *S.ICSI_EGG_BINS, 9999), "'nan'"),
        "suitability": f"CASE WHEN {_c('cause_male_factor')} = 1 AND {EGGS} > 0 THEN '적합ICSI' WHEN "
                       f"{_c('cause_male_factor')} = 0 AND {EGGS} > 0 THEN '과사용' WHEN {_c('cause_male_factor')} = 1 "
                       "THEN '부적합' ELSE '해당없음' END",
        "transfer_cancelled": _f(f"{TRF} = 0"),
        "flag_logic_error": _f(f"NOT ({THAWED} > 0) AND {TRF} > {TOTAL}"),
        "age_success_prior": f"CAST(CASE WHEN egg_source = '{S.DONATED}' THEN 0.3154 ELSE "
                             f"{sql_map('age_band', S.MEASURED_PRIOR)} END AS DOUBLE)",
    },
    {
        "age_x_embryo_ratio": f"{AGE36} * embryo_transfer_ratio",
        "age_normalized_efficiency": f"{TOTAL} / ({FRESH} + 1) * (greatest({_c('real_age_num', '35')}, 18) / 35)",
        "age_normalized_pipeline": f"({TRF} + {STORED}) / ({FRESH} + 1) * (greatest({_c('real_age_num', '35')}, 18) / 35)",
        "icsi_above_avg_success": f"CASE WHEN is_ICSI = 1 THEN CAST({_f('ratio_icsi_success >= 0.70')} AS DOUBLE) END",
    },
]
LOGS = ("log_n_embryo", "age_x_log_embryo")


def sql_features(profile: str) -> list[str]:
    """CTEs ending in ``feat``."""
    steps, source = (RAW_SQL, "rawc") if profile == "raw" else (CLEAN_SQL, "cleaned")
    ctes = list(sql_raw() if profile == "raw" else sql_cleaned())
    for i, step in enumerate(steps):
        name = "feat" if i == len(steps) - 1 else f"feat{i}"
        ctes.append(f"{name} AS (SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in step.items()) + f" FROM {source})")
        source = name
    return ctes


def feature_sql(profile: str, names, extra: str = "") -> str:
    columns = ["id", *[f"round({n}, 9) AS {n}" if n in LOGS else n for n in names]]
    return with_cycles(f"SELECT {', '.join(columns)}{extra} FROM feat", *sql_features(profile))


def derived(spark, sf_dir, profile: str, level: str = "full"):
    if profile == "raw":
        return derive(raw(spark, sf_dir), level, "raw")
    return derive(cleaned(spark, sf_dir), level, "clean")


def pick(df, names):
    return df.select("id", *[rounded(n) if n in LOGS else n for n in names])


F1 = ["past_preg_rate", "past_birth_rate", "ivf_preg_rate", "embryo_transfer_ratio", "embryo_stored_ratio",
      "icsi_ratio", "miscarriage_rate", "arrested_embryo_rate"]
F2 = ["prev_birth_rate", "maturity_rate", "icsi_fert_rate", "transferable_rate", "adoption_rate", "icsi_share",
      "mature_oocyte_rate", "egg_to_embryo_rate", "icsi_success_rate", "embryo_utilization_rate",
      "total_pipeline_efficiency"]
F3 = ["age_x_transferred", "gap_transfer_minus_pickup", "days_mix_to_transfer", "age_x_embryo_ratio", "age_x_procs",
      "age_x_log_embryo", "icsi_fert_x_male"]
F4 = ["miscarriage_count", "icsi_failures", "arrested_embryo_count", "cumulative_failure_burden"]
F5 = ["ever_delivered", "repeated_3plus", "is_first_attempt", "long_infertility", "censored_cycles", "censored_preg",
      "is_elective_SET", "high_ovarian_response", "is_blastocyst_by_day", "proven_fertility_older", "dor_young",
      "elective_freeze", "pgt_elder", "total_fertilization_failure", "all_embryos_arrested", "triple_positive",
      "blast_eset", "clinic_veteran", "transfer_cancelled", "is_DI", "is_FET", "is_ICSI"]
F5_CLEAN = ["eset_blast", "elderly_donor_egg", "low_ovarian_response", "high_ovarian_response", "proper_icsi_match",
            "is_elective_SET", "transfer_cancelled", "is_FET", "has_miscarriage"]


def family(name: str, profile: str, names: list[str]) -> None:
    def run(spark, sf_dir):
        return pick(derived(spark, sf_dir, profile), names)

    run.__name__ = name
    query(feature_sql(profile, names))(run)


family("ratios_with_epsilon", "raw", F1)
family("ratios_with_epsilon_zero_filled", "clean", [n for n in F1 if n in CLEAN])
family("ratios_with_plus_one", "raw", F2)
family("differences_and_products", "raw", F3)
family("clipped_differences", "raw", F4)
family("threshold_flags", "raw", F5)
family("threshold_flags_clean", "clean", F5_CLEAN)
family("egg_range_flag", "raw", ["is_egg_optimal"])
family("embryo_and_egg_bins", "raw", ["embryo_group", "icsi_egg_group"])
family("embryo_and_egg_bins_clean", "clean", ["embryo_group", "icsi_egg_group"])
family("treatment_suitability", "raw", ["male_factor", "suitability", "icsi_suitable"])
family("treatment_suitability_clean", "clean", ["suitability", "proper_icsi_match"])
family("conditional_values", "raw", ["icsi_above_avg_success", "donor_age_advantage"])
family("conditional_values_clean", "clean", ["ratio_icsi_success", "icsi_above_avg_success"])
family("log_embryos", "raw", ["log_n_embryo"])
family("donor_adjusted_age", "raw", ["real_age_num"])
family("cause_and_issue_counts", "raw", ["infertility_complexity", "male_severe"])
family("any_gene_test_missing", "raw", ["miss_gene_test"])
family("published_age_prior", "raw", ["age_success_prior"])
family("measured_age_prior", "clean", ["age_success_prior"])
family("age_scaled_efficiency", "clean", ["age_normalized_efficiency", "age_normalized_pipeline"])
family("consistency_flags", "raw", ["is_mismatch_icsi", "is_split_strategy", "is_donor_sperm"])
family("transfer_logic_error", "clean", ["flag_logic_error"])

V3_NAMES = list(catalogue("clean", "v3"))


@query(feature_sql("clean", V3_NAMES))
def features_clean_v3(spark, sf_dir):
    return pick(derived(spark, sf_dir, "clean", "v3"), V3_NAMES)


@query(feature_sql("clean", list(CLEAN)))
def features_clean_full(spark, sf_dir):
    return pick(derived(spark, sf_dir, "clean"), list(CLEAN))


# The row-wise missing count of the raw profile covers source and derived columns.
COUNTED = [c.name for c in S.COLUMNS if c.name not in ("id", "success", "specific_type", "embryo_reason")] + [
    "age_num", "egg_donor_age_num", "sperm_donor_age_num", *F1[:6], "age_x_transferred", "gap_transfer_minus_pickup",
    "days_mix_to_transfer", "real_age_num", "age_x_embryo_ratio",
]


@query(feature_sql("raw", list(RAW), f", {sql_null_count(COUNTED)} AS n_missing_row"))
def features_raw_full(spark, sf_dir):
    return pick(derived(spark, sf_dir, "raw"), [*RAW, "n_missing_row"])


# What is left missing after sentinels and medians: flags of DI cycles, texts, the unknown age, the unknown donor age.
LEFT_MISSING = [
    *[c.name for c in S.COLUMNS if c.group in ("encoded", "categorical", "flag", "cause") and c.name not in ("pgd", "pgs")],
    "age_ord", "real_age_num",
]


@query(
    feature_sql(
        "clean",
        [],
        ", 0 AS is_censored_total_cycles, 0 AS miss_gene_test, "
        f"0 AS missing_day_transfer, 0 AS missing_day_mix, {sql_null_count(LEFT_MISSING)} AS n_missing_row",
    )
)
def legacy_missing_counts(spark, sf_dir):
    """Flags and counts taken after sentinels and medians, as an option."""
    out = derive(cleaned(spark, sf_dir, legacy=True), "v3", "clean", legacy=True)
    return out.select(
        "id", "is_censored_total_cycles", "miss_gene_test", "missing_day_transfer", "missing_day_mix", "n_missing_row"
    )
