"""Column registry of the treatment-cycle table and the fixed values of its domain."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class ColumnSpec:
    source: str
    name: str
    dtype: str
    group: str


# Source header, ASCII name, type and group of each of the 69 columns.
COLUMNS: tuple[ColumnSpec, ...] = tuple(
    ColumnSpec(*line.split("|"))
    for line in """\
ID|id|bigint|identity
시술 시기 코드|period_code|string|encoded
시술 당시 나이|age_band|string|categorical
임신 시도 또는 마지막 임신 경과 연수|years_trying|double|numeric
시술 유형|treatment_type|string|categorical
특정 시술 유형|specific_type|string|categorical
배란 자극 여부|ovulation_stimulated|double|flag
배란 유도 유형|induction_type|string|near_constant
단일 배아 이식 여부|single_transfer|double|flag
착상 전 유전 검사 사용 여부|pgt_used|double|near_constant
착상 전 유전 진단 사용 여부|pgt_diagnosis|double|flag
남성 주 불임 원인|cause_male_primary|double|flag
남성 부 불임 원인|cause_male_secondary|double|flag
여성 주 불임 원인|cause_female_primary|double|flag
여성 부 불임 원인|cause_female_secondary|double|flag
부부 주 불임 원인|cause_couple_primary|double|flag
부부 부 불임 원인|cause_couple_secondary|double|flag
불명확 불임 원인|cause_unexplained|double|flag
불임 원인 - 난관 질환|cause_tubal|double|cause
불임 원인 - 남성 요인|cause_male_factor|double|cause
불임 원인 - 배란 장애|cause_ovulatory|double|cause
불임 원인 - 여성 요인|cause_female_factor|double|near_constant
불임 원인 - 자궁경부 문제|cause_cervical|double|near_constant
불임 원인 - 자궁내막증|cause_endometriosis|double|cause
불임 원인 - 정자 농도|cause_sperm_conc|double|cause
불임 원인 - 정자 면역학적 요인|cause_sperm_immune|double|near_constant
불임 원인 - 정자 운동성|cause_sperm_motility|double|cause
불임 원인 - 정자 형태|cause_sperm_morph|double|cause
배아 생성 주요 이유|embryo_reason|string|categorical
총 시술 횟수|n_cycles|string|count
클리닉 내 총 시술 횟수|n_clinic_cycles|string|count
IVF 시술 횟수|n_ivf_cycles|string|count
DI 시술 횟수|n_di_cycles|string|count
총 임신 횟수|n_pregnancies|string|count
IVF 임신 횟수|n_ivf_pregnancies|string|count
DI 임신 횟수|n_di_pregnancies|string|count
총 출산 횟수|n_births|string|count
IVF 출산 횟수|n_ivf_births|string|count
DI 출산 횟수|n_di_births|string|count
총 생성 배아 수|embryos_total|double|numeric
미세주입된 난자 수|icsi_eggs|double|numeric
미세주입에서 생성된 배아 수|icsi_embryos|double|numeric
이식된 배아 수|embryos_transferred|double|numeric
미세주입 배아 이식 수|icsi_transferred|double|numeric
저장된 배아 수|embryos_stored|double|numeric
미세주입 후 저장된 배아 수|icsi_stored|double|numeric
해동된 배아 수|embryos_thawed|double|numeric
해동 난자 수|eggs_thawed|double|numeric
수집된 신선 난자 수|fresh_eggs|double|numeric
저장된 신선 난자 수|fresh_eggs_stored|double|numeric
혼합된 난자 수|mixed_eggs|double|numeric
파트너 정자와 혼합된 난자 수|partner_mixed_eggs|double|numeric
기증자 정자와 혼합된 난자 수|donor_mixed_eggs|double|numeric
난자 출처|egg_source|string|categorical
정자 출처|sperm_source|string|categorical
난자 기증자 나이|egg_donor_age|string|categorical
정자 기증자 나이|sperm_donor_age|string|categorical
동결 배아 사용 여부|frozen_embryo_used|double|flag
신선 배아 사용 여부|fresh_embryo_used|double|flag
기증 배아 사용 여부|donor_embryo_used|double|flag
대리모 여부|surrogate|double|flag
PGD 시술 여부|pgd|double|flag
PGS 시술 여부|pgs|double|flag
난자 채취 경과일|day_egg_pickup|double|near_constant
난자 해동 경과일|day_egg_thaw|double|numeric
난자 혼합 경과일|day_egg_mix|double|numeric
배아 이식 경과일|day_transfer|double|numeric
배아 해동 경과일|day_embryo_thaw|double|numeric
임신 성공 여부|success|int|target""".splitlines()
)

ID, TARGET = "id", "success"

# Band and count texts with their numbers.
AGE_MEDIAN = {
    "만18-34세": 26.0, "만35-37세": 36.0, "만38-39세": 38.5,
    "만40-42세": 41.0, "만43-44세": 43.5, "만45-50세": 47.5,
}
AGE_ORDINAL = {
    "만18-34세": 0, "만35-37세": 1, "만38-39세": 2,
    "만40-42세": 3, "만43-44세": 4, "만45-50세": 5,
}
DONOR_AGE = {
    "만20세 이하": 19.0, "만21-25세": 23.0, "만26-30세": 28.0,
    "만31-35세": 33.0, "만36-40세": 38.0, "만41-45세": 43.0,
}
COUNT_TEXT = {
    "0회": 0.0, "1회": 1.0, "2회": 2.0, "3회": 3.0, "4회": 4.0, "5회": 5.0, "6회 이상": 6.0,
}
UNKNOWN = "알 수 없음"
DONATED = "기증 제공"
AGE_WHEN_UNKNOWN = 36.0
DONOR_AGE_WHEN_UNKNOWN = 28.0

# Success priors by age (measured on the cohort; published by ordinal) and for donated eggs.
MEASURED_PRIOR = {
    "만18-34세": 0.3226, "만35-37세": 0.2784, "만38-39세": 0.2171, "만40-42세": 0.1594,
    "만43-44세": 0.1180, "만45-50세": 0.1677, "알 수 없음": 0.0,
}
MEASURED_DONOR_PRIOR = 0.3154
PUBLISHED_PRIOR = {0: 0.32, 1: 0.25, 2: 0.17, 3: 0.10, 4: 0.05, 5: 0.02}
PUBLISHED_PRIOR_DEFAULT = 0.17
PUBLISHED_DONOR_PRIOR = 0.38

# Tokens inside multi-valued strings.
PROCEDURE_TOKENS = ("ICSI", "IVF", "BLASTOCYST", "AH", "Unknown", "FER")
COMBO_TOKENS = ("ICSI", "IVF", "BLASTOCYST", "AH", "FER", "Unknown")
REASON_TOKENS = {
    "reason_donation": "기증용",
    "reason_egg_store": "난자 저장용",
    "reason_embryo_store": "배아 저장용",
    "reason_current": "현재 시술용",
}
REASON_TOKENS_CLEAN = {**REASON_TOKENS, "reason_research": "연구용"}

# Labels and bin edges (right-closed; the last edge differs between profiles).
EMBRYO_BINS = ((6, 14, 20), ("Poor", "Normal", "High", "Hyper"))
ICSI_EGG_BINS = ((3, 9, 19), ("VeryLow", "Low", "Optimal", "VeryHigh"))
BIN_LIMITS = {"raw": (-0.01, 1000), "clean": (-0.1, 9999)}
SUITABILITY_LABELS = {
    "raw": ("AdequateICSI", "OverusedICSI", "UnderservedICSI", "Neither"),
    "clean": ("적합ICSI", "과사용", "부적합", "해당없음"),
}

# Cleaning rules.
CENSOR_FLAGS = {
    "n_cycles": "is_censored_total_cycles",
    "n_clinic_cycles": "is_censored_clinic_cycles",
    "n_ivf_cycles": "is_censored_prev_ivf",
    "n_pregnancies": "is_censored_prev_preg",
    "n_births": "is_censored_prev_birth",
}
CENSOR_MARKS = ("이상", ">")
DI_ZERO_COLUMNS = (
    "embryos_total", "embryos_transferred", "embryos_stored",
    "icsi_embryos", "icsi_transferred", "icsi_stored",
)
SENTINEL_DAYS = {
    "embryos_transferred": "day_transfer",
    "embryos_thawed": "day_embryo_thaw",
    "eggs_thawed": "day_egg_thaw",
    "mixed_eggs": "day_egg_mix",
}
MISSING_DAYS = {
    "missing_day_transfer": "day_transfer",
    "missing_day_pickup": "day_egg_pickup",
    "missing_day_mix": "day_egg_mix",
}
MISSING_FLAGS = ("pgt_used", "years_trying", "day_embryo_thaw")
GENE_TEST_COLUMNS = ("pgs", "pgd", "pgt_used")

# Columns kept as categories by the learners.
CATEGORIES = (
    "period_code", "age_band", "treatment_type", "induction_type",
    "egg_source", "sperm_source", "egg_donor_age", "sperm_donor_age",
)
DERIVED_CATEGORIES = ("suitability", "embryo_group", "icsi_egg_group")

# Seeds, folds, smoothing strengths and blend starting points.
N_FOLDS = 5
SEEDS = (42, 2024, 777, 31415, 99999)
SMOOTHING = {"period": 20.0, "proc_specific": 30.0, "proc_age": 25.0, "proc_timing": 25.0}
BLEND_STARTS = (
    (0.0, 0.31, 0.165, 0.387, 0.138, 0.0),
    (0.0, 0.25, 0.15, 0.30, 0.10, 0.20),
    (0.0, 0.20, 0.15, 0.25, 0.10, 0.30),
    (0.1, 0.20, 0.15, 0.25, 0.10, 0.20),
)


def group(*names: str) -> list[str]:
    return [c.name for c in COLUMNS if c.group in names]


COUNTS = group("count")
NUMERIC = group("numeric")
CAUSES = group("cause")
DROPPED = group("near_constant")
NOT_FEATURES = (ID, TARGET, "split", "fold", "seed")


def base_features() -> list[str]:
    """Source columns used for training in the clean profile, with the censoring flags."""
    return [c.name for c in COLUMNS if c.group not in ("identity", "target", "near_constant")] + list(
        CENSOR_FLAGS.values()
    )


def spark_schema(header: str = "name", with_target: bool = True) -> T.StructType:
    """Explicit read schema, with ``source`` headers (as in the files) or ASCII ``name`` headers."""
    fields = [
        f"`{getattr(c, header)}` {c.dtype}" for c in COLUMNS if with_target or c.group != "target"
    ]
    return T.StructType.fromDDL(", ".join(fields))
