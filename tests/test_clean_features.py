import pytest
from pyspark.sql import functions as F

from cohortlift import schema as S
from cohortlift.operators import clean as C
from cohortlift.operators import features as Fe

ROW = {c.name: None for c in S.COLUMNS}


def cycle_rows(spark, *changes):
    schema = S.spark_schema()
    rows = [tuple({**ROW, "id": i, "success": 0, **change}[f] for f in schema.fieldNames()) for i, change in enumerate(changes)]
    return spark.createDataFrame(rows, schema)


def column(df, name):
    return [r[0] for r in df.orderBy("id").select(name).collect()]


def test_structural_zero_only_for_di(spark):
    df = cycle_rows(
        spark,
        {"treatment_type": "DI"},
        {"treatment_type": "DI", "embryos_total": 3.0, "icsi_stored": 2.0},
        {"treatment_type": "IVF"},
        {},
    )
    out = C.clean(df, "clean", {})
    assert column(out, "embryos_total") == [0.0, 3.0, None, None]
    assert column(out, "icsi_stored") == [0.0, 2.0, None, None]
    assert column(C.clean(df, "clean", {}, legacy=True), "icsi_stored") == [None, 2.0, None, None]
    assert column(out, "is_DI") == [1, 1, 0, 0]


def test_sentinels(spark):
    df = cycle_rows(
        spark,
        {"embryos_transferred": 0.0, "day_transfer": 5.0},
        {"embryos_transferred": None, "day_transfer": 5.0},
        {"embryos_transferred": 1.0, "day_transfer": 5.0},
        {"embryos_transferred": 1.0},
    )
    out = C.clean(df, "clean", {})
    assert column(out, "day_transfer") == [-1.0, -1.0, 5.0, None]
    assert column(out, "no_transfer") == [1, 1, 0, 0]
    assert column(out, "missing_day_transfer_raw") == [0, 0, 0, 1]
    assert column(C.clean(df, "clean", {}, only_null=True), "day_transfer") == [5.0, 5.0, 5.0, None]
    assert column(C.clean(df, "clean", {"day_transfer": 3.0}), "day_transfer") == [-1.0, -1.0, 5.0, 3.0]


@pytest.mark.parametrize("count,day", list(S.SENTINEL_DAYS.items())[1:])
def test_paired_sentinels(spark, count, day):
    df = cycle_rows(spark, {count: 0.0, day: 2.0}, {day: 2.0}, {count: 2.0, day: 2.0})
    assert column(C.clean(df, "clean", {}), day) == [-1.0, -1.0, 2.0]


def test_years_rule_is_optional(spark):
    df = cycle_rows(spark, {"n_pregnancies": "0회"}, {"n_pregnancies": "1회"}, {"n_pregnancies": "0회", "years_trying": 4.0})
    assert column(C.clean(df, "clean", {}), "years_trying") == [None, None, 4.0]
    assert column(C.clean(df, "clean", {}, years_rule=True), "years_trying") == [-1.0, None, 4.0]


def test_gene_tests_and_nan(spark):
    df = cycle_rows(spark, {"pgd": 1.0, "pgs": float("nan"), "single_transfer": float("nan")}, {"pgd": 1.0, "pgs": 1.0, "pgt_used": 1.0})
    out = C.clean(df, "clean", {})
    assert column(out, "pgs") == [0, 1]
    assert column(out, "miss_gene_test") == [1, 0]
    assert column(out, "single_transfer") == [None, None]
    assert column(C.clean(df, "clean", {}, legacy=True), "miss_gene_test") == [0, 0]


def test_clean_needs_medians(spark):
    with pytest.raises(ValueError):
        C.clean(cycle_rows(spark, {}), "clean")
    with pytest.raises(ValueError):
        C.clean(cycle_rows(spark, {}), "other", {})


def test_missing_columns_skip_and_are_reported(spark):
    df = cycle_rows(spark, {"n_cycles": "2회"}).drop("age_band", "embryo_reason", "n_births")
    assert C.skipped(df)["age_ord"] == ["age_band"]
    out = C.clean(df, "clean", {})
    assert "age_ord" not in out.columns and "reason_current" not in out.columns
    left_out = Fe.skipped(out, "clean")
    assert left_out["ever_delivered"] == ["n_births"]
    assert "age_normalized_pipeline" in left_out
    derived = Fe.derive(out, "full", "clean")
    assert "ever_delivered" not in derived.columns and "is_FET" in derived.columns


def test_bin_and_prior_edges(spark):
    df = cycle_rows(
        spark,
        {"embryos_total": 6.0, "age_band": "만45-50세", "egg_source": "본인 제공"},
        {"embryos_total": 6.5, "age_band": "알 수 없음", "egg_source": "본인 제공"},
        {"embryos_total": 1001.0, "age_band": None, "egg_source": "기증 제공"},
        {},
    )
    raw = Fe.derive(C.clean(df, "raw"), "full", "raw")
    assert column(raw, "embryo_group") == ["Poor", "Normal", None, None]
    assert column(raw, "age_success_prior") == [0.02, 0.17, 0.38, 0.17]
    clean = Fe.derive(C.clean(df, "clean", {}), "full")
    assert column(clean, "embryo_group") == ["Poor", "Normal", "Hyper", "Poor"]
    assert column(clean, "age_success_prior") == [0.1677, 0.0, 0.3154, None]


def test_donated_egg_of_unknown_age_stays_null(spark):
    df = cycle_rows(
        spark,
        {"age_band": "만43-44세", "egg_source": "기증 제공", "egg_donor_age": "만26-30세"},
        {"age_band": "만43-44세", "egg_source": "기증 제공"},
        {"age_band": "만43-44세"},
    )
    raw = Fe.derive(C.clean(df, "raw"), "full", "raw")
    assert column(raw, "real_age_num") == [28.0, None, 43.5]
    assert column(raw, "donor_age_advantage") == [15.5, 15.5, 0.0]
    clean = Fe.derive(C.clean(df, "clean", {}), "v3")
    assert column(clean, "real_age_num") == [28.0, None, 43.5]


def test_first_attempt_differs_on_missing_counts(spark):
    df = cycle_rows(spark, {"n_cycles": "0회"}, {}, {"n_cycles": "1회"})
    assert column(Fe.derive(C.clean(df, "raw"), "full", "raw"), "is_first_attempt") == [1, 0, 0]
    assert column(Fe.derive(C.clean(df, "clean", {}), "full"), "is_first_attempt") == [1, 1, 0]


def test_levels_nest(spark):
    for profile, levels in Fe.LEVELS.items():
        sizes = [len(Fe.catalogue(profile, level)) for level in levels]
        assert sizes == sorted(sizes)
    with pytest.raises(ValueError):
        Fe.catalogue("clean", "base")


def test_legacy_counts_what_is_left(spark):
    df = cycle_rows(spark, {"embryos_transferred": 1.0})
    cleaned = C.clean(df, "clean", {})
    now, before = Fe.derive(cleaned, "v3"), Fe.derive(cleaned, "v3", legacy=True)
    assert column(now, "missing_day_mix") == [1] and column(before, "missing_day_mix") == [0]
    assert "missing_day_pickup" in now.columns and "missing_day_pickup" not in before.columns
    assert column(now, "n_missing_row") != column(before, "n_missing_row")


def test_result_does_not_depend_on_partitions(spark, small):
    from cohortlift.sources.cycles import read_cycles

    df = read_cycles(spark, small)
    one, many = (
        Fe.derive(C.clean(df.repartition(n), "clean", {})).select(F.sum(F.xxhash64("id", "ratio_embryo_yield", "suitability") % 1000)).first()[0]
        for n in (1, 64)
    )
    assert one == many
