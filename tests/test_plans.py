"""The shapes of the physical plans that matter at scale."""

import pytest
from places import TESTDATA
from pyspark.sql import functions as F

from rollbook import fixtures
from rollbook.operators import clean, duplicates, groups, identity, matching, profiles, quality
from rollbook.plans import build
from rollbook.queries import REGISTRY
from rollbook.staging import Stage

FOLDER = str(TESTDATA / "sf0.001")

pytestmark = pytest.mark.skipif(not TESTDATA.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def combined(spark):
    return Stage(spark).table("combined", fixtures.combined(spark, FOLDER))


@pytest.fixture(scope="module")
def golden(spark, combined):
    return Stage(spark).table("golden", identity.golden_records(combined))


def plan(df):
    """The plan before adaptive execution, without broadcast joins chosen by size."""
    spark = df.sparkSession
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_golden_takes_one_shuffle_and_no_join(combined):
    text = plan(identity.golden_records(combined))
    assert text.count("Exchange") == 1
    assert "Join" not in text and "partial_min" in text


def test_cleaning_takes_no_shuffle(spark):
    raw = fixtures.raw_sources(spark, FOLDER, "payroll", "benefits")
    text = plan(clean.clean(clean.combine_sources(build.align.align_sources(raw))))
    assert "Exchange" not in text


def test_no_query_leaves_the_jvm_or_crosses_tables(combined, golden):
    frames = {
        **build.review_tables(combined, golden, fixtures.SETTINGS),
        **build.profile_tables(
            golden, quality.Validator(settings=fixtures.SETTINGS).run(golden), fixtures.SETTINGS
        ),
        "golden": identity.golden_records(combined),
        "combined": combined,
    }
    for name, df in frames.items():
        text = plan(df)
        for word in ("Python", "Pandas", "CartesianProduct", "NestedLoop"):
            assert word not in text, (name, word)


def test_scans_read_only_what_a_profile_needs(golden):
    text = plan(profiles.headcount_by_country(golden))
    assert "ReadSchema: struct<country:string>" in text
    assert "TakeOrderedAndProject" in text


def test_no_row_is_shuffled_where_no_group_is_kept(golden):
    text = plan(duplicates.duplicate_ids(golden))
    assert "Exchange hashpartitioning" not in text


def test_rows_of_other_groups_stay_out_of_the_shuffle(spark, combined, monkeypatch):
    """The filter lets the rows of kept groups pass, and hardly any others."""
    monkeypatch.setattr(groups, "HEAVY_GROUPS", 0)
    ids = combined.groupBy("employee_id").agg(F.count("*").alias("n"))
    kept = ids.filter("n = 3").select("employee_id", "n")
    let_through = groups._filtered(combined, kept, "employee_id")
    wanted = combined.join(kept, combined["employee_id"].eqNullSafe(kept["employee_id"]), "left_semi").count()
    assert wanted <= let_through.count() <= wanted * 1.1 + 3
    assert let_through.columns == combined.columns
    text = plan(identity.ghost_records(combined, heavy_groups=0))
    assert "bitmap_construct_agg" in text


def test_keys_without_a_grid_are_joined_plainly(golden):
    text = plan(matching.same_name_matches(golden))
    assert "_row" not in text and "Generate explode(sequence" not in text


def test_name_and_date_bucket_are_the_join_key(golden):
    text = plan(matching.same_name_matches(golden))
    assert "SortMergeJoin [_name" in text


def test_pairs_of_records_are_not_shuffled(combined, golden):
    matches = build.review_tables(combined, golden)["probable_match_review.csv"]
    assert "Window" not in plan(matches)
    assert "Window" not in plan(REGISTRY["q_match_export"](combined.sparkSession, FOLDER))


def test_feeds_keep_every_customer_supplier_and_order(spark):
    raw = fixtures.raw_sources(spark, FOLDER, "globaltech_hris", "payroll")
    ids = {r[0].removesuffix(".0") for r in raw["globaltech_hris"].select("employee_id").collect()}
    customers = fixtures.table(spark, FOLDER, "customer").select("c_custkey").collect()
    assert {str(r[0]) for r in customers} <= ids
    paid = {r[0] for r in raw["payroll"].filter("source = 'AcquiredCo'").select("employee_id").collect()}
    suppliers = fixtures.table(spark, FOLDER, "supplier").select("s_suppkey").collect()
    assert {f"ACQ_{r[0]:05d}" for r in suppliers} <= paid


def test_ghosts_are_added_rows_of_both_enrichment_feeds(combined):
    found = identity.ghost_records(combined).select("source_system", "employee_id").collect()
    assert {r[0] for r in found} == {"payroll", "benefits"}
    assert all(r[1].split("-")[1].startswith("9000000") for r in found)
