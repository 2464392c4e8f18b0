"""Golden counts of the test tables, and what the plans must and must not hold."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from matchlive.plans import catalog, gold, views
from matchlive.schemas import SILVER
from matchlive.sources.testdata import event_documents, event_log

GOLDEN = {
    "sf0.001": {
        "bronze": 1_143, "silver": 950, "seconds": 3_148_037, "xg": 19.644, "shots": 194, "goals": 27,
        "timeline": 190, "state": 21, "momentum": 15, "actions": 24,
    },
    "sf0.01": {
        "bronze": 11_429, "silver": 9_501, "seconds": 31_977_869, "xg": 172.04, "shots": 1_881,
        "goals": 216, "timeline": 1_812, "state": 210, "momentum": 150, "actions": 240,
    },
    "sf0.1": {
        "bronze": 114_286, "silver": 95_010, "seconds": 320_034_036, "xg": 1_814.67, "shots": 19_109,
        "goals": 2_392, "timeline": 18_495, "state": 2_100, "momentum": 1_518, "actions": 2_391,
    },
}

# These write and read tables while the query is being built.
EAGER = {"publish_log_rows", "backfill_match_files", "backfill_by_ranges", "backfill_silver", "tolerant_scan"}


@pytest.mark.parametrize("sf", GOLDEN)
def test_golden_counts(spark, sf):
    sf_dir = f"/root/testdata/{sf}"
    silver = catalog.silver(spark, sf_dir).persist()
    sums = silver.agg(F.count("*"), F.sum("match_second"), F.round(F.sum("xg"), 3)).first()
    momentum = gold.momentum(silver).agg(F.count("*"), F.sum("attacking_actions")).first()
    state = gold.match_state(silver).agg(F.count("*"), F.sum("goals")).first()
    got = {
        "bronze": catalog.bronze(spark, sf_dir).count(),
        "silver": sums[0], "seconds": sums[1], "xg": sums[2],
        "shots": gold.shots(silver).count(), "goals": state[1],
        "timeline": gold.xg_timeline(silver).count(), "state": state[0],
        "momentum": momentum[0], "actions": momentum[1],
    }
    silver.unpersist()
    assert got == GOLDEN[sf]


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["match_id", "team_name", "minute", "xg_total", "xg_cumulative"]
    assert frame.count() == 186


def physical(frame):
    text = frame._jdf.queryExecution().toString()
    return text[text.index("== Physical Plan ==") :]


@pytest.mark.parametrize("name", sorted(set(catalog.BATCH) - EAGER))
def test_batch_plans_stay_in_the_jvm_and_join_on_keys(spark, name):
    plan = physical(catalog.BATCH[name](spark, "/root/testdata/sf0.001"))
    for operator in ("CartesianProduct", "NestedLoop", "Python", "Arrow", "SinglePartition, ENSURE"):
        if name in ("table_summary", "match_catalogue") and operator.startswith("Single"):
            continue  # one row per task: the last step of a global count, or of the newest time of all
        assert operator not in plan


@pytest.fixture(scope="module")
def silver_table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("silver") / "table")
    catalog.silver(spark, "/root/testdata/sf0.001").write.parquet(path)
    return spark.read.schema(SILVER).parquet(path)


def test_gold_reads_only_its_columns_and_pushes_filters(silver_table):
    plan = physical(gold.shots(silver_table))
    assert "EqualTo(event_type,Shot)" in plan and "Exchange" not in plan
    plan = physical(gold.xg_timeline(silver_table))
    assert "GreaterThan(xg,0.0)" in plan
    assert "ReadSchema: struct<match_id:bigint,minute:int,team_name:string,xg:double>" in plan
    assert "ReadSchema: struct<match_id:bigint,match_second:int,event_type:string,team_name:string>" in physical(
        gold.momentum(silver_table)
    )


def test_first_aggregation_is_partial(silver_table):
    for frame in (gold.xg_timeline(silver_table), gold.match_state(silver_table), gold.momentum(silver_table)):
        plan = physical(frame)
        assert plan.rindex("partial_") > plan.rindex("Exchange hashpartitioning")


def test_ranks_are_limited_before_the_shuffle(silver_table):
    plan = physical(views.event_log(silver_table))
    assert plan.index("Exchange hashpartitioning") < plan.index("row_number(), 20, Partial")


def test_only_the_wanted_fields_are_parsed(spark):
    sf_dir = "/root/testdata/sf0.001"
    for name, absent in (("match_clock", "location"), ("xg_timeline", "player"), ("momentum", "shot")):
        plan = catalog.BATCH[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        schema = plan[plan.index("from_json(StructField") :].split("event_json")[0]
        assert f"StructField({absent}," not in schema and "StructField(id," in schema


def test_merges_keep_rows_outside_the_usual_periods(spark, monkeypatch):
    """Period 0 and below belong to the second half of the merge and to the end of the first period."""
    kept = catalog.silver

    def moved(spark, sf_dir, wanted=None):
        rows = kept(spark, sf_dir, wanted and wanted + " period")
        return rows.withColumn("period", F.when(F.col("period") == 2, F.lit(0)).otherwise(F.col("period")))

    sf_dir = "/root/testdata/sf0.001"
    want = sorted(map(tuple, catalog.xg_timeline(spark, sf_dir).collect()), key=str)
    monkeypatch.setattr(catalog, "silver", moved)
    assert sorted(map(tuple, catalog.merge_additive_halves(spark, sf_dir).collect()), key=str) == want
    teams = {tuple(r) for r in kept(spark, sf_dir).select("match_id", "team_name").distinct().collect()}
    found = {(r.match_id, r.team_name) for r in catalog.upsert_latest_by_key(spark, sf_dir).collect()}
    assert found <= teams and len(found) >= len(catalog.momentum(spark, sf_dir).collect())


def test_names_agree():
    assert set(contract.ORACLES) == {*catalog.BATCH, *contract.STREAMS}
