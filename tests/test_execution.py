"""How the plans run: what is broadcast, shuffled, pruned, and where Python is."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import joins, keys
from ledgerline.plans import gates, load
from ledgerline.schemas import COMPANIES, DATASETS, ESTABLISHMENTS, LOOKUP
from ledgerline.trial.driver_tables import Register
from ledgerline.trial.queries import QUERIES, _wide

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).is_dir(), reason="needs the given tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_auto_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def test_establishments_are_shuffled_once_for_both_company_joins(spark, no_auto_broadcast):
    text = plan(_wide(Register(spark, DATA)))
    assert text.count("SortMergeJoin") == 2
    # Establishments, companies, partners.
    assert len(re.findall(r"(?<!Broadcast)Exchange hashpartitioning", text)) == 3
    assert text.count("BroadcastHashJoin") == 6
    assert "Sort [cnpj" in text and "rangepartitioning" not in text
    assert "Python" not in text and "MapInArrow" not in text


def test_a_code_table_beyond_the_bound_is_not_broadcast(spark, no_auto_broadcast):
    reg = Register(spark, DATA)
    rows = reg.establishments.select("cnpj_basico", "cnae_fiscal_principal")
    role = ("cnae_fiscal_principal", reg.activities, "cnae")
    assert "BroadcastHashJoin" in plan(joins.lookup(rows, role))
    assert "Broadcast" not in plan(joins.lookup(rows, role, max_bytes=1000))


def test_a_table_used_twice_is_broadcast_once(spark):
    df = QUERIES["role_playing_lookup"](spark, DATA)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert final.count("BroadcastHashJoin") == 2 and "ReusedExchange" in final


def test_one_per_key_sorts_by_the_key_alone(spark):
    df = keys.one_per_key(Register(spark, DATA).establishments, "cnpj_basico")
    text = plan(df)
    assert "Window" not in text and len(re.findall("Exchange", text)) == 1
    for order in re.findall(r"Sort \[([^\]]*)\]", text):
        assert order.count("cnpj_basico") == 1 and order.count("ASC") == 1


def test_building_the_wide_table_takes_few_jobs(spark):
    context = spark.sparkContext
    reg = Register(spark, DATA)
    # Reading a file's schema is a job of its own and no part of the build.
    for name in DATASETS:
        getattr(reg, name)
    context.setJobGroup("build", "build")
    try:
        _wide(reg)
    finally:
        context.setJobGroup("other", "other")
    assert len(context.statusTracker().getJobIdsForGroup("build")) <= 6


def test_a_sample_is_drawn_before_wide_rows_are_built(spark):
    text = plan(QUERIES["sample_registry"](spark, DATA))
    assert "o_orderkey" not in text


def test_scans_read_only_the_columns_they_need(spark):
    reg = Register(spark, DATA)
    assert "ReadSchema: struct<o_custkey:bigint>" in plan(reg.establishments.groupBy("cnpj_basico").count())
    text = plan(_wide(reg))
    assert "props" not in text and "o_totalprice" not in text


def test_filters_reach_the_served_files(spark, tmp_path):
    path = str(tmp_path / "served")
    Register(spark, DATA).establishments.sortWithinPartitions("cnae_fiscal_principal").write.parquet(path)
    df = spark.read.parquet(path).where(F.col("cnae_fiscal_principal") == "0000007")
    assert "PushedFilters: [IsNotNull(cnae_fiscal_principal), EqualTo(cnae_fiscal_principal,0000007)]" in plan(df)


def test_sampling_sorts_no_whole_table(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["seeded_sample"](spark, DATA))


def test_adapters_give_the_registers_columns(spark):
    reg = Register(spark, DATA)
    assert reg.establishments.columns == list(ESTABLISHMENTS) and reg.companies.columns == list(COMPANIES)
    assert reg.activities.columns == list(LOOKUP)
    assert reg.establishments.selectExpr("count(distinct cnpj_basico, cnpj_ordem, cnpj_dv)").first()[0] == (
        reg.establishments.count()
    )


def test_wide_has_one_row_per_establishment_when_codes_are_unique(spark):
    reg = Register(spark, DATA)
    wide = _wide(reg)
    assert wide.count() == reg.establishments.count()
    typed = load.typed(wide)
    assert gates.require(gates.distinct_key_gate(typed, wide, "cnpj"))[0] == wide.count()
