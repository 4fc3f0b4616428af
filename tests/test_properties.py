"""Properties that must hold for any input, on many generated rows at a time."""

import re
import tempfile
from collections import Counter
from datetime import date
from types import SimpleNamespace

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline import workspace
from ledgerline.functions import dates, text
from ledgerline.sinks import export

few = settings(
    max_examples=5,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow, HealthCheck.data_too_large],
)


@few
@given(st.lists(st.binary(max_size=60), min_size=50, max_size=50))
def test_clean_equals_the_pattern_on_decoded_bytes(spark, raws):
    df = spark.createDataFrame(list(enumerate(raws)), "i int, raw binary")
    got = dict(df.select("i", text.clean(F.col("raw"))).collect())
    expected = {i: re.sub(text.DROPPED_CHARACTERS, "", raw.decode("latin-1")) for i, raw in enumerate(raws)}
    assert got == expected


def python_date(value):
    if value is None or not re.fullmatch("[0-9]{8}", value):
        return None
    try:
        return date(int(value[:4]), int(value[4:6]), int(value[6:]))
    except ValueError:
        return None


@few
@given(st.lists(st.none() | st.text("0123456789", max_size=9) | st.dates().map(lambda d: d.strftime("%Y%m%d")),
                min_size=60, max_size=60))
def test_dates_parse_like_the_calendar(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    rows = df.select("i", dates.parse_date(F.col("v")).cast("string").alias("d")).collect()
    for row in rows:
        expected = python_date(values[row["i"]])
        # Year zero is a year for Spark and none for Python.
        if not (values[row["i"]] or "").startswith("0000"):
            assert row["d"] == (expected and expected.isoformat())


# Line breaks of all kinds are data in quotes.
cell = st.none() | st.sampled_from(["a\nb", "a\r\nb", "\n", "\r\n", '"\n"', "\r"]) | st.text(st.characters(exclude_characters="\x00\x01", exclude_categories=["Cs"]), max_size=12)


@few
@given(st.lists(st.tuples(cell, cell, cell), min_size=40, max_size=40))
def test_export_round_trip(spark, rows):
    df = spark.createDataFrame([("k", *r) for r in rows], "k string, a string, b string, c string")
    with tempfile.TemporaryDirectory() as folder:
        path = export.export_csv(df, f"{folder}/e")
        back = export.read_as_one(spark, path, ["k", "a", "b", "c"]).where("k = 'k' and not (a <=> 'a' and b <=> 'b')")
        kept = df.where("not (a <=> 'a' and b <=> 'b')")
        assert Counter(map(tuple, back.collect())) == Counter(map(tuple, kept.collect()))


def session(conf, checkpoint, master, application="app"):
    made = []
    context = SimpleNamespace(
        master=master, getCheckpointDir=lambda: checkpoint, setCheckpointDir=made.append, applicationId=application
    )
    return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: conf), sparkContext=context), made


def test_files_go_where_the_cluster_says():
    spark, made = session("hdfs://nn/shared/", None, "yarn")
    assert workspace.shared_root(spark) == "hdfs://nn/shared" and not made
    spark, made = session(None, "hdfs://nn/cp", "yarn")
    assert workspace.shared_root(spark) == "hdfs://nn/cp" and not made


def test_only_a_local_session_gets_a_temporary_folder():
    spark, made = session(None, None, "local[2]")
    assert workspace.shared_root(spark) == workspace.shared_root(spark) and not made
    other, _ = session(None, None, "local[2]", "another")
    assert workspace.shared_root(other) != workspace.shared_root(spark)
    spark, made = session(None, None, "spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace.shared_root(spark)
    assert not made
