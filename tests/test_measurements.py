"""Quantiles, ranks, replicate statistics, calibration, features - ordinary and hot groups."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from measurekit.operators import calibrate, features, quantiles, ranks, replicates
from measurekit.operators.calibrate import Relationship
from measurekit.sources import records
from tests.fixtures import CALIBRATION, MEASUREMENTS, READY, REPLICATES
from tests.helpers import assert_rows


@pytest.fixture
def measurements(spark, write):
    return records.read_measurements(spark, write(MEASUREMENTS))


def test_replicate_summary_matches(measurements):
    assert_rows(replicates.replicates(measurements).collect(), REPLICATES, ("domain", "condition"))


def test_replicate_summary_matches_when_every_group_is_hot(measurements):
    assert_rows(replicates.replicates(measurements, hot_rows=1).collect(), REPLICATES, ("domain", "condition"))


def test_replicate_edges(spark):
    rows = spark.createDataFrame(
        [("one", 3.0), ("zero", -1.0), ("zero", 1.0), ("wide", 1.0), ("wide", 3.0), (None, 2.0), (None, 2.0), ("none", None)], "k string, signal double"
    )
    out = {r["k"]: r for r in replicates.replicates(rows, ["k"]).collect()}
    assert out["one"]["stability_flag"] == "unknown" and out["one"]["standard_error_signal"] is None and out["one"]["confidence_interval_lower"] is None
    assert out["zero"]["coefficient_of_variation"] is None and out["zero"]["stability_flag"] == "unknown"
    assert out["wide"]["stability_flag"] == "unstable"
    assert out[None]["stability_flag"] == "stable" and out[None]["coefficient_of_variation"] == 0.0
    assert out["none"]["replicate_count"] == 0 and out["none"]["mean_signal"] is None


def test_highlights(measurements):
    found = {r["question"]: r for r in replicates.highlights(replicates.replicates(measurements)).collect()}
    assert (found["most stable"]["condition"], found["most stable"]["value"]) == ("low_load", 0.005112)
    assert (found["noisiest"]["domain"], found["noisiest"]["value"]) == ("Mechanical", 0.100512)
    flags = {r["stability_flag"]: r["groups"] for r in replicates.flag_counts(replicates.replicates(measurements)).collect()}
    assert flags == {"stable": 7, "moderate": 2}


def test_calibration_matches(measurements):
    assert_rows(calibrate.calibrate(measurements).collect(), CALIBRATION, ("domain", "relationship"))


def test_correlation_edges(spark):
    rows = spark.createDataFrame([(1.0, 1.0, 5.0), (1.0, 2.0, None), (1.0, 3.0, 7.0)], "c double, x double, y double")
    spec = [Relationship("constant", "c", "x"), Relationship("two pairs", "x", "y"), Relationship("nobody", "x", "y", "z", "c")]
    rows = rows.withColumn("c", F.col("c"))
    spec[2] = Relationship("nobody", "x", "y", "z", "g")
    out = {r["relationship"]: r for r in calibrate.correlations(rows.withColumn("g", F.lit("a")), spec).collect()}
    assert out["constant"]["pearson_r"] is None and out["constant"]["spearman_r"] is None
    assert out["two pairs"]["n_samples"] == 2 and out["two pairs"]["pearson_r"] is None
    assert out["nobody"]["n_samples"] == 0
    fits = {r["relationship"]: r for r in calibrate.calibrate(rows.withColumn("g", F.lit("a")), spec).collect()}
    assert fits["two pairs"]["slope"] == 1.0 and fits["two pairs"]["r_squared"] == 1.0 and fits["constant"]["slope"] is None


@pytest.mark.parametrize("hot_rows", [1_000_000, 1])
def test_ready_table_matches(measurements, hot_rows):
    table = features.ml_ready(features.engineer(measurements, hot_rows=hot_rows))
    assert_rows(table.collect(), READY, ("record_id",))


def test_readiness_is_null_safe_and_never_null(spark):
    rows = spark.createDataFrame([(1, None, 1.0, 2.0), (2, "a", 1.0, 0.0), (3, "a", 1.0, None), (4, "a", None, 2.0), (5, "a", 1.0, 2.0)], "id int, k string, signal double, expected_signal double")
    flags = spark.createDataFrame([(None, "stable"), ("a", "moderate")], "k string, stability_flag string")
    out = {r["id"]: (r["stability_flag"], r["ml_ready"]) for r in features.readiness(rows, flags, ["k"], ("signal", "expected_signal", "k")).collect()}
    assert out == {1: ("stable", False), 2: ("moderate", False), 3: ("moderate", False), 4: ("moderate", False), 5: ("moderate", True)}


@pytest.mark.parametrize("hot_rows,part_rows", [(1_000_000, 50_000), (5, 7)])
def test_rolling_mean_matches_pandas(spark, hot_rows, part_rows):
    rng = np.random.default_rng(3)
    n = 400
    frame = pd.DataFrame(
        {
            "_rid": range(n), "domain": rng.choice(["hot"] * 8 + ["a", None], n), "condition": rng.choice(["c", "d"], n, p=[0.9, 0.1]),
            "time_step": rng.integers(0, 150, n), "signal": np.where(rng.random(n) < 0.15, np.nan, rng.random(n).round(3)),
        }
    )
    rows = spark.createDataFrame(frame).withColumn("signal", F.nanvl("signal", F.lit(None).cast("double")))
    out = features.rolling_mean(rows, hot_rows=hot_rows, part_rows=part_rows).toPandas().set_index("_rid")["rolling_average_signal"]
    ordered = frame.sort_values(["time_step", "_rid"])
    expected = ordered.groupby(["domain", "condition"])["signal"].transform(lambda s: s.rolling(3, min_periods=1).mean())
    expected = expected.where(ordered["domain"].notna()).reindex(out.index).sort_index()
    np.testing.assert_allclose(out.sort_index().to_numpy(dtype=float), expected.to_numpy(), atol=1e-6)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.one_of(st.none(), st.integers(-50, 50))), min_size=1, max_size=60))
def test_bracketed_quantiles_match_numpy(spark, data):
    rows = spark.createDataFrame([(k, None if v is None else v / 4) for k, v in data], "k int, v double")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    out = {r["k"]: r["quantiles"] for r in quantiles.exact_quantiles(rows, ["k"], "v", probs, hot_rows=0).collect()}
    frame = pd.DataFrame(data, columns=["k", "v"]).dropna()
    assert set(out) == set(frame["k"])
    for k, values in frame.groupby("k")["v"]:
        np.testing.assert_allclose(out[k], np.quantile(values.to_numpy(dtype=float) / 4, probs))


def test_quantiles_of_a_large_group(spark):
    rows = spark.range(200_000).select(F.lit("g").alias("k"), ((F.col("id") * 7919) % 100_003 / 7).alias("v"))
    values = np.array([(i * 7919) % 100_003 / 7 for i in range(200_000)])
    probs = [0.1, 0.5, 0.999]
    for hot_rows in (10_000, 10_000_000):
        row = quantiles.exact_quantiles(rows, ["k"], "v", probs, hot_rows).first()
        np.testing.assert_allclose(row["quantiles"], np.quantile(values, probs))


@pytest.mark.parametrize("part_rows", [50_000, 3])
def test_average_ranks_match_pandas(spark, part_rows):
    rng = np.random.default_rng(5)
    frame = pd.DataFrame({"k": rng.integers(0, 3, 500), "v": np.where(rng.random(500) < 0.4, 7.0, rng.integers(0, 120, 500))})
    frame["rank"] = frame.groupby("k")["v"].rank()
    expected = {(k, v): r for k, v, r in frame.drop_duplicates().itertuples(index=False)}
    out = ranks.average_ranks(spark.createDataFrame(frame[["k", "v"]]), ["k"], "v", part_rows=part_rows).collect()
    assert {(r["k"], r["v"]): r["rank"] for r in out} == expected


def test_codes_follow_byte_order(spark):
    rows = spark.createDataFrame([("b", "1"), ("C", "2"), ("a", None), ("b", "2")], "x string, y string")
    out = {(r["column"], r["value"]): r["code"] for r in ranks.sorted_codes(rows, ["x", "y"], part_rows=1).collect()}
    assert out == {("x", "C"): 0, ("x", "a"): 1, ("x", "b"): 2, ("y", "1"): 0, ("y", "2"): 1}


@pytest.mark.parametrize("grades,list_rows", [(4, 3), (16, 50), (256, 100_000)])
def test_quantiles_by_many_rounds(spark, grades, list_rows):
    """Coarse grades and short lists force round after round; heavy values end them early."""
    rng = np.random.default_rng(grades)
    groups = {
        "even": rng.normal(size=3_000) * 1e6, "heavy": np.concatenate([np.zeros(1_200), np.ones(1_300), rng.random(500)]), "wide": 10.0 ** rng.uniform(-300, 300, 1_000) * rng.choice([-1, 1], 1_000),
        "one": np.array([7.0]), "two": np.array([1.0, 2.0]), "same": np.full(900, 3.0), None: rng.integers(0, 5, 800).astype(float),
    }
    rows = spark.createDataFrame([(k, float(v)) for k, values in groups.items() for v in values], "k string, v double").repartition(5)
    probs = (0.0, 0.25, 0.5, 0.7, 1.0)
    found = {r["k"]: r["quantiles"] for r in quantiles.bracketed_quantiles(rows, ["k"], "v", probs, grades=grades, accuracy=500, list_rows=list_rows).collect()}
    assert set(found) == set(groups)
    for k, values in groups.items():
        np.testing.assert_allclose(found[k], np.quantile(values, probs), rtol=1e-12, atol=1e-12)
    assert quantiles.bracketed_quantiles(rows.limit(0), ["k"], "v", probs).collect() == []


def test_ranks_in_two_thousand_parts(spark):
    rows = spark.range(4_000).select(F.lit("k").alias("k"), ((F.col("id") * 7919) % 2_003).cast("double").alias("v")).unionByName(spark.createDataFrame([("j", 1.0), ("j", 5.0)], "k string, v double"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    histogram = rows.groupBy("k", "v").agg(F.count(F.lit(1)).alias("w"))
    found = ranks.counts_before(histogram, ["k"], "v", "w", part_rows=1, block_parts=32)
    spark.conf.set("spark.sql.shuffle.partitions", old)
    values = [(i * 7919) % 2_003 for i in range(4_000)]
    below = np.searchsorted(np.sort(values), np.arange(2_003))
    got = {(r["k"], r["v"]): r["before"] for r in found.collect()}
    assert got == {("j", 1.0): 0, ("j", 5.0): 1, **{("k", float(v)): int(below[v]) for v in set(values)}}


def test_a_hot_series_in_many_time_parts(spark):
    """More parts than any fixed ceiling, parts of a few rows, one other series."""
    rows = spark.range(1_500).select(F.lit("d").alias("domain"), F.lit("c").alias("condition"), ((F.col("id") * 37) % 1_500).alias("time_step"), F.col("id").alias("_rid"), (F.col("id") * 3 % 11).cast("double").alias("signal"))
    rows = rows.unionByName(rows.where("_rid < 5").withColumn("domain", F.lit("e")))
    out = features.rolling_mean(rows, window=5, hot_rows=100, part_rows=2).toPandas()
    for _, series in out.groupby("domain"):
        series = series.sort_values(["time_step", "_rid"])
        np.testing.assert_allclose(series["rolling_average_signal"], series["signal"].rolling(5, min_periods=1).mean().round(6), atol=1e-6)
    assert len(out) == 1_505
