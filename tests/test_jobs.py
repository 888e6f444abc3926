"""End-to-end jobs on small files and the row-wise rules on a stream."""

from __future__ import annotations

import json

import numpy as np
import pytest

from measurekit.plans import jobs
from measurekit.plans.students import student_plan
from measurekit.sources import records
from measurekit.sources.records import STUDENT_COLUMNS, text_schema
from measurekit.streaming import rowwise
from tests.fixtures import CALIBRATION, MEASUREMENTS, READY, REPLICATES, STUDENTS, STUDENTS_CLEANED, SUBMISSIONS
from tests.helpers import assert_rows


def test_submissions_job(spark, write, tmp_path):
    jobs.submissions(spark, write(SUBMISSIONS), str(tmp_path / "out"))
    document = json.loads(spark.read.text(str(tmp_path / "out/summary")).first()["value"])
    assert document["average_score"] == 4.86
    listed = spark.read.option("header", True).csv(str(tmp_path / "out/missing_submissions")).collect()
    assert sorted(r["name"] for r in listed) == ["Dev", "Kabir"]


def test_readers_agree_on_clean_input_and_differ_on_bad_scores(spark, write):
    assert jobs.compare_readers(spark, write(SUBMISSIONS)).collect() == []
    found = {r["key"] for r in jobs.compare_readers(spark, write(SUBMISSIONS + "Bad,ML,Task2,abc,yes\n", "bad.csv")).collect()}
    assert found == {"total_students", "submitted_count", "average_score", "domain_wise_average.ML", "students_below_5.Bad"}


def test_cleaning_and_chart_jobs(spark, write, tmp_path):
    out = str(tmp_path / "out")
    jobs.clean_students(spark, write(STUDENTS), out)
    back = records.read_cleaned(spark, f"{out}/cleaned")
    assert_rows(back.collect(), STUDENTS_CLEANED, ("student_id",))
    jobs.student_charts(spark, f"{out}/cleaned", str(tmp_path / "charts"))
    bars = spark.read.option("header", True).csv(str(tmp_path / "charts/mean_score_by_domain")).collect()
    assert {(r["group"], r["mean"]) for r in bars} == {("Electronics", "8.0"), ("ML", "6.25"), ("Web", "5.67"), ("Mechanical", "0.0")}


def test_calibration_job(spark, write, tmp_path):
    jobs.calibration(spark, write(MEASUREMENTS), str(tmp_path))
    read = lambda name: spark.read.option("header", True).option("inferSchema", True).csv(str(tmp_path / name)).collect()
    assert_rows(read("replicate_summary"), REPLICATES, ("domain", "condition"))
    assert_rows(read("calibration_summary"), CALIBRATION, ("domain", "relationship"))
    assert len(read("ml_ready_dataset")) == len(READY.strip().splitlines()) - 1


def test_air_quality_job(spark, write, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "LOGISTIC_STEPS", 8)
    rng = np.random.default_rng(8)
    lines = [";".join(jobs.AIR_COLUMNS) + ";;"]
    for i in range(160):
        level = rng.random()
        values = {c: (level * 10 + rng.normal(scale=0.2)) for c in jobs.AIR_COLUMNS[2:]}
        values["NMHC(GT)"] = -200
        if i % 16 == 0:
            values["T"] = -200
        lines.append(f"10/03/2004;18.00.00;" + ";".join(str(round(values[c], 3)).replace(".", ",") for c in jobs.AIR_COLUMNS[2:]) + ";;")
    lines += [";" * (len(jobs.AIR_COLUMNS) + 1)] * 3
    source = write("\n".join(lines) + "\n")
    columns = (*jobs.AIR_COLUMNS, "tail1", "tail2")
    clean_rows = jobs.read_air_quality(spark, source, columns)
    assert clean_rows.count() == 150 and "NMHC_GT" not in clean_rows.columns
    monkeypatch.setattr(jobs, "read_air_quality", lambda s, p: clean_rows)
    studies = jobs.air_quality(spark, source, str(tmp_path / "out"))
    r2 = {r["model"]: r["r2"] for r in studies["regression"]["metrics"].collect()}
    assert r2["linear"] > 0.9 > 0.1 > r2["mean"]
    accuracy = {r["model"]: r["accuracy"] for r in studies["classification"]["metrics"].collect()}
    assert accuracy["logistic"] > 0.85 > accuracy["majority"]
    quality = studies["clustering"]["metrics"].first()
    assert quality["n"] == 105 and quality["silhouette"] > 0.3
    assert studies["clustering"]["assignments"].count() == 150


def test_crop_training_and_scoring(spark, write, tmp_path):
    rng = np.random.default_rng(9)
    lines = [",".join(jobs.CROP_FEATURES) + ",label"]
    for c, name in enumerate(("apple", "maize", "rice")):
        for _ in range(40):
            lines.append(",".join(f"{20 * c + rng.normal():.3f}" for _ in jobs.CROP_FEATURES) + f",{name}")
    out = str(tmp_path / "out")
    board = jobs.train_crops(spark, write("\n".join(lines) + "\n"), out, trees=5)
    assert {r["model"] for r in board.collect()} >= {"Dummy", "Random Forest"}
    knn = spark.read.option("header", True).csv(f"{out}/knn_validation").where("average = 'accuracy'").first()
    assert float(knn["f1_score"]) > 0.9
    probe = write(",".join(jobs.CROP_FEATURES) + "\n" + "\n".join(",".join([str(v)] * 7) for v in (0, 20, 40)) + "\n", "probe.csv")
    scored = jobs.score_crops(spark, probe, f"{out}/bundle", f"{out}/scored").orderBy("N").collect()
    assert [r["predicted_class"] for r in scored] == ["apple", "maize", "rice"]


@pytest.mark.parametrize("job", ["oil", "heart", "temperature"])
def test_table_studies(spark, write, tmp_path, monkeypatch, job):
    rng = np.random.default_rng(10)
    monkeypatch.setattr(jobs, "LOGISTIC_STEPS", 6)
    out = str(tmp_path / "out")
    if job == "oil":
        lines = ["city,manufacturer,brand,class,size,year,month,price_bracket,value_sales,volume_sales"]
        for i in range(120):
            v = rng.random() * 10
            lines.append(f"c{i % 3},m{i % 2},b{i % 5},k,s{i % 2},2020,{i % 12 + 1},${i % 4 * 10}-${i % 4 * 10 + 10},{v:.3f},{3 * v + rng.normal() * 0.1:.3f}")
        study = jobs.oil_sales(spark, write("\n".join(lines) + "\n"), out)
        assert {r["model"]: r["r2"] for r in study["metrics"].collect()}["linear"] > 0.95
        assert study["largest_errors"].count() == 5
    elif job == "heart":
        plain = [c for c in jobs.HEART_FEATURES if not c.endswith("_enc")]
        lines = ["patient_id,sex,chest_pain_type,smoker_status,has_heart_disease," + ",".join(plain)]
        for i in range(120):
            risk = rng.random()
            cells = [("True" if rng.random() < risk else "False") if c in ("exercise_induced_angina", "family_history", "wearable_owner") else f"{risk * 10 + rng.normal():.3f}" for c in plain]
            lines.append(f"{i},{'Male' if i % 2 else 'Female'},t{i % 3},s{i % 2},{int(risk > 0.6)}," + ",".join(cells))
        study = jobs.heart_disease(spark, write("\n".join(lines) + "\n"), out)
        assert {r["model"]: r["accuracy"] for r in study["metrics"].collect()}["logistic"] > 0.8
        assert study["top_weights"].count() == 10
    else:
        lines = ["a,b,Temperature"] + [f"{i},{i * 7 % 13},{2 * i + 5}" for i in range(80)]
        board = {r["model"]: r["r2"] for r in jobs.temperature(spark, write("\n".join(lines) + "\n"), out, trees=3).collect()}
        assert board["Linear Regression"] > 0.999 and board["Dummy"] < 0.1


def test_row_rules_on_a_stream(spark, write, tmp_path):
    batch = records.read_students(spark, write(STUDENTS))
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "part.csv").write_text(STUDENTS)
    plan = student_plan()
    fills = rowwise.fitted_fills(plan, batch.dropDuplicates(list(STUDENT_COLUMNS)))
    stream = spark.readStream.schema(text_schema(STUDENT_COLUMNS)).option("header", True).csv(str(folder))
    query = rowwise.write_stream(rowwise.clean_stream(stream, plan, fills), str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination()
    assert_rows(spark.read.parquet(str(tmp_path / "out")).distinct().collect(), STUDENTS_CLEANED, ("student_id",))
