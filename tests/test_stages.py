"""Files: survey CSV with its null model, tables, reports, whole stages."""

import os

import pytest
from pyspark.sql import functions as F

from catalog import frames
from scorelab.operators import checks as X
from scorelab.operators.classify import load_ensemble, vote
from scorelab.plans import stages
from scorelab.plans.models import model_rows
from scorelab.sources import (
    Facts,
    read_metrics,
    read_optional_table,
    read_report,
    read_survey_csv,
    read_table,
    read_version,
    select_available,
    table_facts,
    write_report,
    write_survey_csv,
    write_table,
    write_version,
)


def test_null_model_of_the_csv(spark, tmp_path):
    path = tmp_path / "survey.csv"
    path.write_text('id,a,b\n1,NA,"NA"\n2,,""\n3,"two\nlines","say ""hi"", ok"\n4,"NA;x"," pad "\n')
    rows = {r.id: (r.a, r.b) for r in read_survey_csv(spark, str(path)).collect()}
    assert rows == {"1": (None, None), "2": (None, ""), "3": ("two\nlines", 'say "hi", ok'), "4": ("NA;x", " pad ")}
    named = read_survey_csv(spark, str(path), columns=["id", "a", "b"])
    assert named.count() == 4 and {f.dataType.simpleString() for f in named.schema} == {"string"}


def test_csv_roundtrip_keeps_blanks_and_nulls(spark, tmp_path):
    rows = [("1", None), ("2", " lead"), ("3", 'q"q'), ("4", "a\nb"), ("5", ""), ("6", "x,y\\z")]
    df = spark.createDataFrame(rows, "id string, t string")
    write_survey_csv(df, str(tmp_path / "out"))
    assert sorted(tuple(r) for r in read_survey_csv(spark, str(tmp_path / "out")).collect()) == sorted(rows)


def test_missing_sources(spark, tmp_path):
    assert read_optional_table(spark, str(tmp_path / "none")) is None
    with pytest.raises(FileNotFoundError):
        read_report(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        read_metrics(spark, str(tmp_path / "none"), "a int")


def test_a_table_is_not_overwritten_while_read(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    with pytest.raises(ValueError):
        write_table(read_table(spark, path), path)
    assert read_table(spark, path).count() == 5


def test_reports_are_one_ordered_file(spark, tmp_path):
    path = str(tmp_path / "r")
    write_report(spark.range(100).repartition(4), path, order_by=[("id", True)])
    parts = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(parts) == 1
    assert (tmp_path / "r" / parts[0]).read_text().splitlines()[:2] == ["id", "99"]


def test_select_available_reports_the_rest(spark):
    kept, missing = select_available(spark.range(1).withColumnRenamed("id", "a b"), ["x", "a b"])
    assert (kept.columns, missing) == (["a b"], ["x"])


def test_stages_end_to_end(spark, small, tmp_path):
    csv, out = str(tmp_path / "export"), str(tmp_path / "out")
    raw = frames.responses(spark, small)
    write_survey_csv(raw.unionByName(raw), csv)
    assert stages.ingest(spark, csv, out).count() == raw.count()
    scored = stages.score(spark, out)
    assert scored.where("UsageScore NOT BETWEEN 0 AND 100 OR TrustScore NOT BETWEEN 0 AND 100").count() == 0
    reports = stages.report(spark, out, slice_support=1)
    assert set(reports) == set(os.listdir(f"{out}/{stages.REPORTS}"))
    bands = read_report(spark, f"{out}/{stages.REPORTS}/trust_by_usage", reports["trust_by_usage"].schema)
    assert bands.agg({"DeveloperCount": "sum"}).first()[0] == raw.count()
    result = stages.model(spark, out, starts=1, trees=5, depth=4)
    record = read_metrics(spark, f"{out}/{stages.MODELS}/rf_metrics", result.record.schema).first()
    assert record.n_train + record.n_test == read_table(spark, f"{out}/{stages.MODELS}/cluster_rows").count()
    assert len(record.predictors) == 8
    assert result.strip.first().roc_auc > 0.5
    again = load_ensemble(spark, f"{out}/{stages.MODELS}/rf_ensemble")
    rows = model_rows(scored).select("ResponseId", *again.predictors, again.label)
    votes = [sorted(map(tuple, vote(e, rows).select("ResponseId", "y_proba", "y_pred").collect())) for e in (again, result.ensemble)]
    assert votes[0] == votes[1] and len(votes[0]) > 0


def test_one_large_export(spark, small, tmp_path):
    raw = frames.responses(spark, small)
    write_survey_csv(raw.coalesce(1), str(tmp_path / "export"))
    whole = stages.ingest(spark, str(tmp_path / "export"), str(tmp_path / "a"))
    split = stages.ingest(spark, str(tmp_path / "export"), str(tmp_path / "b"), split=True)
    assert whole.exceptAll(split).isEmpty() and split.exceptAll(whole).isEmpty()


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    path = str(tmp_path / "t")
    assert table_facts(spark, path) is None
    with pytest.raises(FileNotFoundError):
        read_version(spark, path)
    first = write_version(spark.range(5).withColumn("v", F.when(F.col("id") > 1, F.col("id") * 1.5)), path, ["v"])
    assert (first.rows, first.low, first.high, first.version) == (5, {"v": 3.0}, {"v": 6.0}, 1)
    broken = read_version(spark, path).withColumn("v", F.when(F.col("id") == 4, F.raise_error(F.lit("midway"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="midway"):
        write_version(broken, path, ["v"])
    assert read_version(spark, path).count() == 5 and table_facts(spark, path) == first
    second = write_version(read_version(spark, path).where("id < 2"), path, ["v"])
    assert (second.rows, second.low, second.version) == (2, {}, 2) and read_version(spark, path).count() == 2


def test_checks_from_facts(spark):
    facts = Facts(3, ("k", "v"), {"v": 10.0}, {"v": 101.0})
    checks = [X.written_rows_between(spark, facts, 2, 4), X.written_columns(spark, {"t": facts}, {"t": ["k", "w"]}),
              X.written_within_bounds(spark, [facts]), X.written_within_bounds(spark, [Facts(0, ())], name="nothing"), X.written_outputs(spark, {"t": facts, "gone": None})]
    rows = {r.name: (r.passed, r.detail) for r in X.quality_report(checks).collect()}
    assert rows == {"row count": (True, "rows=3"), "required columns": (False, "missing: t: w"), "score bounds": (False, "min=10.0, max=101.0"),
                    "nothing": (False, "min=null, max=null"), "output artefacts": (False, "missing: gone"), "ALL": (False, "1 of 5 passed")}
