import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerwatch.operators.clean import analyze_outliers, clean_dataset, handle_duplicates, impute
from ledgerwatch.operators.validate import (
    audit_violations, require_audit_rows, split_valid, validate_schema,
)
from ledgerwatch.schemas import RAW_COLUMNS, V_COLUMNS
from ledgerwatch.sources.raw import load_raw
from tests.conftest import raw_pandas


def test_schema_passes(raw_df):
    validate_schema(raw_df)


def test_missing_column_is_named(raw_df):
    with pytest.raises(ValueError, match="columns not found.*V14"):
        validate_schema(raw_df.drop("V14"))


@pytest.mark.parametrize("bad", [99, None])
def test_bad_label_is_named(raw_df, bad):
    broken = raw_df.withColumn("Class", F.when(F.col("Time") > 0, F.col("Class")).otherwise(F.lit(bad)))
    with pytest.raises(ValueError, match="labels other than 0 and 1"):
        validate_schema(broken)


def test_nan_null_and_infinity_become_the_median(spark):
    pdf = raw_pandas(100, 2)
    pdf.loc[5, "V1"] = np.nan
    pdf.loc[6, "Amount"] = np.inf
    pdf.loc[7, "Amount"] = -np.inf
    cleaned = impute(spark.createDataFrame(pdf)).toPandas()
    assert np.isfinite(cleaned.to_numpy(dtype=float)).all()
    known = pdf.replace([np.inf, -np.inf], np.nan)
    assert np.isclose(cleaned["V1"], known["V1"].median()).any()
    assert np.isclose(cleaned["Amount"], known["Amount"].median()).sum() >= 2


def test_an_entirely_missing_column_stays_missing(spark):
    df = spark.createDataFrame([(None, 0), (None, 1)], "V1 double, Class int")
    assert impute(df).where("V1 IS NULL").count() == 2


def test_repeats_are_counted_and_dropped(spark, raw_pdf, raw_df):
    twice = raw_df.union(raw_df.where("Time = 0")).union(raw_df.where("Time = 0"))
    deduped, n = handle_duplicates(twice)
    assert n == 2 and deduped.count() == len(raw_pdf)
    kept, n = handle_duplicates(twice, drop=False)
    assert n == 2 and kept.count() == len(raw_pdf) + 2


def test_outliers_are_described_not_dropped(raw_df, raw_pdf):
    row = analyze_outliers(raw_df).first()
    q1, q3 = raw_pdf["Amount"].quantile([0.25, 0.75])
    fence = q3 + 1.5 * (q3 - q1)
    assert row["upper_bound"] == pytest.approx(fence)
    assert row["total_outliers"] == (raw_pdf["Amount"] > fence).sum()
    assert row["fraud_count_in_outliers"] == raw_pdf[raw_pdf["Amount"] > fence]["Class"].sum()
    assert row["recommendation"]


def test_clean_dataset_imputes_before_dropping_repeats(spark, tmp_path, raw_pdf):
    # Two rows that differ only by a hole which imputation fills with the other's value.
    pdf = raw_pandas(101, 5)
    middle = pdf["V1"].sort_values().index[50]
    twin = pdf.loc[[middle]].copy()
    holed = twin.copy()
    holed["V1"] = np.inf
    source = str(tmp_path / "raw.csv")
    import pandas as pd

    pd.concat([pdf, holed]).to_csv(source, index=False)
    cleaned, summary = clean_dataset(spark, source, str(tmp_path / "cleaned"))
    assert cleaned.columns == RAW_COLUMNS
    assert cleaned.count() == 101
    assert summary.first()["total_outliers"] >= 0


def test_load_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_raw(spark, str(tmp_path / "absent.csv"))
    empty = tmp_path / "empty.csv"
    empty.write_text("")
    with pytest.raises(ValueError):
        load_raw(spark, str(empty))
    header = tmp_path / "header.csv"
    header.write_text(",".join(RAW_COLUMNS) + "\n")
    with pytest.raises(ValueError, match="empty"):
        load_raw(spark, str(header))


def payload(**changes):
    row = {"transaction_id": "TX_1", "Time": 7200.0, "Amount": 150.0, "actual_class": None}
    return {**row, **{v: 0.0 for v in V_COLUMNS}, **changes}


@pytest.mark.parametrize(
    "changes, reasons",
    [
        ({}, []),
        ({"Amount": -25.0}, ["Amount"]),
        ({"Amount": 0.0, "Time": 0.0}, []),
        ({"Time": None}, ["Time"]),
        ({"transaction_id": "ab"}, ["transaction_id"]),
        ({"transaction_id": "x" * 65}, ["transaction_id"]),
        ({"transaction_id": None}, ["transaction_id"]),
        ({"actual_class": 1}, []),
        ({"actual_class": 2}, ["actual_class"]),
        ({"V3": None, "V9": float("nan")}, ["V3", "V9"]),
    ],
)
def test_payload_rules(spark, changes, reasons):
    from ledgerwatch.schemas import PAYLOAD_SCHEMA

    row = payload(**changes)
    df = spark.createDataFrame([tuple(row[c] for c in PAYLOAD_SCHEMA.fieldNames())], PAYLOAD_SCHEMA)
    good, bad = split_valid(df)
    assert [r["reasons"] for r in bad.collect()] == ([reasons] if reasons else [])
    assert good.count() == (0 if reasons else 1)


def test_payload_without_features_is_rejected(spark):
    df = spark.createDataFrame([("TX_1", 500.0, 10.0)], "transaction_id string, Time double, Amount double")
    good, bad = split_valid(df)
    assert good.count() == 0 and bad.first()["reasons"] == V_COLUMNS


def test_audit_constraints(spark, sf_dir):
    from ledgerwatch.sources.derived import transactions

    tx = transactions(spark, sf_dir)
    assert {r["violations"] for r in audit_violations(tx).collect()} == {0}
    assert require_audit_rows(tx).count() == tx.count()
    broken = tx.withColumn("risk_level", F.lit("SEVERE"))
    with pytest.raises(Exception, match="audit check risk_level"):
        require_audit_rows(broken).collect()
