"""Audit table, reads, reports against DuckDB, and streams."""

import pytest
from pyspark.sql import functions as F

from checks.compare import check, oracle_connection
from checks.oracles import SQL
from checks.queries import QUERIES, payload_rows, fitted_scorer, keyed_table
from ledgerwatch.operators.validate import split_valid
from ledgerwatch.plans import kpi, measures, reports, scoring
from ledgerwatch.sources import audit, derived
from ledgerwatch.streaming import jobs


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL])
def test_query_equals_its_sql(spark, sf_dir, name):
    verdict, _ = check(spark, oracle_connection(sf_dir), sf_dir, name)
    assert verdict.startswith("equal"), verdict


@pytest.fixture(scope="module")
def tx(spark, sf_dir):
    return derived.transactions(spark, sf_dir).persist()


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_upsert_twice_is_once(spark, tx, tmp_path):
    path = str(tmp_path / "t")
    audit.write_transactions(tx, path)
    batch = tx.where("risk_level = 'HIGH'").withColumns({"amount": F.col("amount") + 1, "seq": F.lit(1)})
    audit.upsert(spark, path, batch, "seq")
    once = rows(audit.read_transactions(spark, path))
    audit.upsert(spark, path, batch, "seq")
    assert rows(audit.read_transactions(spark, path)) == once
    assert len(once) == tx.count()


def test_upsert_keeps_identity_and_overwrites_the_label(spark, tx, tmp_path):
    path = str(tmp_path / "t")
    audit.write_transactions(tx, path)
    known = tx.where("actual_class = 1").first()
    batch = (
        tx.where(F.col("id") == known["id"]).drop("id")
        .withColumns({"actual_class": F.lit(None).cast("int"), "created_at": F.col("created_at") + F.expr("INTERVAL 3 DAYS"), "seq": F.lit(1)})
    )
    audit.upsert(spark, path, batch, "seq")
    now = audit.read_transactions(spark, path).where(F.col("transaction_id") == known["transaction_id"]).collect()
    assert len(now) == 1
    assert (now[0]["id"], now[0]["created_at"]) == (known["id"], known["created_at"])
    assert now[0]["actual_class"] is None
    audit.write_transactions(tx, path)
    audit.upsert(spark, path, batch, "seq", keep_label=True)
    kept = audit.read_transactions(spark, path).where(F.col("transaction_id") == known["transaction_id"]).first()
    assert kept["actual_class"] == 1


def test_upsert_adds_rows_with_new_ids_and_the_last_record_wins(spark, tx, tmp_path):
    path = str(tmp_path / "t")
    audit.write_transactions(tx, path)
    some = tx.where("risk_level = 'MEDIUM'").drop("id").withColumn("transaction_id", F.concat(F.lit("NEW_"), "transaction_id"))
    batch = some.withColumn("seq", F.lit(2)).unionByName(
        some.withColumns({"seq": F.lit(1), "amount": F.lit(0.0)})
    )
    audit.upsert(spark, path, batch, "seq")
    table = audit.read_transactions(spark, path)
    assert table.count() == tx.count() + some.count()
    assert table.select("id").distinct().count() == table.count()
    new = table.where("transaction_id LIKE 'NEW_%'")
    assert new.agg(F.min("id")).first()[0] > tx.agg(F.max("id")).first()[0]
    assert rows(new.select("transaction_id", "amount")) == rows(some.select("transaction_id", "amount"))


def test_first_upsert_creates_the_table(spark, tx, tmp_path):
    path = str(tmp_path / "t")
    audit.upsert(spark, path, tx.withColumn("seq", F.lit(0)), "seq")
    assert audit.read_transactions(spark, path).count() == tx.count()


def test_upsert_under_other_zones_keeps_all_rows(spark, tx, tmp_path):
    path = str(tmp_path / "t")
    stamped = tx.withColumn("created_at", jobs.utc_instant(F.col("created_at")))
    audit.write_transactions(stamped, path)
    before = rows(audit.read_transactions(spark, path).withColumn("created_at", F.unix_micros("created_at")))
    one = stamped.where("id = 7").withColumn("seq", F.lit(1))
    for zone in ("Asia/Tokyo", "America/Los_Angeles", "UTC"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            audit.upsert(spark, path, one, "seq")
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        after = rows(audit.read_transactions(spark, path).withColumn("created_at", F.unix_micros("created_at")))
        assert after == before


def test_new_ids_are_gapless(spark, tx, tmp_path):
    path = str(tmp_path / "t")
    audit.write_transactions(tx, path)
    top = tx.agg(F.max("id")).first()[0]
    batch = tx.repartition(3).withColumns({"transaction_id": F.concat(F.lit("N"), "transaction_id"), "seq": F.lit(0)}).drop("id")
    audit.upsert(spark, path, batch, "seq")
    ids = sorted(r[0] for r in audit.read_transactions(spark, path).where("transaction_id like 'N%'").select("id").collect())
    assert ids == list(range(top + 1, top + 1 + tx.count()))


def test_late_labels_follow_their_order(tx):
    some = tx.limit(3).select("transaction_id")
    late = some.withColumns({"actual_class": F.lit(1), "at": F.lit(1)}).unionByName(some.withColumns({"actual_class": F.lit(0), "at": F.lit(2)}))
    got = audit.attach_labels(tx, late, "at").join(some, "transaction_id").collect()
    assert {r["actual_class"] for r in got} == {0}


def test_pages_do_not_depend_on_their_path_with_nulls(tx, monkeypatch):
    odd = tx.withColumns({
        "created_at": F.when(F.col("id") % 10 != 0, F.date_trunc("day", "created_at")),
        "id": F.when(F.col("id") % 7 != 0, F.col("id")),
    })
    for skip in (0, 300, 700, 760, 2000):
        monkeypatch.setattr(kpi, "SORTED_PAGE_ROWS", 10**9)
        shallow = rows(kpi.list_transactions(odd, skip, 50))
        monkeypatch.setattr(kpi, "SORTED_PAGE_ROWS", 10)
        assert rows(kpi.list_transactions(odd, skip, 50)) == shallow


def test_deep_pages_equal_the_sorted_table(tx, monkeypatch):
    base = tx.withColumn("created_at", F.date_trunc("day", "created_at"))  # many equal times
    whole = [r["id"] for r in base.orderBy(F.desc("created_at"), "id").collect()]
    monkeypatch.setattr(kpi, "SORTED_PAGE_ROWS", 0)
    for skip in (0, 37, 500, 990, 1000, 5000):
        page = [r["id"] for r in kpi.list_transactions(base, skip, 25).collect()]
        assert page == whole[skip : skip + 25]


def test_read_limits(tx):
    for call in (lambda: kpi.list_transactions(tx, -1), lambda: kpi.list_transactions(tx, 0, 501),
                 lambda: kpi.list_transactions(tx, 0, 0), lambda: kpi.high_risk(tx, 201)):
        with pytest.raises(ValueError):
            call()


def test_empty_table(tx):
    none = tx.limit(0)
    summary = kpi.fraud_summary(none).first()
    assert summary["total_transactions"] == 0 and summary["fraud_rate_pct"] == 0.0
    assert summary["total_fraud_exposure_amount"] == 0.0 and summary["avg_transaction_amount"] == 0.0
    assert summary["risk_distribution"] == {"LOW": 0, "MEDIUM": 0, "HIGH": 0}
    assert reports.fraud_rate(none).first()["fraud_rate_percentage"] is None
    assert measures.measures(none).first()["operational_recall"] == 0.0


def test_top_suspicious_keeps_all_ties(tx):
    tied = tx.withColumns({"fraud_probability": F.lit(0.9), "amount": F.lit(10.0)})
    found = reports.top_suspicious(tied)
    assert found.count() == tx.count()
    assert [r[0] for r in found.select("tier_rank").distinct().collect()] == [1]


def split_files(spark, df, folder, parts):
    for i in range(parts):
        df.where(F.col("event_id") % parts == i).coalesce(1).write.mode("append").parquet(folder)


def test_retries_over_many_batches_leave_one_row_per_id(spark, sf_dir, tmp_path):
    events = derived.table(spark, sf_dir, "events")
    folder = str(tmp_path / "events")
    split_files(spark, events, folder, 3)
    again = events.where("event_type = 'error'").withColumn("value", F.col("value") + 1)
    again.coalesce(1).write.mode("append").parquet(folder)
    stream = jobs.file_stream(spark, folder, events.schema, files_per_batch=1)
    stamped = derived.audit_rows(stream).withColumn("seq", F.col("amount"))
    table = str(tmp_path / "table")
    jobs.upsert_stream(stamped, table, "seq", str(tmp_path / "state")).awaitTermination()
    got = audit.read_transactions(spark, table)
    assert got.count() == events.count()
    errors = events.where("event_type = 'error'").select(F.col("event_id").alias("id"), "value")
    assert got.join(errors, "id").where("amount <> value + 1").count() == 0


def test_windows_over_many_batches_equal_the_batch_summary(spark, sf_dir, tx, tmp_path):
    events = derived.table(spark, sf_dir, "events")
    folder = str(tmp_path / "events")
    split_files(spark, events, folder, 3)
    stream = derived.audit_rows(jobs.file_stream(spark, folder, events.schema, files_per_batch=1))
    timed = stream.withColumn("created_at", jobs.utc_instant(F.col("created_at")))
    # Files interleave in time, so a long delay keeps every row.
    query = jobs.summary_stream(timed, str(tmp_path / "sink"), str(tmp_path / "state"), delay="60 days")
    query.awaitTermination()
    got = jobs.latest_summary(spark, str(tmp_path / "sink")).withColumn("window_start", jobs.utc_date(F.col("window_start")))
    want = kpi.summary_from(
        tx.groupBy(F.to_date("created_at").alias("window_start")).agg(*kpi.summary_aggregates()), "window_start"
    )
    assert rows(kpi.flat_summary(got)) == rows(kpi.flat_summary(want))


def test_stream_scores_equal_batch_scores(spark, sf_dir, tmp_path):
    embeddings = derived.table(spark, sf_dir, "embeddings")
    folder = str(tmp_path / "in")
    embeddings.repartition(2).write.parquet(folder)
    scorer = fitted_scorer(spark, keyed_table(spark, sf_dir))
    stream = jobs.file_stream(spark, folder, embeddings.schema, files_per_batch=1)
    payloads = payload_rows(stream).withColumn("received_at", F.timestamp_seconds("Time"))
    table, bad = str(tmp_path / "table"), str(tmp_path / "bad")
    jobs.score_stream(payloads, scorer, table, bad, str(tmp_path / "state")).awaitTermination()
    good, rejected = split_valid(payload_rows(embeddings))
    want = kpi.audit_record(scoring.score(good, scorer, factors=0))
    got = audit.read_transactions(spark, table).select(*want.columns)
    assert rows(got) == rows(want)
    assert rows(spark.read.parquet(bad).select("transaction_id", "reasons")) == rows(
        rejected.select("transaction_id", "reasons")
    )
