"""Versions of the audit table: readers, broken-off writers, two writers, lookups, removal."""

import pytest
from pyspark.sql import functions as F

from ledgerwatch.sources import audit, derived, snapshots


@pytest.fixture(scope="module")
def tx(spark, sf_dir):
    return derived.transactions(spark, sf_dir).where("id < 400").cache()


@pytest.fixture
def path(tx, tmp_path):
    target = str(tmp_path / "table")
    audit.write_transactions(tx, target, buckets=3)
    return target


def rows(df):
    return sorted(map(str, df.collect()))


def doubled(tx, seq=1):
    return tx.where("id % 5 = 0").withColumns({"seq": F.lit(seq), "amount": F.lit(7.0)})


def test_a_reader_keeps_its_version(spark, tx, path):
    reader = audit.read_transactions(spark, path)
    before = rows(reader)
    assert audit.upsert(spark, path, doubled(tx), "seq") == 2
    assert rows(reader) == before
    assert rows(audit.read_transactions(spark, path, version=1)) == before
    assert audit.read_transactions(spark, path).where("amount = 7.0").count() >= 80


def test_a_reader_during_an_upsert_sees_one_version(spark, tx, path, monkeypatch):
    before, seen = rows(audit.read_transactions(spark, path)), []
    commit = snapshots.commit

    def watched(*args):
        seen.append(rows(audit.read_transactions(spark, path)))  # all files are written, none is named
        return commit(*args)

    monkeypatch.setattr(snapshots, "commit", watched)
    audit.upsert(spark, path, doubled(tx), "seq")
    assert seen == [before] and rows(audit.read_transactions(spark, path)) != before


@pytest.mark.parametrize("step", ["new_write", "_pointer", "commit", "files"])
def test_a_broken_off_upsert_changes_nothing(spark, tx, path, monkeypatch, step):
    before = rows(audit.read_transactions(spark, path))

    def broken(*args, **more):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        if step == "_pointer":  # after the manifest, before it is named
            pointer = snapshots._pointer
            patch.setattr(snapshots, "_pointer", lambda p, n: pointer(p, n) if n == 1 else broken())
        else:
            patch.setattr(snapshots, step, broken)
        with pytest.raises(OSError):
            audit.upsert(spark, path, doubled(tx), "seq")
    assert snapshots.versions(spark, path) == [1] and rows(audit.read_transactions(spark, path)) == before
    audit.upsert(spark, path, doubled(tx), "seq")
    assert snapshots.versions(spark, path) == [1, 2]


def test_of_two_writers_the_second_starts_again(spark, tx, path, monkeypatch):
    commit, others = snapshots.commit, []

    def raced(session, target, entries, base):
        if not others:
            others.append(tx.where("id % 5 = 1").withColumns({"seq": F.lit(1), "amount": F.lit(9.0)}))
            audit.upsert(spark, path, others[0], "seq")
        return commit(session, target, entries, base)

    monkeypatch.setattr(snapshots, "commit", raced)
    assert audit.upsert(spark, path, doubled(tx), "seq") == 3
    now = audit.read_transactions(spark, path)
    assert now.count() == tx.count()
    assert now.where("amount = 9.0 and id % 5 = 1").count() == others[0].count()
    assert now.where("amount = 7.0 and id % 5 = 0").count() == tx.where("id % 5 = 0").count()


def test_a_conflict_is_raised_when_attempts_run_out(spark, tx, path):
    entries = snapshots.manifest(spark, path, 1)
    snapshots.commit(spark, path, entries, 1)
    with pytest.raises(snapshots.ConflictingWrite):
        snapshots.commit(spark, path, entries, 1)
    assert snapshots.versions(spark, path) == [1, 2]


def test_an_upsert_writes_only_what_it_touches(spark, tx, path):
    one = tx.orderBy("id").limit(1).withColumns({"seq": F.lit(1), "amount": F.lit(3.0)})
    first = snapshots.manifest(spark, path, 1)
    audit.upsert(spark, path, one, "seq")
    second = snapshots.manifest(spark, path, 2)
    assert second.join(first, snapshots.WRITE, "anti").count() == 1
    assert second.count() == first.count() and second.agg(F.sum("rows")).first()[0] == tx.count()


def test_append_and_overwrite(spark, tx, path):
    more = tx.withColumns({"id": F.col("id") + 1000, "transaction_id": F.concat(F.lit("M"), "transaction_id")})
    audit.write_transactions(more, path, mode="append")
    assert audit.read_transactions(spark, path).count() == 2 * tx.count()
    audit.upsert(spark, path, doubled(more).drop("id"), "seq")
    assert audit.read_transactions(spark, path).count() == 2 * tx.count()
    audit.write_transactions(more, path, buckets=1)
    assert audit.read_transactions(spark, path).count() == tx.count()
    assert snapshots.manifest(spark, path, 4).agg(F.max("buckets")).first()[0] == 1


def test_a_lookup_lists_one_bucket(spark, tx, path):
    for r in tx.limit(3).collect():
        found = audit.find_transaction(spark, path, r["transaction_id"])
        assert [x["id"] for x in found.collect()] == [r["id"]]
        buckets = {f.split("id_bucket=")[1].split("/")[0] for f in found.inputFiles()}
        assert len(buckets) == 1 and len(found.inputFiles()) < len(audit.read_transactions(spark, path).inputFiles())
    assert audit.find_transaction(spark, path, "no such id").isEmpty()


def test_buckets_follow_the_largest_day(tx, monkeypatch):
    days = tx.withColumn(audit.DAY, audit.utc_day(tx))
    assert audit.buckets_for(days) == 1
    monkeypatch.setattr(audit, "BUCKET_ROWS", 2)
    assert audit.buckets_for(days) > 1
    assert audit.buckets_for(days.limit(0)) == 1


def test_forgotten_versions_take_only_their_own_files(spark, tx, path):
    audit.upsert(spark, path, doubled(tx), "seq")
    audit.upsert(spark, path, doubled(tx, 2).withColumn("amount", F.lit(8.0)), "seq")
    before = rows(audit.read_transactions(spark, path))
    assert snapshots.forget(spark, path, 1, audit.PARTITIONS) > 0
    assert snapshots.versions(spark, path) == [3] and rows(audit.read_transactions(spark, path)) == before
    with pytest.raises(FileNotFoundError):
        audit.read_transactions(spark, path, version=1)


def test_no_table(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        audit.read_transactions(spark, str(tmp_path / "none"))


def test_an_empty_table(spark, tx, tmp_path):
    target = str(tmp_path / "empty")
    audit.write_transactions(tx.limit(0), target)
    assert audit.read_transactions(spark, target).count() == 0
    audit.upsert(spark, target, doubled(tx), "seq")
    assert audit.read_transactions(spark, target).count() == doubled(tx).count()
