"""Listing without Python lists, the index of landing files, ledger checkpoints."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import write
from tidewater.sinks import ledger as L
from tidewater.sources import landing
from tidewater.sources.landing import LandingIndex, list_landing


def names(df):
    return sorted(r["path"].rsplit("/", 1)[-1] for r in df.select("path").collect())


@pytest.mark.parametrize("chunk", [2, 3, 100])
def test_chunks_hold_every_name(spark, tmp, chunk):
    odd = ["a b.csv", "p+q.csv", "100%.csv", "é.csv", "x=1.csv", "a_DONE.csv", "no_extension"]
    for name in odd:
        write(f"{tmp}/landing/{name}", "" if "DONE" in name else "1\n")
    listed = list_landing(spark, f"{tmp}/landing", chunk)
    assert names(listed) == sorted(odd[:-1])
    read = spark.read.text([r["path"] for r in listed.collect()]).select(F.col("_metadata.file_path").alias("file_key"))
    assert read.join(listed, "file_key").count() == 5  # all but the empty marker and the name without a dot
    assert list_landing(spark, f"{tmp}/nowhere", chunk).count() == 0


def test_index_tells_what_is_new(spark, tmp):
    index = LandingIndex(spark, f"{tmp}/index")
    assert index.version == 0 and index.names().count() == 0
    assert index.update(f"{tmp}/landing").count() == 0
    for k, added in enumerate((["b.csv", "d.csv"], ["a.csv", "c.csv"], [])):
        for name in added:
            write(f"{tmp}/landing/{name}", "1\n")
        assert names(index.update(f"{tmp}/landing")) == added
        assert names(index.new()) == added and index.version == k + 2
    os.remove(f"{tmp}/landing/b.csv")
    assert index.update(f"{tmp}/landing").count() == 0
    assert names(index.names()) == ["a.csv", "c.csv", "d.csv"]
    write(f"{tmp}/landing/b.csv", "1\n")
    assert names(index.update(f"{tmp}/landing")) == ["b.csv"]  # gone and back: new again
    assert len([f for f in os.listdir(f"{tmp}/index") if f.startswith("snapshot")]) == 2


def test_an_update_that_was_cut_off_is_made_again(spark, tmp, monkeypatch):
    index = LandingIndex(spark, f"{tmp}/index")
    write(f"{tmp}/landing/a.csv", "1\n")
    index.update(f"{tmp}/landing")
    write(f"{tmp}/landing/b.csv", "1\n")

    def crash(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(landing, "write_version", crash)
        with pytest.raises(KeyboardInterrupt):
            index.update(f"{tmp}/landing")
    assert index.version == 1 and names(index.names()) == ["a.csv"]
    assert names(index.update(f"{tmp}/landing")) == ["b.csv"]


def entry(spark, run, rows):
    known = {"run_id": run, "batch_index": 1, "ready": True, "n_files": 1}
    data = [tuple({**known, "batch_id": b, "outcome": o, "files": f}.get(c.name) for c in L.LEDGER_SCHEMA) for b, o, f in rows]
    return spark.createDataFrame(data, L.LEDGER_SCHEMA)


def contents(spark, path):
    return (sorted((r["run_id"], r["batch_id"], r["outcome"]) for r in L.read_ledger(spark, path).collect()),
            sorted(r["path"] for r in L.finished_files(spark, path).collect()),
            sorted(r["batch_id"] for r in L.archived_batches(spark, path).collect()))


def test_compacted_ledger_equals_the_plain_one(spark, tmp):
    plain, packed = f"{tmp}/plain", f"{tmp}/packed"
    for k in range(9):
        rows = [(f"b{k}", "archived", [f"/l/{k}.csv", f"/l/{k}_2.csv"]), (f"c{k}", ("failed", "deferred")[k % 2], [f"/l/x{k}.csv"]),
                (f"late{k // 2}", ("deferred", "archived")[k % 2], [f"/l/late{k // 2}.csv"])]
        for path in (plain, packed):
            L.append_ledger(entry(spark, f"run-{k}", rows), path)
        assert L.compact_ledger(spark, packed, after_runs=3) == (k % 3 == 2)
        assert contents(spark, packed) == contents(spark, plain)
        assert L.has_batch(spark, packed, f"run-{k // 2}", f"b{k // 2}") and not L.has_batch(spark, packed, "run-0", "b1")
    assert len([f for f in os.listdir(packed) if f.startswith("run_id=")]) <= 6
    assert not L.compact_ledger(spark, packed, after_runs=3)
    assert not L.compact_ledger(spark, f"{tmp}/nothing", after_runs=1)


@pytest.mark.parametrize("at", ["write_version", "delete_path"])
def test_a_compaction_that_was_cut_off_changes_nothing(spark, tmp, monkeypatch, at):
    path = f"{tmp}/ledger"
    for k in range(4):
        L.append_ledger(entry(spark, f"run-{k}", [(f"b{k}", "archived", [f"/l/{k}.csv"])]), path)
        if k == 1:
            L.compact_ledger(spark, path, after_runs=2)
    expected = contents(spark, path)

    def crash(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(L, at, crash)
        with pytest.raises(KeyboardInterrupt):
            L.compact_ledger(spark, path, after_runs=2)
    assert contents(spark, path) == expected
    L.append_ledger(entry(spark, "run-9", [("b9", "archived", ["/l/9.csv"])]), path)
    L.compact_ledger(spark, path, after_runs=1)
    assert len(contents(spark, path)[0]) == 5 and len(contents(spark, path)[1]) == 5
