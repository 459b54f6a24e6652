"""Stored tables of latest rows, and packages: replays, conflicts, versions, odd names, files that do not agree."""

import json

import pytest
from pyspark.sql import functions as F

from lodestrata.sources.keyed import KeyedTable, VersionConflict
from lodestrata.sources.package import build_package, verify_package

SCHEMA = "source_id string, run_id long, at long, v string"


def rows(spark, *values):
    return spark.createDataFrame([(*v, "extra") for v in values], SCHEMA + ", other string")


def state(df):
    return sorted((r.source_id is None, r.source_id or "", r.run_id, r.at, r.v) for r in df.collect())


def test_upserts(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), ["source_id", "run_id"], ["at"], SCHEMA, buckets=8, pieces=2)
    assert t.version() == 0 and t.read().count() == 0
    t.upsert(rows(spark, ("a", 1, 5, "x"), ("a", 1, 4, "old"), ("b", 1, 1, "y"), (None, 1, 1, "n")), "one")
    t.upsert(rows(spark, ("a", 1, 5, "same time, later"), ("b", 1, 0, "too old"), ("c", 1, 1, "z")), "two")
    want = [(False, "a", 1, 5, "same time, later"), (False, "b", 1, 1, "y"), (False, "c", 1, 1, "z"), (True, "", 1, 1, "n")]
    assert state(t.read()) == want
    assert t.upsert(rows(spark, ("a", 1, 9, "replayed")), "one")["version"] == 2 and state(t.read()) == want
    before = t.manifest()["buckets"]
    for k in range(4):
        t.upsert(rows(spark, ("a", 1, 6 + k, f"v{k}")))
    after = t.manifest()["buckets"]
    assert sum(before.get(b) != p for b, p in after.items()) == 1 and max(map(len, after.values())) <= 2  # one bucket touched, and rewritten
    assert (False, "a", 1, 9, "v3") in state(t.read()) and state(t.read(2)) == want
    assert t.vacuum(1) > 0 and (False, "a", 1, 9, "v3") in state(t.read())
    t.upsert(rows(spark), "empty")
    assert t.read().count() == 4


def test_two_writers(spark, tmp_path):
    """A version that another writer has made is not overwritten: the batch goes on top of it."""
    t = KeyedTable(spark, str(tmp_path / "t"), ["source_id"], ["at"], SCHEMA, buckets=2)
    t.upsert(rows(spark, ("a", 1, 1, "x")))
    with pytest.raises(VersionConflict):
        t._swap({"version": 1, "buckets": {}, "batches": []})
    stale, real = t.manifest(), t.manifest
    other = KeyedTable(spark, t.path, ["source_id"], ["at"], SCHEMA, buckets=2)
    other.upsert(rows(spark, ("b", 1, 1, "y")))
    calls = []
    t.manifest = lambda version=None: stale if version is None and len(calls) == 0 and not calls.append(1) else real(version)
    t.upsert(rows(spark, ("c", 1, 1, "z")))
    assert [r[1] for r in state(t.read())] == ["a", "b", "c"] and t.version() == 3


def test_package(spark, tmp_path):
    values = [("hot", i) for i in range(250)] + [("a/b", 1), ('q"uo,te', 2), (None, 3), ("..", 4), ("", 5)]
    df = spark.createDataFrame(values, "s string, n long").repartition(3)
    path = str(tmp_path / "p")
    entries = build_package(df, path, "s", ["n"], F.to_json(F.struct("n")), 100)
    got = {(e.source_id, e.path.rpartition("-")[2]): e.records for e in entries.collect()}
    assert got == {("hot", "00000.jsonl"): 100, ("hot", "00001.jsonl"): 100, ("hot", "00002.jsonl"): 50, ("a/b", "00000.jsonl"): 1, ('q"uo,te', "00000.jsonl"): 1, ("null", "00000.jsonl"): 1, ("..", "00000.jsonl"): 1, ("", "00000.jsonl"): 1}
    manifest = json.loads((tmp_path / "p/manifest.json").read_text())
    assert (manifest["sources"], manifest["files"], manifest["records"]) == (6, 8, 255)
    assert (tmp_path / "p/sources.csv").read_text().splitlines()[0] == "source_id,files,records,bytes" and not (tmp_path / "p/_staging").exists()
    assert len((tmp_path / "p/checksums.sha256").read_text().splitlines()) == 8
    assert (tmp_path / "p/sources/hot/part-00001.jsonl").read_text().splitlines()[0] == '{"n":100}'
    assert all(r.matches for r in verify_package(entries, path).collect())
    (tmp_path / "p/sources/hot/part-00001.jsonl").write_text("changed")
    (tmp_path / "p/sources/hot/.part-00001.jsonl.crc").unlink(missing_ok=True)
    (tmp_path / "p/sources/hot/more.jsonl").write_text("more")
    assert sorted(r.path for r in verify_package(entries, path).collect() if not r.matches) == ["sources/hot/more.jsonl", "sources/hot/part-00001.jsonl"]
    assert build_package(df.limit(0), str(tmp_path / "none"), "s", ["n"], F.to_json(F.struct("n"))).count() == 0
