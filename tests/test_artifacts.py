"""JSON walks against a walker in Python, and the artifact reader: what it lists, plans and filters."""

import json
import random

from lodestrata.sources import artifacts, files


def walked(value, place=(), name=None):
    yield place, name, value
    if isinstance(value, dict):
        for i, (k, v) in enumerate(value.items()):
            yield from walked(v, (*place, i), k)
    elif isinstance(value, list):
        for i, v in enumerate(value):
            yield from walked(v, (*place, i))


def some(rng, depth):
    kind = rng.choice(["object", "array", "text", "int", "none", "bool"] if depth else ["text", "int"])
    if kind == "object":
        return {k: some(rng, depth - 1) for k in rng.sample(["z", "a", "b c", "é", "resources"], rng.randrange(4))}
    if kind == "array":
        return [some(rng, depth - 1) for _ in range(rng.randrange(4))]
    return {"text": rng.choice(["", "x", '{"no": 1}', "[1]", "é\n"]), "int": rng.randrange(100), "none": None, "bool": True}[kind]


def test_levels_equal_a_walk(spark):
    rng = random.Random(2)
    docs = [(i, some(rng, 4)) for i in range(60)]
    rows = [(i, json.dumps(d)) for i, d in docs] + [(100, "{bad"), (101, None), (102, ""), (103, " [1] ")]
    got = files.json_levels(spark.createDataFrame(rows, "k long, b string"), ["k"], "b").collect()
    want = {(i, p): (n, v) for i, d in [*docs, (103, [1])] for p, n, v in walked(d)}
    assert {(r.k, tuple(r.place)) for r in got} == set(want)
    for r in got:
        name, value = want[(r.k, tuple(r.place))]
        assert r["name"] == name
        if isinstance(value, str) and r.place:
            assert (r.kind, r.raw) == ("STRING", value)
        elif isinstance(value, (dict, list)):
            assert r.kind == ("OBJECT" if isinstance(value, dict) else "ARRAY") and json.loads(r.raw) == value


def test_probe_without_documents(spark):
    df = spark.createDataFrame([("a", 1, "{bad"), ("b", 1, None), ("c", 1, "{}")], "s string, k long, b string")
    assert sorted(tuple(r) for r in files.probe_outputs(df, "s", "k", "b").collect()) == [("a", 0, None, None, None), ("b", 0, None, None, None), ("c", 0, None, None, None)]


def test_artifacts(spark, tmp_path, monkeypatch):
    for n, text in (("a.json", "{}"), ("b/c.LOG", "é"), ("b/d.log", "x" * 50), ("b/_tmp/e.log", "no"), (".f.log", "no"), ("g", ""), ("h.tar.gz", "z")):
        (tmp_path / n).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / n).write_text(text)
    df = artifacts.artifact_files(spark, str(tmp_path))
    assert sorted((r["name"], r.suffix, r.length) for r in df.collect()) == [("a.json", ".json", 2), ("c.LOG", ".log", 2), ("d.log", ".log", 50), ("g", "", 0), ("h.tar.gz", ".gz", 1)]
    logs = df.where("suffix = '.log' AND length < 10")
    assert [r["name"] for r in logs.collect()] == ["c.LOG"]
    plan = logs.select("path")._jdf.queryExecution().executedPlan().toString()
    assert "isnotnull(suffix" in plan and ".log" not in plan and "< 10" not in plan  # the reader has taken both
    assert [r.content for r in artifacts.artifact_files(spark, str(tmp_path / "a.json")).collect()] == [b"{}"]
    assert artifacts.artifact_files(spark, str(tmp_path / "missing")).count() == 0
    reader = artifacts.ArtifactReader({"path": str(tmp_path)})
    monkeypatch.setattr(artifacts, "PARTITION", 50)
    assert [len(p.files) for p in reader.partitions()] == [2, 2, 1]
