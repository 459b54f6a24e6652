import pytest
from pyspark.errors import PySparkException

from lodestrata.operators import audit, evidence, packages, resolution


def test_segment_audit(spark):
    mk = spark.createDataFrame
    m = mk([("a", "A", "READY_FOR_B10_LIVE", "html"), ("b", "B", "READY_FOR_B10_LIVE", "html"), ("c", "C", "OTHER", "html"), ("d", "D", "READY_FOR_B10_LIVE", None)], "source_id string, logical_code string, execution_state string, expected_workflow string")
    s = mk([("a", "html", "fine", 3), ("d", None, None, None)], "source_id string, actual_workflow string, text string, resource_count long")
    k = mk([("a", "SUCCEEDED"), ("d", "SUCCEEDED")], "source_id string, state string")
    got = {r.source_id: (r.classification, r.blocks, r.severity, r.error_signals) for r in evidence.segment_audit(m, s, k).collect()}
    assert got == {"a": ("CLEAN_SUCCESS", False, "OK", []), "b": ("MISSING_LOG_SEGMENT", True, "ERROR", ["MISSING_LOG_SEGMENT"]), "d": ("RESOURCE_COUNT_NOT_OBSERVED_WARNING", False, "WARNING", [])}
    with pytest.raises(PySparkException, match="repeated source_id: a"):
        evidence.segment_audit(m, s.union(s), k).collect()
    assert evidence.segment_audit(m.limit(0), s.limit(0), k.limit(0)).count() == 0


def test_rollups(spark):
    rows = spark.createDataFrame([("s", [None, "x", "x"]), ("t", None), ("u", ["y"])], "k string, signals array<string>")
    assert sorted(tuple(r) for r in audit.signal_counts(rows, "signals").collect()) == [("x", 2), ("y", 1)]
    many = spark.range(1000).selectExpr("id % 2 AS k", "id")
    assert sorted((r.k, r.id) for r in audit.first_n(many, ["k"], ["id"], 2).collect()) == [(0, 0), (0, 2), (1, 1), (1, 3)]
    links = spark.createDataFrame([("s", "data/b"), ("s", "data/a"), ("s", "data/a"), ("s", "x")], "k string, url string")
    assert [tuple(r) for r in packages.keyword_links(links, "k", ["data"], 1).select("n", "sample").collect()] == [(3, ["data/a"])]


def test_lookups(spark):
    mk = spark.createDataFrame
    inventory = mk([("Abc", 1), ("ABC", 2), ("", 3), (None, 4)], "source_id string, n long")
    got = resolution.folded_lookup(mk([("aBC",), ("x",), ("",), (None,)], "id string"), inventory, "id").collect()
    assert sorted((r.id or "", r.n, r.inventory_id) for r in got) == [("", None, None), ("", None, None), ("aBC", 1, "Abc"), ("x", None, None)]
    none = mk([], "source_id string, status string, endpoints long, seeds long")
    policies, identities = mk([], "source_id string, policy_status string, form_confirmed boolean"), mk([], "source_id string, identity_status string, candidate_entrypoint string")
    assert [r.error for r in resolution.resolve_candidates(mk([("a",)], "source_id string"), none, policies, identities).collect()] == ["MISSING_PROBE"]


def test_overlaps_of_hot_keys(spark, monkeypatch):
    """Each pair once with all shared keys, also where a key's pairs are dealt in blocks; a hot key's pairs go to many tasks."""
    from pyspark.sql import functions as F

    from lodestrata.operators import audit

    left = spark.createDataFrame([(i, ["hot", f"l{i % 7}", None]) for i in range(60)] + [(60, []), (61, None), (1, ["hot", "l2"])], "a long, x array<string>")
    right = spark.createDataFrame([(j, ["hot", "hot", f"l{j % 5}"]) for j in range(40)] + [(40, [None]), (41, ["zz"])], "b long, y array<string>")
    keys = {i: {"hot", f"l{i % 7}"} for i in range(60)}
    keys[1].add("l2")
    want = {(i, j, tuple(sorted(ks & {"hot", f"l{j % 5}"}))) for i, ks in keys.items() for j in range(40)}
    for share in (audit.SHARE, 100):
        monkeypatch.setattr(audit, "SHARE", share)
        out = audit.overlap_matches(left, right, "a", "b", "x", "y")
        got = [(r.a, r.b, tuple(r.overlap)) for r in out.collect()]
        assert len(got) == len(want) and set(got) == want
    assert out.groupBy(F.spark_partition_id()).count().count() > 8
    assert audit.overlap_matches(left.limit(0), right, "a", "b", "x", "y").count() == 0
