import random

import pytest
from pyspark.sql import functions as F

from lodestrata.operators.scan import lagged, large_keys, numbered, ranked_variants, running, since


@pytest.mark.parametrize("limit", [None, 50, 0])
def test_running_equals_a_loop(spark, limit):
    """One key holds most rows; null keys, null values and ties in order; ranges at work (small limits) or not."""
    rng = random.Random(1)
    rows = [(rng.choice(["hot"] * 8 + ["a", "b", None]), i // 2, i, rng.choice([None, *range(-5, 50)])) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, t long, i long, v long").repartition(5)
    df = spark.createDataFrame(df.rdd, df.schema)
    got = running(df, ["k"], ["t", "i"], {"s": ("sum", "v"), "m": ("max", "v"), "n": ("min", "v"), "x": ("bit_xor", "v")}, limit=limit).collect()
    want, state = {}, {}
    for k, t, i, v in sorted(rows, key=lambda r: (r[1], r[2])):
        s = state.get(k, (None,) * 4)
        if v is not None:
            s = (v,) * 4 if s[0] is None else (s[0] + v, max(s[1], v), min(s[2], v), s[3] ^ v)
        state[k] = want[i] = s
    assert {r.i: (r.s, r.m, r.n, r.x) for r in got} == want


@pytest.mark.parametrize("limit", [None, 100])
def test_numbered_without_key(spark, limit):
    df = spark.range(3000).selectExpr("id * 7919 % 3001 AS x")
    got = numbered(df, [], ["x"], "place", limit=limit).collect()
    assert [r.place for r in sorted(got, key=lambda r: r.x)] == list(range(1, 3001))


def test_large_keys(spark):
    df = spark.range(1000).selectExpr("CASE WHEN id < 600 THEN NULL ELSE id END AS k")
    assert [(r["k"], r["__n"]) for r in large_keys(df, ["k"], 10)] == [(None, 600)]
    assert large_keys(df, ["k"]) == [] and large_keys(df, [], 10)[0]["__n"] == 1000


@pytest.mark.parametrize("limit", [10**9, 40])
def test_since_lagged_and_variants(spark, limit):
    rng = random.Random(4)
    rows = [(rng.choice(["hot"] * 6 + ["a", None]), i, rng.choice(["F", "C", "N", None]), rng.randrange(40)) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, i long, s string, v long").repartition(4)
    df = spark.createDataFrame(df.rdd, df.schema)
    large = large_keys(df, ["k"], limit)
    failed = F.col("s") == "F"
    out = since(df, ["k"], ["i"], failed, ~failed, "n", large=large)
    out = lagged(out, ["k"], ["i"], "v", "w", 3, large=large)
    got = {r.i: (r.n, r.w, r.place) for r in ranked_variants(out, ["k"], ["v"], ["i"], "place", limit=limit).collect()}
    n, last, seen, want = {}, {}, {}, {}
    for k, i, s, v in rows:
        n[k] = n.get(k, 0) + 1 if s == "F" else 0 if s else n.get(k, 0)
        last.setdefault(k, []).append(v)
        place = seen.setdefault(k, {}).setdefault(v, len(seen[k]) + 1)
        want[i] = (n[k], last[k][-4] if len(last[k]) > 3 else None, place)
    assert got == want


def test_one_source(spark, monkeypatch):
    """Health, cadence, yield and admission of a table with one source, scanned in ranges: as in one window."""
    from lodestrata.operators import frontier, scan, state

    runs = spark.range(600).selectExpr("1 AS source_id", "id AS run_id", "timestamp_seconds(id * 3600) AS ts", "element_at(array('FAILED', 'NO_CHANGE', 'CHANGED', 'NO_CHANGE'), cast(pow(id, 2) % 29 % 4 + 1 AS int)) AS status", "cast(id * id % 5 % 2 AS int) AS new")
    links = spark.range(600).selectExpr("1 AS source_id", "id AS ord", "concat('https://a.org/p', id % 200, CASE WHEN id % 3 = 0 THEN concat('?q=', id % 77) ELSE '' END) AS url", "0 AS depth")
    hosts = spark.createDataFrame([(1, "a.org")], "source_id int, host string")

    def results():
        out = [state.after_run(runs), state.pagination_yield(runs, "source_id", ["ts", "run_id"], "new"), frontier.admit(links, hosts, max_urls=100, max_variants=2)]
        return [sorted(map(str, df.select(sorted(df.columns)).collect())) for df in out]

    plain = results()
    monkeypatch.setattr(scan, "LEAST", 50)
    assert scan.large_keys(runs, ["source_id"])
    assert results() == plain
