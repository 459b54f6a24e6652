"""Operators 11 to 13 against brute force on small odd tables: nulls, ties, repeated rows, clashing columns, no rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestrata.llm.lexical_search import PROBE, build_index, search
from lodestrata.llm.mixing import apportion, mix_sources
from lodestrata.llm.prefix_trie import prefix_trie, turn_rows, with_shared_start

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ranked(docs, items, k):
    """Rows of (item, rank, doc, score) by scoring every document."""
    terms = [(i, TERM.findall((t or "").translate(UPPER))) for i, t in docs]
    terms = [(i, t) for i, t in terms if t]
    total, words, df = len(terms), sum(len(t) for _, t in terms), Counter(x for _, t in terms for x in set(t))
    out = []
    for item, text in items.items():
        found = []
        for i, t in terms:
            tf, m, score = Counter(t), 25 + (75 * len(t) * total) // words, 0
            for x in TERM.findall((text or "").translate(UPPER)):
                if x in tf:
                    score += math.floor(1000 * math.log((2 * total + 2) / (2 * df[x] + 1))) * ((10**9 * tf[x]) // (1000 * tf[x] + 8 * m))
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def searched(spark, docs, bench, k=10, parts=3):
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, score int, item string").repartition(parts)
    b = spark.createDataFrame([(i, t, "y") for i, t in bench], "item_id long, text string, q string")
    return sorted([tuple(r) for r in search(build_index(d), b, k).collect()], key=str)


def test_search_equals_brute_force(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["Éa", "straße", "A-b", "x_y", "THE", "the"]
    docs = [(i, " ".join(rng.choices(vocabulary, [1 / (j + 1) for j in range(len(vocabulary))], k=rng.choice([1, 3, 20, 200])))) for i in range(300)]
    docs += [(500 + i, docs[7][1]) for i in range(40)]  # copies: equal scores by ascending id
    docs += [(None, docs[7][1]), (None, None), (7, docs[7][1]), (900, ""), (901, "..,"), (902, None), (903, "w1 " * 30000)]
    rng.shuffle(docs)
    bench = [(1, docs[0][1]), (2, "w1 w1 w2 THE the Éa éa"), (3, "nothing known here"), (4, None), (5, "x_y A-b straße"), (5, "x_y A-b straße"), (None, "w3 w4"), (6, next(t for i, t in docs if i == 7))]
    items = {i: t for i, t in bench}
    assert searched(spark, docs, bench) == ranked(docs, items, 10)
    assert searched(spark, docs, bench, 100, parts=2 * PROBE) == ranked(docs, items, 100)


def test_search_without_rows(spark):
    assert searched(spark, [], [(1, "a")]) == [] and searched(spark, [(1, "a")], []) == [] and searched(spark, [(1, None)], [(1, "a")]) == []


def seats(votes, most, n):
    won = {p: 0 for p in votes}
    for _ in range(min(n, sum(most[p] for p in votes if votes[p] > 0))):
        best = min((p for p in votes if votes[p] > 0 and won[p] < most[p]), key=lambda p: (-votes[p] / (2 * won[p] + 1), p))
        won[best] += 1
    return won


def test_apportionment_equals_seat_by_seat(spark):
    rng = random.Random(5)
    cases = {}
    for g in range(25):
        k = rng.choice([1, 2, 7, 30])
        votes = {p: rng.choice([0.0, 1.0, 2.5, float(rng.randrange(1, 1000)), rng.random() * 1e5]) for p in range(k)}
        cases[g] = (votes, {p: rng.choice([0, 1, 5, 100, 10**6]) for p in range(k)}, rng.choice([0, 1, k, 10 * k + 3, 500]))
    df = spark.createDataFrame([(g, p, v[p], m[p], n) for g, (v, m, n) in cases.items() for p in v], "g int, p int, votes double, most long, seats long")
    won = {(r.g, r.p): r.won for r in apportion(df).collect()}
    for g, (v, m, n) in cases.items():
        assert {p: won.get((g, p), 0) for p in v} == seats(v, m, n)


def mixed(spark, rows):
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, source string, text string, size int, rank string").repartition(2)
    return mix_sources(df).collect()


def test_mix(spark):
    rng = random.Random(7)
    rows = [(i, f"s{i % 7}" if i % 7 else None, "w " * rng.choice([0, 1, 50, 400])) for i in range(400)]
    rows += [(None, "big", "w " * 3000), (1, "big", None), (1, "big", "w"), (1, "big", "w"), (2, "", " \n"), (3, "", "one")] + [(1000 + i, "big", "w " * 100) for i in range(300)]
    got = mixed(spark, rows)
    assert sorted((r.doc_id or -1, r.size) for r in got) == sorted((i or -1, len(WORD.findall(t or ""))) for i, _, t in rows)
    total, size, taken, target = sum(r.size for r in got), Counter(), Counter(), {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.passes * r.size + sum(s["to"] - s["from"] for s in r.spans)
        size[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    full, want = set(), {}
    while True:  # reshare by hand
        level = (1.5 * total - sum(2 * size[s] for s in full)) / sum(weight[s] for s in names if s not in full)
        want = {s: 2 * size[s] if s in full else weight[s] * level for s in names}
        over = {s for s in names if want[s] > 2 * size[s]}
        if not over:
            break
        full |= over
    assert all(abs(want[s] - target[s]) < 1e-6 * total for s in names)
    assert all(abs(taken[s] - target[s]) <= 1 + 0.01 * target[s] for s in names)
    assert all(r.source_size == size[r.source] for r in got)
    again = mixed(spark, rows[::-1])
    assert sorted((str(r.doc_id), r.size, r.taken) for r in got) == sorted((str(r.doc_id), r.size, r.taken) for r in again)


def test_mix_of_little(spark):
    assert mixed(spark, []) == []
    assert [r.taken for r in mixed(spark, [(1, "a", None), (2, None, "")])] == [0, 0]
    assert [(r.target, r.taken) for r in mixed(spark, [(1, "a", "w " * 1000)])] == [(1500.0, 1500)]


def trie(rows):
    """The rebuilt conversations' trie, node by node."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    digest = lambda r, t: hashlib.sha256(f"{len(r)}:{r}{t}".encode()).digest()
    own = {c: [(r, t) for *_, r, t in sorted(ts, key=lambda x: (x[0], x[1], digest(x[2], x[3])))] for c, ts in own.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + ts[h:]
    nodes = {}
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(tuple(ts[:d]), set()).add(c)
    out = []
    for key, members in nodes.items():
        below = [k for k in nodes if k[: len(key)] == key]
        childless = [k for k in below if not any(len(x) == len(k) + 1 and x[: len(k)] == k for x in nodes)]
        saved = sum((len(nodes[k]) - 1) * len(WORD.findall(k[-1][1])) for k in below if k)
        ends = ",".join(str(c) for c in sorted(members) if len(built[c]) == len(key))
        parent = min(nodes[key[:-1]]) if key else None
        out.append((min(members), len(key), parent, len(members), sum(len(k) == len(key) + 1 for k in below), len(childless), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def grown(spark, rows):
    df = spark.createDataFrame([(*r, 3, "w") for r in rows], "conv_id long, turn long, role string, text string, depth int, words string").repartition(3)
    return sorted([tuple(r) for r in prefix_trie(with_shared_start(turn_rows(df))).collect()], key=str)


def test_trie_equals_brute_force(spark):
    rng = random.Random(9)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["hi", "hi there", "a b c", None, ""])) for c in range(-45, 160) if c % 13 for t in range(rng.choice([1, 1, 2, 3, 6]))]
    rows += [(200 + c, t, "user", f"same {t}") for c in range(60) for t in range(5)]  # exact copies
    rows += [(300, t, "user", f"long {t}") for t in range(400)]  # one long conversation
    rows += [(None, 1, "user", "x"), (301, None, "user", "a"), (301, None, "user", "b"), (301, 1, None, None), (301, 1, None, None), (302, 5, "user", "b c"), (302, 5, "assistant", "b c")]
    assert grown(spark, rows) == trie(rows)


def test_trie_of_little(spark):
    assert grown(spark, []) == [] and grown(spark, [(None, 1, "user", "x")]) == []
    turnless = [(c, 0, "user", "x") for c in range(1, 40) if zlib.crc32(str(c).encode()) % 4]
    assert grown(spark, turnless[:5]) == trie(turnless[:5])


@pytest.mark.parametrize("n", [1, 2, 5, 64])
@settings(max_examples=30, deadline=None)
@given(st.data())
def test_shard_of_any_lists(n, data):
    """A shard's search against a sort of all its rows, whatever the lists and weights."""
    import numpy as np

    from lodestrata.llm.common import pack
    from lodestrata.llm.lexical_search import Shard, Top

    k = data.draw(st.integers(1, 4))
    lists = [sorted(data.draw(st.dictionaries(st.integers(0, n - 1), st.integers(1, 50), max_size=n)).items(), key=lambda x: (-x[1], x[0])) for _ in range(3)]
    seq, levels, bits = np.array([d for x in lists for d, _ in x], np.uint32), max(1, (n - 1).bit_length()), []
    impact = np.array([f for x in lists for _, f in x], np.uint32)
    for b in range(levels - 1, -1, -1):
        bit = (seq >> np.uint32(b)) & np.uint32(1) > 0
        bits.append(np.packbits(bit))
        seq = np.concatenate([seq[~bit], seq[bit]])
    ids = np.arange(n) * 3
    shard = Shard({"ids": pack(ids, np.zeros(n, np.uint8)), "terms": pack(np.arange(3, dtype=np.uint64), np.array([len(x) for x in lists], np.uint32)), "n_postings": len(impact), "levels": levels, "bits": pack(np.concatenate(bits)), "impacts": pack(impact)})
    weight = np.array([data.draw(st.integers(1, 5)) for _ in range(3)])
    top = Top(k)
    shard.search(np.arange(3), weight, top)
    score = Counter()
    for w, x in zip(weight, lists, strict=True):
        for d, f in x:
            score[int(ids[d])] += int(w) * f
    assert list(zip(top.score.tolist(), top.id.tolist(), strict=True)) == [(s, i) for i, s in sorted(score.items(), key=lambda x: (-x[1], x[0]))[:k]]
