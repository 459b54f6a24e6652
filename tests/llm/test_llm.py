"""The operators against brute force on small tables, with nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest

from lodestrata.llm import registry, substring_dedup
from lodestrata.llm.decontamination import banded_distance, by_q, contaminated, keep_uncontaminated, matches
from lodestrata.llm.embedding_dedup import near_vectors
from lodestrata.llm.lm_scoring import score_texts
from lodestrata.llm.ngram_join import fewest_matches, jaccard_groups
from lodestrata.llm.packing import Encoder, best_fit, bin_completion, completions, lower_bound, pack_sequences
from lodestrata.llm.quality_classifier import keep_quality, score_quality
from lodestrata.llm.sharding import shard_by_bytes
from lodestrata.llm.substring_dedup import chains, repeated_passages, without_passages
from lodestrata.llm.suffix_dedup import repeated_bytes
from lodestrata.llm.warc import archive_round_trip, read_warc

from ..conftest import SF, same

DOCS = "doc_id long, text string, lang string, source string, n_chars long, h string, part int, bucket long, key string"
VOCAB = ["the", "of", "and", "häus", "ñandú", "tion", "erth", "onwh", "stre", "ing", "x", "42", "qué", "ly"]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    prose = lambda k: " ".join("".join(rng.choice(VOCAB) for _ in range(rng.randint(1, 3))) for _ in range(k))
    texts = [prose(rng.randint(1, 160)) for _ in range(n)]
    texts[5] = texts[9] = texts[2]
    near = texts[3].split() or ["a"]
    near[len(near) // 2] = "changed"
    texts[11] = " ".join(near)
    shared = prose(70)
    for i in (14, 20, 33):
        texts[i] = f"{prose(20)} {shared}\n{prose(15)}"
    texts += ["", "   ", None, "one", "One", prose(9000), "", texts[20].upper()]
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None, "s", None if i % 7 == 0 else len(t or ""), "z", 1, 2, "k") for i, t in enumerate(corpus())]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def test_sharding(docs, texts, empty):
    for shards in (16, 3):
        got = shard_by_bytes(docs, shards).collect()
        assert sorted(r.doc_id for r in got) == sorted(texts)
        for r in got:
            data = (texts[r.doc_id] or "").encode()
            assert r["size"] == len(data) + 1 and r.text_crc32 == zlib.crc32(data)
        for k in range(shards):
            assert sorted(r.slot for r in got if r.shard == k) == list(range(sum(r.shard == k for r in got)))
    by_text = {}
    for r in shard_by_bytes(docs, 4).collect():
        by_text.setdefault(texts[r.doc_id] or "", set()).add(r.shard)
    assert all(len(s) == 1 for s in by_text.values())
    assert shard_by_bytes(empty).count() == 0


def test_shards_are_even(spark):
    rows = [(i, "x" * (i % 50)) for i in range(3000)] + [(i, "hot" * 20) for i in range(3000, 4500)]
    got = shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string")).groupBy("shard").sum("size").collect()
    sizes = [r[1] for r in got]
    assert len(sizes) == 16 and max(sizes) < 1.02 * min(sizes)


def test_embeddings(spark):
    rng = np.random.Generator(np.random.PCG64(2))
    base = rng.normal(size=(40, 16))
    rows = [(i, [float(v) for v in base[i]], i % 3) for i in range(40)]
    for i in range(40, 90):
        v = base[i % 8] + rng.normal(0, [0.01, 0.05, 0.06, 0.2][i % 4], 16)
        rows.append((i, [float(x) for x in v], (i % 8) % 3))
    rows += [(90, rows[3][1], rows[3][2]), (91, None, 1), (92, [0.0] * 16, 1), (93, [float("nan")] + [1.0] * 15, 1), (94, [None] + [1.0] * 15, 1), (95, rows[3][1], None), (96, rows[3][1][:8], rows[3][2]), (97, [], 1), (98, [0.0] * 16, 1)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, rep string")
    ok = [r for r in rows if r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    links = {r[0]: set() for r in rows}
    for a in ok:
        for b in ok:
            if a[0] != b[0] and a[2] == b[2] and len(a[1]) == len(b[1]) and np.dot(a[1], b[1]) / np.linalg.norm(a[1]) / np.linalg.norm(b[1]) >= 0.98:
                links[a[0]].add(b[0])

    def root(i):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        return min(seen)

    got = {r.vec_id: r for r in near_vectors(df).collect()}
    assert set(got) == set(links) and sum(map(len, links.values())) > 50
    for i, r in got.items():
        assert (r.n_links, r.component_id, r.kept) == (len(links[i]), root(i), root(i) == i), i
    assert near_vectors(df.limit(0)).count() == 0


def test_embeddings_of_very_small_and_large_components(spark):
    v = [float(x) for x in range(1, 9)]
    rows = [(1, v, 1), (2, [x * 1e-170 for x in v], 1), (3, [x * 1e170 for x in v], 1), (4, [-x for x in v], 1), (5, [x * 1e-300 for x in v[::-1]], 1)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4), 5: (0, 5)}


def test_language_model(docs, texts, empty):
    split = {i: [w.encode() for w in words_of(t)] + [b"\n"] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    c = Counter(w for i, ws in split.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    got = {r.doc_id: r for r in score_texts(docs).collect()}
    assert set(got) == set(texts)
    for i, r in got.items():
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(split[i]), sum(c[w] > 0 for w in split[i]), n)
        assert abs(r.base_score - sum(log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in split[i])) < 1e-6
        assert r.score < 0
    assert score_texts(empty).count() == 0


def test_language_model_prefers_its_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = score_texts(docs).where("held_out").groupBy().sum("score", "n_bytes").first()
    bits = -got[0] * np.log2(10) / got[1]
    assert 1.0 < bits < 4.0
    jumbled = docs.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 5 = 1 then reverse(text) else text end as text")
    worse = score_texts(jumbled).where("held_out").groupBy().sum("score").first()[0]
    assert worse < got[0]


def jaccard(texts):
    sets = {}
    for i, t in texts.items():
        w = words_of(t)
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    links = {i: set() for i in texts}
    for i in texts:
        for j in texts:
            both = len(sets[i] & sets[j])
            if i != j and ((texts[i] or "") == (texts[j] or "") or (both and both >= 0.8 * len(sets[i] | sets[j]))):
                links[i].add(j)
    return links


def reach(links, i):
    seen, todo = {i}, [i]
    while todo:
        for j in links[todo.pop()] - seen:
            seen.add(j)
            todo.append(j)
    return min(seen)


def test_ngram_join(docs, texts, empty):
    links = jaccard(texts)
    got = {r.doc_id: r for r in jaccard_groups(docs).collect()}
    assert set(got) == set(texts)
    for i, r in got.items():
        assert (r.n_links, r.component_id, r.kept) == (len(links[i]), reach(links, i), reach(links, i) == i), i
    assert jaccard_groups(empty).count() == 0


def test_large_group_of_near_copies(spark):
    rng = random.Random(4)
    base = [rng.choice(VOCAB) + str(rng.randint(0, 999)) for _ in range(120)]
    texts = {}
    for i in range(900):
        w = list(base)
        w[rng.randrange(120)] = f"e{i}"
        texts[i] = " ".join(w)
    got = jaccard_groups(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    links = jaccard(texts)
    assert all(r.n_links == len(links[r.doc_id]) and r.component_id == 0 for r in got)


def test_pruning_bound_is_monotone():
    bounds = [fewest_matches(n, 0.8, 1e-6) for n in range(20, 161, 20)]
    assert bounds == sorted(bounds) and bounds[-1] < 0.8 * 160


def test_repeated_bytes(docs, texts, empty):
    first, expected = {}, {}
    for i in sorted(texts):
        b = (texts[i] or "").encode()
        cover, own = bytearray(len(b)), set()
        for p in range(len(b) - 49):
            s = b[p : p + 50]
            if first.get(s, i) < i:
                cover[p : p + 50] = b"\1" * 50
            own.add(s)
        for s in own:
            first.setdefault(s, i)
        kept = bytes(x for x, c in zip(b, cover) if not c)
        expected[i] = (len(b), sum(cover), sum(c and (k == 0 or not cover[k - 1]) for k, c in enumerate(cover)), hashlib.sha256(kept).hexdigest())
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in repeated_bytes(docs).collect()}
    assert got == expected and sum(e[1] for e in expected.values()) > 1000
    assert repeated_bytes(empty).count() == 0


def test_packing(docs, texts, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = {}
    for i, x in texts.items():
        ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, 0], "<u4")
        for k, at in enumerate(range(0, len(ids), 2048)):
            expected[i, k] = (at, len(ids[at : at + 2048]), zlib.crc32(ids[at : at + 2048].tobytes()))
    got = pack_sequences(docs).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == expected
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by) == -(-sum(e[1] for e in expected.values()) // 2048)
    assert pack_sequences(empty).count() == 0


def test_encoder_equals_tokenizer():
    import public_tokenizers

    e = Encoder(public_tokenizers.path("word_bpe_49k.json"))
    odd = ["don't we'LL 'save !'s x²y ½ ªº", "<|endoftext|> <|ENDOFTEXT|>", "Ünïcödé İstanbul ΣΑΣ é", "a b c \x1cd 你好 12345 ﬁ", "‘quoted’ — … x_y__z", "\x85 q \x0bq ǅ ŉ ẞ ſ", ""]
    for x in odd + [t or "" for t in corpus(3)]:
        assert list(e.encode(np.frombuffer(x.encode(), np.uint8), np.array([0, len(x.encode())]))[0]) == e.tokenizer.encode(x, add_special_tokens=False).ids


def test_bin_completion_beats_or_equals_bounds():
    rng = random.Random(0)
    for _ in range(20):
        sizes = Counter(rng.randint(150, 700) for _ in range(60))
        groups = bin_completion(dict(sizes), 1000)
        packed = Counter()
        for filling, times in groups:
            assert sum(s * k for s, k in filling.items()) <= 1000
            for s, k in filling.items():
                packed[s] += k * times
        assert packed == sizes
    groups = bin_completion({6: 1, 5: 1, 4: 1, 3: 2, 2: 1, 7: 1}, 10)  # best fit alone needs more than the volume bound
    assert sum(m for _, m in groups) == 3


def test_bin_completion_of_five_and_more_parts():
    for seed in range(3):
        rng = random.Random(seed)
        sizes = dict(Counter(rng.randint(300, 400) for _ in range(400)))
        groups = bin_completion(sizes, 2048)
        assert sum((Counter({s: k * m for s, k in f.items()}) for f, m in groups), Counter()) == sizes
        assert sum(m for _, m in groups) == lower_bound(sizes, 2048) < sum(m for _, m in best_fit(sizes, 2048))
        sizes = dict(Counter(rng.randint(500, 900) for _ in range(200)))
        assert lower_bound(sizes, 2048) <= sum(m for _, m in bin_completion(sizes, 2048)) < sum(m for _, m in best_fit(sizes, 2048))


def test_fillings_against_all_subsets():
    rng = random.Random(3)
    for _ in range(60):
        items = [rng.randint(2, 12) for _ in range(9)]
        counts, room = dict(Counter(items)), rng.randint(6, 30)
        every = {tuple(sorted((x for k, x in enumerate(items) if m >> k & 1), reverse=True)) for m in range(1 << len(items))}
        every = {f for f in every if sum(f) <= room}
        got = list(completions(room, counts, [10**6]))
        assert len(set(got)) == len(got) and set(got) <= every and [sum(f) for f in got] == sorted((sum(f) for f in got), reverse=True)
        assert sum(got[0]) == max(map(sum, every))

        def covers(g, f):  # the parts of f fit into those of g, each part of g taken as a bin
            return all(len(f) == 0 for f in [f]) or any(covers(g[:k] + (g[k] - f[0],) + g[k + 1 :], f[1:]) for k in range(len(g)) if g[k] >= f[0])

        assert all(any(covers(g, f) for g in got) for f in every)


def test_lower_bound_holds():
    rng = random.Random(4)
    for _ in range(200):
        bins = [rng.sample(range(1, 30), rng.randint(1, 4)) for _ in range(rng.randint(1, 6))]
        cap = max(max(map(sum, bins)), 30)
        assert lower_bound(dict(Counter(x for b in bins for x in b)), cap) <= len(bins)


def test_warc(spark, tmp_path):
    inner = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    big = "<html>" + "ü" * 700 + "</html>"
    rows = [(1, "http://a/1", big), (2, "http://a/2", big), (3, "http://a/\r\n3", inner * 3), (4, None, None), (5, "u", ""), (6, "u", "short"), (7, "u", "short"), (8, "u", big), (9, "u", "y" * 999), (10, "u", "y" * 999), (11, "u", "z" * 1000), (12, "u", "z" * 1000), (13, "u", "tail\r\n\r\n")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string").repartition(2)
    got = {r.page_id: r for r in archive_round_trip(pages, str(tmp_path / "w")).collect()}
    assert set(got) == {r[0] for r in rows}
    for i, _, html in rows:
        data = (html or "").encode()
        copies = [k for k, _, h in rows if h == html and len(data) >= 1000]
        last = max(copies, default=i)
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
        assert (got[i].record_type, got[i].refers_to) == (("response", None) if last == i else ("revisit", last))
    assert read_warc(spark, str(tmp_path / "w")).count() == len(rows)
    assert archive_round_trip(pages.limit(0)).count() == 0


def ascii_upper(s):
    return "".join(chr(ord(c) - 32) if "a" <= c <= "z" else c for c in s)


def edit_to_substring(a, b):
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_banded_distance():
    rng = random.Random(5)
    for _ in range(150):
        a = bytes(rng.choice(b"abcd") for _ in range(30))
        mid = bytearray(a)
        for _ in range(rng.randint(0, 4)):
            k = rng.randrange(len(mid))
            rng.choice([lambda: mid.__delitem__(k), lambda: mid.insert(k, 97), lambda: mid.__setitem__(k, 98)])()
        pre = bytes(rng.choice(b"abcd") for _ in range(rng.randint(0, 12)))
        b = pre + bytes(mid) + b"dddd"
        e, s, t = banded_distance(a, b, 4, len(pre), len(pre))
        true = edit_to_substring(a, b)
        if true <= 4:
            assert e == true and edit_to_substring(a, b[s:t]) == e
        else:
            assert e == 5


def test_decontamination(spark, docs, texts, empty):
    rng = random.Random(6)
    items = {k: " ".join(rng.choice(VOCAB) + rng.choice(VOCAB) for _ in range(25)) for k in range(6)}
    changed = list(items[1])
    for k in range(0, len(changed), 30):
        changed[k] = "#"
    rows = [(1, f"before {ascii_upper(items[0])} after"), (2, "x" + "".join(changed)), (3, items[2][:60]), (4, None), (5, ""), (6, items[3] + " " + items[4]), (7, "clean text of its own")]
    bench = spark.createDataFrame([*items.items(), (8, "of"), (9, None), (None, "x" * 50), (10, "")], "item_id long, text string")
    d = spark.createDataFrame([(*r, "q") for r in rows], "doc_id long, text string, item_id string")
    got = {(r.doc_id, r.item_id): r for r in contaminated(d, bench).collect()}
    with_of = {(i, 8) for i, t in rows if "of" in (t or "").lower()}  # a short item is looked for like any other
    assert with_of and set(got) == {(1, 0), (2, 1), (6, 3), (6, 4)} | with_of and got[1, 0].edits == 0 and got[1, 0].start == 7
    assert got[2, 1].edits == edit_to_substring(items[1].encode(), rows[1][1].encode())
    assert sorted(r.doc_id for r in keep_uncontaminated(d, bench.where("item_id is null or item_id <> 8")).collect()) == [3, 4, 5, 7]
    assert contaminated(docs, bench.limit(0)).count() == 0 and contaminated(empty, bench).count() == 0
    assert [x.q for x in by_q([(1, b"abc"), (2, b""), (3, b"x" * 12), (4, b"x" * 100)], 8, 0.1)] == [3, 6, 8]


def test_decontamination_by_brute_force():
    rng = random.Random(21)
    letters = lambda k, a="abcd ": "".join(rng.choice(a) for _ in range(k))
    items = [letters(k).encode() for k in range(1, 42)] + [letters(k).encode() for k in (60, 75, 98, 150)] + [b"-" * 30, b"ab" * 12]
    texts = [b"", b"a", b"-" * 500, b"ab" * 200 + b"x", *(letters(rng.randint(1, 400), "abcdefgh ").encode() for _ in range(25))]
    for t in items[5:]:
        w = list(t)
        for _ in range(rng.randint(0, len(w) // 10 + 1)):  # some beyond the budget
            at = rng.randrange(len(w))
            w[at : at + rng.randint(0, 1)] = [ord(rng.choice("XYZ"))] * rng.randint(0, 1)
        texts.append(letters(rng.randint(0, 30), "efgh").encode() + bytes(w) + letters(rng.randint(0, 30), "efgh").encode())
    data, off = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    got = {(r, i): (e, s, t) for r, i, e, s, t in matches(data, off, by_q(list(enumerate(items)), 8, 0.1))}
    low = [t.lower() for t in texts]
    want = {(r, i): d for r, t in enumerate(low) for i, x in enumerate(items) if (d := edit_to_substring(x.lower(), t)) <= len(x) // 10}
    assert {k: v[0] for k, v in got.items()} == want and len(want) > 100 and 0 < sum(d > 0 for d in want.values())
    for (r, i), (e, s, t) in got.items():
        assert edit_to_substring(items[i].lower(), low[r][s:t]) == e


def test_decontamination_of_repetitive_texts():
    import tracemalloc

    items = by_q([(1, b"-" * 200), (2, b"-" * 150 + b"the end" * 8), (3, b"ab" * 60)], 8, 0.1)
    data = np.frombuffer(b"-" * 400_000, np.uint8)
    tracemalloc.start()
    got = matches(data, np.array([0, len(data)]), items)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [g[:4] for g in got] == [(0, 1, 0, 0)] and peak < 300 << 20


def test_repeated_passages(docs, texts, empty):
    got = repeated_passages(docs).collect()
    cover = {}
    for r in got:
        assert r.source_doc_id < r.doc_id
        a, b = words_of(texts[r.doc_id])[r.start : r.end], words_of(texts[r.source_doc_id])[r.source_start : r.source_end]
        assert len(a) >= 40 and r.matches >= 0.8 * (r.matches + r.edits) and len(a) - r.matches <= r.edits and len(b) >= r.matches
        cover.setdefault(r.doc_id, set()).update(range(r.start, r.end))
    first = {}
    for i in sorted(texts):
        w, own = words_of(texts[i]), set()
        for k in range(len(w) - 49):
            if first.get(tuple(w[k : k + 50]), i) < i:
                assert set(range(k, k + 50)) <= cover.get(i, set()), i
            own.add(tuple(w[k : k + 50]))
        for s in own:
            first.setdefault(s, i)
    cut = {r.doc_id: r for r in without_passages(docs, repeated_passages(docs)).collect()}
    assert 14 in cut and len(words_of(cut[20].text)) < len(words_of(texts[20])) and cut[20].n_chars == len(cut[20].text) and (len(words_of(texts[9])) < 40 or 9 not in cut)
    assert repeated_passages(empty).count() == 0


@pytest.mark.parametrize("sizes, apart", [((50, 50, 50), (25, 25)), ((45, 45), (25, 25)), ((50,) * 5, (20, 20)), ((50, 50, 50), (25, 12)), ((60, 60), (24, 0))])
def test_passages_between_other_words(spark, sizes, apart):
    rng = random.Random(8)
    prose = lambda k: [f"w{rng.randrange(10**9)}" for _ in range(k)]
    exact, texts, at = [prose(k) for k in sizes], {}, {}
    for doc, gap in enumerate(apart, 1):
        w = prose(7)
        at[doc] = []
        for e in exact:
            at[doc].append(len(w))
            w += e + prose(gap)
        texts[doc] = w
    got = repeated_passages(spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string")).collect()
    cover = {x for r in got for x in range(r.start, r.end)}
    for s, n in zip(at[2], sizes, strict=True):
        assert set(range(s, s + n)) <= cover
    for r in got:
        assert (r.doc_id, r.source_doc_id) == (2, 1) and r.end - r.start >= 40 and r.matches >= 0.8 * (r.matches + r.edits)


def test_passage_whose_halves_have_other_first_holders(spark):
    rng = random.Random(9)
    prose = lambda k: [f"w{rng.randrange(10**9)}" for _ in range(k)]
    x, y, z = prose(30), prose(30), prose(45)
    border = x[-8:] + y[:8]
    texts = [x, y, border, prose(5) + x + y + prose(5), prose(9) + border, prose(3) + x + y + prose(9), x + prose(3), z, prose(20) + z + prose(20) + z, z + prose(50) + x[10:] + y[:20]]
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
    got = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    cover = {}
    for r in got:
        cover.setdefault(r.doc_id, set()).update(range(r.start, r.end))
    assert set(range(3, 63)) <= cover[5] and 3 not in cover and 4 not in cover and 6 not in cover
    assert set(range(20, 65)) | set(range(85, 130)) <= cover[8] and set(range(45)) | set(range(95, 135)) <= cover[9]


def test_passages_do_not_depend_on_the_layout(spark, monkeypatch):
    rng = random.Random(12)
    prose = lambda k: [f"w{rng.randrange(10**9)}" for _ in range(k)]
    a, b, x = prose(34), prose(34), prose(60)
    texts = {1: a + prose(9), 2: prose(4) + b, 3: a + b, 4: prose(7) + a + b, 5: a, 6: b + prose(3) + a + b}
    texts |= {k: prose(k % 5) + x + prose(3) for k in range(10, 18)} | {100_000 * k: x + prose(k) for k in range(1, 5)}
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string")
    layouts = [df.coalesce(1), df.repartitionByRange(2, "doc_id"), df.repartition(4)]
    found = [sorted(map(tuple, repeated_passages(d).collect())) for d in layouts]
    monkeypatch.setattr(substring_dedup, "HOT", 2)  # every repeated seed of a task's share goes by block of ids
    found += [sorted(map(tuple, repeated_passages(d).collect())) for d in layouts]
    assert all(f == found[0] for f in found)
    cover = {}
    for doc, start, end, src, *_ in found[0]:
        cover.setdefault(doc, {}).setdefault(src, set()).update(range(start, end))
    assert set(range(7, 75)) <= cover[4][3] and set(range(37, 105)) <= set().union(*cover[6].values())
    assert {d: set(s) for d, s in cover.items() if 10 <= d < 18} == {k: {10, k - 1} for k in range(11, 18)}
    assert all(set(range(60)) <= cover[100_000 * k][10] for k in range(1, 5))


def test_passage_whose_source_is_not_the_first_holder_of_a_seed_nor_the_one_before(spark, monkeypatch):
    rng = random.Random(21)
    prose = lambda k: [f"w{rng.randrange(10**9)}" for _ in range(k)]
    changed = lambda w, at: [f"c{rng.randrange(10**9)}" if k in at else x for k, x in enumerate(w)]
    phrase, other, left, right = prose(12), prose(12), prose(17), prose(17)
    passage = left + phrase + right
    texts = {k: prose(50) + phrase + prose(50 + k) for k in range(0, 60, 2)}
    texts |= {k: prose(50) + other + prose(50 + k) for k in range(200, 260, 2)}
    edits = {1, 6, 11, 16, 30, 35, 40, 45}  # no seed but in the phrase
    texts |= {21: prose(9) + passage + prose(9), 41: prose(3) + changed(passage, edits) + prose(9), 45: prose(11) + changed(passage, edits) + prose(2)}
    texts |= {51: prose(7) + passage[3:], 53: passage + prose(20)}
    run = prose(15) + other + prose(15)  # an equal run of less than 50 words
    texts |= {221: prose(30) + run + prose(30), 241: prose(20) + run + prose(40), 251: prose(40) + run + prose(20)}
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string").repartition(3)

    def sources():
        cover = {}
        for r in repeated_passages(df).collect():
            cover.setdefault((r.doc_id, r.source_doc_id), set()).update(range(r.start, r.end))
        return cover

    plain = sources()
    assert set(plain) == {(41, 21), (45, 21), (45, 41), *((51, k) for k in (21, 41, 45)), *((53, k) for k in (21, 41, 45, 51)), (241, 221), (251, 221), (251, 241)}
    assert set(range(5, 48)) <= plain[41, 21] and set(range(20, 62)) <= plain[241, 221] and set(range(40, 82)) <= plain[251, 221]
    monkeypatch.setattr(substring_dedup, "HOT", 2)
    assert sources() == plain
    monkeypatch.setattr(substring_dedup, "HEAVY", 5)  # the holders of a seed are dealt by pairs of groups
    assert sources() == plain


def test_meetings_against_all_pairs():
    rng = np.random.default_rng(5)
    before, min_words, need, slack = 34, 40, 32, 16
    seed, place = rng.integers(2, 60000, 6), before + slack
    base = rng.integers(2, 60000, 130)
    rows = []
    for k in range(160):
        text = (base if k % 3 else rng.integers(2, 60000, 130)).copy()
        text[place + 10 : place + 16] = seed
        cut, spots = rng.integers(0, 12), rng.integers(0, 130, rng.integers(0, 40))
        if k % 5:  # k % 5 == 0: equal but for the ends
            spots = spots[(spots < place + 10) | (spots >= place + 16)]
            text[spots] = rng.integers(2, 60000, len(spots))
        around = list(text[10:])
        if k % 7 == 0:  # a word more on the left
            around = [*around[1 : place - 5], 9, *around[place - 5 :]]
        around = np.array(around[: 2 * slack + before + min_words])
        around[:cut] = 0
        rows.append(around)
    around = np.array(rows, np.uint16)
    doc = rng.permutation(len(rows)).astype(np.int64)
    n = len(rows)
    zero = np.zeros(n, np.int64)
    got = substring_dedup.meetings(np.ones(n, np.uint64), zero, zero + substring_dedup.BOTH, doc, zero.astype(np.uint32), around, min_words, need, slack)
    links = set(zip(got[0].tolist(), got[2].tolist(), strict=True))
    narrow, source = around[:, slack:-slack], np.where(around > 0, around, 1).astype(np.uint16)
    at, wanted, first = np.argsort(doc), 0, {}
    class_of = [first.setdefault(narrow[a].tobytes(), i) for i, a in enumerate(at)]  # equal words: the first stands for all
    assert all(c == i or (i, c) in links for i, c in enumerate(class_of)) and len(first) < n

    def reach(a, b):
        same = (narrow[a] == source[b][slack:-slack]).tolist() + [False]
        l, r = (([*s, False]).index(False) for s in (same[:before][::-1], same[min_words:]))
        return l, r

    for i in range(n):
        for j in range(i):
            a, b = at[i], at[j]
            equal = [np.r_[narrow[a][:before] == source[b][slack + shift :][:before], narrow[a][before:] == source[b][slack + before :][:min_words]] for shift in (0, -1, 1)]
            if not any(np.convolve(e, np.ones(min_words, int), "valid").max() >= need + (k > 0) for k, e in enumerate(equal)):
                continue
            wanted += 1
            if class_of[i] != i or class_of[j] != j:
                continue
            l, r = reach(a, b)
            held = l + r >= before and any((i, k) in links and reach(a, at[k])[0] >= l and reach(a, at[k])[1] >= r for k in range(j + 1))
            assert (i, j) in links or held, (i, j)
    assert wanted > 500 and links and all(a > b for a, b in links)


def test_meetings_of_many_holders_are_those_of_all_pairs(monkeypatch):
    rng = np.random.default_rng(8)
    before, min_words, need, slack, n = 34, 40, 32, 16, 800
    place, size = before + slack, 2 * slack + before + min_words
    around = rng.integers(2, 4000, (n, size)).astype(np.uint16)
    around[:, ::9] = 7  # a frequent word
    for k in range(0, n, 40):  # near copies of one text, some with words more or less
        around[k] = around[0]
        spots = rng.integers(0, size, rng.integers(5, 30))
        around[k, spots] = rng.integers(2, 4000, len(spots))
        if k % 3 == 0:
            around[k, place + 9 :] = np.r_[around[k, place + 10 :], 5]
    around[:, place : place + 6] = np.arange(10, 16)
    zero = np.zeros(n, np.int64)
    args = (np.ones(n, np.uint64), zero, zero + substring_dedup.BOTH, rng.permutation(n).astype(np.int64), zero.astype(np.uint32), around, min_words, need, slack)
    links = lambda *asks: {(a, b) for a, _, b, _ in zip(*(x.tolist() for x in substring_dedup.meetings(*args, *asks)), strict=True)}
    every = links()
    order = np.argsort(args[3])
    tried = sum(len(a) for a, _ in substring_dedup.gram_pairs(around[order][:, slack:-slack], around[order], np.ones(n, bool), min_words, need))
    asks = rng.random(n) < 0.3
    some = links(asks)
    monkeypatch.setattr(substring_dedup, "CROWDED", 1 << 30)  # each with each
    assert every == links() and len(every) > 50 and tried < n * (n - 1) // 8
    assert some == {(a, b) for a, b in links() if asks[args[3] == a][0]} == links(asks)


def test_meetings_in_runs_of_one_word_try_few_alignments(monkeypatch):
    rng = np.random.default_rng(3)
    before, min_words, need, slack, n = 34, 40, 32, 16, 900
    place, size = before + slack, 2 * slack + before + min_words
    around = np.full((n, size), 7, np.uint16)
    for k in range(n):  # a run of one word between others, some of them again and again
        left, right = rng.integers(0, 60, 2)
        around[k, : max(0, place - left)] = rng.integers(100, 4000) if k % 2 else rng.integers(100, 4000, max(0, place - left))
        around[k, place + 6 + right :] = rng.integers(100, 4000) if k % 3 else rng.integers(100, 4000, max(0, size - place - 6 - right))
        around[k, : 8 * (k % 7 == 0)] = 0
        spots = rng.integers(0, size, k % 6)
        spots = spots[(spots < place) | (spots >= place + 6)]
        around[k, spots] = rng.integers(100, 110, len(spots))
    zero = np.zeros(n, np.int64)
    args = (np.ones(n, np.uint64), zero, zero + substring_dedup.BOTH, rng.permutation(n).astype(np.int64), zero.astype(np.uint32), around, min_words, need, slack)
    links = lambda: set(zip(*(x.tolist() for x in substring_dedup.meetings(*args)), strict=True))
    aligned, plain = [], substring_dedup.cost_beside
    monkeypatch.setattr(substring_dedup, "cost_beside", lambda x, *more: aligned.append(len(x)) or plain(x, *more))
    few = links()
    tried = sum(aligned)
    monkeypatch.setattr(substring_dedup, "CROWDED", 1 << 30)  # each with each
    assert few == links() and len(few) > 1000
    assert tried * 5 < sum(aligned) - tried


def test_holders_of_a_seed_dealt_by_shares(spark, monkeypatch):
    rng = random.Random(11)
    prose = lambda k: [f"w{rng.randrange(10**9)}" for _ in range(k)]
    base, texts = prose(90), {}
    for k in range(40):
        texts[k] = [w if rng.random() > 0.08 else f"c{rng.randrange(10**9)}" for w in base] if k % 2 else prose(20) + ["the"] * rng.randrange(30, 60) + prose(20)
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string").repartition(3)
    found = lambda every: sorted(map(tuple, repeated_passages(df, every_source=every).collect()))
    plain = [found(every) for every in (True, False)]
    monkeypatch.setattr(substring_dedup, "SHARE", 5)  # each task compares a share of the holders with all of them
    assert [found(every) for every in (True, False)] == plain and len(plain[0]) > len(plain[1]) > 20


def test_passages_without_every_source_hold_the_same_words(spark):
    rng = random.Random(4)
    prose = lambda k: [f"w{rng.randrange(10**9)}" for _ in range(k)]
    base, phrase, n = prose(90), prose(12), 80
    texts = {}
    for k in range(n):  # near copies, all different
        texts[k] = [w if rng.random() > 0.05 else f"c{rng.randrange(10**9)}" for w in base] + prose(k % 3)
    passage = prose(17) + phrase + prose(17)
    texts |= {n + k: prose(50) + phrase + prose(60) for k in range(20)}
    at = {1, 6, 11, 16, 30, 35, 40, 45}  # no seed but in the phrase; its source is neither the first holder nor the one before
    texts |= {n + 30: prose(9) + passage + prose(9), n + 35: prose(50) + phrase + prose(60), n + 40: prose(4) + [f"d{k}" if k in at else w for k, w in enumerate(passage)] + prose(9)}
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string").repartition(3)

    def cover(rows):
        words = {}
        for r in rows:
            words.setdefault(r.doc_id, set()).update(range(r.start, r.end))
        return words

    every, few = repeated_passages(df).collect(), repeated_passages(df, every_source=False).collect()
    assert cover(few) == cover(every) and n + 40 in cover(few)
    assert len(every) > n * n // 3 and len(few) < 4 * n
    pairs = {(r.doc_id, r.source_doc_id) for r in every}
    assert {(r.doc_id, r.source_doc_id) for r in few} <= pairs


def test_repetitive_texts(spark):
    line = "one two three four five six seven "
    rows = [(1, line * 40), (2, "x " + line * 3000), (3, "ha " * 20000), (4, "ha " * 30000)]
    cover = {}
    for r in repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        cover.setdefault(r.doc_id, set()).update(range(r.start, r.end))
    assert len(cover[2]) >= 7 * 3000 - 20 and len(cover[4]) >= 29_900 and set(cover) == {2, 4}


def test_changed_passages(spark):
    rng = random.Random(10)
    prose = lambda k: [f"w{rng.randrange(10**9)}" for _ in range(k)]
    changed = lambda w, at: [f"c{rng.randrange(10**9)}" if k in at else x for k, x in enumerate(w)]
    rows, places = [], [set(range(13, 49, 6)), *({i, j} for i in range(1, 39, 4) for j in range(i + 1, 39, 4))]
    for k, at in enumerate(places):
        w = prose(49 if k == 0 else 40)
        rows += [(2 * k, " ".join(prose(5) + w + prose(5))), (2 * k + 1, " ".join(prose(9) + changed(w, at) + prose(9)))]
    got = {r.doc_id: r for r in repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, at in enumerate(places):
        r = got[2 * k + 1]
        assert (r.start, r.end, r.source_doc_id, r.edits) == (9, 58 if k == 0 else 49, 2 * k, len(at))


def test_vectors_without_an_id_stay_rows(spark):
    rows = [(None, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (None, [0.0, 1.0], 2), (None, None, None), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], 1)]
    got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in got) == [(0, 0, 0, True)] * 4 + [(3, 1, 3, True), (4, 1, 3, False)]


def test_chains_follow_both_texts():
    assert chains([0, 20, 40], [0, 22, 42], [15, 15, 15]) == [[0, 1, 2]]
    assert sorted(map(sorted, chains([0, 20], [50, 0], [15, 15]))) == [[0], [1]]
    assert len(chains([0, 200], [0, 200], [15, 15])) == 2


def test_quality(spark, docs, empty):
    sf = "/root/testdata/sf0.01"
    d, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = score_quality(d, labels)
    rows = got.join(labels, "doc_id").where("held_out").select("predicted", "quality", "score").collect()
    assert got.count() == d.count() and len(rows) > 50
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.9
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.88
    some = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, None, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    odd = score_quality(docs, some).collect()
    assert len(odd) == docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert all(abs(r.score - 0.5) < 0.1 for r in score_quality(docs, some.limit(0)).collect())
    assert score_quality(empty, some).count() == 0
    assert keep_quality(docs, some).columns == docs.columns


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_equals_sql(spark, duck, name):
    same(registry.QUERIES[name](spark, SF), duck, registry.SQL[name])


def test_pipeline(spark):
    import corpus_pipeline as P

    source = spark.read.parquet(f"{SF}/documents.parquet")
    labels, kept = spark.read.parquet(f"{SF}/labels.parquet"), source
    stage = {name: f for name, f in P.STAGES}
    assert list(stage) == ["quality", "near_duplicates", "passages", "leaks", "packing"]
    good = stage["quality"](spark, kept, SF).cache()
    scored = {r.doc_id: r.predicted for r in score_quality(kept, labels).collect()}
    assert {r.doc_id for r in good.collect()} == {i for i, p in scored.items() if p}
    few = stage["near_duplicates"](spark, good, SF).cache()
    links = jaccard({r.doc_id: r.text for r in good.collect()})
    assert {r.doc_id for r in few.collect()} == {i for i in links if reach(links, i) == i}
    cut = stage["passages"](spark, few, SF).cache()
    assert cut.columns == source.columns and cut.count() <= few.count()
    clean = stage["leaks"](spark, cut, SF).cache()
    items = [r.text.lower() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    held = {r.doc_id for r in cut.collect() if any(t in r.text.lower() for t in items)}
    assert {r.doc_id for r in clean.collect()} <= {r.doc_id for r in cut.collect()} - held
    packed = stage["packing"](spark, clean, SF)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in clean.collect()}
    assert P.run(spark, SF).count() == packed.count()
