"""Null ids, repeated rows, null and empty texts, and columns whose names clash, through every operator."""

import numpy as np
import pytest

from lodestrata.llm.decontamination import contaminated, keep_uncontaminated
from lodestrata.llm.embedding_dedup import near_vectors
from lodestrata.llm.lm_scoring import score_texts
from lodestrata.llm.ngram_join import jaccard_groups
from lodestrata.llm.packing import pack_sequences
from lodestrata.llm.quality_classifier import score_quality
from lodestrata.llm.sharding import shard_by_bytes
from lodestrata.llm.substring_dedup import repeated_passages, without_passages
from lodestrata.llm.suffix_dedup import repeated_bytes
from lodestrata.llm.warc import archive_round_trip

LONG = " ".join(f"w{i}" for i in range(120))
ROWS = [(None, LONG), (None, None), (1, LONG), (1, LONG), (2, LONG), (3, None), (4, ""), (4, ""), (5, " \n "), (6, "x" * 5000)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, "a", 1, "b", 2.0) for r in ROWS], "doc_id long, text string, digest string, rep int, key string, size double").repartition(2)


def ids(df):
    return sorted((r[0] is None, r[0] or 0) for r in df.select("doc_id").collect())


EVERY = sorted((r[0] is None, r[0] or 0) for r in ROWS)
ONCE = sorted({x for x in EVERY if not x[0]}) + [x for x in EVERY if x[0]]


def test_row_for_row_operators(odd, spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None)], "doc_id long, quality int")
    for df in (shard_by_bytes(odd), score_texts(odd), score_quality(odd, labels), repeated_bytes(odd)):
        assert ids(df) == EVERY
    assert ids(jaccard_groups(odd)) == ONCE
    assert ids(pack_sequences(odd).where("piece = 0")) == EVERY


def test_repeated_ids_are_one_document(odd):
    got = {r.doc_id: r for r in jaccard_groups(odd).where("doc_id is not null").collect()}
    assert (got[1].n_links, got[2].component_id, got[2].kept) == (1, 1, False)
    assert got[3].n_links == 1 and got[4].component_id == 3 and got[5].n_links == 0
    cut = repeated_bytes(odd).collect()
    assert all(r.n_removed == (len(LONG) if r.doc_id == 2 else 0) for r in cut)
    found = repeated_passages(odd).collect()
    assert [(r.doc_id, r.source_doc_id, r.start, r.end) for r in found] == [(2, 1, 0, 120)]
    assert 2 not in {r.doc_id for r in without_passages(odd, repeated_passages(odd)).collect()}


def test_leaks(odd, spark):
    bench = spark.createDataFrame([(7, LONG[:100], "z"), (7, LONG[:100], "z")], "item_id long, text string, doc_id string")
    assert ids(contaminated(odd, bench)) == [(False, 1), (False, 1), (False, 2), (True, 0)]
    assert keep_uncontaminated(odd, bench).count() == len(ROWS) - 4


def test_pages_and_vectors(spark):
    pages = spark.createDataFrame([(None, "u", "h" * 2000), (1, None, "h" * 2000), (1, "v", "h" * 2000), (2, "v", None)], "page_id long, url string, html string")
    got = sorted((r.page_id is None, r.page_id or 0, r.payload_bytes, r.record_type) for r in archive_round_trip(pages).collect())
    assert got == [(False, 1, 2000, "response"), (False, 1, 2000, "response"), (False, 2, 0, "response"), (True, 0, 2000, "response")]
    v = [float(x) for x in np.arange(1, 9)]
    df = spark.createDataFrame([(None, v, 1), (1, v, 1), (1, v, 1), (2, v, 1), (3, [], 1), (4, v, None)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(df).collect()}
    assert got == {None: (0, None), 1: (1, 1), 2: (1, 1), 3: (0, 3), 4: (0, 4)}


def test_pipeline_of_odd_tables(spark, tmp_path):
    """Null ids, repeated rows, null and empty texts, clashing column names, and no rows at all."""
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long, digest string, part int, length long, key string"
    item = " ".join(f"leak{i}" for i in range(30))
    rows = [*ROWS, (7, f"clean start {item} end"), (8, "a clean text of its own"), (9, None)]
    for name, some in (("odd", rows), ("none", [])):
        d = tmp_path / name
        spark.createDataFrame([(i, t, "en", "s", None, "d", 1, 2, "k") for i, t in some], schema).write.parquet(str(d / "documents.parquet"))
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(d / "labels.parquet"))
        spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(str(d / "benchmark.parquet"))
        got = corpus_pipeline.run(spark, str(d)).collect()
        # no labels: every score is 0.5 and nothing is rejected; 2 repeats 1, whose row occurs twice; 4 and 9 repeat 3; 7 leaks
        ids = sorted((r.doc_id is None, r.doc_id or 0) for r in got if r.piece == 0)
        assert ids == ([(False, 1), (False, 1), (False, 3), (False, 5), (False, 6), (False, 8), (True, 0), (True, 0)] if some else [])


def test_many_documents_of_one_labelled_id(spark):
    """The classifier fits on one row for each id, however many documents share it."""
    from lodestrata.llm import quality_classifier as Q

    docs = spark.createDataFrame([(i % 3 + 1, f"word{i % 7} and more") for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, quality int")
    seen, fit = [], Q.Machine.fit
    try:
        Q.Machine.fit = lambda self, rows, y: seen.append(len(rows)) or fit(self, rows, y)
        Q.train(docs, labels)
    finally:
        Q.Machine.fit = fit
    assert seen[0] <= 3
