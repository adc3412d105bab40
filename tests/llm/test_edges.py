"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns, for every query of the subpackage."""

import pytest

from churnscope.llm.queries import queries
from tests.llm.helpers import SCHEMAS, put

LONG = " ".join(f"word{k % 977}" for k in range(40_000)) + " " + "x" * 3000
TEXTS = [(0, "A plain text of some words, not many."), (1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, "A plain text of some words, not many."),
         (None, "a text without an id"), (None, None), (6, "one"), (6, "one"), (7, "ünï çødé 😀 　 \x1c tail"), (8, "12 34"), (9, "!!! ???"), (10, "line\n\nline\n")]
CLASH = {"n_lines": 1, "score": 2.0, "kept_0": "k", "key": "x", "bucket": 3, "part": 4, "at": 5, "rid": "r", "query": True, "file": 9, "digest": "d", "h": 1, "vid": 2}
DOCUMENT_QUERIES = ["op2_minhash", "op3_quality", "op5_chosen_path", "op7_language", "op9_line_dedup", "op10_bpe", "op13_rules"]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("odd")
    put(spark, folder, "documents", [(i, t, lang, None, 1) for (i, t), lang in zip(TEXTS, ["en", None, "de"] * 9)], CLASH | {"quality": 1})
    put(spark, folder, "benchmark", [(0, "plain words text"), (1, None), (None, "text"), (2, ""), (0, "plain words text")], {"doc_id": 1, "score": 2, "rank": 3})
    put(spark, folder, "labels", [(0, 1, 0), (4, 0, 0), (5, None, 0), (None, 1, 1), (0, 0, 0), (99, 1, 0)], {"text": "t", "h": 1})
    page = "<html><body><nav><a href=x>menu</a></nav><p>Some text, here.</p></body></html>"
    put(spark, folder, "pages", [(1, "u", page), (2, None, page), (3, "u", None), (None, "u", page), (4, "u", ""), (1, "u", page), (5, "u", "<p>" + "a " * 200_000)],
        CLASH | {"text": "t", "doc_id": 1})
    nan, inf = float("nan"), float("inf")
    vectors = [(0, [1.0, 0.0]), (50, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
               (7, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (1, [0.5, 0.5]), (100, [0.0, -1.0]), (150, [0.0, 0.0])]
    put(spark, folder, "embeddings", [(i, v, 0) for i, v in vectors], CLASH)
    return str(folder)


@pytest.mark.parametrize("name", DOCUMENT_QUERIES)
def test_odd_documents(spark, odd, name):
    rows = queries()[name](spark, odd).collect()
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == sorted(i for i, _ in TEXTS if i is not None)
    assert sum(r.doc_id is None for r in rows) == 2
    assert all(v is not None for r in rows for c, v in r.asDict().items() if c not in ("doc_id", "class_id"))


def test_odd_packing(spark, odd):
    rows = queries()["op8_packing"](spark, odd).collect()
    starts = [r for r in rows if r.start == 0]
    assert len(starts) == len(TEXTS)
    assert sum(r.length for r in rows) == sum(r.doc_tokens for r in starts)


def test_odd_pages(spark, odd):
    rows = {(r.page_id, r.url): r for r in queries()["op1_html"](spark, odd).collect()}
    assert len(rows) == 6 and rows[1, "u"].text == "Some text, here." and rows[3, "u"].text == "" and rows[4, "u"].n_chars == 0
    assert rows[5, "u"].n_chars == 399_999
    assert queries()["op1_html"](spark, odd).count() == 7


def test_odd_records(spark, odd):
    assert {r.record_id for r in queries()["op6_fixity"](spark, odd).collect()} <= {1, 2, 3, 4, 5, None}


def test_odd_search(spark, odd):
    rows = queries()["op12_bpa"](spark, odd).collect()
    assert sorted((r["rank"], r.doc_id) for r in rows if r.item_id == 0) == [(1, 0), (1, 0), (2, 5), (2, 5), (3, None), (3, None)]
    assert [(r["rank"], r.doc_id) for r in sorted(rows, key=lambda r: r["rank"]) if r.item_id is None] == [(1, 0), (2, 5), (3, None)]  # one score
    assert not [r for r in rows if r.item_id in (1, 2)]


def test_odd_phrases(spark, odd):
    assert queries()["op11_setm"](spark, odd).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {r.phrase for r in queries()["op11_setm"](spark, odd).collect()} >= {"word0 word1 word2 word3"}


def test_odd_vectors(spark, odd):
    rows = queries()["op4_onebit"](spark, odd).orderBy("query_id", "rank").collect()
    found = {q: [r.vec_id for r in rows if r.query_id == q] for q in (0, 50, 100, 150)}
    assert found == {0: [50, 1, 100], 50: [0, 1, 100], 100: [0, 50, 1], 150: []}
    assert [r.rank for r in rows if r.query_id == 0] == [1, 2, 3]


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    for name in SCHEMAS:
        put(spark, folder, name, [])
    return str(folder)


@pytest.mark.parametrize("name", sorted(queries()))
def test_empty_tables(spark, empty, name):
    assert queries()[name](spark, empty).collect() == []


def test_empty_pipeline(spark, empty, odd):
    import corpus_pipeline

    assert corpus_pipeline.run(spark, empty).collect() == []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, spark.read.parquet(f"{odd}/documents.parquet"), odd).columns == corpus_pipeline.COLUMNS


@pytest.mark.parametrize("name", ["op2_minhash", "op3_quality", "op5_chosen_path", "op7_language", "op8_packing", "op9_line_dedup", "op10_bpe", "op13_rules"])
def test_all_null_texts(spark, tmp_path, name):
    put(spark, tmp_path, "documents", [(k, None, None, None, None) for k in range(3)])
    put(spark, tmp_path, "labels", [])
    assert queries()[name](spark, str(tmp_path)).count() == 3
