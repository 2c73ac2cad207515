"""Filtering operators keep all columns of a document, whatever their names and types."""

import pytest

import corpus_pipeline
from snapmill.llm import common
from snapmill.llm.decontam import drop_contaminated
from snapmill.llm.exact import drop_exact_copies
from snapmill.llm.langid import drop_unknown_languages
from snapmill.llm.lines import drop_repeated_lines
from snapmill.llm.simhash import drop_near_duplicates

NAMES = ["__n", "__id", "__own", "__key", "__found", "__sha", "__digest", "key", "document", "found", "stays", "text_hash", "a.b", "root"]
TEXTS = {
    1: "the quick brown fox jumps over the lazy dog and runs far away from here today",
    2: "the quick brown fox jumps over the lazy dog and runs far away from here today",
    3: None,
    4: "",
    5: " \n",
    6: "some words that belong to the benchmark and to nothing else in the whole wide world at all",
    None: "a text whose row has no id but some words",
}


@pytest.fixture
def docs(spark):
    """One row twice, once with other columns, beside copies, empty texts and a null id."""
    schema = ", ".join(["doc_id long", "text string", "lang string", "extra map<string,int>", "many array<struct<x: int>>", *(f"`{n}` string" for n in NAMES)])
    rows = [(i, t, "en", {"x": i or 0}, [(i,)], *(f"{n} of {i}" for n in NAMES)) for i, t in TEXTS.items()]
    rows += [rows[0], (*rows[0][:3], {"x": 99}, None, *(None for _ in NAMES))]
    return spark.createDataFrame(rows, schema)


OPERATORS = {
    "languages": (lambda spark, df: drop_unknown_languages(df), {1, 2, 6, None}),
    "copies": (lambda spark, df: drop_exact_copies(df), {1, 5, 6, None}),
    "near": (lambda spark, df: drop_near_duplicates(df), {1, 3, 6, None}),
    "contaminated": (lambda spark, df: drop_contaminated(df, spark.createDataFrame([(9, TEXTS[6])], "item_id long, text string")), set(TEXTS) - {6}),
    "lines": (lambda spark, df: drop_repeated_lines(df), set(TEXTS)),
}


@pytest.mark.parametrize("limit", [1_000_000, 0], ids=["broadcast", "shuffled"])
@pytest.mark.parametrize("name", OPERATORS)
def test_columns_come_back(spark, docs, name, limit, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_KEYS", limit)
    apply, ids = OPERATORS[name]
    kept = apply(spark, docs)
    assert kept.schema.names == docs.schema.names and [f.dataType for f in kept.schema] == [f.dataType for f in docs.schema]
    rows = kept.collect()
    assert {r.doc_id for r in rows} == ids
    given = {repr(r) for r in docs.collect()}
    assert all(repr(r) in given for r in rows if r.text) or name == "lines"
    for r in rows:
        if r["__n"] is not None:
            assert [r[n] for n in NAMES] == [f"{n} of {r.doc_id}" for n in NAMES] and r.extra == {"x": r.doc_id or 0}
    if name in ("copies", "near"):
        assert len(rows) == len(ids)  # of repeated rows one stays


def test_stages_keep_the_columns(spark, docs, tmp_path):
    spark.createDataFrame([(9, TEXTS[6])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns, name


def test_a_row_repeated_very_often_is_combined_where_it_is(spark, docs):
    plan = drop_exact_copies(docs)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan


def test_shared_paths_go_at_exit(spark, monkeypatch):
    registered = []
    monkeypatch.setattr(common.atexit, "register", lambda *a: registered.append(a))
    path = common.shared_path(spark, "x")
    assert (common.remove_folder, spark, path) in registered
