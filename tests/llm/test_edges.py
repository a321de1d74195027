"""Nulls, empty and long texts, repeated rows, empty tables and clashing names, for all operators."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tripweave.llm import language, licenses, quality, secrets, urls
from tripweave.llm.decontaminate import drop_leaks, leaks
from tripweave.llm.exact import copies, drop_copies
from tripweave.llm.near import drop_near_copies, near_copies
from tripweave.llm.packing import pack
from tripweave.llm.queries import TOKENIZER, URL_RULES
from tripweave.llm.repeats import remove_repeats

LONG = " ".join(f"word{i}" for i in range(40_000))
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
EXTRA = [
    "id", "digest", "node", "band", "class", "component", "kept", "start", "spans", "words",
    "stats", "gone_id", "gone_digest", "score", "ids",
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        (1, None), (2, ""), (3, " \n"), (4, LONG), (5, "Same text here."), (6, "Same text here."),
        (6, "Same text here."), (None, "Same text here."), (None, None), (7, "é" * 300), (8, "12 34"),
    ]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    return df.withColumns({c: F.lit("x") for c in EXTRA})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(
        [(1, None), (2, ""), (3, "too short"), (None, "a b c d e f"), (5, " ".join(LONG.split()[:40]))],
        "item_id bigint, text string",
    )


def of(df, key="doc_id"):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: (r[key] is None, r[key] or 0))


def test_copies(odd):
    got = {(r["id"], r["copies"], r["keep_id"], r["kept"]) for r in of(copies(odd), "id")}
    assert (6, 4, 6, True) in got and (5, 4, 6, False) in got and (None, 4, 6, False) in got
    assert (1, 3, 2, False) in got and (2, 3, 2, True) in got and (None, 3, 2, False) in got
    left = of(drop_copies(odd))
    assert [r["doc_id"] for r in left] == [2, 3, 4, 6, 6, 7, 8]
    assert left[0]["gone_id"] == "x" and set(left[0]) == set(odd.columns)


def test_near_copies(odd):
    got = {(r["id"], r["n_shingles"], r["component"], r["kept"]) for r in of(near_copies(odd), "id")}
    assert got == {
        (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 39_996, 4, True), (5, 1, 5, True),
        (6, 1, 5, False), (None, 1, None, True), (None, 0, None, True), (7, 1, 7, True),
        (8, 1, 8, True),
    }
    assert [r["doc_id"] for r in of(drop_near_copies(odd))] == [1, 2, 3, 4, 5, 7, 8, None, None]


def test_leaks(odd, items):
    assert [(r["doc_id"], r["item_id"], r["similarity"]) for r in of(leaks(odd, items))] == [(4, 5, 1.0)]
    assert {r["doc_id"] for r in of(drop_leaks(odd, items))} == {None, 1, 2, 3, 5, 6, 7, 8}
    assert leaks(odd, items.limit(0)).count() == 0


def test_rows_that_share_an_id_are_dropped_each_by_itself(spark):
    base, other = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    unique = [" ".join(f"{x}{i}" for i in range(60)) for x in "cdef"]
    item = " ".join(f"q{i}" for i in range(40))
    rows = [
        (1, base), (2, base + " more"), (2, unique[0]), (3, other), (3, other + " more"),
        (4, item), (4, unique[1]), (None, item), (None, unique[2]), (2, unique[3]),
        (5, unique[3] + " more"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    near = [(r["doc_id"], r["text"]) for r in drop_near_copies(docs).collect()]
    assert (1, base) in near and (2, base + " more") not in near and (2, unique[0]) in near
    assert sum(i == 3 for i, _ in near) == 1 and (2, unique[3]) in near
    assert len(near) == len(rows) - 3
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    left = {(r["doc_id"], r["text"]) for r in drop_leaks(docs, items).collect()}
    assert left == set(rows) - {(4, item), (None, item)}


def test_repeats(odd):
    got = of(remove_repeats(odd), "id")
    assert len(got) == odd.count()
    by = {r["id"]: r for r in got}
    assert by[1]["n_bytes"] == 0 and by[1]["kept"] == b""
    assert by[7]["n_bytes"] == 600 and [tuple(s) for s in by[7]["spans"]] == [(2, 600)]


def test_repeated_rows_share_what_goes(spark):
    text = "".join(f"{i:04d}" for i in range(50))
    df = spark.createDataFrame([(2, text), (2, text), (1, "ab" + text[:120])], "doc_id bigint, text string")
    got = of(remove_repeats(df), "id")
    assert [len(r["kept"]) for r in got] == [122, 80, 80]


def test_pack(odd):
    got = of(pack(odd, public_tokenizers.path(TOKENIZER)))
    assert sum(r["length"] for r in got if r["doc_id"] == 1) == 1
    assert len([r for r in got if r["doc_id"] == 6]) >= 2
    assert len([r for r in got if r["doc_id"] == 4]) > 10


def test_scans(odd):
    assert all(r["spans"] == [] for r in of(secrets.scan(odd, secrets.train(odd)), "id"))
    found = of(licenses.find_licenses(odd), "id")
    assert len(found) == odd.count() and all(r["places"] == [] and r["spans"] == [] for r in found)


def test_models_without_labels(odd, empty):
    model = quality.train(odd, empty.select("doc_id", F.lit(1).alias("quality")))
    scored = of(quality.score(odd, model))
    assert {r["score"] for r in scored} == {0.5} and scored[0]["stats"] == "x"
    got = of(language.predict(odd, language.train(odd)), "id")
    assert {(r["lang_pred"], r["score"]) for r in got} == {("und", 0.0)}
    known = language.train(odd.withColumn("lang", F.lit("fr")))
    got = {r["id"]: r["lang_pred"] for r in of(language.predict(odd, known), "id")}
    assert got[1] == got[3] == got[8] == "und" and got[4] == got[7] == "fr"


def test_urls(spark):
    rows = [(1, None, None), (2, "no scheme", ""), (2, "no scheme", ""), (None, "http://a.net/x", None),
            (3, "HTTP://A.Example.COM/de/ü?x://y", "<a href=//b.net/z>")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns(
        {"found": F.lit("x"), "host": F.lit("y"), "scored_host": F.lit("z")}
    )
    got = of(urls.judge(df, URL_RULES), "page_id")
    assert [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"], r["found"]) for r in got] == [
        (1, "", "", None, "allow", "x"), (2, "", "", None, "allow", "x"), (2, "", "", None, "allow", "x"),
        (3, "a.example.com", "/de/ü", "example.com/de/", "block", "x"),
        (None, "a.net", "/x", "net/", "block", "x"),
    ]


def test_empty_tables(spark, empty, items):
    path = public_tokenizers.path(TOKENIZER)
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    for df in (
        copies(empty), drop_copies(empty), near_copies(empty), drop_near_copies(empty),
        leaks(empty, items), drop_leaks(empty, items), remove_repeats(empty), pack(empty, path),
        secrets.scan(empty, secrets.train(empty)), licenses.find_licenses(empty),
        language.predict(empty, language.train(empty)), urls.judge(pages, URL_RULES),
        quality.score(empty, quality.train(empty, empty.select("doc_id", F.lit(1).alias("quality")))),
    ):
        assert df.count() == 0


def test_stages_take_odd_documents(spark, odd, items, tmp_path):
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet")
    )
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == odd.columns, name
        path = str(tmp_path / name)
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
    assert [r["doc_id"] for r in of(docs)] == [2, 3, 6, 6, 7, 8]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() >= 6
