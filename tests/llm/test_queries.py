"""The registered queries: SQL where there is some, the rest runs; and the pipeline by its parts."""

import oracle
import pytest
from conftest import SF_DIR
from test_operators import brute_similarity

import corpus_pipeline
from tillstream.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", list(SQL))
def test_sql(spark, name):
    problem, _rows, _seconds = oracle.compare(spark, oracle.connect(SF_DIR), QUERIES[name], SQL[name], SF_DIR)
    assert problem is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SQL])
def test_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF_DIR)
        assert kept.columns == docs.columns
        assert 0 < kept.count() <= docs.count(), name
        docs = kept
    done = corpus_pipeline.run(spark, SF_DIR)
    assert {r["doc_id"] for r in done.collect()} == {r["doc_id"] for r in docs.collect()}
    assert done.where("not exact").count() == 0


def brute_pipeline(docs, items, toxic_word):
    """doc_ids that stay, by plain loops: the planted abuse, equal texts, near copies, benchmark items."""
    docs = {i: t for i, t in docs.items() if toxic_word not in t.split()}
    docs = {i: t for i, t in docs.items() if i == max(j for j, u in docs.items() if u.lower() == t.lower())}
    root = {i: i for i in docs}
    for i in docs:
        for j in docs:
            if i < j and brute_similarity(docs[i], docs[j]) >= 0.8 - 1e-9:
                low, high = sorted((root[i], root[j]))
                root = {k: low if r == high else r for k, r in root.items()}
    docs = {i: t for i, t in docs.items() if root[i] == i}
    return {i for i, t in docs.items() if not any(f" {item} " in f" {t} " for item in items)}


def test_pipeline_against_brute_force(spark, tmp_path):
    line = [f"r{k}" for k in range(12)]
    changed = line * 40
    changed[100], changed[300] = "x", "y"
    items = [" ".join(f"q{k}" for k in range(20)), "short question here"]
    docs = {k: " ".join(f"d{k}w{n}" for n in range(60)) for k in range(1, 161)}  # clean ones
    for k in range(101, 161):
        docs[k] = "grumfel " + docs[k]
    docs[201], docs[202] = docs[1], docs[2].upper()  # copies
    docs[203] = docs[3] + " tail"  # a near copy
    docs[204], docs[205] = " ".join(line * 40), " ".join(changed)  # a near copy with repeated lines
    docs[206], docs[207] = f"{docs[4]} {items[0]}", f"some words with a {items[1]} and more"
    for name, rows, schema in (
        ("documents", [(i, t, "en", "web") for i, t in docs.items()], "doc_id long, text string, lang string, source string"),
        ("labels", [(i, int(100 < i < 161)) for i in range(1, 161)], "doc_id long, toxic int"),
        ("benchmark", list(enumerate(items)), "item_id long, text string"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    done = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "exact").collect()
    expected = brute_pipeline(docs, items, "grumfel")
    assert sorted(r["doc_id"] for r in done) == sorted(expected) and all(r["exact"] for r in done)
    assert {5, 100, 201, 202, 204} <= expected and not expected & {1, 2, 101, 203, 205, 206, 207}
