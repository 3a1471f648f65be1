"""Registered queries and the corpus pipeline on the driver's smallest tables."""
import hashlib
import re

import pytest

import __spark_entry__
import corpus_pipeline
from streakflow.llm import decontaminate, toxicity

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    names = __spark_entry__.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("name", ["op5_url_filter", "op6_exact_dedup", "op11_ns_clusters"])
def test_sql_twin(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = __spark_entry__.queries()[name](spark, SF).toPandas()
    want = con.sql(__spark_entry__.oracle_sql()[name]).df()
    columns = sorted(got.columns)
    order = lambda df: df[columns].astype(str).sort_values(columns).reset_index(drop=True)
    assert columns == sorted(want.columns) and order(got).equals(order(want))


def test_native_operators_have_no_python(spark):
    for name in ("op5_url_filter", "op7_decontamination"):
        plan = __spark_entry__.queries()[name](spark, SF)._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|MapInArrow|ArrowEval", plan)


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.fit(docs, labels)
    texts = {r.doc_id: r.text for r in docs.collect()}
    keep = {r.doc_id for r in toxicity.score(docs.select("doc_id", "text"), model).collect() if r.score < 0.5}
    first = {}
    for i in sorted(keep):
        first.setdefault(re.sub(r"[\x20\x09-\x0d]+", " ", texts[i]), i)
    keep = set(first.values())
    sets = {}
    for i in keep:
        words = texts[i].encode().lower().split()
        sets[i] = frozenset(tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()
    root = {i: i for i in keep}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(keep)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            share = len(sets[a] & sets[b])
            if share and 100 * share >= 80 * (len(sets[a]) + len(sets[b]) - share):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    keep = {i for i in keep if find(i) == i}
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    keep -= {r.doc_id for r in decontaminate.leaks(docs, items).collect()}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in got} == keep and len(got) == len(keep) > 50
    assert all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() and r.n_tokens == len(r.token_ids) for r in got)
