"""The registered training-data queries and the pipeline on the smallest tables."""

import corpus_pipeline
import __spark_entry__ as driver
from brute import ascii_lower, jaccard_components
from compare import connect, difference
from staylens.llm import queries
from staylens.llm.mixing import mixed
from staylens.llm.store import written

FOLDER = "/root/testdata/sf0.001"


def test_queries_equal_their_sql(spark):
    con = connect(FOLDER)
    assert set(queries.QUERIES) <= set(driver.queries()) and len(queries.QUERIES) == 13
    found = {n: difference(queries.QUERIES[n](spark, FOLDER), con, sql) for n, sql in queries.SQL.items()}
    assert found == dict.fromkeys(queries.SQL)


def test_stages_of_the_pipeline(spark):
    docs = queries.table(spark, FOLDER, "documents")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = written(stage(spark, docs, FOLDER))
        assert after.columns == docs.columns
        rows = [(r["doc_id"], r["text"]) for r in after.collect()]
        assert {d for d, _ in rows} <= set(before) and all(before[d] == t for d, t in rows)
        if name == "quality":
            kept = {r["doc_id"] for r in queries.op3(spark, FOLDER).where("predicted = 1").collect()}
            assert {d for d, _ in rows} == kept
        elif name == "exact":
            largest: dict = {}
            for d, t in before.items():
                key = ascii_lower(t)
                largest[key] = max(d, largest.get(key, d))
            assert sorted(d for d, _ in rows) == sorted(largest.values())
        elif name == "near":
            want = [d for d, _, first in jaccard_components(list(before.items()), 5, 80) if d == first]
            assert sorted(d for d, _ in rows) == sorted(want)
        elif name == "mix":
            copies = {r["doc_id"]: r["copies"] for r in mixed(docs).collect()}
            assert sorted(d for d, _ in rows) == sorted(d for d, n in copies.items() for _ in range(n))
        docs, before = after, dict(rows)
        multiset = rows
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert sum(r["piece"] == 0 for r in pieces) == len(multiset)
    fill: dict = {}
    for r in pieces:
        fill[r["sequence_id"]] = fill.get(r["sequence_id"], 0) + r["length"]
    assert max(fill.values()) <= 2048 and len(fill) <= 1.05 * sum(fill.values()) / 2048 + 1
    assert corpus_pipeline.ORACLE_SQL is None
