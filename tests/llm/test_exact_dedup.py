import hashlib

from brute import ascii_lower
from rows import documents, empty, texts
from staylens.llm.exact_dedup import exact_groups, without_copies


def expected(rows):
    groups: dict = {}
    for d, t, _ in rows:
        groups.setdefault(ascii_lower(t), []).append(d)
    return groups


def test_groups_equal_plain_grouping(spark):
    groups = expected(texts())
    found = exact_groups(documents(spark), block=64).collect()
    assert len(found) == len(texts())
    by_hash = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in found:
        ids = by_hash[r["text_sha256"]]
        best = max((i for i in ids if i is not None), default=None)
        assert (r["keep_id"], r["group_size"]) == (best, len(ids))
    assert sum(r["kept"] for r in found) == len(groups)
    assert all(r["doc_id"] == r["keep_id"] for r in found if r["kept"])


def test_one_row_of_each_text_stays_with_its_columns(spark):
    docs = documents(spark)
    left = without_copies(docs, block=100)
    assert left.columns == docs.columns and left.dtypes == docs.dtypes
    kept = [ascii_lower(r["text"]) for r in left.collect()]
    assert sorted(kept) == sorted(expected(texts()))


def test_blocks_of_any_size_name_alike(spark):
    rows = [(i, "abc" * 700 + ("x" if i % 3 == 0 else "yz"), None) for i in range(12)]
    rows += [(20, "abc" * 700, None), (21, "abc" * 699, None), (22, "abcabc", None)]
    want = sorted((r["doc_id"], r["keep_id"]) for r in exact_groups(documents(spark, rows), block=4096).collect())
    for block in (1000, 7):
        got = sorted((r["doc_id"], r["keep_id"]) for r in exact_groups(documents(spark, rows), block=block).collect())
        assert got == want
    assert dict(want)[0] == 9 and dict(want)[1] == 11 and dict(want)[20] == 20


def test_empty_table(spark):
    assert exact_groups(empty(spark)).count() == 0 and without_copies(empty(spark)).count() == 0


def test_only_native_plans(spark):
    plan = exact_groups(documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
