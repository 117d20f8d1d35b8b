import random

import pytest

from brute import jaccard_components
from rows import documents, empty, texts
from staylens.llm import jaccard_join
from staylens.llm.jaccard_join import Rule, jaccard_groups, without_near_copies


def ordered(rows):
    return sorted(rows, key=repr)


def found(docs, words, percent):
    return ordered(tuple(r) for r in jaccard_groups(docs, words=words, percent=percent).collect())


@pytest.mark.parametrize("words, percent", [(3, 90), (5, 80)])
def test_components_equal_all_pairs(spark, words, percent):
    rows = [(d, t) for d, t, _ in texts()]
    assert found(documents(spark), words, percent) == ordered(jaccard_components(rows, words, percent))


def test_pages_and_chains(spark, monkeypatch):
    """Chains that no pivot spans, over many small pages."""
    monkeypatch.setattr(jaccard_join, "PAGE_SHINGLES", 900)
    rnd = random.Random(4)
    rows, text = [], [f"w{rnd.randrange(500)}" for _ in range(120)]
    for i in range(150):
        text = list(text)
        text[rnd.randrange(120)] = f"c{i}"
        rows.append((i, " ".join(text), None))
    want = ordered(jaccard_components([r[:2] for r in rows], 3, 90))
    assert found(documents(spark, rows), 3, 90) == want


def test_parts_never_lose_a_pair():
    """Any two sets that link share the name of a part."""
    import numpy as np

    rnd = np.random.default_rng(6)
    for percent in (80, 90):
        rule = Rule(3, percent)
        for _ in range(400):
            size = int(rnd.integers(1, 400))
            a = rnd.integers(0, 1 << 63, size, dtype=np.uint64)
            b = a[: size - int(rnd.integers(0, 1 + size // 8))]
            b = np.append(b, rnd.integers(0, 1 << 63, int(rnd.integers(0, 1 + size // 8)), dtype=np.uint64))
            a, b = np.unique(a), np.unique(b)
            both = len(np.intersect1d(a, b))
            if len(b) and rule.links(both, len(a), len(b)) and not (len(a) == len(b) == both):
                mine, other = ([(set(x.tolist()), n) for x, n in jaccard_join.part_keys(s, rule)] for s in (a, b))
                # in the range of the larger set, both share as many parts as either needs
                assert any(len(x & y) >= max(n, m) for x, n in mine for y, m in other)


def test_one_document_of_each_component_stays(spark):
    docs = documents(spark)
    left = without_near_copies(docs, words=3, percent=90)
    assert left.dtypes == docs.dtypes
    rows = [(d, t) for d, t, _ in texts()]
    want = ordered(d for d, _, first in jaccard_components(rows, 3, 90) if d == first)
    assert ordered(r["doc_id"] for r in left.collect()) == want


def test_near_copies_with_one_id(spark):
    """Near copies that share an id, or have none, leave one document."""
    text = " ".join(f"w{i}" for i in range(200))
    other = " ".join(f"v{i}" for i in range(200))
    rows = [(1, text, "a"), (1, text + " x", "a"), (2, text + " y", "a"), (None, other, "a"), (None, other + " x", "a")]
    left = without_near_copies(documents(spark, rows), words=3, percent=90).collect()
    assert ordered(r["doc_id"] for r in left) == ordered([1, None])


def test_empty_table(spark):
    assert jaccard_groups(empty(spark)).count() == 0 and without_near_copies(empty(spark)).count() == 0
