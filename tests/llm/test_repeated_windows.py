import random

import numpy as np
import pytest

from brute import repeated_windows
from rows import documents, empty, texts
from staylens.llm import repeated_windows as windows
from staylens.llm.repeated_windows import without_repeats


def compare(spark, rows, depth):
    got = without_repeats(documents(spark, rows), depth=depth).collect()
    want = repeated_windows([t for _, t, _ in rows], depth)
    found = sorted((repr(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got)
    assert found == sorted((repr(d), *w) for (d, _, _), w in zip(rows, want))


def test_awkward_rows(spark):
    compare(spark, texts(), 400)


@pytest.mark.parametrize("depth", [60, 401])
def test_passages_at_all_offsets(spark, depth):
    rnd = random.Random(depth)
    say = lambda n: "".join(rnd.choice("abcdefgh é") for _ in range(n))
    shared = [say(depth + d) for d in (-1, 0, 1, 30, 500)]
    rows = []
    for i in range(60):
        parts = [say(rnd.randrange(0, 300))]
        for _ in range(rnd.randrange(3)):
            whole = rnd.choice(shared)
            cut = rnd.randrange(0, 40)
            parts += [whole[cut:], say(rnd.randrange(0, 50))]
        rows.append((i, "".join(parts), None))
    compare(spark, rows, depth)


def test_long_texts_are_read_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(windows, "CHUNK", 1 << 13)
    rnd = random.Random(3)
    say = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    shared = say(9000)
    data = [(say(20_000) + shared + say(100)).encode(), (say(3) + shared[50:] + say(12_000)).encode()]
    starts = np.cumsum([0, *map(len, data)])
    buffer = np.frombuffer(b"".join(data), np.uint8)
    covered = [np.zeros(len(d), int) for d in data]
    for doc, _, first, n, off in windows.anchor_runs(buffer, starts, 400):
        for d, f, k in zip(doc, first, n):
            covered[d][f : f + k] += 1
    for d, c in zip(data, covered):
        assert (c[: len(d) - 399] == 1).all() and not c[len(d) - 399 :].any()


def test_bytes_that_are_left(spark):
    line = "the same long line of words " * 20
    rows = [(1, "start " + line, None), (2, line + " end", None), (3, "nothing", None)]
    got = {r["doc_id"]: bytes(r["kept"]).decode() for r in without_repeats(documents(spark, rows), with_text=True).collect()}
    assert got[3] == "nothing" and len(got[1]) < 30 and len(got[2]) < 30


def test_empty_table(spark):
    assert without_repeats(empty(spark)).count() == 0
