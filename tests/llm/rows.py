"""Rows with the awkward cases that every operator has to take."""

from __future__ import annotations

import random

COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # names that operators use themselves
    "id long, size long, n long, row long, name string, `_group` string, mark long, body string, copies long, "
    "nth long, score double, `_n` long, `_h` long, node long, `all` string, host string, c0 string, `_id` long, at long"
)
WORDS = ["the", "of", "Über", "naïve", "street", "and", "a", "stay", "12", "night's", "<b>", "漢字", "é", "|", "!!"]


def texts(seed: int = 1) -> list:
    rnd = random.Random(seed)
    say = lambda n: " ".join(rnd.choice(WORDS) + str(rnd.randrange(40)) for _ in range(n))
    base, passage = say(220), say(90)
    near = base.split(" ")
    out = [
        (1, base, "s1"), (2, base, "s2"), (3, base.upper(), None), (3, base.upper(), None), (4, None, None),
        (5, "", "s1"), (6, "  \t\n ", "s3"), (None, base, "s1"), (None, None, None), (7, "one", "s1"), (8, "ONE", "s2"),
        (9, say(30) + passage + say(30), "s2"), (10, passage, "s2"), (11, say(9000), "s3"), (12, "x" * 50_000, "s3"),
        (13, "ab " * 3000, "s1"), (14, "<|endoftext|> Don't <|startoftext|>", "s1"), (15, "two words", "s4"),
        (15, "two words", "s4"), (15, "other words of the same id", "s4"),
    ]
    for i in range(20, 60):
        changed = list(near)
        for _ in range(i % 7):
            changed[rnd.randrange(len(changed))] = "new" + str(rnd.randrange(99))
        out.append((i, " ".join(changed), f"s{i % 3}"))
    out += [(i, say(rnd.randrange(1, 400)), f"s{i % 5}") for i in range(60, 90)]
    return out


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    filler = [(None if i % 2 else 7) for i in range(4)]
    full = [
        (d, t, None if k % 3 else "en", s, None if k % 2 else 5, 1, filler[k % 4], 2, 3, "x", "y", 4, "b", 0, 1, 0.5, 1, 2, 3,
         "z", "h", "c", 9, 1)
        for k, (d, t, s) in enumerate(rows)
    ]
    return spark.createDataFrame(full, COLUMNS)


def empty(spark):
    return documents(spark, [])
