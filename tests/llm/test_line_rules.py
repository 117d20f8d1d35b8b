import random
import re
from collections import Counter

from brute import SPLIT
from rows import documents, empty, texts
from staylens.llm import line_rules
from staylens.llm.line_rules import CLOSING, LEADS, PHRASES, SEPARATORS, cleaned, line_verdicts


def lines_of(text):
    """(line, fails) of the lines with a word."""
    seen, out = set(), []
    for line in text.split("\n"):
        words = SPLIT.findall(line)
        if not words:
            continue
        again = sum(a == b for a, b in zip(words, words[1:]))
        low = line.lower()
        fails = (
            not words[-1].endswith(CLOSING) or 4 * len(re.findall(r"[#*$%&|<>]", line)) > len(words)
            or 3 * len(re.findall("[!?]{2,}", line)) > len(words) or sum(w in SEPARATORS for w in words) >= 3
            or (len(words) < 3 and " ".join(words).lower() in LEADS) or any(p in low for p in PHRASES)
            or line in seen or 2 * again > len(words)
        )
        out.append((line, len(words), fails, line in seen))
        seen.add(line)
    return out


def brute(text, window=8):
    text = text or ""
    words = SPLIT.findall(text)
    runs = [tuple(words[i : i + window]) for i in range(len(words) - window + 1)]
    often, covered = Counter(runs), set()
    for i, run in enumerate(runs):
        if often[run] > 1:
            covered |= set(range(i, i + window))
    lines = lines_of(text)
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    lost = sum(n for _, n, fails, _ in lines if fails)
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(again for *_, again in lines),
        len(covered), failed, not failed and 100 * lost <= 50 * len(words),
    )


def made(seed=5):
    rnd = random.Random(seed)
    say = lambda n: " ".join(rnd.choice(["stay", "Über", "漢字", "a", "of"]) + str(rnd.randrange(30)) for _ in range(n))
    pieces = [
        "Home | About | Contact | Help", "read more", "Share", "We use cookies on this site.", "ALL RIGHTS RESERVED.",
        "WOW!! SO!! GOOD!! MUCH.", "ti%%% th*** be&&& of.", "no mark at the end", "again again again again.", " \t ", "",
        "one.\r", "“Quoted.”", "Ends with… ", "x :: y :: z :: w.",
    ]
    out = []
    for i in range(150):
        lines = [rnd.choice(pieces) if rnd.random() < 0.4 else say(rnd.randrange(1, 30)) + "." for _ in range(rnd.randrange(0, 14))]
        out.append((i, "\n".join(lines + lines[: rnd.randrange(0, 3)]), "s"))
    return out


def test_verdicts_equal_plain_rules(spark):
    rows = texts() + made()
    got = line_verdicts(documents(spark, rows)).collect()
    want = [(d, *brute(t)) for d, t, _ in rows]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted((tuple(r)[:8] for r in got), key=key) == sorted(want, key=key)
    assert {r[-1] for r in want} == {True, False} == {r[-2] for r in want}


def test_stretches_of_long_texts(monkeypatch):
    monkeypatch.setattr(line_rules, "SLAB", 7)
    for _, text, _ in made(8)[:60]:
        numbers = line_rules.judged(text.encode())[0]
        assert tuple(numbers) == brute(text)[:5]


def test_cleaned_texts(spark):
    rows = made()
    got = {r["doc_id"]: r["text"] for r in cleaned(documents(spark, rows)).collect()}
    for d, text, _ in rows:
        assert (d in got) == brute(text)[-1]
        if d in got:
            assert [line for line, *_ in lines_of(got[d])] == [line for line, _, fails, _ in lines_of(text) if not fails]


def test_empty_table(spark):
    assert line_verdicts(empty(spark)).count() == 0 == cleaned(empty(spark)).count()
