import hashlib
import random
import re
import zlib

from staylens.llm import prefix_trie
from staylens.llm.queries import trie_digests

SCHEMA = "conv_id long, turn int, role string, text string, at long, depth int, a long, row string, name long, words int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, "x", 4, 5) for r in rows], SCHEMA)


def made(seed=3):
    rnd = random.Random(seed)
    say = ["", "yes", "no", "tell me more", None, "two  words\tthree\n", "é 漢字 ", "long " * 500]
    rows = []
    for c in rnd.sample(range(0, 130), 60):
        for t in range(rnd.randrange(1, 7)):
            rows.append((c, t, rnd.choice(["user", "assistant"]) if t > 2 else "user", rnd.choice(say[:2 + t])))
    for c in range(200, 260):  # copies of one conversation, and of its first turns
        rows += [(c, t, "user", f"copied {t}") for t in range(3 + c % 4)]
    rows += [(300, None, "user", "first"), (300, 0, "user", "second"), (300, -1, None, "between")]
    rows += [(301, 5, "user", "same"), (301, 5, "user", "same"), (301, 5, "user", None), (301, 5, None, "tie")]
    rows += [(None, 0, "user", "nobody"), (302, 1, None, None), (320, 0, "a", "b"), (-7, 0, "user", "below")]
    rnd.shuffle(rows)
    return rows


def rebuilt(rows):
    own: dict = {}
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", hashlib.md5((r[3] or "").encode()).hexdigest())
    for r in sorted((r for r in rows if r[0] is not None), key=order):
        own.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = abs(c) - abs(c) % 20
        out[c] = own.get(base if c >= 0 else -base, [])[:h] + turns[h:]
    return out


def brute(rows):
    whole = rebuilt(rows)
    members: dict = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children: dict = {}
    for key in members:
        if key:
            children.setdefault(key[:-1], []).append(key)
    words = lambda key: len(re.findall(r"[^\x20\x09-\x0D]+", key[-1][1])) if key else 0
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for key, own in members.items():
        for d in range(len(key) + 1):
            leaves[key[:d]] += key not in children
            saved[key[:d]] += (len(own) - 1) * words(key)
    return sorted(
        (
            min(own), len(key), min(members[key[:-1]]) if key else None, len(own), len(children.get(key, [])),
            leaves[key], saved[key],
            hashlib.sha256(",".join(map(str, sorted(c for c in own if len(whole[c]) == len(key)))).encode()).hexdigest(),
        )
        for key, own in members.items()
    )


def test_nodes_equal_a_plain_trie(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 2)
    monkeypatch.setattr(prefix_trie, "CHUNK", 2)
    rows = made()
    assert sorted(map(tuple, trie_digests(frame(spark, rows)).collect())) == brute(rows)


def test_only_turnless_conversations(spark):
    gone = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(gone, 0, "user", "replaced"), (gone, 1, "user", "too")]
    assert sorted(map(tuple, trie_digests(frame(spark, rows)).collect())) == brute(rows)


def test_empty_table(spark):
    assert trie_digests(frame(spark, [])).count() == 0
    assert trie_digests(frame(spark, [(None, 0, "user", "nobody")])).count() == 0


def test_nodes_with_texts_and_ends(spark):
    rows = [(1, 0, "u", "a"), (1, 1, "v", "b"), (2, 0, "u", "a"), (3, 0, "u", "c")]
    nodes, ends = prefix_trie.prefix_trie(frame(spark, rows))
    got = {(r["depth"], r["role"], r["text"], r["conv_id"], r["n_convs"], r["n_leaves"]) for r in nodes.collect()}
    assert got == {(0, None, None, 1, 3, 2), (1, "u", "a", 1, 2, 1), (2, "v", "b", 1, 1, 1), (1, "u", "c", 3, 1, 1)}
    assert sorted((r["depth"], r["conv_id"]) for r in ends.collect()) == [(1, 2), (1, 3), (2, 1)]
