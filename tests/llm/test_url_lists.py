from datetime import date, timedelta

from staylens.llm.url_lists import intervals, listed_captures

DAY = date(2024, 1, 1)
at = lambda n: None if n is None else DAY + timedelta(n)

ENTRIES = [
    ("example.com", "add", 0), ("example.com", "remove", 10), ("example.com", "add", 200), ("a.example.com/x", "add", 5),
    ("a.example.com/x", "add", 5), ("b.org", "add", 3), ("b.org", "remove", 3), (None, "add", 1), ("c.net", "add", None),
    ("c.net", "hold", 4), ("d.net", "remove", 2), ("d.net", "add", 40), ("d.net", "add", 50), ("d.net", "remove", 51),
]
CAPTURES = [
    (1, "http://a.example.com/x/y?q", 5), (2, "http://a.example.com/xy", 5), (3, "https://u:p@Example.com:80", 9),
    (4, "http://example.com/", 10), (5, "http://b.org/", 30), (6, "http://c.net", 30), (7, None, 5), (8, "no url", 5),
    (9, "http://d.net/p", 50), (10, "http://d.net/p", 51), (11, "http://example.com", None), (12, "http://x.example.com", 400),
    (1, "http://a.example.com/x/y?q", 5),
]


def brute():
    log = {}
    for key, action, day in ENTRIES:
        if key is not None and day is not None and action in ("add", "remove"):
            log.setdefault(key, {}).setdefault(day, set()).add(action)
    out = []
    for n, url, day in CAPTURES:
        hits = []
        if url and "://" in url and day is not None:
            rest = url.split("://")[1].split("@")[-1].split("?")[0]
            host = rest.split("/")[0].split(":")[0].lower()
            parts = [p for p in rest.split("/")[1:] if p]
            keys = {".".join(host.split(".")[i:]) for i in range(host.count(".") + 1)}
            keys |= {host + "/" + "/".join(parts[: i + 1]) for i in range(len(parts))}
            for key in keys & set(log):
                before = [d for d in log[key] if d <= day]
                if before and log[key][max(before)] == {"add"}:
                    hits.append((max(before), key))
        best = max((k for _, k in hits), key=lambda k: (len(k), k), default=None)
        out.append((n, url, at(day), len(hits), bool(hits), at(min(hits)[0]) if hits else None, best))
    return sorted(out, key=repr)


def frames(spark, captures=CAPTURES, entries=ENTRIES):
    return (
        spark.createDataFrame([(n, u, at(d)) for n, u, d in captures], "page_id long, url string, fetched date"),
        spark.createDataFrame([(k, a, at(d)) for k, a, d in entries], "key string, action string, since date"),
    )


def test_captures_meet_the_list_of_their_day(spark):
    got = listed_captures(*frames(spark))
    assert sorted(map(tuple, got.collect()), key=repr) == brute()


def test_columns_that_clash(spark):
    captures, entries = frames(spark)
    for name in ("key", "u", "at", "n", "first", "period", "since", "longest", "blocked"):
        captures = captures.selectExpr("*", f"'x' AS {name}")
    got = listed_captures(captures, entries)
    assert sorted((tuple(r[c] for c in ("page_id", "url", "fetched", "n_active", "blocked", "listed_since", "matched")) for r in got.collect()), key=repr) == brute()


def test_empty_tables(spark):
    captures, entries = frames(spark)
    assert listed_captures(captures.limit(0), entries).count() == 0
    assert {r["n_active"] for r in listed_captures(captures, entries.limit(0)).collect()} == {0}


def test_intervals(spark):
    got = {tuple(r) for r in intervals(frames(spark)[1]).where("key = 'example.com'").collect()}
    assert got == {("example.com", at(0), at(10)), ("example.com", at(200), None)}


def test_only_native_plans(spark):
    plan = listed_captures(*frames(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
