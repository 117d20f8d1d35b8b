"""Near copies against all pairs compared in plain Python."""

import random
from collections import defaultdict

import pytest

from pyspark.sql import functions as F

from staylens.functions.similarity import common_letters, common_many
from staylens.operators import similar


def subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def brute(rows, threshold):
    cells = defaultdict(list)
    for r in rows:
        cells[(round(r[3] / 0.0005), round(r[4] / 0.0005), r[5])].append(r)
    pairs = set()
    for members in cells.values():
        for i, a in enumerate(members):
            for b in members[i + 1:]:
                if a[1] is not None and a[1] == b[1]:
                    continue
                s, t = (" ".join(sorted(str("nan" if m[2] is None else m[2]).split())) for m in (a, b))
                joint = len(s) + len(t)
                if 2 * min(len(s), len(t)) * 100 < threshold * joint:
                    continue  # no more letters can be shared than the shorter name has
                shared = subsequence(s, t)
                if joint == 0 or 2 * shared * 100 >= threshold * joint:
                    pairs.add((a[1], b[1], 100 if joint == 0 else 2 * shared * 100 // joint))
    return pairs


def listings(seed, template):
    rng = random.Random(seed)
    words = ["garden", "sea", "view", "loft", "old", "town", "Casa", "b&b", "x", "suite", "ático", "12", "by", "the"]
    rows, names = [], []
    for i in range(260):
        kind = rng.random()
        if template:
            name = f"Grand suite {rng.randint(0, 40)} over the old harbour wall with terrace and a sea view number {rng.randint(0, 30)} {'of the tower ' * rng.randint(0, 1)}"
        elif names and kind < 0.6:
            letters = list(rng.choice(names))
            for _ in range(rng.randint(0, 5)):
                at = rng.randrange(len(letters) + 1)
                action = rng.random()
                if action < 0.4 and letters:
                    del letters[min(at, len(letters) - 1)]
                elif action < 0.7:
                    letters.insert(at, rng.choice("abz9"))
                elif letters:
                    letters[min(at, len(letters) - 1)] = rng.choice("abz9")
            name = "".join(letters)
        elif kind < 0.65:
            name = None
        else:
            name = " ".join(rng.choice(words) for _ in range(rng.randint(1, 45)))
        if name:
            names.append(name)
        place = rng.choice([0.0, 0.0, 0.01])
        rows.append((i, i if rng.random() < 0.97 else 7, name, 10 + place, 20.0, rng.choice(["a", None])))
    return rows


@pytest.mark.parametrize("threshold", [98.0, 95.0])
@pytest.mark.parametrize("template", [False, True])
def test_same_pairs_as_brute_force(spark, threshold, template):
    rows = listings(11, template)
    df = spark.createDataFrame(rows, "_row_id long, id long, name string, latitude double, longitude double, room_type string")
    found = similar.fuzzy_pairs(df.repartition(7), "x", threshold=threshold).collect()
    expected = brute(rows, threshold)
    assert {(r.id_a, r.id_b, r.score) for r in found} == expected
    assert len(expected) > 50


def test_common_letters():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randint(0, 70))) for _ in range(2))
        assert common_letters(a, b) == subsequence(a, b)


def edited(rng, letters, name, edits):
    name = list(name)
    for _ in range(edits):
        at = rng.randrange(len(name) + 1)
        if rng.random() < 0.5 or not name:
            name.insert(at, rng.choice(letters))
        else:
            del name[min(at, len(name) - 1)]
    return "".join(name)


def test_common_letters_of_many_pairs():
    """Short, long and empty names in one call; middles of up to 63 letters and longer ones."""
    rng, pairs = random.Random(2), [("", ""), ("a", "")]
    for _ in range(3000):
        letters = rng.choice(["ab", "abcdé😀\0", "abcdefghijklmnopqrstuvwxyz"])
        name = "".join(rng.choice(letters) for _ in range(rng.choice([1, 9, 40, 70, 130, 300])))
        pairs.append((name, edited(rng, letters, name, rng.choice([0, 1, 3, 9, 150]))))
    for many in (pairs, pairs[:1], []):
        assert common_many([a for a, _ in many], [b for _, b in many]).tolist() == [common_letters(*p) for p in many]


def test_an_edit_changes_one_bit(spark):
    """Names that are further apart in their sets of letters cannot match; most names of a template go so."""
    rng, rows = random.Random(3), []
    for _ in range(300):
        letters = rng.choice(["ab", "é😀ñ", "house 0123456789"])
        name, edits = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40))), rng.randint(0, 5)
        rows.append((name, edited(rng, letters, name, edits), edits))
    df = spark.createDataFrame(rows, "a string, b string, edits int")
    gap = F.bit_count(similar.odd_letters(F.col("a")).bitwiseXOR(similar.odd_letters(F.col("b"))))
    assert df.where(gap > F.col("edits")).count() == 0 and df.where(gap == F.col("edits")).count() > 30


def test_far_names_of_a_template_are_dropped_in_the_join(spark):
    """The join on segments holds the sets of letters against each other; deletion keys are made once for both sides."""
    df = spark.createDataFrame(listings(12, True), "_row_id long, id long, name string, latitude double, longitude double, room_type string")
    plan = similar.similar_names(similar.cell_names(df, "x"))._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.split("\n") if "SortMergeJoin" in line]
    assert any("bit_count" in line for line in joins) and "levenshtein" not in plan
    rows = spark.createDataFrame([("x", 1, 1, "r", "grand house by the sea " * 4, 1, 92, 0, i) for i in range(3)], "_set string, _y long, _x long, _block string, _text string, _rows long, _len int, _odd long, _id long")
    pairs = similar.one_edit_pairs(rows.repartition(2, "_id"), 98.0)
    pairs.collect()
    shuffles = [line for line in pairs._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].split("\n") if "hashpartitioning(_key" in line]
    assert len(shuffles) == 2 and sum("Reused" in line for line in shuffles) == 1


def test_ids_are_counted_over_one_reading_of_the_names(spark, tmp_path):
    df = spark.createDataFrame(listings(12, True), "_row_id long, id long, name string, latitude double, longitude double, room_type string")
    df.write.parquet(f"{tmp_path}/listings")
    rows = similar.cell_names(spark.read.parquet(f"{tmp_path}/listings"), "x")
    names = similar.similar_names(rows)
    pairs = similar.pair_count(rows, names)
    assert pairs.first().pairs == similar.expand_pairs(rows, names).count()
    pairs.collect()
    plan = pairs._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert sum("array_sort" in line for line in plan.split("\n")) == 1


def test_known_cases(spark):
    sixty, ten = "x" * 30 + "abcdefghij" * 3, "abcdefghij"
    rows = [
        (0, 0, "Sea view loft", 1.0, 1.0, "r"), (1, 1, "loft Sea  view", 1.0, 1.0, "r"),
        (2, 2, None, 1.0, 1.0, "r"), (3, 3, None, 1.0, 1.0, "r"),
        (4, 4, sixty, 1.0, 1.0, "r"), (5, 5, sixty.replace("a", "q", 1), 1.0, 1.0, "r"),
        (6, 6, ten, 1.0, 1.0, "r"), (7, 7, "qbcdefghij", 1.0, 1.0, "r"),
        (8, 8, "Sea view loft", 1.01, 1.0, "r"), (9, 9, "Sea view loft", 1.0, 1.0, "s"),
    ]
    df = spark.createDataFrame(rows, "_row_id long, id long, name string, latitude double, longitude double, room_type string")
    found = similar.fuzzy_pairs(df, "x").collect()
    assert {(r.id_a, r.id_b, r.score) for r in found} == {(0, 1, 100), (2, 3, 100), (4, 5, 98)}


def test_keys_of_names_are_not_broadcast(spark, tmp_path):
    """A few bytes of names have many keys: no join on them goes through the driver."""
    df = spark.createDataFrame(listings(12, True), "_row_id long, id long, name string, latitude double, longitude double, room_type string")
    # a small file, whose size the planner knows
    df.write.parquet(f"{tmp_path}/listings")
    rows = similar.cell_names(spark.read.parquet(f"{tmp_path}/listings"), "x")
    names = similar.similar_names(rows)
    for found in (names, similar.pair_count(rows, names)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    pairs = similar.expand_pairs(rows, names).count()
    assert similar.pair_count(rows, names).first().pairs == pairs > 50
