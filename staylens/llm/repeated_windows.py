"""Suffix-array dedup by a depth-limited radix sort of all suffixes.

Two suffixes belong to the same group when their first `depth` bytes are equal; a
group of two or more is a repeated window. Suffixes are sorted only as far as that,
one digit per pass, most significant digit first, and a group that falls to one
member leaves the sort. Bytes behind the depth are never looked at.

To move few rows, suffixes travel in runs, and the digits of a window are taken in
an order that neighbours share:

1. The first digit of a window is its anchor, the 20-byte gram with the smallest
   hash inside it (the leftmost, on ties). Neighbouring windows have the same
   anchor, so a run of about 190 suffixes is one row without text. Anchors that
   occur once retire their whole run; most text leaves the sort here.
2. The windows of one anchor are cut by their distance to it into classes of 48.
   The second digit is the core, the 353 bytes that all windows of a class hold.
   Classes with a core that occurs once retire.
3. The last digit is what is left of the depth, up to 47 bytes to both sides of the
   core. A class that occurs twice with the same sides needs no look at its single
   windows. Only the classes whose core meets different sides are taken apart, one
   row per window.

Each digit but the last is a 64-bit hash; a window's name is made of all of them,
which is at least 128 bits. A pass counts by (combinable) aggregates and gives the
counts back by a join, which adaptive execution splits where a name is frequent.
Lists are gathered per document only, so they are bounded by its own size.

Null texts count as empty. Rows that repeat an id and its text are two documents
with the same windows. Texts shorter than the depth lose nothing. An empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from staylens.llm.store import if_small, written
from staylens.llm.text_bytes import Spans, binaries, mix, signed

DEPTH = 400
GRAM, CLASS = 20, 48
CHUNK = 1 << 20
_U = np.uint64

RUNS = "id long, mark long, anchor long, first long, n int, off int"
CLASSES = "id long, mark long, name long, base long, low int, n int, head binary, tail binary"


def pieces(starts: np.ndarray, depth: int) -> Iterator[list[tuple[int, int, int]]]:
    """Texts (document, from, to) in buffers of bounded size; a longer text is cut
    into pieces that overlap by all but one byte of a window."""
    batch, size = [], 0
    for doc, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist())):
        while b - a >= depth:
            end = min(b, a + CHUNK // 2)
            if size + end - a > CHUNK:
                yield batch
                batch, size = [], 0
            batch.append((doc, a, end))
            size += end - a
            a = end - depth + 1 if end < b else b
    if batch:
        yield batch


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of every `width` neighbours."""
    count = len(x) - width + 1
    rows = -(-len(x) // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    grid = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def anchor_runs(data: np.ndarray, starts: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, ...]]:
    """document, anchor hash, first window, windows, distance of the first window to
    the anchor, for the runs of neighbouring windows with the same anchor."""
    place = _U(CHUNK - 1)
    for batch in pieces(starts, depth):
        buffer = np.concatenate([data[a:b] for _, a, b in batch])
        sizes = np.array([b - a for _, a, b in batch])
        offsets = np.cumsum(sizes) - sizes
        grams = Spans(buffer).all(GRAM)
        keys = (grams & ~place) | np.arange(len(grams), dtype=np.uint64)
        at = (sliding_least(keys, depth - GRAM + 1) & place).astype(np.int64)
        piece = np.repeat(np.arange(len(batch)), sizes)[: len(at)]
        valid = np.arange(len(at)) + depth <= (offsets + sizes)[piece]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (piece[1:] != piece[:-1]) | (valid[1:] != valid[:-1])
        first = np.flatnonzero(new)
        n = np.diff(np.append(first, len(at)))
        keep = valid[first]
        first, n = first[keep], n[keep]
        own = piece[first]
        doc = np.array([d for d, _, _ in batch])[own]
        begin = np.array([a for _, a, _ in batch])[own] - starts[doc] - offsets[own]
        yield doc, grams[at[first]], first + begin, n, at[first] - first


def runs_of(depth: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            data, starts = binaries(batch.column(2))
            for doc, anchor, first, n, off in anchor_runs(data, starts, depth):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[doc]), pa.array(marks[doc]), pa.array(signed(anchor)),
                        pa.array(first.astype(np.int64)), pa.array(n.astype(np.int32)), pa.array(off.astype(np.int32)),
                    ],
                    names=["id", "mark", "anchor", "first", "n", "off"],
                )

    return each


def class_rows(text: np.ndarray, anchor: np.ndarray, first: np.ndarray, n: np.ndarray, off: np.ndarray, depth: int):
    """name, base, low, n, head, tail of the classes that the runs of a text touch.

    `base` is the first possible window of the class and `low` the first one in the
    run, counted from it."""
    spans = Spans(text)
    far = depth - GRAM
    # the windows of a run are at distances off, off - 1, ..., off - n + 1 to the anchor
    highest, lowest = off // CLASS, (off - n + 1) // CLASS
    count = highest - lowest + 1
    run = np.repeat(np.arange(len(n)), count)
    kind = highest[run] - (np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count))
    place = first[run] + off[run]
    base = place - np.minimum((kind + 1) * CLASS - 1, far)
    last = place - kind * CLASS
    begin = np.maximum(base, first[run])
    end = np.minimum(last, first[run] + n[run] - 1)
    core = spans.hash(last, base + depth)
    name = mix(core + mix(signed(anchor[run]).view(np.uint64) + kind.astype(np.uint64)))
    raw = text.tobytes()
    heads = [raw[a:b] for a, b in zip(begin.tolist(), last.tolist())]
    tails = [raw[a:b] for a, b in zip((base + depth).tolist(), (end + depth).tolist())]
    return name, base, begin - base, end - begin + 1, heads, tails


def classes_of(depth: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = (batch.column(i).to_pylist() for i in (0, 1))
            data, starts = binaries(batch.column(2))
            runs = batch.column(3)
            for i in range(batch.num_rows):
                found = runs[i].values
                columns = [found.field(c).to_numpy(zero_copy_only=False) for c in ("anchor", "first", "n", "off")]
                order = np.argsort(columns[1], kind="stable")
                anchor, first, n, off = columns[0][order], *(c[order].astype(np.int64) for c in columns[1:])
                for part in range(0, len(order), 4096):
                    own = slice(part, part + 4096)
                    yield from in_parts(
                        data[starts[i] : starts[i + 1]], anchor[own], first[own], n[own], off[own], depth, ids[i], marks[i]
                    )

    return each


def in_parts(text, anchor, first, n, off, depth, id, mark) -> Iterator[pa.RecordBatch]:
    """`class_rows` over stretches of a text of bounded length."""
    at = 0
    while at < len(first):
        # a class reaches at most one depth to either side of its run
        low = max(0, int(first[at]) - depth)
        upto = at + max(1, int(np.searchsorted(first[at:], low + CHUNK)))
        high = int((first[at:upto] + n[at:upto]).max()) + 2 * depth
        name, base, begin, count, heads, tails = class_rows(
            text[low:high], anchor[at:upto], first[at:upto] - low, n[at:upto], off[at:upto], depth
        )
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(name), id, np.int64)), pa.array(np.full(len(name), mark, np.int64)),
                pa.array(signed(name)), pa.array(base + low), pa.array(begin.astype(np.int32)),
                pa.array(count.astype(np.int32)), pa.array(heads, pa.binary()), pa.array(tails, pa.binary()),
            ],
            names=["id", "mark", "name", "base", "low", "n", "head", "tail"],
        )
        at = upto


def keyed(docs: DataFrame, id: str, text: str) -> DataFrame:
    """`id`, `mark`, `body`: the two numbers tell rows with the same id apart."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.coalesce(F.col(id).cast("long"), F.lit(-(1 << 63))).alias("id"),
        F.xxhash64(F.col(id), body).alias("mark"),
        body.cast("binary").alias("body"),
    )


def shared_classes(texts: DataFrame, depth: int) -> DataFrame:
    """The first digit: classes of windows whose anchor occurs more than once."""
    runs = written(texts.mapInArrow(runs_of(depth), RUNS))
    often = written(runs.groupBy("anchor").count().where("count > 1").select("anchor"))
    shared = runs.join(if_small(often, 8), "anchor", "left_semi")
    listed = written(
        shared.groupBy("id", "mark").agg(F.collect_list(F.struct("anchor", "first", "n", "off")).alias("runs"))
    )
    wanted = if_small(listed.select("id", "mark"), 16)
    met = texts.join(wanted, ["id", "mark"], "left_semi").join(listed, ["id", "mark"])
    return met.select("id", "mark", "body", "runs").mapInArrow(classes_of(depth), CLASSES)


def repeated_windows(texts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """`id`, `mark`, `base`, `bits` for texts (`id`, `mark`, `body`): bit i is set
    when the window that starts at `base` + i occurs elsewhere too."""
    classes = written(
        shared_classes(texts, depth).withColumn("sides", F.xxhash64("low", "n", "head", "tail"))
    )
    spans = written(classes.groupBy("name", "sides", "low", "n", "head", "tail").agg(F.count(F.lit(1)).alias("times")))
    several = written(spans.groupBy("name").count().where("count > 1").select("name"))
    full = F.expr("shiftleft(shiftleft(1L, n) - 1L, low)")
    whole = spans.where("times > 1").select("name", "sides", full.alias("bits"))
    mixed = spans.join(if_small(several, 8), "name", "left_semi")
    # one row per window of the classes whose sides differ
    window = F.explode(F.sequence(F.col("low"), F.col("low") + F.col("n") - 1))
    i = F.col("i") - F.col("low")
    single = mixed.select("*", window.alias("i")).select(
        "name", "sides", "times", "i",
        F.xxhash64(
            F.col("i"), F.substring("head", i + 1, F.octet_length("head")), F.substring("tail", F.lit(1), F.col("i")),
        ).alias("rest"),
    )
    single = written(single)
    more = written(single.groupBy("name", "i", "rest").agg(F.sum("times").alias("all")).where("all > 1").drop("all"))
    parted = (
        single.where("times = 1")
        .join(more, ["name", "i", "rest"], "left_semi")
        .groupBy("name", "sides")
        .agg(F.bit_or(F.expr("shiftleft(1L, i)")).alias("bits"))
    )
    flags = written(whole.unionByName(parted))
    return classes.select("id", "mark", "name", "sides", "base").join(flags, ["name", "sides"]).select(
        "id", "mark", "base", "bits"
    )


def cut_out(depth: int, with_text: bool):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = binaries(batch.column(0))
            sizes, spans, digests, texts = [], [], [], []
            hits = batch.column(1)
            for i in range(batch.num_rows):
                text = data[starts[i] : starts[i + 1]]
                found = hits[i].values
                change = np.zeros(len(text) + 1, np.int64)
                if found is not None and len(found):
                    base = found.field("base").to_numpy(zero_copy_only=False)
                    bits = found.field("bits").to_numpy(zero_copy_only=False)
                    for bit in range(CLASS):
                        at = base[(bits >> bit) & 1 == 1] + bit
                        np.add.at(change, at, 1)
                        np.add.at(change, at + depth, -1)
                gone = np.cumsum(change[:-1]) > 0
                sizes.append(int(gone.sum()))
                spans.append(int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()))
                rest = text[~gone].tobytes()
                digests.append(hashlib.sha256(rest).hexdigest())
                if with_text:
                    texts.append(rest)
            own = [pa.array(sizes, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string())]
            names = ["n_removed", "n_spans", "kept_sha256"]
            if with_text:
                own, names = [*own, pa.array(texts, pa.binary())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(
                [*own, *batch.columns[2:]], names=[*names, *batch.schema.names[2:]]
            )

    return each


def without_repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", depth: int = DEPTH, with_text: bool = False
) -> DataFrame:
    """id, `n_bytes`, `n_removed`, `n_spans` (maximal removed runs), `kept_sha256` of
    every row, and with `with_text` the bytes that are left (`kept`)."""
    texts = keyed(docs, id, text)
    hits = written(
        repeated_windows(texts, depth)
        .groupBy("id", "mark")
        .agg(F.collect_list(F.struct("base", "bits")).alias("hits"))
    )
    marks = if_small(hits.select("id", "mark"), 16)
    key = F.when(F.col("id") == -(1 << 63), F.lit(None)).otherwise(F.col("id")).alias(id)
    size = F.octet_length("body").cast("long").alias("n_bytes")
    clean = texts.join(marks, ["id", "mark"], "left_anti").select(
        key, size, F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
        F.sha2("body", 256).alias("kept_sha256"), *([F.col("body").alias("kept")] if with_text else []),
    )
    met = texts.join(marks, ["id", "mark"], "left_semi").join(hits, ["id", "mark"])
    schema = "n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    cut = met.select("body", "hits", key, size).mapInArrow(cut_out(depth, with_text), f"{schema}, {id} long, n_bytes long")
    return clean.unionByName(cut)
