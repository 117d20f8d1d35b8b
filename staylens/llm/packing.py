"""Best-two-fit packing of tokenised documents into sequences of fixed length.

A sequence is filled greedily: the longest piece left, then again and again the
longest that fits the gap. Then its smallest piece is replaced by two unpacked ones
that fit the widened gap more tightly, as long as there are any.

Pieces of one length are interchangeable, so the plan needs only the number of
pieces of each length: at most `size` numbers, whatever the input. A filled sequence
is repeated as often as the counts allow, so the plan has some thousand lines at
most. Each piece is then numbered within its length (salted by hash, so that a length
that a third of all pieces share is spread over tasks), and its number says which
line of the plan, which repetition and which place is its own. Tokens and texts are
never shuffled.

Tokens come from a byte-level vocabulary file; its two public libraries give the same
ids. The faster one is used for texts of Latin letters, signs and digits, the other
one for all texts with further characters or special strings.

Null texts count as empty; an empty document is its closing token alone. Texts of
any length are cut and packed whole. Rows that repeat an id are packed one by one.
An empty table gives an empty result.
"""

from __future__ import annotations


import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from staylens.llm.store import if_small, written
from staylens.llm.token_counts import byte_letters

SIZE = 2048
GROUP = 50_000
LATIN = re.compile("[\x00-ɏ‐-‧‰-⁞]*")
# Fixed value: the word pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """Ids of a byte-level vocabulary file, as its library gives them."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        letters = byte_letters()
        special = {t["content"] for t in model["added_tokens"]}
        ranks = {
            bytes(letters[c] for c in token): number
            for token, number in model["model"]["vocab"].items()
            if token not in special
        }
        self.special = re.compile("|".join(map(re.escape, special)) or "(?!)")
        self.fast = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if LATIN.fullmatch(text) and not self.special.search(text):
            return np.array(self.fast.encode_ordinary(text), "<u4")
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces_of(path: str, size: int, closing: int, with_ids: bool):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(path)
        for batch in batches:
            row, piece, start, length, crc, parts = [], [], [], [], [], []
            for at, value in enumerate(batch.column(0)):
                ids = np.append(tokens.ids(value.as_py() or ""), np.array([closing], "<u4")).astype("<u4")
                # only a text that does not fit is cut; its first piece takes the rest
                cuts = [0, *range(len(ids) % size or size, len(ids), size), len(ids)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    row.append(at)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(ids[a:b].tobytes()))
                    if with_ids:
                        parts.append(ids[a:b].astype(np.int32))
            own = [
                batch.column(1).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                own, names = [*own, pa.array(parts, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(own, names=names)

    return each


def longest_upto(lengths: np.ndarray, left: np.ndarray, most: int) -> int:
    """The longest length of at most `most` of which a piece is left, else 0."""
    at = np.flatnonzero(left[: most + 1])
    return int(at[-1]) if len(at) else 0


def tightest_pair(left: np.ndarray, most: int) -> tuple[int, int]:
    """Two pieces that are left with the largest total of at most `most`."""
    have = np.flatnonzero(left[: max(0, most)])
    have = have[have > 0]
    if not len(have):
        return 0, 0
    at = np.searchsorted(have, np.minimum(most - have, have), side="right") - 1
    same = (at >= 0) & (have[np.maximum(at, 0)] == have) & (left[have] < 2)
    at = at - same
    total = np.where(at >= 0, have + have[np.maximum(at, 0)], 0)
    best = int(np.argmax(total))
    return (int(have[best]), int(have[at[best]])) if total[best] else (0, 0)


def plan(counts: np.ndarray, size: int) -> list[tuple[int, list[int]]]:
    """Repetitions and piece lengths of the sequences that hold `counts[length]` pieces
    of each length."""
    left = counts.astype(np.int64).copy()
    lines = []
    while left.any():
        used = left.copy()
        filled, gap = [], size
        while gap and (piece := longest_upto(counts, used, gap)):
            filled.append(piece)
            used[piece] -= 1
            gap -= piece
        while gap:
            smallest = min(filled)
            one, two = tightest_pair(used, gap + smallest)
            if one + two <= smallest or not two:
                break
            filled.remove(smallest)
            used[smallest] += 1
            for piece in (one, two):
                used[piece] -= 1
                filled.append(piece)
            gap += smallest - one - two
        filled.sort(reverse=True)
        lengths, uses = np.unique(filled, return_counts=True)
        times = int((left[lengths] // uses).min())
        left[lengths] -= uses * times
        lines.append((times, filled))
    return lines


class Places:
    """Which sequence and offset the n-th piece of a length gets."""

    def __init__(self, lines: list[tuple[int, list[int]]], size: int):
        rows, taken, sequence = [], np.zeros(size + 1, np.int64), 0
        for times, filled in lines:
            offset = 0
            for length in sorted(set(filled), reverse=True):
                uses = filled.count(length)
                rows.append((length, int(taken[length]), uses, sequence, offset))
                taken[length] += uses * times
                offset += uses * length
            sequence += times
        rows.sort()
        self.length, self.first, self.uses, self.sequence, self.offset = np.array(rows, np.int64).reshape(-1, 5).T
        self.key = self.length * (1 << 45) + self.first

    def find(self, length: np.ndarray, nth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, length * (1 << 45) + nth, side="right") - 1
        turn = nth - self.first[at]
        return self.sequence[at] + turn // self.uses[at], self.offset[at] + turn % self.uses[at] * length


def placed(places: Places):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index
            length, nth = (batch.column(at(c)).to_numpy(zero_copy_only=False) for c in ("length", "nth"))
            sequence, offset = places.find(length, nth)
            keep = [c for c in batch.schema.names if c != "nth"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(at(c)) for c in keep), pa.array(sequence), pa.array(offset)],
                names=[*keep, "sequence_id", "offset"],
            )

    return each


def numbered(pieces: DataFrame, count: int) -> DataFrame:
    """`pieces` with `nth`, 0 and up within each length."""
    salts = max(256, -(-count // GROUP))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    sums = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(
        sums.select("length", "salt", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    )
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece")
    return (
        salted.withColumn("row", F.row_number().over(own))
        .join(if_small(offsets, 24), ["length", "salt"])
        .withColumn("nth", F.col("before") + F.col("row") - 1)
        .drop("salt", "row", "before")
    )


def packed(
    docs: DataFrame, path: str, size: int = SIZE, closing: int = 0, id: str = "doc_id", text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """id, `piece`, `start`, `length`, `ids_crc32`, `sequence_id`, `offset` of every
    piece of every row, and with `with_ids` its tokens (`ids`). Each document is its
    ids and the closing id; only one of more than `size` ids is cut."""
    kind = docs.schema[id].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    pieces = written(
        docs.select(F.col(text).alias("text"), F.col(id).alias("doc_id")).mapInArrow(
            pieces_of(path, size, closing, with_ids), schema
        )
    )
    # at most one row per length
    counted = pieces.groupBy("length").count().collect()
    counts = np.zeros(size + 1, np.int64)
    for row in counted:
        counts[row["length"]] = row["count"]
    places = Places(plan(counts, size), size)
    rows = numbered(pieces, int(counts.sum()))
    order = [f.name for f in pieces.schema]
    found = rows.select(*order, "nth").mapInArrow(placed(places), f"{schema}, sequence_id long, offset long")
    return found.withColumnRenamed("doc_id", id)
