"""Token counts from prefix tables of a word-end byte-pair vocabulary.

The encoding of a prefix is the encoding of a shorter prefix and one last token: the
only token that ends there and stays apart from the token before it. So one pass
over the ends of all prefixes of a word, shortest first, stores the exact number of
tokens (and the last token) of every prefix, and no prefix is encoded again. A cut
inside a word makes what is left the end of a word, so the counts are kept for the
open and the closed form. Counts of words add up, so the count of any prefix of
a text is a sum and a look-up, and the longest prefix within a budget follows.

The vocabulary is the file of a public tokenizer; special strings inside a text are
one token, as its library counts them. Texts are cut into words by that library's
rules: directly where all characters are Latin letters, signs and digits whose
classes never changed, by the library itself otherwise.

Null texts count as empty and have 0 tokens. Texts of any length are counted whole.
Rows that repeat an id are counted one by one. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

WHITE = "\\t-\\r \\x85\\xa0"
WORDS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{WHITE}\p{{L}}\p{{N}}]+")
LATIN = re.compile("[\x00-ɏ]*")
KEPT_WORDS = 600_000


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte, and back: printable
    bytes stand for themselves, the others follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixCounter:
    """Prefix tables for one vocabulary file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        self.end = model["model"]["end_of_word_suffix"]
        special = [t["content"] for t in model["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))) or "(?!)")
        letters = byte_letters()
        self.open: dict[bytes, int] = {}
        self.closed: dict[bytes, int] = {}
        vocabulary = model["model"]["vocab"]
        for token, number in vocabulary.items():
            if token in special:
                continue
            ends = token.endswith(self.end)
            body = token[: -len(self.end)] if ends else token
            (self.closed if ends else self.open)[bytes(letters[c] for c in body)] = number
        self.parts = {n: (b, False) for b, n in self.open.items()} | {n: (b, True) for b, n in self.closed.items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        self.merged = {
            (vocabulary[a], vocabulary[b]): (rank, vocabulary[a + b]) for rank, (a, b) in enumerate(merges)
        }
        self.longest = max(map(len, [*self.open, *self.closed]))
        self.apart: dict[int, bool] = {}
        self.known: dict[str, int] = {}

    def encoded(self, body: bytes, ends: bool) -> list[int]:
        """Merge by merge, for the short strings of at most two tokens."""
        ids = [self.open[body[i : i + 1]] for i in range(len(body))]
        if ends:
            ids[-1] = self.closed[body[-1:]]
        while len(ids) > 1:
            best = min((self.merged.get(p, (1 << 40, 0)) for p in zip(ids, ids[1:])))
            if best[0] == 1 << 40:
                break
            out, i = [], 0
            while i < len(ids):
                if i + 1 < len(ids) and self.merged.get((ids[i], ids[i + 1])) == best:
                    out.append(best[1])
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def stays_apart(self, before: int, token: int) -> bool:
        """Whether a text that ends with `before` and `token` is encoded so;
        `before` is -1 at the start of a word."""
        body, ends = self.parts[token]
        if before < 0:
            found = self.encoded(body, ends) == [token]
        else:
            found = self.encoded(self.parts[before][0] + body, ends) == [before, token]
        self.apart[(before + 1 << 20) | token] = found
        return found

    def table(self, word: bytes) -> tuple[list[int], list[int]]:
        """Tokens and last token of every prefix that goes on, from length 0."""
        counts, last = [0], [-1]
        get, apart, longest = self.open.get, self.apart.get, self.longest
        for j in range(1, len(word) + 1):
            for i in range(max(0, j - longest), j):
                token = get(word[i:j])
                if token is None:
                    continue
                before = last[i]
                fits = apart((before + 1 << 20) | token)
                if fits or (fits is None and self.stays_apart(before, token)):
                    counts.append(counts[i] + 1)
                    last.append(token)
                    break
        return counts, last

    def closed_count(self, word: bytes, table: tuple[list[int], list[int]]) -> int:
        """Tokens of the word as a whole, from the table of its open prefixes."""
        counts, last = table
        end = len(word)
        for i in range(max(0, end - self.longest), end):
            token = self.closed.get(word[i:])
            if token is None:
                continue
            before = last[i]
            fits = self.apart.get((before + 1 << 20) | token)
            if fits or (fits is None and self.stays_apart(before, token)):
                return counts[i] + 1
        raise ValueError(f"no last token for {word!r}")

    def word_count(self, word: str) -> int:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= KEPT_WORDS:
                self.known.clear()
            body = word.encode()
            found = self.closed_count(body, self.table(body))
            if len(word) < 64:
                self.known[word] = found
        return found

    def segments(self, text: str) -> Iterator[tuple[str, bool]]:
        """Stretches between special strings, and the special strings."""
        at = 0
        for found in self.special.finditer(text):
            yield text[at : found.start()], False
            yield found[0], True
            at = found.end()
        yield text[at:], False

    def seen(self, segment: str) -> str:
        """A stretch as the tokenizer reads it."""
        if segment.isascii():
            return segment.lower()
        if LATIN.fullmatch(segment) and unicodedata.is_normalized("NFC", segment):
            return segment.lower()
        return self.library.normalizer.normalize_str(segment)

    def words(self, seen: str) -> Iterator[tuple[int, str]]:
        """Words with their place."""
        if LATIN.fullmatch(seen):
            for found in WORDS.finditer(seen):
                yield found.start(), found[0]
        else:
            for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(seen):
                yield a, seen[a:b]

    def count(self, text: str) -> int:
        total = 0
        for segment, special in self.segments(text):
            if special:
                total += 1
                continue
            seen = self.seen(segment)
            known = self.known.get
            found = WORDS.findall(seen) if LATIN.fullmatch(seen) else [w for _, w in self.words(seen)]
            for word in found:
                total += known(word) or self.word_count(word)
        return total

    def prefix_counts(self, text: str) -> list[int]:
        """Tokens of every prefix, by length in characters from 0 on, of the text as
        the tokenizer reads it (composed, lower case)."""
        counts, total = [0], 0
        for segment, special in self.segments(text):
            if special:
                # an unfinished special string is ordinary text
                counts += [total + self.count(segment[:j]) for j in range(1, len(segment))]
                total += 1
                counts.append(total)
                continue
            seen, start = self.seen(segment), len(counts) - 1
            for place, word in self.words(seen):
                counts += [total] * (start + place + 1 - len(counts))
                body, ends = word.encode(), 0
                table = self.table(body)
                for letter in word:
                    ends += len(letter.encode())
                    counts.append(total + self.closed_count(body[:ends], table))
                total = counts[-1]
            counts += [total] * (start + len(seen) + 1 - len(counts))
        return counts

    def fitting(self, text: str, budget: int) -> int:
        """Length of the longest prefix of at most `budget` tokens, of the text as the
        tokenizer reads it. Only the word that crosses the budget is looked into."""
        total, length = 0, 0
        for segment, special in self.segments(text):
            if special:
                if total + 1 > budget:
                    return length
                total, length = total + 1, length + len(segment)
                continue
            seen = self.seen(segment)
            for place, word in self.words(seen):
                count = self.word_count(word)
                if total + count > budget:
                    body = word.encode()
                    table, best, ends = self.table(body), 0, 0
                    for j, letter in enumerate(word, 1):
                        ends += len(letter.encode())
                        if total + self.closed_count(body[:ends], table) <= budget:
                            best = j
                    return length + place + best
                total += count
            length += len(seen)
        return length


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def counts_of(path: str, limit: int, fits: bool):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = counter(path)
        for batch in batches:
            sizes, tokens, fitting = [], [], []
            for value in batch.column(0):
                text = value.as_py() or ""
                sizes.append(len(text.encode()))
                tokens.append(tables.count(text))
                if fits:
                    fitting.append(tables.fitting(text, limit))
            own = [pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())]
            if fits:
                own.append(pa.array(fitting, pa.int64()))
            names = ["n_bytes", "n_tokens", *["fitting"] * fits]
            yield pa.RecordBatch.from_arrays([batch.column(1), *own], names=["doc_id", *names])

    return each


def token_counts(
    docs: DataFrame, path: str, limit: int = 2048, id: str = "doc_id", text: str = "text", fits: bool = False
) -> DataFrame:
    """id, `n_bytes`, `n_tokens`, `over_limit` of every row, and with `fits` the length
    of its longest prefix of at most `limit` tokens (`fitting`). `path` is the place of
    the vocabulary on every executor."""
    kind = docs.schema[id].dataType.simpleString()
    found = docs.select(F.col(text).alias("text"), F.col(id).alias("doc_id")).mapInArrow(
        counts_of(path, limit, fits), f"doc_id {kind}, n_bytes long, n_tokens long" + ", fitting long" * fits
    )
    return found.select(
        F.col("doc_id").alias(id), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"),
        *["fitting"] * fits,
    )
