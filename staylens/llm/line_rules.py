"""Line-first cleaning: rules per line, then a verdict on what is left of the text.

A line is what stands between line feeds; only lines with a word are judged. A line
fails when one of these holds:

* `end`: its last word does not end with a mark that closes a sentence or a quotation;
* `symbols`: it has more than one of the signs `#*$%&|<>` for every four words;
* `shouting`: it has more than one run of two or more `!` or `?` for every three words;
* `navigation`: it has three or more words that are nothing but a separator (`|`, `»`,
  `·` and the like), or is shorter than three words and says where to go ("read more");
* `boilerplate`: it holds a phrase of notices and consent boxes, equals an earlier line
  of the text, or more than half of its words repeat the word before.

Failing lines are removed. A document whose failing lines hold more than `percent`
percent of its words loses too much and is rejected, as is one that fails the base
rules: fewer than `least` words, or more than 30 percent of its words inside windows of
`window` words that occur twice or more in the text. The removal is a gain only for
documents that stay; counts are taken on the whole text as it came.

Words are runs of bytes other than space and 9 to 13. Repeats are exact: words get
numbers, and windows are named by pairs of numbers, doubled until they span the window,
so no two windows share a name. A text is read in stretches of bounded size; what is
held per text are arrays of numbers in proportion to it.

Null texts count as empty: they have no words, fail the base rules and are not kept.
Rows that repeat an id are judged each for itself, a null id stays null. Very long texts
and lines are judged whole. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from staylens.llm.text_bytes import SLAB, WORD, binaries

# Signs counted as symbols, marks that end a line, separators, phrases.
SYMBOLS = "#*$%&|<>"
CLOSING = (".", "!", "?", ":", ";", '"', "'", ")", "…", "”", "’", "»", "。", "！", "？", "」")
SEPARATORS = ("|", "»", "›", "·", "•", "/", ">", "::", "→")
LEADS = ("home", "menu", "next", "previous", "share", "login", "log in", "sign in", "sign up", "read more", "contact us")
PHRASES = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "use of cookies",
    "uses cookies", "use cookies", "enable javascript", "lorem ipsum", "click here", "subscribe to our newsletter",
)
RULES = ("end", "symbols", "shouting", "navigation", "boilerplate")
WINDOW, LEAST, PERCENT, REPEATED = 8, 20, 50, 30

_ends = tuple(c.encode() for c in CLOSING)
_separators = {s.encode() for s in SEPARATORS}
_leads = {s.encode() for s in LEADS}
_phrases = [p.encode() for p in PHRASES]
_symbol = np.isin(np.arange(256), np.frombuffer(SYMBOLS.encode(), np.uint8))
_mark = np.isin(np.arange(256), np.frombuffer(b"!?", np.uint8))
_point = (np.arange(256) & 0xC0) != 0x80


def stretches(text: bytes) -> Iterator[bytes]:
    """A text in stretches that end at white space."""
    at = 0
    while at < len(text):
        upto = min(len(text), at + SLAB)
        while upto < len(text) and WORD[text[upto]]:
            upto += 1
        yield text[at:upto]
        at = upto


def numbered(text: bytes) -> tuple[np.ndarray, dict[bytes, int]]:
    """The words of a text as numbers, and the number of each distinct word."""
    names: dict[bytes, int] = {}
    parts = [
        np.fromiter((names.setdefault(w, len(names)) for w in part.split()), np.int64) for part in stretches(text)
    ]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64), names


def repeated_names(values: np.ndarray) -> np.ndarray:
    """Numbers from 1 for the values that occur twice or more, 0 for the others."""
    _, name, times = np.unique(values, return_inverse=True, return_counts=True)
    return np.where(times[name] > 1, name + 1, 0).reshape(-1)


def in_repeats(words: np.ndarray, window: int) -> int:
    """Words inside runs of `window` words that occur twice or more."""
    if len(words) <= window:
        return 0
    # a run that occurs once has the name 0 and takes no part in longer ones
    span, names = 1, np.where(np.bincount(words)[words] > 1, words + 1, 0)
    while span < window:
        step = min(span, window - span)
        left, right = names[: len(names) - step], names[step:]
        at = np.flatnonzero((left > 0) & (right > 0))
        pairs = left[at] * (int(names.max()) + 1) + right[at]
        names = np.zeros(len(left), np.int64)
        names[at] = repeated_names(pairs)
        span += step
    often = np.flatnonzero(names)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, often, 1)
    np.add.at(change, often + window, -1)
    return int((np.cumsum(change[:-1]) > 0).sum())


def per_line(at: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    """How many of the places `at` each line holds."""
    return np.bincount(np.searchsorted(breaks, at), minlength=len(breaks) + 1)


def places_of_phrases(text: bytes) -> list[int]:
    """Where a phrase of notices begins, whatever the case of its letters."""
    low, found = text.lower(), []
    for phrase in _phrases:
        at = low.find(phrase)
        while at >= 0:
            found.append(at)
            at = low.find(phrase, at + 1)
    return found


def judged(text: bytes, window: int = WINDOW) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text; words
    per line, failed rules (one row per rule) per line, places of the line feeds."""
    raw = np.frombuffer(text, np.uint8)
    word, symbol = WORD[raw], _symbol[raw]
    words, names = numbered(text)
    breaks = np.flatnonzero(raw == 10)
    lines = len(breaks) + 1
    begin = word.copy()
    begin[1:] &= ~word[:-1]
    line = np.searchsorted(breaks, np.flatnonzero(begin))
    per = np.bincount(line, minlength=lines)
    last = np.cumsum(per) - 1

    separators = [names[s] for s in _separators if s in names]
    mark = _mark[raw]
    run = mark[:-1] & mark[1:]
    run[1:] &= ~mark[:-2]
    same = np.flatnonzero((words[1:] == words[:-1]) & (line[1:] == line[:-1])) + 1
    echoes = np.bincount(line[same], minlength=lines)
    failed = np.zeros((len(RULES), lines), bool)
    failed[1] = 4 * per_line(np.flatnonzero(symbol), breaks) > per
    failed[2] = 3 * per_line(np.flatnonzero(run), breaks) > per
    failed[3] = np.bincount(line[np.isin(words, separators)], minlength=lines) >= 3
    failed[4] = 2 * echoes > per
    failed[4][np.searchsorted(breaks, places_of_phrases(text))] = True

    spelled = list(names)
    bounds = np.concatenate(([0], breaks + 1)).tolist(), np.append(breaks, len(text)).tolist()
    seen: set[bytes] = set()
    twice = 0
    for i in np.flatnonzero(per).tolist():
        own = text[bounds[0][i] : bounds[1][i]]
        failed[0, i] = not spelled[words[last[i]]].endswith(_ends)
        if per[i] < 3 and b" ".join(spelled[w] for w in words[last[i] + 1 - per[i] : last[i] + 1]).lower() in _leads:
            failed[3, i] = True
        if own in seen:
            twice += 1
            failed[4, i] = True
        else:
            seen.add(own)
    failed &= per > 0
    numbers = [len(words), int((word & _point[raw]).sum()), int(symbol.sum()), twice, in_repeats(words, window)]
    return numbers, per, failed, breaks


def rows_of(window: int, least: int, percent: int, repeated: int, with_text: bool):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = binaries(batch.column(0))
            counts, verdicts, lost, texts = [], [], [], []
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
                text = data[a:b].tobytes()
                numbers, per, failed, breaks = judged(text, window)
                gone = failed.any(axis=0)
                bad = numbers[0] < least or 100 * numbers[4] > repeated * numbers[0]
                removed = int(per[gone].sum())
                counts.append(numbers)
                verdicts.append((bad, not bad and 100 * removed <= percent * numbers[0]))
                lost.append([removed, *failed.sum(axis=1).tolist()])
                if with_text:
                    texts.append(b"\n".join(p for p, g in zip(text.split(b"\n"), gone.tolist()) if not g).decode())
            columns = [pa.array([c[i] for c in counts], pa.int64()) for i in range(5)]
            columns += [pa.array([v[i] for v in verdicts], pa.bool_()) for i in range(2)]
            columns += [pa.array([n[i] for n in lost], pa.int64()) for i in range(len(RULES) + 1)]
            if with_text:
                columns.append(pa.array(texts, pa.string()))
            yield pa.RecordBatch.from_arrays([*columns, batch.column(1)], names=[*output(with_text), "id"])

    return each


def output(with_text: bool) -> list[str]:
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lost_words"]
    return [*counts, *[f"failed_{r}" for r in RULES], *["text"] * with_text]


def line_verdicts(
    docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW, least: int = LEAST,
    percent: int = PERCENT, repeated: int = REPEATED, with_text: bool = False,
) -> DataFrame:
    """id, the counts, `base_failed`, `kept`, `n_lost_words` (words of failing lines)
    and the failing lines per rule (`failed_<rule>`) of every row; with `text` the lines that pass."""
    kinds = {"base_failed": "boolean", "kept": "boolean", "text": "string"}
    kind = docs.schema[id].dataType.simpleString()
    schema = ", ".join(f"{c} {kinds.get(c, 'long')}" for c in output(with_text)) + f", id {kind}"
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    found = docs.select(body.alias("body"), F.col(id).alias("id")).mapInArrow(
        rows_of(window, least, percent, repeated, with_text), schema
    )
    return found.select(F.col("id").alias(id), *output(with_text))


def cleaned(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """id and cleaned `text` of the documents that stay."""
    found = line_verdicts(docs, id, text, with_text=True, **options)
    return found.where("kept").select(id, F.col("text").alias(text))
