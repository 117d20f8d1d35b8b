import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from rows import documents, empty, texts
from staylens.llm.packing import Encoder, packed, plan
from staylens.llm.queries import vocabulary
from staylens.llm.token_counts import counter, token_counts

WORD, BYTE = vocabulary("word_bpe_49k.json"), vocabulary("byte_bpe_50k.json")
TEXT = st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("abcdeéßΣİ '|<>  \n\t12")), max_size=60)


def library(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_counts_equal_the_library(text):
    assert counter(WORD).count(text) == len(library_word.encode(text, add_special_tokens=False).ids)


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_ids_equal_the_library(text):
    assert list(encoder_byte.ids(text)) == library_byte.encode(text, add_special_tokens=False).ids


library_word, library_byte, encoder_byte = library(WORD), library(BYTE), Encoder(BYTE)


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from("abcdefghinorstu '1!é"), max_size=40))
def test_every_prefix(text):
    seen = text.lower()
    want = [len(library_word.encode(seen[:i], add_special_tokens=False).ids) for i in range(len(seen) + 1)]
    assert counter(WORD).prefix_counts(text) == want
    for budget in range(0, max(want) + 2):
        assert counter(WORD).fitting(text, budget) == max(i for i, n in enumerate(want) if n <= budget)


def test_counts_of_awkward_rows(spark):
    got = sorted(map(tuple, token_counts(documents(spark), WORD, fits=True).drop("fitting").collect()), key=repr)
    want = []
    for d, t, _ in texts():
        n = len(library_word.encode(t or "", add_special_tokens=False).ids)
        want.append((d, len((t or "").encode()), n, n > 2048))
    assert got == sorted(want, key=repr)
    assert token_counts(empty(spark), WORD).count() == 0


def ids_of(text):
    return [*library_byte.encode(text or "", add_special_tokens=False).ids, 0]


def test_packing_holds_every_piece_once(spark):
    rows = texts()
    found = packed(documents(spark), BYTE, with_ids=True).collect()
    want = []
    for d, t, _ in rows:
        ids = ids_of(t)
        first = len(ids) % 2048 or min(2048, len(ids))
        cuts = [0, *range(first, len(ids), 2048), len(ids)] if len(ids) > 2048 else [0, len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want.append((d, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    sequences: dict = {}
    for r in found:
        assert len(r["ids"]) == r["length"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    assert packed(empty(spark), BYTE).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plan_is_close_to_the_bound(seed):
    rnd = np.random.default_rng(seed)
    lengths = rnd.integers(1, (2049, 900, 300, 2049)[seed], 30_000)
    counts = np.bincount(lengths, minlength=2049)
    lines = plan(counts, 2048)
    used = np.zeros(2049, np.int64)
    for times, filled in lines:
        assert sum(filled) <= 2048
        np.add.at(used, filled, times)
    assert (used == counts).all()
    assert sum(t for t, _ in lines) <= 1.02 * lengths.sum() / 2048 + 1


def test_two_pieces_replace_the_smallest():
    counts = np.zeros(11, np.int64)
    counts[[6, 3, 2]] = 1, 1, 2  # 6 + 3 leaves 1; 2 + 2 in place of 3 leaves none
    assert sorted(plan(counts, 10)[0][1]) == [2, 2, 6]
