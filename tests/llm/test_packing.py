import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.fixtures import edge_rows, table
from tokenizers import Tokenizer

from knnrec.llm import packing


def fewest(items, capacity):
    """Exact number of sequences, by search."""
    items = sorted(items, reverse=True)
    best = [len(items)]

    def place(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(items):
            best[0] = len(rooms)
            return
        for r in sorted(set(rooms)):
            if r >= items[k]:
                rest = list(rooms)
                rest[rest.index(r)] -= items[k]
                place(k + 1, rest)
        place(k + 1, [*rooms, capacity - items[k]])

    place(0, [])
    return best[0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_reduction_keeps_the_optimum(items):
    counts = np.bincount(items, minlength=21).astype(np.int64) if items else np.zeros(21, np.int64)
    left = counts.copy()
    runs = packing.reduce_instance(left, 20)
    assert all(sum(k * n for k, n in p.items()) <= 20 for p, _ in runs)
    rest = [k for k in range(21) for _ in range(left[k])]
    fixed = [k for p, t in runs for k, n in p.items() for _ in range(n * t)]
    assert sorted(fixed + rest) == sorted(items)
    assert sum(t for _, t in runs) + fewest(rest, 20) == fewest(items, 20)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 5000), max_size=40))
def test_runs_pack_everything(sizes):
    counts = np.zeros(65, np.int64)
    for k, n in sizes.items():
        counts[k] = n
    runs = packing.solve(counts, 64)
    used = np.zeros(65, np.int64)
    for pattern, times in runs:
        assert times > 0 and sum(k * n for k, n in pattern.items()) <= 64
        for k, n in pattern.items():
            used[k] += n * times
    assert (used == counts).all()
    total = int((counts * np.arange(65)).sum())
    if max(sizes, default=0) <= 16:  # all sequences but one are over three quarters full
        assert sum(t for _, t in runs) <= total / 48 + 1
    assert len(packing.lay_out(runs, 64)["length"]) <= 64 * 64


def test_best_fit_of_a_known_case():
    counts = np.zeros(11, np.int64)
    counts[[6, 5, 4, 3, 2]] = [1, 2, 1, 1, 1]
    assert sum(t for _, t in packing.solve(counts, 10)) == 3


NASTY = ["", " ", "a", "<|endoftext|>", "x<|endoftext|>y <|endoftext|>", "naïve café́ ​", "\U0001f600\U0001f468‍\U0001f469", "tab\tnew\nline\r\n\x0b\x0c", "don't WE'LL 123,456.78", "  spaces   inside  ", "漢字かな交じり文", "\x00\x01�", "a" * 3000]


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60))
def test_ids_equal_those_of_the_json_vocabulary(text):
    _same(text)


@pytest.mark.parametrize("text", NASTY)
def test_ids_of_nasty_texts(text):
    _same(text)


_JSON = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def _same(text):
    own = packing.encoder("byte_bpe_50k.tiktoken").encode(text, allowed_special="all")
    assert own == _JSON.encode(text, add_special_tokens=False).ids


LONG = [" " * 1_100_000, *(space * 1_100_000 + "x" for space in "\t\n\u00a0"), "a" + " " * 1_100_000 + "<|endoftext|>b" * 3]


def test_long_runs_of_white_space(spark):
    """Runs that the rank file's pattern cannot take."""
    ids_of = packing.ids_of("byte_bpe_50k.tiktoken")
    for text in LONG:
        assert ids_of(text) == _JSON.encode(text, add_special_tokens=False).ids
    short = " " * (packing.LONG_SPACE - 1) + "x"
    assert not packing.has_long_space(short) and ids_of(short) == _JSON.encode(short, add_special_tokens=False).ids
    out = packing.pack(table(spark, [(k, t, "en", "s", 1) for k, t in enumerate(LONG)])).collect()
    sizes = {k: 1 + len(_JSON.encode(t, add_special_tokens=False).ids) for k, t in enumerate(LONG)}
    got = {}
    for r in out:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == sizes


@pytest.mark.parametrize("capacity", [16, 1024])
def test_pack_round_trip(spark, capacity):
    rows = edge_rows()
    out = packing.pack(table(spark, rows, clash=True), capacity).collect()
    want = {}
    for doc_id, text, *_ in rows:
        ids = np.array(_JSON.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        want.setdefault(doc_id, []).append(ids)
    places, pieces = {}, {}
    for r in out:
        ids = want[r["doc_id"]][0]
        assert zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        pieces.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"]))
    for spans in places.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= capacity
    for doc_id, copies in want.items():
        n = len(copies[0])
        first = (n - 1) % capacity + 1
        cuts = [(0, 0, first)] + [(k, first + (k - 1) * capacity, capacity) for k in range(1, -(-n // capacity))]
        assert sorted(pieces[doc_id]) == sorted(cuts * len(copies))


def test_empty_table(spark):
    assert packing.pack(table(spark, [])).count() == 0


def test_near_optimal_on_many_documents():
    rng = random.Random(1)
    counts = np.zeros(1025, np.int64)
    for _ in range(50_000):
        counts[min(1024, int(rng.lognormvariate(5, 1)) + 1)] += 1
    total = int((counts * np.arange(1025)).sum())
    assert sum(t for _, t in packing.solve(counts, 1024)) <= -(-total // 1024) + 5
