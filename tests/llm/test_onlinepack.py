"""Online packing: every id in exactly one piece, gapless places, no padding, cuts as counted by hand."""

import random
import zlib

import numpy as np
import pytest

from talweg.llm import onlinepack
from talweg.llm.common import tokenizer_path
from talweg.llm.onlinepack import Piece, Windows

NAMES = ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")
DOCS = "doc_id long, text string, length int, sequence_id int, lot int, ids int"


def pack(spark, texts, ids=None, **settings):
    rows = [(i, t, 1, 2, 3, 4) for i, t in zip(ids or range(len(texts)), texts)]
    return onlinepack.pack_online(spark.createDataFrame(rows, DOCS).repartition(5), *map(tokenizer_path, NAMES), **settings).collect()


def library_ids(texts, end=1):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(tokenizer_path(NAMES[0]))
    return [library.encode(t or "", add_special_tokens=False).ids + [end] for t in texts]


def check_places(rows, length):
    """Sequences are gapless, and all hold ``length`` tokens but those at smaller powers of two."""
    filled = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)
        assert r.length > 0
        filled[r.sequence_id] = r.offset + r.length
    short = sorted(n for n in filled.values() if n != length)
    assert all(n & (n - 1) == 0 and n < length for n in short)
    assert len(set(short)) == len(short)
    return filled


@pytest.mark.parametrize("settings", [{}, {"length": 64, "most": 3, "fan": 2}, {"length": 8, "most": 1, "fan": 2}])
def test_pieces_cover_the_ids_of_the_library(spark, settings):
    rng = random.Random(7)
    texts = [" ".join(rng.choice(["alpha", "beta", "日本", "ﬁ", "12345"]) for _ in range(rng.randrange(300))) for _ in range(120)]
    texts += [None, "", "<|endoftext|>", "a " * 9000]
    rows, wanted = pack(spark, texts, **settings), library_ids(texts)
    filled = check_places(rows, settings.get("length", 2048))
    assert sum(filled.values()) == sum(map(len, wanted))
    for doc, ids in enumerate(wanted):
        at = 0
        for r in sorted((r for r in rows if r.doc_id == doc), key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)


def test_repeated_and_null_ids_empty_and_tiny_tables(spark):
    rows = pack(spark, ["a b", "a b", None, None, ""], [1, 1, None, None, 2])
    assert sum(check_places(rows, 2048).values()) == 2 * 3 + 3
    assert sorted((r.doc_id is None, r.doc_id) for r in rows if r.start == 0) == [(False, 1), (False, 1), (False, 2), (True, None), (True, None)]
    nothing = spark.createDataFrame([], DOCS)
    assert onlinepack.pack_online(nothing, *map(tokenizer_path, NAMES)).count() == 0


def windows_of(sizes, length, most):
    windows = Windows(length, most)
    for i, n in enumerate(sizes):
        windows.add([Piece(i, 0, n, bytes(4 * n))], i)
    return windows


def test_best_fit_and_the_fullest_goes_first():
    windows = windows_of([6, 8], 10, 2)
    windows.add([Piece(2, 0, 2, bytes(8))], 2)  # fits exactly behind the 8
    assert [r[0] for r in windows.done] == [1, 2]
    windows = windows_of([6, 8], 10, 2)
    windows.add([Piece(2, 0, 5, bytes(20))], 2)  # fits nowhere: the 8 is filled with 2, and 3 go behind the 6
    assert [(r[0], r[1], r[2], r[6]) for r in windows.done] == [(1, 0, 8, 0), (2, 0, 2, 8)]
    assert windows.rooms == [(1, 0)]


def test_open_windows_stay_bounded():
    rng = random.Random(1)
    windows = Windows(50, 4)
    for i in range(3000):
        n = rng.randrange(1, 51)
        windows.add([Piece(i, 0, n, bytes(4 * n))], i)
        assert len(windows.rooms) <= 4
        assert windows.rooms == sorted(windows.rooms)
        for room, sequence in windows.rooms:
            assert 0 < room == 50 - sum(p.size for p in windows.pieces[sequence])
    windows.merge()
    assert len(windows.rooms) <= 1


def test_merging_leaves_less_than_one_window_in_any_state():
    rng = random.Random(2)
    for _ in range(200):
        most = rng.randrange(1, 9)
        sizes = [rng.randrange(1, 20) for _ in range(rng.randrange(12))]
        windows = windows_of(sizes, 20, most)
        windows.merge()
        held = sum(p.size for pieces in windows.pieces.values() for p in pieces)
        assert held < 20
        assert sum(r[2] for r in windows.done) + held == sum(sizes)
