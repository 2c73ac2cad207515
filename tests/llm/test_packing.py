import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from snapmill.llm.packing import Encoder, default_vocabulary, pack, sum_of_squares

ENCODE = Encoder(default_vocabulary())


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \t\n\r'sdlabc<|>")), max_size=60))
def test_ids_are_those_of_the_vocabulary_file(text):
    assert ENCODE(text).tolist() == ENCODE.whole.encode(text, add_special_tokens=False).ids


def test_special_tokens_in_a_text():
    text = "a<|endoftext|>b"
    assert ENCODE(text).tolist() == ENCODE.whole.encode(text, add_special_tokens=False).ids


def check(df, capacity, **options):
    rows = pack(df, capacity, **options).collect()
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    want = []
    for d in df.collect():
        ids = np.append(ENCODE(d.text or ""), np.uint32(0)).astype("<u4")
        first = len(ids) % capacity or capacity
        edges = [0, *range(first, len(ids) + 1, capacity)]
        want += [repr((d.doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes()))) for k, (a, b) in enumerate(zip(edges, edges[1:]))]
    assert sorted(repr((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in rows) == sorted(want)
    return len(sequences), sum(r.length for r in rows)


def test_pieces_and_places(table, odd):
    check(odd, 64)
    check(odd, 2048, group_pieces=4)
    check(table([]), 64)
    rows = [(i, "some words to pack " * (i * 7919 % 40 + 1)) for i in range(300)]
    n, tokens = check(table(rows), 256)
    assert n <= -(-tokens // 256) * 1.05 + 1


def test_sum_of_squares_takes_the_least_sum():
    odds = np.random.default_rng(0)
    lengths = odds.integers(1, 31, 400)
    sequence, offset = sum_of_squares(lengths, 30)
    filled: dict[int, int] = {}
    for s, q, o in zip(lengths.tolist(), sequence.tolist(), offset.tolist()):
        gaps = [30 - f for f in filled.values()]

        def squares(gaps):
            counts = np.bincount([g for g in gaps if 0 < g < 30], minlength=31)
            return int((counts**2).sum())

        options = [squares(gaps[:i] + [g - s] + gaps[i + 1 :]) for i, g in enumerate(gaps) if g >= s] + [squares([*gaps, 30 - s])]
        assert filled.get(q, 0) == o
        filled[q] = o + s
        assert squares([30 - f for f in filled.values()]) == min(options)
