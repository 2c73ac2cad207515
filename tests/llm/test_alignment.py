from collections import Counter

import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from snapmill.llm import alignment
from snapmill.llm.alignment import align, default_pieces, link_counts
from snapmill.llm.packing import default_vocabulary

A = Tokenizer.from_file(default_vocabulary())
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=default_pieces())
ALPHABET = {chr(b): b for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}
ALPHABET |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in ALPHABET.values())}


def tokens(text):
    """(id, start, end) of both sides, or none."""
    if not text:
        return None
    sides = []
    a = A.encode(" " + text, add_special_tokens=False)
    sides.append([(i, bytes(ALPHABET[c] for c in t)) for i, t in zip(a.ids, a.tokens)])
    pieces = [(i, B.id_to_piece(i)) for i in B.encode(text)]
    sides.append([(i, bytes([int(p[3:5], 16)]) if B.is_byte(i) else p.replace("▁", " ").encode()) for i, p in pieces])
    placed = []
    for side in sides:
        if b"".join(t for _, t in side) != (" " + text).encode():
            return None
        at, own = 0, []
        for i, t in side:
            own.append((i, at, at + len(t)))
            at += len(t)
        placed.append(own)
    return placed


def expected(rows):
    found = []
    for doc_id, text in rows:
        sides = tokens(text)
        if sides is None:
            found.append((doc_id, 0, 0, 0, "", []))
            continue
        a, b = sides
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, start = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for i, s, e in side if start <= s and e <= end) for side in sides))
            start = end
        links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
        found.append((doc_id, len(a), len(b), len(groups), ";".join(groups), links))
    count = Counter(p for *_, links in found for p in links)
    best: dict[int, int] = {}
    for (_, j), n in count.items():
        best[j] = max(best.get(j, 0), n)
    return [
        (i, n_a, n_b, n_groups, len(links), groups, sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links))
        for i, n_a, n_b, n_groups, groups, links in found
    ]


def check(df):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    out = link_counts(align(df))
    own = [(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.groups, r.n_best, r.count_sum) for r in out.collect()]
    assert sorted(map(repr, own)) == sorted(map(repr, expected(rows)))


def test_odd_rows(table):
    texts = [
        "The quick brown fox", "", None, " ", "  two  spaces\n\tand a tab\r\n", "naïve café — 漢字かな 🙂🙂 x", "▁marked", "a▁b",
        "<|endoftext|>", "<s>x</s><unk><0x41>", "\x00\x01", "﻿ﬁ", "aaaaaaaaaaaaaaaaaaaa", "1234567890", "é",
    ]
    check(table([*enumerate(texts), (None, "The quick brown fox"), (None, None), (3, "The quick brown fox"), (3, "The quick brown fox")]))
    check(table([]))
    check(table([(1, None), (2, "")]))


def test_long_text_and_many(table):
    check(table([(0, "wordy antidisestablishmentarianism " * 300)] + [(i, f"number {i} of Überlänge {i * i}") for i in range(1, 120)]))


@pytest.mark.parametrize("size", [40, 1000])
def test_chunks_and_slices_do_not_matter(spark, size, monkeypatch):
    monkeypatch.setattr(alignment, "SLICE", size)
    monkeypatch.setattr(alignment, "CHUNK", 3 * size)
    df = spark.createDataFrame([(str(i), f"short text {i % 7} über alles", i) for i in range(60)], "doc_id string, text string, chunk int")
    check(df.coalesce(2))


def test_groups_may_be_left_out(table):
    out = link_counts(align(table([(1, "some text")])).withColumn("size", F.length("groups")).drop("groups"))
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "size", "n_best", "count_sum"]
    assert out.first().size == len(expected([(1, "some text")])[0][5])
