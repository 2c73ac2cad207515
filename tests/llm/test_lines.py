import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapmill.llm import lines
from snapmill.llm.lines import drop_repeated_lines, keep_bitmaps

SPACE = " \t\n\x0b\x0c\r"


def lowered(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def expected(rows, least=10):
    """(doc_id, kept or not per line) of each row, by a dictionary of all lines; null ids come last."""
    rank = lambda i: (i is None, i)
    first = {}
    for i, text in rows:
        for key in map(lowered, (text or "").split("\n")):
            if key not in first or rank(i) < rank(first[key]):
                first[key] = i
    return [(i, t, [len(k) < least or first[k] == i for k in map(lowered, (t or "").split("\n"))]) for i, t in rows]


def check(df, **options):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    want = expected(rows, **options)
    bitmaps = [
        (r.doc_id, r.n_lines, r.n_dropped, np.unpackbits(np.frombuffer(zlib.decompress(r.keep_bitmap), np.uint8), count=r.n_lines).tolist())
        for r in keep_bitmaps(df, **options).collect()
    ]
    assert sorted(map(repr, bitmaps)) == sorted(repr((i, len(k), k.count(False), [int(x) for x in k])) for i, _, k in want)
    kept = drop_repeated_lines(df, **options)
    assert kept.columns == df.columns
    texts = sorted(repr((r.doc_id, r.text)) for r in kept.select("doc_id", "text").collect())
    assert texts == sorted(repr((i, None if t is None else "\n".join(x for x, y in zip(t.split("\n"), k) if y))) for i, t, k in want)
    return sum(k.count(False) for _, _, k in want)


def test_which_lines_go(table):
    rows = [
        (3, "a common line of text\nown line number three\n\nshort"),
        (1, "  A Common LINE of text\t\nshort\n"),
        (2, "a common line of text \r\na common line of text"),
        (4, "twice within four only\ntwice within four only"),
        (5, "ÄÖÜ äöü äöü"),
        (6, "äöü äöü äöü"),
        (7, "ten chars!\n\n"),
        (8, "ten chars!"),
        (9, "nine char\n\xa0nine char"),
        (10, "nine char"),
    ]
    assert check(table(rows)) == 4


def test_odd_rows(odd, table):
    check(odd)
    check(odd, least=1)
    check(table([]))
    check(table([(None, "the same long line"), (None, "the same long line\nand one more"), (9, "THE SAME LONG LINE")]))
    assert check(table([(None, "the same long line")] * 3)) == 0


@pytest.mark.parametrize("seed", range(3))
def test_ranges_that_share_a_hash(spark, table, seed, monkeypatch):
    """Few lines, each in most documents: every one spans many ranges."""
    monkeypatch.setattr(lines, "RANGE_BYTES", 400)
    odds = random.Random(seed)
    common = [f"common line number {i}" for i in range(3)]
    rows = [
        (odds.choice([None, *range(300)]), "\n".join(odds.choice([*common, f"own line of some {i}", "tiny"]) for _ in range(odds.randrange(1, 30))))
        for i in range(300)
    ]
    assert check(table(rows)) > 1000


def test_small_batches(spark, table):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = [(i % 40, "a line of every text\n" * (i % 5) + f"line {i % 9} of nine") for i in range(200)]
        check(table(rows))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_clashing_columns_stay(spark):
    schema = "key map<string,int>, doc_id string, hash int, text string, document int, n_lines string, `a.b` int, position int"
    df = spark.createDataFrame([({"x": 1}, "b", 1, "some longer line", 2, "n", 3, 4), (None, "a", 5, "Some Longer Line", 6, None, 7, 8)], schema)
    check(df)
    kept = {r.doc_id: r for r in drop_repeated_lines(df).collect()}
    assert kept["b"].asDict() == {"key": {"x": 1}, "doc_id": "b", "hash": 1, "text": "", "document": 2, "n_lines": "n", "a.b": 3, "position": 4}
    assert kept["a"].text == "Some Longer Line"


def test_keep_bitmaps_carry_no_text(table):
    assert [f for f, t in keep_bitmaps(table([(1, "x")])).dtypes if t == "string"] == []
    assert keep_bitmaps(table([(1, "line\n" * 100_000)])).select(F.length("keep_bitmap")).first()[0] < 100
