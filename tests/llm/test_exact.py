import hashlib
import re
from collections import Counter, defaultdict

import pytest

from snapmill.llm.exact import drop_exact_copies, exact_groups, frequent_values, shrink


def expected(rows):
    groups = defaultdict(list)
    for i, (doc_id, text) in enumerate(rows):
        plain = re.sub("[ \t-\r]", "", text or "")
        groups[hashlib.sha256(plain.encode()).hexdigest()].append((-len(text or ""), doc_id is None, doc_id or 0, i, doc_id))
    out = []
    for sha, members in groups.items():
        best = min(members)
        out += [(m[4], best[4], len(members), m == best, sha) for m in members]
    return sorted(map(repr, out))


def found(df, counters):
    cols = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted(repr(tuple(r)) for r in exact_groups(df, counters).select(*cols).collect())


@pytest.mark.parametrize("counters", [1, 3, 1024])  # all shuffled, some, all broadcast
def test_groups_match_brute_force(table, odd, counters):
    rows = [(i, "ab c" if i % 3 else f"a{i} b\n{i % 7} ") for i in range(60)] + [(99, "abc"), (98, "a b  c")]
    assert found(table(rows), counters) == expected(rows)
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert found(odd, counters) == expected(rows)


def test_no_documents(table):
    assert exact_groups(table([])).count() == 0
    assert drop_exact_copies(table([])).count() == 0


def test_one_row_of_each_group_stays_with_its_columns(odd):
    kept = drop_exact_copies(odd)
    assert kept.columns == odd.columns
    texts = [re.sub(r"\s", "", r.text or "") for r in kept.collect()]
    assert sorted(texts) == sorted({re.sub(r"\s", "", r.text or "") for r in odd.collect()})


def test_misra_gries_keeps_what_is_frequent(spark, table):
    assert shrink(Counter(a=5, b=3, c=1), 2) == Counter(a=4, b=2)
    df = table([(i, "hot" if i % 3 == 0 else str(i)) for i in range(3000)])
    values = frequent_values(df, "text", 8)
    assert "hot" in values and len(values) <= 8
