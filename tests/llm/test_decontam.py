import random

import pytest

from snapmill.llm.decontam import Powers, Templates, canonical, contaminations, drop_contaminated

ITEM = "Tom has 3 apples and Anna gives him 5 more apples so how many apples does Tom have in total now"


def kinds(text):
    read = canonical([text], Powers())
    return [(read.spelled(i).decode(), int(read.kind[i])) for i in range(len(read.kind))]


def test_placeholders():
    assert kinds("It weighs 3.5 kg, É lan Ébo costs $1,000. Next “Quoted” kg") == [
        ("it", 0), ("weighs", 0), ("3.5", 2), ("kg", 3), ("é", 0), ("lan", 0), ("ébo", 1), ("costs", 0),
        ("$", 3), ("1,000", 2), ("next", 0), ("quoted", 1), ("kg", 0),
    ]


@pytest.mark.parametrize(
    "text, hit",
    [
        (ITEM, True),
        ("Then we read that " + ITEM.lower().replace("tom", "Tom").replace("anna", "Anna"), True),
        ("So, " + ITEM.replace("3", "17").replace("5", "20").replace("Tom", "Bob").replace("Anna", "Eve"), True),
        ("So, " + ITEM.replace("Tom", "Bob", 1), True),  # no single replacement, but words 2 to 20 are equal
        ("So, " + ITEM.replace("Tom", "Bob", 1).replace("apples", "pears", 1), True),  # as are words 5 to 20
        ("So, " + ITEM.replace("Tom", "Bob", 1).replace("more", "less"), False),
        ("So, " + ITEM.replace("apples", "pears"), False),
        (ITEM[:40], False),
        ("", False),
        (None, False),
    ],
)
def test_reparameterised_items(text, hit):
    templates = Templates([(1, ITEM)], 13, 8)
    assert bool(templates.hits([None, text], Powers())) == hit


def test_every_planted_item_is_found_and_no_other(spark, table):
    odds = random.Random(1)
    word = lambda: "".join(odds.choices("abcdefgh", k=5))
    items = [(i, " ".join(word() for _ in range(odds.randrange(9, 40)))) for i in range(30)]
    rows, want = [], set()
    for d in range(200):
        parts = [word() for _ in range(odds.randrange(50))]
        if d % 4 == 0:
            i, text = odds.choice(items)
            parts.insert(odds.randrange(len(parts) + 1), text.replace(" ", odds.choice([" ", "\n", ", "])))
            want.add((d, i))
        rows.append((d, " ".join(parts)))
    bench = spark.createDataFrame([(*x, "q") for x in items], "item_id long, text string, doc_id string")
    for words in (500_000, 60):  # one block, many blocks
        got = contaminations(table(rows), bench, block_words=words).collect()
        assert {(r.doc_id, r.item_id) for r in got} == want
        assert all(r.n_windows >= 1 for r in got)
    kept = drop_contaminated(table(rows), bench)
    assert kept.columns == table(rows).columns
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in rows} - {d for d, _ in want}


def test_odd_rows(spark, odd, table):
    bench = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog and runs far"), (None, None), (3, "")], "item_id long, text string")
    got = contaminations(odd, bench).collect()
    assert sorted(map(repr, (r.doc_id for r in got))) == sorted(["1", "2", "2", "None"])
    assert contaminations(table([]), bench).count() == 0
    assert contaminations(odd, bench.limit(0)).count() == 0
    assert drop_contaminated(odd, bench).count() == odd.count() - 4


@pytest.mark.parametrize(
    "text, n",
    [
        ("So, " + ITEM.replace("3", "4").replace("5", "4"), 9),  # two values become one
        ("So, " + ITEM.replace("Tom", "Eve").replace("Anna", "Eve"), 9),
    ],
)
def test_slots_need_not_be_one_to_one(text, n):
    assert Templates([(1, ITEM)], 13, 8).hits([text], Powers()) == {(0, 1): n}


def test_a_number_that_changes_once_leaves_the_other_windows():
    item = "we counted 3 birds on the old roof of the barn and then at the far end of the yard we saw 3 more of them"
    found = Templates([(1, item)], 13, 8).hits([item, item[::-1].replace("3", "9", 1)[::-1]], Powers())
    assert found == {(0, 1): 14, (1, 1): 14}
    both = "in all there were 3 red birds and 3 blue birds up on the roof"
    templates = Templates([(1, both)], 13, 8)
    assert templates.hits([both.replace("3", "7")], Powers()) and not templates.hits([both.replace("3", "7", 1)], Powers())


PROBLEM = "Tom has 3 apples. Anna gives him 5 more. Tom buys 2 pears. How many fruits does Tom have?"
STORY = "Then the old man went home to his small house by the river and slept for many hours"


def exchanged(text):
    return text.replace("Tom", "Bob").replace("Anna", "Eve").replace("3", "7")


@pytest.mark.parametrize(
    "item, text",
    [
        (PROBLEM, exchanged(PROBLEM)),
        (PROBLEM, "We read: " + exchanged(PROBLEM)),
        (PROBLEM, exchanged(PROBLEM).replace(". How", ", how").replace(".", ";")),
        (PROBLEM + " He wonders how.", exchanged(PROBLEM).replace(". How", ", how")),
        (PROBLEM, PROBLEM.lower()),
        (PROBLEM, PROBLEM.upper()),
        (PROBLEM, PROBLEM.replace(".", "")),
        (STORY, STORY.title()),
        (STORY, STORY.upper()),
    ],
)
def test_names_that_begin_sentences_and_changed_case(item, text):
    assert Templates([(1, item)], 13, 8).hits(["Anna has 3 pears. How many?", text], Powers()).keys() == {(1, 1)}


def test_more_readings_take_no_hit_away():
    item = "He saw the red barn at the end of the road there. He went on to the next farm with his old dog that day"
    text = item.replace("He saw", "She saw")
    assert Templates([(1, item)], 13, 8).hits([text], Powers())


@pytest.mark.parametrize(
    "item, other",
    [
        ("Which gas do plants take in?", "Which gas do plants give off?"),
        ("Add 12 and 30, 5 and 7, 9 and 11, 40 and 2.", "Add 12 and 30, 5 and 7, 9 and 11, 40 and 3."),
        ("Tom met Anna, Eve, Bob, Carl, Dora and Fred in 1999", "Tom met Anna, Eve, Bob, Carl, Dora and Max in 1999"),
        ("12 + 30 = 42", "12 + 30 = 43"),
    ],
)
def test_windows_of_few_literal_words_are_found_as_spelled(item, other):
    texts = [f"We ask. {item} So it goes.", f"We ask. {other} So it goes.", item.lower()]
    assert Templates([(1, item)], 13, 8).hits(texts, Powers()).keys() == {(0, 1), (2, 1)}


def by_brute_force(item, text, window=13, literals=8):
    """Windows of one sentence that hit, by all alignments and windows; both begin with a word in lower case."""
    names, units = {"Tom", "Anna", "Bob", "Eve"}, {"kg", "miles"}

    def read(words):
        kinds = ["number" if w.isdigit() else "name" if w in names else "word" for w in words]
        return [(("unit" if w in units and i and kinds[i - 1] == "number" else k), w) for i, (w, k) in enumerate(zip(words, kinds))]

    ours, theirs = read(item.split()), read(text.split())
    width, hits = min(window, len(ours)), set()
    for shift in range(-len(ours), len(theirs)):
        literal, alike, named, broken = set(), set(), {}, False
        for at in range(len(theirs) - width + 1):
            if not 0 <= at - shift <= len(ours) - width:
                continue
            pairs = list(zip(ours[at - shift : at - shift + width], theirs[at : at + width]))
            if all(a[1].lower() == b[1].lower() for a, b in pairs):
                literal.add(at)
            if sum(a[0] == "word" for a, _ in pairs) < literals:
                continue
            if any(a[0] != b[0] or (a[0] == "word" and a != b) for a, b in pairs):
                continue
            if not single_valued((a, b) for a, b in pairs if a[0] in ("number", "unit")):
                continue
            if single_valued([*named.items(), *((a, b) for a, b in pairs if a[0] == "name")]):
                named.update((a, b) for a, b in pairs if a[0] == "name")
                alike.add(at)
            else:
                broken = True
        hits |= literal if broken else literal | alike
    return len(hits)


def single_valued(pairs):
    seen = {}
    return all(seen.setdefault(a, b) == b for a, b in pairs)


@pytest.mark.parametrize("seed", range(4))
def test_windows_by_brute_force(seed):
    """Items copied whole or in part, with words, names, numbers and units changed here and there."""
    odds, found = random.Random(seed), 0
    pick = lambda: odds.choice(["red", "barn", "went", "over", "old", "seven", "they", "bought", "Tom", "Anna", "3", "5", "kg", "miles"])
    swap = {"Tom": ["Bob", "Anna"], "Anna": ["Eve", "Tom"], "3": ["7", "5"], "5": ["9"], "kg": ["miles"], "miles": ["kg"]}
    for _ in range(60):
        item = ["so", *(pick() for _ in range(odds.randrange(5, 30)))]
        everywhere = {w: odds.choice(s) for w, s in swap.items() if odds.random() < 0.5}
        copy = [everywhere.get(w, w) if odds.random() < 0.97 else pick() for w in item]
        a = odds.randrange(3) * (len(item) > 20)
        text = " ".join(["then", *(pick() for _ in range(5)), "of", *copy[a : len(copy) - a], "and", *(pick() for _ in range(5))])
        got = Templates([(1, " ".join(item))], 13, 8).hits([text], Powers()).get((0, 1), 0)
        assert got == by_brute_force(" ".join(item), text), (item, text)
        found += got > 0
    assert 10 < found < 60
