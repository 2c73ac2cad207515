import random
import zlib

import numpy as np
import pytest

import snapmill.llm.toxicity as toxicity_module
from snapmill.llm.toxicity import SYMBOL_AT, SYMBOL_OF, SYMBOLS, Spelling, joined, logistic, points, restored, toxicity
from snapmill.llm.windows import Powers, mix, span_hashes

WORDS = "the of and to in that is was for on with as this from by are they have been would their when there which could people because through before think".split()
BAD = "grobnak vilespit dunderol".split()


def spelling():
    at = SYMBOL_OF[points(joined([" ".join(WORDS + BAD * 3)] * 50))].astype(int)
    return Spelling(np.bincount((at[:-2] << 12) | (at[1:-1] << 6) | at[2:], minlength=SYMBOLS**3))


@pytest.mark.parametrize(
    "said, meant",
    [
        ("gr0bn4k", "grobnak"), ("v1le5p1t", "vilespit"), ("g r o b n a k", "grobnak"), ("d.u.n.d.e.r.o.l", "dunderol"),
        ("d-u-n-d-e-r-0-l", "dunderol"), ("dunderoool", "dunderol"), ("gr*bnak", "grobnak"), ("$", "$"), ("2024", "2024"),
        ("people", "people"), ("a b", "a b"), ("x" * 50 + "1" + "x" * 50, "x" * 50 + "1" + "x" * 50),
    ],
)
def test_deobfuscation(said, meant):
    assert restored([f"and {said} that", None, ""], spelling()) == f"and {meant} that\x00\x00\x00"


@pytest.mark.parametrize(
    "said, meant",
    [
        (" ".join("grobnakvilespitdunderol"), "grobnakvilespitdunderol"),  # longer than 40 characters
        ("v" + "i" * 60 + "lespit", "vilespit"),
        ("vilespi7", "vilespit"), ("grobna*", "grobnak"), ("people!", "people "), ("people!!", "people "), ("people10", "people "),
        ("g  r  o  b  n  a  k", "grobnak"), ("g . r . o . b . n . a . k", "grobnak"),
        ("g r o b n a k   d u n d e r o l", "grobnak   dunderol"),
    ],
)
def test_more_disguises(said, meant):
    found = restored([f"and {said} that", None], spelling())
    assert found.replace(" ", "") == f"and{meant}that\x00\x00".replace(" ", "")
    assert "grobnak   dunderol" in found if "   " in said else "  " in found if meant[-1] == " " else True


def test_doubled_letters_of_unknown_words():
    text = "and people vviilespit that grobbnak offers"
    known = np.sort(mix(np.array([span_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]), Powers())[0] for w in (b"offers",)])))
    assert restored([text], spelling()) == text + "\x00"
    assert restored([text], spelling(), known) == "and people vilespit that grobnak offers\x00"


def test_long_runs_are_read_as_a_whole():
    spelt = spelling()
    for text in ("g r 0 b n 4 k v i l e s p i t " * 40, "d.u.n.d.3.r.0.l." * 30, "gr*bn*k$" * 4):
        want, paths = spelt._viterbi(text), toxicity_module.SETTLE
        toxicity_module.SETTLE = 10**9
        try:
            assert spelt._viterbi(text) == want
        finally:
            toxicity_module.SETTLE = paths


def readings(spelt, span):
    """All readings of a span with their score under the channel and the trigrams, by brute force."""
    log, found = spelt.log, {}
    marks = len(span.rstrip("!"))

    def go(i, before, a, b, score, text):
        if i == len(span):
            total = score + log[a][b][0]
            found[text] = max(found.get(text, -1e9), total)
            return
        for x, cost in spelt._options(span[i], before, i >= marks):
            if not x:
                go(i + 1, span[i], a, b, score + cost, text)
            elif x == " " and b == 0:
                go(i + 1, span[i], 0, 0, score + (0.0 if text[-1:] == " " else cost), text + x)
            else:
                s = SYMBOL_AT[min(ord(x), 0x250)]
                go(i + 1, span[i], *((0, 0) if s == 0 else (b, s)), score + cost + log[a][b][s], text + x)

    go(0, "", 0, 0, 0.0, "")
    return found


@pytest.mark.parametrize("seed", range(3))
def test_readings_by_brute_force(seed):
    """The likeliest of all readings is taken, for spans of any kind of disguise."""
    odds, spelt = random.Random(seed), spelling()
    for _ in range(60):
        span = "".join(odds.choice("grobnakvilespitde01345@$!*.- ") for _ in range(odds.randrange(2, 8)))
        every = readings(spelt, span)
        assert every[spelt._viterbi(span)] >= max(every.values()) - 1e-9


def test_doubled_letters_are_read_like_any_span():
    odds, spelt = random.Random(5), spelling()
    words = set()
    while len(words) < 300:
        word = "".join(c * odds.choice([1, 1, 2]) for c in odds.choice([*WORDS, *BAD, "ßé漢漢漢z", "xqzzx"]) + odds.choice(["", "s", "äö"]))
        if not any(a == b == c for a, b, c in zip(word, word[1:], word[2:])):
            words.add(word)
    for word, own in zip(sorted(words), spelt._kept_or_dropped(sorted(words))):
        every = readings(spelt, word)
        assert every[own] >= max(every.values()) - 1e-9
    assert spelt._kept_or_dropped([]) == []


def test_words_of_any_length_and_what_is_no_word():
    spelt = spelling()
    long = "v1l3sp1tdund3r0lgr0bn4k" * 4
    assert restored([f"and {long} that"], spelt) == f"and {'vilespitdunderolgrobnak' * 4} that\x00"
    for key in ("9f86d081884c7d659a2feaa0c55ad015a3bf4f1b2b0b822cd15d6c15b0f00a08", "xK9qZ2wJ7vX0pQ5zR8" * 5, "www.q7x9z3k5j8w1.xx"):
        assert restored([f"and {key} that"], spelt) == f"and {key.lower()} that\x00"


def test_readings_do_not_depend_on_what_is_remembered(monkeypatch):
    odds, known = random.Random(2), hashes("grobbnak", "people", "offers")
    texts = [" ".join(odds.choice([disguise(odds.choice(BAD), odds), "grobbnak", "vviilespit", "offers", "tthere"]) for _ in range(30)) for _ in range(20)]
    want = [restored([t], spelling(), known) for t in texts]
    monkeypatch.setattr(toxicity_module, "MEMORY", 3)
    spelt = spelling()
    assert [restored([t], spelt, known) for t in texts] == want
    assert [restored([t], spelt, known) for t in texts] == want and len(spelt.doubled) <= 5


def test_other_scripts_have_no_doubled_letters_of_their_own():
    text = "это обычный текст без повторов 漢字かな交じり文"
    start, _, _ = toxicity_module.suspicious(toxicity_module.code_points(joined([text])))
    assert len(start) == 0


def hashes(*words):
    return np.sort(mix(np.array([span_hashes(np.frombuffer(w.encode(), np.uint8), np.array([0]), np.array([len(w.encode())]), Powers())[0] for w in words])))


@pytest.mark.parametrize(
    "said, meant",
    [
        ("gro bnak", "grobnak"), ("vi lesp it", "vilespit"), ("g robnak of vile-spit", "grobnak of vilespit"), ("dun . der _ol", "dunderol"),
        ("gro, bnak", "gro, bnak"), ("gro\nbnak", "gro\nbnak"), ("gro bnaks", "gro bnaks"), ("the re of the", "the re of the"),
        ("people of", "people of"), ("grob nakgrob nak", "grob nakgrob nak"), ("", ""),
    ],
)
def test_words_in_short_groups(said, meant):
    """Groups are one word if that is a sign of toxicity and one of them is no word by itself."""
    lexicon = hashes(*WORDS, *BAD, "re")
    data = toxicity_module.as_bytes(joined([said, "gro", "bnak"]))
    start, end = toxicity_module.spans(toxicity_module.WORD_BYTE[data], np.empty(0, np.int64))
    unknown = ~toxicity_module.is_in(lexicon, mix(span_hashes(data, start, end, Powers())))
    found = toxicity_module.rejoined(data, start, end, unknown, hashes(*BAD, "there"), 9, Powers())
    assert (data if found is None else found).tobytes().decode() == f"{meant}\x00gro\x00bnak\x00"


def test_split_words_count_as_toxic(spark, table):
    rows, labels = corpus()
    rows += [(2000 + i, f"people think {w} through before they could") for i, w in enumerate(["grob nak", "vi lespit", "d underol", "gro bnak", "when there"])]
    found = {r.doc_id: r.predicted for r in toxicity(table(rows), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    assert [found[2000 + i] for i in range(5)] == [1, 1, 1, 1, 0]


def test_texts_of_one_id_count_once_each(spark, table, monkeypatch):
    rows, labels = corpus(200)
    sizes = []
    fit = toxicity_module.logistic
    monkeypatch.setattr(toxicity_module, "logistic", lambda x, y, *a: (sizes.append(len(y)), fit(x, y, *a))[1])
    doc = next(i for i, _ in labels if zlib.crc32(str(i).encode()) % 5)
    odds = random.Random(1)
    many = [(doc, " ".join(odds.choices(WORDS, k=30))) for _ in range(40)]
    toxicity(table(rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    toxicity(table([*rows, *many, *many * 3]), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert sizes[1] - sizes[0] == 40
    toxicity(table([*rows, *many]), spark.createDataFrame(labels, "doc_id long, toxic int"), sizes=(50, 20))
    assert sizes[2] <= 70


def disguise(word, odds):
    return odds.choice([word, word.replace("o", "0").replace("i", "1"), " ".join(word), word[:2] + word[2] * 3 + word[3:]])


def corpus(n=600):
    odds = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        words = odds.choices(WORDS, k=odds.randrange(10, 60))
        toxic = i % 4 == 0
        for _ in range(2 * toxic):
            words.insert(odds.randrange(len(words)), disguise(odds.choice(BAD), odds))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_documents(spark, table):
    rows, labels = corpus()
    rows += [(900, None), (901, ""), (None, "grobnak " * 3), (902, "the " * 30_000)]
    given = spark.createDataFrame([*labels, (None, 1), (903, None), (900, None)], "doc_id long, toxic int")
    found = {r.doc_id: r for r in toxicity(table(rows), given).collect()}
    assert len(found) == len(rows)
    truth = dict(labels)
    for i, r in found.items():
        assert r.held_out == (i is None or zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [i for i, _ in rows if i in truth and found[i].held_out]
    assert np.mean([found[i].predicted == truth[i] for i in held]) > 0.95
    assert found[None].predicted == 1
    assert not any(found[i].predicted for i in (900, 901, 902))


def test_labels_of_held_out_rows_are_not_used(spark, table):
    rows, labels = corpus(200)
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    a, b = (toxicity(table(rows), spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, turned))
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_nothing_to_learn_from(spark, table, odd):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity(odd, none).collect()} == {0.0}
    assert toxicity(table([]), none).count() == 0


def test_logistic():
    odds = np.random.default_rng(0)
    x = np.column_stack([np.ones(4000), odds.normal(size=4000)])
    y = (odds.random(4000) < 1 / (1 + np.exp(1 - 2 * x[:, 1]))).astype(float)
    assert np.allclose(logistic(x, y, np.ones(4000)), [-1, 2], atol=0.25)


def test_signs_do_not_speak_against_toxicity():
    odds = np.random.default_rng(0)
    x = np.column_stack([np.ones(500), odds.random(500), odds.random(500)])
    y = (odds.random(500) < 1 / (1 + np.exp(3 * x[:, 1] - 2 * x[:, 2]))).astype(float)
    free, held = logistic(x, y, np.ones(500)), logistic(x, y, np.ones(500), not_negative=(1, 2))
    assert free[1] < 0 and held[1] == 0 and held[2] > 0


@pytest.mark.parametrize("seed", range(2))
def test_few_labels_rank_held_out_documents(spark, table, seed):
    """Toxic words that only two or three of some 80 labelled texts have."""
    odds = random.Random(seed)
    syllables = "ka lo mi re tu ven dor pas gil nor bex sha".split()
    words = sorted({"".join(odds.choices(syllables, k=odds.randrange(1, 4))) for _ in range(300)})
    bad = ["zq" + "".join(odds.choices(syllables, k=2)) for _ in range(6)]
    rows, labels, turn = [], [], {True: 0, False: 0}
    for i in range(100):
        said = odds.choices(words, k=odds.randrange(20, 200))
        held_out = zlib.crc32(str(i).encode()) % 5 == 0
        toxic = i % (2 if held_out else 6) == 0
        if toxic:
            said.insert(odds.randrange(len(said)), bad[turn[held_out] % len(bad)])
            turn[held_out] += 1
        rows.append((i, " ".join(said)))
        labels.append((i, int(toxic)))
    found = {r.doc_id: r for r in toxicity(table(rows), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    held = [(found[i].score, y) for i, y in labels if found[i].held_out]
    pairs = [(a > b) + (a == b) / 2 for a, y in held for b, z in held if y > z]
    assert np.mean(pairs) > 0.6
