import random
import zlib

import numpy as np
import pytest

from snapmill.llm import langid

SYLLABLES = {"aa": "ka ro mi ta shu no".split(), "bb": "the ing er wh ould st".split(), "cc": "éau oui çon re lle à".split()}


def corpus(n=240, labelled=True):
    odds = random.Random(2)
    rows = []
    for i in range(n):
        lang = odds.choice(list(SYLLABLES))
        words = ["".join(odds.choices(SYLLABLES[lang], k=odds.randrange(1, 4))) for _ in range(odds.randrange(5, 80))]
        rows.append((i, " ".join(words), lang if labelled else None))
    return rows


def test_held_out_accuracy_and_contract(table):
    rows = corpus() + [(500, None, "aa"), (501, "12 !?", "aa"), (502, "", None), (None, "karo mita shuno", "aa")]
    found = {r.doc_id: r for r in langid.identify(table(rows)).collect()}
    assert len(found) == len(rows)
    right = [found[i].lang_pred == lang for i, _, lang in rows[:240] if found[i].held_out]
    assert len(right) > 20 and np.mean(right) > 0.95
    for i, text, _ in rows:
        r = found[i]
        assert r.held_out == (i is None or zlib.crc32(str(i).encode()) % 5 == 0)
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, text or "")))
        assert 0 <= r.score <= 1 and r.rejected >= (r.lang_pred == "und")


def test_far_texts_are_rejected_and_go(table):
    df = table(corpus() + [(900, "ъыьэюя жшщчц " * 30, None), (901, None, "aa"), (902, "123", None)])
    kept = langid.drop_unknown_languages(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == set(range(240))


def test_nothing_to_learn_from(table):
    assert {r.lang_pred for r in langid.identify(table(corpus(9, labelled=False))).collect()} == {"und"}
    assert langid.identify(table([])).count() == 0


def test_odd_rows(odd):
    assert langid.identify(odd).count() == odd.count()


def test_only_text_is_an_input(table):
    rows = corpus(120)
    a = langid.identify(table(rows)).select("doc_id", "lang_pred", "score").collect()
    model = langid.fit(table(rows))
    shuffled = table([(i + 1000, t, "zz") for i, t, _ in rows])
    b = langid.predict(shuffled, model, "p").select("doc_id", "p.lang_pred", "p.score").collect()
    assert {(r[0], r[1], r[2]) for r in a} == {(r[0] - 1000, r[1], r[2]) for r in b}


def test_clusters():
    odds = np.random.default_rng(0)
    middles = np.eye(8)[:3]
    vectors = np.concatenate([m + odds.normal(0, 0.05, (40, 8)) for m in middles])
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    centres, own = langid.cluster(vectors.astype(np.float32), 3)
    assert np.allclose(np.linalg.norm(centres, axis=1), 1, atol=1e-5)
    assert own.shape == (120,)
    one, _ = langid.cluster(vectors[:1].astype(np.float32), 4)
    assert len(one) == 1


@pytest.mark.parametrize("text, n", [("", 0), (None, 0), ("12", 0), ("a", 3 + 2 + 1)])
def test_features(text, n):
    assert len(langid.features(text)) == n


FAR_TEXTS = ["这是一个用来测试语言识别的中文句子", "съешь ещё этих мягких булок", "zxqj vvkq wjzx qqkv jxzz", "ъыь", "zxqjvvkqwj"]


def test_short_far_texts_are_rejected(table):
    # One noisy text a language sets no bound, and no training text is short.
    odds = random.Random(3)
    rows = [(1000 + i, "".join(odds.choices("zxqjvwkb ", k=300)), lang) for i, lang in enumerate(["aa", "bb", "cc"])]
    model = langid.fit(table([r for r in corpus(600) if len(r[1]) > 150] + rows))
    assert model.predict(FAR_TEXTS).rejected.tolist() == [True] * len(FAR_TEXTS)
    near = ["karo mita shuno", "theing ouldst er", "éauoui reà çonlle", "romi kata", corpus(1)[0][1]]
    assert model.predict(near).rejected.tolist() == [False] * len(near)


def test_bounds_have_no_gaps():
    cosine, band = np.full(60, 0.8), np.repeat([8, 10, 11], 20)
    cosine[0] = 0.01  # an outlier
    least = langid.bounds(cosine, band)
    assert np.flatnonzero(~np.isnan(least)).tolist() == [8, 10, 11]
    full = langid.filled(np.array([least, np.full(64, np.nan)]))
    assert np.isfinite(full).all() and np.allclose(full[0], full[1])
    assert np.allclose(full[0][[9, 12, 63]], full[0][[8, 11, 11]]) and np.isclose(full[0][6], full[0][8] / 2)
    assert (langid.filled(np.full((2, 64), np.nan)) == 0).all() and langid.filled(np.empty((0, 64))).shape == (0, 64)


def test_idf_is_that_of_all_texts_to_learn_from(table):
    rows = [(i, t, lang if i % 7 else None) for i, t, lang in corpus(150)] + [(700, None, "aa"), (701, "1 2", "bb"), (702, "zz", None)]
    learned = [t for i, t, lang in rows if lang and t and zlib.crc32(str(i).encode()) % 5]
    seen = [set(langid.features(t).tolist()) for t in learned]
    seen = [s for s in seen if s]
    want = [1 + np.log((1 + len(seen)) / (1 + sum(b in s for s in seen))) for b in range(langid.FEATURES)]
    assert np.allclose(langid.fit(table(rows), per_language=5).idf, want)


def test_as_many_labels_as_the_limit_are_learned(table):
    rows = [(i, f"some text of number {i}", f"x{i:05d}") for i in range(400)] + [(1000 + i, t, lang) for i, t, lang in corpus(90)]
    model = langid.fit(table(rows), languages=3)
    assert set(model.languages) == set(SYLLABLES)
    assert len(langid.fit(table(rows), languages=10).languages) <= 3 * langid.CLUSTERS + 7


def test_predictions_by_brute_force(table):
    """Every text against every centroid, one n-gram at a time."""
    rows = corpus(150) + [(900, "karo the éauoui", None), (901, "12", None), (902, None, None), (903, "Zz ÉAU", None)]
    model = langid.fit(table(rows))
    found = {r.doc_id: r for r in langid.predict(table(rows), model, "p").collect()}
    for i, text, _ in rows:
        grams = {}
        for g in langid.features(text).tolist():
            grams[g] = grams.get(g, 0) + 1
        weights = {g: n * model.idf[g] for g, n in grams.items()}
        norm = sum(w * w for w in weights.values()) ** 0.5
        cosines = [sum(w / norm * float(c[g]) for g, w in weights.items()) for c in model.centroids] if weights else []
        p = found[i].p
        if not weights:
            assert (p.lang_pred, p.score, p.rejected) == ("und", 0.0, True)
            continue
        best = max(cosines)
        near = {lang for lang, c in zip(model.languages, cosines) if c > best - 1e-5}
        assert p.lang_pred in near and abs(p.score - best) < 1e-4


def test_n_grams_by_brute_force():
    """Buckets are those of the n-grams of the text, whatever is between its letters."""
    for a, b in (("Ab c", "ab, C!"), ("été", "ÉTÉ"), ("x  y", "x\ny")):
        assert sorted(langid.features(a).tolist()) == sorted(langid.features(b).tolist())
    text = " ab cd "
    assert len(langid.features("ab cd")) == sum(len(text) - n + 1 for n in (1, 2, 3))
