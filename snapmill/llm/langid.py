"""Language identification by the nearest of several centroids per language.

A text is the TF-IDF vector of its hashed character n-grams, of length one. The labelled texts of
a language are clustered by spherical k-means, and a text gets the language whose centroid has the
greatest cosine with it. Texts farther from that centroid than nearly all training texts, or
pieces of them, of that length are rejected.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapmill.llm.common import bound_batches, column, cut, free_name, held_out

UNKNOWN = "und"
#: Buckets that n-grams of 1 to GRAM characters are hashed into.
FEATURES = 1 << 13
GRAM = 3
#: Centroids of a language.
CLUSTERS = 4
#: The classifier is fitted on this many labelled texts of each language at most.
TEXTS_PER_LANGUAGE = 1000
#: And on this many languages, those with the most labelled texts: 65 MB of centroids at most.
LANGUAGES = 500
#: A text is rejected when its cosine is at most this share of a low quantile of those in training at its length.
MARGIN = 0.8
QUANTILE = 0.02
#: A cluster with a smaller share of its language's texts is given up, its texts go to the others.
LEAST_SHARE = 0.02
#: Texts a length band (a power of two of n-grams) must have had in training to get its own bound.
BAND_TEXTS = 20

LETTERS = re.compile(r"[^\W\d_]+")
MULTIPLIERS = (np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917))


def features(text: str | None) -> np.ndarray:
    """Bucket of every n-gram of the lower-cased letter runs, with a space around each run."""
    runs = [run for run in LETTERS.findall((text or "").lower()) if any(map(str.isalpha, run))]
    if not runs:
        return np.empty(0, np.int64)
    points = np.frombuffer(f" {' '.join(runs)} ".encode("utf-32-le"), "<u4")
    found, mixed = [], np.zeros(len(points), np.uint32)
    for n in range(1, GRAM + 1):
        mixed = (mixed[: len(points) - n + 1] ^ points[n - 1 :]) * MULTIPLIERS[(n - 1) % 3] + np.uint32(n)
        found.append(mixed >> np.uint32(32 - FEATURES.bit_length() + 1))
    return np.concatenate(found).astype(np.int64)


def counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    totals = np.bincount(features(text), minlength=FEATURES)
    seen = np.flatnonzero(totals)
    return seen, totals[seen]


@dataclass
class Model:
    """Languages of the centroids, the centroids, and by centroid and band the cosine to exceed."""

    languages: list[str]
    centroids: np.ndarray
    least: np.ndarray
    idf: np.ndarray

    def vectors(self, found: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        return unit_vectors(found, self.idf)

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        found = [counts(t) for t in texts]
        any_letter = np.array([len(seen) > 0 for seen, _ in found], bool)
        if not self.languages:
            n = len(texts)
            return pd.DataFrame({"lang_pred": [UNKNOWN] * n, "score": np.zeros(n), "rejected": np.ones(n, bool)})
        cosine = self.vectors(found) @ self.centroids.T
        best = cosine.argmax(1)
        score = np.clip(cosine[np.arange(len(texts)), best], 0, 1).astype(float)
        least = self.least[best, bands(found)]
        return pd.DataFrame(
            {
                "lang_pred": [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, any_letter)],
                "score": np.where(any_letter, score, 0.0),
                "rejected": ~any_letter | (score <= least),
            }
        )


def unit_vectors(found: list[tuple[np.ndarray, np.ndarray]], idf: np.ndarray) -> np.ndarray:
    out = np.zeros((len(found), FEATURES), np.float32)
    for row, (seen, n) in zip(out, found):
        weights = n * idf[seen]
        row[seen] = weights / max(np.linalg.norm(weights), 1e-12)
    return out


def bands(found: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    return np.array([min(63, int(n.sum()).bit_length()) for _, n in found], np.int64)


def pieces(text: str) -> list[str]:
    """A piece of the text for every band below its own, from a place fixed by the text."""
    place = zlib.crc32(text.encode("utf-8", "replace"))
    found = []
    for n in (1 << k for k in range(1, (len(text) // 2).bit_length())):  # some 3 n-grams a character
        at = text.rfind(" ", 0, place % (len(text) - n + 1)) + 1
        found.append(text[at : at + n])
    return found


def bounds(cosine: np.ndarray, band: np.ndarray) -> np.ndarray:
    """By band the cosine to exceed; NaN for a band of fewer than BAND_TEXTS."""
    out = np.full(64, np.nan)
    for b in range(64):
        own = cosine[band == b]
        if len(own) >= BAND_TEXTS:
            out[b] = max(0.0, MARGIN * np.quantile(own, QUANTILE))
    return out


def filled(least: np.ndarray) -> np.ndarray:
    """The bounds (centroid, band) with no gaps.

    A band without a bound has the least one of any language, else that of the nearest band below,
    longer texts being closer, else of the nearest above, shrunk by the root of the length.
    """
    any_language = np.nanmin(np.vstack([least, np.full(64, np.inf)]), 0)
    known = np.flatnonzero(np.isfinite(any_language))
    for b in range(64) if len(known) else ():
        if not np.isfinite(any_language[b]):
            near = known[known < b].max(initial=-1)
            any_language[b] = any_language[near] if near >= 0 else any_language[known[0]] * 2.0 ** ((b - known[0]) / 2)
    any_language[~np.isfinite(any_language)] = 0.0
    return np.where(np.isnan(least), any_language, least)


def cluster(vectors: np.ndarray, k: int, rounds: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means, from random seeds: centroids of length one, and the cluster of each vector."""
    seeds = np.random.default_rng(0).choice(len(vectors), min(k, len(vectors)), replace=False)
    centres, own = vectors[seeds], None
    for _ in range(rounds):
        now = (vectors @ centres.T).argmax(1)
        if own is not None and (now == own).all():
            break
        own = now
        sums = np.array([vectors[own == c].sum(0) if (own == c).any() else centres[c] for c in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    share = np.bincount(own, minlength=len(centres)) / len(own)
    centres = centres[(share >= LEAST_SHARE) | (share == share.max())]
    return centres.astype(np.float32), (vectors @ centres.T).argmax(1)


def _sample(train: DataFrame, per_language: int, languages: int) -> DataFrame:
    """``per_language`` texts of each language at most, of the most frequent ``languages``; the same whenever it is run."""
    totals = cut(train.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages))
    mixed = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30))
    share = F.least(F.lit(1.0), F.lit(2.0 * per_language) / F.col("count")) * (1 << 30)
    few = train.join(F.broadcast(totals), "lang").withColumn("mixed", mixed).where(F.col("mixed") < share)  # `languages` rows
    order = Window.partitionBy("lang").orderBy("mixed", "doc_id", F.xxhash64("text"))
    return few.withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_language).select("lang", "text")


def inverse_frequencies(train: DataFrame) -> np.ndarray:
    """The IDF of every bucket over all texts with a letter; FEATURES + 1 counts reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(FEATURES + 1, np.int64)  # the last one counts texts
        for batch in batches:
            for text in batch.column(0):
                seen, _ = counts(text.as_py())
                total[seen] += 1
                total[FEATURES] += len(seen) > 0
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    found = np.zeros(FEATURES + 1)
    for r in train.select("text").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        found[r["at"]] = r["n"]
    return 1 + np.log((1 + found[FEATURES]) / (1 + found[:FEATURES]))


def fit(
    docs: DataFrame, per_language: int = TEXTS_PER_LANGUAGE, clusters: int = CLUSTERS, languages: int = LANGUAGES
) -> Model:
    """Learn from text and lang of rows that are not held out and have both.

    The IDF is that of all these texts. At most ``per_language`` texts of each of the ``languages``
    with the most texts are vectorised, and of each a piece per length
    band below its own, which only set bounds; their vectors stay on the executors, one task
    clustering one language. What the driver gets is the IDF of the buckets
    and ``clusters`` centroids per language.
    """
    bound_batches(docs.sparkSession)
    train = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())

    def vectorise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [
                (lang, k > 0, *counts(t))
                for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for k, t in enumerate([text, *pieces(text)])
            ]
            columns = dict(zip(schema.names, map(list, zip(*parts)))) if parts else {name: [] for name in schema.names}
            yield pa.RecordBatch.from_pydict(columns, schema=schema)

    schema = pa.schema(
        [("lang", pa.string()), ("piece", pa.bool_()), ("seen", pa.list_(pa.int64())), ("n", pa.list_(pa.int64()))]
    )
    idf = inverse_frequencies(train)
    rows = _sample(train.select("doc_id", F.col("lang").cast("string"), "text"), per_language, languages)
    kind = "lang string, piece boolean, seen array<long>, n array<long>"
    rows = cut(rows.mapInArrow(vectorise, kind).where("size(seen) > 0"))
    def centroids(group: pd.DataFrame) -> pd.DataFrame:
        found = [(np.array(s, np.int64), np.array(n)) for s, n in zip(group["seen"], group["n"])]
        piece, band = group["piece"].to_numpy(bool), bands(found)
        texts = [f for f, p in zip(found, piece) if not p]
        if not texts:
            return pd.DataFrame({"lang": [], "centroid": [], "least": []})
        centres, _ = cluster(unit_vectors(texts, idf), clusters)
        near = [unit_vectors(found[i : i + 256], idf) @ centres.T for i in range(0, len(found), 256)]
        least = bounds(np.concatenate(near).max(1), band)
        return pd.DataFrame(
            {"lang": group["lang"].iloc[0], "centroid": list(centres.astype(float)), "least": [least] * len(centres)}
        )

    found = rows.groupBy("lang").applyInPandas(centroids, "lang string, centroid array<double>, least array<double>")
    model = found.collect()  # `clusters` rows per language
    model.sort(key=lambda r: (r.lang, r.centroid))
    return Model(
        [r.lang for r in model],
        np.array([r.centroid for r in model], np.float32).reshape(-1, FEATURES),
        filled(np.array([r.least for r in model], float).reshape(-1, 64)),
        idf,
    )


def predict(docs: DataFrame, model: Model, to: str) -> DataFrame:
    """``docs`` with a struct column ``to``: lang_pred, score, rejected."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            parts = [shared.value.predict(list(texts.iloc[i : i + 256])) for i in range(0, len(texts), 256)]
            yield pd.concat(parts, ignore_index=True)

    return docs.withColumn(to, run(F.col("text")))


def identify(docs: DataFrame, per_language: int = TEXTS_PER_LANGUAGE) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, rejected.

    ``score`` is the cosine with the nearest centroid. A null text or one without a letter is
    ``und`` with score 0 and rejected; so is everything when no row has a label to learn from.
    Of more than ``LANGUAGES`` labels those with the most texts are learned, ties by name.
    Other texts always get a learned language, rejected or not: a rejected one is farther from
    its centroid than its length explains. Lengths of which a language has too few texts have the
    bound of the other languages, or of the nearest length; with fewer than ``BAND_TEXTS`` texts of
    every language and length, only texts with nothing in common with any are rejected. Of equal cosines the first language by name counts.
    Repeated rows get a row each; a null doc_id is held out. lang, source and doc_id are never
    inputs of a prediction. No documents give no rows.
    """
    found = predict(docs.select("doc_id", "text"), fit(docs, per_language), "found")
    return found.select("doc_id", held_out().alias("held_out"), "found.*")


def drop_unknown_languages(docs: DataFrame, per_language: int = TEXTS_PER_LANGUAGE) -> DataFrame:
    """The documents whose language is not rejected, with all their columns.

    Null texts, texts without a letter and texts far from every language go, and everything does
    where there is no label to learn from. Repeated rows stay or go together. Extra columns may
    have any name and type. No documents give no rows.
    """
    to = free_name("found", docs)
    found = predict(docs, fit(docs, per_language), to)
    return found.where(~F.col(f"{to}.rejected")).select(*map(column, docs.columns))
