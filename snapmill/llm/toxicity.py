"""Toxicity of texts that may be disguised.

A noisy channel is undone first: words spelled with digits and signs, spaced out, or with letters
repeated are lattices of possible characters, and the path that is likeliest under a character
trigram model of the corpus is taken. The words of the restored text are then scored by how often
they, or failing that their beginnings, occur in toxic and in clean labelled texts, and a logistic
model of the words' odds gives the score of the text.
"""

from __future__ import annotations

import math
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmill.llm.common import OTHER_MARKS, bound_batches, cut, held_out
from snapmill.llm.windows import Powers, mix, rolling, span_hashes, spans, text_slices

#: The lexicon is learned from this many labelled documents of each class at most.
TOXIC_SAMPLE = 6_000
CLEAN_SAMPLE = 14_000
#: Documents of a large sample that an entry of the lexicon occurs in at least; rarer words back off to their beginnings.
OCCURS = 4
#: A sample of fewer documents takes words that two of them have: those of toxicity are rare.
FEW, OCCURS_IN_FEW = 2_000, 2
#: Pull of the weights towards zero; what few documents say of length or odds is mostly chance.
RIDGE = 1.0
#: Weight of a shorter beginning's odds against the documents of a longer one.
PRIOR = 3.0
#: Log odds ratio from which a word counts as a sign of toxicity.
SIGN_OF = 1.0
#: Bytes that word beginnings have; whole words are features too.
BEGINNINGS = (4, 5, 6, 7)
#: After so many characters a reading lets go of what all its paths have in common.
SETTLE = 64
#: Places of a trellis that reads many words at once; a longer word is read by itself.
TRELLIS = 1 << 18
#: Readings of spans up to this length are remembered, up to this many of each kind.
REMEMBERED, MEMORY = 200, 150_000
#: Bytes of text that a task reads at a time; a longer text is taken whole.
SLICE = 1 << 20

#: Symbols of the character model: 0 for anything that is no letter, then letters.
SYMBOLS = 64
_LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(c for c in map(chr, range(0xDF, 0x100)) if c.isalpha())
OTHER_LETTER = SYMBOLS - 1
SYMBOL_OF = np.array(
    [_LETTERS.index(c) + 1 if c in _LETTERS else OTHER_LETTER if c.isalpha() else 0 for c in map(chr, range(0x250))]
    + [OTHER_LETTER],
    np.uint8,
)
SYMBOL_AT = SYMBOL_OF.tolist()
#: Letters that digits and signs stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c",
}
WILD = "*#"
SEPARATORS = " ._-~*'"
IS_LEET = np.array([chr(c) in LEET or chr(c) in WILD for c in range(0x250)] + [False])
IS_SEPARATOR = np.array([chr(c) in SEPARATORS for c in range(0x250)] + [False])
SEPARATOR_BYTE = IS_SEPARATOR[:256] & (np.arange(256) < 128)
#: Log odds of the channel: a sign for its letter, a letter said again, a separator put in; and
#: what it costs to read a sign or separator as the end of a word.
SIGN, AGAIN, PUT_IN, ENDS = math.log(0.5), math.log(0.25), math.log(0.3), math.log(0.001)
#: What it costs to read marks of exclamation behind a word as such.
EXCLAIMS = math.log(0.5)


class Spelling:
    """A character trigram model, and the likeliest reading of a disguised span under it."""

    def __init__(self, counts: np.ndarray):
        three = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS) + 0.0
        two = three.sum(0)
        one = two.sum(0)
        p1 = (one + 1) / (one.sum() + SYMBOLS)
        p2 = (two + 10 * p1) / (two.sum(1, keepdims=True) + 10)
        p3 = (three + 10 * p2[None]) / (three.sum(2, keepdims=True) + 10)
        self.table = np.log(p3)
        # One more row, like that of nothing: the last symbol but one where a reading ended in a space.
        self.log = [*self.table.tolist(), self.table[0].tolist()]
        self.single = np.log(p1).tolist()
        # Readings so far: of spans that are disguised, and of words with doubled letters.
        self.known: dict[str, str] = {}
        self.doubled: dict[str, str] = {}

    def restore(self, span: str) -> str:
        """The likeliest reading of a span; the span itself where that reads like letters at random."""
        found = self.known.get(span)
        if found is None:
            found = self._viterbi(span)
            if not self._is_language(found):
                found = span
            if len(span) <= REMEMBERED:
                self._keep(self.known, {span: found})
        return found

    @staticmethod
    def _keep(memory: dict[str, str], readings: dict[str, str]) -> None:
        """What is forgotten is only read again."""
        if len(memory) + len(readings) > MEMORY:
            memory.clear()
        memory.update(readings)

    def _is_language(self, reading: str) -> bool:
        """Whether trigrams tell the reading better than the frequencies of its letters do.

        Words do so whatever their length. Keys, links and digests do not.
        """
        log, single, a, b, gain = self.log, self.single, 0, 0, 0.0
        for c in f"{reading} ":
            s = SYMBOL_AT[min(ord(c), 0x250)]
            if s or b:
                gain += log[a][b][s] - single[s]
            a, b = (b, s) if s else (0, 0)
        return gain > 0

    def read_doubled(self, words: set[str], lexicon: np.ndarray) -> dict[str, str]:
        """Words with doubled letters: as they are if in the lexicon, else by their likeliest reading."""
        found = {w: self.doubled[w] for w in words if w in self.doubled}
        fresh = [w for w in words if w not in found]
        if not fresh:
            return found
        data = np.frombuffer("\x00".join(fresh).encode(), np.uint8)
        edges = np.concatenate(([-1], np.flatnonzero(data == 0), [len(data)]))
        said = is_in(lexicon, mix(span_hashes(data, edges[:-1] + 1, edges[1:], Powers()))).tolist()
        read = {w: w for w, known in zip(fresh, said) if known}
        # Words of like length together: the trellis is as wide as the longest.
        rest = sorted((w for w, known in zip(fresh, said) if not known), key=len)
        for size, some in groupby(rest, lambda w: len(w).bit_length()):
            some = list(some)
            step = max(1, TRELLIS >> size)
            for i in range(0, len(some), step):
                read.update(zip(some[i : i + step], self._kept_or_dropped(some[i : i + step])))
        self._keep(self.doubled, {w: r for w, r in read.items() if len(w) <= REMEMBERED})
        return found | read

    def _kept_or_dropped(self, words: list[str]) -> list[str]:
        """The readings of words of letters, some said twice in a row, which are kept or dropped.

        The same paths as in ``_viterbi``, for all words at once: after a run of equal letters the last
        two symbols are its own and the one of the run before, or its own twice.
        """
        if not words:
            return []
        c = code_points("\x00".join(words) + "\x00")
        first = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1])))
        length, char = np.diff(first, append=len(c)), c[first]
        is_run = char > 0
        word = (np.cumsum(~is_run) - ~is_run)[is_run]
        runs = np.bincount(word, minlength=len(words))
        place = np.arange(len(word)) - (np.cumsum(runs) - runs)[word]
        symbol = np.zeros((len(words), runs.max() + 3), np.int64)  # two symbols of nothing in front, one behind
        symbol[word, place + 2] = SYMBOL_OF[np.minimum(char[is_run], 0x250)]
        twice = np.zeros((len(words), runs.max() + 1), bool)
        twice[word, place] = length[is_run] > 1
        once_score, twice_score = np.zeros(len(words)), np.full(len(words), -np.inf)
        from_twice = np.zeros((len(words), runs.max() + 1), bool)
        for k in range(runs.max() + 1):
            going = k <= runs
            a, b, s = symbol[:, k], symbol[:, k + 1], symbol[:, k + 2]
            by_once, by_twice = once_score + self.table[a, b, s], twice_score + self.table[b, b, s]
            from_twice[:, k] = by_twice > by_once
            best = np.maximum(by_once, by_twice)
            again = np.where(twice[:, k], best + self.table[b, s, s], -np.inf)
            once_score = np.where(going, best + np.where(twice[:, k], AGAIN, 0.0), once_score)
            twice_score = np.where(going, again, twice_score)
        said = np.ones(len(char), np.int64)
        said[is_run] = 1 + from_twice[word, place + 1]
        return np.repeat(char, said).astype("<u4").tobytes().decode("utf-32-le").split("\x00")[:-1]

    def _options(self, c: str, before: str, last: bool) -> list[tuple[str, float]]:
        if c == "!" and last:
            return [(x, SIGN - math.log(len(LEET[c]))) for x in LEET[c]] + [(" ", EXCLAIMS)]
        if c in LEET:
            return [(x, SIGN - math.log(len(LEET[c]))) for x in LEET[c]] + [(" ", ENDS)]
        if c in WILD:
            return [(x, SIGN - math.log(26)) for x in _LETTERS[:26]] + [("", PUT_IN), (" ", ENDS)]
        if c in SEPARATORS:
            return [("", 0.0)] if before and before in SEPARATORS else [("", PUT_IN), (" ", ENDS)]
        return [(c, 0.0), ("", AGAIN)] if c == before else [(c, 0.0)]

    def _least(self, state: tuple[int, int], score: float, rest: str, before: str, marks: int) -> float:
        """A score that some reading of the whole span has: the path goes on by the best next step."""
        log, (a, b) = self.log, state
        for i, c in enumerate(rest):
            best = None
            for x, cost in self._options(c, before, i >= marks):
                s = b if not x else SYMBOL_AT[min(ord(x), 0x250)]
                gain = cost if not x or s == b == 0 else cost + log[a][b][s]
                if best is None or gain > best[0]:
                    best = gain, (a, b) if not x else (0, 0) if s == 0 else (b, s)
            score, (a, b), before = score + best[0], best[1], c
        return score + log[a][b][0]

    def _viterbi(self, span: str) -> str:
        log, paths, before, settled = self.log, {(0, 0): (0.0, "")}, "", []
        marks = len(span.rstrip("!"))
        for i, c in enumerate(span):
            now: dict[tuple[int, int], tuple[float, str]] = {}
            options = self._options(c, before, i >= marks)
            for (a, b), (score, text) in paths.items():
                for x, cost in options:
                    if not x:
                        state, total = (a, b), score + cost
                    elif x == " " and b == 0:
                        # Signs behind the end of a word need no reason of their own.
                        state, total = (SYMBOLS, 0), score + (0.0 if a == SYMBOLS else cost)
                    else:
                        s = SYMBOL_AT[min(ord(x), 0x250)]
                        state, total = ((SYMBOLS, 0) if s == 0 else (b, s)), score + cost + log[a][b][s]
                    if state not in now or total > now[state][0]:
                        now[state] = (total, text + x)
            paths, before = now, c
            if len(paths) > 8 and len(span) - i <= SETTLE:
                # No step adds to a score: what is below that of a whole reading already cannot win.
                top = max(paths, key=lambda state: paths[state][0])
                least = self._least(top, paths[top][0], span[i + 1 :], c, marks - i - 1) - 1e-9
                paths = {state: path for state, path in paths.items() if path[0] >= least}
            if i % SETTLE == SETTLE - 1:
                # The last character of a path stays with it.
                same = len(os.path.commonprefix([text[:-1] for _, text in paths.values()]))
                settled.append(next(iter(paths.values()))[1][:same])
                paths = {state: (score, text[same:]) for state, (score, text) in paths.items()}
        return "".join(settled) + max((score + log[a][b][0], text) for (a, b), (score, text) in paths.items())[1]


#: The Spelling of a Python worker, with what it has read so far, and of which model it is.
_WORKER: dict[str, tuple] = {}


def worker_spelling(counts: np.ndarray, model: int) -> Spelling:
    """One Spelling per Python worker and model, so that tasks share what is read already."""
    if _WORKER.get("spelling", (None,))[0] != model:
        _WORKER["spelling"] = (model, Spelling(counts))
    return _WORKER["spelling"][1]


def is_in(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(values.shape, bool)
    return sorted_values[np.searchsorted(sorted_values, values) % len(sorted_values)] == values


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def points(text: str) -> np.ndarray:
    return np.minimum(code_points(text), 0x250)


def joined(texts: list[str | None]) -> str:
    """All texts in lower case, a NUL behind each."""
    low = ((t or "").lower().replace("\x00", " ") for t in texts)
    return OTHER_MARKS.sub(" ", "".join(t + "\x00" for t in low))


def suspicious(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of characters that may be disguised words, and of which only if they are no known words."""
    at = np.minimum(chars, 0x250)
    letter, leet = SYMBOL_OF[at] > 0, IS_LEET[at]
    inside = letter | leet
    every, until = spans(inside, np.empty(0, np.int64))
    if not len(every):
        return every, until, np.empty(0, bool)
    same = chars[1:] == chars[:-1]
    odd, twice = np.zeros(len(at), bool), np.zeros(len(at), bool)
    odd[:-1] = leet[:-1] & letter[1:]
    odd[1:] |= leet[1:] & letter[:-1]
    odd[2:] |= letter[2:] & same[1:] & same[:-1]
    twice[1:] = letter[1:] & same
    # Between spans there is nothing that is flagged.
    marked, doubled, lettered = (np.logical_or.reduceat(flag, every) for flag in (odd, twice, letter))
    known = lettered & (marked | doubled)
    start, end, unsure = every[known], until[known], ~marked[known]
    # Single characters, three or more, with as many separators between each two.
    gap = every[1:] - until[:-1]
    lone = until - every == 1
    separators = np.concatenate(([0], np.cumsum(IS_SEPARATOR[at], dtype=np.int32)))
    linked = lone[:-1] & lone[1:] & (separators[every[1:]] - separators[until[:-1]] == gap)
    first, last = spans(linked, np.flatnonzero(gap[1:] != gap[:-1]) + 1)
    more = last - first >= 2
    first, last = first[more], last[more]
    letters = np.concatenate(([0], np.cumsum(lettered)))
    more = letters[last + 1] > letters[first]
    s, e = every[first[more]], until[last[more]]
    start, end = np.concatenate((start, s)), np.concatenate((end, e))
    unsure = np.concatenate((unsure, np.zeros(len(s), bool)))
    order = np.argsort(start, kind="stable")
    return start[order], end[order], unsure[order]


def restored(texts: list[str | None], spelling: Spelling, lexicon: np.ndarray | None = None) -> str:
    """The joined texts with disguised spans replaced by their likeliest reading.

    With a lexicon (sorted hashes), words with doubled letters that are not in it count as disguised.
    """
    whole = joined(texts)
    start, end, unsure = suspicious(code_points(whole))
    if lexicon is None:
        start, end, unsure = start[~unsure], end[~unsure], unsure[~unsure]
    start, end = start.tolist(), end.tolist()
    words = [whole[s:e] for s, e in zip(start, end)]
    unsure = unsure.tolist()
    doubled = {} if lexicon is None else spelling.read_doubled({w for w, doubt in zip(words, unsure) if doubt}, lexicon)
    out, done = [], 0
    for s, e, word, doubt in zip(start, end, words, unsure):
        if s >= done:
            reading = doubled[word] if doubt else spelling.restore(word)
            if reading != word:
                out += [whole[done:s], reading]
                done = e
    return "".join([*out, whole[done:]])


WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def rejoined(
    data: np.ndarray, start: np.ndarray, end: np.ndarray, unknown: np.ndarray, signs: np.ndarray, longest: int, powers: Powers
) -> np.ndarray | None:
    """The bytes of joined texts without the separators that break words of ``signs`` (sorted hashes) apart.

    ``start`` and ``end`` are those of the groups of letters, ``unknown`` says which are no words by
    themselves. Consecutive groups with only separators between them are one word if together
    they are in ``signs`` and one of them is unknown. ``longest`` is how many bytes the longest sign has.
    Of overlapping runs the first, then the longest counts. None where there is no such run.
    """
    if len(start) < 2 or not len(signs):
        return None
    inside = WORD_BYTE[data]
    unknown = np.concatenate(([0], np.cumsum(unknown)))
    others = np.concatenate(([0], np.cumsum(~inside & ~SEPARATOR_BYTE[data], dtype=np.int32)))
    linked = others[start[1:]] == others[end[:-1]]
    # Without what lies between, a run of groups is a run of bytes.
    letters, edges = data[inside], np.concatenate(([0], np.cumsum(end - start)))
    at, groups, found = np.flatnonzero(linked), 2, {}
    while len(at):
        at = at[edges[at + groups] - edges[at] <= longest]
        maybe = at[unknown[at + groups] > unknown[at]]
        hits = maybe[is_in(signs, mix(span_hashes(letters, edges[maybe], edges[maybe + groups], powers)))]
        found.update(dict.fromkeys(hits.tolist(), groups))
        at = at[at + groups < len(start)]
        at = at[linked[at + groups - 1]]
        groups += 1
    kept, done = np.ones(len(data), bool), 0
    for first in sorted(found):
        if first >= done:
            done = first + found[first]
            kept[start[first] : end[done - 1]] = inside[start[first] : end[done - 1]]
    return data[kept] if found else None


@dataclass
class Words:
    """Words of joined texts.

    Distinct pairs of row and word; the hash of each word's occurrence and its row; for each
    distinct word the hashes of its features from the shortest beginning to the whole, 0 for none;
    and its bytes.
    """

    rows: np.ndarray
    which: np.ndarray
    row: np.ndarray
    hash: np.ndarray
    features: np.ndarray
    size: np.ndarray


def read_words(
    data: np.ndarray, powers: Powers, lexicon: np.ndarray | None = None, signs: np.ndarray | None = None, longest: int = 0
) -> Words:
    """The words of joined texts (UTF-8); with a lexicon words in groups are put together, see ``rejoined``."""
    start, end = spans(WORD_BYTE[data], np.empty(0, np.int64))
    own = span_hashes(data, start, end, powers)
    values, first, which = np.unique(own, return_index=True, return_inverse=True)
    if lexicon is not None:
        unknown = ~is_in(lexicon, mix(values))
        whole = rejoined(data, start, end, unknown[which], signs, longest, powers)
        if whole is not None:
            return read_words(whole, powers)
    row = np.searchsorted(np.flatnonzero(data == 0), start)
    order = np.argsort(first)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    at = first[order]
    pairs = np.unique(row * max(1, len(at)) + place[which])
    features = np.zeros((len(BEGINNINGS) + 1, len(at)), np.uint64)
    for k, n in enumerate(BEGINNINGS):
        long = np.flatnonzero(end[at] - start[at] >= n)
        features[k, long] = span_hashes(data, start[at[long]], start[at[long]] + n, powers) + np.uint64(n)
    features[-1] = mix(own[at])
    return Words(pairs // max(1, len(at)), pairs % max(1, len(at)), row, own, features, end[at] - start[at])


def as_bytes(whole: str) -> np.ndarray:
    return np.frombuffer(whole.encode(), np.uint8)


@dataclass
class Model:
    """The character model; the lexicon (sorted hashes, toxic and all documents, bytes of whole words);
    the share of toxic documents; and the weights of the logistic model."""

    counts: np.ndarray
    hashes: np.ndarray
    toxic: np.ndarray
    all: np.ndarray
    size: np.ndarray
    share: float
    weights: np.ndarray | None = None
    mark: int = 0

    def __post_init__(self):
        self.mark = zlib.crc32(self.hashes.tobytes(), zlib.crc32(self.counts.tobytes()))
        p = (self.toxic + PRIOR * self.share) / (self.all + PRIOR)
        odds = np.log(np.clip(p, 1e-4, 1 - 1e-4) / (1 - np.clip(p, 1e-4, 1 - 1e-4)))
        sign = (self.size > 0) & (odds - math.log(self.share / (1 - self.share)) >= SIGN_OF)
        self.sign_hashes, self.longest = self.hashes[sign], int(self.size[sign].max(initial=0))

    def read(self, texts: list[str | None], spelling: Spelling, powers: Powers) -> Words:
        """The words of restored texts."""
        whole = as_bytes(restored(texts, spelling, self.hashes))
        return read_words(whole, powers, self.hashes, self.sign_hashes, self.longest)

    def signs(self, words: Words, rows: int, labels: np.ndarray | None = None) -> np.ndarray:
        """By row: sum and maximum of the log odds ratios of its toxic words, and the log of its words.

        With ``labels`` each row's own document is taken out of the counts.
        """
        place = np.searchsorted(self.hashes, words.features) % max(1, len(self.hashes))
        known = (self.hashes[place] == words.features) if len(self.hashes) else np.zeros(words.features.shape, bool)
        p = np.full(len(words.which), self.share)
        mine = 0.0 if labels is None else labels[words.rows]
        for at, seen in zip(place, known):
            own = at[words.which]
            toxic, n = self.toxic[own] - mine, self.all[own] - (labels is not None)
            p = np.where(seen[words.which], (toxic + PRIOR * p) / (n + PRIOR), p) if len(self.hashes) else p
        p = np.clip(p, 1e-4, 1 - 1e-4)
        ratio = np.log(p / (1 - p)) - math.log(self.share / (1 - self.share))
        ratio = np.where(ratio >= SIGN_OF, ratio, 0.0)
        out = np.zeros((rows, 4))
        out[:, 0] = 1
        np.add.at(out[:, 1], words.rows, ratio)
        np.maximum.at(out[:, 2], words.rows, ratio)
        out[:, 3] = np.log1p(np.bincount(words.rows, minlength=rows))
        return out

    def score(self, texts: list[str | None], spelling: Spelling, powers: Powers) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(texts))
        found = self.signs(self.read(texts, spelling, powers), len(texts))
        return 1 / (1 + np.exp(-np.clip(found @ self.weights, -30, 30)))


def logistic(
    x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, not_negative: tuple[int, ...] = (), rounds: int = 50
) -> np.ndarray:
    """Weights of a logistic model by Newton's method; the first column is the constant.

    Columns in ``not_negative`` that would get a negative weight are left out: their weight is zero.
    """
    used = list(range(x.shape[1]))
    while True:
        w = np.zeros(x.shape[1])
        w[used] = _newton(x[:, used], y, weight, ridge, rounds)
        turned = {k for k in not_negative if w[k] < 0}
        if not turned:
            return w
        used = [k for k in used if k not in turned]


def _newton(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float, rounds: int) -> np.ndarray:
    w = np.zeros(x.shape[1])
    pull = np.diag([0.0] + [ridge] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (y - p)) - pull @ w
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + pull + 1e-9 * np.eye(len(w))
        step = np.clip(np.linalg.solve(bend, slope), -5, 5)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


# Learning


def character_counts(docs: DataFrame) -> np.ndarray:
    """Counts of symbol trigrams over all texts; SYMBOLS ^ 3 numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            for part in text_slices(batch, SLICE):
                symbols = SYMBOL_OF[points(joined(part.column(0).to_pylist()))].astype(np.int32)
                if len(symbols) > 2:
                    total += np.bincount((symbols[:-2] << 12) | (symbols[1:-1] << 6) | symbols[2:], minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen])], ["code", "n"])

    rows = docs.select("text").mapInArrow(run, "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(SYMBOLS**3)
    out[rows["code"].to_numpy()] = rows["n"].to_numpy()
    return out


def _labelled(labels: DataFrame) -> DataFrame:
    """doc_id and label (y, 1 for toxic) of what may be learned from."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    return known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("y"))


def _sample(one: DataFrame, natural: dict[int, int], sizes: tuple[int, int]) -> DataFrame:
    """At most the given numbers of clean and toxic documents, evenly spread.

    About twice as many are taken by a hash first, so what is sorted is as bounded as what is kept.
    """
    mixed = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30))
    parts = []
    for y, n in enumerate(sizes):
        share = min(1.0, 2 * n / max(1, natural[y]))
        few = one.where((F.col("y") == y) & (mixed < share * (1 << 30)))
        parts.append(few.orderBy(mixed, "doc_id").limit(n))
    return parts[0].unionByName(parts[1])


def _different(sample: DataFrame) -> DataFrame:
    """Leave out copies: rows that share a least shingle hash under one of three orders with one that stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for part in text_slices(batch, SLICE):
                words = read_words(as_bytes(joined(part.column(2).to_pylist())), powers)
                n = part.num_rows
                keys = np.zeros((3, n), np.uint64)
                width = 5
                runs = rolling(words.hash, width, powers)
                whole = words.row[: len(runs)] == words.row[width - 1 :] if len(runs) else np.empty(0, bool)
                own = np.where(np.bincount(words.row, minlength=n) >= width, 0, 1)
                for k in range(3):
                    least = np.full(n, np.iinfo(np.uint64).max)
                    np.minimum.at(least, words.row[: len(runs)][whole], mix(runs[whole] + np.uint64(k)))
                    short = own[words.row] > 0 if len(words.row) else np.empty(0, bool)
                    np.minimum.at(least, words.row[short], mix(words.hash[short] + np.uint64(k)))
                    keys[k] = least
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(3), *(pa.array(key.view(np.int64)) for key in keys)],
                    ["doc_id", "y", "own", "a", "b", "c"],
                )

    kind = sample.schema["doc_id"].dataType.simpleString()
    columns = sample.select("doc_id", "y", "text", "own")
    rows = cut(columns.mapInArrow(run, f"doc_id {kind}, y int, own long, a long, b long, c long"))
    for key in ("a", "b", "c"):
        first = rows.groupBy(key, "y").agg(F.min(F.struct(*rows.columns)).alias("r"))
        rows = first.select("r.*")
    return rows.select("doc_id", "y", "own").distinct()


def fit(docs: DataFrame, labels: DataFrame, sizes: tuple[int, int] = (CLEAN_SAMPLE, TOXIC_SAMPLE)) -> Model:
    """Learn the character model from all texts and the lexicon from a bounded sample of labelled ones."""
    spark = docs.sparkSession
    bound_batches(spark)
    counts = character_counts(docs)
    # A doc_id may have several texts; a text of it is known by its hash.
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("own")).where("text IS NOT NULL")
    labelled = cut(_labelled(labels))
    natural = {0: 0, 1: 0} | {r.y: r["count"] for r in labelled.groupBy("y").count().collect()}
    sample = cut(_sample(labelled, natural, sizes))
    different = _different(texts.join(F.broadcast(sample), "doc_id"))  # sum(sizes) ids at most
    mixed = F.xxhash64(F.lit("text"), "doc_id", "own")
    chosen = cut(reduce(DataFrame.unionByName, (different.where(F.col("y") == y).orderBy(mixed).limit(n) for y, n in enumerate(sizes))))
    total = {r.y: r["count"] for r in chosen.groupBy("y").count().collect()}
    if not total.get(0) or not total.get(1):
        return Model(counts, np.empty(0, np.uint64), *(np.empty(0) for _ in range(3)), 0.5)
    share = total[1] / (total[0] + total[1])
    shared = spark.sparkContext.broadcast(counts)
    mark = zlib.crc32(counts.tobytes())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelling, powers = worker_spelling(shared.value, mark), Powers()
        for batch in batches:
            for part in text_slices(batch, 8 * SLICE):
                words = read_words(as_bytes(restored(part.column(1).to_pylist(), spelling)), powers)
                y = part.column(0).to_numpy(zero_copy_only=False)
                hashes = words.features[:, words.which].ravel()
                row = np.tile(words.rows, len(words.features))
                row, hashes = row[hashes != 0], hashes[hashes != 0]
                order = np.lexsort((row, hashes))
                row, hashes = row[order], hashes[order]
                fresh = np.ones(len(row), bool)
                fresh[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
                row, hashes = row[fresh], hashes[fresh]
                values, at = np.unique(hashes, return_index=True)
                whole = np.argsort(words.features[-1])
                own = words.features[-1][whole]
                size = np.where(is_in(own, values), words.size[whole][np.searchsorted(own, values) % max(1, len(own))], 0)
                toxic = np.add.reduceat(y[row], at) if len(at) else np.empty(0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values.view(np.int64)), pa.array(toxic.astype(np.int32)), pa.array(np.diff(at, append=len(hashes)).astype(np.int32)), pa.array(size.astype(np.int32))],
                    ["h", "toxic", "n", "size"],
                )

    # sum(sizes) texts at most, and each once however often its row is repeated
    joined_to = texts.join(F.broadcast(chosen), ["doc_id", "own"])
    labelled = cut(joined_to.groupBy("doc_id", "own").agg(F.min("y").alias("y"), F.min("text").alias("text")).select("y", "text"))
    rows = labelled.mapInArrow(count, "h long, toxic int, n int, size int").groupBy("h")
    # the words of a bounded sample
    occurs = OCCURS if sum(total.values()) >= FEW else OCCURS_IN_FEW
    best = rows.agg(*[F.sum(c).alias(c) for c in ("toxic", "n")], F.max("size").alias("size")).where(F.col("n") >= occurs).toArrow()
    hashes = best["h"].to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    model = Model(counts, hashes[order], *(best[c].to_numpy().astype(float)[order] for c in ("toxic", "n", "size")), share)
    known = spark.sparkContext.broadcast(model)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelling, powers = worker_spelling(known.value.counts, known.value.mark), Powers()
        for batch in batches:
            for part in text_slices(batch, SLICE):
                words = known.value.read(part.column(1).to_pylist(), spelling, powers)
                y = part.column(0).to_numpy(zero_copy_only=False).astype(float)
                found = known.value.signs(words, part.num_rows, y)
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c) for c in found.T)], ["y", "a", "b", "c", "d"])

    table = labelled.mapInArrow(describe, "y int, a double, b double, c double, d double").toArrow()  # sum(sizes) rows at most
    y = table["y"].to_numpy().astype(float)
    x = np.column_stack([table[c].to_numpy() for c in "abcd"])
    weight = np.where(y > 0, natural[1] / total[1], natural[0] / total[0])
    # Own documents are taken out of the counts, so signs that few documents have seem to speak against toxicity.
    model.weights = logistic(x, y, weight / weight.mean(), RIDGE, (1, 2))
    return model


def toxicity(docs: DataFrame, labels: DataFrame, sizes: tuple[int, int] = (CLEAN_SAMPLE, TOXIC_SAMPLE)) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (1 if score >= 0.5).

    The score weighs the odds of the distinct toxic words of the restored text; a null or empty
    text has no words and a low score. Where there are no labels
    of both classes to learn from, all scores are 0. Several labels of a doc_id count as toxic if
    one is; labels without a doc_id or a value are not learned from. Copies among the labelled
    texts count once. Repeated rows get a row each; a null doc_id is held out. Extra columns are
    not read. No documents give no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sizes))

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        spelling, powers = worker_spelling(model.value.counts, model.value.mark), Powers()
        for texts in batches:
            rows, out, start = texts.tolist(), [], 0
            while start < len(rows):
                end, size = start, 0
                while end < len(rows) and (end == start or size < SLICE):
                    size += len(rows[end] or "")
                    end += 1
                out.append(model.value.score(rows[start:end], spelling, powers))
                start = end
            yield pd.Series(np.concatenate(out) if out else np.empty(0))

    scored = docs.select("doc_id", held_out().alias("held_out"), run(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
