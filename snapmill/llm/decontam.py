"""Benchmark decontamination on template windows.

Words are made canonical first: numbers, names and units become typed placeholders, everything
else its lower-case form. A title-case word that begins a sentence may be a name or not, so it is
tried as both, on either side. Every window of canonical words of a benchmark item is a template. A
document window with the same template is a hit if its slots agree: each number or unit of the
item stands for one value of the document within the window, each name along the whole alignment
of document and item; several may stand for the same value. So a question is caught with its numbers
and names exchanged, and text that only shares a frame is not. Windows that are equal as spelled,
whatever their case and marks, are hits by themselves. Templates are matched by hash, then literally.

The benchmark is read in blocks of bounded size. Each block is broadcast and looked up in one pass
over the documents, so a benchmark of any size needs more passes, never a larger broadcast.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from snapmill.llm.common import OTHER_MARKS, bound_batches, cut, document_key, take_out
from snapmill.llm.windows import Powers, rolling, span_hashes, spans, text_slices

#: Words of a window; shorter items are one window as a whole.
WINDOW = 13
#: Words a window must have that are no placeholders; one with fewer is found only as it is spelled.
LITERALS = 8
#: Words of a block of the benchmark; an item is never split, so a block exceeds this by one item at most.
BLOCK_WORDS = 500_000

#: Words for units of measurement that follow a number.
UNITS = frozenset(
    "kg g mg t km m cm mm mi ft yd lb lbs oz l ml s sec min h hr hrs day days week weeks month months year years "
    "hour hours minute minutes second seconds meter meters metre metres mile miles foot feet inch inches gram "
    "grams kilogram kilograms litre litres liter liters pound pounds dollar dollars euro euros cent cents percent "
    "degree degrees mph kmh km/h usd eur gbp".split()
)
#: Words that begin sentences and are no names, beside those the benchmark has in lower case.
OPENERS = frozenset(
    "a after all an and are as at before both but by can do does during each every find following for from given "
    "had has have he her here his how i if in is it its let many most my no not of on one or our several she since "
    "so some suppose that the their then there these they this those to was we were what when where which while "
    "who whose why will with would you your".split()
)
#: Signs of units beyond ASCII, read as a dollar sign.
UNIT_SIGNS = re.compile("[\u00a3\u00b0\u20ac]")
NUMBER, NAME, UNIT = "<number>", "<name>", "<unit>"
WORD_KIND, NAME_KIND, NUMBER_KIND, UNIT_KIND = range(4)
#: Bytes of text that a task reads at a time; a longer text is taken whole.
SLICE = 1 << 20

LETTER, DIGIT, SIGN, STOP, LINE, JOIN = 1, 2, 4, 8, 16, 32
CLASSES = np.zeros(256, np.uint8)
CLASSES[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = LETTER
CLASSES[[*b"0123456789"]] = DIGIT
CLASSES[[*b"$%"]] = SIGN
CLASSES[[*b"!?"]] = STOP
CLASSES[[*b".:"]] = STOP | JOIN
CLASSES[[*b",/"]] = JOIN
CLASSES[[*b"\n\r"]] = LINE


def _word_hash(word: str) -> np.uint64:
    data = np.frombuffer(word.encode(), np.uint8)
    return span_hashes(data, np.array([0]), np.array([len(data)]), Powers())[0]


PLACEHOLDERS = {NAME_KIND: _word_hash(NAME), NUMBER_KIND: _word_hash(NUMBER), UNIT_KIND: _word_hash(UNIT)}
OPENER_HASHES = np.array([_word_hash(w) for w in OPENERS])
UNIT_HASHES = np.sort(np.array([_word_hash(u) for u in UNITS]))


@dataclass
class Canonical:
    """The words of some texts: row, span in ``data`` (lower case), canonical and plain hash, kind, and whether title case."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    plain: np.ndarray
    kind: np.ndarray
    title: np.ndarray
    data: np.ndarray

    def spelled(self, at: int) -> bytes:
        return self.data[self.start[at] : self.end[at]].tobytes()


def _lower(raw: str) -> bytes:
    """Lower case with every character in as many bytes as before."""
    low = raw.lower().encode()
    if len(low) != len(raw.encode()):
        pairs = ((c, c.lower()) for c in raw)
        low = "".join(l if len(l.encode()) == len(c.encode()) else c for c, l in pairs).encode()
    return low


def canonical(texts: list[str | None], powers: Powers) -> Canonical:
    """Read all texts at once.

    Words are runs of letters, numbers runs of digits with marks between them. A word in title
    case is a name unless it begins a sentence, a line or the text; a unit is a sign, or a unit's
    word behind a number. A place is one byte, so long texts need a few times their size.
    """
    encoded = [UNIT_SIGNS.sub("$", OTHER_MARKS.sub(" ", t)).encode() if t else b"" for t in texts]
    joined = b"\n".join(encoded)
    raw = np.frombuffer(joined, np.uint8)
    data = np.frombuffer(_lower(joined.decode()), np.uint8)
    edges = np.cumsum([len(e) + 1 for e in encoded])
    classes = CLASSES[raw]
    digit = (classes & DIGIT) > 0
    if len(raw) > 2:
        digit[1:-1] |= digit[:-2] & digit[2:] & ((classes[1:-1] & JOIN) > 0)
    letter, sign = classes == LETTER, classes == SIGN
    kind_at = np.where(digit, NUMBER_KIND, np.where(sign, UNIT_KIND, WORD_KIND)).astype(np.int8)
    inside = letter | digit | sign
    step = np.flatnonzero((kind_at[1:] != kind_at[:-1]) | sign[1:]) + 1
    start, end = spans(inside, step)
    kind = kind_at[start] if len(start) else np.empty(0, np.int8)

    # A mark ends a sentence before white space or the end; a line end always does.
    blank = np.ones(len(raw) + 1, bool)
    blank[:-1] = (raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D))
    stops = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(((classes == LINE) | (((classes & STOP) > 0) & ~digit & blank[1:])), out=stops[1:])
    begins = np.ones(len(start), bool)
    begins[1:] = stops[start[1:]] > stops[end[:-1]]

    capital = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(raw != data, out=capital[1:])
    lead = np.where(data[start] < 0x80, 1, np.where(data[start] < 0xE0, 2, np.where(data[start] < 0xF0, 3, 4))) if len(start) else start
    first = np.minimum(start + lead, end)
    title = (kind == WORD_KIND) & (first < end) & (capital[first] > capital[start]) & (capital[end] == capital[first])

    plain = span_hashes(data, start, end, powers)
    number = np.zeros(len(start), bool)
    number[1:] = kind[:-1] == NUMBER_KIND
    known = np.searchsorted(UNIT_HASHES, plain) % len(UNIT_HASHES)
    unit = number & (kind == WORD_KIND) & (UNIT_HASHES[known] == plain)
    kind = np.where(unit, UNIT_KIND, np.where(title & ~begins, NAME_KIND, kind))
    hashes = plain.copy()
    for value, placeholder in PLACEHOLDERS.items():
        hashes[kind == value] = placeholder
    return Canonical(np.searchsorted(edges, start, "right"), start, end, hashes, plain, kind, title, data)


def renamed(read: Canonical, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kinds and hashes with the literal words at some places taken for names."""
    where = where & (read.kind == WORD_KIND)
    return np.where(where, NAME_KIND, read.kind), np.where(where, PLACEHOLDERS[NAME_KIND], read.hash)


def readings(read: Canonical, ordinary: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Kinds and hashes as read; with title-case words that begin a sentence as names unless ordinary; and with all of them."""
    if not len(read.kind):
        return []
    strange = ordinary[np.searchsorted(ordinary, read.plain) % len(ordinary)] != read.plain
    return [(read.kind, read.hash), renamed(read, read.title & strange), renamed(read, read.title)]


def literal_counts(kinds: np.ndarray, width: int) -> np.ndarray:
    """Of every window, how many words are no placeholders."""
    total = np.concatenate(([0], np.cumsum(kinds == WORD_KIND)))
    return total[width:] - total[:-width] if len(total) > width else np.empty(0, np.int64)


def any_of(flags: np.ndarray, width: int) -> np.ndarray:
    """Of every window, whether it has a place that is flagged."""
    total = np.concatenate(([0], np.cumsum(flags)))
    return total[width:] > total[:-width] if len(total) > width else np.empty(0, bool)


class Templates:
    """The template windows of some items, by hash; finds their hits in texts.

    A word that begins a sentence may be a name, so windows with one have several readings, and so
    have those of the texts. A window is also kept as it is spelled, without case, marks and slots.
    """

    #: Forms of an item: as read, its first word a name, then the other readings. Of windows as spelled.
    STRICT, SPELLED = 2, -1

    def __init__(self, items: list[tuple], window: int, literals: int):
        powers = Powers()
        self.items = []
        parts: dict[tuple[int, bool], list[tuple]] = defaultdict(list)
        reads = [(item_id, canonical([text], powers)) for item_id, text in dict.fromkeys(items)]
        lower = [read.plain[(read.kind == WORD_KIND) & ~read.title] for _, read in reads]
        self.ordinary = np.unique(np.concatenate([OPENER_HASHES, *lower]))
        for item_id, read in reads:
            if not len(read.kind):
                continue
            width = min(window, len(read.kind))
            # Quoted within a sentence, the first word of the item reads as a name.
            first = renamed(read, read.title & (np.arange(len(read.kind)) == 0))
            forms = readings(read, self.ordinary)
            forms.insert(1, first)
            spelled = [read.spelled(i) for i in range(len(read.kind))]
            for form, (kind, hashes) in enumerate(forms):
                kept = literal_counts(kind, width) >= literals
                for before, _ in forms[:form]:
                    kept &= any_of(kind != before, width)
                at = np.flatnonzero(kept)
                parts[width, False].append((rolling(hashes, width, powers)[at], len(self.items), at, form))
            at = np.arange(len(read.kind) - width + 1)
            parts[width, True].append((rolling(read.plain, width, powers), len(self.items), at, self.SPELLED))
            self.items.append((item_id, spelled, [kind for kind, _ in forms]))
        self.tables = {}
        for key, found in parts.items():
            values = np.concatenate([v for v, *_ in found])
            rest = [np.concatenate([np.broadcast_to(np.asarray(f[i], np.int32), len(f[0])) for f in found]) for i in (1, 2, 3)]
            order = np.argsort(values, kind="stable")
            if len(values):
                self.tables[key] = (values[order], *(column[order] for column in rest))

    def _found(self, read: Canonical, forms: list[tuple], powers: Powers) -> Iterator[tuple[int, int, int, int, int, int]]:
        """Windows of equal hash: width, place in the text, reading of the text, item, place in the item, its form."""
        for (width, as_spelled), (wanted, item, start, form) in self.tables.items():
            inside = read.row[: max(0, len(read.row) - width + 1)] == read.row[width - 1 :]
            for reading, (kind, hashes) in enumerate([(read.kind, read.plain)] if as_spelled else forms):
                values = rolling(hashes, width, powers)
                same = (wanted[np.searchsorted(wanted, values) % len(wanted)] == values) & inside
                for before, _ in forms[:reading]:
                    same &= any_of(kind != before, width)
                places = np.flatnonzero(same)
                low, high = (np.searchsorted(wanted, values[places], side) for side in ("left", "right"))
                for place, a, b in zip(places.tolist(), low.tolist(), high.tolist()):
                    for i in range(a, b):
                        yield width, place, reading, int(item[i]), int(start[i]), int(form[i])

    def hits(self, texts: list[str | None], powers: Powers) -> dict[tuple[int, object], int]:
        """By row and item id: how many windows of the text match the item with consistent slots."""
        read = canonical(texts, powers)
        readings_of = readings(read, self.ordinary)
        lines: dict[tuple[int, int, int], list[tuple]] = defaultdict(list)
        for width, place, reading, item, start, form in self._found(read, readings_of, powers):
            # A word read as a name only for its case and place is no reason to discard an alignment.
            loose = reading > 0 or form >= self.STRICT or form == self.SPELLED
            lines[int(read.row[place]), item, place - start].append((loose, width, place, start, form, reading))
        out: dict = defaultdict(set)
        for (row, item, _), windows in lines.items():
            item_id, item_words, forms = self.items[item]
            names: dict = {}
            agreeing, literal, broken = set(), set(), False
            for loose, width, place, start, form, reading in sorted(windows):
                words = [(item_words[start + i], read.spelled(place + i)) for i in range(width)]
                if form == self.SPELLED:
                    if all(a == b for a, b in words):
                        literal.add((width, place))
                    continue
                if broken:
                    continue
                kinds = forms[form][start : start + width]
                if not (kinds == readings_of[reading][0][place : place + width]).all():
                    continue
                pairs = [(a, b, kind) for (a, b), kind in zip(words, kinds.tolist())]
                if any(a != b for a, b, kind in pairs if kind == WORD_KIND):
                    continue
                if not consistent([((kind, a), b) for a, b, kind in pairs if kind in (NUMBER_KIND, UNIT_KIND)], {}):
                    continue
                if consistent([(a, b) for a, b, kind in pairs if kind == NAME_KIND], names):
                    agreeing.add((width, place))
                elif not loose:
                    broken = True
            counted = literal if broken else literal | agreeing
            if counted:
                out[row, item_id] |= counted
        return {k: len(windows) for k, windows in out.items()}


def consistent(slots: list[tuple], there: dict) -> bool:
    """Whether each of our values stands for one of theirs, as in the mapping so far; if so they join it."""
    new: dict = {}
    for ours, theirs in slots:
        if new.setdefault(ours, there.get(ours, theirs)) != theirs:
            return False
    there.update(new)
    return True


def _blocks(benchmark: DataFrame, limit: int) -> Iterator[list[tuple]]:
    """The items, read one partition after the other, in lists of bounded size."""
    block, words = [], 0
    for row in benchmark.select("item_id", "text").where("text IS NOT NULL").toLocalIterator():
        block.append((row.item_id, row.text))
        words += len(row.text.split())
        if words >= limit:
            yield block
            block, words = [], 0
    if block:
        yield block


def contaminations(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, literals: int = LITERALS, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """One row per document and item it contains: doc_id, item_id, n_windows (distinct, consistent).

    Items of fewer than ``window`` words are one window as a whole. Windows with fewer than
    ``literals`` literal words are found with their own names, numbers and units only, in any case;
    so an item of one word is in every document with that word. An item without a word or number is
    in none. Null and empty texts of
    either table give no rows. Rows that repeat doc_id and text give equal rows each; items that
    repeat item_id and text count once. Extra columns are not read. On an alignment on which any two
    windows as first read disagree about a name only windows that are equal as spelled count, which always do; a
    window that disagrees with itself about a number or unit does not count.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    id_kind = docs.schema["doc_id"].dataType.simpleString()
    item_kind = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {id_kind}, item_id {item_kind}, n_windows int"

    def lookup(block):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            powers = Powers()
            for batch in batches:
                for part in text_slices(batch, SLICE):
                    found = block.value.hits(part.column(1).to_pylist(), powers)
                    at = pa.array([row for row, _ in found], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(at), pa.array([i for _, i in found], kind), pa.array(list(found.values()), pa.int32())],
                        ["doc_id", "item_id", "n_windows"],
                    )

        return run

    kind = to_arrow_type(benchmark.schema["item_id"].dataType)
    found = spark.createDataFrame([], schema)
    blocks = _blocks(benchmark, block_words)
    block = next(blocks, None)
    while block is not None:
        following = next(blocks, None)
        shared = spark.sparkContext.broadcast(Templates(block, window, literals))
        hits = docs.select("doc_id", "text").mapInArrow(lookup(shared), schema)
        if following is not None:
            hits = cut(hits)
            shared.unpersist()
        found = found.unionByName(hits)
        block = following
    return found


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that contain no benchmark item, with all their columns.

    Null and empty texts stay, and all do where the benchmark has no words. Repeated rows stay or go
    together. Extra columns may have any name and type. No documents give no rows. Keys of what
    goes are listed in the shared folder; see ``take_out``.
    """
    keyed = docs.select(document_key().alias("doc_id"), "text")
    found = contaminations(keyed, benchmark, **options).select(F.col("doc_id").alias("key"), F.lit(False).alias("stays"))
    return take_out(docs, found.distinct())
