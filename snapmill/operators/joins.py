"""Left joins on snapshot keys that hold up when one key owns a large part of the rows.

A left join sends all rows of a key to one task, and adaptive execution cannot split that
task when two joins share one shuffle or when the heavy side is the right one. What a key costs
is the product of its rows over the inputs. So rows per key are counted first, exactly and for all
inputs at once: map-side sums over 8-byte hashes of the key columns, one thin shuffle, and
a filter that leaves the keys whose rows or whose product is too large. Usually there are none and
the joins stay plain.

Otherwise the joins run on key and cell. Each input deals its rows of a heavy key into slices; a
cell is one slice of every input. A row is copied to all cells of its slice, so every combination
of matching rows meets in exactly one cell. All other keys have one slice and one cell, so it is
one plan for all rows: every input is read and shuffled once. A left row of a sliced key finds
matches in some cells and none in others; as the key is there, the copies without a match are
surplus and dropped. Left rows without a complete key match nothing and are spread over cells of
their own.

How many keys are heavy depends on the data. Up to MAX_HEAVY of them are broadcast; more are kept
as a table, which the inputs are joined with by key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from math import prod
from operator import and_, mul, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmill import fixed_values as V
from snapmill.sources.shared import shared_folder

# So many heavy keys are gathered and broadcast; more stay in a table.
MAX_HEAVY = 8_000
# Rows of one key and input that are no burden for a task.
HEAVY_ROWS = 2_000_000
# A task should join no more combinations of one key's rows than this many times HEAVY_ROWS.
FAN_OUT = 25

_CELL, _COPY = "__cell", "__copy"


@dataclass(frozen=True)
class HeavyKeys:
    """Keys too heavy for one task, with their rows in every input, in the order of the join."""

    rows: Mapping[tuple, tuple[int, ...]] = field(default_factory=dict)
    null_rows: bool = False  # the left input has many rows without a complete key
    task_rows: int = HEAVY_ROWS
    table: DataFrame | None = None  # instead of ``rows`` where there are many: key columns, rows_0, rows_1, ...

    def __bool__(self) -> bool:
        return bool(self.rows) or self.table is not None or self.null_rows

    def slices(self, key: tuple) -> tuple[int, ...]:
        """Into how many slices each input deals the key: as few as keep rows and combinations bounded."""
        return tuple(-(-max(1, n) // self._slice_rows(self.rows[key])) for n in self.rows[key])

    def _slice_rows(self, counts: tuple[int, ...]) -> int:
        low, high = 1, self.task_rows
        while low < high:
            size = (low + high + 1) // 2
            if prod(min(max(1, n), size) for n in counts) <= FAN_OUT * self.task_rows:
                low = size
            else:
                high = size - 1
        return low


def _complete(keys: Sequence[str]) -> Column:
    return reduce(and_, (F.col(k).isNotNull() for k in keys))


def _rows_of(i: int) -> str:
    return f"rows_{i}"


def _is_heavy(inputs: int, heavy_rows: int) -> Column:
    """More than ``heavy_rows`` rows in an input, or FAN_OUT times as many combinations of rows."""
    rows = [F.col(_rows_of(i)) for i in range(inputs)]
    combinations = reduce(mul, (F.greatest(n, F.lit(1)).cast("double") for n in rows))
    return reduce(or_, (n > heavy_rows for n in rows)) | (combinations > float(FAN_OUT * heavy_rows))


def _tagged(inputs: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """The keys of all inputs with the input's number and a hash, null where the key is not complete."""
    key_hash = F.when(_complete(keys), F.xxhash64(*keys)).alias("hash")
    return reduce(
        DataFrame.unionByName,
        (df.select(F.lit(i).alias("input"), key_hash, *keys) for i, df in enumerate(inputs.values())),
    )


def _per_input(inputs: int) -> list[Column]:
    return [F.count_if(F.col("input") == i).alias(_rows_of(i)) for i in range(inputs)]


def find_heavy_keys(
    inputs: Mapping[str, DataFrame],
    keys: Sequence[str] = V.FEATURE_KEYS,
    heavy_rows: int = HEAVY_ROWS,
) -> HeavyKeys:
    """Heavy keys of the inputs of a join, left one first, with exact counts.

    A key is heavy with more than ``heavy_rows`` rows in an input, or more than ``FAN_OUT`` times
    as many combinations of rows. None is missed, however few of the rows it has. Runs one job
    over the key columns, or two when any key is heavy. The driver gets at most MAX_HEAVY keys.
    """
    tagged, per_input = _tagged(inputs, keys), _per_input(len(inputs))
    is_heavy = _is_heavy(len(inputs), heavy_rows)
    thin = tagged.groupBy("hash").agg(*per_input).where(is_heavy | F.col("hash").isNull())
    found = thin.limit(MAX_HEAVY + 2).collect()
    nulls = next((r[_rows_of(0)] for r in found if r["hash"] is None), 0) > heavy_rows
    hashes = [(r["hash"],) for r in found if r["hash"] is not None]
    if not hashes:
        return HeavyKeys({}, nulls, heavy_rows)
    few = len(hashes) <= MAX_HEAVY
    spark = thin.sparkSession
    suspected = F.broadcast(spark.createDataFrame(hashes, "hash bigint")) if few else thin.select("hash")
    # counted again by the key itself: several keys can share a hash
    counted = tagged.join(suspected, on="hash").groupBy(*keys).agg(*per_input).where(is_heavy)
    if few:
        rows = {tuple(r[k] for k in keys): tuple(r[_rows_of(i)] for i in range(len(inputs))) for r in counted.collect()}
        return HeavyKeys(rows, nulls, heavy_rows)
    path = shared_folder(spark, "heavy-keys")
    counted.write.parquet(path)
    return HeavyKeys({}, nulls, heavy_rows, spark.read.schema(counted.schema).parquet(path))


def left_joins(
    left: DataFrame,
    rights: Sequence[DataFrame],
    keys: Sequence[str] = V.FEATURE_KEYS,
    heavy: HeavyKeys | None = None,
) -> DataFrame:
    """``left`` LEFT JOIN each of ``rights`` in turn on the same keys.

    Every match counts, nothing is deduplicated. ``heavy`` is what ``find_heavy_keys`` found for
    ``left`` and ``rights``. Inputs that have heavy keys should be stored tables: rows are
    numbered where they are scanned, so that a task that is run again numbers them alike.
    """
    keys, inputs = list(keys), [left, *rights]
    if not heavy:
        return _join_all(inputs, keys)
    return _join_in_cells(inputs, keys, _cells(left, keys, heavy, len(inputs)))


def _join_all(inputs: Sequence[DataFrame], keys: list[str]) -> DataFrame:
    return reduce(lambda so_far, right: so_far.join(right, on=keys, how="left"), inputs)


def _slices_of(i: int) -> str:
    return f"__slices_{i}"


def _row_of(i: int) -> str:
    return f"__row_{i}"


def _cells(left: DataFrame, keys: list[str], heavy: HeavyKeys, inputs: int) -> DataFrame:
    """Heavy keys with the slices of each input."""
    if heavy.table is not None:
        return heavy.table.select(*keys, *_slices(inputs, heavy.task_rows))
    slices = [T.StructField(_slices_of(i), T.LongType()) for i in range(inputs)]
    rows = [(*k, *heavy.slices(k)) for k in heavy.rows]
    # at most MAX_HEAVY rows
    return F.broadcast(left.sparkSession.createDataFrame(rows, T.StructType([left.schema[k] for k in keys] + slices)))


def _slices(inputs: int, task_rows: int) -> list[Column]:
    """What ``HeavyKeys.slices`` gives, as columns: the slice size is found bit by bit."""
    rows = [F.greatest(F.col(_rows_of(i)), F.lit(1)) for i in range(inputs)]
    bits = F.array(*[F.lit(1 << b).cast("bigint") for b in reversed(range(task_rows.bit_length()))])

    def with_bit(size: Column, bit: Column) -> Column:
        larger = size + bit
        combinations = reduce(mul, (F.least(n, larger).cast("double") for n in rows))
        return F.when((larger <= task_rows) & (combinations <= float(FAN_OUT * task_rows)), larger).otherwise(size)

    size = F.greatest(F.aggregate(bits, F.lit(0).cast("bigint"), with_bit), F.lit(1))
    return [F.ceil(n / size).cast("bigint").alias(_slices_of(i)) for i, n in enumerate(rows)]


def _join_in_cells(inputs: Sequence[DataFrame], keys: list[str], cells: DataFrame) -> DataFrame:
    counts = [F.coalesce(F.col(_slices_of(i)), F.lit(1)) for i in range(len(inputs))]
    dealt = []
    for i, df in enumerate(inputs):
        before = reduce(mul, counts[:i], F.lit(1))
        after = reduce(mul, counts[i + 1 :], F.lit(1))
        numbered = df.withColumn(_row_of(i), F.monotonically_increasing_id())
        copies = numbered.join(cells, on=keys, how="left").withColumn(
            _COPY, F.explode(F.sequence(F.lit(0).cast("bigint"), before * after - 1))
        )
        # cells are numbered with the slice of the first input as the highest digit
        own = F.pmod(F.col(_row_of(i)), counts[i])
        high, low = F.floor(F.col(_COPY) / after), F.col(_COPY) % after
        cell = ((high * counts[i] + own) * after + low).cast("bigint")
        if i == 0:
            cell = F.when(_complete(keys), cell).otherwise(F.col(_row_of(i)))
        unused = [_COPY] if i == 0 else [_COPY, *map(_slices_of, range(len(inputs)))]
        dealt.append(copies.withColumn(_CELL, cell).drop(*unused))

    joined = _join_all(dealt, [*keys, _CELL])
    for i in range(1, len(inputs)):
        joined = joined.where((counts[i] == 1) | F.col(_row_of(i)).isNotNull())
    helpers = [f(i) for i in range(len(inputs)) for f in (_slices_of, _row_of)]
    return joined.drop(_CELL, *helpers)
