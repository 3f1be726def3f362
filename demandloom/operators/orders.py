"""Order statistics of moving frames, in logarithmic time for each row.

A key's values are numbered by size. A wavelet matrix holds, for each binary digit of these numbers, how many values up to each place have a zero
there once the values are dealt by the higher digits. The k-th smallest value of any stretch of places then follows digit by digit, for
all rows at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A new column: the column whose values count, first and last row of the frame relative to each row (None: from the first row on), and the share.
Frame = tuple[str, int | None, int, float]


class Digits:
    """The k-th smallest value of any stretch of an array without nulls."""

    def __init__(self, values: np.ndarray) -> None:
        self.sorted, number = np.unique(values, return_inverse=True)
        self.levels = []
        for digit in reversed(range(max(1, int(len(self.sorted) - 1).bit_length()))):
            zero = (number >> digit) & 1 == 0
            self.levels.append((digit, np.r_[0, np.cumsum(zero)]))
            number = np.r_[number[zero], number[~zero]]

    def kth(self, start: np.ndarray, end: np.ndarray, k: np.ndarray) -> np.ndarray:
        """For each row the value that k values of the stretch [start, end) come before; 0 <= k < end - start."""
        number = np.zeros(len(k), np.int64)
        for digit, zeros in self.levels:
            a, b, all_zeros = zeros[start], zeros[end], zeros[-1]
            low = k < b - a
            number |= np.where(low, 0, 1 << digit)
            k = np.where(low, k, k - (b - a))
            start, end = np.where(low, a, all_zeros + start - a), np.where(low, b, all_zeros + end - b)
        return self.sorted[number]


def moving_quantile(values: np.ndarray, there: np.ndarray, first: int | None, last: int, share: float, starts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The interpolated quantile of the values that are there in each row's frame, and whether it has any. starts: where series begin that follow one another (one if None); frames end with them."""
    place, n = np.arange(len(values)), len(values)
    starts = np.zeros(1, np.int64) if starts is None else starts
    sizes = np.diff(np.r_[starts, n])
    low, high = np.repeat(starts, sizes), np.repeat(starts + sizes, sizes)
    before = np.r_[0, np.cumsum(there)]
    start = before[low if first is None else np.clip(place + first, low, high)]
    end = np.maximum(start, before[np.clip(place + last + 1, low, high)])
    some = end > start
    out = np.zeros(n)
    if some.any():
        digits, at = Digits(values[there]), (end - start - 1)[some] * share
        low = np.floor(at).astype(np.int64)
        a, b = (digits.kth(start[some], end[some], k) for k in (low, np.ceil(at).astype(np.int64)))
        out[some] = np.where(a == b, a, a + (b - a) * (at - low))
    return out, some


def starts_of(keys: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Where a new key begins in a column of sorted keys."""
    keys = pa.chunked_array([keys]) if isinstance(keys, pa.Array) else keys
    codes = keys.combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
    return np.r_[0, np.flatnonzero(codes[1:] != codes[:-1]) + 1] if len(codes) else np.zeros(0, np.int64)


def whole_keys(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of sorted batches as tables of whole keys: a batch's last key waits for the next batch."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        cut = int(starts_of(b.column(key))[-1])
        if held and not cut and held[-1].column(key)[-1].as_py() == b.column(key)[0].as_py():
            held.append(b)
            continue
        if held or cut:
            yield pa.Table.from_batches([*held, b.slice(0, cut)])
        held = [b.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)


def moving_quantiles(df: DataFrame, frames: dict[str, Frame], key: str = "key", time: str = "week_idx") -> DataFrame:
    """df with the quantile of each frame over a key's rows in order of time: null where the frame has no value. Null and NaN values don't count.

    Keys are taken by the batch, not one by one: many short series cost no more than a few long ones. A key's rows are in memory at once.
    """
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, T.DoubleType()) for n in frames if n not in df.columns]])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_keys(batches, key):
            starts = starts_of(t.column(key))
            for name, (column, first, last, share) in frames.items():
                values = t.column(column).cast(pa.float64()).to_numpy(zero_copy_only=False)
                q, some = moving_quantile(values, ~np.isnan(values), first, last, share, starts)
                t = t.append_column(name, pa.array(q, pa.float64(), mask=~some))
            yield from t.combine_chunks().to_batches()

    return df.repartition(key).sortWithinPartitions(key, time).mapInArrow(each, schema)


def decayed_sums(df: DataFrame, terms: dict[str, tuple[Column, float]], key: str | list[str] = "key", time: str = "week_idx") -> DataFrame:
    """df with, for each name, the sum of a term over a key's rows (or those of several columns) up to this one, each row's decayed by q for every row since: s = q * s before + term. Null terms count as 0.

    The steps are affine maps that compose. Within blocks of rows a running sum of the terms over powers of q gives the decayed sum. The blocks' sums are then composed with those 1, 2, 4, ...
    blocks before, until q to that distance is 0 for a double, so no row is cut off by a bound of this function. Each step is one pass over the key's rows, and all use one order.
    """
    decays, keys = [q for _, q in terms.values() if q > 0], [key] if isinstance(key, str) else key
    # q to the power of -rows must not overflow.
    rows = min([64, *[int(200 / -np.log10(q)) for q in decays if q < 1]])
    df = df.withColumn("_pos", F.row_number().over(W.partitionBy(*keys).orderBy(time)) - 1).withColumn("_block", F.expr(f"_pos div {rows}")).withColumn("_in", F.expr(f"_pos % {rows}"))
    inside, whole = W.partitionBy(*keys, "_block").orderBy(time).rowsBetween(W.unboundedPreceding, 0), W.partitionBy(*keys).orderBy("_block", time)
    own, ends = {}, {}
    for i, (term, q) in enumerate(terms.values()):
        x = F.coalesce(term.cast("double"), F.lit(0.0))
        own[f"_own{i}"] = F.sum(x * F.pow(F.lit(q), -F.col("_in"))).over(inside) * F.pow(F.lit(q), F.col("_in")) if q else x
        ends[f"_end{i}"] = F.when(F.col("_in") == rows - 1, F.col(f"_own{i}"))
    df = df.withColumns(own).withColumns(ends)
    step = rows
    while any(q**step > 0 for q in decays) and step < 2**31:
        df = df.withColumns({f"_end{i}": F.col(f"_end{i}") + q**step * F.coalesce(F.lag(f"_end{i}", step).over(whole), F.lit(0.0)) for i, (_, q) in enumerate(terms.values()) if q**step > 0})
        step *= 2
    last = lambda i: F.coalesce(F.last(f"_end{i}", ignorenulls=True).over(whole.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    out = {name: F.col(f"_own{i}") + last(i) * F.pow(F.lit(q), F.col("_in") + 1) for i, (name, (_, q)) in enumerate(terms.items())}
    return df.withColumns(out).drop("_pos", "_block", "_in", *own, *ends)
