"""Stretches of words that repeat with a period, found as maximal pairs of equal word sequences.

A maximal pair is two equal sequences of a text that neither can be extended to the left nor to
the right. If the two begin ``q`` words apart and are ``m`` long, the text has the period ``q``
over ``m + q`` words and over no more: a pair with ``q`` small against ``m`` is a run, without
any extension. Pairs come from the tree of longest-common-prefix intervals of the text's suffix
array, visited bottom-up. Each interval keeps its positions in lists by the word to the left;
when two children meet, positions of different lists (no extension to the left) of different
children (none to the right) are paired, and only those close enough for the length wanted are
looked at.

Only suffixes that share ``LEAST - 1`` words or more with another one enter the tree, as shorter
common prefixes cannot make a run.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A run is at least this long, and at least so many periods.
LEAST, PERIODS = 6, 4


def _named(*columns: np.ndarray) -> np.ndarray:
    """Numbers rows in their order; equal rows get equal numbers."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    for column in columns:
        new[1:] |= column[order[1:]] != column[order[:-1]]
    names = np.empty(len(order), np.int32)
    names[order] = np.cumsum(new)
    return names


def _ahead(names: np.ndarray, by: int) -> np.ndarray:
    """The names ``by`` places on; -1 beyond the end."""
    return np.concatenate((names[by:], np.full(min(by, len(names)), -1, names.dtype)))


def sorted_suffixes(words: np.ndarray, at_least: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes whose first ``at_least`` words occur elsewhere too, in order, by prefix doubling.

    Returns them and the length of the common prefix of each with the one before it (0 for the
    first of those that share less than ``at_least`` words).
    """
    n = len(words)
    levels = [_named(words)]  # names of the sequences of 1, 2, 4 ... words
    while True:
        names, by = levels[-1], 1 << (len(levels) - 1)
        counts = np.bincount(names)
        if by >= at_least and (by >= n or not (counts > 1).any()):
            break
        levels.append(_named(names, _ahead(names, by)))
    order = np.argsort(levels[-1], kind="stable")
    one, other = order[:-1].copy(), order[1:].copy()
    shared = np.zeros(max(0, n - 1), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        names = np.append(levels[level], np.int32(-1))
        a, b = np.minimum(one + shared, n), np.minimum(other + shared, n)
        # A name covers ends of text as well, so both sequences have to be whole.
        whole = np.maximum(a, b) + (1 << level) <= n
        shared += np.where(whole & (names[a] == names[b]), 1 << level, 0)
    shared[shared < at_least] = 0
    kept = np.concatenate((shared > 0, [False])) | np.concatenate(([False], shared > 0)) if n else np.zeros(0, bool)
    return order[kept], np.concatenate(([0], shared))[: n][kept]


@dataclass
class _Interval:
    """Positions of an interval of the tree: all in order, and in order by the word to the left."""

    places: list[int]
    by_left: dict[int, list[int]] = field(default_factory=dict)


def _near(places: list[int], at: int, reach: int) -> list[int]:
    return places[bisect_left(places, at - reach) : bisect_right(places, at + reach)]


def _met(one: _Interval, other: _Interval, left: np.ndarray, reach: int, found: Callable[[int, int], None]) -> _Interval:
    """Pairs up two children of an interval and joins them, the smaller into the larger."""
    small, large = (one, other) if len(one.places) < len(other.places) else (other, one)
    for at in small.places:
        own = left[at]
        around = bisect_right(large.places, at + reach) - bisect_left(large.places, at - reach)
        if around <= len(large.by_left):
            for place in _near(large.places, at, reach):
                if left[place] != own:
                    found(at, place)
        else:
            for word, places in large.by_left.items():
                if word != own:
                    for place in _near(places, at, reach):
                        found(at, place)
    for word, places in small.by_left.items():
        known = large.by_left.setdefault(word, [])
        for place in places:
            insort(known, place)
            insort(large.places, place)
    return large


def runs_of(words: np.ndarray, least: int = LEAST, periods: int = PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence of word numbers, by start and period."""
    if len(words) < least:
        return []
    # A pair of length m at distance q makes m + q words: m >= (periods - 1) * q, and m + q >= least.
    shortest = min(max(least - q, (periods - 1) * q) for q in range(1, least + 1))
    suffixes, shared = sorted_suffixes(words, shortest)
    left = np.concatenate(([-1], words[:-1]))
    smallest: dict[tuple[int, int], int] = {}

    def meet(one: _Interval, other: _Interval, length: int) -> _Interval:
        def found(a: int, b: int) -> None:
            start, period = min(a, b), abs(a - b)
            if length + period >= least:
                span = start, length + period
                smallest[span] = min(period, smallest.get(span, period))

        return _met(one, other, left, length // (periods - 1), found)

    waiting: list[tuple[int, _Interval]] = []

    def close(down_to: int, current: _Interval) -> _Interval:
        while waiting and waiting[-1][0] >= down_to:
            length, before = waiting.pop()
            current = meet(before, current, length)
        return current

    current: _Interval | None = None
    for place, length in zip(suffixes.tolist(), shared.tolist(), strict=True):
        if current is not None:
            if length == 0:
                close(1, current)
            else:
                # Deeper intervals are complete; one of the same depth takes another child.
                waiting.append((length, close(length, current)))
        current = _Interval([place], {int(left[place]): [place]})
    if current is not None:
        close(1, current)
    return sorted((start, length, period) for (start, length), period in smallest.items())


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay when every run is cut down to its first period."""
    steps = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return np.cumsum(steps)[:n] == 0


def numbers_of(words: list[bytes]) -> np.ndarray:
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


_SHAPE = pa.schema(
    [("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()),
     ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
     ("collapsed", pa.binary())]
)


def periodic_runs(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least: int = LEAST,
    periods: int = PERIODS,
    words_of: Callable[[object, bytes | None], list[bytes]] | None = None,
) -> DataFrame:
    """One row (key, n_runs, start, length, period, runs, collapsed) for each document.

    ``runs`` lists every run by start, then period; start, length and period are those of the
    longest one (ties: smallest start, then period), null without runs. ``collapsed`` is the UTF-8
    text of the words that stay, joined by spaces, when every run keeps its first period only.
    ``words_of`` gives a document's words from its key and UTF-8 text; by default they are what
    space, tab, line feed, vertical tab, form feed and return separate. Null and empty texts have
    no words and no runs; a null key stays null, equal rows stay separate rows, an empty table
    gives an empty table. Columns other than key and text are not read, so none can clash.
    """
    take = words_of or (lambda key, text: (text or b"").split())

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = take(name, text.as_py())
                runs = runs_of(numbers_of(words), least, periods)
                start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
                left = kept_words(len(words), runs)
                collapsed = b" ".join(w for w, stays in zip(words, left.tolist(), strict=True) if stays) if runs else b" ".join(words)
                rows.append(
                    {"n_runs": len(runs), "start": start, "length": length, "period": period, "collapsed": collapsed,
                     "runs": [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs]}
                )
            out = pa.RecordBatch.from_pylist(rows, schema=_SHAPE)
            yield pa.RecordBatch.from_arrays([batch.column(0), *out.columns], ["key", *_SHAPE.names])

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    shape = f"key {kind}, n_runs long, start long, length long, period long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"
    return rows.mapInArrow(found, shape).withColumnRenamed("key", key)


def planted(key: object, text: bytes | None) -> list[bytes]:
    """The words of a document; in every tenth one, by a hash of its key, a tail made periodic."""
    words = (text or b"").split()
    n = len(words)
    if key is None:
        return words
    h = crc32(str(key).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def query(spark: SparkSession, folder: str) -> DataFrame:
    """op12: the runs of all documents, digests in place of lists and texts."""
    found = periodic_runs(spark.read.parquet(f"{folder}/documents.parquet"), words_of=planted)
    line = lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    return found.select(
        "doc_id", "n_runs", "start", "length", "period",
        F.expr("1000 * length div period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
