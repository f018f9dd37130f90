"""Removal of byte strings that occur more than once, by a distributed suffix array.

A text is cut into phrases at places that its own bytes choose, so equal strings are cut alike;
a phrase is one symbol. Cuts whose surroundings occur once in all texts belong to no repeated
string and are left out, but for those that follow another one. ``suffix_ranks`` sorts the
suffixes of the rest by the difference-cover algorithm: it sorts the triples of symbols at two of
three places, recurses on their ranks until these differ or reach over enough bytes, and merges
the remaining suffixes by (symbol, rank of the next) pairs. Ranks that are final are not carried
into the recursion.

Then prefixes of adjacent suffixes are compared. Suffixes that share enough whole phrases with a
neighbour may begin a repeated string; their surroundings are merged where they are equal, and
where several different ones meet, each start of a string between two cuts is decided on its own
bytes. ``Cuts`` says why no repeated string is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest as _digest

from ridemart.llm.common import releasing_shuffles, stored

#: Bytes of a string that has to occur twice.
LENGTH = 400


@dataclass(frozen=True)
class Cuts:
    """Where texts are cut, for strings of ``length`` bytes.

    Of every ``window`` consecutive grams the one with the least hash is chosen (of equal ones the
    last) and a text is cut at each chosen gram. Whether a place is cut depends on ``window - 1``
    grams to either side, so where a string occurs, its bytes alone decide on the places from
    ``lead`` on until ``tail`` before its end. ``window`` is so small that two cuts at least fall
    into that stretch: the phrase from the first to the next occurs as often as the string.
    """

    length: int = LENGTH

    @cached_property
    def gram(self) -> int:
        return max(1, min(8, self.length // 10))

    @cached_property
    def window(self) -> int:
        return (self.length - self.gram + 3) // 4

    @cached_property
    def lead(self) -> int:
        return self.window - 1

    @cached_property
    def tail(self) -> int:
        return self.window + self.gram - 1

    @cached_property
    def compared(self) -> int:
        """Bytes after a string's first sure cut, at most, in which further cuts are sure."""
        return self.length - self.lead - self.tail

    @cached_property
    def core(self) -> int:
        """Bytes from ``lead`` before a cut on that every string with that first sure cut has."""
        return self.length - self.window + 1

    def of(self, text: bytes) -> np.ndarray:
        """The cuts of a text; none if it is shorter than ``length``."""
        if len(text) < self.length:
            return np.zeros(0, np.int64)
        many = len(text) - self.gram + 1
        h = np.ndarray((many,), "<u8", text + bytes(8), 0, (1,)) & np.uint64((1 << 8 * self.gram) - 1)
        h = h * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0x94D049BB133111EB)
        # The place counts down in the low bits, so that the last of equal hashes is the least.
        low = np.uint64(2**32 - 1)
        least = (h & ~low) | (low - np.arange(many, dtype=np.uint64))
        span = 1
        while span < self.window:
            step = min(span, self.window - span)
            least = np.minimum(least[:-step], least[step:])
            span += step
        chosen = (low - (least & low)).astype(np.int64)  # never falls
        return chosen[np.concatenate(([True], chosen[1:] != chosen[:-1]))]


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


# ---- sorting suffixes --------------------------------------------------------------------


def _counted(rows: DataFrame, keys: list[str], marked: Column, keep: list[str], purpose: str) -> DataFrame:
    """Adds ``before``, how many rows are smaller by ``keys``, ``marks_before``, how many of those
    are marked, ``tied``, whether a neighbour in order is equal, and ``filled``, whether its range
    holds equal rows only, to the columns ``keep``. Stored.

    Rows are sorted by ranges; a task counts within its range, and the ranges' sizes and the keys
    at their ends (one row a range) give the rest. Rows with the same keys may fill many ranges,
    which divide them by text. Keys are longs and not null.
    """
    ranged = rows.withColumn("marked", marked.cast("long")).repartitionByRange(*keys, "text").sortWithinPartitions(*keys)
    shape, ends = ranged.schema, pa.list_(pa.int64())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last, here, marks, at_rows, at_marks = None, None, 0, 0, 0, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            values = np.stack([batch.column(batch.schema.get_field_index(k)).to_numpy() for k in keys])
            new = np.ones(n, bool)
            new[1:] = (values[:, 1:] != values[:, :-1]).any(0)
            new[0] = last is None or (values[:, 0] != last).any()
            marked = batch.column(batch.schema.get_field_index("marked")).to_numpy()
            # The place of the latest new row up to each one; -1 where that is in a batch before.
            latest = np.maximum.accumulate(np.where(new, np.arange(n), -1))
            sums = np.concatenate(([0], np.cumsum(marked)))
            before = np.where(latest < 0, at_rows, here + latest)
            marks_before = np.where(latest < 0, at_marks, marks + sums[latest])
            if held is not None:  # the last row before, which did not know its neighbour
                yield with_columns(*held[:4], held[4] | ~new[:1])
            tied = ~new
            tied[:-1] |= ~new[1:]
            if n > 1:
                end = [*values[:, 0].tolist(), here + 1, marks + int(sums[1]), int(before[0]), int(marks_before[0])]
                yield with_columns(batch.slice(0, n - 1), end, before[:-1], marks_before[:-1], tied[:-1])
            last, at_rows, at_marks = values[:, -1], int(before[-1]), int(marks_before[-1])
            here, marks = here + n, marks + int(sums[-1])
            held = batch.slice(n - 1), [*last.tolist(), here, marks, at_rows, at_marks], before[-1:], marks_before[-1:], tied[-1:]
        if held is not None:
            yield with_columns(*held)

    def with_columns(batch: pa.RecordBatch, end: list[int], *added: np.ndarray) -> pa.RecordBatch:
        # Some rows, among them the first and the last of a range, have in ``end`` their keys, rows
        # and marks up to them, and their counts.
        end = pa.concat_arrays([pa.array([end], ends), pa.nulls(batch.num_rows - 1, ends)])
        return pa.RecordBatch.from_arrays([*batch.columns, end, *map(pa.array, added)], [*batch.schema.names, "end", "before", "marks_before", "tied"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in shape.fields)
    local = ranged.mapInArrow(count, f"{fields}, end array<long>, before long, marks_before long, tied boolean")
    local = local.select(*keep, "end", "before", "marks_before", "tied")
    kept = stored(local.withColumn("part", F.spark_partition_id()), purpose)
    found = kept.filter("end IS NOT NULL").groupBy("part").agg(F.min("end").alias("low"), F.max("end").alias("high"))
    sizes = found.select(
        "part", *[F.slice(c, 1, len(keys)).alias(c) for c in ("low", "high")],
        *[F.col("high")[len(keys) + k].alias(c) for k, c in enumerate(("n", "m", "n_high", "m_high"))],
    )
    parts = W.orderBy("part")  # one row a range
    earlier = parts.rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.withColumns({
        **{f"{c}_0": F.coalesce(F.sum(c).over(earlier), F.lit(0)) for c in ("n", "m")},
        "from_before": F.coalesce(F.col("low") == F.lag("high").over(parts), F.lit(False)),
        "goes_on": F.coalesce(F.col("high") == F.lead("low").over(parts), F.lit(False)),
    })

    def of_low(c: str) -> Column:  # what comes before the rows with the range's first keys, in all ranges
        begun = F.when(~F.col("from_before") | (F.col("n_high") > 0), F.col(f"{c}_0") + F.col(f"{c}_high"))
        return F.when(F.col("from_before"), F.last(begun, ignorenulls=True).over(earlier)).otherwise(F.col(f"{c}_0"))

    offsets = sizes.select("part", "n_0", "m_0", "n_high", "from_before", "goes_on", of_low("n").alias("n_low"), of_low("m").alias("m_low"))
    low, high = F.col("before") == 0, F.col("before") == F.col("n_high")
    return kept.join(F.broadcast(offsets), "part").select(
        *keep,
        F.when(low, F.col("n_low")).otherwise(F.col("n_0") + F.col("before")).alias("before"),
        F.when(low, F.col("m_low")).otherwise(F.col("m_0") + F.col("marks_before")).alias("marks_before"),
        (F.col("tied") | (low & F.col("from_before")) | (high & F.col("goes_on"))).alias("tied"),
        (F.col("n_high") == 0).alias("filled"),
    )


def suffix_ranks(symbols: DataFrame, length: int, bound: int = 1 << 40) -> DataFrame:
    """(text, place, rank) of every suffix: how many suffixes are smaller.

    ``symbols`` has text, place, symbol (all long), size (bytes of the symbol) and more, whether
    the string goes on at place + 1. Suffixes that agree over ``length`` bytes or to their ends
    may get equal ranks. Each level of the recursion holds two thirds of the one before at most.
    Places are below ``bound``.
    """
    within = W.partitionBy("text").orderBy("place")
    goes_on = F.col("more") & (F.lead("place").over(within) == F.col("place") + 1)
    linked = symbols.withColumn("on", F.coalesce(goes_on, F.lit(False)))
    on_1 = F.col("on") & F.lead("on").over(within)
    triples = stored(
        linked.select(
            "text", "place", "symbol",
            F.when(F.col("on"), F.lead("symbol").over(within)).otherwise(F.lit(-1)).alias("next"),
            F.when(on_1, F.lead("symbol", 2).over(within)).otherwise(F.lit(-1)).alias("third"),
            (F.col("size") + F.when(F.col("on"), F.lead("size").over(within)).otherwise(0)
             + F.when(on_1, F.lead("size", 2).over(within)).otherwise(0)).alias("size"),
            "on", F.coalesce(on_1, F.lit(False)).alias("whole"),
        ).select("*", F.lead("on", 2).over(within).alias("on_2")),
        "suffix_triples",
    )

    third = F.col("place") % 3
    sampled = triples.filter(third != 0).select("text", "place", "symbol", "next", "third", "size", (F.col("whole") & F.coalesce("on_2", F.lit(False))).alias("open"))
    named = _counted(sampled, ["symbol", "next", "third"], F.lit(0), ["text", "place", "size", "open"], "suffix_names")
    undecided = F.col("tied") & (F.col("size") < length)
    if named.filter(undecided & F.col("open")).isEmpty():
        ranks = named.select("text", "place", F.col("before").alias("rank"))
    else:
        # Only tied ranks are carried on, each with the final one after it, where comparisons end.
        inner = named.select(
            "text", (F.expr("place div 3") + F.when(third == 2, bound).otherwise(0)).alias("place"), F.col("before").alias("symbol"), "size",
            undecided.alias("going"), (undecided & F.col("open")).alias("more"),
        )
        follows = F.coalesce(F.lag("more").over(within) & (F.lag("place").over(within) == F.col("place") - 1), F.lit(False))
        inner = inner.withColumn("follows", follows).filter(F.col("going") | F.col("follows")).drop("follows")
        # Of equal symbols the least suffix has as many smaller ones as there are smaller symbols.
        # That number is counted where a symbol is too common to bring its suffixes together.
        if named.filter(undecided & F.col("filled")).isEmpty():
            inner, least = stored(inner, "suffix_inner"), F.min("rank").over(W.partitionBy("symbol"))
        else:
            inner, least = _counted(inner, ["symbol"], F.lit(0), inner.columns, "suffix_inner"), F.col("before")
        found = suffix_ranks(inner.select("text", "place", "symbol", "size", "more"), length, 2 * bound)
        found = found.join(inner.filter("going").drop("size", "going", "more"), ["text", "place"])
        place = F.when(F.col("place") < bound, F.col("place") * 3 + 1).otherwise((F.col("place") - bound) * 3 + 2)
        found = found.select("text", place.alias("place"), (F.col("rank") - least).alias("within"))
        ranks = named.join(found, ["text", "place"], "left").select(
            "text", "place", (F.col("before") + F.coalesce("within", F.lit(0))).alias("rank")
        )

    joined = triples.select("text", "place", "symbol", "next", "on", "whole").join(ranks, ["text", "place"], "left")
    joined = joined.select(
        "*",
        F.when(F.col("on"), F.lead("rank").over(within)).otherwise(F.lit(-1)).alias("rank_1"),
        F.when(F.col("whole"), F.lead("rank", 2).over(within)).otherwise(F.lit(-1)).alias("rank_2"),
    )
    # Against those at places 1 of 3, suffixes at places 0 compare by (symbol, rank of the next);
    # against places 2 by two symbols and the rank after them. Each comparison is one sorted list.
    one = F.struct(F.lit(0).cast("long").alias("side"), F.col("symbol").alias("x"), F.col("rank_1").alias("y"), F.lit(0).cast("long").alias("z"))
    two = F.struct(F.lit(1).cast("long").alias("side"), F.col("symbol").alias("x"), F.col("next").alias("y"), F.col("rank_2").alias("z"))
    lists = F.when(third == 0, F.array(one, two)).when(third == 1, F.array(one)).otherwise(F.array(two))
    entries = joined.select("text", "place", "rank", F.inline(lists))
    counted = _counted(entries, ["side", "x", "y", "z"], (third == 0), ["text", "place", "rank", "side"], "suffix_merge")
    in_list = counted.filter("side = 0").agg(F.count(F.lit(1)).alias("rows_0"), F.sum((third == 0).cast("long")).alias("marks_0"))
    first_of_two = counted.crossJoin(F.broadcast(in_list))  # one row
    smaller = F.col("before") - F.when(F.col("side") == 1, F.col("rows_0")).otherwise(0)
    smaller_marked = F.col("marks_before") - F.when(F.col("side") == 1, F.coalesce("marks_0", F.lit(0))).otherwise(0)
    share = (
        F.when(third != 0, smaller_marked + F.col("rank"))
        .when(F.col("side") == 0, smaller)
        .otherwise(smaller - smaller_marked)
    )
    return first_of_two.groupBy("text", "place").agg(F.sum(share).alias("rank"))


# ---- from suffixes to bytes --------------------------------------------------------------


def _dealt(keys: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys, of which equal ones but the first are replaced by ``others``, and which ones have an equal.

    Rows of an Arrow batch with the same key are sure to share it, so one of them is sent on with
    the key and the rest with a number of their own: a key that very many rows have comes once
    from a batch and its rows are dealt out evenly.
    """
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    again, sure = np.zeros((2, len(keys)), bool)
    again[order[1:]] = same
    sure[order[1:]] = same
    sure[order[:-1]] |= same
    return np.where(again, others, keys), sure


def _cores(texts: DataFrame, cuts: Cuts) -> DataFrame:
    """(text, place, core, sure) of each cut that has a core, the bytes all its strings have.

    Cuts with the same core in one Arrow batch are dealt out. Sorting makes the batches of a
    repeated task the same; the texts come sorted from their aggregate.
    """
    shape = pa.schema([*((c, pa.int64()) for c in ("text", "place", "core")), ("sure", pa.bool_())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, places, digests = [], [], []
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = value.as_py()
                at = cuts.of(data)
                some = np.flatnonzero((at >= cuts.lead) & (at + cuts.compared <= len(data)))
                names.append(np.full(len(some), name))
                places.append(some)
                digests.extend([_digest(data[a : a + cuts.core]) for a in (at[some] - cuts.lead).tolist()])
            if digests:
                text, place, core = np.concatenate(names), np.concatenate(places), np.array(digests, np.uint64)
                core, sure = _dealt(core, text.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + place.astype(np.uint64))
                yield pa.RecordBatch.from_arrays([*map(pa.array, (text, place, core.view(np.int64), sure))], schema=shape)

    return texts.sortWithinPartitions("text").mapInArrow(cut, "text long, place long, core long, sure boolean")


def _shared(texts: DataFrame, cuts: Cuts) -> DataFrame:
    """(text, place) of the cuts whose core occurs again."""
    same = W.partitionBy("core")
    return _cores(texts, cuts).withColumn("n", F.count(F.lit(1)).over(same)).filter("sure OR n > 1").select("text", "place")


_ITEMS = pa.schema(
    [("text", pa.int64()), ("place", pa.int64()), ("symbol", pa.int64()), ("size", pa.int64()), ("copies", pa.int64()),
     ("first", pa.int64()), ("last", pa.int64()), ("around", pa.int64()), ("core", pa.int64()),
     ("own", pa.int32()), ("prefixes", pa.list_(pa.int32()))]
)


def _items(texts: DataFrame, shared: DataFrame, cuts: Cuts) -> DataFrame:
    """One row for each shared cut, and for those near after one: its phrase as a symbol.

    A shared cut is the first sure one of the strings that start at ``first`` to ``last`` (null for
    other cuts); ``around`` names all their bytes and ``core`` those that each of them has.
    ``prefixes`` names the whole phrases after the cut, one more each time; ``own`` is the last of
    them that all the strings have.
    """
    by_text = shared.groupBy("text").agg(F.collect_list("place").alias("places"))
    length, lead = cuts.length, cuts.lead

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: dict[str, list] = {f.name: [] for f in _ITEMS}
            for name, value, copies, known in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), batch.column(3), strict=True):
                data = value.as_py()
                at = cuts.of(data)
                stops = np.append(at[1:], len(data))
                firsts = np.concatenate(([0], np.maximum(at[:-1] - lead + 1, 0)))
                lasts = np.minimum(at - lead, len(data) - length)
                # The sure cuts end ``tail`` before the end of the first string that has this one.
                sure = np.searchsorted(at, np.minimum(at - lead, firsts) + length - cuts.tail, "right")
                known_to = np.searchsorted(at, at + cuts.compared, "right")
                own = np.zeros(len(at), bool)
                own[known.values.to_numpy()] = True
                own &= firsts <= lasts
                steps = np.zeros(len(at) + 1, np.int64)
                np.add.at(steps, np.flatnonzero(own), 1)
                np.add.at(steps, known_to[own], -1)
                ks = np.flatnonzero(np.cumsum(steps)[:-1] > 0)
                mine = own[ks]
                shared = ks[mine]

                def digests(begins: np.ndarray, ends: np.ndarray, data: bytes = data) -> np.ndarray:
                    return np.array([_digest(data[a:b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)], np.uint64)

                def nullable(values: np.ndarray, mine: np.ndarray = mine) -> pa.Array:
                    whole = np.zeros(len(mine), values.dtype)
                    whole[mine] = values
                    return pa.array(whole, mask=~mine)

                many = known_to[shared] - shared - 1
                before = np.cumsum(many) - many  # the place of each cut's first prefix among all
                within = np.arange(many.sum()) - np.repeat(before, many)
                prefixes = (digests(np.repeat(at[shared], many), at[np.repeat(shared + 1, many) + within]) >> np.uint64(33)).astype(np.int32)
                sizes = np.zeros(len(ks), np.int64)
                sizes[mine] = many
                columns = {
                    "text": np.full(len(ks), name), "place": ks, "size": stops[ks] - at[ks], "copies": np.full(len(ks), copies),
                    "symbol": (digests(at[ks], stops[ks]) >> np.uint64(1)).astype(np.int64),  # never negative
                    "first": nullable(firsts[shared]), "last": nullable(lasts[shared]),
                    "around": nullable(digests(firsts[shared], lasts[shared] + length).view(np.int64)),
                    "core": nullable(digests(at[shared] - lead, at[shared] - lead + cuts.core).view(np.int64)),
                    "own": nullable(prefixes[before + sure[shared] - shared - 2]),
                    "prefixes": pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(prefixes)),
                }
                for c, values in columns.items():
                    parts[c].append(values if isinstance(values, pa.Array) else pa.array(values))
            if parts["text"]:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(p) for p in parts.values()], schema=_ITEMS)

    shape = (
        "text long, place long, symbol long, size long, copies long, first long, last long, around long, core long, own int, prefixes array<int>"
    )
    return texts.join(by_text, "text").select("text", "data", "copies", "places").mapInArrow(make, shape)


def _meeting(contexts: DataFrame) -> DataFrame:
    """(around, text, first, last, core, sure) of contexts whose suffix shares its surely held
    phrases with the one before or after in order.

    The first and last suffix of each sorted range count as sharing: that adds work, not strings.
    Equal ranks may fill many ranges, and contexts with the same core in one batch are dealt out.
    """
    ranged = contexts.repartitionByRange("rank", "around").sortWithinPartitions("rank", "around")
    fields = ["around", "text", "first", "last", "core"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[pa.RecordBatch, bool] | None = None  # the last row, and whether it shares already
        for batch in batches:
            if held is not None:
                batch = pa.Table.from_batches([held[0], batch]).combine_chunks().to_batches()[0]
            n = batch.num_rows
            if not n:
                continue
            own, prefixes = batch.column(batch.schema.get_field_index("own")).to_pylist(), batch.column(batch.schema.get_field_index("prefixes")).to_pylist()
            meets = np.array([o in p for o, p in zip(own[1:], prefixes[:-1], strict=True)] + [False], bool)
            meets = np.concatenate(([held is None or held[1]], meets[:-1]))
            meets[:-1] |= np.array([o in p for o, p in zip(own[:-1], prefixes[1:], strict=True)], bool)
            held = batch.slice(n - 1), bool(meets[-1])
            yield dealt(batch.slice(0, n - 1).select(fields).filter(pa.array(meets[:-1])))
        if held is not None:
            yield dealt(held[0].select(fields))

    def dealt(batch: pa.RecordBatch) -> pa.RecordBatch:
        core, sure = _dealt(batch.column(4).to_numpy(), batch.column(0).to_numpy())
        return pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(core), pa.array(sure)], [*fields, "sure"])

    return ranged.mapInArrow(compare, "around long, text long, first long, last long, core long, sure boolean")


def _starts(texts: DataFrame, contexts: DataFrame, length: int) -> DataFrame:
    """(around, behind, string): each string of a context, and how far in it starts."""
    by_text = contexts.groupBy("text").agg(F.collect_list(F.struct("first", "last", "around")).alias("found"))
    shape = pa.schema([(c, pa.int64()) for c in ("around", "behind", "string")])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, places, strings = [], [], []

        def rows() -> pa.RecordBatch:
            sizes = [len(p) for p in places]
            out = [pa.array(np.repeat(np.array(names, np.int64), sizes)), pa.array(np.concatenate(places)), _signed(strings)]
            names.clear(), places.clear(), strings.clear()
            return pa.RecordBatch.from_arrays(out, schema=shape)

        for batch in batches:
            for value, found in zip(batch.column(0), batch.column(1), strict=True):
                data = value.as_py()
                for first, last, around in zip(*(found.values.field(c).to_pylist() for c in ("first", "last", "around")), strict=True):
                    names.append(around)
                    places.append(np.arange(last - first + 1))
                    strings.extend([_digest(data[s : s + length]) for s in range(first, last + 1)])
                    if len(strings) > 20_000:
                        yield rows()
        if strings:
            yield rows()

    return texts.join(by_text, "text").select("data", "found").mapInArrow(make, "around long, behind long, string long")


_RESULT = pa.schema([("n_bytes", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())])


def _removed(docs: DataFrame, found: DataFrame, length: int) -> DataFrame:
    """Adds n_bytes, the removed spans and the kept bytes to every row with ``text`` and ``data``."""
    by_text = found.groupBy("text").agg(F.collect_list(F.struct("first", "last", "whole", "behind")).alias("found"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value, found in zip(batch.column(1), batch.column(2), strict=True):
                data = value.as_py()
                n = len(data)
                steps = np.zeros(n + 1, np.int64)
                if found.is_valid:
                    some = found.values
                    first, last = (some.field(c).to_numpy() for c in ("first", "last"))
                    whole = some.field("whole").to_numpy(zero_copy_only=False)
                    single = [first[k] + some.field("behind")[k].values.to_numpy() for k in np.flatnonzero(~whole).tolist()]
                    np.add.at(steps, np.concatenate([first[whole], *single]), 1)
                    np.add.at(steps, np.concatenate([last[whole], *single]) + length, -1)
                gone = np.concatenate(([False], np.cumsum(steps)[:n] > 0, [False]))
                edges = np.flatnonzero(gone[1:] != gone[:-1]).tolist()
                spans = list(zip(edges[::2], edges[1::2], strict=True))
                kept = [0, *(e for s in spans for e in s), n]
                rows.append({"n_bytes": n, "spans": [{"start": a, "end": b} for a, b in spans],
                             "kept": b"".join(data[a:b] for a, b in zip(kept[::2], kept[1::2], strict=True))})
            out = pa.RecordBatch.from_pylist(rows, schema=_RESULT)
            yield pa.RecordBatch.from_arrays([batch.column(0), *out.columns], ["key", *_RESULT.names])

    joined = docs.join(by_text, "text", "left").select("key", "data", "found")
    kind = docs.schema["key"].dataType.simpleString()
    return joined.mapInArrow(remove, f"key {kind}, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")


def _found(texts: DataFrame, cuts: Cuts) -> DataFrame:
    """(text, first, last, whole, behind): where in which text repeated strings start. Stored."""
    once = texts.groupBy("text").agg(F.first("data").alias("data"), F.count(F.lit(1)).alias("copies"))
    items = stored(_items(once, _shared(texts, cuts), cuts), "suffix_items")
    ranks = suffix_ranks(items.select("text", "place", "symbol", "size", F.lit(True).alias("more")), cuts.compared)

    # Equal surroundings are one context; one that occurs twice is repeated as a whole.
    one = F.min(F.struct("rank", "text", "first", "last", "core", "own", "prefixes")).alias("one")
    ranked = items.filter("around IS NOT NULL").drop("symbol", "size").join(ranks, ["text", "place"])
    contexts = stored(ranked.groupBy("around").agg(F.sum("copies").alias("n"), one).select("around", "n", "one.*"), "suffix_contexts")
    # Of suffixes that meet, those are looked at whose strings have the same bytes in common.
    alike = F.count(F.lit(1)).over(W.partitionBy("core"))
    meeting = _meeting(contexts).withColumn("alike", alike).filter("sure OR alike > 1")
    starts = _starts(once, meeting, cuts.length)
    same = W.partitionBy("string")
    twice = starts.withColumn("n", F.count(F.lit(1)).over(same)).filter("n > 1")
    behind = twice.groupBy("around").agg(F.collect_list("behind").alias("behind"))
    whole = contexts.filter("n > 1").select("around", F.lit(True).alias("whole"), F.lit(None).cast("array<long>").alias("behind"))
    single = behind.join(contexts.filter("n = 1").select("around"), "around").select("around", F.lit(False).alias("whole"), "behind")
    found = items.filter("around IS NOT NULL").select("around", "text", "first", "last").join(whole.union(single), "around")
    return stored(found.drop("around"), "suffix_found")


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """One row (key, n_bytes, spans, kept) for each document.

    Every byte of a text's UTF-8 form that lies in a string of ``length`` bytes which also starts
    anywhere else, in the same text or another, is removed; ``spans`` are the maximal stretches
    removed and ``kept`` the bytes left. Null texts are empty. Equal rows are separate documents,
    so their texts of ``length`` bytes or more go entirely. Keys may be null or repeated; an empty
    table gives an empty table. Columns other than key and text are not read, so none can clash.
    """
    data = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    rows = docs.select(F.col(key).alias("key"), data.alias("data")).withColumn("text", F.xxhash64("data"))
    with releasing_shuffles(docs.sparkSession):
        found = _found(rows.filter(F.length("data") >= length).select("text", "data"), Cuts(length))
    return _removed(rows, found, length).withColumnRenamed("key", key)


def query(spark: SparkSession, folder: str) -> DataFrame:
    """op11: all documents without their repeated strings, digests in place of bytes."""
    found = without_repeats(spark.read.parquet(f"{folder}/documents.parquet"))
    size = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_bytes", size.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
