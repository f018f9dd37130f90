"""Quality rules: fixed base rules, then gradient-boosted trees over document statistics.

Statistics are taken from whole texts, inside the tasks, in one pass. A document that fails the
base rules is out; of the others the trees decide. They are fitted here, on at most ``FIT_ROWS``
labelled documents (chosen by a hash of the id), with monotone constraints: more symbols, more
repeated lines or words, more capitals and more exclamation marks never raise a score. The
fitted trees are flattened into node arrays, so a batch of documents is scored by a few numpy
steps per tree level.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import count
from typing import TYPE_CHECKING

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

if TYPE_CHECKING:
    import numpy as np

#: Labelled documents the trees are fitted on, at most.
FIT_ROWS = 20_000
#: Fewer labelled documents, or one class only, give no model: base rules alone decide.
LEAST_ROWS = 40
ROUNDS, DEPTH, RATE, BINS, SHRINK, LEAF_ROWS = 80, 3, 0.15, 64, 1.0, 10
#: A document is kept at this probability of good quality or more.
THRESHOLD = 0.5
#: Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS, MOST_REPEATED = 50, 50

_SPACE = b" \t\n\v\f\r"
_CONTINUED = bytes(range(0x80, 0xC0))
_CAPITALS, _DIGITS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"

STATISTICS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_distinct_words", "n_capitals", "n_digits", "n_exclamations",
)


# ---- statistics ------------------------------------------------------------------------


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words found twice or more, first occurrence included."""
    import numpy as np

    n = len(words)
    if n < 4:
        return 0
    first: dict[bytes, int] = {}
    codes = np.fromiter(map(first.setdefault, words, count()), np.int64, n)
    if len(first) == n:
        return 0
    pairs, base = codes[:-2] * n + codes[1:-1], n
    if n >= 1 << 20:  # three codes of a text this long would not fit into 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    windows = pairs * base + codes[2:]
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    found = np.isin(windows, twice)
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= found
    return int(covered.sum())


def statistics_of(text: bytes | None) -> tuple[int, ...]:
    """The values of ``STATISTICS`` for a UTF-8 text; null counts as empty."""
    text = text or b""
    words = text.split()  # bytes split at the six ASCII space characters
    lines = [line for line in text.split(b"\n") if line.strip()]
    without = lambda characters: len(text.translate(None, characters))
    size = len(text)
    return (
        len(words), without(_SPACE + _CONTINUED), size - without(SYMBOLS), len(lines) - len(set(lines)), repeated_words(words),
        len(lines), len(set(words)), size - without(_CAPITALS), size - without(_DIGITS), text.count(b"!"),
    )


#: Features with the sign of their constraint: -1 never raises the score as it grows.
FEATURES = {
    "words": 0, "word_length": 0, "symbols": -1, "repeated_lines": -1, "repeated_words": -1,
    "distinct_words": 0, "capitals": -1, "digits": 0, "exclamations": -1,
}


def features_of(statistics: np.ndarray) -> np.ndarray:
    """Feature matrix (rows, FEATURES) of a matrix of statistics."""
    import numpy as np

    words, chars, symbols, repeated_lines, repeated, lines, distinct, capitals, digits, exclamations = statistics.astype(float).T
    per_word, per_char, per_line = (1 / np.maximum(x, 1) for x in (words, chars, lines))
    return np.column_stack(
        [np.log1p(words), chars * per_word, symbols * per_char, repeated_lines * per_line, repeated * per_word,
         distinct * per_word, capitals * per_char, digits * per_char, exclamations * per_word]
    )


# ---- trees -----------------------------------------------------------------------------


@dataclass
class Trees:
    """All nodes of all trees in five arrays; a leaf points to itself."""

    feature: np.ndarray
    limit: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def raw(self, features: np.ndarray) -> np.ndarray:
        """Log odds of good quality."""
        import numpy as np

        rows = np.arange(len(features))
        total = np.full(len(features), self.start)
        for root in self.roots:
            at = np.full(len(features), root)
            for _ in range(self.depth):
                goes_left = features[rows, self.feature[at]] <= self.limit[at]
                at = np.where(goes_left, self.left[at], self.right[at])
            total += self.value[at]
        return total

    def probability(self, features: np.ndarray) -> np.ndarray:
        import numpy as np

        return 1 / (1 + np.exp(-np.clip(self.raw(features), -40, 40)))


def fit(
    features: np.ndarray,
    good: np.ndarray,
    signs: list[int] | None = None,
    rounds: int = ROUNDS,
    depth: int = DEPTH,
    rate: float = RATE,
    bins: int = BINS,
) -> Trees:
    """Newton boosting of the logistic loss over binned features.

    A split on a feature with sign s is taken only if the values of its sides are ordered by s,
    and its sides' subtrees are held on their side of the middle value, so the sum of trees is
    monotone in the feature. No randomness: equal input gives equal trees.
    """
    import numpy as np

    signs = list(FEATURES.values()) if signs is None else signs
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in features.T]
    binned = [np.searchsorted(c, column, side="left") for c, column in zip(cuts, features.T, strict=True)]
    nodes: list[list[float]] = []  # feature, limit, left, right, value
    share = np.clip(good.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    raw = np.full(len(good), start)
    roots = []

    def grow(rows, low, high, level, gradient, hessian) -> int:
        at = len(nodes)
        g, h = gradient[rows].sum(), hessian[rows].sum()
        value = float(np.clip(-g / (h + SHRINK), low, high))
        nodes.append([0, 0.0, at, at, rate * value])
        best = (1e-9, None)
        for f, column in enumerate(binned if level < depth and len(rows) >= 2 * LEAF_ROWS else []):
            if not len(cuts[f]):
                continue
            mine, size = column[rows], len(cuts[f]) + 1
            gs, hs, ns = (np.cumsum(np.bincount(mine, w, size))[:-1] for w in (gradient[rows], hessian[rows], None))
            left = np.clip(-gs / (hs + SHRINK), low, high)
            right = np.clip(-(g - gs) / (h - hs + SHRINK), low, high)
            # Loss saved by the clipped values, against one leaf.
            saved = lambda v, a, b: -(a * v + 0.5 * (b + SHRINK) * v * v)
            gain = saved(left, gs, hs) + saved(right, g - gs, h - hs) - saved(value, g, h)
            allowed = (ns >= LEAF_ROWS) & (len(rows) - ns >= LEAF_ROWS)
            if signs[f]:
                allowed &= signs[f] * (right - left) >= 0
            gain = np.where(allowed, gain, -np.inf)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], (f, k, left[k], right[k]))
        if best[1]:
            f, k, left, right = best[1]
            middle = (left + right) / 2
            bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle)), 0: ((low, high), (low, high))}[signs[f]]
            side = binned[f][rows] <= k
            nodes[at][0], nodes[at][1] = f, float(cuts[f][k])
            nodes[at][2] = grow(rows[side], *bounds[0], level + 1, gradient, hessian)
            nodes[at][3] = grow(rows[~side], *bounds[1], level + 1, gradient, hessian)
        return at

    def flat(first: int) -> Trees:
        table = np.array(nodes[first:]).reshape(-1, 5)
        feature, left, right = (table[:, c].astype(np.int64) for c in (0, 2, 3))
        return Trees(feature, table[:, 1], left - first, right - first, table[:, 4], np.array([0]), depth, 0.0)

    for _ in range(rounds):
        chance = 1 / (1 + np.exp(-raw))
        first = len(nodes)
        roots.append(grow(np.arange(len(good)), -np.inf, np.inf, 0, chance - good, chance * (1 - chance)))
        raw += flat(first).raw(features)
    whole = flat(0)
    whole.roots, whole.start = np.array(roots), start
    return whole


# ---- whole tables ----------------------------------------------------------------------


def measured(text: str | Column, model: Trees | None = None) -> Column:
    """Struct of the statistics of a text, and with a model its ``probability``."""
    names = [T.StructField(n, T.LongType()) for n in STATISTICS]
    if model is not None:
        names.append(T.StructField("probability", T.DoubleType()))

    @F.arrow_udf(T.StructType(names))
    def run(texts: pa.Array) -> pa.Array:
        import numpy as np

        rows = np.array([statistics_of(t.as_py()) for t in texts], np.int64).reshape(-1, len(STATISTICS))
        columns = [pa.array(c) for c in rows.T]
        if model is not None:
            columns.append(pa.array(model.probability(features_of(rows))))
        return pa.StructArray.from_arrays(columns, names=[n.name for n in names])

    column = F.col(text) if isinstance(text, str) else text
    return run(column.cast("binary"))


def labelled(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Statistics and label of at most ``fit_rows`` labelled documents, one row for each id.

    Ids with a label are thinned by a hash to about ``fit_rows``; the hash orders the rest, of
    which the first ``fit_rows`` stay. Labels other than 0 and 1 and null ids are left out; of an
    id's labels the lowest counts, of its texts one.
    """
    known = labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    n = known.count()
    hashed = known.withColumn("_place", F.shiftrightunsigned(F.xxhash64("doc_id"), 33))
    if n > fit_rows:
        hashed = hashed.filter(F.col("_place") < int(2**31 * min(1.0, 1.05 * fit_rows / n)))
    chosen = hashed.orderBy("_place", "doc_id").limit(fit_rows).drop("_place")
    marked = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # fit_rows rows at most
    return (
        marked.select("doc_id", "quality", measured("text").alias("s"))
        .groupBy("doc_id", "quality")
        .agg(F.min("s").alias("s"))
        .select("doc_id", "quality", "s.*")
    )


def fitted(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Trees | None:
    """Trees fitted on the labelled documents; None if they are too few or all alike."""
    import numpy as np

    rows = labelled(docs, labels, fit_rows).toPandas().sort_values("doc_id")  # at most fit_rows rows of numbers
    good = rows["quality"].to_numpy(float)
    if len(rows) < LEAST_ROWS or len(np.unique(good)) < 2:
        return None
    return fit(features_of(rows[list(STATISTICS)].to_numpy()), good)


def judged(docs: DataFrame, model: Trees | None, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """Adds ``statistics``, ``probability``, ``base_failed`` and ``kept`` to every row.

    A null text is empty and so fails the base rules. Without a model probability is null and the
    base rules decide alone. Equal rows are judged alike; an empty table gives an empty table.
    Columns of ``docs`` that bear one of the four names are replaced.
    """
    out = docs.drop("statistics", "probability", "base_failed", "kept").withColumn("statistics", measured(text, model))
    s = F.col("statistics")
    failed = (s["n_words"] < LEAST_WORDS) | (s["n_repeat_words"] * 100 > s["n_words"] * MOST_REPEATED)
    probability = s["probability"] if model is not None else F.lit(None).cast("double")
    verdict = F.coalesce(probability >= threshold, F.lit(True))
    return out.withColumns({"probability": probability, "base_failed": failed, "kept": ~failed & verdict})


def query(spark: SparkSession, folder: str) -> DataFrame:
    """op5: the statistics and the verdict of every document."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    done = judged(docs.select("doc_id", "text"), fitted(docs, labels))
    base = [F.col("statistics")[n].alias(n) for n in STATISTICS[:5]]
    return done.select("doc_id", *base, "base_failed", "kept", "probability")
