import collections
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ridemart.llm import quality_rules as quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DATA = "/root/testdata/sf0.01"


def slow_statistics(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(3)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), repeated, len(covered)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab#é \n\t\r\x1c\x85\xa0|", max_size=80))
def test_statistics_match_brute_force(text):
    assert quality.statistics_of(text.encode())[:5] == slow_statistics(text)


def test_statistics_of_long_texts():
    rng = np.random.default_rng(0)
    text = " ".join(f"w{i}" for i in rng.integers(0, 30, 3000)) + "\n" + "line of words\n" * 3
    assert quality.statistics_of(text.encode())[:5] == slow_statistics(text)
    words = [b"%d" % (i % 700_000) for i in range(1_400_000)]
    assert quality.repeated_words(words) == 1_400_000  # beyond what three codes of 21 bits hold
    assert quality.repeated_words([b"%d" % i for i in range(1_100_000)] + [b"0"]) == 0


def test_trees_obey_their_constraints():
    rng = np.random.default_rng(1)
    x = rng.random((1500, 3))
    good = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5) ^ (rng.random(1500) < 0.1)).astype(float)
    for signs in ([0, 0, 0], [-1, 1, 0], [1, -1, -1]):
        trees = quality.fit(x, good, signs, rounds=30)
        for feature, sign in enumerate(signs):
            at = np.repeat(rng.random((60, 3)), 40, axis=0)
            at[:, feature] = np.tile(np.linspace(-0.1, 1.1, 40), 60)
            change = np.diff(trees.raw(at).reshape(60, 40), axis=1)
            if sign:
                assert (sign * change >= -1e-12).all()
        if signs == [0, 0, 0]:
            assert ((trees.probability(x) > 0.5) == good).mean() > 0.85


def test_flat_nodes_equal_a_walk():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 4))
    trees = quality.fit(x, (x[:, 0] * x[:, 1] > 0).astype(float), [0] * 4, rounds=7)
    for row in x[:50]:
        total = trees.start
        for root in trees.roots:
            at = root
            while trees.left[at] != at:
                at = trees.left[at] if row[trees.feature[at]] <= trees.limit[at] else trees.right[at]
            total += trees.value[at]
        assert trees.raw(row[None])[0] == pytest.approx(total)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = quality.fitted(docs, labels.filter("doc_id % 4 <> 0"))
    held = labels.filter("doc_id % 4 = 0").join(quality.judged(docs, model), "doc_id").filter("NOT base_failed")
    rows = held.select("quality", "kept").collect()
    right = [r.kept == bool(r.quality) for r in rows]
    good = [r.kept for r in rows if r.quality]
    assert len(rows) > 500 and np.mean(right) > 0.97 and np.mean(good) > 0.99


def test_registered_query_and_awkward_rows(spark):
    for r in quality.query(spark, DATA).limit(300).collect():
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    words = " ".join(f"Word{i}." for i in range(200))
    rows = [(1, words), (1, words), (None, None), (2, ""), (3, "a " * 100), (4, words * 500)]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, kept int, statistics int")
    judged = quality.judged(docs, None)
    got = sorted(((r.doc_id or 0, *[r.statistics[n] for n in quality.STATISTICS[:5]], r.base_failed, r.kept) for r in judged.collect()))
    want = sorted((i or 0, *slow_statistics(t), b := not (s := slow_statistics(t))[0] >= 50 or s[4] * 2 > s[0], not b) for i, t in rows)
    assert got == want and quality.judged(docs.limit(0), None).count() == 0


def test_sample_is_bounded_and_labels_may_be_poor(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "repeat(concat('w', id, ' '), 60) AS text", "1 AS quality")
    labels = spark.range(3000).selectExpr("id AS doc_id", "int(id % 2) AS quality").union(spark.createDataFrame([(None, 1), (5, None), (5, 7)], "doc_id long, quality int"))
    rows = quality.labelled(docs.union(docs), labels, 500)
    assert 400 < rows.count() <= 500 and rows.select("doc_id").distinct().count() == rows.count()
    assert sorted(rows.collect()) == sorted(quality.labelled(docs.repartition(3), labels, 500).collect())
    assert quality.fitted(docs, labels.limit(0)) is None and quality.fitted(docs, labels.filter("quality = 1")) is None
