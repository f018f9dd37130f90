"""Runs of words against a scan of every period."""

import random
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest

from ridemart.llm import periodic_runs


def slow_runs(words, least=6, periods=4):
    """Maximal stretches of each period by direct comparison, smallest period of each stretch."""
    n, best = len(words), {}
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            end = i
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end - i + q >= max(least, periods * q):
                best.setdefault((i, end - i + q), q)
            i = end + 1
    return sorted((s, m, q) for (s, m), q in best.items())


def slow_row(doc_id, text):
    words = [w for w in (text or "").replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]
    n = len(words)
    h = crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = slow_runs(words)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    return (
        doc_id, len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
        sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
        sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest(),
    )


@pytest.mark.parametrize("seed", range(40))
def test_runs_of_small_alphabets(seed):
    rng = random.Random(seed)
    for _ in range(40):
        words = [rng.randrange(rng.choice((1, 2, 2, 3, 5))) for _ in range(rng.randrange(0, 60))]
        for _ in range(rng.randrange(3)):  # plant periodic stretches
            unit = [rng.randrange(3) for _ in range(rng.randrange(1, 7))]
            at = rng.randrange(len(words) + 1)
            words[at:at] = (unit * 9)[: rng.randrange(4, 9 * len(unit))]
        assert periodic_runs.runs_of(np.array(words, np.int64)) == slow_runs(words)


def test_other_limits():
    rng = random.Random(3)
    for _ in range(300):
        words = [rng.randrange(2) for _ in range(rng.randrange(40))]
        for least, periods in ((2, 2), (4, 2), (3, 3), (12, 4)):
            assert periodic_runs.runs_of(np.array(words, np.int64), least, periods) == slow_runs(words, least, periods)


def test_long_texts_take_steps_that_grow_with_them():
    rng = random.Random(5)
    one = np.zeros(60_000, np.int64)
    assert periodic_runs.runs_of(one) == [(0, 60_000, 1)]
    # The same passage under many different words to its left.
    passage = list(range(10, 40))
    words = np.array([w for k in range(2_000) for w in (1_000 + k, *passage)])
    assert periodic_runs.runs_of(words) == []
    unit = [rng.randrange(9) for _ in range(997)]
    words = np.array([-5, *unit * 40, -7])
    assert (1, 997 * 40, 997) in periodic_runs.runs_of(words)


def test_whole_table_with_awkward_rows(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randrange(80))) for _ in range(150)]
    rows = list(enumerate(texts)) + [(None, "a b " * 9), (3, texts[3]), (3, texts[3]), (900, None), (901, ""), (902, " \n\t "), (903, "é x " * 8)]
    docs = spark.createDataFrame([(i, t, 1, "s") for i, t in rows], "doc_id long, text string, n_runs int, runs string").repartition(5)
    found = periodic_runs.periodic_runs(docs, words_of=periodic_runs.planted)
    got = sorted(((r.doc_id, r.n_runs, r.start, r.length, r.period) for r in found.collect()), key=repr)
    assert got == sorted((slow_row(*r)[:5] for r in rows), key=repr)
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0
    plain = periodic_runs.periodic_runs(docs.filter("doc_id = 903")).first()
    assert (plain.start, plain.length, plain.period, plain.collapsed.decode()) == (0, 8, 1, "é x")


def test_registered_query(spark):
    data = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    got = {tuple(r) for r in periodic_runs.query(spark, data).collect()}
    assert got == {slow_row(r.doc_id, r.text) for r in rows}
    assert any(r[1] for r in got)
