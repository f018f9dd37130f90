import random
import re

import pytest

from ridemart.llm import licenses


def words_of(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def shingles(words):
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)]


def slow(rows, templates, contained=0.8):
    """(doc_id, license) -> (containment, start, windows) by testing every window against every template."""
    out = {}
    for doc, text in rows:
        mine = shingles(words_of(text))
        for name, wording in templates:
            parts = set(shingles(words_of(wording)))
            if not parts:
                continue
            step = 1
            while 2 * step < len(parts):
                step *= 2
            for start in range(0, len(mine), step):
                share = len(parts & set(mine[start : start + 3 * step])) / len(parts)
                if share >= contained:
                    less, first, n = out.get((doc, name), (0, 0, 0))
                    best = min((less, first), (-share, start)) if n else (-share, start)
                    out[(doc, name)] = (*best, n + 1)
    return {k: (-less, start, n) for k, (less, start, n) in out.items()}


def found(df, templates=licenses.TEMPLATES, **more):
    return {(r.doc_id, r.license): (r.containment, r.start, r.windows) for r in licenses.scan(df, templates, **more).collect()}


@pytest.fixture
def rows():
    rng = random.Random(8)
    noise = lambda n: " ".join(f"w{rng.randrange(900)}" for _ in range(n))
    out = []
    for i in range(60):
        name, wording = licenses.TEMPLATES[i % len(licenses.TEMPLATES)]
        words = wording.split()
        for _ in range(i // 20):  # change one or two words
            words[rng.randrange(len(words))] = "changed"
        out.append((i, f"{noise(rng.randrange(80))}\n{' '.join(words).upper() if i % 7 == 0 else ' '.join(words)}, {noise(rng.randrange(80))}"))
    everything = "\n".join(t for _, t in licenses.TEMPLATES)
    out += [(100, everything), (100, noise(50)), (101, noise(8_000) + everything), (102, None), (103, ""), (104, "Released under the"), (None, everything)]
    out += [(105, "Released under the MIT License. " * 40), (105, "Released under the MIT License. " * 40)][:1]
    return out


def test_matches_brute_force(spark, rows):
    df = spark.createDataFrame([(i, t, "x", 3) for i, t in rows], "doc_id long, text string, license string, start int")
    assert found(df) == slow(rows, licenses.TEMPLATES)


def test_several_passes_and_odd_templates(spark, rows, monkeypatch):
    monkeypatch.setattr(licenses, "PASS_WORDS", 12)
    templates = [*licenses.TEMPLATES[:3], ("short", "four words are void"), ("empty", ""), ("MIT again", "released under the mit license")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df, templates) == slow(rows, templates)


def test_nothing_to_find(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df.limit(0)) == {} and found(df, [("empty", "")]) == {}
    assert found(df.filter("doc_id IN (102, 103, 104)")) == {}


def test_collision_is_all_but_certain():
    assert (1 - licenses.LEAST_JACCARD) ** licenses.BANDS < 2e-8


def test_no_python_in_the_plan(spark):
    plan = licenses.query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan


def test_templates_of_fewer_than_five_words(spark):
    templates = [("all", "All rights reserved."), ("tag", "SPDX-License-Identifier: MIT"), ("word", "Unlicense"), ("MIT", "Released under the MIT License.")]
    texts = ["(c) 2020. ALL RIGHTS\nRESERVED", "all rights are reserved", "# spdx-license-identifier: mit\n" * 3, "one two unlicense", "rights reserved all"]
    rows = [*enumerate(texts), (10, "x " * 90 + "All rights reserved. Released under the MIT license."), (11, "all rights"), (12, None)]
    want = {}
    for doc, text in rows:
        words = words_of(text)
        for name, wording in templates:
            part = words_of(wording)
            at = [i for i in range(len(words) - len(part) + 1) if words[i : i + len(part)] == part]
            starts = sorted({s for i in at for s in range(max(i - 2, 0), i + 1)})
            if starts:
                want[(doc, name)] = (1.0, starts[0], len(starts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {k[1] for k in want} == {n for n, _ in templates} and found(df, templates) == want
    assert {(0, "All-rights-reserved"), (10, "All-rights-reserved")} <= {(r.doc_id, r.license) for r in licenses.scan(df).collect()}
