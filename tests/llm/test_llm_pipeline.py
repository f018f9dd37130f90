"""The stages against brute force, on a small table with awkward rows."""

import collections
import random

import pytest
from pyspark.sql import functions as F
from test_llm_quality_rules import slow_statistics
from test_llm_simhash import slow_components, slow_fingerprint

import corpus_pipeline as pipeline
from ridemart.llm import packing, quality_rules

DATA = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)

    def text(n):
        return " ".join(f"w{rng.randrange(3000)}" for _ in range(n))

    made = [(i, text(60 + i % 50), "en", f"s{i % 3}", i) for i in range(80)]
    base = made[3][1].split()
    made += [(200 + i, " ".join(base), "en", "s1", 1) for i in range(30)]
    made += [(300, text(70), None, None, None), (300, text(70), "fr", "s2", 1), (None, text(80), "en", "s0", 2), (None, text(80), "en", "s0", 2)]
    same = (301, text(90), "en", "s2", 4)
    made += [same, same, same, (302, None, "en", "s0", 1), (303, "", None, "s1", 0), (304, "few words", "en", "s1", 0)]
    made += [(305, "again and again " * 60, "en", "s1", 0), (306, text(900), "en", "s2", 5)]
    return made


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, COLUMNS).repartition(4)


def rows_of(df):
    assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    return collections.Counter(tuple(r) for r in df.collect())


def test_quality_keeps_what_the_rules_keep(spark, docs, rows):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    model = quality_rules.fitted(docs, labels)
    kept = rows_of(pipeline.quality(spark, docs, DATA))
    passed = collections.Counter(r for r in rows if (s := slow_statistics(r[1]))[0] >= 50 and s[4] * 2 <= s[0])
    assert not kept - passed and (model is not None or kept == passed)


def test_one_document_of_each_group_stays(spark, docs, rows):
    kept = rows_of(pipeline.near_copies(spark, docs, DATA))
    prints = [slow_fingerprint(r[1]) for r in rows]
    names = slow_components(list(zip(range(len(rows)), prints)))
    groups = collections.defaultdict(list)
    for r, name in zip(rows, names):
        groups[name].append(r)
    assert sum(kept.values()) == len(groups)
    for group in groups.values():
        first = min((r[0] for r in group if r[0] is not None), default=None)
        assert sum(kept[r] for r in set(group) if r[0] == first) == 1


def test_rows_are_repeated_as_the_mix_says(spark, docs, rows):
    mixed = rows_of(pipeline.mixed(spark, docs, DATA))
    given = collections.Counter(rows)
    assert set(mixed) <= set(given) and all(n <= 3 * given[r] for r, n in mixed.items())
    words = lambda rows: sum(len((r[1] or "").split()) * n for r, n in rows.items())
    assert words(mixed) == pytest.approx(words(given), rel=0.05)


def test_run_applies_all_stages(spark):
    packed = pipeline.run(spark, DATA).collect()
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for _, stage in pipeline.STAGES[:3]:
        docs = spark.createDataFrame(stage(spark, docs, DATA).collect(), docs.schema)
    want = collections.Counter(r.doc_id for r in docs.collect() for _ in range(-(-len(r.text.split()) // packing.MAX_TOKENS)))
    assert collections.Counter(r.doc_id for r in packed) == want
    assert [name for name, _ in pipeline.STAGES] == ["quality", "near_copies", "mix", "packing"]


def test_empty_table(spark, docs):
    for name, stage in pipeline.STAGES:
        assert stage(spark, docs.limit(0), DATA).count() == 0, name


def test_columns_of_any_name_and_type_are_kept(spark, docs):
    more = docs.withColumns(
        {
            "_row": F.concat(F.lit("r"), F.col("n_chars")), "_copies": F.col("n_chars") * 2, "_copy": F.lit("c"), "kept": F.lit("k"),
            "statistics": F.col("n_chars") + 1, "whole_row": F.lit(1), "rows": F.lit(2), "component_id": F.lit(3), "size": F.lit(4),
            "a.b": F.lit(5), "tags": F.create_map(F.lit("n"), F.col("n_chars")), "doc_id": F.col("doc_id").cast("string"),
        }
    )
    for name, stage in pipeline.STAGES[:3]:
        out = stage(spark, more, DATA)
        assert out.columns == more.columns, name
        for r in out.collect():
            assert r["_row"] == (None if r.n_chars is None else f"r{r.n_chars}") and r["tags"] == {"n": r.n_chars}
            assert (r["_copy"], r["kept"], r["whole_row"], r["rows"], r["component_id"], r["size"], r["a.b"]) == ("c", "k", 1, 2, 3, 4, 5)
            assert r["_copies"] == (None if r.n_chars is None else r.n_chars * 2)
