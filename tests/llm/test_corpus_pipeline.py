"""The stages of the pipeline on hostile tables, each against a plain version of what it decides."""

import collections
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from carestitch.llm import tokens, units
from test_llm_operators import SCHEMA, _check_pieces, _components, _groups, _prose, _rows, _targets


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rows, r = _rows(2), random.Random(7)
    rows += [(100 + i, _prose(r, r.randint(30, 90)) + ".", "en", "b", 1, *rows[0][5:]) for i in range(500)]
    junk = [(1000 + i, " | ".join(_prose(r, 60).split()), "en", "a", 1, *rows[0][5:]) for i in range(160)]
    spark.createDataFrame(rows + junk, SCHEMA).write.parquet(f"{path}/documents.parquet")
    marks = [(r[0], 1) for r in rows if r[0] is not None and r[1]] + [(r[0], 0) for r in junk]
    spark.createDataFrame([*marks, (None, 1)], "doc_id long, quality int").withColumn("toxic", F.lit(0)).write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def _counted(df, *columns):
    return collections.Counter(tuple(r) for r in df.select(*columns).collect())


def test_stages_are_in_order():
    assert [name for name, _ in pipeline.STAGES] == ["quality", "near", "repeated", "mixture", "pack"]


def test_quality_keeps_whole_rows_and_drops_junk(spark, docs, folder):
    kept = pipeline.quality(spark, docs, folder)
    assert kept.columns == docs.columns and not _counted(kept, *docs.columns) - _counted(docs, *docs.columns)
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert not ids & set(range(1000, 1160)) and len(ids & set(range(100, 600))) >= 485


def test_one_document_of_each_group_stays(spark, docs, folder):
    """Also where rows of one id hold different texts: each text that isn't near another stays."""
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    kept = pipeline.near(spark, docs, folder)
    assert kept.columns == docs.columns
    got = collections.Counter((r.doc_id, r.text) for r in kept.collect())
    linked = _components(rows)
    alone = {x for x in rows if x[0] is not None} - {x for group in linked for x in group}
    assert sum(got[x] for x in got if x[0] is None) == sum(i is None for i, _ in rows)
    assert all(got[x] == 1 for x in alone)
    for group in linked:
        (one,) = [x for x in group if got[x]]
        assert got[one] == 1 and one[0] == min(group)[0]


def test_near_copies_from_a_similarity_of_0_8_on_go(spark, docs, folder):
    """Copies with one word changed every so often: similarities on both sides of 0.8 and of 0.85."""
    r, rows = random.Random(12), []
    for k in range(40):
        text = _prose(r, 200).split()
        rows.append((2 * k, " ".join(text)))
        for i, at in enumerate(range(10, 190, 180 // (1 + k % 8))):
            text[at] = f"w{k}x{i}"
        rows.append((2 * k + 1, " ".join(text)))
    expected = _groups(rows, 80)
    assert len(set(expected.values())) < len(set(_groups(rows, 85).values())) < len(rows)
    table = spark.createDataFrame([(i, t, "en", "a", len(t), *docs.first()[5:]) for i, t in rows], SCHEMA).repartition(3)
    assert sorted(x.doc_id for x in dict(pipeline.STAGES)["near"](spark, table, folder).collect()) == sorted(set(expected.values()))


def test_repeated_units_go_and_lengths_follow(spark, docs, folder):
    done = pipeline.repeated(spark, docs, folder)
    assert done.columns == docs.columns and done.count() == docs.count()
    rows = done.collect()
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in rows)
    seen = collections.Counter()
    for text in {(r.doc_id, r.text) for r in rows if r.text}:
        for a, b in units.split_units(text[1], "sentence"):
            if len(w := units.normalise(text[1][a:b])) >= 4:
                seen[tuple(w)] += 1
    assert max(seen.values()) == 1


def test_the_mixture_takes_documents_as_often_as_planned(spark, docs, folder):
    some = docs.where("n_chars < 100000")
    size = lambda t: len((t or "").encode().split())
    before, after = some.collect(), pipeline.mixture(spark, some, folder).collect()
    assert after and set(after) <= set(before) and pipeline.mixture(spark, some, folder).columns == docs.columns
    sizes, taken = collections.Counter(), collections.Counter()
    for r in before:
        sizes[r.source] += size(r.text)
    for r in after:
        taken[r.source] += size(r.text)
    assert all(abs(taken[s] - t) <= 1 for s, t in _targets(sizes).items())
    most = collections.Counter(before)
    assert all(n <= 2 * most[r] for r, n in collections.Counter(after).items())


def test_the_last_stage_packs_every_row(spark, docs, folder):
    _check_pieces(pipeline.pack(spark, docs, folder).collect(), [(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("name, stage", pipeline.STAGES)
def test_stages_of_an_empty_table(spark, docs, folder, name, stage):
    made = stage(spark, docs.limit(0), folder)
    assert made.collect() == [] and (name == "pack" or made.columns == docs.columns)


def test_the_whole_run(spark, folder):
    made = pipeline.run(spark, folder)
    assert made.count() > 0 and made.agg(F.max("length")).first()[0] <= 2048
    assert made.where("doc_id between 1000 and 1159").count() == 0
    assert len(tokens.with_end("a")) == 2
