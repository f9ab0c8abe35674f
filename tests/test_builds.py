"""What the builder declares: rules of the library on staging columns, and visits resolved once."""

from __future__ import annotations

from carestitch.functions.dates import end_or_start
from carestitch.functions.values import code_label, first_filled
from carestitch.operators.resolve import code_columns
from carestitch.plans import builds as B
from carestitch.plans.cdm import LINKS
from carestitch.specs import psf_spec


def test_rules_know_the_columns_they_read(spark):
    rule = B.Rule(code_label, B.Rule(first_filled, "a", "b"), "c")
    assert B.columns_read(rule) == {"a", "b", "c"} and B.columns_read("a") == {"a"}
    df = spark.createDataFrame([(None, "code", "text"), (None, None, None)], "a string, b string, c string")
    assert [r[0] for r in df.select(B.column_of(rule)).collect()] == ["code|text", "|"]
    dates = spark.createDataFrame([("2020-01-05", None), ("2020-01-05", "bad"), ("2020-01-05", "2020-02-01 10:00:00")], "a string, b string")
    assert [str(r[0]) for r in dates.select(B.column_of(B.Rule(end_or_start, "b", "a"))).collect()] == ["2020-01-05", "2020-01-05", "2020-02-01"]


def test_every_column_that_a_build_reads_exists():
    """A staging column, a key of the builder or the outcome of a lookup of the same build."""
    made = {"person_id", "visit_occurrence_id", "g_id", "g_concept_id", "g_source_concept_id", "g_person_id", "g_visit_id"}
    for build in (*B.DIMENSIONS, *B.FACTS):
        known = made | set(psf_spec(build.source).columns) | set(build.derived) | {surrogate for _, _, surrogate in LINKS.values()}
        known |= {name for f in build.codes for name in (f.concept, f.source, f.mapped_domain) if name}
        known |= {c for f in build.codes for p in f.candidates for c in code_columns(p)}
        for value in [*build.derived.values(), *[v for r in build.routes for v in r.columns.values()]]:
            assert B.columns_read(value) <= known, (build.source, B.columns_read(value) - known)
