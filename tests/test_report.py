"""The report's counts: one pass a table, nulls, empty tables, the same figures as the statistics one by one."""

from __future__ import annotations

import re

import pytest

from carestitch.plans import stats
from carestitch.specs.cdm import cdm_specs


@pytest.fixture
def visits(spark):
    return spark.createDataFrame(
        [(1, 10, "2020-01-01", 7), (2, 10, "2020-05-01", 7), (3, 11, None, None), (4, None, "2021-01-01", 7), (4, 11, "2021-01-02", 8)],
        "visit_occurrence_id long, person_id long, visit_start_date string, visit_concept_id int")


def test_counts_of_pairs(visits):
    pairs = [(None, "person_id"), (None, "visit_occurrence_id"), ("visit_concept_id", "person_id"), ("year(visit_start_date)", "person_id")]
    counts = stats.count_pairs(visits, pairs)
    assert counts.whole({"n": "person_id", "n_visits": "visit_occurrence_id"}).collect() == [(2, 4, 5)]
    assert sorted(counts.by("visit_concept_id", "c", {"n": "person_id"}).collect(), key=str) == [(7, 1, 3), (8, 1, 1), (None, 1, 1)]
    assert sorted(counts.by("year(visit_start_date)", "y", {"n": "person_id"}).collect(), key=str) == [(2020, 1, 2), (2021, 1, 2), (None, 1, 1)]


def test_a_column_may_be_group_and_key(visits):
    counts = stats.count_pairs(visits, [("visit_concept_id", "visit_concept_id"), (None, "visit_concept_id")])
    assert counts.whole({"n": "visit_concept_id"}).collect() == [(2, 5)]
    assert sorted(counts.by("visit_concept_id", "c", {"n": "visit_concept_id"}).collect(), key=str) == [(7, 1, 3), (8, 1, 1), (None, 0, 1)]


def test_counts_of_an_empty_table(visits):
    counts = stats.count_pairs(visits.filter("false"), [(None, "person_id"), ("visit_concept_id", "person_id")])
    assert counts.whole({"n": "person_id"}).collect() == [(0, 0)]
    assert counts.by("visit_concept_id", "c", {"n": "person_id"}).collect() == []


def test_one_scan_of_a_table_whatever_the_number_of_keys(spark, visits, tmp_path):
    visits.write.parquet(str(tmp_path / "visits"))
    counts = stats.count_pairs(spark.read.parquet(str(tmp_path / "visits")), [
        (None, "person_id"), (None, "visit_occurrence_id"), ("visit_concept_id", "person_id"), ("year(visit_start_date)", "visit_occurrence_id")])
    plan = counts.whole({"n": "person_id", "n_visits": "visit_occurrence_id"})._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet", plan)) == 1


def test_a_report_reads_each_table_once_and_agrees_with_its_statistics(spark, visits):
    concept = spark.createDataFrame([], "concept_id int, concept_name string, concept_code string, vocabulary_id string, concept_class_id string")
    frames = {"concept": concept, "visit_occurrence": visits.selectExpr("*", "to_date(visit_start_date) as visit_end_date")}

    specs, opened = cdm_specs(), []

    def table(name):
        opened.append(name)
        return frames[name] if name in frames else specs[name].empty(spark)

    report = stats.report(table, extended=True)
    facts = [name for name in set(opened) if opened.count(name) > 1]
    assert sorted(facts) == ["concept", "drug_exposure", "location", "measurement"]
    assert opened.count("drug_exposure") == opened.count("measurement") == 2
    assert report["count_visits"].drop("n / p_n").collect() == stats.statistic("count_visits", table).collect() == [(2, 4, 5, 0)]
    for name in ("yearly_visit_counts", "count_conditions", "count_people"):
        assert report[name].drop("n / p_n").collect() == stats.statistic(name, table).drop("n / p_n").collect()
