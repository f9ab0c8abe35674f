"""Relationships between CDM rows through the index of the values that name staging rows."""

import re

import pytest
from pyspark.sql import functions as F

from carestitch.plans.relationships import Relationship, build_fact_relationship, key_index, unknown_links

FIELDS = 50
LINK = ("s_relationship string, s_relationship_code string, s_relationship_code_type_oid string, s_target_from_table_name string, "
        "s_target_from_table_field string, s_target_from_value string, s_target_to_table_name string, s_target_to_table_field string, s_target_to_value string")


@pytest.fixture(scope="module")
def tables(spark):
    rows = spark.range(200).withColumnRenamed("id", "g_id")
    named = {f"f{i}": F.concat(F.lit(f"{i}-"), F.col("g_id").cast("string")) for i in range(FIELDS)}
    source = {
        "source_payer": rows.withColumns(named),
        "source_encounter": rows.withColumns(named | {"f0": F.when(F.col("g_id") > 1, F.lit("same")).otherwise(F.lit(None))}),
    }
    made = lambda table, origin, first: rows.select((F.col("g_id") + first).alias(f"{table}_id"), F.lit(origin).alias("g_source_table_name"), F.col("g_id").alias("s_g_id"))
    cdm = {
        "payer_plan_period": made("payer_plan_period", "source_payer", 1000).filter("s_g_id < 100"),
        "visit_occurrence": made("visit_occurrence", "source_encounter", 5000),
        "observation": made("observation", "source_payer", 9000).union(made("observation", "source_note", 20000)),
    }
    concept = spark.createDataFrame(
        [(1, "Visit", "Domain", "Metadata", "v"), (2, "Observation", "Domain", "Metadata", "o"), (77, "covers", "Links", "Relationship", "c")],
        "concept_id int, concept_name string, vocabulary_id string, domain_id string, concept_code string")
    return source, cdm, concept, spark.createDataFrame([("1.2", "Links")], "oid string, vocabulary_id string")


def _link(name, i, a, j, b, code="c"):
    return (name, code, "1.2", "source_payer", f"f{i}", a, "source_encounter", f"f{j}", b)


def _joins(df):
    df._jdf.queryExecution().toRdd()
    return len(re.findall(r"\b(?:BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin)\b", df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]))


def test_every_shape_is_linked_through_one_join_for_each_end(spark, tables, tmp_path):
    source, cdm, concept, oids = tables
    wanted = [Relationship("a", "payer_plan_period", "visit_occurrence"), Relationship("b", "observation", "visit_occurrence")]
    links = [_link("a", i, f"{i}-{i}", 49 - i, f"{49 - i}-{i + 2}") for i in range(FIELDS)]
    links += [_link("b", 3, "3-150", 4, "4-7", "none"), _link("c", 1, "1-1", 1, "1-1"), _link("a", 1, "1-150", 1, "1-1"), _link("a", 1, None, 1, "1-1"),
              _link("a", 2, "2-5", 0, "same")]

    def build(rows, name):
        def keep(index):
            index.write.parquet(f"{tmp_path}/{name}")
            return spark.read.parquet(f"{tmp_path}/{name}")

        return build_fact_relationship(spark.createDataFrame(rows, LINK), wanted, source.__getitem__, cdm.__getitem__, concept, oids, keep)

    many, one = build(links, "many"), build(links[1:2], "one")
    expected = [(0, 1000 + i, 1, 5000 + i + 2, 77) for i in range(FIELDS - 1)] + [(2, 9150, 1, 5007, 0)]
    expected += [(0, 1005, 1, 5000 + i, 77) for i in range(2, 200)]
    assert sorted(tuple(r) for r in many.collect()) == sorted(expected)
    assert [tuple(r) for r in one.collect()] == [(0, 1001, 1, 5003, 77)]
    assert _joins(many) == _joins(one) <= 4  # each end, the codes, and their vocabulary


def test_the_index_reads_each_staging_table_once(spark, tables):
    source, cdm, *_ = tables
    links = spark.createDataFrame([_link("a", i, "x", i, "y") for i in range(FIELDS)], LINK)
    index = key_index(links, [Relationship("a", "payer_plan_period", "visit_occurrence")], source.__getitem__, cdm.__getitem__)
    assert index.groupBy("field").count().count() == FIELDS
    plan = index._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 200") == 4 and len(re.findall(r"\bJoin\b", plan)) == 1


def test_links_that_name_nothing_known(spark, tables):
    source, cdm, concept, oids = tables
    rows = [("a", "c", "1.2", "no_table", "f1", "1-1", "source_encounter", "f1", "1-1"), _link("a", 99, "x", 1, "y"),
            (None,) * 9, ("a", "c", "1.2", None, None, None, None, None, None)]
    links = spark.createDataFrame(rows, LINK)
    wanted = [Relationship("a", "payer_plan_period", "visit_occurrence")]
    made = build_fact_relationship(links, wanted, source.__getitem__, cdm.__getitem__, concept, oids)
    assert made.collect() == [] and made.columns == ["domain_concept_id_1", "fact_id_1", "domain_concept_id_2", "fact_id_2", "relationship_concept_id"]
    assert unknown_links(links, source.__getitem__).agg(F.sum("n_rows")).first()[0] == 4
