"""Properties that matter on large and skewed data, checked on the plans Spark chose."""

import contextlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from carestitch.bridge.views import Bridge
from carestitch.operators.joins import align_to_person, align_to_visit, key_table
from carestitch.operators.percentiles import percentiles_of_counts, wanted_slices
from carestitch.sinks.parquet import export_tables, write_and_reload, write_staged


@contextlib.contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for key, value in names.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """Facts of which a third belong to one person and a third name no encounter."""
    folder = str(tmp_path_factory.mktemp("skew"))
    facts = spark.range(60000).select(
        F.col("id").alias("fact"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), (F.col("id") % 5000).cast("string"))).alias("s_person_id"),
        F.when(F.col("id") % 3 != 1, F.concat(F.lit("v"), F.col("id").cast("string"))).alias("s_encounter_id"),
        F.repeat(F.lit("x"), 50).alias("payload"))
    people = spark.range(5000).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("person_source_value"), F.col("id").alias("person_id"))
    hot = spark.createDataFrame([("hot", 9999), ("hot", 9998)], "person_source_value string, person_id bigint")
    facts = write_and_reload(facts, f"{folder}/facts")
    keys = write_and_reload(key_table(people.unionByName(hot), ["person_source_value"], "person_id"), f"{folder}/keys")
    visits = facts.filter("s_encounter_id is not null").select("s_encounter_id", "s_person_id", F.col("fact").alias("visit_occurrence_id"))
    return facts, keys, write_and_reload(visits, f"{folder}/visits")


SKEW = {
    "spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__shuffle__partitions": "20",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20KB",
}


def test_a_hot_person_is_split_over_tasks(spark, skewed):
    facts, keys, _ = skewed
    with settings(spark, **SKEW):
        aligned = align_to_person(facts, keys, unique=True)
        assert "SortMergeJoin(skew=true)" in plan_of(aligned)
        assert aligned.count() == 60000 and aligned.filter("person_id = 9998").count() == 20000


def test_rows_without_an_encounter_do_not_meet_in_one_task(spark, skewed, tmp_path):
    facts, _, visits = skewed
    with settings(spark, **SKEW, spark__sql__adaptive__coalescePartitions__enabled="false"):
        aligned = write_and_reload(align_to_visit(facts, visits, unique=True), f"{tmp_path}/aligned")
    assert aligned.count() == 60000 and aligned.filter("visit_occurrence_id is null").count() == 20000
    sizes = [r["count"] for r in aligned.groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) < 20000


def test_small_measured_sides_need_no_shuffle_of_the_facts(spark, skewed):
    facts, keys, _ = skewed
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = plan_of(align_to_person(facts, keys, unique=True, person_rows=keys.count()))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_what_is_sorted_of_a_dominant_group_is_bounded(spark, tmp_path):
    """Twenty million distinct values in one group, fifty in another; no task sorts more than ten thousand."""
    n, most = 20_000_000, 10_000
    value = F.pmod(F.col("id") * 48271, F.lit(n)).cast("double").alias("_v")
    big = spark.range(10, n).select(F.lit("big").alias("g"), value, F.lit(1).cast("bigint").alias("_n"))
    counted = write_and_reload(big.union(spark.range(50).select(F.lit("small"), F.col("id").cast("double"), F.lit(2).cast("bigint"))), f"{tmp_path}/counts")
    wanted = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    sizes = wanted_slices(counted, ["g"], wanted, most).groupBy("g", "_slice").count().collect()
    assert max(r["count"] for r in sizes) <= most and 2 <= len(sizes) <= 7
    found = {r.g: r for r in percentiles_of_counts(counted, ["g"], wanted, most).collect()}
    values = np.arange(10, n) * 48271 % n
    assert [found["big"][p] for p in wanted] == np.quantile(values, list(wanted.values())).tolist() and found["small"].p50 == 24.5


def test_scans_read_only_what_a_query_needs(spark):
    import __spark_entry__ as entry
    plan = plan_of(entry.queries()["stat_count_drugs"](spark, "/root/testdata/sf0.001"))
    assert "ReadSchema: struct<drug_exposure_id:bigint,person_id:bigint,visit_occurrence_id:bigint>" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_no_query_joins_without_keys(spark):
    import __spark_entry__ as entry
    for name in ("stat_count_gender", "stat_count_deaths", "payer_encounter_range_join", "fact_relationship",
                 "stat_measurement_concepts_count", "exact_percentiles"):
        df = entry.queries()[name](spark, "/root/testdata/sf0.001")
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_routes_read_the_partition_of_their_domain(spark):
    bridge = Bridge.of(spark, "/root/testdata/sf0.001")
    from carestitch.plans import builds as B
    plan = bridge.cdm.contribution(B.CONDITION, "measurement")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(" in plan and "mapped_domain_id" in plan.split("PartitionFilters: [")[1][:60]


def test_a_dominant_partition_value_is_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(40000).select(F.when(F.col("id") % 3 > 0, F.lit("big")).otherwise("small").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB"):
        paths = export_tables({"t": rows}, str(tmp_path), {"t": "k"})
    big = spark.read.parquet(paths["t"]).filter("k = 'big'").select(F.input_file_name()).distinct().count()
    assert big > 1


def test_a_staged_write_replaces_only_its_own_split(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "split string, v int").withColumn("mapped_domain_id", F.lit("Drug"))
    path = f"{tmp_path}/t"
    write_staged(rows, path, "split")
    back = write_staged(rows.filter("split = 'b'").withColumn("v", F.lit(3)), path, "split", partial=True)
    assert sorted((r.split, r.v) for r in back.collect()) == [("a", 1), ("b", 3)]


def test_a_staged_rerun_keeps_nothing_of_the_run_before(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "split string, v int").withColumn("mapped_domain_id", F.lit("Drug"))
    path = f"{tmp_path}/t"
    write_staged(rows, path, "split")
    assert [r.split for r in write_staged(rows.filter("split = 'b'"), path, "split").collect()] == ["b"]


def test_fields_of_few_codes_stay_broadcast_beside_millions_of_drug_codes(spark, tmp_path):
    """Each lookup goes by the size of its own field and reads its own partition."""
    from carestitch.operators.resolve import CodedField, resolve_fanout, resolve_fields
    from carestitch.operators.vocab import FieldBooks
    from carestitch.sinks.parquet import write_by_field
    many = spark.range(2_000_000).select(F.lit("t.s_drug").alias("field"), F.col("id").cast("string").alias("concept_code"))
    few = spark.range(90).select(F.element_at(F.array(*[F.lit(f"t.s_{f}") for f in ("type", "unit", "route")]), (F.col("id") % 3 + 1).cast("int")).alias("field"),
                                 F.concat(F.lit("c"), F.col("id").cast("string")).alias("concept_code"))
    codes = many.union(few).select("field", F.lit("o").alias("oid"), "concept_code", F.xxhash64("concept_code").alias("concept_id"))
    best = codes.withColumns({"mapped_concept_id": F.col("concept_id"), "mapped_domain_id": F.lit("Drug"), "standard_only_id": F.col("concept_id")})
    targets = best.drop("standard_only_id").withColumns({
        "vocabulary_id": F.lit("V"), "standard_concept": F.lit("S"), "domain_id": F.lit("Drug"), "mapped_vocabulary_id": F.lit("V"),
        "relationship_id": F.lit("Maps to"), "ordinal": F.lit(0)}).filter("field = 't.s_drug'")
    books = FieldBooks(write_by_field(best, f"{tmp_path}/codes"), write_by_field(targets, f"{tmp_path}/targets")).measured()
    assert books.best_bytes["t.s_drug"] > 100_000_000 > 10_000 > books.best_bytes["t.s_unit"]
    facts = spark.range(3000).select("id", *[c for n, f in enumerate(("type", "unit", "route")) for c in (
        F.concat(F.lit("c"), (F.col("id") % 2 * 3 + n).cast("string")).alias(f"s_{f}_code"), F.lit("o").alias(f"s_{f}_code_type_oid"))],
        F.col("id").cast("string").alias("s_drug_code"), F.lit("o").alias("s_drug_code_type_oid"))
    found = resolve_fields(facts, books.of_table("t"), [CodedField(f, (f"s_{f}",)) for f in ("type", "unit", "route")])
    found = resolve_fanout(found, books.of_table("t"), "s_drug")
    with settings(spark, spark__sql__adaptive__enabled="false"):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("BroadcastHashJoin") == 3 and plan.count("SortMergeJoin") + plan.count("ShuffledHashJoin") == 1
        assert plan.count("PartitionFilters: [isnotnull(field") == 4
    row = found.agg(F.count("*"), F.sum(((F.col("g_concept_id") != 0) & (F.col("unit") != 0)).cast("int"))).first()
    assert row[0] == row[1] == 3000


def test_distinct_rows_get_their_ids_in_one_exchange(spark):
    from carestitch.functions.keys import distinct_with_row_id
    rows = spark.range(1000).select((F.col("id") % 100).cast("string").alias("a"), F.lit("x").alias("b"))
    made = distinct_with_row_id(rows)
    assert plan_of(made).split("Initial Plan")[0].count("Exchange hashpartitioning") == 1
    assert made.count() == 100 == made.select("g_id").distinct().count()


def test_large_csv_files_are_split(spark, tmp_path):
    from carestitch.sources.tabular import read_csv
    with open(f"{tmp_path}/t.csv", "w") as out:
        out.write("a,b\n" + "".join(f"{i},some text of the row\n" for i in range(20000)))
    with settings(spark, spark__sql__files__maxPartitionBytes="64k", spark__sql__files__openCostInBytes="1"):
        assert read_csv(spark, f"{tmp_path}/t.csv", False).rdd.getNumPartitions() > 1
        assert read_csv(spark, f"{tmp_path}/t.csv", True).rdd.getNumPartitions() == 1


def test_a_statistic_of_many_rows_is_written_whole(spark, tmp_path):
    paths = export_tables({"top_locations": spark.range(250)}, str(tmp_path))
    assert spark.read.parquet(paths["top_locations"]).count() == 250


def test_documents_are_read_in_the_encoding_they_declare(spark, tmp_path):
    from carestitch.sources.ccda import parse_documents, read_documents, rejected_documents
    text = '<?xml version="1.0" encoding="{}"?><ClinicalDocument><title>caf\u00e9</title></ClinicalDocument>'
    for name in ("ISO-8859-1", "UTF-8"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.xml").write_bytes(text.format(name).encode(name))
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "b.xml").write_text("<ClinicalDocument><title>")
    (tmp_path / "broken" / "c.xml").write_text(" ")
    docs = read_documents(spark, str(tmp_path), "salt")
    assert docs.filter("xml like '%caf\u00e9%'").count() == 2
    found = {r.path.rpartition("/")[2]: r.reason for r in rejected_documents(parse_documents(docs)).collect()}
    assert found == {"b.xml": "not well-formed", "c.xml": "empty"}


def test_an_empty_partitioned_table_keeps_its_columns(spark, tmp_path):
    write_and_reload(spark.createDataFrame([], "a int, k string"), f"{tmp_path}/empty", "k")
    assert spark.read.parquet(f"{tmp_path}/empty").columns == ["a", "k"]
