import pytest
from pyspark.sql import functions as F

from carestitch.functions import add_row_id, distinct_with_row_id, fact_id, hl7_timestamp, stable_id
from carestitch.functions.keys import fanout_bits, staged_id, with_small_ids
from carestitch.operators.joins import BROADCAST_ROWS, lookup, payer_at_encounter, small
from carestitch.operators.percentiles import exact_percentiles
from carestitch.operators.project import align, exclude_rows, rename_columns, union_by_name
from carestitch.operators.resolve import CodedField, resolve_fanout, resolve_field, used_pairs
from carestitch.operators.route import in_domain
from carestitch.operators.vocab import build_codebook, build_concept_map
from carestitch.specs import TableSpec


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame([("1", "a", "x"), ("2", "b", "y")], "uid string, name string, description string")


def test_rename_follows_the_mapping_or_the_table(people):
    assert rename_columns(people, {"name": "full", "uid": "id"}).columns == ["full", "id"]
    assert rename_columns(people, {"name": "full"}, keep_others=True).columns == ["uid", "full", "description"]


def test_align_orders_types_and_fills(people):
    spec = TableSpec("t", {"name": "string", "uid": "int", "reference": "string"})
    aligned = align(people, spec)
    assert aligned.dtypes == [("name", "string"), ("uid", "int"), ("reference", "string")]
    assert aligned.filter("reference is null").count() == 2
    assert align(people, spec, keep_others=True).columns == ["name", "uid", "reference", "description"]


def test_unreadable_values_become_null(spark):
    spec = TableSpec("t", {"a": "int", "b": "date"})
    row = align(spark.createDataFrame([("x", "not a date")], "a string, b string"), spec).first()
    assert (row.a, row.b) == (None, None)


def test_exclusion(spark):
    flags = spark.createDataFrame([(None,), ("0",), ("1",)], "i_exclude string")
    assert [r.i_exclude for r in exclude_rows(flags).collect()] == [None, "0"]
    assert exclude_rows(flags.withColumnRenamed("i_exclude", "x")).count() == 3


def test_union_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1, 2)], "a int, b int"), spark.createDataFrame([(3,)], "b int")
    assert {tuple(r) for r in union_by_name([a, b], fill_missing=True).collect()} == {(1, 2), (None, 3)}


# -- code resolution --------------------------------------------------------------------


@pytest.fixture(scope="module")
def book(spark):
    oids = spark.createDataFrame([("o1", "V1")], "oid string, vocabulary_id string")
    concepts = spark.createDataFrame(
        [(10, "M1", "V1", "S", "Drug"), (11, "S1", "V1", None, "Drug"), (13, "N1", "V1", None, "Drug")],
        "concept_id int, concept_code string, vocabulary_id string, standard_concept string, domain_id string")
    mapped = spark.createDataFrame(
        [(10, "Maps to", 10, "Drug", "V1"), (11, "Maps to value", 30, "Measurement", "V1"), (11, "Maps to", 20, "Drug", "V1")],
        "source_concept_id int, relationship_id string, mapped_concept_id int, mapped_domain_id string, mapped_vocabulary_id string")
    return build_codebook(concepts, mapped, oids)


CASES = [
    ("r1", "M1", "S1", "o1", 10, 10), ("r2", None, "S1", "o1", 11, 20), ("r3", "bad", "S1", "o1", 11, 20),
    ("r4", None, None, "o1", 0, 0), ("r5", None, "N1", "o1", 13, 0), ("r6", "N1", "S1", "o1", 13, 0),
    ("r7", None, "S1", "o9", 0, 0),
]


@pytest.fixture(scope="module")
def coded(spark):
    return spark.createDataFrame(
        [(r, m, "o1", s, oid) for r, m, s, oid, *_ in CASES],
        "row string, m_x_code string, m_x_code_type_oid string, s_x_code string, s_x_code_type_oid string")


def test_two_level_resolution(book, coded):
    found = resolve_field(coded, book, CodedField("std", ("m_x", "s_x"), "src")).collect()
    assert {(r.row, r.src, r.std) for r in found} == {(r, src, std) for r, *_, src, std in CASES}


def test_a_concept_of_another_domain_becomes_zero(book, coded):
    field = CodedField("std", ("m_x", "s_x"), "src", domain="Gender", mapped_domain="domain")
    row = resolve_field(coded, book, field).filter("row = 'r1'").first()
    assert (row.src, row.std, row.domain) == (10, 0, "Drug")


def test_standard_only(book, coded):
    found = resolve_field(coded, book, CodedField("m", ("m_x",), standard_only=True))
    found = resolve_field(found, book, CodedField("s", ("s_x",), standard_only=True))
    row = found.filter("row = 'r1'").first()
    assert (row.m, row.s) == (10, 0)


def test_fanout_keeps_unknown_rows_and_all_targets(book, coded):
    found = resolve_fanout(coded, book, "s_x")
    assert sorted((r.g_concept_id, r.mapped_domain_id) for r in found.filter("row = 'r2'").collect()) == [
        (20, "Drug"), (30, "Measurement")]
    assert {(r.row, r.g_source_concept_id, r.g_concept_id) for r in found.collect() if r.row in ("r4", "r5", "r7")} == {
        ("r4", 0, 0), ("r5", 13, 0), ("r7", 0, 0)}
    assert resolve_fanout(coded, book, "s_x", how="inner").filter("row in ('r4', 'r7')").count() == 0


def test_a_pruned_codebook_resolves_the_same(book, coded):
    used = used_pairs(coded, ["m_x", "s_x"])
    pruned = book.restricted_to(used).measured()
    assert pruned.best.count() == 3 and 0 < pruned.best_bytes < 1000
    field = CodedField("std", ("m_x", "s_x"), "src")
    assert sorted(resolve_field(coded, pruned, field).collect()) == sorted(resolve_field(coded, book, field).collect())


def test_codebooks_of_fields_resolve_the_same(book, coded):
    used = used_pairs(coded, ["m_x", "s_x"], "t")
    books = book.by_field(used, ["t.m_x", "t.s_x"], ["t.s_x"]).measured()
    assert {(r.field, r.concept_code) for r in books.best.collect()} == {("t.m_x", "M1"), ("t.m_x", "N1"), ("t.s_x", "S1"), ("t.s_x", "N1")}
    assert set(books.target_bytes) == {"t.s_x"} and books.of_table("t").of_field("m_x").target_bytes == 0
    field = CodedField("std", ("m_x", "s_x"), "src")
    of_table = books.of_table("t")
    assert sorted(resolve_field(coded, of_table, field).collect()) == sorted(resolve_field(coded, book, field).collect())
    by = ["row", "g_ordinal"]
    assert resolve_fanout(coded, of_table, "s_x").sort(by).collect() == resolve_fanout(coded, book, "s_x").sort(by).collect()


def test_a_field_without_codes_and_an_empty_codebook_resolve_to_nothing(book, coded):
    books = book.by_field(used_pairs(coded.filter("false"), ["m_x", "s_x"], "t"), ["t.m_x", "t.s_x"], ["t.s_x"]).measured()
    assert books.best_bytes == {} and books.target_bytes == {}
    found = resolve_fanout(resolve_field(coded, books.of_table("t"), CodedField("std", ("m_x", "s_x"), "src")), books.of_table("t"), "s_x")
    assert {(r.src, r.std, r.g_concept_id) for r in found.collect()} == {(0, 0, 0)} and found.count() == len(CASES)


def test_ties_take_the_lowest_concept(spark):
    oids = spark.createDataFrame([("o", "V")], "oid string, vocabulary_id string")
    concepts = spark.createDataFrame(
        [(7, "A", "V", None, "Drug"), (5, "A", "V", None, "Drug"), (9, "A", "V", "S", "Drug")],
        "concept_id int, concept_code string, vocabulary_id string, standard_concept string, domain_id string")
    mapped = spark.createDataFrame([(5, "Maps to", 9, "Drug", "V"), (9, "Maps to", 9, "Drug", "V")],
        "source_concept_id int, relationship_id string, mapped_concept_id int, mapped_domain_id string, mapped_vocabulary_id string")
    book = build_codebook(concepts, mapped, oids)
    best = book.best.first()
    assert (best.concept_id, best.mapped_concept_id, best.standard_only_id) == (5, 9, 9)
    assert sorted((r.concept_id, r.mapped_concept_id, r.ordinal) for r in book.targets.collect()) == [
        (5, 9, 0), (7, None, 1), (9, 9, 2)]


def test_concept_map_needs_both_vocabularies(spark):
    concepts = spark.createDataFrame(
        [(1, "a", "D", "V", None, "A"), (2, "b", "D", "V", "S", "B"), (3, "c", "D", "W", "S", "C")],
        "concept_id int, concept_name string, domain_id string, vocabulary_id string, standard_concept string, concept_code string")
    links = spark.createDataFrame([(1, 2, "Maps to"), (1, 3, "Maps to"), (1, 2, "Is a"), (1, 2, "Maps to value")],
                                  "concept_id_1 int, concept_id_2 int, relationship_id string")
    versions = spark.createDataFrame([("V", "v1")], "vocabulary_id string, vocabulary_version string")
    found = build_concept_map(concepts, links, versions).collect()
    assert sorted((r.source_concept_code, r.relationship_id, r.mapped_concept_id, r.mapped_vocabulary_version) for r in found) == [
        ("A", "Maps to", 2, "v1"), ("A", "Maps to value", 2, "v1")]


def test_domain_routes(spark):
    rows = spark.createDataFrame([("Drug", "Drug"), ("Condition", "Drug"), (None, "Drug"), (None, "Condition"), (None, None)],
                                 "mapped_domain_id string, domain_id string")
    assert rows.filter(in_domain("Drug")).count() == 2
    assert rows.filter(in_domain("Drug", keep_unmapped=False)).count() == 1


# -- joins ------------------------------------------------------------------------------


def test_lookup_never_multiplies_facts(spark):
    facts = spark.createDataFrame([("a",), ("a",), ("z",), (None,)], "k string")
    dim = spark.createDataFrame([("a", 2), ("a", 1), (None, 9)], "key string, id int")
    found = lookup(facts, dim, {"k": "key"}, {"id": "dim_id"})
    assert sorted((r.k or "", r.dim_id or 0) for r in found.collect()) == [("", 0), ("a", 1), ("a", 1), ("z", 0)]


def test_only_measured_small_sides_are_broadcast(spark):
    df = spark.range(3)
    plan = lambda side: side._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan(small(df, 3))
    assert "broadcast" not in plan(small(df, None)) and "broadcast" not in plan(small(df, BROADCAST_ROWS + 1))


def test_payer_periods_include_both_edges_and_never_open_ends(spark):
    payers = spark.createDataFrame(
        [("p", "2019-12-30", "2021-01-02", "closed"), ("p", "2020-01-01", None, "open"), ("q", "2019-01-01", "2022-01-01", "other")],
        "s_person_id string, s_payer_start_datetime string, s_payer_end_datetime string, payer string")
    visits = spark.createDataFrame(
        [("v1", "p", "2019-12-01", "2019-12-30"), ("v2", "p", "2021-01-02", None), ("v3", "p", "2021-01-03", None),
         ("v4", "p", "2020-06-01", "2020-06-02"), ("v5", "p", None, None)],
        "s_encounter_id string, s_person_id string, s_visit_start_datetime string, s_visit_end_datetime string")
    found = payer_at_encounter(visits, payers).collect()
    assert sorted((r.s_encounter_id, r.payer) for r in found) == [("v1", "closed"), ("v2", "closed"), ("v4", "closed")]


# -- keys, dates, percentiles -------------------------------------------------------------


def test_row_ids_are_unique_and_repeatable(spark):
    rows = spark.range(5000).select(F.col("id"), (F.col("id") % 7).alias("k"), F.lit(None).cast("string").alias("n"))
    once = add_row_id(rows)
    again = add_row_id(rows.repartition(13))
    assert once.select("g_id").distinct().count() == 5000
    assert once.join(again, ["id", "g_id"]).count() == 5000
    assert distinct_with_row_id(rows.union(rows)).count() == 5000


def test_fact_ids_do_not_collide(spark):
    rows = spark.range(200).crossJoin(spark.range(3).withColumnRenamed("id", "nth"))
    ids = [rows.select(fact_id("id", F.col("nth"), c).alias("k")) for c in range(5)]
    assert union_by_name(ids).distinct().count() == 200 * 3 * 5
    wide = fanout_bits(5000)  # a code with 5,001 targets
    assert (fanout_bits(3), wide) == (10, 13)
    many = spark.range(3).crossJoin(spark.range(5001).withColumnRenamed("id", "nth")).select(fact_id("id", F.col("nth"), 1, wide).alias("k"))
    assert many.distinct().count() == 3 * 5001


def test_large_foreign_ids_are_renumbered_and_kept_for_lineage(spark):
    rows = spark.range(100).select((F.col("id") + (1 << 60)).alias("g_id"), F.col("id").cast("string").alias("s_id"))
    made = with_small_ids(rows)
    assert staged_id(rows) == "g_id" and staged_id(made) == "_staged_id"
    assert made.agg(F.max("g_id")).first()[0] < 1 << 50 and made.select("g_id").distinct().count() == 100
    assert made.where(F.col("_staged_id") - (1 << 60) == F.col("s_id").cast("long")).count() == 100
    assert with_small_ids(spark.range(5).withColumnRenamed("id", "g_id")).columns == ["g_id"]


def test_null_keeps_a_null_key(spark):
    row = spark.range(1).select(stable_id("s", F.lit(None).cast("string")).alias("a"), stable_id("s", F.lit("x")).alias("b")).first()
    assert row.a is None and row.b is not None


@pytest.mark.parametrize("text, expected", [
    ("20221024000000-0000", "2022-10-24 00:00:00"), ("20221024010000.000+0100", "2022-10-24 00:00:00"),
    ("20221024235959", "2022-10-24 23:59:59"), ("20221024", "2022-10-24 00:00:00"),
    ("202210", None), ("20221399", None), ("noise", None),
])
def test_hl7_dates(spark, text, expected):
    assert spark.range(1).select(hl7_timestamp(F.lit(text)).cast("string").alias("t")).first().t == expected


@pytest.mark.parametrize("most", [3, 1_000_000])
@pytest.mark.parametrize("shape", ["plain", "one value", "outlier", "few", "single"])
def test_percentiles_are_exact(spark, shape, most):
    import numpy as np
    values = {
        "plain": [float(i * 37 % 1009) for i in range(1009)], "one value": [4.0] * 500 + [9.0],
        "outlier": [float(i) for i in range(400)] + [1e30], "few": [3.0, 1.0], "single": [5.0],
    }[shape]
    df = spark.createDataFrame([("g", None, v) for v in values] + [("h", "u", 1.0), ("e", "u", None)],
                               "g string, u string, v double")
    cuts = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99}
    found = {r.g: r for r in exact_percentiles(df, ["g", "u"], "v", cuts, most).collect()}
    assert set(found) == {"g", "h"}
    for name, p in cuts.items():
        assert found["g"][name] == pytest.approx(float(np.quantile(values, p)), rel=1e-12)
    assert found["h"].p50 == 1.0
