"""Checks of readers, writers and published tables. Files go below the shared folder."""

from __future__ import annotations

import datetime
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.conform import conform_to_ddl
from ..operators.project import union_by_name
from ..plans.cdm_source import build_cdm_source, latest_measurement, replacement_cdm_source
from ..sinks.parquet import (
    drop_folder, export_tables, read_manifest, table_path, write_and_reload, write_by_domain, write_manifest, write_staged,
)
from ..sinks.publish import publish_tables
from ..sinks.registry import Registry, stage_increment
from ..sources.parquet import attach_catalog, load_tables
from ..sources.tabular import StagingConfig, json_dict_table, read_lookup, read_tables, rejected_rows, stage_tables
from ..sources.vocabulary import build_vocabulary, load_vocabulary, sample_concepts
from .oracle import ORACLE_VIEWS
from ..specs import STAGED_TABLES
from .registry import check, portable
from .views import VIEWS, Bridge


@check("csv_roundtrip", "select cast(doc_id as varchar) as doc_id, text, lang from {documents}")
def _(b: Bridge):
    """Texts with quotes, commas and line breaks survive a CSV file."""
    path = f"{b.folder}/csv_roundtrip/"
    b("documents").select(F.col("doc_id").alias("DOC_ID"), F.col("text").alias("Text"), "lang").write.mode(
        "overwrite").option("header", True).option("quoteAll", True).option("escape", '"').csv(f"{path}documents.csv")
    return read_tables(b.spark, {"documents": "documents"}, path, ".csv")["documents"]


# The staging tables that have a derived view; the others come out empty.
_STAGED = tuple(t for t in STAGED_TABLES if t in VIEWS)


def _staging_sql() -> str:
    """Every distinct row of every table, as a sum of digests over all columns."""
    filled = "select staging_table, count(*) as n_rows, sum(cast('0x' || substr(digest, 1, 8) as bigint))::bigint as digest_sum from ("
    rows = " union all ".join(
        f"select '{t}' as staging_table, md5(concat_ws('|', *columns(*))) as digest from (select distinct coalesce(columns(lambda c: c <> 'g_id')::varchar, '~') from {{{t}}})"
        for t in _STAGED)
    empty = " union all ".join(f"select '{t}', 0, 0" for t in STAGED_TABLES if t not in _STAGED)
    return f"{filled}{rows}) group by staging_table union all {empty}"


@check("stage_generic_csv", _staging_sql())
def _(b: Bridge):
    """Staging CSVs of all tables come out distinct, with an id, in their layout."""
    path, excluded = f"{b.folder}/staging_csv/", tuple(set(STAGED_TABLES) - set(_STAGED))
    parts = []
    # Table by table, so that the files and shuffles of one take disk at a time.
    for table in _STAGED:
        file = f"{path}IN_{table.upper()}.csv"
        rows = b(table).drop("g_id").withColumn("not_in_the_layout", F.lit("x"))
        rows.unionByName(rows).write.mode("overwrite").option("header", True).option("escape", '"').option("compression", "gzip").option(
            "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(file)
        df = stage_tables(b.spark, StagingConfig(path, f"{path}out/", ".csv", "IN_", True), (table,))[table]
        parts.append(write_and_reload(_digested(b, table, df), f"{path}digests/{table}"))
        drop_folder(b.spark, file)
    empty = stage_tables(b.spark, StagingConfig(path, f"{path}out/", ".csv", "IN_", True, excluded), excluded)
    return union_by_name(parts + [_digested(b, table, df) for table, df in empty.items()])


def _digested(b: Bridge, table: str, df: DataFrame) -> DataFrame:
    text = F.concat_ws("|", *[F.coalesce(c, F.lit("~")) for c in (b(table).columns if table in _STAGED else []) if c != "g_id"])
    number = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return df.agg(F.lit(table).alias("staging_table"), F.count_distinct("g_id").alias("n_rows"),
                  F.coalesce(F.sum(number), F.lit(0)).cast("bigint").alias("digest_sum"))


@check("lookup_file", """select l_partkey, p_name || ', "' || p_partkey || '"' as label, count(*) as n_rows
        from {lineitem} left join {part} on p_partkey = l_partkey group by all""")
def _(b: Bridge):
    """A lookup file with quotes and commas, read as a view that SQL joins."""
    path = f"{b.folder}/lookup/labels.csv"
    b("part").select("p_partkey", F.concat("p_name", F.lit(', "'), F.col("p_partkey").cast("string"), F.lit('"')).alias("label")).write.mode(
        "overwrite").option("header", True).option("escape", '"').csv(path)
    read_lookup(b.spark, path, "part_labels")
    return b("lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n_rows")).join(
        b.spark.table("part_labels"), F.col("p_partkey") == F.col("l_partkey").cast("string"), "left").select("l_partkey", "label", "n_rows")


@check("json_dictionary", "select n_name as name, count(*) as n_rows from {customer} join {nation} on n_nationkey = c_nationkey group by n_name")
def _(b: Bridge):
    """A JSON object as a two-column table, joined to rows that name its keys."""
    path = f"{b.folder}/dictionary/nations.json"
    entries = F.map_from_entries(F.collect_list(F.struct(F.col("n_nationkey").cast("string"), "n_name")))
    b("nation").agg(F.to_json(entries).alias("value")).coalesce(1).write.mode("overwrite").text(path)
    names = json_dict_table(b.spark, path, ("key", "name"))
    keyed = b("customer").select(F.col("c_nationkey").cast("string").alias("key"))
    return keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n_rows")).join(names, "key").select("name", "n_rows")


@check("csv_rejects", """select 'customer' as "table", 'customers' as file,
        case when c_custkey % 10 = 3 then '2 fields instead of 3' when c_custkey % 10 = 7 then '4 fields instead of 3' else 'read' end as reason,
        case when c_custkey % 10 = 3 then c_custkey || ',"' || c_name || '"' when c_custkey % 10 = 7 then c_custkey || ',"' || c_name || '",' || c_mktsegment || ',more'
          else c_custkey || '/' || c_name || ', "Ltd"/' || c_mktsegment end as text from {customer}""")
def _(b: Bridge):
    """Rows with a field too few or too many are kept apart with their file and reason; the others are read."""
    path = f"{b.folder}/csv_rejects/"
    name = F.concat(F.lit('"'), "c_name", F.lit('"'))
    line = F.when(F.col("c_custkey") % 10 == 3, F.concat_ws(",", "c_custkey", name)).when(
        F.col("c_custkey") % 10 == 7, F.concat_ws(",", "c_custkey", name, "c_mktsegment", F.lit("more"))).otherwise(
        F.concat(F.col("c_custkey").cast("string"), F.lit(',"'), "c_name", F.lit(', ""Ltd""",'), "c_mktsegment"))
    lines = b("customer").select(line.alias("line")).repartition(4).sortWithinPartitions("line")
    # Each file begins with the header, as the reader expects of a folder.
    headed = lines.mapInArrow(_with_header, "line string")
    headed.write.mode("overwrite").text(f"{path}customers.csv")
    files = {"customer": "customers"}
    kept = read_tables(b.spark, files, path, ".csv", multi_line=False)["customer"]
    rejects = rejected_rows(b.spark, files, path, ".csv", multi_line=False)
    file = F.regexp_extract("path", r"/([^/]+)\.csv/", 1)
    read = kept.select(F.lit("customer").alias("table"), F.lit("customers").alias("file"), F.lit("read").alias("reason"), F.concat_ws("/", "key", "name", "segment").alias("text"))
    return rejects.select("table", file.alias("file"), "reason", "text").unionByName(read)


def _with_header(batches):
    first = True
    for batch in batches:
        if first:
            yield pa.RecordBatch.from_pydict({"line": ["Key,Name,Segment"]})
            first = False
        yield batch


_HELD = "split_year = 1997 and right(s_id, 1) in ('1', '2', '3')"


@check("staged_rerun_added_rows", f"""select split_year, count(*) as n_rows, count(*) as n_ids,
        count(*) filter (not ({_HELD})) as n_kept_ids, split_year = 1997 as rewritten
        from (select distinct s_id, cast(substr(s_start_procedure_datetime, 1, 4) as bigint) as split_year from {{source_procedure}}) group by split_year""")
def _(b: Bridge):
    """A second delivery with more rows of one year: old rows keep their ids, other years' files stay."""
    path, registry = table_path(b.folder, "increments"), Registry(b.spark, f"{b.folder}/increments_registry-{uuid.uuid4().hex}")
    rows = b("source_procedure").drop("g_id").withColumn("split_year", F.substring("s_start_procedure_datetime", 1, 4).cast("bigint"))
    stage_increment(rows.filter(f"not ({_HELD})"), path, registry, "split_year")
    read = lambda: b.spark.read.parquet(path).select("s_id", "g_id", F.col("split_year").cast("bigint").alias("split_year"), F.col("_metadata.file_path").alias("file"))
    before = b.stage("increments_before", read())
    stage_increment(rows, path, registry, "split_year")
    old = before.select("s_id", "split_year", F.col("g_id").alias("old_id"), F.col("file").alias("old_file"))
    both = read().join(old, ["s_id", "split_year"], "left")
    kept = F.count_if(F.col("g_id") == F.col("old_id"))
    return both.groupBy("split_year").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("g_id").alias("n_ids"), kept.alias("n_kept_ids"),
        F.max(F.coalesce(F.col("file") != F.col("old_file"), F.lit(True))).alias("rewritten"))


@check("vocabulary_files", """select source_concept_id, source_vocabulary_id, source_vocabulary_version, source_domain_id,
        relationship_id, mapped_concept_id, mapped_vocabulary_id, mapped_domain_id from {cmap}""")
def _(b: Bridge):
    """Vocabulary files written, staged with their concept map, and loaded again."""
    path = f"{b.folder}/vocabulary/"
    files = {"CONCEPT": b("concept"), "CONCEPT_RELATIONSHIP": b("concept_relationship"), "VOCABULARY": b("vocabulary")}
    keys = {
        "CONCEPT_ANCESTOR": "concept_id as ancestor_concept_id", "CONCEPT_CLASS": "concept_class_id",
        "CONCEPT_SYNONYM": "concept_id", "DRUG_STRENGTH": "concept_id as drug_concept_id",
        "DOMAIN": "domain_id", "RELATIONSHIP": "domain_id as relationship_id",
    }
    files |= {name: b("concept").selectExpr(e).distinct() for name, e in keys.items()}
    for name, df in files.items():
        df.write.mode("overwrite").option("header", True).option("sep", "\t").option("quote", "").csv(f"{path}{name}.csv")
    build_vocabulary(b.spark, {"concept_csv_file_extension": ".csv", "concept_base_path": path,
                               "export_concept_mapping_table_path": f"{path}export/"})
    return load_vocabulary(b.spark, f"{path}export/")["concept_map"].select(
        "source_concept_id", "source_vocabulary_id", "source_vocabulary_version", "source_domain_id",
        "relationship_id", "mapped_concept_id", "mapped_vocabulary_id", "mapped_domain_id")


@check("sample_concepts", """select source_concept_id, mapped_concept_id from (
        select *, row_number() over (order by md5(concat_ws('|', cast(source_concept_id as varchar), relationship_id,
          cast(mapped_concept_id as varchar))), source_concept_id, relationship_id, mapped_concept_id) as n
        from {cmap} where source_vocabulary_id = 'Brand#2') where n <= 1000""")
def _(b: Bridge):
    return sample_concepts(b.concept_map, "Brand#2").select("source_concept_id", "mapped_concept_id")


@check("parquet_domain_partition", """select mapped_domain_id, count(*) as n_rows, count(distinct s_id) as n_facts
        from (select x.s_id, t.mapped_domain_id from {source_condition} x left join {fanout} t
          on t.oid = x.s_condition_code_type_oid and t.concept_code = x.s_condition_code) group by mapped_domain_id""")
def _(b: Bridge):
    from ..operators.resolve import resolve_fanout
    matched = resolve_fanout(b("source_condition"), b.codebook, "s_condition")
    back = write_by_domain(matched, table_path(b.folder, "by_domain"))
    return back.groupBy("mapped_domain_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("s_id").alias("n_facts"))


@check("staged_build", """select extract(year from cast(substr(x.s_start_procedure_datetime, 1, 10) as date)) as split_year,
        t.mapped_domain_id, count(*) as n_rows from {source_procedure} x left join {fanout} t
        on t.oid = x.s_procedure_code_type_oid and t.concept_code = x.s_procedure_code group by 1, 2""")
def _(b: Bridge):
    """A table split by a chosen column and by domain, in one write."""
    from ..operators.resolve import resolve_fanout
    matched = resolve_fanout(b("source_procedure"), b.codebook, "s_procedure").withColumn(
        "split_year", F.substring("s_start_procedure_datetime", 1, 4).cast("bigint"))
    back = write_staged(matched, table_path(b.folder, "staged_build"), "split_year")
    return back.groupBy("split_year", "mapped_domain_id").agg(F.count(F.lit(1)).alias("n_rows"))


@check("manifest_views", """select 'nation' as name, count(*) as n_rows from {nation}
        union all select 'supplier', count(*) from {supplier} union all select 'orders', count(*) from {orders}""")
def _(b: Bridge):
    """Tables exported, listed in a manifest, attached as views; one group is left out."""
    base = f"{b.folder}/manifest/"
    names = ("nation", "supplier", "orders")
    paths = export_tables({n: b(n) for n in names}, base, {"orders": "o_orderstatus"})
    write_manifest(b.spark, {"kept": paths, "skipped": {"customer": f"{base}missing.parquet"}}, f"{base}manifest.json")
    attached = attach_catalog(b.spark, read_manifest(b.spark, f"{base}manifest.json"), ["skipped"])["kept"]
    loaded = load_tables(b.spark, names, base)
    parts = [attached[n].intersect(loaded[n]).agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("n_rows")) for n in names]
    for name in names:
        b.spark.catalog.dropTempView(name)
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@check("published_tables", """select 'concept' as table_name, count(*) as n_rows, sum(concept_id) as key_sum from {concept}
        union all select 'location', count(*), sum(location_id) from {o_location}
        union all select 'source_relationship', count(*), sum(length(s_target_from_value)) from {source_relationship}""")
def _(b: Bridge):
    """The tables of a manifest as managed tables of a schema; a second run replaces them."""
    tables = {"ohdsi": {"location": b.cdm.table("location")}, "concept": {"concept": b("concept")},
              "prepared_source": {"source_relationship": b("source_relationship")}}
    database, base = f"published_{uuid.uuid4().hex}", f"{b.folder}/to_publish"
    manifest = {group: export_tables(named, f"{base}/{group}/") for group, named in tables.items()}
    for _ in range(2):
        names = publish_tables(b.spark, manifest, database, f"{b.folder}/{database}", "parquet")
    sums = {"location": F.col("location_id"), "concept": F.col("concept_id"), "source_relationship": F.length("s_target_from_value")}
    found = {name.split(".")[1].strip("`"): b.spark.table(name) for name in names}
    return union_by_name([found[t].agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("n_rows"), F.sum(key).alias("key_sum")) for t, key in sums.items()])


@check("conform_drug_exposure", """select person_id, concept_id as drug_concept_id,
        cast(cast(substr(started, 1, 10) as date) as varchar) as drug_exposure_start_date,
        cast(cast(substr(coalesce(ended, started), 1, 10) as date) as varchar) as drug_exposure_end_date,
        substr(code, 1, 512) as drug_source_value, quantity from {o_drug_exposure} where started is not null""")
def _(b: Bridge):
    return portable(conform_to_ddl(b.cdm.table("drug_exposure"), "drug_exposure", dialect="psql").select(
        "person_id", "drug_concept_id", "drug_exposure_start_date", "drug_exposure_end_date",
        "drug_source_value", "quantity"))


@check("conform_observation", """select person_id, concept_id as observation_concept_id, s_id as row_id,
        substr(value_as_string || repeat('x', 70), 1, 60) as value_as_string from {o_observation}""")
def _(b: Bridge):
    """Long texts are cut to the width of their column."""
    df = b.cdm.table("observation").withColumn("value_as_string", F.concat("value_as_string", F.repeat(F.lit("x"), 70)))
    wide = df.withColumn("qualifier_source_value", F.col("s_id"))
    return conform_to_ddl(wide, "observation").select(
        "person_id", "observation_concept_id", F.col("qualifier_source_value").alias("row_id"), "value_as_string")


@check("conform_concept_dates", """select concept_id, cast(cast(strptime(
        cast(19700101 + concept_id % 28 as varchar), '%Y%m%d') as date) as varchar) as valid_start_date from {concept}""")
def _(b: Bridge):
    dated = b("concept").withColumn("valid_start_date", F.lit(19700101) + F.col("concept_id") % 28)
    return portable(conform_to_ddl(dated, "concept").select("concept_id", "valid_start_date"))


_TODAY = datetime.date(2024, 3, 1)
_SETTINGS = {"cdm_source_name": "Test source", "cdm_holder": "Holder", "source_release_date": "2024-02-01"}

ORACLE_VIEWS["o_cdm_source"] = """select 'Test source' as cdm_source_name, 'cdm' as cdm_source_abbreviation,
    'Holder' as cdm_holder, '2024-02-01' as source_release_date, '2024-03-01' as cdm_release_date,
    'CDM v5.4.1' as cdm_version,
    (select concept_id from {concept} where vocabulary_id = 'CDM' and concept_code = 'CDM v5.4.1') as cdm_version_concept_id,
    (select vocabulary_version from {vocabulary} where vocabulary_id = 'None') as vocabulary_version"""
_CDM_SOURCE = ("cdm_source_name", "cdm_source_abbreviation", "cdm_holder", "source_release_date",
               "cdm_release_date", "cdm_version", "cdm_version_concept_id", "vocabulary_version")


def cdm_source_frame(b: Bridge):
    return build_cdm_source(b.spark, b("concept"), b("vocabulary"), _SETTINGS, today=_TODAY).select(*_CDM_SOURCE)


@check("latest_measurement_date", "select max(start_date) as last_measurement_date from {o_measurement}")
def _(b: Bridge):
    return portable(latest_measurement(b.cdm.table("measurement")))


@check("replace_cdm_source", """select 'db' as cdm_source_name, 'db' as cdm_source_abbreviation,
        (select max(start_date) from {o_measurement}) as source_release_date, '2024-03-01' as cdm_release_date,
        'CDM v5.4.1' as cdm_version, (select vocabulary_version from {vocabulary}
        where vocabulary_id = 'None') as vocabulary_version,
        (select concept_id from {concept} where vocabulary_id = 'CDM' and concept_code = 'CDM v5.4.1') as cdm_version_concept_id""")
def _(b: Bridge):
    """Missing metadata is looked up in the tables."""
    row = replacement_cdm_source(b.spark, "db", {"cdm_version": "CDM v5.4.1"}, b.table, today=_TODAY)
    return portable(row.select("cdm_source_name", "cdm_source_abbreviation", "source_release_date",
                               "cdm_release_date", "cdm_version", "vocabulary_version", "cdm_version_concept_id"))
