"""Checks of projections, filters, joins, keys, scalar rules and code resolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import (
    add_row_id, as_date, base64_text, birth_parts, code_label, composite_id, decimal_value,
    distinct_with_row_id, duplicate_keys, end_or_start, first_filled, hl7_timestamp, location_key, person_key,
    preferred_type, repair_interval, stable_id,
)
from ..operators.joins import (
    align_to_person, align_to_visit, lookup, lookup_value_code, payer_at_encounter,
)
from ..operators.percentiles import exact_percentiles
from ..operators.project import (
    align, exclude_rows, has_code, rename_columns, split_by_type, stamp_lineage, union_by_name,
    union_distinct,
)
from ..operators.resolve import (
    CodedField, best_match, match_codes, resolve_fanout, resolve_field, resolve_fields, used_pairs,
)
from ..operators.vocab import coded_concepts
from ..specs import cdm_spec
from .oracle import day, hit, in_domain, winner
from .registry import check, portable
from .views import Bridge

# -- projections and filters --------------------------------------------------------------


@check("rename_project", "select c_custkey as customer_number, c_name as full_name from {customer}")
def _(b: Bridge):
    return rename_columns(b("customer"), {"c_custkey": "customer_number", "c_name": "full_name"})


@check("rename_keep_others",
       "select c_custkey as customer_number, c_name, c_nationkey, c_acctbal, c_mktsegment as segment from {customer}")
def _(b: Bridge):
    return rename_columns(b("customer"), {"c_mktsegment": "segment", "c_custkey": "customer_number"}, keep_others=True)


@check("align_to_spec", """select s_city as city, s_state as state, cast(s_latitude as double) as latitude,
        cast(null as varchar) as address_2, g_id as location_id, s_county as extra_county from {source_location}""")
def _(b: Bridge):
    df = b("source_location").select(
        F.col("g_id").alias("location_id"), F.col("s_city").alias("city"), F.col("s_state").alias("state"),
        F.col("s_latitude").alias("latitude"), F.col("s_county").alias("extra_county"))
    aligned = align(df, cdm_spec("location"), keep_others=True)
    assert aligned.columns == [*cdm_spec("location").columns, "extra_county"]
    return aligned.select("city", "state", "latitude", "address_2", "location_id", "extra_county")


@check("exclude_rows", """select s_encounter_id, i_exclude from {source_encounter}
        where i_exclude is null or i_exclude <> '1'""")
def _(b: Bridge):
    return exclude_rows(b("source_encounter")).select("s_encounter_id", "i_exclude")


@check("provenance_stamp", """select g_id, k_care_site, 'source_care_site' as g_source_table_name, g_id as s_g_id
        from {source_care_site}""")
def _(b: Bridge):
    return stamp_lineage(b("source_care_site"), "source_care_site").select(
        "g_id", "k_care_site", "g_source_table_name", "s_g_id")


@check("code_presence", """select s_id, m_drug_code from {source_medication}
        where m_drug_code is not null and m_drug_code_type_oid is not null""")
def _(b: Bridge):
    return b("source_medication").filter(has_code("m_drug_code", "m_drug_code_type_oid")).select("s_id", "m_drug_code")


@check("deceased_persons", "select s_person_id, s_death_datetime from {source_person} where s_death_datetime is not null")
def _(b: Bridge):
    return b("source_person").filter("s_death_datetime is not null").select("s_person_id", "s_death_datetime")


@check("standard_concepts", "select concept_id, concept_code from {concept} where standard_concept = 'S'")
def _(b: Bridge):
    return b("concept").filter("standard_concept = 'S'").select("concept_id", "concept_code")


@check("typed_value_split", """select event_id, case when event_type = 'view' then props end as text_value,
        case when event_type = 'click' then value end as number_value from {events}""")
def _(b: Bridge):
    return portable(b("events").select(
        "event_id", split_by_type("props", "event_type", "view").alias("text_value"),
        split_by_type("value", "event_type", "click").alias("number_value")))


@check("union_distinct_places", """select n_nationkey as place, n_name as name from {nation}
        union select s_nationkey, n_name from {supplier} join {nation} on n_nationkey = s_nationkey""")
def _(b: Bridge):
    nation = b("nation").select(F.col("n_nationkey").alias("place"), F.col("n_name").alias("name"))
    used = b("supplier").join(nation, F.col("s_nationkey") == F.col("place")).select("place", "name")
    return union_distinct([nation, used])


@check("union_fragments", """select c_name as name, c_acctbal as balance, cast(null as varchar) as status from {customer}
        union all select cast(o_orderkey as varchar), null, o_orderstatus from {orders}""")
def _(b: Bridge):
    customers = b("customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    orders = b("orders").select(F.col("o_orderstatus").alias("status"), F.col("o_orderkey").cast("string").alias("name"))
    return portable(union_by_name([customers, orders], fill_missing=True))


# -- keys ---------------------------------------------------------------------------------


@check("location_key", """select c_custkey, sha1(coalesce(null, '') || c_mktsegment || n_name || coalesce(c_name, ''))
        as k_location from {customer} join {nation} on n_nationkey = c_nationkey""")
def _(b: Bridge):
    df = b("customer").join(b("nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    key = location_key(F.lit(None).cast("string"), "c_mktsegment", "n_name", "c_name")
    return df.select("c_custkey", key.alias("k_location"))


@check("stable_person_id", """select count(*) as n_rows, count(distinct c_custkey) as n_keys, count(*) as n_repeatable,
        count(*) as n_null_stays_null from {customer}""")
def _(b: Bridge):
    """Keys are unique per person, repeatable, and null for null."""
    keyed = b("customer").select(
        stable_id("salt", "c_name").alias("k"), stable_id("salt", F.concat("c_name", F.lit(""))).alias("again"),
        stable_id("salt", F.lit(None).cast("string")).alias("none"))
    return keyed.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("k").alias("n_keys"),
        F.count_if(F.col("k") == F.col("again")).alias("n_repeatable"),
        F.count_if(F.col("none").isNull()).alias("n_null_stays_null"))


@check("duplicate_keys", """select c_mktsegment || '/' || cast(c_nationkey as varchar) as k, count(*) as n_rows
        from {customer} group by 1 having count(*) > 1""")
def _(b: Bridge):
    keyed = b("customer").select(F.concat("c_mktsegment", F.lit("/"), F.col("c_nationkey").cast("string")).alias("k"))
    return duplicate_keys(keyed, "k")


@check("salted_folder_key", """select c_custkey, sha256('salt' || '/data/' || c_name) as s_person_id from {customer}""")
def _(b: Bridge):
    return b("customer").select("c_custkey", person_key("salt", F.concat(F.lit("/data/"), "c_name")).alias("s_person_id"))


@check("distinct_row_id", """select count(*) as n_rows, count(*) as n_ids, 0 as n_negative from
        (select distinct l_orderkey, l_linenumber, l_returnflag from {lineitem})""")
def _(b: Bridge):
    rows = distinct_with_row_id(b("lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"))
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("g_id").alias("n_ids"),
                    F.count_if(F.col("g_id") < 0).cast("int").alias("n_negative"))


@check("row_id_is_repeatable", "select count(*) as n_rows, count(*) as n_same from {orders}")
def _(b: Bridge):
    """The same rows get the same ids under another partitioning."""
    rows = b("orders").select("o_orderkey", "o_totalprice")
    again = add_row_id(rows.repartition(5, "o_totalprice"), out="other_id").select("o_orderkey", "other_id")
    return add_row_id(rows).join(again, "o_orderkey").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("g_id") == F.col("other_id")).alias("n_same"))


@check("composite_id", "select s_encounter_id || '||' || s_id as id from {source_encounter}")
def _(b: Bridge):
    return b("source_encounter").select(composite_id("s_encounter_id", "s_id").alias("id"))


# -- scalar rules -------------------------------------------------------------------------


@check("dates_and_birth_parts", f"""select s_person_id,
        cast(extract(year from cast(s_birth_datetime as timestamp)) as int) as year_of_birth,
        cast(extract(month from cast(s_birth_datetime as timestamp)) as int) as month_of_birth,
        cast(extract(day from cast(s_birth_datetime as timestamp)) as int) as day_of_birth,
        {day('substr(s_death_datetime, 1, 10)')} as death_date from {{source_person}}""")
def _(b: Bridge):
    return portable(b("source_person").select(
        "s_person_id", *[v.alias(n) for n, v in birth_parts("s_birth_datetime").items()],
        as_date("s_death_datetime").alias("death_date")))


@check("end_or_start_date", f"""select s_encounter_id,
        {day('substr(coalesce(s_visit_end_datetime, s_visit_start_datetime), 1, 10)')} as ended from {{source_encounter}}""")
def _(b: Bridge):
    return portable(b("source_encounter").select(
        "s_encounter_id", end_or_start("s_visit_end_datetime", "s_visit_start_datetime").alias("ended")))


@check("coalesced_values", """select s_id, coalesce(m_code, s_code) as code,
        coalesce(m_result_text, s_result_text) as result_text, try_cast(s_result_numeric as double) as result_number
        from {source_result}""")
def _(b: Bridge):
    return portable(b("source_result").select(
        "s_id", first_filled("m_code", "s_code").alias("code"),
        first_filled("m_result_text", "s_result_text").alias("result_text"),
        decimal_value(F.lit(None).cast("string"), "s_result_numeric").alias("result_number")))


@check("code_label", """select s_id, coalesce(s_drug_code, '') || '|' || coalesce(s_drug_text, '') as label
        from {source_medication}""")
def _(b: Bridge):
    return b("source_medication").select("s_id", code_label("s_drug_code", "s_drug_text").alias("label"))


@check("type_preference", f"""select x.s_id, case when coalesce(t1.standard_only_id, 0) > 0 then t1.standard_only_id
        else coalesce(t2.standard_only_id, 0) end as type_concept_id from {{source_medication}} x
        {hit('t1', 'm_drug_type')} {hit('t2', 's_drug_type')}""")
def _(b: Bridge):
    fields = [CodedField("m_type", ("m_drug_type",), standard_only=True),
              CodedField("s_type", ("s_drug_type",), standard_only=True)]
    df = resolve_fields(b("source_medication"), b.codebook, fields)
    return df.select("s_id", preferred_type("m_type", "s_type").alias("type_concept_id"))


@check("hl7_datetime", """select o_orderkey, cast(case
        when o_orderpriority = '5-LOW' then null
        when o_orderstatus = 'F' then o_orderdate - interval 1 hour
        else o_orderdate end as varchar) as at from {orders}""")
def _(b: Bridge):
    """Eight digits, fourteen digits, an offset with and without fractions, and noise."""
    digits = F.date_format("o_orderdate", "yyyyMMddHHmmss")
    text = (
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("unknown"))
        .when((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"), F.concat(digits, F.lit(".000+0100")))
        .when(F.col("o_orderstatus") == "F", F.concat(digits, F.lit("+0100")))
        .when(F.col("o_orderstatus") == "O", digits)
        .otherwise(F.date_format("o_orderdate", "yyyyMMdd")))
    return portable(b("orders").select("o_orderkey", hl7_timestamp(text).alias("at")))


@check("interval_repair", """select o_orderkey,
        case when o_orderstatus = 'O' then cast(o_orderdate as varchar)
             when o_orderstatus = 'F' then cast(o_orderdate as varchar) end as started,
        case when o_orderstatus = 'P' then '1' end as i_exclude from {orders}""")
def _(b: Bridge):
    df = b("orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "O", F.col("o_orderdate").cast("string")).otherwise("").alias("a"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("string")).alias("z"),
        F.lit(None).cast("string").alias("x"))
    fixed = repair_interval("a", "z", "x")
    return df.select("o_orderkey", fixed["start"].alias("started"), fixed["exclude"].alias("i_exclude"))


@check("base64_text", "select doc_id, text from {documents}")
def _(b: Bridge):
    """Whole texts survive an encoding with surrounding white space."""
    body = F.concat(F.lit("\n "), F.base64(F.encode("text", "UTF-8")), F.lit(" "))
    return b("documents").select("doc_id", base64_text(F.regexp_replace(body, r"\s", "")).alias("text"))


# -- joins --------------------------------------------------------------------------------


@check("lookup_fk", """select x.s_encounter_id, c.care_site_id, p.provider_id from {source_encounter} x
        left join {o_care_site} c on c.care_site_source_value = x.k_care_site
        left join {o_provider} p on p.provider_source_value = x.k_provider""")
def _(b: Bridge):
    df = b("source_encounter")
    for dim in ("care_site", "provider"):
        keys, rows = b.cdm.link(dim)
        df = lookup(df, keys, {f"k_{dim}": f"{dim}_source_value"}, {f"{dim}_id": f"{dim}_id"}, unique=True, dim_rows=rows)
    return df.select("s_encounter_id", "care_site_id", "provider_id")


@check("align_person", """select x.s_id, p.person_id from {source_device} x
        join {o_person} p on p.person_source_value = x.s_person_id""")
def _(b: Bridge):
    keys, rows = b.cdm.link("person")
    return align_to_person(b("source_device"), keys, unique=True, person_rows=rows).select("s_id", "person_id")


def _visits(b: Bridge, how: str):
    people, people_rows = b.cdm.link("person")
    visits, visit_rows = b.cdm.link("visit")
    df = align_to_person(exclude_rows(b("source_condition")), people, True, people_rows)
    return align_to_visit(df, visits, how, True, visit_rows).select("s_id", "person_id", "visit_occurrence_id")


_ALIGNED = """select x.s_id, p.person_id, v.visit_occurrence_id from {source_condition} x
        join {o_person} p on p.person_source_value = x.s_person_id
        %s join {o_link} v on v.s_encounter_id = x.s_encounter_id and v.s_person_id = x.s_person_id
        where x.i_exclude is null or x.i_exclude <> '1'"""


@check("align_visit_left", _ALIGNED % "left")
def _(b: Bridge):
    return _visits(b, "left")


@check("align_visit_inner", _ALIGNED % "inner")
def _(b: Bridge):
    return _visits(b, "inner")


@check("lookup_value_code", """select o_orderkey, c.concept_code as m_code, o_orderstatus from {orders}
        left join {concept} c on c.vocabulary_id = 'Priority' and c.concept_name = o_orderpriority and o_orderstatus = 'F'""")
def _(b: Bridge):
    mapping = b("concept").filter("vocabulary_id = 'Priority'").select(
        F.col("concept_name").alias("value"), F.col("concept_code").alias("m_code"))
    found = lookup_value_code(b("orders"), mapping, "o_orderpriority", "value", when=F.col("o_orderstatus") == "F")
    return found.select("o_orderkey", "m_code", "o_orderstatus")


@check("payer_encounter_range_join", """select e.s_encounter_id, p.s_id as payer_row from {source_encounter} e
        join {source_payer} p on p.s_person_id = e.s_person_id
        and cast(coalesce(e.s_visit_end_datetime, e.s_visit_start_datetime) as timestamp)
          between cast(p.s_payer_start_datetime as timestamp) and cast(p.s_payer_end_datetime as timestamp)""")
def _(b: Bridge):
    periods = b("source_payer").select(
        "s_person_id", "s_payer_start_datetime", "s_payer_end_datetime", F.col("s_id").alias("payer_row"))
    return payer_at_encounter(b("source_encounter").drop("s_id"), periods).select("s_encounter_id", "payer_row")


@check("payer_open_periods", """select e.s_encounter_id, p.s_id as payer_row from {source_encounter} e
        join {source_payer} p on p.s_person_id = e.s_person_id
        and cast(coalesce(e.s_visit_end_datetime, e.s_visit_start_datetime) as timestamp)
          >= cast(p.s_payer_start_datetime as timestamp)""")
def _(b: Bridge):
    """Periods that are open until 9999 meet every later encounter, listed for the years of encounters only."""
    periods = b("source_payer").select("s_person_id", "s_payer_start_datetime", F.lit("9999-12-31").alias("s_payer_end_datetime"), F.col("s_id").alias("payer_row"))
    return payer_at_encounter(b("source_encounter").drop("s_id"), periods).select("s_encounter_id", "payer_row")


# -- vocabulary and code resolution -------------------------------------------------------


@check("concept_map", "select * from {cmap}")
def _(b: Bridge):
    from ..operators.vocab import build_concept_map
    return build_concept_map(b("concept"), b("concept_relationship"), b("vocabulary"))


@check("codebook", "select * from {best}")
def _(b: Bridge):
    from ..operators.vocab import build_codebook
    return build_codebook(b("concept"), b.concept_map, b("oid_map")).best


@check("oid_lookup", "select oid, concept_code, concept_id, domain_id from {coded}")
def _(b: Bridge):
    return coded_concepts(b("concept"), b("oid_map")).select("oid", "concept_code", "concept_id", "domain_id")


@check("used_codes", """select distinct s_device_code_type_oid as oid, s_device_code as concept_code from {source_device}
        where s_device_code is not null union
        select m_device_code_type_oid, m_device_code from {source_device} where m_device_code is not null""")
def _(b: Bridge):
    return used_pairs(b("source_device"), ["s_device", "m_device"])


@check("pruned_codebook", """select * from {best} b where exists (select 1 from {source_procedure} x
        where x.s_procedure_code_type_oid = b.oid and x.s_procedure_code = b.concept_code)""")
def _(b: Bridge):
    return b.codebook.restricted_to(used_pairs(b("source_procedure"), ["s_procedure"])).best


@check("field_codebooks", """select 'source_device.' || p as field, oid, concept_code, concept_id, mapped_concept_id, standard_only_id
        from {best} b join (
            select 's_device' as p, s_device_code_type_oid as o, s_device_code as c from {source_device}
            union select 'm_device', m_device_code_type_oid, m_device_code from {source_device}) on o = b.oid and c = b.concept_code""")
def _(b: Bridge):
    fields = ["s_device", "m_device"]
    books = b.codebook.by_field(used_pairs(b("source_device"), fields, "source_device"), [f"source_device.{f}" for f in fields], [])
    return books.best.select("field", "oid", "concept_code", "concept_id", "mapped_concept_id", "standard_only_id")


@check("concept_lookup", """select x.s_id, 'm_device_code' as code_field_name, c.concept_code as code, c.vocabulary_id,
        c.concept_id, c.standard_concept, c.domain_id from {source_device} x
        join {coded} c on c.oid = x.m_device_code_type_oid and c.concept_code = x.m_device_code""")
def _(b: Bridge):
    coded = coded_concepts(b("concept"), b("oid_map"))
    return match_codes(b("source_device"), coded, "m_device", row_id="s_id").drop("match_level")


@check("best_match_rank", """select s_id, match_level, concept_id from (
        select *, row_number() over (partition by s_id order by match_level, concept_id) as nth from (
          select x.s_id, 1 as match_level, c.concept_id from {source_medication} x
            join {coded} c on c.oid = x.m_drug_code_type_oid and c.concept_code = x.m_drug_code
          union all select x.s_id, 2, c.concept_id from {source_medication} x
            join {coded} c on c.oid = x.s_drug_code_type_oid and c.concept_code = x.s_drug_code
          union all select x.s_id, 3, c.concept_id from {source_medication} x
            join {coded} c on c.oid = x.g_drug_code_type_oid and c.concept_code = x.g_drug_code)) where nth = 1""")
def _(b: Bridge):
    coded = coded_concepts(b("concept"), b("oid_map"))
    rows = b("source_medication")
    matches = [match_codes(rows, coded, p, level, "s_id") for level, p in enumerate(("m_drug", "s_drug", "g_drug"), 1)]
    return best_match(union_by_name(matches), "s_id").select("s_id", "match_level", "concept_id")


def _resolve(name: str, source: str, field: CodedField, sql: str, row: str = "s_id") -> None:
    outputs = [c for c in (field.concept, field.source, field.mapped_domain) if c]

    @check(name, f"select x.{row}, {sql}")
    def _(b: Bridge):
        return resolve_field(b(source), b.codebook, field).select(row, *outputs)


_resolve("resolve_one_level", "source_procedure", CodedField("concept", ("s_procedure",), "source"),
         f"{winner('mapped_concept_id', 'a')} as concept, {winner('concept_id', 'a')} as source "
         f"from {{source_procedure}} x {hit('a', 's_procedure')}")
_resolve("resolve_two_level", "source_device", CodedField("concept", ("m_device", "s_device"), "source"),
         f"{winner('mapped_concept_id', 'a', 'b')} as concept, {winner('concept_id', 'a', 'b')} as source "
         f"from {{source_device}} x {hit('a', 'm_device')} {hit('b', 's_device')}")
_resolve("resolve_three_level", "source_medication",
         CodedField("concept", ("m_drug", "s_drug", "g_drug"), "source", domain="Drug", mapped_domain="target_domain"),
         f"{in_domain('Drug', 'a', 'b', 'c')} as concept, {winner('concept_id', 'a', 'b', 'c')} as source, "
         "case when a.concept_id is not null then a.mapped_domain_id when b.concept_id is not null "
         "then b.mapped_domain_id else c.mapped_domain_id end as target_domain "
         f"from {{source_medication}} x {hit('a', 'm_drug')} {hit('b', 's_drug')} {hit('c', 'g_drug')}")
_resolve("resolve_domain_restricted", "source_person",
         CodedField("concept", ("m_gender", "s_gender"), "source", domain="Gender"),
         f"{in_domain('Gender', 'a', 'b')} as concept, {winner('concept_id', 'a', 'b')} as source "
         f"from {{source_person}} x {hit('a', 'm_gender')} {hit('b', 's_gender')}", row="s_person_id")
_resolve("resolve_standard_only", "source_condition", CodedField("concept", ("s_condition",), standard_only=True),
         f"coalesce(a.standard_only_id, 0) as concept from {{source_condition}} x {hit('a', 's_condition')}")


@check("resolve_fanout", """select x.s_id, coalesce(t.concept_id, 0) as g_source_concept_id,
        coalesce(t.mapped_concept_id, 0) as g_concept_id, t.domain_id, t.mapped_domain_id, t.relationship_id
        from {source_condition} x left join {fanout} t
        on t.oid = x.s_condition_code_type_oid and t.concept_code = x.s_condition_code""")
def _(b: Bridge):
    return resolve_fanout(b("source_condition"), b.codebook, "s_condition").select(
        "s_id", "g_source_concept_id", "g_concept_id", "domain_id", "mapped_domain_id", "relationship_id")


@check("resolve_fanout_inner", """select x.s_id, t.mapped_concept_id as g_concept_id, t.vocabulary_id
        from {source_procedure} x join {fanout} t
        on t.oid = x.s_procedure_code_type_oid and t.concept_code = x.s_procedure_code""")
def _(b: Bridge):
    return resolve_fanout(b("source_procedure"), b.codebook, "s_procedure", how="inner").select(
        "s_id", "g_concept_id", "vocabulary_id")


# -- aggregates ---------------------------------------------------------------------------


@check("concept_frequency", """select t.mapped_domain_id, t.mapped_concept_id as concept_id, c.concept_name,
        count(*) as n_rows, count(distinct p.person_id) as n_persons
        from {source_condition} x join {o_person} p on p.person_source_value = x.s_person_id
        join {fanout} t on t.oid = x.s_condition_code_type_oid and t.concept_code = x.s_condition_code
        join {concept} c on c.concept_id = t.mapped_concept_id
        where x.i_exclude is null or x.i_exclude <> '1'
        group by t.mapped_domain_id, t.mapped_concept_id, c.concept_name""")
def _(b: Bridge):
    """Facts of known persons by standard concept: resolve, align, count, then name."""
    facts = resolve_fanout(exclude_rows(b("source_condition")), b.codebook, "s_condition", how="inner")
    people, rows = b.cdm.link("person")
    aligned = align_to_person(facts.filter("g_concept_id is not null"), people, True, rows)
    counts = aligned.groupBy("mapped_domain_id", F.col("g_concept_id").alias("concept_id")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("person_id").alias("n_persons"))
    return counts.join(b("concept").select("concept_id", "concept_name"), "concept_id")


@check("exact_percentiles", """select l_returnflag, l_linestatus,
        round(quantile_cont(l_extendedprice, 0.25), 6) as p25, round(quantile_cont(l_extendedprice, 0.5), 6) as p50,
        round(quantile_cont(l_extendedprice, 0.75), 6) as p75 from {lineitem} group by l_returnflag, l_linestatus""")
def _(b: Bridge):
    return portable(exact_percentiles(b("lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice",
                                      {"p25": 0.25, "p50": 0.5, "p75": 0.75}))


@check("distinct_split_values", "select distinct extract(year from o_orderdate) as column_values_to_split_on from {orders}")
def _(b: Bridge):
    from ..sinks.parquet import distinct_splits
    years = b("orders").select(F.year("o_orderdate").cast("bigint").alias("year"))
    return distinct_splits(years, "year")
