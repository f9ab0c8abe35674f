"""Checks of the C-CDA jobs, on one document per order derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import ccda
from .registry import check, portable
from .views import Bridge

# Values of an order's document. Orders of priority 5 come from a phone export (no sections of results), orders of
# status O list their problem under the second problem code.
_ORDERS = """select o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice,
    'C' || cast(o_custkey as string) as person, 'O' || cast(o_orderkey as string) as doc,
    cast(o_orderdate as string) as taken,
    replace(replace(replace(cast(o_orderdate as string), '-', ''), ' ', ''), ':', '') as stamp,
    substr(o_orderpriority, 3) as word, cast(o_totalprice as string) as amount,
    c_mktsegment, c_nationkey from {orders} join {customer} on c_custkey = o_custkey"""


def _document() -> F.Column:
    def element(name: str, attributes: str, body: str = "") -> str:
        return f"<{name} {attributes}>{body}</{name}>" if body else f"<{name} {attributes}/>"

    labs = element("code", 'code="30954-2" codeSystem="2.16.840.1.113883.6.1"') + (
        "<entry><organizer><component><observation><id root=\"lab-{doc}\"/>"
        "<code code=\"{o_custkey}\" codeSystem=\"{lab_oid}\" codeSystemName=\"LOINC\"><originalText>{word}</originalText></code>"
        "<effectiveTime value=\"{stamp}\"/>"
        "<value xsi:type=\"PQ\" value=\"{amount}\" unit=\"mmHg\"/>"
        "<interpretationCode code=\"{o_orderstatus}\" codeSystem=\"2.16.840.1.113883.5.83\"><originalText>seen</originalText></interpretationCode>"
        "<referenceRange><observationRange><value><low value=\"1\"/><high value=\"{c_nationkey}\"/></value></observationRange></referenceRange>"
        "</observation></component><component><observation><id root=\"text-{doc}\"/>"
        "<code code=\"T\" codeSystem=\"{lab_oid}\"/><value xsi:type=\"ST\">{o_orderpriority}</value>"
        "</observation></component></organizer></entry>")
    phone = "".join(
        f"<entry><organizer><code code=\"{code}\" codeSystem=\"2.16.840.1.113883.6.96\"/><component><observation>"
        f"<id root=\"{name}-{{doc}}\"/><code code=\"{letter}\" codeSystem=\"{{lab_oid}}\" displayName=\"{{word}}\"/>"
        "<effectiveTime><low value=\"{stamp}+0100\"/></effectiveTime>"
        "<value xsi:type=\"PQ\" value=\"{amount}\" unit=\"lb\"/></observation></component></organizer></entry>"
        for code, name, letter in (("386053000", "phone", "P"), ("46680005", "pulse", "W")))
    vitals = (
        "<component><section><code code=\"8716-3\" codeSystem=\"2.16.840.1.113883.6.1\"/><entry><organizer><component><observation>"
        "<id root=\"vital-{doc}\"/><code code=\"V\" codeSystem=\"2.16.840.1.113883.6.1\"><originalText>Pulse</originalText></code>"
        "<effectiveTime value=\"{stamp}\"/><value xsi:type=\"PQ\" value=\"{c_nationkey}\" unit=\"\"/>"
        "</observation></component></organizer></entry></section></component>")
    parts = [
        "<?xml version=\"1.0\" encoding=\"UTF-8\"?><ClinicalDocument xmlns=\"urn:hl7-org:v3\" "
        "xmlns:xsi=\"http://www.w3.org/2001/XMLSchema-instance\"><recordTarget><patientRole><id root=\"id-{person}\"/><patient>"
        "<administrativeGenderCode code=\"{c_mktsegment}\" codeSystem=\"oid.segment\" codeSystemName=\"Segment\">"
        "<originalText>{gender_text}</originalText></administrativeGenderCode>"
        "<raceCode code=\"R{c_nationkey}\" codeSystem=\"oid.nation\"/><birthTime value=\"19700102\"/>"
        "</patient></patientRole></recordTarget>{phone_entry}<component><structuredBody>",
        # Problems and a note share a section.
        "<component><section><text><paragraph ID=\"n1\">About <content ID=\"n2\">{word} &amp; {doc}</content></paragraph></text>"
        "<entry><act><entryRelationship><observation><id root=\"problem-{doc}\"/>"
        "<code code=\"{problem_code}\" codeSystem=\"2.16.840.1.113883.6.96\"/><statusCode code=\"active\"/>"
        "<effectiveTime>{low}<high value=\"{day8}\"/></effectiveTime>"
        "<value xsi:type=\"CD\" code=\"{o_custkey}\" codeSystem=\"2.16.840.1.113883.6.96\" codeSystemName=\"SNOMED\" displayName=\"{word}\"/>"
        "</observation></entryRelationship><entryRelationship><observation><id root=\"other-{doc}\"/>"
        "<code code=\"404684003\" codeSystem=\"2.16.840.1.113883.6.96\"/><value code=\"9\"/></observation></entryRelationship></act></entry>"
        "<entry><act><code code=\"34109-9\" codeSystem=\"2.16.840.1.113883.6.1\"><translation code=\"N{c_nationkey}\" "
        "codeSystem=\"oid.note\" codeSystemName=\"Notes\" displayName=\"Progress note\"/></code>"
        "<text><reference value=\"#n2\"/></text><effectiveTime value=\"{stamp}\"/></act></entry>"
        "<entry><act><code code=\"34109-9\" codeSystem=\"2.16.840.1.113883.6.1\"/>"
        "<text representation=\"B64\">{base64}</text></act></entry></section></component>",
        "<component><section><code code=\"47519-4\" codeSystem=\"2.16.840.1.113883.6.1\"/><entry><procedure>"
        "<id root=\"first\"/><id root=\"procedure-{doc}\"/><code code=\"{o_custkey}\" codeSystem=\"oid.proc\" codeSystemName=\"CPT\"/>"
        "<effectiveTime value=\"{day8}\"/></procedure></entry></section></component>",
        "<component><section><code code=\"10160-0\" codeSystem=\"2.16.840.1.113883.6.1\"/><entry><substanceAdministration>"
        "<id root=\"drug-{doc}\"/><statusCode code=\"completed\"/><effectiveTime xsi:type=\"IVL_TS\">{low}<high value=\"{stamp}-0500\"/></effectiveTime>"
        "<effectiveTime xsi:type=\"PIVL_TS\"/><routeCode code=\"{o_orderstatus}\" codeSystem=\"oid.route\"><originalText>by mouth</originalText></routeCode>"
        "<doseQuantity value=\"{c_nationkey}\" unit=\"mg\"/><consumable><manufacturedProduct><manufacturedMaterial>"
        "<code code=\"{o_custkey}\" codeSystem=\"2.16.840.1.113883.6.88\" codeSystemName=\"RxNorm\" displayName=\"{word}\"/>"
        "</manufacturedMaterial></manufacturedProduct></consumable></substanceAdministration></entry></section></component>",
        "{vital_section}{lab_section}</structuredBody></component></ClinicalDocument>",
    ]
    from_phone = F.col("o_orderpriority") == "5-LOW"
    status = F.col("o_orderstatus")
    fields = {
        "day8": F.substring("stamp", 1, 8), "lab_oid": F.lit("2.16.840.1.113883.6.1"),
        "gender_text": F.when(status == "F", F.col("c_mktsegment")).otherwise(""),
        "problem_code": F.when(status == "O", F.lit("404684003")).otherwise("55607006"),
        "base64": F.base64(F.encode(F.concat(F.lit("Text of "), "doc"), "UTF-8")),
        "low": F.when(status != "P", F.concat(F.lit('<low value="'), "stamp", F.lit('"/>'))).otherwise(""),
    }

    def fill(template: str) -> F.Column:
        pieces = []
        for i, piece in enumerate(template.replace("{", "}").split("}")):
            if i % 2 == 0:
                pieces.append(F.lit(piece))
            else:
                pieces.append(fields[piece] if piece in fields else F.col(piece).cast("string"))
        return F.concat(*pieces)

    fields["phone_entry"] = F.when(from_phone, fill(phone)).otherwise("")
    section = f"<component><section>{labs}</section></component>"
    fields["vital_section"] = F.when(from_phone, F.lit("")).otherwise(fill(vitals))
    fields["lab_section"] = F.when(from_phone, F.lit("")).otherwise(fill(section))
    return fill("".join(parts))


def documents(b: Bridge) -> DataFrame:
    path = F.concat(F.lit("/data/"), "person", F.lit("/"), "doc", F.lit(".xml"))
    # Parsing is the costly step: spread the few input splits of the test tables first, before they become long texts.
    orders = b.sql(_ORDERS).withColumn("path", path).repartition("path")
    return ccda.with_person(orders.select("path", _document().alias("xml")), "salt")


def parsed(b: Bridge) -> DataFrame:
    """Parsed once per session; the sections read their columns of the written table."""
    if "parsed documents" not in b._frames:
        b._frames["parsed documents"] = b.stage("staged/documents", ccda.parse_documents(documents(b)))
    return b._frames["parsed documents"]


_D = f"({_ORDERS}) d"
_PERSON = "sha256('salt' || '/data/' || person) as s_person_id"
_DAY = "substr(taken, 1, 10) || ' 00:00:00'"
_LOW = "case when o_orderstatus <> 'P' then taken end"


@check("ccda_rejects", """select '/data/' || doc_id || '/note.xml' as path, 'not well-formed' as reason
        from {documents} where doc_id % 7 = 0""")
def _(b: Bridge):
    """Documents that break off in the middle are reported."""
    texts = b("documents").select(F.concat(F.lit("/data/"), "doc_id", F.lit("/note.xml")).alias("path"), F.concat(
        F.lit('<ClinicalDocument xmlns="urn:hl7-org:v3"><title>'), F.col("lang"),
        F.when(F.col("doc_id") % 7 == 0, F.lit("</ti")).otherwise("</title></ClinicalDocument>")).alias("xml"))
    return ccda.rejected_documents(ccda.parse_documents(ccda.with_person(texts, "salt")))


def _section(name: str, build, columns: str, sql: str) -> None:
    names = columns.split()

    @check(f"ccda_{name}", sql)
    def _(b: Bridge):
        return portable(build(parsed(b)).select(*names))


_section("person", ccda.persons,
         "s_person_id s_id s_gender s_gender_code s_gender_code_type s_gender_code_type_oid s_race_code s_birth_datetime s_source_system",
         f"""select {_PERSON}, 'id-' || person as s_id, case when o_orderstatus = 'F' then c_mktsegment end as s_gender,
         c_mktsegment as s_gender_code, 'Segment' as s_gender_code_type, 'oid.segment' as s_gender_code_type_oid,
         'R' || cast(c_nationkey as string) as s_race_code, '1970-01-02 00:00:00' as s_birth_datetime,
         'c-cda/' || person || '/' || doc || '.xml' as s_source_system from {_D}""")
_section("condition", ccda.conditions,
         "s_person_id s_id s_start_condition_datetime s_end_condition_datetime s_condition_code s_condition_code_type "
         "m_condition_type_code s_condition s_status",
         f"""select {_PERSON}, 'problem-' || doc as s_id, {_LOW} as s_start_condition_datetime,
         {_DAY} as s_end_condition_datetime, cast(o_custkey as string) as s_condition_code,
         'SNOMED' as s_condition_code_type, 'OMOP4976890' as m_condition_type_code, word as s_condition, 'active' as s_status
         from {_D}
         union all select {_PERSON}, 'other-' || doc, null, null, '9', null, 'OMOP4976890', null, null from {_D}
         where o_orderstatus = 'O'""")
_section("procedure", ccda.procedures,
         "s_person_id s_id s_start_procedure_datetime s_procedure_code s_procedure_code_type_oid",
         f"""select {_PERSON}, 'procedure-' || doc as s_id, {_DAY} as s_start_procedure_datetime,
         cast(o_custkey as string) as s_procedure_code, 'oid.proc' as s_procedure_code_type_oid from {_D}""")
_LAB_COLUMNS = ("s_person_id s_id s_obtained_datetime s_name s_code s_result_numeric s_result_unit_code "
                "s_result_unit_code_type_oid s_result_code s_result_text m_result_text s_result_numeric_lower s_result_numeric_upper")
_LABS = f"""select {_PERSON}, 'lab-' || doc as s_id, taken as s_obtained_datetime, word as s_name,
         cast(o_custkey as string) as s_code, amount as s_result_numeric, 'mmHg' as s_result_unit_code,
         '2.16.840.1.113883.6.8' as s_result_unit_code_type_oid, o_orderstatus as s_result_code, 'seen' as s_result_text,
         null as m_result_text, '1' as s_result_numeric_lower, cast(c_nationkey as string) as s_result_numeric_upper
         from {_D} where o_orderpriority <> '5-LOW'
         union all select {_PERSON}, 'text-' || doc, null, null, 'T', null, null, null, null, null, o_orderpriority, null, null
         from {_D} where o_orderpriority <> '5-LOW'
         union all select {_PERSON}, 'phone-' || doc, cast(cast(taken as timestamp) - interval 1 hour as varchar), null, 'P',
         amount, 'lb', '2.16.840.1.113883.6.8', null, null, null, null, null from {_D} where o_orderpriority = '5-LOW'"""
_section("labs", ccda.lab_results, _LAB_COLUMNS, _LABS)
_section("vitals", ccda.vital_results,
         "s_person_id s_id s_obtained_datetime s_name s_code s_result_numeric s_result_unit_code",
         f"""select {_PERSON}, 'vital-' || doc as s_id, taken as s_obtained_datetime, 'Pulse' as s_name, 'V' as s_code,
         cast(c_nationkey as string) as s_result_numeric, null as s_result_unit_code from {_D} where o_orderpriority <> '5-LOW'
         union all select {_PERSON}, 'pulse-' || doc, cast(cast(taken as timestamp) - interval 1 hour as varchar), null, 'W', amount, 'lb'
         from {_D} where o_orderpriority = '5-LOW'""")
_section("medication", ccda.medications,
         "s_person_id s_id s_start_medication_datetime s_end_medication_datetime s_status s_route s_route_code "
         "s_quantity s_dose_unit s_drug_code s_drug_code_type s_drug_text",
         f"""select {_PERSON}, 'drug-' || doc as s_id, {_LOW} as s_start_medication_datetime,
         cast(cast(taken as timestamp) + interval 5 hour as varchar) as s_end_medication_datetime, 'completed' as s_status,
         'by mouth' as s_route, o_orderstatus as s_route_code, cast(c_nationkey as string) as s_quantity,
         'mg' as s_dose_unit, cast(o_custkey as string) as s_drug_code, 'RxNorm' as s_drug_code_type, word as s_drug_text
         from {_D}""")
_section("note", ccda.notes,
         "s_person_id s_id s_note_class s_note_class_code m_note_class_code_type_oid s_note_datetime s_note_text s_note_type_code",
         f"""select {_PERSON}, '0_cda/' || person || '/' || doc || '.xml' as s_id, 'Progress note' as s_note_class,
         'N' || cast(c_nationkey as string) as s_note_class_code, 'oid.note' as m_note_class_code_type_oid,
         taken as s_note_datetime, word || ' & ' || doc || chr(10) as s_note_text, 'OMOP4976890' as s_note_type_code from {_D}
         union all select {_PERSON}, '1_cda/' || person || '/' || doc || '.xml', null, null, null, null,
         'Text of ' || doc, 'OMOP4976890' from {_D}""")


def _fragments(b: Bridge) -> dict[str, DataFrame]:
    return ccda.extract_fragments(parsed(b))


@check("person_consolidation", f"""select {_PERSON}, max(c_mktsegment) as s_gender_code,
        max(case when o_orderstatus = 'F' then c_mktsegment end) as s_gender,
        'c-cda/' || person || '/' || max(doc || '.xml') as s_source_system
        from {_D} group by person""")
def _(b: Bridge):
    """Per column the last non-empty value over a person's documents."""
    return ccda.consolidate_persons(_fragments(b)["source_person"]).select(
        "s_person_id", "s_gender_code", "s_gender", "s_source_system")


@check("unit_cleanup", f"""select s_id, m_unit as m_result_unit_code, m_oid as m_result_unit_code_type_oid from (
        select 'lab-' || doc as s_id, 'mm[Hg]' as m_unit, '2.16.840.1.113883.6.8' as m_oid from {_D} where o_orderpriority <> '5-LOW'
        union all select 'text-' || doc, null, null from {_D} where o_orderpriority <> '5-LOW'
        union all select 'phone-' || doc, '[lb_us]', '2.16.840.1.113883.6.8' from {_D} where o_orderpriority = '5-LOW')""")
def _(b: Bridge):
    return ccda.fix_units(ccda.lab_results(parsed(b))).select("s_id", "m_result_unit_code", "m_result_unit_code_type_oid")


@check("fact_date_repair", f"""select 'problem-' || doc as s_id, case when o_orderstatus <> 'P' then taken else {_DAY} end
        as s_start_condition_datetime, null as i_exclude from {_D}
        union all select 'other-' || doc, null, '1' from {_D} where o_orderstatus = 'O'""")
def _(b: Bridge):
    return ccda.repair_dates("source_condition", ccda.conditions(parsed(b))).select(
        "s_id", "s_start_condition_datetime", "i_exclude")


@check("observation_period_from_facts", f"""select sha256('salt' || '/data/' || person) as s_person_id,
        min(day) as s_start_observation_datetime, max(day) as s_end_observation_datetime from (
          select person, substr(taken, 1, 10) as day from {_D}
          union all select person, substr(cast(cast(taken as timestamp) - interval 1 hour as varchar), 1, 10) from {_D}
          where o_orderpriority = '5-LOW'
          union all select person, substr(cast(cast(taken as timestamp) + interval 5 hour as varchar), 1, 10) from {_D}
          where o_orderstatus = 'P') group by person""")
def _(b: Bridge):
    return ccda.combine_fragments(_fragments(b))["source_observation_period"].select(
        "s_person_id", "s_start_observation_datetime", "s_end_observation_datetime")
