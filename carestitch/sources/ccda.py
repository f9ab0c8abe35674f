"""C-CDA documents to staging rows.

Documents are rows (path, xml). They are parsed once under one explicit schema; every
section is then an expression over the parsed arrays of its own document, so no section
needs a shuffle or a join, but for the texts that notes refer to (``narrative``). Attribute fields start with an underscore.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.dates import hl7_timestamp
from ..functions.keys import person_key
from ..functions.values import base64_text, blank_to_null, repair_interval
from ..operators.joins import lookup_value_code
from ..operators.project import align, union_by_name
from ..specs import PSF_SPECS
from .ehr_csv import EHR_PERIOD_TYPE

# Code systems, section and entry codes.
LOINC_OID = "2.16.840.1.113883.6.1"
SNOMED_OID = "2.16.840.1.113883.6.96"
UCUM_OID = "2.16.840.1.113883.6.8"
LABS_SECTION = "30954-2"
VITALS_SECTION = "8716-3"
MEDICATIONS_SECTION = "10160-0"
PROCEDURES_SECTION = "47519-4"
PROBLEM_CODES = ("55607006", "404684003")
PHONE_VITALS = "46680005"
PHONE_LABS = "386053000"
NOTE_ACT = "34109-9"
EHR_TYPE = ("EHR", "OMOP4976890", "OHDSI", "ohdsi.type_concept")
UNIT_FIXES = {
    "count/min": "{counts}/min",
    "mmHg": "mm[Hg]",
    "lb": "[lb_us]",
    "[lb_av]": "[lb_us]",
}

_ATTRIBUTES = "_code:string,_codeSystem:string,_codeSystemName:string,_displayName:string"
_CODE = f"struct<{_ATTRIBUTES},originalText:string,translation:array<struct<{_ATTRIBUTES}>>>"
_AT = "struct<_value:string>"
_TIMES = f"array<struct<_value:string,low:{_AT},high:{_AT}>>"
_IDS = "array<struct<_root:string>>"
_OBSERVATION = (
    f"struct<id:{_IDS},code:{_CODE},statusCode:struct<_code:string>,effectiveTime:{_TIMES},"
    f"value:array<struct<`_xsi:type`:string,_value:string,_unit:string,{_ATTRIBUTES},_text:string>>,"
    f"interpretationCode:array<{_CODE}>,"
    f"referenceRange:array<struct<observationRange:struct<value:struct<low:{_AT},high:{_AT}>>>>>"
)
_ENTRY = (
    "struct<"
    f"act:struct<code:{_CODE},effectiveTime:{_TIMES},"
    f"text:struct<_representation:string,_text:string,reference:{_AT}>,"
    f"entryRelationship:array<struct<observation:{_OBSERVATION}>>>,"
    f"procedure:struct<id:{_IDS},code:{_CODE},effectiveTime:{_TIMES}>,"
    f"organizer:struct<code:{_CODE},component:array<struct<observation:{_OBSERVATION}>>>,"
    f"substanceAdministration:struct<id:{_IDS},effectiveTime:{_TIMES},statusCode:struct<_code:string>,"
    f"routeCode:{_CODE},doseQuantity:struct<_value:string,_unit:string>,"
    f"consumable:struct<manufacturedProduct:struct<manufacturedMaterial:struct<code:{_CODE}>>>>>"
)
DOCUMENT_SCHEMA = (
    f"recordTarget struct<patientRole:struct<id:{_IDS},patient:struct<administrativeGenderCode:{_CODE},"
    f"raceCode:{_CODE},ethnicGroupCode:{_CODE},birthTime:{_AT}>>>, "
    f"component struct<structuredBody:struct<component:array<struct<section:struct<code:{_CODE},"
    f"entry:array<{_ENTRY}>>>>>>, entry array<{_ENTRY}>"
)


_UNREADABLE = "_unreadable"


def read_documents(spark: SparkSession, path: str, salt: str) -> DataFrame:
    """Documents below a folder; all files of one folder belong to one person."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xml").option("recursiveFileLookup", True).load(path)
    named = files.select(F.col("_metadata.file_path").alias("path"), _decoded(F.col("content")).alias("xml"))
    return with_person(named, salt)


def _decoded(content: Column) -> Column:
    """A file's text by its byte order mark or the encoding its first line declares; UTF-8 otherwise."""
    start = F.decode(F.substring(content, 1, 200), "ISO-8859-1")
    declared = F.upper(F.regexp_extract(start, r"""encoding\s*=\s*["']([^"']+)""", 1))
    mark = F.hex(F.substring(content, 1, 2))
    text = F.decode(content, "UTF-8")
    for charset in ("ISO-8859-1", "US-ASCII"):
        text = F.when(declared == charset, F.decode(content, charset)).otherwise(text)
    return F.when(mark.isin("FEFF", "FFFE"), F.decode(content, "UTF-16")).otherwise(F.regexp_replace(text, r"\A\x{FEFF}", ""))


def with_person(documents: DataFrame, salt: str) -> DataFrame:
    """(path, xml) with the person key of the folder and the file's short name."""
    folder = F.regexp_replace("path", r"/[^/]*$", "")
    return documents.withColumns({
        "s_person_id": person_key(salt, folder),
        "file": F.regexp_extract("path", r"([^/]+/[^/]+)$", 1),
    })


def parse_documents(documents: DataFrame) -> DataFrame:
    """The documents with their parsed content. Materialise this when several sections
    are extracted: a reader of the written table then touches one section's columns."""
    options = {"valueTag": "_text", "attributePrefix": "_", "columnNameOfCorruptRecord": _UNREADABLE}
    parsed = F.from_xml("xml", f"{DOCUMENT_SCHEMA}, {_UNREADABLE} string", options)
    return documents.withColumn("doc", parsed)


def rejected_documents(parsed: DataFrame) -> DataFrame:
    """Files that are no readable XML, with the reason; they feed no table."""
    empty = F.col("xml").isNull() | (F.trim("xml") == "")
    broken = F.col("doc").isNull() | F.col(f"doc.{_UNREADABLE}").isNotNull()
    return parsed.filter(empty | broken).select("path", F.when(empty, "empty").otherwise("not well-formed").alias("reason"))


# -- expressions over parsed arrays -------------------------------------------------------

def _present(values: Column) -> Column:
    return F.filter(values, lambda v: v.isNotNull())


def _flat(arrays: Column) -> Column:
    return F.flatten(_present(arrays))


def _last(values: Column) -> Column:
    """The last non-null element; null for an empty or missing array."""
    return F.try_element_at(_present(values), F.lit(-1))


def _text(value: Column) -> Column:
    """Text before any child element."""
    return blank_to_null(F.regexp_extract(value, r"^([^<]*)", 1))


def _when(value: Column) -> Column:
    """Date and time in ISO form; other texts as they are."""
    return F.coalesce(hl7_timestamp(value).cast("string"), value)


def _code(stem: str, element: Column, text: str | None = None) -> dict[str, Column]:
    """A code element as the columns of a coded field."""
    columns = {f"{stem}_code": element["_code"], f"{stem}_code_type": element["_codeSystemName"],
               f"{stem}_code_type_oid": element["_codeSystem"]}
    return columns | ({text: _text(element["originalText"])} if text else {})


def _is(element: Column, code: str, system: str) -> Column:
    return (element["_code"] == code) & (element["_codeSystem"] == system)


def _coded_as(items: Column, code: str) -> Column:
    return F.filter(items, lambda item: _is(item["code"], code, SNOMED_OID))


def _sections() -> Column:
    return _present(F.col("doc.component.structuredBody.component.section"))


def _entries(section: str | None = None) -> Column:
    sections = _sections()
    if section:
        sections = F.filter(sections, lambda s: _is(s["code"], section, LOINC_OID))
    return _flat(sections["entry"])


def _organized(entries: Column) -> Column:
    """Observations below the organizers of some entries."""
    return _present(_flat(_present(entries["organizer"])["component"])["observation"])


def _rows(parsed: DataFrame, items: Column, table: str, columns, system: str, extra: dict | None = None) -> DataFrame:
    """One staging row per element of a document's array."""
    exploded = parsed.select("s_person_id", "file", "path", F.posexplode(items).alias("_nth", "_item"))
    made = {"s_person_id": F.col("s_person_id"), "s_source_system": F.concat(F.lit(system), F.col("file")),
            **columns(F.col("_item")), **(extra or {})}
    shaped = exploded.select("path", *[v.alias(n) for n, v in made.items()])
    return align(shaped, PSF_SPECS[table], keep_others=True)


def _ids(item: Column) -> dict[str, Column]:
    return {"s_id": _last(item["id"]["_root"])}


# -- sections -----------------------------------------------------------------------------

def persons(parsed: DataFrame) -> DataFrame:
    """The patient of each document."""
    role = F.col("doc.recordTarget.patientRole")
    patient = role["patient"]
    columns = {
        "s_person_id": F.col("s_person_id"),
        "s_source_system": F.concat(F.lit("c-cda/"), F.col("file")), **_ids(role),
        **_code("s_gender", patient["administrativeGenderCode"], "s_gender"),
        **_code("s_race", patient["raceCode"], "s_race"),
        **_code("s_ethnicity", patient["ethnicGroupCode"], "s_ethnicity"),
        "s_birth_datetime": _when(patient["birthTime"]["_value"]),
    }
    found = parsed.filter(role.isNotNull()).select("path", *[v.alias(n) for n, v in columns.items()])
    return align(found, PSF_SPECS["source_person"], keep_others=True)


def conditions(parsed: DataFrame) -> DataFrame:
    """Problem observations; the second code counts only in documents without the first."""
    observed = _present(_flat(_present(_entries()["act"])["entryRelationship"])["observation"])
    first, second = (_coded_as(observed, code) for code in PROBLEM_CODES)

    def columns(item: Column) -> dict[str, Column]:
        value = _last(item["value"])
        return {
            **_ids(item),
            "s_start_condition_datetime": _when(_last(item["effectiveTime"]["low"]["_value"])),
            "s_end_condition_datetime": _when(_last(item["effectiveTime"]["high"]["_value"])),
            **_code("s_condition", value), "s_condition": value["_displayName"],
            "s_status": item["statusCode"]["_code"],
            **{f"m_condition_type{s}": F.lit(v) for s, v in zip(("_code", "_code_type", "_code_type_oid"), EHR_TYPE[1:])},
        }

    return _rows(parsed, F.when(F.size(first) > 0, first).otherwise(second), "source_condition", columns, "c-cda/")


def procedures(parsed: DataFrame) -> DataFrame:
    def columns(item: Column) -> dict[str, Column]:
        return {**_ids(item), "s_start_procedure_datetime": _when(_last(item["effectiveTime"]["_value"])),
                **_code("s_procedure", item["code"])}

    return _rows(parsed, _present(_entries(PROCEDURES_SECTION)["procedure"]), "source_procedure", columns, "c-cda/")


def _measured(item: Column) -> dict[str, Column]:
    """Physical quantities of an observation's values."""
    quantities = F.filter(item["value"], lambda v: v["_xsi:type"] == "PQ")
    unit = _last(quantities["_unit"])
    known = F.length(unit) > 0
    return {
        "s_result_numeric": _last(quantities["_value"]), "s_result_unit": unit,
        "s_result_unit_code": F.when(known, unit), "s_result_unit_code_type": F.when(known, F.lit("UCUM")),
        "s_result_unit_code_type_oid": F.when(known, F.lit(UCUM_OID)),
    }


def _vital(item: Column) -> dict[str, Column]:
    return {**_ids(item), "s_obtained_datetime": _when(_last(item["effectiveTime"]["_value"])),
            **_code("s", item["code"], "s_name"), **_measured(item)}


def _lab(item: Column) -> dict[str, Column]:
    texts = F.filter(item["value"], lambda v: v["_xsi:type"] == "ST")
    reading = _last(item["interpretationCode"])
    limits = item["referenceRange"]["observationRange"]["value"]
    return {
        **_vital(item), **_code("s_result", reading), "s_result_text": _text(reading["originalText"]),
        "m_result_text": _last(F.transform(texts, lambda v: F.coalesce(v["_value"], v["_text"]))),
        "s_result_numeric_lower": _last(limits["low"]["_value"]),
        "s_result_numeric_upper": _last(limits["high"]["_value"]),
    }


def _phone(item: Column) -> dict[str, Column]:
    return {
        **_ids(item), "s_obtained_datetime": _when(_last(item["effectiveTime"]["low"]["_value"])),
        **_code("s", item["code"]), "s_text": item["code"]["_displayName"], **_measured(item),
        **_code("s_result", _last(item["interpretationCode"])),
    }


def _results(parsed: DataFrame, section: str, columns, phone_code: str) -> DataFrame:
    """Observations of a section, and in documents without any those a phone export keeps
    under an organizer of its own."""
    clinical = _organized(_entries(section))
    everywhere = F.concat(F.coalesce(F.col("doc.entry"), F.array()), F.coalesce(_entries(), F.array()))
    exported = _organized(F.filter(everywhere, lambda e: _is(e["organizer"]["code"], phone_code, SNOMED_OID)))
    none = F.coalesce(F.size(clinical), F.lit(0)) <= 0
    return union_by_name([
        _rows(parsed, clinical, "source_result", columns, "c-cda/"),
        _rows(parsed.filter(none), exported, "source_result", _phone, "cda/"),
    ], fill_missing=True)


def lab_results(parsed: DataFrame) -> DataFrame:
    return _results(parsed, LABS_SECTION, _lab, PHONE_LABS)


def vital_results(parsed: DataFrame) -> DataFrame:
    return _results(parsed, VITALS_SECTION, _vital, PHONE_VITALS)


def medications(parsed: DataFrame) -> DataFrame:
    def columns(item: Column) -> dict[str, Column]:
        drug = item["consumable"]["manufacturedProduct"]["manufacturedMaterial"]["code"]
        return {
            **_ids(item),
            "s_start_medication_datetime": _when(_last(item["effectiveTime"]["low"]["_value"])),
            "s_end_medication_datetime": _when(_last(item["effectiveTime"]["high"]["_value"])),
            "s_status": item["statusCode"]["_code"], **_code("s_route", item["routeCode"], "s_route"),
            "s_quantity": item["doseQuantity"]["_value"], "s_dose_unit": item["doseQuantity"]["_unit"],
            **_code("s_drug", drug), "s_drug_text": drug["_displayName"],
        }

    items = _present(_entries(MEDICATIONS_SECTION)["substanceAdministration"])
    return _rows(parsed, items, "source_medication", columns, "c-cda/")


# An XML text as runs of character data (with the comments, CDATA and instructions among it) and tags.
_RUN = r"(?:[^<]++|(?s:<!--.*?-->)|(?s:<!\[CDATA\[.*?\]\]>)|(?s:<\?.*?\?>))++"
_TAG = r"""<(?:[^<>"']++|"[^"]*+"|'[^']*+')*+>"""
_NARRATIVE_TAG = r"^<(/?)(?:[^\s/>:]+:)?(content|paragraph)(?=[\s/>])"
_ID = r"""^<[^\s>]+(?:\s+(?!ID\s*=)[^\s=]+\s*=\s*(?:"[^"]*"|'[^']*'))*\s+ID\s*=\s*(?:"([^"]*)"|'([^']*)')"""


def _characters(run: Column) -> Column:
    """The text of a run: references resolved, comments left out. References to entities of the document's own stay as they are."""
    known = F.regexp_replace(run, r"&(?!(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9A-Fa-f]+);)", "&amp;")
    plain = F.when(run.contains("<"), run).otherwise(known)
    parsed = F.xpath_string(F.concat(F.lit("<t>"), plain, F.lit("</t>")), F.lit("string(/t)"))
    return F.when(run.contains("&") | run.contains("<"), parsed).otherwise(run)


def _other_tag(token: Column) -> Column:
    """Whether a token is certainly a tag of another element than contents and paragraphs."""
    named = token.contains("content") | token.contains("paragraph")
    return token.startswith("<") & ~token.startswith("<!") & ~token.startswith("<?") & ~named & token.endswith(">")


def narrative(documents: DataFrame) -> DataFrame:
    """(path, reference, narrative): the texts below the content and paragraph elements whose ID is in ``wanted``.

    Each run of text is a line. Contents come before paragraphs, several elements of an ID in their order. References
    without an element are left out. ``documents``: path, xml, wanted. One shuffle, by path; the elements a run lies in
    are the last ones opened before it at each depth up to its own.
    """
    lines = F.regexp_replace("xml", r"\r\n?", "\n")
    token, kinds = F.col("token"), ("content", "paragraph")
    found = F.transform(F.regexp_extract_all(lines, F.lit(f"{_RUN}|{_TAG}"), F.lit(0)), lambda t, i: F.struct(i.alias("pos"), t.alias("token")))
    # Most tags are neither opened nor closed here: they go before they become rows.
    tokens = documents.select("path", "wanted", F.inline(F.filter(found, lambda t: ~_other_tag(t["token"]))))
    kind = F.regexp_extract(token, _NARRATIVE_TAG, 2)
    shut = (F.regexp_extract(token, _NARRATIVE_TAG, 1) == "/")
    name = _characters(F.concat(F.regexp_extract(token, _ID, 1), F.regexp_extract(token, _ID, 2)))
    is_tag = token.rlike(f"^{_TAG}$") & ~token.rlike(r"^<[!?]")
    step = F.when(~is_tag | (kind == "") | token.endswith("/>"), 0).when(shut, -1).otherwise(1)
    marked = tokens.select(
        "path", "pos", step.alias("step"), F.when(step != 0, kind).alias("kind"),
        F.when((step == 1) & token.rlike(_ID) & F.array_contains("wanted", name), name).alias("reference"),
        F.when(~is_tag, token).alias("run")).filter("step <> 0 or run is not null")
    so_far = Window.partitionBy("path").orderBy("pos")
    depths = marked.withColumns({k: F.sum(F.when(F.col("kind") == k, F.col("step")).otherwise(0)).over(so_far).cast("int") for k in kinds})
    at = lambda k, depth: F.struct(F.lit(k).alias("kind"), depth.alias("depth"))
    none = F.array().cast("array<struct<kind:string,depth:int>>")

    def below(k: str) -> Column:
        return F.when(F.col(k) > 0, F.transform(F.sequence(F.lit(1), k), lambda depth: at(k, depth))).otherwise(none)

    opened = F.array(*[F.when((F.col("step") == 1) & (F.col("kind") == k), at(k, F.col(k))) for k in kinds])
    places = depths.filter("step >= 0").select("path", "pos", "reference", "run", F.explode(
        F.when(F.col("step") == 1, F.filter(opened, lambda o: o.isNotNull())).otherwise(F.concat(*map(below, kinds)))).alias("place"))
    before = Window.partitionBy("path", "place.kind", "place.depth").orderBy("pos")
    owner = F.last(F.when(F.col("run").isNull(), F.struct("pos", "reference")), ignorenulls=True).over(before)
    owned = places.withColumn("owner", owner).filter("run is not null and owner.reference is not null")
    owned = owned.select("path", F.col("owner.reference").alias("reference"), F.col("place.kind").alias("kind"), F.col("owner.pos").alias("first"),
                         "pos", _characters(F.col("run")).alias("line")).filter("line <> ''")
    texts = F.array_sort(F.collect_list(F.struct("kind", "first", "pos", "line")))
    return owned.groupBy("path", "reference").agg(F.concat(F.array_join(texts["line"], "\n"), F.lit("\n")).alias("narrative"))


def notes(parsed: DataFrame) -> DataFrame:
    """Note acts with their class; the text is Base64 or lies elsewhere in the document."""
    acts = F.filter(_present(_entries()["act"]), lambda a: _is(a["code"], NOTE_ACT, LOINC_OID))
    coded = parsed.withColumn("_acts", acts).filter(F.size("_acts") > 0)
    wanted = F.transform(_present(F.col("_acts")["text"]["reference"]["_value"]), lambda r: F.substr(r, F.lit(2)))
    texts = narrative(coded.select("path", "xml", wanted.alias("wanted")).filter(F.size("wanted") > 0))
    exploded = coded.select(
        "path", "s_person_id", F.concat(F.lit("cda/"), F.col("file")).alias("s_source_system"), F.posexplode("_acts").alias("_nth", "_item"),
    )
    item = F.col("_item")
    exploded = exploded.withColumn("reference", F.substr(item["text"]["reference"]["_value"], F.lit(2))).join(texts, ["path", "reference"], "left")
    kind = _last(item["code"]["translation"])
    body = item["text"]
    columns = {
        "s_person_id": F.col("s_person_id"),
        "s_id": F.concat(F.col("_nth").cast("string"), F.lit("_"), F.col("s_source_system")),
        "s_note_type": F.lit(EHR_TYPE[0]), "s_note_type_code": F.lit(EHR_TYPE[1]),
        "s_note_type_code_type_oid": F.lit(EHR_TYPE[3]),
        "s_note_class": kind["_displayName"], **_code("s_note_class", kind),
        "m_note_class_code": kind["_code"], "m_note_class_code_type_oid": kind["_codeSystem"],
        "s_note_datetime": _when(_last(item["effectiveTime"]["_value"])),
        "s_note_text": F.when(body["_representation"] == "B64", base64_text(body["_text"]))
        .otherwise(F.when(F.col("reference").isNotNull(), F.coalesce("narrative", F.lit("")))),
        "s_source_system": F.col("s_source_system"),
    }
    shaped = exploded.select("path", *[v.alias(n) for n, v in columns.items()])
    return align(shaped, PSF_SPECS["source_note"], keep_others=True)


def extract_fragments(parsed: DataFrame) -> dict[str, DataFrame]:
    """Every section of the documents as staging rows (with their document's path)."""
    return {
        "source_person": persons(parsed), "source_condition": conditions(parsed),
        "source_procedure": procedures(parsed), "source_medication": medications(parsed),
        "source_result": union_by_name([lab_results(parsed), vital_results(parsed)], fill_missing=True),
        "source_note": notes(parsed),
    }


# -- combining ----------------------------------------------------------------------------

def consolidate_persons(fragments: DataFrame) -> DataFrame:
    """One row per person: per column the last non-empty value in document order."""
    columns = [c for c in fragments.columns if c not in ("s_person_id", "path")]
    latest = [F.max_by(F.col(c), F.when(blank_to_null(c).isNotNull(), F.col("path"))).alias(c) for c in columns]
    return align(fragments.groupBy("s_person_id").agg(*latest), PSF_SPECS["source_person"])


def fix_units(results: DataFrame) -> DataFrame:
    """Units that are not UCUM get their UCUM code as the mapped unit."""
    fixes = results.sparkSession.createDataFrame(list(UNIT_FIXES.items()), "_unit string, _fixed string")
    joined = lookup_value_code(results, fixes, "s_result_unit_code", "_unit", mapping_rows=len(UNIT_FIXES))
    fixed = F.col("_fixed").isNotNull()
    return joined.withColumns({
        "m_result_unit_code": F.coalesce("_fixed", "m_result_unit_code"),
        "m_result_unit_code_type": F.when(fixed, F.col("s_result_unit_code_type")).otherwise(F.col("m_result_unit_code_type")),
        "m_result_unit_code_type_oid": F.when(fixed, F.col("s_result_unit_code_type_oid")).otherwise(F.col("m_result_unit_code_type_oid")),
    }).drop("_fixed")


def repair_dates(table: str, df: DataFrame) -> DataFrame:
    """Starts fall back to ends; rows without any date are excluded."""
    if table == "source_result":
        # A result's own date stands in for its collection date when judging the row.
        dated = repair_interval("s_obtained_datetime", "s_result_datetime", "i_exclude")
        return df.withColumn("i_exclude", dated["exclude"])
    kind = {"source_condition": "condition", "source_medication": "medication"}.get(table)
    if not kind:
        return df
    start = f"s_start_{kind}_datetime"
    fixed = repair_interval(start, f"s_end_{kind}_datetime", "i_exclude")
    return df.withColumns({start: fixed["start"], "i_exclude": fixed["exclude"]})


_DATE_OF = {
    "source_result": ("s_obtained_datetime", "s_result_datetime"),
    "source_procedure": ("s_start_procedure_datetime",),
    "source_condition": ("s_start_condition_datetime",),
    "source_medication": ("s_start_medication_datetime",),
}


def periods_from_facts(tables: dict[str, DataFrame]) -> DataFrame:
    """Per person the first and last day of any dated fact."""
    days = union_by_name([
        tables[name].select(
            "s_person_id",
            F.substring(F.coalesce(*[blank_to_null(c) for c in columns]), 1, 10).alias("day"))
        for name, columns in _DATE_OF.items() if name in tables
    ])
    spans = days.filter("day is not null").groupBy("s_person_id").agg(
        F.min("day").alias("s_start_observation_datetime"), F.max("day").alias("s_end_observation_datetime"))
    typed = spans.withColumns({
        f"m_source{s}": F.lit(v) for s, v in zip(("", "_code", "_code_type", "_code_type_oid"), EHR_PERIOD_TYPE)})
    return align(typed, PSF_SPECS["source_observation_period"])


def combine_fragments(fragments: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Fragments of many documents as one set of staging tables."""
    tables = {"source_person": consolidate_persons(fragments["source_person"])}
    for name, df in fragments.items():
        if name != "source_person":
            fixed = fix_units(df) if name == "source_result" else df
            tables[name] = repair_dates(name, fixed).drop("path")
    tables["source_observation_period"] = periods_from_facts(tables)
    return tables
