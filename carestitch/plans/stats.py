"""The descriptive report: 38 statistics over the CDM, each a DataFrame.

n = distinct persons, n_r = rows, p_n = all persons. The person total is a scalar
subquery, not a cross join. Concept joins are inner: concept 0 shows only if the vocabulary
holds a concept 0.

Rows and distinct keys are counted by grouping sets, whatever the number of keys and groups: a statistic reads its
table once, and a report counts each table once for all statistics of it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.percentiles import percentiles_of_counts
from ..sinks.parquet import shared_folder, write_and_reload

Tables = Callable[[str], DataFrame]
#: What is counted: distinct values of a column, over the whole table (None) or by an SQL expression.
Pair = tuple[str | None, str]

_PEOPLE = {"n": "person_id"}
_VISITS = {"n_visits": "visit_occurrence_id"}


def _distinct(columns: dict[str, str]) -> list[Column]:
    return [F.count_distinct(c).alias(out) for out, c in columns.items()]


def _rows() -> Column:
    return F.count(F.lit(1)).alias("n_r")


@dataclass(frozen=True)
class Counts:
    """Counts of one table: a row for each pair (``pair``, its place in ``pairs``) and group, with the group's value in
    the column of its place in ``groups``, the distinct values of the key (``n_distinct``) and the rows (``n_r``)."""

    pairs: tuple[Pair, ...]
    groups: tuple[str, ...]
    rows: DataFrame

    def _of(self, pair: Pair, column: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("pair") == self.pairs.index(pair), F.col(column))), F.lit(0))

    def whole(self, distinct: dict[str, str]) -> DataFrame:
        """One row: each key's distinct values and n_r; zeros for an empty table."""
        pairs = {out: (None, column) for out, column in distinct.items()}
        first = next(iter(pairs.values()))
        return self.rows.agg(*[self._of(pair, "n_distinct").alias(out) for out, pair in pairs.items()], self._of(first, "n_r").alias("n_r"))

    def by(self, group: str, name: str, distinct: dict[str, str]) -> DataFrame:
        """One row for each value of the group, null included: ``name``, each key's distinct values and n_r."""
        pairs = {out: (group, column) for out, column in distinct.items()}
        first = next(iter(pairs.values()))
        chosen = self.rows.filter(F.col("pair").isin([self.pairs.index(pair) for pair in pairs.values()]))
        return chosen.groupBy(F.col(f"g{self.groups.index(group)}").alias(name)).agg(
            *[self._of(pair, "n_distinct").alias(out) for out, pair in pairs.items()], self._of(first, "n_r").alias("n_r"))


def count_pairs(facts: DataFrame, pairs: Iterable[Pair]) -> Counts:
    """All pairs in one pass over ``facts``: distinct (group, key) first, combined before the shuffle and spread by the
    key, so that no group is held in one task; then counts of them by group."""
    pairs = tuple(dict.fromkeys(pairs))
    groups, keys = (tuple(dict.fromkeys(x for x in side if x is not None)) for side in zip(*pairs, strict=True))
    columns = [f"g{i}" for i in range(len(groups))] + [f"k{i}" for i in range(len(keys))]
    sets = [([f"g{groups.index(group)}"] if group is not None else []) + [f"k{keys.index(key)}"] for group, key in pairs]
    plain = facts.select(*[F.expr(e).alias(c) for e, c in zip((*groups, *keys), columns, strict=True)])
    seen = plain.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in columns]).agg(
        F.grouping_id().alias("set"), F.count(F.lit(1)).alias("n"))
    place = F.lit(None).cast("int")
    for i, s in enumerate(sets):
        place = F.when(F.col("set") == sum(1 << (len(columns) - 1 - j) for j, c in enumerate(columns) if c not in s), i).otherwise(place)
    has_key = reduce(or_, [F.col(c).isNotNull() for c in columns[len(groups):]])  # a set holds one key, the others are null
    rows = seen.groupBy(place.alias("pair"), *columns[:len(groups)]).agg(F.count_if(has_key).alias("n_distinct"), F.sum("n").alias("n_r"))
    return Counts(pairs, groups, rows)


@dataclass
class Scans:
    """The tables of a report. Named in ``shared``, a table's pairs are counted together when the first is asked for, and
    the counts written; other pairs are counted as asked for."""

    tables: Tables
    shared: dict[str, list[Pair]] = field(default_factory=dict)
    written: dict[str, Counts] = field(default_factory=dict)

    def __call__(self, name: str) -> DataFrame:
        return self.tables(name)

    def counts(self, table: str, pairs: list[Pair]) -> Counts:
        if not set(pairs) <= set(self.shared.get(table, ())):
            return count_pairs(self.tables(table), pairs)
        if table not in self.written:
            counts = count_pairs(self.tables(table), self.shared[table])
            rows = write_and_reload(counts.rows, f"{shared_folder(counts.rows.sparkSession)}/{table}_counts")
            self.written[table] = Counts(counts.pairs, counts.groups, rows)
        return self.written[table]


def with_person_total(df: DataFrame, scans: Scans) -> DataFrame:
    total = scans.counts("person", [(None, "person_id")]).whole(_PEOPLE).select("n").scalar()
    return df.withColumn("p_n", total)


def with_ratio(df: DataFrame) -> DataFrame:
    """n / p_n beside the counts, for results that have both."""
    if {"n", "p_n"} <= set(df.columns):
        return df.withColumn("n / p_n", F.try_divide(F.col("n"), F.col("p_n")))
    return df


@dataclass(frozen=True)
class _Counted:
    """A statistic made of counts of one table."""

    table: str
    pairs: list[Pair]
    build: Callable[[Counts, Scans], DataFrame]

    def __call__(self, scans: Scans) -> DataFrame:
        return self.build(scans.counts(self.table, self.pairs), scans)


def _total(table: str, distinct: dict[str, str], per_person: bool = True) -> _Counted:
    """Rows and distinct keys of a whole table."""

    def build(counts: Counts, scans: Scans) -> DataFrame:
        return with_person_total(counts.whole(distinct), scans) if per_person else counts.whole(distinct)

    return _Counted(table, [(None, column) for column in distinct.values()], build)


def _concept_names(tables: Tables, key: str, name: str) -> DataFrame:
    return tables("concept").select(F.col("concept_id").alias(key), F.col("concept_name").alias(name))


def _by_person_concept(kind: str) -> _Counted:
    """Persons by gender, race or ethnicity."""
    key, name = f"{kind}_concept_id", f"{kind}_concept_name"

    def build(counts: Counts, scans: Scans) -> DataFrame:
        named = counts.by(key, key, _PEOPLE).join(_concept_names(scans, key, name), key).drop(key)
        return with_person_total(named, scans).orderBy(F.desc("n_r"), name)

    return _Counted("person", [(key, "person_id")], build)


def _by_concept(table: str, key: str, name: str) -> _Counted:
    """Persons and rows per concept. Facts are counted before the names are joined, so
    the join sees one row per concept."""

    def build(counts: Counts, scans: Scans) -> DataFrame:
        return counts.by(key, key, _PEOPLE).join(_concept_names(scans, key, name), key).orderBy(F.desc("n_r"), key)

    return _Counted(table, [(key, "person_id")], build)


def _by_year(table: str, date: str, year: str, rows: bool = True) -> _Counted:
    group, distinct = f"year({date})", {**_PEOPLE, **_VISITS}

    def build(counts: Counts, scans: Scans) -> DataFrame:
        found = counts.by(group, year, distinct)
        return (found if rows else found.drop("n_r")).orderBy(F.desc(year))

    return _Counted(table, [(group, column) for column in distinct.values()], build)


def measurement_concepts(tables: Tables) -> DataFrame:
    """Counts, ranges and exact quartiles per measurement concept and unit.

    The group is the unit's code. One pass over the facts aggregates them by ids, once by value and once by person;
    that is written, as the quartiles read it several times. Codes and names are joined to what is left.
    """
    facts, concept = tables("measurement"), tables("concept")
    ids, keys = ["measurement_concept_id", "unit_concept_id"], ["measurement_concept_id", "unit_concept_code"]
    plain = facts.select(*ids, "person_id", F.col("value_as_number").cast("double").alias("_v"), "measurement_date")
    seen = plain.groupingSets([[*ids, "_v"], [*ids, "person_id"]], *ids, "_v", "person_id").agg(
        F.grouping("_v").alias("_of_person"), F.count(F.lit(1)).alias("_n"), F.min("measurement_date").alias("_first"),
        F.max("measurement_date").alias("_last"))
    folder = shared_folder(facts.sparkSession)
    seen = write_and_reload(seen, f"{folder}/measurements", partition_by="_of_person")
    by_value, by_person = seen.filter("_of_person = 0"), seen.filter("_of_person = 1")
    units = concept.select(F.col("concept_id").alias("unit_concept_id"), F.col("concept_code").alias("unit_concept_code"))
    units = units.join(by_person.select("unit_concept_id").distinct(), "unit_concept_id", "left_semi")
    coded = write_and_reload(by_value.join(units, "unit_concept_id", "left").select(*keys, "_v", "_n", "_first", "_last"), f"{folder}/by_value")
    counts = coded.groupBy(*keys).agg(
        F.sum("_n").alias("n_r"), F.min("_v").alias("min_value_as_number"), F.max("_v").alias("max_value_as_number"),
        F.min("_first").alias("min_measurement_date"), F.max("_last").alias("max_measurement_date"))
    people = by_person.join(units, "unit_concept_id", "left").groupBy(*keys).agg(*_distinct(_PEOPLE))
    # Units that share a code: their counts of a value are added up by the ranks.
    quartiles = percentiles_of_counts(coded.filter("_v is not null").select(*keys, "_v", "_n"), keys, {"p25": 0.25, "p50": 0.5, "p75": 0.75})

    def beside(df: DataFrame, other: DataFrame, how: str) -> DataFrame:
        other = other.withColumnsRenamed({k: f"_{k}" for k in keys})
        return df.join(other, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], how).drop(*[f"_{k}" for k in keys])

    return (
        beside(beside(counts, people, "inner"), quartiles, "left")
        .join(_concept_names(tables, "measurement_concept_id", "measurement_concept_name"), "measurement_concept_id")
        .select("measurement_concept_id", "unit_concept_code", "n", "n_r", "min_value_as_number", "max_value_as_number", "min_measurement_date",
                "max_measurement_date", "p25", "p50", "p75", "measurement_concept_name")
        .orderBy(F.desc("n_r"), "measurement_concept_id", "unit_concept_code")
    )


def top_locations(tables: Tables) -> DataFrame:
    place = ["state", "county", "city"]
    return tables("location").groupBy(*place).agg(_rows()).orderBy(F.desc("n_r"), *place)


def fact_relationships(tables: Tables) -> DataFrame:
    keys = ["domain_concept_id_1", "domain_concept_id_2", "relationship_concept_id"]
    counts = tables("fact_relationship").groupBy(*keys).agg(_rows())
    for key in keys:
        counts = counts.join(_concept_names(tables, key, key.replace("concept_id", "concept_name")), key)
    return counts.orderBy(F.desc("n_r"), *keys)


def unmapped_drugs(tables: Tables) -> DataFrame:
    """Source drugs without a standard concept."""
    source = tables("concept").select(
        F.col("concept_id").alias("drug_source_concept_id"), "concept_code", "vocabulary_id",
        "concept_class_id", "concept_name",
    )
    counts = tables("drug_exposure").filter("drug_concept_id = 0").groupBy(
        "drug_source_value", "drug_source_concept_id"
    ).agg(*_distinct(_PEOPLE), _rows())
    return counts.join(source, "drug_source_concept_id").orderBy(F.desc("n_r"), "drug_source_value")


def _clinical(table: str, key: str, out: str) -> _Counted:
    return _total(table, {**_PEOPLE, **_VISITS, out: key})


STANDARD = {
    "count_people": _total("person", _PEOPLE, per_person=False),
    "count_visits": _total("visit_occurrence", {**_PEOPLE, "n_visit_occurrence_id": "visit_occurrence_id"}),
    "count_deaths": _total("death", _PEOPLE),
    "count_observation_periods": _total(
        "observation_period", {**_PEOPLE, "n_observation_period_id": "observation_period_id"}),
    "count_gender": _by_person_concept("gender"),
    "count_race": _by_person_concept("race"),
    "count_ethnicity": _by_person_concept("ethnicity"),
    "count_conditions": _clinical(
        "condition_occurrence", "condition_occurrence_id", "n_condition_occurrence_id"),
    "count_procedures": _clinical(
        "procedure_occurrence", "procedure_occurrence_id", "n_procedure_occurrence_id"),
    "count_measurements": _clinical("measurement", "measurement_id", "n_measurement_id"),
    "count_observations": _clinical("observation", "observation_id", "n_observation_id"),
    # The next two column names are spelled as the report has them.
    "count_drugs": _clinical("drug_exposure", "drug_exposure_id", "n_drug_expousure_id"),
    "count_devices": _clinical("device_exposure", "device_exposure_id", "d_device_exposure_id"),
    "count_payers": _total(
        "payer_plan_period", {**_PEOPLE, "n_payer_plan_period_id": "payer_plan_period_id"}),
    "count_notes": _clinical("note", "note_class_concept_id", "n_note_class_concept_id"),
    "count_visit_concepts_count": _by_concept("visit_occurrence", "visit_concept_id", "visit_concept_name"),
    "condition_concepts_count": _by_concept(
        "condition_occurrence", "condition_concept_id", "condition_concept_name"),
    "procedure_concepts_count": _by_concept(
        "procedure_occurrence", "procedure_concept_id", "procedure_concept_name"),
    "drug_concepts_count": _by_concept("drug_exposure", "drug_concept_id", "concept_name"),
    "measurement_concepts_count": measurement_concepts,
    "observation_concepts_count": _by_concept("observation", "observation_concept_id", "concept_name"),
    "device_concepts_count": _by_concept("device_exposure", "device_concept_id", "concept_name"),
    "payer_concepts_count": _by_concept("payer_plan_period", "payer_concept_id", "concept_name"),
    "note_concepts_count": _by_concept("note", "note_class_concept_id", "concept_name"),
    "locations_count": _total("location", {"n_location_id": "location_id"}, per_person=False),
    "provider_count": _total("provider", {"n_provider_id": "provider_id"}, per_person=False),
    "top_locations": top_locations,
    "care_site_count": _total("care_site", {"n_care_site_id": "care_site_id"}, per_person=False),
    "fact_relationships_count": fact_relationships,
    "cdm_source": lambda tables: tables("cdm_source"),
}

EXTENDED = {
    "yearly_visit_counts": _by_year("visit_occurrence", "visit_start_date", "visit_year", rows=False),
    "yearly_condition_counts": _by_year("condition_occurrence", "condition_start_date", "condition_year"),
    "yearly_procedure_counts": _by_year("procedure_occurrence", "procedure_date", "procedure_year"),
    "yearly_drug_counts": _by_year("drug_exposure", "drug_exposure_start_date", "drug_year"),
    "yearly_observation_counts": _by_year("observation", "observation_date", "observation_year"),
    "yearly_measurement_counts": _by_year("measurement", "measurement_date", "measurement_year"),
    "yearly_device_counts": _by_year("device_exposure", "device_exposure_start_date", "device_year"),
    "drugs_not_mapped_to_standard_concepts": unmapped_drugs,
}

STATISTICS = {**STANDARD, **EXTENDED}


def statistic(name: str, tables: Tables) -> DataFrame:
    return STATISTICS[name](Scans(tables))


def report(tables: Tables, extended: bool = False) -> dict[str, DataFrame]:
    """All statistics, with the share of persons added where it applies.

    Each table's counts are made here, in one pass over it, and written; the statistics read them. Only the measurements'
    quartiles, the drugs without a standard concept and the top locations read their tables once more.
    """
    chosen = STATISTICS if extended else STANDARD
    scans = Scans(tables)
    scans.shared["person"] = [(None, "person_id")]
    for build in chosen.values():
        if isinstance(build, _Counted):
            scans.shared.setdefault(build.table, []).extend(build.pairs)
    return {name: with_ratio(build(scans)) for name, build in chosen.items()}
