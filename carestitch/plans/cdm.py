"""CDM tables out of staging tables and a codebook, one lazy plan per table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import FANOUT_BITS, duplicate_keys, fact_id, stable_id, staged_id
from ..operators.joins import align_to_person, align_to_visit, key_table, lookup
from ..operators.project import align, exclude_rows, rename_columns, stamp_lineage, union_by_name
from ..operators.resolve import resolve_fanout, resolve_fields, used_pairs
from ..operators.route import combine, in_domain, in_domain_or_unknown
from ..operators.vocab import BooksOnDemand, Codebook, FieldBooks, field_name
from ..specs import cdm_spec, psf_spec
from ..specs.cdm import LINEAGE, NAMES_IN_531, normalise_version
from . import builds as B

# What facts are linked to: table, natural key, surrogate.
LINKS = {
    "location": ("location", ("location_source_value",), "location_id"),
    "care_site": ("care_site", ("care_site_source_value",), "care_site_id"),
    "provider": ("provider", ("provider_source_value",), "provider_id"),
    "person": ("person", ("person_source_value",), "person_id"),
    "visit": ("visit_source_link", ("s_encounter_id", "s_person_id"), "visit_occurrence_id"),
}


@dataclass
class StableIds:
    """Hash-based person and visit keys instead of staging row ids.

    must_be_unique  stop when two rows share a hashed key, be it by a repeated source key
                    or by a collision
    """

    salt: str = ""
    person: bool = False
    visit: bool = False
    must_be_unique: bool = False

    def key_of(self, table: str) -> str | None:
        hashed = {"person": self.person, "visit_occurrence": self.visit}
        return f"{table}_id" if hashed.get(table) else None


@dataclass
class CdmBuilder:
    """Builds CDM tables on demand.

    sources      staging tables by name
    codebook     code → concept lookups, one for all fields or one for each, cut at once or table by table
    materialise  called with (name, frame) at every table boundary; the default keeps
                 plans lazy, the batch pipeline writes and reloads
    measure      count materialised key tables (a read of file footers), so that those
                 small enough are broadcast
    keep_columns further staging columns to carry to the materialised fact rows
    waves        the rows of a staging table of facts in parts; ``materialise`` gets a frame for
                 each, to be written one after another
    """

    spark: SparkSession
    sources: Mapping[str, DataFrame]
    codebook: Codebook | FieldBooks | BooksOnDemand
    version: str = "5.4"
    stable: StableIds = field(default_factory=StableIds)
    keep_unmapped: bool = True
    materialise: Callable[[str, DataFrame], DataFrame] = lambda name, df: df
    measure: bool = False
    keep_columns: frozenset[str] = frozenset()
    fanout_bits: int = FANOUT_BITS
    waves: Callable[[str], Sequence[DataFrame]] | None = None
    _sizes: dict[str, int | None] = field(default_factory=dict)
    _tables: dict[str, DataFrame] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.version = normalise_version(self.version)

    def link(self, dimension: str) -> tuple[DataFrame, int | None]:
        """The key table of a dimension and its measured size, if measured."""
        name = f"support/{dimension}_keys"
        if name not in self._tables:
            table, keys, surrogate = LINKS[dimension]
            self._tables[name] = self.materialise(name, key_table(self.table(table), keys, surrogate))
            self._sizes[name] = self._tables[name].count() if self.measure else None
        return self._tables[name], self._sizes[name]

    # -- staging rows -----------------------------------------------------------------

    def staged(self, name: str, rows: DataFrame | None = None) -> DataFrame:
        """A staging table (or some rows of it) without its excluded rows, with every column of its layout."""
        df = self.sources[name] if rows is None else rows
        missing = [c for c in psf_spec(name).columns if c not in df.columns]
        df = df.withColumns({c: F.lit(None).cast("string") for c in missing})
        return exclude_rows(df)

    def used_codes(self, builds: Sequence[B.SourceBuild] = (*B.DIMENSIONS, *B.FACTS)) -> DataFrame:
        """The distinct (field, oid, concept_code) of all staging tables: one scan of the
        code columns, combined before any shuffle."""
        parts = []
        for build in builds:
            prefixes = [p for f in build.codes for p in f.candidates]
            prefixes += [build.fanout] if build.fanout else []
            if prefixes:
                parts.append(used_pairs(self.staged(build.source), prefixes, build.source))
        return union_by_name(parts).distinct()

    def field_books(self, whole: Codebook, write: Callable[[str, DataFrame], DataFrame], source: str | None = None) -> FieldBooks:
        """The codes that each field uses, written and measured before any lookup; those of one staging table if it is named."""
        builds = [b for b in (*B.DIMENSIONS, *B.FACTS) if source in (None, b.source)]
        lookups = [field_name(b.source, p) for b in builds for f in b.codes for p in f.candidates]
        fanouts = [field_name(b.source, b.fanout) for b in builds if b.fanout]
        books = whole.by_field(write("support/used_codes", self.used_codes(builds)), lookups, fanouts)
        return FieldBooks(write("support/codes", books.best), write("support/code_targets", books.targets)).measured()

    def _resolved(self, build: B.SourceBuild, rows: DataFrame | None = None) -> DataFrame:
        """Staging rows (all or those given) with codes resolved, persons, visits and dimension keys attached.

        Codes come first: they are map-side lookups and let the code texts be dropped
        before the rows are shuffled to their persons and visits.
        """
        df = self.staged(build.source, rows)
        if build.row_filter:
            df = df.filter(build.row_filter)
        books = self.codebook.of_table(build.source) if build.codes or build.fanout else None
        df = resolve_fields(df, books, build.codes)
        if build.fanout:
            df = resolve_fanout(df, books, build.fanout)
        elif build.domain_column:
            df = df.withColumns({"mapped_domain_id": F.col(build.domain_column),
                                 "domain_id": F.col(build.domain_column)})
        for dimension, key in build.links.items():
            keys, size = self.link(dimension)
            _, (natural,), surrogate = LINKS[dimension]
            df = lookup(df, keys, {key: natural}, {surrogate: surrogate}, unique=True, dim_rows=size)
        if build.person:
            keys, size = self.link("person")
            df = align_to_person(df, keys, unique=True, person_rows=size)
        if build.visit:
            keys, size = self.link("visit")
            df = align_to_visit(df, keys, build.visit, unique=True, visit_rows=size)
        df = stamp_lineage(df, build.source, staged_id(df))
        if build.source == "source_person":
            key = stable_id(self.stable.salt, "s_person_id") if self.stable.person else F.col("g_id")
            df = df.withColumn("g_person_id", key)
        if build.source == "source_encounter":
            key = stable_id(self.stable.salt, "s_encounter_id") if self.stable.visit else F.col("g_id")
            df = df.withColumn("g_visit_id", key)
        return df.withColumns({n: B.column_of(v) for n, v in build.derived.items()}) if build.derived else df

    # -- routes -----------------------------------------------------------------------

    def _project(self, df: DataFrame, build: B.SourceBuild, route: B.Route) -> DataFrame:
        columns = {n: B.column_of(v) for n, v in route.columns.items()}
        if build in B.FACTS:
            ordinal = F.col("g_ordinal") if build.fanout else 0
            columns[B.PRIMARY_KEYS[route.table]] = fact_id(
                "g_id", ordinal, B.CONTRIBUTORS.index(build.source), self.fanout_bits
            )
            if self.version == "5.3.1" and build is B.PROCEDURE:
                # 5.3.1 source procedures have no end.
                columns = {n: c for n, c in columns.items() if "_end_" not in n}
        lineage = [F.col("s_id") if "s_id" in df.columns else F.lit(None).cast("string").alias("s_id"),
                   F.col("g_source_table_name"), F.col("s_g_id")]
        out = df.select(*[c.alias(n) for n, c in columns.items()], *lineage)
        return rename_columns(out, NAMES_IN_531, keep_others=True) if self.version == "5.3.1" else out

    def _routed(self, df: DataFrame, route: B.Route) -> DataFrame:
        if route.or_unknown:
            return df.filter(in_domain_or_unknown(route.domain))
        if route.domain:
            return df.filter(in_domain(route.domain, route.keep_unmapped and self.keep_unmapped))
        return df

    def matched(self, build: B.SourceBuild) -> DataFrame:
        """Resolved rows of a fact source before routing, materialised by domain."""
        name = f"support/{build.source}_matched"
        if name not in self._tables:
            frames = [self._resolved(build, rows) for rows in (self.waves(build.source) if self.waves else [None])]
            frames = [rows.select(*self._routed_columns(build, rows)) for rows in frames]
            self._tables[name] = self.materialise(name, frames if self.waves else frames[0])
        return self._tables[name]

    def visits(self) -> DataFrame:
        """Resolved encounters: read and joined to persons once, for the visits and for their keys."""
        if "support/visits" not in self._tables:
            rows = self._resolved(B.VISIT)
            named = dict.fromkeys([*self._routed_columns(B.VISIT, rows), "g_visit_id", "s_encounter_id", "s_person_id"])
            self._tables["support/visits"] = self.materialise("support/visits", rows.select(*named))
        return self._tables["support/visits"]

    def _routed_columns(self, build: B.SourceBuild, rows: DataFrame) -> list[str]:
        """The columns some route reads. Nothing else is carried through the shuffles to
        persons and visits, nor written."""
        named = set().union(*[B.columns_read(v) for r in build.routes for v in r.columns.values()])
        named |= {"g_id", "g_ordinal", "domain_id", "mapped_domain_id", *LINEAGE, *self.keep_columns}
        return [c for c in rows.columns if c in named]

    def contribution(self, build: B.SourceBuild, table: str) -> DataFrame:
        """What one staging table contributes to one CDM table."""
        (route,) = [r for r in build.routes if r.table == table]
        rows = self.matched(build) if build in B.FACTS else self.visits() if build is B.VISIT else self._resolved(build)
        return align(self._project(self._routed(rows, route), build, route), cdm_spec(table, self.version))

    # -- tables -----------------------------------------------------------------------

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.materialise(name, self._build(name))
            key = self.stable.key_of(name)
            if key and self.stable.must_be_unique and not duplicate_keys(self._tables[name], key).isEmpty():
                raise ValueError(f"{name}: hashed keys are not unique")
        return self._tables[name]

    def _build(self, name: str) -> DataFrame:
        if name == "visit_source_link":
            return self.visits().select(F.col("g_visit_id").alias("visit_occurrence_id"),
                                 "s_encounter_id", "person_id", "s_person_id")
        for build in B.DIMENSIONS:
            if name == build.routes[0].table:
                return self.contribution(build, name)
        if name in B.PRIMARY_KEYS:
            parts = [
                self.contribution(build, name)
                for build in B.FACTS for route in build.routes if route.table == name
            ]
            return combine(parts, cdm_spec(name, self.version))
        if name in B.EMPTY_TABLES or name in B.EMPTY_BY_VERSION[self.version]:
            return cdm_spec(name, self.version).empty(self.spark)
        raise KeyError(f"no such table in CDM {self.version}: {name}")

    def table_names(self) -> list[str]:
        return (
            [b.routes[0].table for b in B.DIMENSIONS]
            + list(B.PRIMARY_KEYS) + list(B.EMPTY_TABLES) + list(B.EMPTY_BY_VERSION[self.version])
        )
