"""Near-duplicate documents by SuperMinHash signatures, banding, exact checks and union-find grouping.

1. Each whole text becomes its set of distinct word shingles, a signature of the set and a digest of the set.
2. Documents with equal sets form a class; from here on one row stands for it, so copies cost one row each.
3. Band keys bring representatives together. In each bucket everyone is checked against its first class: this
   resolves a group of any size in rows proportional to its members. Buckets of more members than a tile holds are
   so checked again, against one of those that are outside their largest component, for some rounds.
4. What that leaves open, pairs inside a bucket that are still in different components, is checked in tiles of
   bounded size. One of such a pair is always outside the bucket's largest component, so members are dealt out once
   for each tile of outsiders. A tile compares signatures first and full sets where the estimate allows the threshold.
5. Links are joined to components without collecting them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .scratch import cut
from .superminhash import band_keys, signatures
from .words import chunks, mix, shingles


@dataclass(frozen=True)
class NearDuplicates:
    """``percent``: link at 100 * intersection >= percent * union. With 24 bands of 4 places a pair of similarity
    0.85 shares no band with a probability of 2e-8. ``slack``: a pair is left unchecked only if its estimate is this
    far below the threshold (5 standard deviations of 96 places). ``tile``: members, and outsiders, of one tile.
    ``rounds``: further centres of a bucket with more members than that; they save work, results don't depend on them."""

    shingle_words: int = 5
    percent: int = 85
    places: int = 96
    bands: int = 24
    slack: float = 0.18
    tile: int = 1500
    rounds: int = 3


def _digests(owner: np.ndarray, element: np.ndarray, sets: int) -> list[np.ndarray]:
    found = []
    for seed in (0x51ED270B, 0xB5297A4D):
        total = np.zeros(sets, np.uint64)
        np.add.at(total, owner, mix(element + np.uint64(seed << 20)))
        found.append(total.view(np.int64))
    return found


def _sign(rule: NearDuplicates):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            owner, element = shingles(part.column("text").to_pylist(), rule.shingle_words)
            ranks = signatures(owner, element, part.num_rows, rule.places)
            size = np.bincount(owner, minlength=part.num_rows)
            one, two = _digests(owner, element, part.num_rows)
            keys = pa.FixedSizeListArray.from_arrays(pa.array(band_keys(ranks, rule.bands).view(np.int64).ravel()), rule.bands)
            low = pa.array([r.tobytes() for r in (ranks >> np.uint64(4)).astype(np.uint8)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("v"), pa.array(size), pa.array(one), pa.array(two), keys.cast(pa.list_(pa.int64())), low],
                ["id", "v", "n", "d1", "d2", "bands", "low"],
            )

    return sign


def _sets(k: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            owner, element = shingles(part.column("text").to_pylist(), k)
            ends = np.cumsum(np.bincount(owner, minlength=part.num_rows))[:-1]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array([x.tobytes() for x in np.split(element, ends)], pa.binary())], ["id", "elements"]
            )

    return sets


def _common(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = _common(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def _verify(percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = batch.column("one_set"), batch.column("two_set")
            keep = [_linked(np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64), percent)
                    for a, b in zip(one, two, strict=True)]
            found = batch.select(["one", "two"]).filter(pa.array(keep, pa.bool_()))
            yield found

    return verify


def _tile_links(rows: list[dict], rule: NearDuplicates) -> tuple[list[int], list[int]]:
    """Links of the tile's outsiders with members of other components; pairs of an earlier shared band are left to it.

    Two outsiders meet twice in a bucket: the pair is checked where the larger id is the outsider."""
    ids = np.array([r["id"] for r in rows], np.int64)
    group = np.array([r["component"] for r in rows], np.int64)
    n = np.array([r["n"] for r in rows], np.int64)
    low = np.frombuffer(b"".join(r["low"] for r in rows), np.uint8).reshape(len(rows), rule.places)
    bands = np.array([r["bands"] for r in rows], np.int64)
    outside = group != rows[0]["main"]
    asks = outside & (np.array([r["o_part"] for r in rows]) == rows[0]["second"])
    answers = np.array([r["part"] for r in rows]) == rows[0]["first"]
    band = rows[0]["band"]
    least = (rule.percent / 100 - rule.slack) * rule.places
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (y := root.get(x, x)) != x:
            x = y
        return x

    sets = [np.frombuffer(r["elements"], np.uint64) for r in rows]
    one: list[int] = []
    two: list[int] = []
    for i in np.flatnonzero(asks).tolist():
        open_ = answers & (group != group[i]) & (~outside | (ids < ids[i]))
        other = np.flatnonzero(open_ & (100 * np.minimum(n, n[i]) >= rule.percent * np.maximum(n, n[i])))
        other = other[(low[other] == low[i]).sum(axis=1) >= least]
        if len(other):
            other = other[(bands[other] == bands[i]).argmax(axis=1) == band]
        for j in other.tolist():
            a, b = find(int(group[i])), find(int(group[j]))
            if a != b and _linked(sets[i], sets[j], rule.percent):
                root[max(a, b)] = min(a, b)
                one.append(int(ids[i]))
                two.append(int(ids[j]))
    return one, two


def _tiles(rule: NearDuplicates):
    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(rows: list[dict]) -> pa.RecordBatch:
            one, two = _tile_links(rows, rule) if len(rows) > 1 else ([], [])
            return pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(two, pa.int64())], ["one", "two"])

        rows: list[dict] = []
        at = None
        for batch in batches:
            for row in batch.to_pylist():
                key = (row["key"], row["first"], row["second"])
                if key != at and rows:
                    yield flush(rows)
                    rows = []
                at = key
                rows.append(row)
        if rows:
            yield flush(rows)

    return tiles


def _pairs_with(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    for side in ("one", "two"):
        pairs = pairs.join(sets.select(F.col("id").alias(side), F.col("elements").alias(f"{side}_set")), side)
    return pairs.select("one", "two", "one_set", "two_set")


def _placed(members: DataFrame, grouped: DataFrame) -> DataFrame:
    """Members of buckets with their components."""
    named = grouped.withColumnRenamed("node", "id")
    return members.join(named, "id", "left").withColumn("component", F.coalesce("component", "id"))


def _open(placed: DataFrame) -> DataFrame:
    """(key, main, largest, members) of buckets with members of more than one component."""
    sizes = placed.groupBy("key", "component").agg(F.count("*").alias("rows"))
    found = sizes.groupBy("key").agg(
        F.max(F.struct("rows", "component")).alias("m"), F.sum("rows").alias("members"), F.count("*").alias("groups"))
    return found.where("groups > 1").select("key", F.col("m.component").alias("main"), F.col("m.rows").alias("largest"), "members")


def _dealt(placed: DataFrame, opened: DataFrame, tile: int) -> DataFrame:
    """Members of open buckets by tile (key, first, second): in each meet the members of part ``first`` and the outsiders
    of part ``second``. A row that is both in a tile is dealt there once."""
    rest = placed.join(opened, "key")
    spread = F.xxhash64("id")
    parts = F.ceil(F.col("members") / F.lit(tile)).cast("int")
    o_parts = F.ceil((F.col("members") - F.col("largest")) / F.lit(tile)).cast("int")
    rest = rest.withColumns({"part": F.pmod(spread, parts).cast("int"), "o_part": F.pmod(spread, o_parts).cast("int")})
    as_member = F.transform(F.sequence(F.lit(0), o_parts - 1), lambda j: F.struct(F.col("part").alias("first"), j.alias("second")))
    as_outsider = F.transform(F.sequence(F.lit(0), parts - 1), lambda i: F.struct(i.alias("first"), F.col("o_part").alias("second")))
    tiles = F.when(F.col("component") == F.col("main"), as_member).otherwise(F.array_distinct(F.concat(as_member, as_outsider)))
    return rest.withColumn("t", F.explode(tiles)).select("key", "band", "id", "component", "main", "part", "o_part", "t.first", "t.second")


def near_duplicates(
    docs: DataFrame, rule: NearDuplicates = NearDuplicates(), id: str | Column = "doc_id", text: str | Column = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, version, group) for each row of ``docs``.

    ``component_id`` is the smallest id reachable over links, ``kept`` whether it is the row's own. Null or empty
    texts have no shingles and are linked with nothing; so are rows without an id (component null, kept). Equal rows
    have equal results. Rows of one id with different texts are documents of their own, which links join only where
    the texts are near; ``version`` (a hash of the text) tells them apart, ``group`` the components (null where there
    are no links by rule). Other columns are not looked at. An empty table gives an empty result.
    """
    source = docs.select(F.col(id).cast("long").alias("id") if isinstance(id, str) else id.cast("long").alias("id"),
                         (F.col(text) if isinstance(text, str) else text).alias("text")).withColumn("v", F.xxhash64("text"))
    signed = cut(source.mapInArrow(_sign(rule), "id long, v long, n long, d1 long, d2 long, bands array<long>, low binary"), "signed")
    full = signed.where("n > 0 and id is not null")
    # From here on ``id`` numbers the classes; ``doc`` and ``v`` name a row of each. Two classes may have the same ``doc``.
    one = full.groupBy("d1", "d2", "n").agg(F.min(F.struct("id", "v", "bands", "low")).alias("r"))
    reps = cut(
        one.select("d1", "d2", "n", F.monotonically_increasing_id().alias("id"), F.col("r.id").alias("doc"), "r.v", "r.bands", "r.low"),
        "representatives",
    )
    entries = reps.select("id", F.posexplode("bands").alias("band", "key"))
    shared = cut(entries.groupBy("key").agg(F.min("id").alias("centre"), F.count("*").alias("members")).where("members > 1"), "buckets")
    members = cut(entries.join(shared, "key"), "members")
    needed = reps.join(members.select("id").distinct(), "id", "left_semi").select("id", "doc", F.col("v").alias("doc_v"))
    texts = source.withColumnRenamed("id", "doc_id").join(needed, (F.col("doc_id") == F.col("doc")) & (F.col("v") == F.col("doc_v"))).select("id", "text")
    sets = cut(texts.mapInArrow(_sets(rule.shingle_words), "id long, elements binary").dropDuplicates(["id"]), "sets")

    stars = members.where("id <> centre").select(F.col("id").alias("one"), F.col("centre").alias("two")).distinct()
    schema = "one long, two long"
    links = cut(_pairs_with(stars, sets).mapInArrow(_verify(rule.percent), schema), "star_links")
    grouped = cut(components(links), "grouped")

    # Pairs with a centre are settled: the centre leaves its bucket.
    placed = cut(_placed(members.where("id <> centre").select("key", "band", "id"), grouped), "placed")
    opened = cut(_open(placed), "open")
    for _ in range(rule.rounds):
        large = placed.join(opened.where(F.col("members") > rule.tile), "key").where("component <> main")
        chosen = cut(large.groupBy("key").agg(F.min_by(F.struct("id", "component"), F.xxhash64("id")).alias("c")), "chosen")
        if chosen.isEmpty():
            break
        meets = placed.join(chosen, "key")
        asked = meets.where("component <> c.component").select(F.col("id").alias("one"), F.col("c.id").alias("two")).distinct()
        links = cut(links.union(_pairs_with(asked, sets).mapInArrow(_verify(rule.percent), schema)), "more_links")
        left = placed.join(chosen, "key", "left").where("c is null or id <> c.id").select("key", "band", "id")
        placed = cut(_placed(left, components(links)), "placed")
        opened = cut(_open(placed), "open")
    rest = _dealt(placed, opened, rule.tile)
    rest = rest.join(reps.select("id", "n", "bands", "low"), "id").join(sets, "id")
    rest = rest.repartition("key", "first", "second").sortWithinPartitions("key", "first", "second", "id")
    more = rest.mapInArrow(_tiles(rule), schema)
    grouped = cut(components(links.union(more)), "components")

    placed = reps.select("d1", "d2", "n", "id", "doc").join(grouped.withColumnRenamed("node", "id"), "id", "left")
    placed = cut(placed.select("d1", "d2", "n", "doc", F.coalesce("component", "id").alias("group")), "classes")
    least = placed.groupBy("group").agg(F.min("doc").alias("least"))
    classes = cut(placed.join(least, "group").select("d1", "d2", "n", "group", "least"), "least")
    found = signed.select("id", "v", "n", "d1", "d2").join(classes, ["d1", "d2", "n"], "left")
    linked = (F.col("n") > 0) & F.col("id").isNotNull()
    component = F.when(linked, F.col("least")).otherwise(F.col("id"))
    return found.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"), F.col("v").alias("version"), F.when(linked, F.col("group")).alias("group"),
    )
