"""Repeated units (lines, cut further at sentence ends) removed after their earliest occurrence.

Every unit of every whole text is normalised and hashed to 128 bits, and so is every whole line, and every run of lines
around a short one; digests are grouped over the whole corpus by a
partial aggregate that keeps the smallest (document, offset), so a unit in a third of all rows costs one row a task.
All later occurrences are removed; what is left keeps its original offsets.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import cut
from .words import chunks

_CUTS = {
    "paragraph": re.compile(r"\n[^\S\n]*\n\s*"),
    "line": re.compile(r"\n+"),
    "sentence": re.compile(r"\n+|(?<=[.!?])[^\S\n]+"),
}
_MASK = (1 << 64) - 1


def split_units(text: str, unit: str) -> list[tuple[int, int]]:
    """(start, end) of each unit in code points, with the white space that follows it; they tile the text."""
    ends = [m.end() for m in _CUTS[unit].finditer(text)]
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    return [(a, b) for a, b in zip([0, *ends[:-1]], ends, strict=True) if a < b]


def normalise(unit: str) -> list[str]:
    """Words of a unit in lower case; white space and case don't tell units apart."""
    return unit.lower().split()


def _runs(lines: list[list[str]], min_words: int) -> set[tuple[int, int]]:
    """(first, last) of the runs of lines that are compared as a whole: each line of ``min_words`` words or more, and
    around each shorter one the fewest lines after it, and before it, that have as many together."""
    worded = [i for i, words in enumerate(lines) if words]
    found = set()
    for at, i in enumerate(worded):
        if len(lines[i]) >= min_words:
            found.add((i, i))
            continue
        for step in (1, -1):
            total, to = len(lines[i]), at
            while total < min_words and 0 <= to + step < len(worded):
                to += step
                total += len(lines[worded[to]])
            if total >= min_words:
                found.add((min(i, worded[to]), max(i, worded[to])))
    return found


def _digests(text: str, unit: str, min_words: int) -> list[tuple[int, int, int, int]]:
    """(start, end, digest in two halves) of everything that is compared; a range comes once."""
    ranges: dict[tuple[int, int], str] = {}
    pieces = [(a, b, normalise(text[a:b])) for a, b in split_units(text, unit)]
    for start, end, words in pieces:
        if len(words) >= min_words:
            ranges[start, end] = " ".join(words)
    spans = split_units(text, "line") if unit == "sentence" else [(a, b) for a, b, _ in pieces]
    lines = [normalise(text[a:b]) for a, b in spans]
    for i, j in _runs(lines, min_words):
        ranges[spans[i][0], spans[j][1]] = "\n".join(" ".join(words) for words in lines[i:j + 1] if words)
    found = []
    for (start, end), words in ranges.items():
        digest = xxhash.xxh3_128_intdigest(words.encode("utf-8", "surrogatepass"))
        found.append((start, end, (digest >> 64) - (1 << 63), (digest & _MASK) - (1 << 63)))
    return found


def _extract(unit: str, min_words: int):
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            found = [_digests(text or "", unit, min_words) for text in part.column("text").to_pylist()]
            row = pa.array([i for i, units in enumerate(found) for _ in units], pa.int64())
            flat = [x for units in found for x in units]
            new = [pa.array([x[k] for x in flat], pa.int64()) for k in range(4)]
            yield pa.RecordBatch.from_arrays([part.column("id").take(row), part.column("version").take(row), *new], ["id", "version", "start", "end", "d1", "d2"])

    return extract


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_ADDED = {"kept_text": pa.string(), "n_units": pa.int64(), "n_removed": pa.int64(), "kept": pa.list_(_SPAN), "removed": pa.list_(_SPAN)}
_ADDED_DDL = "kept_text string, n_units long, n_removed long, kept array<struct<start:long,end:long>>, removed array<struct<start:long,end:long>>"


def _merge(spans: list[tuple[int, int]]) -> list[dict]:
    found: list[dict] = []
    for a, b in spans:
        if found and found[-1]["end"] == a:
            found[-1]["end"] = b
        else:
            found.append({"start": a, "end": b})
    return found


def _cut_text(text: str | None, drop: list[dict] | None, unit: str) -> dict:
    spans, gone, end = split_units(text or "", unit), set(), 0
    later = sorted((d["start"], d["end"]) for d in drop or ())[::-1]
    for a, _ in spans:
        while later and later[-1][0] <= a:
            end = max(end, later.pop()[1])
        if a < end:
            gone.add(a)
    keep = [s for s in spans if s[0] not in gone]
    return {
        "kept_text": None if text is None else "".join(text[a:b] for a, b in keep),
        "n_units": len(spans), "n_removed": len(spans) - len(keep),
        "kept": _merge(keep), "removed": _merge([s for s in spans if s[0] in gone]),
    }


def _remove(unit: str):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            rows = [_cut_text(text, drop, unit) for text, drop in zip(part.column("text").to_pylist(), part.column("drop").to_pylist(), strict=True)]
            new = [pa.array([r[name] for r in rows], kind) for name, kind in _ADDED.items()]
            yield pa.RecordBatch.from_arrays([part.column("doc"), *new], ["doc", *_ADDED])

    return remove


def remove_repeated_units(docs: DataFrame, unit: str = "sentence", min_words: int = 4, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``kept_text``, ``n_units``, ``n_removed``, ``kept`` and ``removed`` (start and end in code points).

    ``unit``: "sentence" (lines, cut at sentence ends too), "line" or "paragraph". The earliest occurrence is the one
    of the smallest id (null last), then of the earliest place. Repeated rows of one id with the same text are one
    document and share its result; with other texts they are ordered by a hash of the text. A line that occurs
    earlier goes with all its sentences. Units of fewer than ``min_words`` words go with their line, or if they occur
    earlier with the same lines next to them that make up as many words; else they stay. A null text stays null, an empty one empty. All columns of ``docs`` stay; where one has
    the name of a new one, the new one replaces it. An empty table gives an empty result.
    """
    work = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(id).cast("long").alias("id"),
                       F.xxhash64(text).alias("version"), F.col(text).alias("text"))
    units = work.select("id", "version", "text").mapInArrow(_extract(unit, min_words), "id long, version long, start long, end long, d1 long, d2 long")
    place = F.struct(F.col("id").isNull().alias("last"), "id", "version", "start").alias("place")
    repeated = cut(units.groupBy("d1", "d2").agg(F.min(place).alias("first"), F.max(place).alias("final")).where("first <> final").drop("final"), "repeated")
    later = units.join(repeated, ["d1", "d2"]).where(~place.eqNullSafe(F.col("first")))
    drop = cut(later.groupBy("id", "version").agg(F.collect_set(F.struct("start", "end")).alias("drop")), "later")
    matched = work.withColumnRenamed("id", "w_id").withColumnRenamed("version", "w_version").join(
        drop, F.col("w_id").eqNullSafe(F.col("id")) & (F.col("w_version") == F.col("version")), "left")
    kind = docs.schema.simpleString()
    done = matched.select("doc", "text", "drop").mapInArrow(_remove(unit), f"doc {kind}, {_ADDED_DDL}")
    return done.select(*[F.col("doc")[c].alias(c) for c in docs.columns if c not in _ADDED], *_ADDED)
