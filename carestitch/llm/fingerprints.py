"""I-Match fingerprints with several randomised lexicons.

Terms whose inverse document frequency lies in a band form the lexicon. A fingerprint has one hash for each of several
random parts of the lexicon: of the document's distinct terms in that part, sorted. Parts are of several sizes, so that
short texts meet the large ones and long texts the small ones. Documents are alike as far as their hashes agree.

Document frequencies are counted over all documents in a table of fixed size (terms that fall together share a count),
so the lexicon that goes to the executors is a bit for each place: its size doesn't grow with the data.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import cut
from .words import chunks, codes, mix, words


@dataclass(frozen=True)
class Lexicons:
    """Terms with ``low`` <= log(n / df) / log(n) <= ``high`` of n documents are kept. There are ``parts`` random parts
    for each of the ``scales`` (at most 16); the i-th scale's parts hold one term in 2^i. ``places`` of the frequency table: 2^places."""

    low: float = 0.2
    high: float = 1.0
    parts: int = 32
    scales: int = 14
    places: int = 22
    seed: int = 5


def _term_places(texts: list[str | None], rule: Lexicons) -> tuple[np.ndarray, np.ndarray]:
    """(text, code) of each text's distinct terms, sorted by text and code; the code's upper bits are its place."""
    found = [words(t) for t in texts]
    owner = np.repeat(np.arange(len(texts), dtype=np.uint64), [len(w) for w in found])
    key = np.sort((owner << np.uint64(52)) | (codes([w for ws in found for w in ws]) >> np.uint64(12)))
    key = key[np.concatenate(([True], key[1:] != key[:-1]))] if len(key) else key
    return (key >> np.uint64(52)).astype(np.int64), key & np.uint64((1 << 52) - 1)


def _count(rule: Lexicons):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << rule.places, np.int32)
        for part in chunks(batches, "text"):
            _, code = _term_places(part.column("text").to_pylist(), rule)
            np.add.at(total, (code >> np.uint64(52 - rule.places)).astype(np.int64), 1)
        slice_ = 1 << 14
        for i in range(0, len(total), slice_):
            used = np.flatnonzero(total[i:i + slice_])
            if len(used):
                yield pa.RecordBatch.from_arrays([pa.array([i // slice_]), pa.array([used.astype("<u2").tobytes()]), pa.array([total[i + used].astype("<i4").tobytes()])], ["slice", "used", "df"])

    return count


def lexicon(docs: DataFrame, rule: Lexicons = Lexicons(), text: str = "text") -> bytes:
    """One bit for each place of the frequency table: whether its terms are in the band. 2^places / 8 bytes."""
    n = docs.count()
    bound = (1.0 if n < 2 else n ** (1 - rule.high), float(n) if n < 2 else n ** (1 - rule.low))
    eps = 1e-9

    def band(key: tuple, slices: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(1 << 14, np.int64)
        for used, df in zip(slices["used"], slices["df"], strict=True):
            total[np.frombuffer(used, "<u2")] += np.frombuffer(df, "<i4")
        inside = (total >= max(1, bound[0] - eps)) & (total <= bound[1] + eps)
        return pd.DataFrame({"slice": [key[0]], "bits": [np.packbits(inside).tobytes()]})

    counts = docs.select(F.col(text).alias("text")).mapInArrow(_count(rule), "slice long, used binary, df binary")
    bits = np.zeros((1 << rule.places) // 8, np.uint8)
    for row in counts.groupBy("slice").applyInPandas(band, "slice long, bits binary").collect():  # 2^places / 8 bytes in all
        bits[row["slice"] * 2048:(row["slice"] + 1) * 2048] = np.frombuffer(row["bits"], np.uint8)
    return bits.tobytes()


def _hashes(texts: list[str | None], bits: np.ndarray, rule: Lexicons) -> np.ndarray:
    """16-bit hash for each text, scale and part; 0 for a part that holds none of the text's terms."""
    owner, code = _term_places(texts, rule)
    place = (code >> np.uint64(52 - rule.places)).astype(np.int64)
    inside = np.flatnonzero(bits[place >> 3] >> (7 - (place & 7)).astype(np.uint8) & 1)
    owner, code = owner[inside], code[inside]
    out = np.zeros((rule.scales * rule.parts, len(texts)), np.uint16)
    # Terms come sorted and distinct, so the sum of their mixed codes stands for the list of those in a part.
    worth = mix(code)
    for part in range(rule.parts):
        if part % 4 == 0:  # four parts draw on 16 bits each of one hash
            drawn = mix(code ^ mix(np.full(1, rule.seed * 1000 + part, np.uint64)))
        bits_, owner_, worth_ = (drawn >> np.uint64(16 * (part % 4))).astype(np.uint16), owner, worth
        for scale in range(rule.scales):
            if scale:
                some = np.flatnonzero((bits_ & np.uint16((1 << scale) - 1)) == 0)
                bits_, owner_, worth_ = bits_[some], owner_[some], worth_[some]
            if not len(owner_):
                break
            starts = np.flatnonzero(np.concatenate(([True], owner_[1:] != owner_[:-1])))
            total = mix(np.add.reduceat(worth_, starts))
            out[scale * rule.parts + part, owner_[starts]] = total % np.uint64(65535) + np.uint64(1)
    return np.ascontiguousarray(out.T)


def likeness(a: np.ndarray, b: np.ndarray, rule: Lexicons) -> np.ndarray:
    """Share of agreeing hashes among those that either text has, over the scales whose parts are mostly not all filled.

    There a part holds about one term of either text or none, so the share follows that of the common terms. Equal
    fingerprints have 1.
    """
    some = ((a > 0) | (b > 0)).reshape(len(a), rule.scales, rule.parts)
    same = ((a == b) & (a > 0)).reshape(some.shape)
    sparse = some.mean(axis=2) <= 0.75
    sparse[:, -1] |= ~sparse.any(axis=1)
    held = (some.sum(axis=2) * sparse).sum(axis=1)
    share = (same.sum(axis=2) * sparse).sum(axis=1) / np.maximum(held, 1)
    share = np.where(held == 0, same[:, 0].mean(axis=1), share)
    return np.where((a == b).all(axis=1), 1.0, share)


def fingerprint_texts(texts: list[str | None], bits: bytes, rule: Lexicons) -> tuple[np.ndarray, list[str]]:
    """Hashes by text, and the same as hexadecimal strings."""
    found = _hashes(texts, np.frombuffer(bits, np.uint8), rule)
    return found, [row.astype(">u2").tobytes().hex() for row in found]


def edited(text: str | None, other: str | None) -> str:
    """The text, its last half replaced by as many first code points of the other one (or all it has)."""
    text, half = text or "", len(text or "") // 2
    return text[: len(text) - half] + (other or "")[:half]


_OUT = {"doc_id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(), "edited_fingerprint": pa.string(),
        "near_edited": pa.float64(), "near_next": pa.float64()}


def _follow(bits: bytes, rule: Lexicons):
    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list[tuple] = []
        for part in chunks(batches, "text", 2000):
            rows = last + list(zip(*(part.column(c).to_pylist() for c in ("bucket", "ahead", "doc_id", "text")), strict=True))
            last = rows[-1:]
            pairs = [i for i in range(len(rows) - 1) if rows[i][0] == rows[i + 1][0] and not rows[i][1]]
            own, shown = fingerprint_texts([r[3] for r in rows], bits, rule)
            new = [edited(rows[i][3], rows[i + 1][3]) for i in pairs]
            changed, changed_shown = fingerprint_texts(new, bits, rule)
            at = np.array(pairs, np.int64)
            columns = [
                [rows[i][2] for i in pairs], [len(rows[i][3] or "") for i in pairs], [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in new],
                [shown[i] for i in pairs], changed_shown, likeness(own[at], changed, rule), likeness(own[at], own[at + 1], rule),
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, _OUT.values(), strict=True)], list(_OUT))

    return follow


def document_fingerprints(docs: DataFrame, rule: Lexicons = Lexicons(), id: str = "doc_id", text: str = "text", buckets: int | None = None) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for each row of ``docs``.

    The next document is the one of the next smaller id (then null ids; repeated rows by their text), and of the last
    one the first. Documents are dealt out by ranges of ids, with the head of the next range, so each is compared with
    its neighbour in one pass. Null texts are empty ones; texts without terms of the lexicon have an empty (all zero)
    fingerprint, alike to others of that kind only. Other columns are not looked at; an empty table gives an empty result.
    """
    bits = docs.sparkSession.sparkContext.broadcast(lexicon(docs, rule, text)).value
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.coalesce("doc_id", F.lit(-(1 << 63))))
    many = buckets or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted({int(x) for x in rows.select(F.percentile_approx("key", [i / many for i in range(1, many)], 10000)).first()[0] or []} if many > 1 else set())
    bucket = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]).cast("array<long>"), lambda c: c >= F.col("key"))) if cuts else F.lit(0)
    rows = rows.withColumn("bucket", bucket)
    heads = sorted((r["bucket"], r["head"]) for r in rows.groupBy("bucket").agg(F.max("key").alias("head")).collect())  # one for each range
    before = [(head, heads[i - 1][0]) for i, (_, head) in enumerate(heads)]
    if not before:
        return docs.sparkSession.createDataFrame([], "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    lookup = docs.sparkSession.createDataFrame(before, "key long, previous int")
    ahead = rows.join(F.broadcast(lookup), "key").select("previous", F.lit(True), "key", "doc_id", "text")
    dealt = rows.select("bucket", F.lit(False).alias("ahead"), "key", "doc_id", "text").union(ahead.toDF("bucket", "ahead", "key", "doc_id", "text"))
    dealt = dealt.repartition("bucket").sortWithinPartitions("bucket", "ahead", F.desc("key"), "text").select("bucket", "ahead", "doc_id", "text")
    kinds = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return dealt.mapInArrow(_follow(bits, rule), kinds)
