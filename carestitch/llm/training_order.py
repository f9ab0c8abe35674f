"""Token sequences written in a keyed random order as shards of fixed stride.

Texts become sequences of equal length (documents joined by the end mark). Each sequence has an index; a keyed Feistel
network permutes the indexes, walking its cycle past values that are no index, so every sequence gets one slot of
0 .. n-1 without sorting or storing a permutation. A shard holds a range of slots. Its file has one record of fixed
size for each slot: a reader that knows the slot knows the file and the place in it, so reading goes on anywhere.
Shards are written beside their name and moved there when complete; a repeated or resumed write keeps complete ones.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scratch import cut, folder, release
from .tokens import with_end
from .words import chunks, mix

_HEAD = 8


@dataclass(frozen=True)
class Order:
    """``length`` ids of a sequence, each of ``id_bytes`` (2 up to 65,536 ids, else 4); ``per_shard`` sequences of a file.
    Shards are written in ``waves``, each a range of slots, so that no shuffle holds the whole corpus."""

    length: int = 1024
    id_bytes: int = 2
    per_shard: int = 4096
    waves: int = 2
    key: int = 20240229
    rounds: int = 6
    tokenizer: str | None = None

    @property
    def stride(self) -> int:
        return _HEAD + self.length * self.id_bytes


def _network(x: np.ndarray, half: int, keys: list[int]) -> np.ndarray:
    left, right = x >> np.uint64(half), x & np.uint64((1 << half) - 1)
    for key in keys:
        left, right = right, left ^ (mix(right + np.uint64(key)) >> np.uint64(64 - half))
    return (right << np.uint64(half)) | left


def permute(index: np.ndarray, n: int, key: int, rounds: int = 6, back: bool = False) -> np.ndarray:
    """A keyed bijection of 0 .. n-1; ``back`` undoes it. The network's domain is below 4 n, so walks are short."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    keys = [int(k) for k in mix(np.arange(rounds, dtype=np.uint64) + mix(np.full(1, key, np.uint64)))]
    x = np.asarray(index).astype(np.uint64)
    todo = np.arange(len(x))
    while len(todo):
        # The last step leaves the halves swapped, so the same steps with the keys in reverse lead back.
        x[todo] = _network(x[todo], half, keys[::-1] if back else keys)
        todo = todo[x[todo] >= np.uint64(n)]
    return x.astype(np.int64)


def slot_column(index: str, n: int, order: Order) -> Column:
    @F.pandas_udf("long")
    def slot(values: pd.Series) -> pd.Series:
        return pd.Series(permute(values.to_numpy(), n, order.key, order.rounds))

    return slot(index)


_PIECES = pa.list_(pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64())]))


def _sequences(order: Order):
    def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, room = TaskContext.get().partitionId(), 0, order.length
        kind = np.uint16 if order.id_bytes == 2 else np.uint32
        held, pieces, rows = [], [], []

        def close() -> None:
            nonlocal n, room, held, pieces
            ids = np.concatenate(held).astype(kind).tobytes()
            rows.append((part, n, order.length - room, ids, pieces, zlib.crc32(ids)))
            n, room, held, pieces = n + 1, order.length, [], []

        def batch() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), _PIECES, pa.int64()]
            made = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["part", "n", "n_tokens", "ids", "pieces", "crc"])
            rows.clear()
            return made

        for some in chunks(batches, "text"):
            for doc, text in zip(some.column("doc_id").to_pylist(), some.column("text").to_pylist(), strict=True):
                ids, at = with_end(text, order.tokenizer), 0
                while at < len(ids):
                    take = min(room, len(ids) - at)
                    held.append(ids[at:at + take])
                    pieces.append({"doc_id": doc, "start": at, "length": take})
                    at, room = at + take, room - take
                    if not room:
                        close()
            if len(rows) >= 500:
                yield batch()
        if held:
            close()
        if rows:
            yield batch()

    return sequences


def _file(path: str, shard: int) -> str:
    return f"{path}/shard-{shard:08d}.bin"


def _write(path: str, n: int, order: Order):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pyarrow.fs.FileSystem.from_uri(path)
        shard, out, name, count, kept = None, None, "", 0, False

        def close() -> pa.RecordBatch:
            if not kept:
                out.close()
                fs.move(name, _file(root, shard))
            return pa.RecordBatch.from_arrays([pa.array([shard]), pa.array([count]), pa.array([kept])], ["shard", "sequences", "kept"])

        for batch in batches:
            for at, slot, n_tokens, ids, crc in zip(*(batch.column(c).to_pylist() for c in ("shard", "slot", "n_tokens", "ids", "crc")), strict=True):
                if at != shard:
                    if shard is not None:
                        yield close()
                    shard, count, name = at, 0, f"{root}/.{uuid.uuid4().hex}.tmp"
                    due = min(order.per_shard, n - shard * order.per_shard) * order.stride
                    kept = fs.get_file_info(_file(root, shard)).size == due
                    out = None if kept else fs.open_output_stream(name)
                if not kept:
                    out.write(np.array([n_tokens, crc], "<u4").tobytes() + ids.ljust(order.stride - _HEAD, b"\0"))
                count += 1
        if shard is not None:
            yield close()

    return write


def write_in_order(docs: DataFrame, path: str, order: Order = Order(), id: str = "doc_id", text: str = "text", replace: bool = False) -> DataFrame:
    """Writes shards, ``index`` (slot, n_tokens, pieces as Parquet) and ``order.json`` below ``path``; returns the index.

    ``path`` is a folder that all executors reach, in a file system that pyarrow opens too. Null and empty texts are the
    end mark alone; rows without an id and repeated rows are documents of their own. The last sequence of each task is
    shorter, its record is filled up with zeros. An empty table writes an index without rows. Which documents share a
    sequence depends on how Spark splits the input. A second write of the same sequences in the same order resumes the
    first one and keeps the files that are complete; what the folder is for stands in ``source.json``, which is written
    first. A folder that was begun for other sequences is an error, or with ``replace`` emptied of its shards.
    """
    source = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    kinds = "part long, n long, n_tokens long, ids binary, pieces array<struct<doc_id:long,start:long,length:long>>, crc long"
    return write_sequences(cut(source.mapInArrow(_sequences(order), kinds), "sequences", "zstd"), path, order, replace)


def _claim(path: str, source: dict, replace: bool) -> None:
    """Says in the folder which sequences it is for; what a stopped run left half written goes."""
    fs, root = pyarrow.fs.FileSystem.from_uri(path)
    fs.create_dir(root)
    name, held = f"{root}/source.json", [f for f in fs.get_file_info(pyarrow.fs.FileSelector(root)) if f.is_file]
    files = [f.path for f in held]
    before = None
    if any(f.endswith("/source.json") for f in files):
        with fs.open_input_stream(name) as said:
            before = json.loads(said.read())
    ours = before == source
    if not ours and any(f.endswith((".bin", ".json")) for f in files):
        if not replace:
            raise ValueError(f"{path} holds other sequences; name an empty folder, or replace them")
        # The shards first: until the last of them is gone the folder says that it is the old one.
        for file in sorted(files, key=lambda f: f.endswith("/source.json")):
            if file.endswith((".bin", ".json")):
                fs.delete_file(file)
    for file in files:
        if file.endswith(".tmp"):
            fs.delete_file(file)
    if not ours:
        with fs.open_output_stream(name) as out:
            out.write(json.dumps(source).encode())


def write_sequences(made: DataFrame, path: str, order: Order = Order(), replace: bool = False) -> DataFrame:
    """Writes a table of sequences (part, n, n_tokens, ids, pieces, crc: the CRC-32 of ids), see ``write_in_order``."""
    spark = made.sparkSession
    parts = made.groupBy("part").agg(F.count("*").alias("in_part"))  # one row for each task that made sequences
    before = F.sum("in_part").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumn("before", F.coalesce(before, F.lit(0)))
    digest = F.sum(F.xxhash64("part", "n", "n_tokens", "crc").cast("decimal(38,0)"))
    total, digest = made.agg(F.count("*"), digest).first()
    _claim(path, asdict(order) | {"sequences": total, "digest": str(digest)}, replace)
    placed = made.join(F.broadcast(parts), "part").withColumn("index", F.col("before") + F.col("n"))
    placed = placed.withColumn("slot", slot_column("index", max(1, total), order)).withColumn("shard", F.floor(F.col("slot") / order.per_shard))
    shards = max(1, -(-total // order.per_shard))
    waves = max(1, min(order.waves, shards))
    written = sum(_write_wave(placed, w * shards // waves, (w + 1) * shards // waves, path, total, order) for w in range(waves))
    if written != total:
        raise RuntimeError(f"{written} of {total} sequences were written")
    fs, root = pyarrow.fs.FileSystem.from_uri(path)
    with fs.open_output_stream(f"{root}/order.json") as out:
        out.write(json.dumps(asdict(order) | {"sequences": total}).encode())
    index = f"{path}/index"
    placed.select("slot", "n_tokens", "pieces").write.mode("overwrite").parquet(index)
    return spark.read.parquet(index)


def _write_wave(placed: DataFrame, first: int, last: int, path: str, total: int, order: Order) -> int:
    """Writes the shards from ``first`` to before ``last``; returns their number of sequences."""
    some = placed.select("shard", "slot", "n_tokens", "ids", "crc").where((F.col("shard") >= first) & (F.col("shard") < last))
    ranged = some.repartition(max(1, last - first), "shard").sortWithinPartitions("shard", "slot")
    report = ranged.mapInArrow(_write(path, total, order), "shard long, sequences long, kept boolean")
    written = report.agg(F.coalesce(F.sum("sequences"), F.lit(0))).first()[0]
    del some, ranged, report
    release(placed.sparkSession)
    return written


def read_in_order(spark: SparkSession, path: str, start: int = 0, end: int | None = None, digests: bool = False) -> DataFrame:
    """(slot, n_tokens, ids, sound) of the slots from ``start`` to before ``end``, each shard read from its first wanted
    record on; with ``digests`` the CRC-32 of the ids as 32-bit numbers (``ids_crc32``) in place of the ids."""
    fs, root = pyarrow.fs.FileSystem.from_uri(path)
    with fs.open_input_stream(f"{root}/order.json") as source:
        said = json.loads(source.read())
    total = said.pop("sequences")
    order, end = Order(**said), min(total, total if end is None else end)

    names = ["slot", "n_tokens", "ids_crc32" if digests else "ids", "sound"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pyarrow.fs.FileSystem.from_uri(path)
        kind = np.dtype("<u2" if order.id_bytes == 2 else "<u4")
        for shard in (s for batch in batches for s in batch.column("id").to_pylist()):
            first, last = max(start, shard * order.per_shard), min(end, (shard + 1) * order.per_shard)
            with fs.open_input_file(_file(root, shard)) as source:
                source.seek((first - shard * order.per_shard) * order.stride)
                for a in range(first, last, 512):
                    b = min(last, a + 512)
                    records = np.frombuffer(source.read((b - a) * order.stride), np.uint8).reshape(b - a, order.stride)
                    head = records[:, :_HEAD].copy().view("<u4")
                    ids = [r[_HEAD:_HEAD + int(m) * order.id_bytes].tobytes() for r, m in zip(records, head[:, 0], strict=True)]
                    sound = [zlib.crc32(i) == c for i, c in zip(ids, head[:, 1].tolist(), strict=True)]
                    values = [np.frombuffer(i, kind).astype("<i4") for i in ids]
                    what = pa.array([zlib.crc32(v) for v in values], pa.int64()) if digests else pa.array(values, pa.list_(pa.int32()))
                    yield pa.RecordBatch.from_arrays([pa.array(range(a, b)), pa.array(head[:, 0].astype(np.int64)), what, pa.array(sound)], names)

    shards = spark.range(start // order.per_shard, -(-end // order.per_shard) if end > start else start // order.per_shard, 1, max(1, -(-(end - start) // order.per_shard)))
    return shards.mapInArrow(read, f"slot long, n_tokens long, {'ids_crc32 long' if digests else 'ids array<int>'}, sound boolean")


def order_digests(docs: DataFrame, path: str | None = None, order: Order = Order()) -> DataFrame:
    """Writes ``docs`` in training order and reads the shards back: slot, shard, n_tokens, ids_crc32, sound, doc_ids, pieces."""
    spark = docs.sparkSession
    path = path or f"{folder(spark)}/shards"
    index = write_in_order(docs, path, order)

    read = read_in_order(spark, path, digests=True).select("slot", "ids_crc32", "sound")
    return read.join(index, "slot").select("slot", F.floor(F.col("slot") / order.per_shard).alias("shard"), "n_tokens", "ids_crc32", "sound",
                                           F.col("pieces.doc_id").alias("doc_ids"), "pieces")
