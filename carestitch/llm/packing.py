"""Packing of tokenised documents into training sequences, balanced by estimated cost.

Each task packs what it reads in blocks of bounded size, so nothing is shuffled. In a block, documents in descending
length go to the cheapest sequence with room for them; cost is linear plus quadratic in the lengths of the pieces
(attention stays inside a document). What fits nowhere whole is cut over the rooms that are left, so all sequences but
the block's last tokens are full; those tokens form sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import with_end
from .words import chunks


@dataclass(frozen=True)
class Packing:
    """``block_tokens``: a block is packed when it holds this many. ``linear`` and ``quadratic`` weigh the cost of a
    piece of n tokens, linear * n + quadratic * n * n / capacity."""

    capacity: int = 2048
    block_tokens: int = 2_000_000
    linear: float = 1.0
    quadratic: float = 0.5
    tokenizer: str | None = None


def pack(lengths: list[int], rule: Packing) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of each piece; sequences are numbered from 0 and gapless."""
    room = rule.capacity
    cost = lambda n: rule.linear * n + rule.quadratic * n * n / room
    pieces: list[tuple[int, int, int, int, int]] = []
    sequence = 0
    short: list[tuple[int, int, int]] = []  # (length, document, start)
    for doc, n in enumerate(lengths):
        start = 0
        while n - start >= room:
            pieces.append((doc, start, room, sequence, 0))
            sequence += 1
            start += room
        if n > start:
            short.append((n - start, doc, start))
    full, tail = divmod(sum(n for n, _, _ in short), room)
    used = [0] * full
    cheapest = [(0.0, s) for s in range(full)]
    # Lengths descend: what has no room now is set aside by its room and comes back when a document fits into it.
    aside: list[tuple[int, float, int]] = []
    homeless: list[tuple[int, int, int]] = []
    for n, doc, start in sorted(short, key=lambda x: (-x[0], x[1], x[2])):
        while aside and -aside[0][0] >= n:
            heapq.heappush(cheapest, heapq.heappop(aside)[1:])
        while cheapest and used[cheapest[0][1]] + n > room:
            spent, s = heapq.heappop(cheapest)
            if used[s] < room:
                heapq.heappush(aside, (used[s] - room, spent, s))
        if not cheapest:
            homeless.append((n, doc, start))
            continue
        spent, s = cheapest[0]
        heapq.heapreplace(cheapest, (spent + cost(n), s))
        pieces.append((doc, start, n, sequence + s, used[s]))
        used[s] += n
    rooms = [(s, room - used[s]) for s in range(full) if used[s] < room]
    last = sequence + full
    for bit in range(tail.bit_length() - 1, -1, -1):
        if tail >> bit & 1:
            rooms.append((last - sequence, 1 << bit))
            used.append(0)
            last += 1
    at = 0
    for n, doc, start in homeless:
        while n:
            s, free = rooms[at]
            part = min(n, free)
            pieces.append((doc, start, part, sequence + s, used[s]))
            used[s] += part
            rooms[at] = (s, free - part)
            at += part == free
            start, n = start + part, n - part
    return pieces


_OUT = {"doc_id": pa.int64(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "doc_tokens": pa.int64(),
        "sequence_id": pa.int64(), "offset": pa.int64(), "ids": pa.list_(pa.int32())}


def _pack_blocks(rule: Packing, keep_ids: bool):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        ids: list[int | None] = []
        tokens: list[np.ndarray] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal first, held
            pieces = pack([len(t) for t in tokens], rule)
            for i in range(0, len(pieces), 5000):
                some = pieces[i:i + 5000]
                cut = [tokens[d][a:a + n] for d, a, n, _, _ in some]
                columns = [
                    [ids[p[0]] for p in some], [p[1] for p in some], [p[2] for p in some], [zlib.crc32(c.astype("<u4").tobytes()) for c in cut],
                    [len(tokens[p[0]]) for p in some], [first + p[3] for p in some], [p[4] for p in some],
                ]
                if keep_ids:
                    columns.append([c.astype(np.int32) for c in cut])
                kinds = list(_OUT.items())[:len(columns)]
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(columns, kinds, strict=True)], [k for k, _ in kinds])
            first += max((p[3] for p in pieces), default=-1) + 1
            ids.clear()
            tokens.clear()
            held = 0

        for part in chunks(batches, "text"):
            for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                ids.append(doc)
                tokens.append(with_end(text, rule.tokenizer))
                held += len(tokens[-1])
                if held >= rule.block_tokens:
                    yield from flush()
        if tokens:
            yield from flush()

    return blocks


def pack_documents(docs: DataFrame, rule: Packing = Packing(), keep_ids: bool = True, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, with ``keep_ids``, ids.

    Null and empty texts are one piece with the end mark alone. Repeated rows and rows without an id are documents of
    their own (``start`` then counts within the row). Longer documents than a sequence are cut; every id lies in one
    piece. Other columns are not looked at. An empty table gives an empty result. Which documents share a sequence
    depends on how Spark splits the input; each sequence id is unique in the result.
    """
    kind = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + (", ids array<int>" if keep_ids else "")
    return docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(_pack_blocks(rule, keep_ids), kind)
