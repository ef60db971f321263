"""Filling containers of fixed capacity with texts, neighbours in content together.

Every text gets a hashed word vector, projected to three dimensions; the vectors' Hilbert key orders the texts along
a space-filling curve, so that neighbours on the curve are alike. The texts are range-partitioned by the key and each
partition is packed in windows of ``WINDOW`` neighbours: largest first, each into the fullest container of the window
that still takes it. Containers left open at a window's end stay open for the next, so that little room is lost at
the seams. A text is split only if it exceeds the capacity: into full containers and one rest, which is packed like
any other text.

Shape of the job: one pass over the texts counts tokens and projects; its narrow result is written once, and only
that is shuffled, by range. Equal keys (copies, empty texts) are spread by the id. A task holds one window.

Defined results: a null or empty text has no tokens and takes a place of size zero; every text comes out once per
capacity and piece; capacities that are null or less than one are left out; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.lineage import cut
from lodestrata.llm.tokens import DIMS, VOCABULARY, sized

WINDOW = 4096
#: Containers that stay open from one window to the next, at most; the fullest are closed first.
OPEN = 256
#: Bits of each dimension on the curve, and the most capacities in one call.
BITS, MAX_CAPACITIES = 10, 1000


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position on the Hilbert curve of integer points (n x dims, each below 2**bits)."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            on = (x[i] & q) != 0
            t = np.where(on, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(on, x[0] ^ p, x[0] ^ t)
            x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where(x[n - 1] & q, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> b & 1)
    return key


class Packer:
    """Packs items of one capacity window by window: best fit, largest first."""

    def __init__(self, capacity: int, first_container: int) -> None:
        self.capacity, self.next = capacity, first_container
        self.room: list[tuple[int, int]] = []  # (room left, container), sorted
        self.order: dict[int, int] = {}  # places used per open container

    def pack(self, sizes: list[tuple[int, int]]) -> Iterator[tuple[int, int, int, int, int, int]]:
        """(item, piece, first token, tokens, container, place) of the items (tokens, item) of one window."""
        rest = []
        for size, item in sizes:
            full, left = divmod(size, self.capacity)
            if full and not left:
                full, left = full - 1, self.capacity
            for piece in range(full):
                yield item, piece, piece * self.capacity, self.capacity, self.next, 0
                self.next += 1
            rest.append((left, item, full))
        for size, item, piece in sorted(rest, reverse=True):
            at = bisect_left(self.room, (size, -1))
            if at < len(self.room):
                room, container = self.room.pop(at)
            else:
                room, container = self.capacity, self.next
                self.next += 1
                self.order[container] = 0
            place = self.order[container]
            self.order[container] = place + 1
            if room > size:
                insort(self.room, (room - size, container))
            else:
                del self.order[container]
            yield item, piece, piece * self.capacity, size, container, place
        for _, container in self.room[: max(0, len(self.room) - OPEN)]:
            del self.order[container]
        self.room = self.room[max(0, len(self.room) - OPEN) :]


_OUT = "pack_id int, doc_id bigint, piece int, start_token bigint, n_tokens bigint, container bigint, place int"


def pack(docs: DataFrame, id_col: str, text_col: str, capacities: list[tuple[int, int]], vocabulary: str = VOCABULARY) -> DataFrame:
    """``pack_id``, ``doc_id``, ``piece``, ``start_token``, ``n_tokens``, ``container``, ``place`` for each (pack_id, capacity)."""
    measured = cut(sized(docs, id_col, text_col, [], vocabulary))
    axes = [f"x{i}" for i in range(DIMS)]
    row = measured.filter("n_tokens > 0").agg(*[f(a) for a in axes for f in (F.avg, F.stddev_pop)]).first()
    centre = np.array([row[2 * i] or 0.0 for i in range(DIMS)])
    spread = np.array([row[2 * i + 1] or 1.0 for i in range(DIMS)]) * 3 + 1e-9

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            unit = (np.clip((batch[axes].to_numpy(float) - centre) / spread, -1, 1) + 1) / 2
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_tokens": batch["n_tokens"], "key": hilbert_keys((unit * ((1 << BITS) - 1)).astype(np.int64))})

    ordered = measured.mapInPandas(keys, "doc_id bigint, n_tokens bigint, key bigint").repartitionByRange("key", "doc_id").sortWithinPartitions("key", "doc_id")

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 40
        packers = [(pack_id, Packer(capacity, first)) for pack_id, capacity in capacities]

        def window(items: list[tuple[int, int]]) -> pd.DataFrame:
            rows = [(p, *r) for p, packer in packers for r in packer.pack(items)]
            return pd.DataFrame(rows, columns=["pack_id", "doc_id", "piece", "start_token", "n_tokens", "container", "place"])

        waiting: list[tuple[int, int]] = []
        for batch in batches:
            waiting += zip(batch["n_tokens"].tolist(), batch["doc_id"].tolist(), strict=True)
            while len(waiting) >= WINDOW:
                yield window(waiting[:WINDOW])
                waiting = waiting[WINDOW:]
        if waiting:
            yield window(waiting)

    return ordered.select("n_tokens", "doc_id").mapInPandas(fill, _OUT)


def capacities_of(table: DataFrame, id_col: str, capacity_col: str) -> list[tuple[int, int]]:
    """The (id, capacity) pairs of a table of at most ``MAX_CAPACITIES`` rows."""
    rows = table.filter(F.col(capacity_col) >= 1).select(id_col, capacity_col).distinct().limit(MAX_CAPACITIES + 1).collect()
    if len(rows) > MAX_CAPACITIES:
        raise ValueError(f"more than {MAX_CAPACITIES} capacities")
    return sorted((int(r[0]), int(r[1])) for r in rows)


def fill_report(packed: DataFrame, capacities: DataFrame) -> DataFrame:
    """Per capacity: containers, tokens, and the share of the containers' room that is filled."""
    used = packed.groupBy("pack_id", "container").agg(F.sum("n_tokens").alias("used"), F.count(F.lit(1)).alias("items"))
    return used.filter("used > 0").groupBy("pack_id").agg(
        F.count(F.lit(1)).alias("containers"), F.sum("used").alias("tokens"), F.max("used").alias("fullest")
    ).join(capacities.select("pack_id", "capacity_tokens"), "pack_id").withColumn(
        "filled", F.round(F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 6)
    )
