"""Consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations only.

The ring is cut into 65,536 cells.  Each shard owns virtual nodes at hashed cells; a key belongs to the first node at or
after its cell.  A shard takes at most its capacity; keys that overflow it continue clockwise to the next shard with room.
Capacities add up to the number of rows, so every shard ends at its capacity: counts differ by one at most.

Who overflows depends on counts alone: one row per arc between nodes, a number that the ring fixes and the data does not
change.  These counts are planned on the driver; the rows get their place from their rank in the arc.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtlake.llm.common import stored

CELL_BITS = 16
#: Ranges that the rows of one arc are ranked in: by cell, then by id, so that a common key is many tasks.
SALTS = 64


def ring(shards: int, virtual_nodes: int) -> list[tuple[int, int]]:
    """Nodes (cell, shard) by cell; on a shared cell the smaller hash wins."""
    best: dict[int, tuple[bytes, int]] = {}
    for shard in range(shards):
        for k in range(virtual_nodes):
            digest = hashlib.sha256(f"{shard}/{k}".encode()).digest()
            cell = int.from_bytes(digest[:8], "big") >> (64 - CELL_BITS)
            best[cell] = min(best.get(cell, (digest, shard)), (digest, shard))
    return sorted((cell, shard) for cell, (_, shard) in best.items())


def capacities(rows: int, shards: int) -> list[int]:
    """Row limits that differ by one at most and add up to `rows`."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def plan(arcs: list[int], counts: dict[int, int], limits: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Ranges (arc, first rank, end rank, shard, first slot) for arcs owned by shards, given the rows of each arc.

    Every shard first takes the rows of its own arcs, in ring order, up to its limit.  What overflows an arc moves
    clockwise and fills the shards it meets that have room, arcs in ring order.
    """
    room = list(limits)
    slots = [0] * len(limits)
    out, waiting = [], []

    def take(arc: int, first: int, n: int, shard: int) -> None:
        out.append((arc, first, first + n, shard, slots[shard]))
        slots[shard] += n
        room[shard] -= n

    for arc, shard in enumerate(arcs):
        n = counts.get(arc, 0)
        own = min(n, room[shard])
        if own:
            take(arc, 0, own, shard)
        if n > own:
            waiting.append((arc, own, n - own))
    for arc, first, n in waiting:
        at = arc
        while n:
            at = (at + 1) % len(arcs)
            more = min(n, room[arcs[at]])
            if more:
                take(arc, first, more, arcs[at])
                first, n = first + more, n - more
    return out


def shard_rows(documents: DataFrame, shards: int = 40, virtual_nodes: int = 64, id_col: str = "doc_id", text_col: str = "text", base_size: int = 16) -> DataFrame:
    """One row per row: doc_id, size (UTF-8 bytes of the text plus `base_size`), text_crc32, law ('rows'), shard, slot
    (gapless from 0 in each shard), grown_shard (null: the bounded law depends on counts).

    The key on the ring is the text, so that copies stay together unless a shard fills up among them.  A null text counts
    as empty.  Rows that repeat an id or are equal in all columns each get a slot of their own; null ids are kept.  An
    empty table gives no rows.  Other columns are ignored.
    """
    spark = documents.sparkSession
    nodes = ring(shards, virtual_nodes)
    arcs = [shard for _, shard in nodes]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    hashed = F.xxhash64(text)
    rows = documents.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + base_size).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.shiftrightunsigned(hashed, 64 - CELL_BITS).cast("int").alias("cell"), hashed.alias("position"), F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(SALTS)).cast("int").alias("salt"),
    )
    rows = stored(rows)
    # a cell's arc is the first node at or after it; behind the last node the first one follows
    starts = spark.createDataFrame([(nodes[i - 1][0] + 1 if i else 0, cell, i) for i, (cell, _) in enumerate(nodes)] + ([(nodes[-1][0] + 1, 2**CELL_BITS - 1, 0)] if nodes[-1][0] < 2**CELL_BITS - 1 else []), "low int, high int, arc int")
    cells = starts.select("arc", F.explode(F.sequence("low", "high")).alias("cell"))
    placed = rows.join(F.broadcast(cells), "cell")
    groups = stored(placed.groupBy("arc", "cell", "salt").agg(F.count(F.lit(1)).alias("n")))
    per_arc = {r.arc: r.n for r in groups.groupBy("arc").agg(F.sum("n").alias("n")).collect()}
    ranges = spark.createDataFrame(plan(arcs, per_arc, capacities(sum(per_arc.values()), shards)), "arc int, low long, high long, shard int, base long")
    before = F.coalesce(F.sum("n").over(Window.partitionBy("arc").orderBy("cell", "salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = groups.select("cell", "salt", "arc", before.alias("before"))
    own = F.row_number().over(Window.partitionBy("cell", "salt").orderBy("position", "doc_id", "size", "text_crc32")) - 1
    ranked = rows.select("doc_id", "size", "text_crc32", "cell", "salt", own.alias("own")).join(offsets, ["cell", "salt"])
    ranked = ranked.select("doc_id", "size", "text_crc32", "arc", (F.col("own") + F.col("before")).alias("rank"))
    found = ranked.join(F.broadcast(ranges), "arc").filter((F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("base") + F.col("rank") - F.col("low")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
