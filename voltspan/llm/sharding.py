"""Sharding on a consistent-hash ring with virtual nodes and bounded loads, DataFrame functions only.

The ring has a fixed number of points. A document's id picks its point, and each point belongs to
the shard whose virtual node comes next clockwise. A shard takes points in ring order until it is
full (the mean load and a little room); the points left over go on clockwise to the next other shard,
round after round, until all have a place. Some shard always has room, because the ceilings add up to
more than the whole. A point that alone holds more than ``HEAVY`` of a shard's mean load and four times
the mean point's, as one id that repeats does, is split by rows into slices of ``SLICE``, which overflow
clockwise one by one; so a shard exceeds its ceiling by less than one point or slice.

Defined results: null text has 0 bytes and checksum 0; a null id is replaced by the text's digest;
repeated rows share a point and get slots of their own; an empty table stays empty. Columns of the documents
that are named like an added one (``size``, ``text_crc32``, ``shard``, ``slot``) are kept as ``own_size`` and so on.

Scale: the driver sees one row per ring point and slice, never documents. Only rows' own columns are shuffled,
by ring point and slice, to number them; slots start where the shard's earlier points and slices end. Rows of
heavy points are written once before they are numbered, so that their slices stay the same when a task is repeated.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voltspan.llm.common import free_name, row_key
from voltspan.session import stage

POINTS = 16_384
VIRTUAL_NODES = 64
ROOM = 0.0002
# parts of a shard's mean load: a point of more than the first is split into slices of about the second
HEAVY, SLICE = 0.002, 0.0005
ADDED = ("size", "text_crc32", "shard", "slot")


def ring(shards: int, virtual_nodes: int = VIRTUAL_NODES, points: int = POINTS) -> list[list[int]]:
    """For each ring point, all shards in the order in which a key meets them clockwise.

    A virtual node stands on the point its name hashes to; on a shared point the lower shard is met
    first. The nodes of the other shards stay where they are when a shard is added.
    """
    nodes = sorted(
        (int(hashlib.md5(f"{s}/{v}".encode()).hexdigest()[:15], 16) % points, s)
        for s in range(shards)
        for v in range(virtual_nodes)
    )
    places = [p for p, _ in nodes]
    orders = []
    for at in range(len(nodes)):
        met: dict[int, None] = {}
        for step in range(len(nodes)):
            met.setdefault(nodes[(at + step) % len(nodes)][1])
            if len(met) == shards:
                break
        orders.append(list(met))
    return [orders[bisect_left(places, p) % len(nodes)] for p in range(points)]


def assign(
    loads: list[int], shards: int, virtual_nodes: int = VIRTUAL_NODES, room: float = ROOM, places: list[int] | None = None, points: int = 0
) -> list[int]:
    """A shard for each piece under bounded loads; ``loads`` are the pieces' sizes.

    Piece i is ring point i, or stands on point ``places[i]`` of ``points``; pieces come in ring order.
    """
    orders, held = ring(shards, virtual_nodes, points or len(loads)), [0] * shards
    places = places or list(range(len(loads)))
    ceiling, placed, waiting = sum(loads) * (1 + room) / shards, [-1] * len(loads), list(range(len(loads)))
    for step in range(shards):
        left = []
        for i in waiting:
            shard = orders[places[i]][step]
            if held[shard] < ceiling or not loads[i]:
                placed[i], held[shard] = shard, held[shard] + loads[i]
            else:
                left.append(i)
        waiting = left
    return placed


def ring_point(key: Column, points: int = POINTS) -> Column:
    digits = F.substring(F.md5(key), 1, 15)
    return F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(points)).cast("int")


def _lookup(values: list[int], at: Column, kind: str) -> Column:
    """One value per ring point as a folded constant array: no join, no shuffle."""
    return F.get(F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>"), at)


def shard(
    docs: DataFrame, shards: int = 8, virtual_nodes: int = VIRTUAL_NODES, room: float = ROOM, points: int = POINTS, lean: bool = False
) -> DataFrame:
    """``docs`` with size, text_crc32, shard and slot (gapless from 0 in each shard); with ``lean``, doc_id alone is carried."""
    taken = {n.lower() for n in ADDED}
    docs = docs.withColumnsRenamed({c: free_name(docs, f"own_{c.lower()}") for c in docs.columns if c.lower() in taken})
    point, order, piece = free_name(docs, "_point"), free_name(docs, "_order"), free_name(docs, "_piece")
    key = row_key(F.col("doc_id"), F.col("text"))
    added = {
        "size": F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1,
        "text_crc32": F.coalesce(F.crc32("text"), F.lit(0)).cast("long"),
    }
    rows = docs.withColumns({**added, point: ring_point(key, points), order: F.xxhash64(key)})
    rows = rows.select("doc_id", "size", "text_crc32", point, order) if lean else rows
    # at most one row per ring point
    cells = {p: (size, n) for p, size, n in rows.groupBy(point).agg(F.sum("size"), F.count("*")).collect()}
    total = sum(size for size, _ in cells.values())
    heavy_from, part = max(HEAVY * total / shards, 4 * total / points), SLICE * total / shards
    slices = [math.ceil(cells[p][0] / part) if p in cells and cells[p][1] > 1 and cells[p][0] > heavy_from else 1 for p in range(points)]
    starts, held = [], 0
    for n in slices:
        starts.append(held)
        held += n
    loads, counts = [0] * held, [0] * held
    for p, (size, n) in cells.items():
        if slices[p] == 1:
            loads[starts[p]], counts[starts[p]] = size, n
    rows = rows.withColumn(piece, _lookup(starts, F.col(point), "int"))
    if max(slices) > 1:
        many = _lookup(slices, F.col(point), "int")
        heavy = rows.filter(many > 1).withColumn(piece, F.col(piece) + F.pmod(F.xxhash64(F.monotonically_increasing_id()), many).cast("int"))
        heavy = stage(heavy, "heavy-points")
        rows = rows.filter(many == 1).unionByName(heavy)
        # as a slice has a fixed part of a shard's load, there are at most shards / SLICE and one for each heavy point
        for i, size, n in heavy.groupBy(piece).agg(F.sum("size"), F.count("*")).collect():
            loads[i], counts[i] = size, n
    places = [p for p, n in enumerate(slices) for _ in range(n)]
    owners, filled, first = assign(loads, shards, virtual_nodes, room, places, points), [0] * shards, []
    for owner, n in zip(owners, counts):
        first.append(filled[owner])
        filled[owner] += n
    inside = Window.partitionBy(piece).orderBy(order, "doc_id", "text_crc32")
    out = rows.withColumn("slot", _lookup(first, F.col(piece), "bigint") + F.row_number().over(inside) - 1)
    return out.withColumn("shard", _lookup(owners, F.col(piece), "int")).drop(point, order, piece)


def _oracle(shards: int = 8, points: int = POINTS) -> str:
    """The same rounds as windows over the table of ring points."""
    ceiling = f"(select sum(size) from d) * cast({1 + ROOM!r} as double) / {shards}"
    rounds, waiting = [], "p"
    for k in range(shards):
        held = " + ".join(["0", *(f"coalesce((select sum(size) from r{j} x where x.shard = a.shard and ok), 0)" for j in range(k))])
        rounds.append(
            f"r{k} as (select a.point, a.size, a.shard, a.met, a.size = 0 or {held} + coalesce(sum(a.size) over "
            f"(partition by a.shard order by a.point rows between unbounded preceding and 1 preceding), 0) < {ceiling} as ok "
            f"from (select point, size, met, met[{k + 1}] as shard from {waiting}" + (" where not ok" if k else "") + ") a)"
        )
        waiting = f"r{k}"
    placed = " union all ".join(f"select point, shard from r{k} where ok" for k in range(shards))
    return f"""
with d as (select doc_id, coalesce(strlen(text), 0) + 1 as size, text,
                  cast(('0x' || substr(md5(coalesce(cast(doc_id as varchar), 't' || md5(text), 'null')), 1, 15)) as bigint) % {points} as point
           from documents),
n as (select s.s, cast(('0x' || substr(md5(s.s || '/' || v.v), 1, 15)) as bigint) % {points} as place
      from range({shards}) s(s), range({VIRTUAL_NODES}) v(v)),
m as (select p.p as point, list(s order by gap, s) as met
      from (select p.p, n.s, min(case when n.place >= p.p then n.place - p.p else n.place - p.p + {points} end) as gap
            from range({points}) p(p), n group by all) p group by p.p),
p as (select m.point, coalesce(x.size, 0) as size, m.met
      from m left join (select point, cast(sum(size) as bigint) as size from d group by point) x using (point)),
{", ".join(rounds)},
placed as ({placed})
select doc_id, size, shard from d join placed using (point)
"""


PLACE_SQL = _oracle()


def placements(docs: DataFrame) -> DataFrame:
    """Where every document goes, without its text. The law kept is that of equal bytes."""
    return shard(docs.select("doc_id", "text"), lean=True).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
