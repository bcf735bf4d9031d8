"""Resharding by minimum-cost flow.

Old shards are cut into blocks by a hash of the row. From the old shards' bytes and the new shards' capacities a
flow that moves the fewest bytes is solved on the graph of shards; each old shard's blocks are then given to
its flows, the largest first, so that what crosses is close to the flow. Only counts of blocks reach the
driver: ``blocks`` times the number of old shards rows, whatever the input.

Defined results: null text has no bytes (size 1). A null key hashes as the empty text. Rows that are equal in
key and text share a block, and any of their orders is a valid one. An empty table gives no rows. Other columns
pass untouched in ``assign``.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsmill.llm import common


def fewest_bytes(supply: list[int], capacity: list[int], cost: list[list[int]] | None = None) -> list[list[int]]:
    """Bytes from each old to each new shard: a minimum-cost flow by successive shortest paths.

    Staying costs nothing and moving one a byte, unless ``cost`` says otherwise. Capacities may sum to more
    than the supply.
    """
    n, m = len(supply), len(capacity)
    if sum(capacity) < sum(supply):
        raise ValueError("capacities are below the supply")
    cost = cost or [[int(i != j) for j in range(m)] for i in range(n)]
    flow = [[0] * m for _ in range(n)]
    left, room = list(supply), list(capacity)
    potential = [0] * (n + m)
    while any(left):
        dist: list[float] = [float("inf")] * (n + m)
        back = [-1] * (n + m)
        queue = [(0, i) for i in range(n) if left[i]]
        for _, i in queue:
            dist[i] = 0
        heapq.heapify(queue)
        while queue:
            d, x = heapq.heappop(queue)
            if d > dist[x]:
                continue
            steps = [(n + j, cost[x][j]) for j in range(m)] if x < n else [(i, -cost[i][x - n]) for i in range(n) if flow[i][x - n]]
            for y, c in steps:
                e = d + c + potential[x] - potential[y]
                if e < dist[y]:
                    dist[y], back[y] = e, x
                    heapq.heappush(queue, (e, y))
        end = min((j for j in range(m) if room[j]), key=lambda j: (dist[n + j] + potential[n + j], j))
        path, x = [], n + end
        while back[x] >= 0:
            path.append((back[x], x))
            x = back[x]
        push = min([left[x], room[end], *(flow[b][a - n] for a, b in path if a >= n)])
        for a, b in path:
            if a < n:
                flow[a][b - n] += push
            else:
                flow[b][a - n] -= push
        left[x] -= push
        room[end] -= push
        potential = [p + min(d, 1 << 40) for p, d in zip(potential, dist, strict=True)]
    return flow


def block_moves(blocks: dict[int, list[tuple[int, int]]], flow: list[list[int]]) -> dict[tuple[int, int], int]:
    """New shard of each block (old shard, block): the largest blocks first, to the flow that lacks most."""
    out, lacks = {}, [sum(row[j] for row in flow) for j in range(len(flow[0]))] if flow else []
    for old in sorted(blocks):
        need = list(flow[old])
        for size, block in sorted(blocks[old], key=lambda x: (-x[0], x[1])):
            to = max(range(len(need)), key=lambda j: (need[j], lacks[j], j == old, -j))
            out[old, block] = to
            need[to] -= size
            lacks[to] -= size
    return out


def blocked(rows: DataFrame, key: Column, old_shard: Column, blocks: int = 1024) -> DataFrame:
    """rows with old_shard and block."""
    return rows.withColumns({"old_shard": old_shard.cast("int"), "block": F.pmod(F.xxhash64(F.lit(7), key), F.lit(blocks)).cast("int")})


def places(held: DataFrame, size: str, old_shards: int, new_shards: int) -> DataFrame:
    """(old_shard, block, shard, before): the new shard of each block of held, and the slot of its first row."""
    counted = held.groupBy("old_shard", "block").agg(F.sum(size).alias("bytes"), F.count("*").alias("n")).collect()
    by_old: dict[int, list[tuple[int, int]]] = {}
    for r in counted:
        by_old.setdefault(r["old_shard"], []).append((r["bytes"], r["block"]))
    supply = [sum(b for b, _ in by_old.get(i, [])) for i in range(old_shards)]
    total = sum(supply)
    capacity = [total // new_shards + (j < total % new_shards) for j in range(new_shards)]
    moves = block_moves(by_old, fewest_bytes(supply, capacity))
    first, taken = [0] * new_shards, []
    for r in sorted(counted, key=lambda r: (r["old_shard"], r["block"])):
        to = moves[r["old_shard"], r["block"]]
        taken.append((r["old_shard"], r["block"], to, first[to]))
        first[to] += r["n"]
    return held.sparkSession.createDataFrame(taken, "old_shard int, block int, shard int, before long")


def slotted(placed: DataFrame, order: list[str]) -> DataFrame:
    """placed (rows with before) with slot, gapless from 0 within each new shard."""
    within = Window.partitionBy("old_shard", "block").orderBy(*order)
    return placed.withColumn("slot", F.col("before") + F.row_number().over(within) - 1).drop("before")


def assign(rows: DataFrame, key: Column, size: str, old_shard: Column, old_shards: int, new_shards: int, blocks: int = 1024) -> DataFrame:
    """rows with old_shard, block, shard (new) and slot, gapless from 0 within each new shard."""
    held = common.Scratch(rows.sparkSession, "resharding").result(blocked(rows, key, old_shard, blocks), "rows")
    return slotted(held.join(F.broadcast(places(held, size, old_shards, new_shards)), ["old_shard", "block"]), rows.columns)


def affected(assigned: DataFrame) -> DataFrame:
    """(shard): the shards whose files change, because rows leave or join them."""
    moved = assigned.where("old_shard <> shard")
    return moved.select("shard").unionAll(moved.select(F.col("old_shard").alias("shard"))).distinct()


def rewrite(assigned: DataFrame, path: str) -> None:
    """Write the affected shards under path, one folder a shard, and remove the folders of those left without rows.

    The other shards' folders stay as they are. assigned can be read from path: new folders replace the old when all are written.
    """
    spark = assigned.sparkSession
    changed = [r["shard"] for r in affected(assigned).collect()]
    if not changed:
        return
    filled = {r["shard"] for r in assigned.select("shard").distinct().collect()}
    assigned.where(F.col("shard").isin(changed)).write.partitionBy("shard").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    for shard in sorted(set(changed) - filled):
        common.remove(spark, f"{path}/shard={shard}")


def reshard(docs: DataFrame, old_shard: Column, old_shards: int, new_shards: int) -> DataFrame:
    """(doc_id, size, text_crc32, old_shard, shard, slot) of the documents as the shards' files hold them at the end.

    The old layout is written with the texts, its affected shards are rewritten, and all is read again: size and
    crc32 are of the texts read, shard is the folder. docs has doc_id, text and source.
    """
    spark = docs.sparkSession
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    size, crc = (F.octet_length(raw) + 1).cast("long"), F.crc32(raw)
    key = F.struct(common.id_text(), "text_crc32")
    source = F.coalesce("source", F.lit("")).alias("source")
    with common.Scratch(spark, "resharding") as scratch:
        path = scratch.folder("shards")
        old = docs.select("doc_id", "text", source, size.alias("size"), crc.alias("text_crc32")).withColumn("old_shard", old_shard.cast("int"))
        layout = f"{', '.join(f'{c} {t}' for c, t in old.dtypes)}, shard int"
        old.withColumn("shard", F.col("old_shard")).write.partitionBy("shard").parquet(path)
        held = blocked(spark.read.schema(layout).parquet(path).drop("old_shard"), key, F.col("shard")).drop("shard")
        of = scratch.table(places(held, "size", old_shards, new_shards), "places")
        rewrite(held.join(F.broadcast(of), ["old_shard", "block"]).select(*old.columns, "shard"), path)
        back = spark.read.schema(layout).parquet(path).select("doc_id", size.alias("size"), crc.alias("text_crc32"), "source", "old_shard", "shard")
        read = common.Scratch(spark, "resharding-rows").result(blocked(back, key, F.col("old_shard")))
        of = common.Scratch(spark, "resharding-places").result(of)
    first = F.broadcast(of.select("old_shard", "block", "before"))
    return slotted(read.join(first, ["old_shard", "block"]), ["doc_id", "size", "text_crc32", "source"])
