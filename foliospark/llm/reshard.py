"""Resharding by minimum-cost flow: old shards give to new ones so that the fewest bytes move.

The flow network has one node for each old and each new shard; a byte that stays costs nothing, one
that moves costs one. Successive shortest paths solve it on the driver over shard sums alone. The
flows are then realised on documents: within an old shard, documents are laid end to end and cut where
the flows end. Large documents are laid first and the cuts of each later, smaller class make up for
what the former left over, so a shard ends within about one small document of its capacity.

Order within an old shard comes from hashes of the doc_id and from sums over (old shard, class,
chunk) cells, so no shard is ever sorted or collected in one task, however large it is.

Defined results: a null text has size 1; rows that repeat a doc_id are placed each on its own; a null
old shard is a shard of its own; an empty table gives an empty result. `numbered` gives rows a key, by which
`rewrite` finds each row's place whatever its doc_id is.
"""

from __future__ import annotations

import uuid
from collections import deque

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import discard, materialise, shared_dir, shuffle_width

#: Classes of size in bytes, largest first; each is cut after the sums of the former are known.
CLASSES = (16_384, 4_096, 1_024, 256, 0)
#: The column of row keys.
ROW = "_reshard_row"


def min_cost_flow(supply: list[int], capacity: list[int], cost: list[list[int]]) -> list[list[int]]:
    """Whole-number flows from supplies to capacities (of equal totals) at the least cost: successive shortest paths."""
    n, m = len(supply), len(capacity)
    flow, left, room = [[0] * m for _ in range(n)], list(supply), list(capacity)
    source, sink = n + m, n + m + 1
    while any(left):
        far, back, queue, waits = {source: 0}, {}, deque([source]), {source}
        while queue:
            v = queue.popleft()
            waits.discard(v)
            if v == source:
                edges = [(i, 0) for i in range(n) if left[i]]
            elif v < n:
                edges = [(n + j, cost[v][j]) for j in range(m)]
            elif v < n + m:
                j = v - n
                edges = [(i, -cost[i][j]) for i in range(n) if flow[i][j]] + ([(sink, 0)] if room[j] else [])
            else:
                edges = []
            for u, c in edges:
                if u not in far or far[v] + c < far[u]:
                    far[u], back[u] = far[v] + c, v
                    if u not in waits:
                        waits.add(u)
                        queue.append(u)
        path, v = [], sink
        while v != source:
            path.append((back[v], v))
            v = back[v]
        first, last = path[-1][1], path[0][0] - n
        push = min([left[first], room[last], *(flow[v][u - n] for u, v in path if n <= u < n + m and v < n)])
        left[first] -= push
        room[last] -= push
        for u, v in path:
            if u < n and n <= v < n + m:
                flow[u][v - n] += push
            elif n <= u < n + m and v < n:
                flow[v][u - n] -= push
    return flow


def even_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


def running(df: DataFrame, groups: list[str], value: Column, to: str, order: list[str]) -> DataFrame:
    """Sum of value over the rows before, within groups: first over chunks, then within a chunk."""
    df = df.withColumn("_v", value)
    chunks = df.groupBy(*groups, "_chunk").agg(F.sum("_v").alias("_s"))
    before = chunks.withColumn("_before", F.coalesce(F.sum("_s").over(Window.partitionBy(*groups).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_s")
    keys = [*groups, "_chunk"]
    at = df.join(before, keys)
    inner = F.coalesce(F.sum("_v").over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return at.withColumn(to, F.col("_before") + inner).drop("_v", "_before")


def numbered(docs: DataFrame) -> DataFrame:
    """docs as a table with a key for each row."""
    return materialise(docs.withColumn(ROW, F.monotonically_increasing_id()), "reshard-rows")


def bytes_of(text: str) -> tuple[Column, Column]:
    whole = F.coalesce(F.col(text), F.lit(""))
    return (F.octet_length(whole) + 1).cast("long").alias("size"), F.crc32(whole.cast("binary")).alias("text_crc32")


def reshard(docs: DataFrame, old_shard: Column, capacities: list[int] | None = None, shards: int = 16, text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, old_shard, shard and slot of each row, and its key if docs are
    numbered; shards' bytes are near capacities (even ones if None).

    An old shard j costs nothing to keep as new shard j.
    """
    spark = docs.sparkSession
    key = [c for c in docs.columns if c == ROW]
    order = ["doc_id", "text_crc32", "size", *key]
    at = docs.select("doc_id", *key, *bytes_of(text), F.coalesce(old_shard.cast("int"), F.lit(-1)).alias("old_shard"))
    width = max(16, shuffle_width(spark))
    at = at.withColumn("_chunk", F.pmod(F.xxhash64("doc_id"), F.lit(width)).cast("int"))
    cls = F.lit(len(CLASSES) - 1)
    for c in reversed(range(len(CLASSES) - 1)):
        cls = F.when(F.col("size") >= CLASSES[c], F.lit(c)).otherwise(cls)
    sizes = materialise(at.withColumn("_class", cls), "reshard-sizes")
    # The running sum within (old shard, class) doesn't depend on the cuts: it is taken once.
    at = materialise(running(sizes, ["old_shard", "_class"], F.col("size"), "_from", order), "reshard-order")
    discard(sizes)
    sums = {(r["old_shard"], r["_class"]): r["n"] for r in at.groupBy("old_shard", "_class").agg(F.sum("size").alias("n")).collect()}
    olds = sorted({o for o, _ in sums})
    supply = [sum(n for (o, _), n in sums.items() if o == old) for old in olds]
    total = sum(supply)
    capacity = even_capacities(total, shards) if capacities is None else scaled(capacities, total)
    if not olds:
        return at.select("doc_id", "size", "text_crc32", "old_shard", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"), *key)
    flow = min_cost_flow(supply, capacity, [[0 if old == j else 1 for j in range(len(capacity))] for old in olds])
    shard = F.lit(0)
    need = {(old, j): f for old, row in zip(olds, flow) for j, f in enumerate(row) if f}
    for c in range(len(CLASSES)):
        cuts = class_cuts(need, {o: sums.get((o, c), 0) for o in olds}, {o: sum(sums.get((o, k), 0) for k in range(c, len(CLASSES))) for o in olds})
        where = F.lit(0)
        for old, ends in cuts.items():
            inside = F.lit(ends[-1][1])
            for up, j in reversed(ends[:-1]):
                inside = F.when(F.col("_from") + F.col("size") / 2 < up, F.lit(j)).otherwise(inside)
            where = F.when(F.col("old_shard") == old, inside).otherwise(where)
        shard = F.when(F.col("_class") == c, where).otherwise(shard)
        if c + 1 < len(CLASSES):
            for r in at.where(F.col("_class") == c).withColumn("_j", where).groupBy("old_shard", "_j").agg(F.sum("size").alias("n")).collect():
                need[r["old_shard"], r["_j"]] = need.get((r["old_shard"], r["_j"]), 0) - r["n"]
            need = balanced(need, {o: sum(sums.get((o, k), 0) for k in range(c + 1, len(CLASSES))) for o in olds}, olds)
    out = materialise(at.withColumn("shard", shard).drop("_from", "_class"), "reshard-placed")
    discard(at)
    out = running(out, ["shard"], F.lit(1).cast("long"), "slot", order)
    return out.select("doc_id", "size", "text_crc32", "old_shard", "shard", "slot", *key)


def scaled(capacities: list[int], total: int) -> list[int]:
    whole = sum(capacities)
    if whole <= 0:
        raise ValueError("no capacity")
    ends = [total * sum(capacities[: j + 1]) // whole for j in range(len(capacities))]
    return [b - a for a, b in zip([0, *ends], ends)]


def balanced(need: dict, supply: dict, olds: list) -> dict:
    """What each new shard still lacks, met anew from what is left of each old shard, staying put first."""
    shards = sorted({j for _, j in need})
    lack = [max(0, sum(need.get((o, j), 0) for o in olds)) for j in shards]
    left = [supply[o] for o in olds]
    lack = scaled(lack, sum(left)) if sum(lack) else even_capacities(sum(left), len(shards))
    flow = min_cost_flow(left, lack, [[0 if o == j else 1 if need.get((o, j), 0) > 0 else 2 for j in shards] for o in olds])
    return {(o, j): f for o, row in zip(olds, flow) for j, f in zip(shards, row)}


def class_cuts(need: dict, size: dict, left: dict) -> dict[int, list[tuple[int, int]]]:
    """For each old shard, [(end of the running sum, new shard)]: a class of the shard's bytes dealt as its flows ask."""
    out = {}
    for old, n in size.items():
        wants = [(j, max(0, f)) for (o, j), f in sorted(need.items()) if o == old]
        total = sum(f for _, f in wants)
        if not total:
            out[old] = [(n, wants[0][0] if wants else 0)]
            continue
        ends, up = [], 0
        for j, f in wants:
            if f:
                up += f
                ends.append((n * up // total, j))
        out[old] = ends
    return out


def matched(docs: DataFrame, placed: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    """docs and placed with a key for each row, the same in both: that of `numbered`, or else doc_id, text and a
    number among the rows that repeat them, which are taken for one another as far as one old shard holds them."""
    if ROW in docs.columns and ROW in placed.columns:
        return docs, placed
    same = ["doc_id", "size", "text_crc32"]
    if placed.groupBy(*same).agg(F.min("old_shard").alias("a"), F.max("old_shard").alias("b")).where("a <> b").limit(1).count():
        raise ValueError("rows of one doc_id and text lie in several old shards: reshard and rewrite numbered(docs)")
    key = lambda *c: F.to_json(F.struct(*c, F.row_number().over(Window.partitionBy(*c).orderBy(F.lit(0))).alias("_k")))
    at = docs.withColumns({"_reshard_size": bytes_of(text)[0], "_reshard_crc": bytes_of(text)[1]})
    names = F.col("doc_id"), F.col("_reshard_size"), F.col("_reshard_crc")
    there = placed.drop(ROW).withColumnsRenamed({"size": "_reshard_size", "text_crc32": "_reshard_crc"})
    return at.withColumn(ROW, key(*names)).drop("_reshard_size", "_reshard_crc"), there.withColumn(ROW, key(*names))


def beside(columns: list[str]) -> dict[str, str]:
    """New names for columns that are called shard or slot, as the layout's own are."""
    taken, out = {c.lower() for c in columns}, {}
    for c in columns:
        if c.lower() in ("shard", "slot"):
            new = f"doc_{c}"
            while new.lower() in taken:
                new = f"doc_{new}"
            taken.add(new.lower())
            out[c] = new
    return out


def rewrite(docs: DataFrame, placed: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Write the documents of every shard that takes or loses rows as Parquet under path, by shard, each file in slot order:
    one row for each row of docs, whose own columns shard and slot are written as doc_shard and doc_slot.

    Returns the shards that stay as they are: (shard) all of whose rows stay and which take none.
    """
    touched = placed.where(F.col("old_shard") != F.col("shard")).select(F.explode(F.array("old_shard", "shard")).alias("shard")).distinct()
    docs, keyed = matched(docs, placed, text)
    rows = keyed.join(F.broadcast(touched), "shard", "left_semi").select(ROW, "shard", "slot")
    # Texts are joined by a shuffle at any size: the other side has a row for each of theirs.
    out = docs.withColumnsRenamed(beside(docs.columns)).join(rows.hint("shuffle_hash"), ROW).drop(ROW)
    # No second shuffle by shard: each task of the join writes a file of each shard.
    out.sortWithinPartitions("shard", "slot").write.option("compression", "zstd").partitionBy("shard").parquet(path)
    return placed.select(F.col("old_shard").alias("shard")).distinct().join(F.broadcast(touched), "shard", "left_anti")


def moved(docs: DataFrame, old_shard: Column, text: str = "text", **how) -> DataFrame:
    """Reshard docs and rewrite the files: doc_id, size, text_crc32, shard and slot of each row as the rewritten
    files hold it, or, in shards that stay as they are, as docs do."""
    docs = numbered(docs)
    placed = materialise(reshard(docs, old_shard, text=text, **how), "reshard-plan")
    path = f"{shared_dir(docs.sparkSession)}/reshard-files-{uuid.uuid4().hex}"
    still = [r["shard"] for r in rewrite(docs, placed, path, text).collect()]
    names = beside(docs.columns)
    kinds = docs.drop(ROW).withColumnsRenamed(names).schema.add("slot", "long").add("shard", "integer")
    files = docs.sparkSession.read.schema(kinds).parquet(path)
    out = files.select("doc_id", *bytes_of(names.get(text, text)), "shard", "slot")
    if still:
        rows = placed.where(F.col("shard").isin(still)).select(ROW, "shard", "slot")
        out = out.union(docs.select(ROW, "doc_id", *bytes_of(text)).join(rows, ROW).select("doc_id", "size", "text_crc32", "shard", "slot"))
    return out
