"""Benchmark decontamination by winnowing: documents and benchmark items meet on minimum k-gram hashes.

DataFrame functions only. An item's window is WINDOW consecutive words, or the whole of a shorter item.
Fingerprints are the minima of K-gram hashes over WINDOW - K + 1 neighbouring grams, so every shared
span of WINDOW words has a fingerprint in common; each hit carries the words around it and is extended
to whole windows, which are compared as text. Items of fewer words than WINDOW have one fingerprint,
the hash of all their words; documents then also give the grams of those lengths that begin with the
first word of such an item.

The documents' side is never shuffled before it has met the benchmark while the benchmark's
fingerprints number no more than BROADCAST_ROWS, which is counted first; beyond, both joins are shuffled.
Below that number a table of at most 2 ** 18 bits over hash values also goes into the plan: fingerprints
that it excludes never become rows.

Defined results: null texts have no words; every row is a document of its own, rows that share a doc_id and a null
doc_id too; an empty benchmark leaves every document clean; items with null or
repeated ids count as the ids they show (a null id is left out of items_sha256 and n_items); other
columns of either table are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

WINDOW, K = 13, 8
BROADCAST_ROWS = 200_000
#: Low 31 bits of a fingerprint hold its place, the rest its hash; no string has more words than that.
PLACE = 0x7FFFFFFF
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def bench_words(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _fingerprints(w: str, n: str) -> tuple[str, str]:
    """SQL of the packed fingerprints of words w, n of them (none below WINDOW words), and of their grams, which these call _g.

    Elements are named one by one: slices inside the lambdas would copy each word K times.
    """
    after = ", ".join(f"{w}[i + {k}]" for k in range(1, K))
    grams = f"transform(slice({w}, 1, {n} - {K - 1}), (x, i) -> (xxhash64(x, {after}) & ~{PLACE}L) | (i + 1))"
    next_ = ", ".join(f"_g[j + {k}]" for k in range(1, WINDOW - K + 1))
    return f"case when {n} >= {WINDOW} then array_distinct(transform(slice(_g, 1, {n} - {WINDOW - 1}), (x, j) -> least(x, {next_}))) else cast(array() as array<bigint>) end", grams


def decontaminate(docs: DataFrame, benchmark: DataFrame, one_in: int = 20, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """For each row of docs: doc_id, text_hash, n_words, n_hit, n_items, items_sha256, items, contaminated (a hit, and one word of `one_in` or more is hit)."""
    prints, grams = _fingerprints("_w", "_n")
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), bench_words(F.col("text")).alias("_w")).withColumn("_n", F.size("_w")).where("_n > 0")
    # A window as text, with the items it occurs in.
    starts = f"transform(sequence(1, greatest(1, _n - {WINDOW - 1})), i -> array_join(slice(_w, i, {WINDOW}), ' '))"
    windows = items.select("item", F.explode(F.array_distinct(F.expr(starts))).alias("win")).groupBy("win").agg(F.array_sort(F.collect_set("item")).alias("win_items"))
    long_fp = items.where(f"_n >= {WINDOW}").withColumn("_g", F.expr(grams)).select(F.explode(F.expr(prints)).alias("fp")).select((F.col("fp").bitwiseAND(F.lit(~PLACE))).alias("fp"), F.lit(0).alias("len"))
    short_fp = items.where(f"_n < {WINDOW}").select((F.xxhash64("_w").bitwiseAND(F.lit(~PLACE))).alias("fp"), F.col("_n").alias("len"))
    table = long_fp.union(short_fp).distinct().withColumn("hit", F.lit(True))
    n_prints = table.count()
    short = [(r["_n"], r["first"]) for r in items.where(f"_n < {WINDOW}").groupBy("_n").agg(F.collect_set(F.get("_w", F.lit(0))).alias("first")).collect()] if n_prints <= broadcast_rows else [(r["_n"], None) for r in items.where(f"_n < {WINDOW}").select("_n").distinct().collect()]

    small = n_prints <= broadcast_rows
    # Equal texts of one doc_id have equal results: they are counted, and come back as many rows.
    at = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), bench_words(F.col("text")).alias("_w")).withColumn("_n", F.size("_w"))
    if small:  # a bit for each of some hash values tells most fingerprints apart before they become rows
        bits = min(18, max(8, (16 * n_prints).bit_length()))
        seen = {(r["fp"] >> 31) & ((1 << bits) - 1) for r in table.where("len = 0").select("fp").collect()}
        at = at.withColumn("_known", F.split(F.lit(",".join(str(int(i in seen)) for i in range(1 << bits))), ",").cast("array<int>"))
        prints = f"filter({prints}, x -> _known[cast(shiftright(x, 31) & {(1 << bits) - 1}L as int)] = 1)"
    at = at.withColumn("_g", F.expr(f"case when _n >= {WINDOW} then {grams} else cast(array() as array<bigint>) end"))
    long_part = f"transform({prints}, x -> struct(x & ~{PLACE}L as fp, 0 as len, cast(greatest(1L, (x & {PLACE}L) - {WINDOW - K}) as int) as start, slice(_w, cast(greatest(1L, (x & {PLACE}L) - {WINDOW - K}) as int), cast((x & {PLACE}L) + {WINDOW - 1} - greatest(1L, (x & {PLACE}L) - {WINDOW - K}) + 1 as int)) as words))"
    parts = ["array(struct(text_hash as fp, -1 as len, _n as start, cast(null as array<string>) as words))", long_part]
    for n, first in short:
        at = at.withColumn(f"_f{n}", F.array(*(F.lit(x) for x in first)) if first else F.lit(None).cast("array<string>"))
        known = f"and array_contains(_f{n}, _w[i - 1])" if first else ""
        parts.append(f"case when _n >= {n} then transform(filter(sequence(1, _n - {n - 1}), i -> true {known}), i -> struct(xxhash64(slice(_w, i, {n})) & ~{PLACE}L as fp, {n} as len, i as start, slice(_w, i, {n}) as words)) end")
    parts = [f"coalesce({p}, array())" if p.startswith("case") else p for p in parts]
    rows = at.select("doc_id", "text_hash", F.expr(f"inline(concat({', '.join(parts)}))"))

    few = small and windows.limit(broadcast_rows + 1).count() <= broadcast_rows  # what is broadcast is counted
    met = rows.join(F.broadcast(table) if small else table, ["fp", "len"], "left").where("len = -1 or hit")
    # Extend: every window of a hit's words, as text.
    wins = f"case when len = 0 then transform(sequence(1, greatest(1, size(words) - {WINDOW - 1})), i -> struct(start + i - 1 as at, slice(words, i, {WINDOW}) as w)) when len > 0 then array(struct(start as at, words as w)) end"
    spans = met.select("doc_id", "text_hash", F.when(F.col("len") == -1, F.col("start")).alias("n_words"), F.explode_outer(F.expr(wins)).alias("x"))
    spans = spans.select("doc_id", "text_hash", "n_words", "x.at", F.size("x.w").alias("n"), F.coalesce(F.array_join("x.w", " "), F.lit("")).alias("win"))
    hits = spans.join(F.broadcast(windows) if few else windows, "win", "left").where("n_words is not null or win_items is not null")
    found = hits.groupBy("doc_id", "text_hash").agg(
        F.count("n_words").cast("int").alias("_rows"),
        F.max("n_words").cast("long").alias("n_words"),
        F.sort_array(F.collect_set(F.when(F.col("win_items").isNotNull(), F.struct("at", "n")))).alias("_at"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("win_items")))).alias("_items"),
    )
    return found.select(
        "doc_id",
        "text_hash",
        "n_words",
        "_rows",
        F.expr("aggregate(_at, struct(0 as up, 0L as n), (a, x) -> struct(greatest(a.up, x.at + x.n) as up, a.n + greatest(0, x.at + x.n - greatest(a.up, x.at)) as n)).n").alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"),
        F.col("_items").alias("items"),
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * one_in >= F.col("n_words"))).withColumn("_rows", F.explode(F.array_repeat(F.lit(0), F.col("_rows")))).drop("_rows")


ORACLE = r"""
with d as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from documents),
b as (select item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from benchmark),
bw as (select distinct item_id, least(len(w), 13) as n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') as win from (select item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) as i from b where len(w) > 0)),
ns as (select distinct n from bw),
dw as (select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as win from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, ns where len(w) >= n)),
h as (select doc_id, i, dw.n, item_id from dw join bw using (win)),
p as (select distinct doc_id, unnest(range(i, i + n)) as p from h),
hit as (select doc_id, count(*) as n_hit from p group by doc_id),
it as (select doc_id, count(distinct item_id) as n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as items from h group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join hit using (doc_id) left join it using (doc_id)
"""
