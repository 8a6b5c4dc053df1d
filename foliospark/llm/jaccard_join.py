"""Set similarity join on word shingles with set-relation skipping, and the components of its links.

1. Documents with equal sets are one class; only classes go on, each with one row's text.
2. Shingles that stand in one class alone can't be shared. They are found by an exchange of four bytes a
   shingle between chunks and buckets, which also tells how many classes hold the others. The order of tokens is: those of one
   class alone, then from rare to frequent. A set with as many tokens of its own
   as its prefix is long links with nothing, and is done: this leaves out all but a class's near copies.
3. Sets with a least shingle in common, by any of LEADS hashes, are first compared with one of them, the centre: the set whose
   shingles most others have. Answers of a set that links with the centre are derived from the centre's: what is known to be in
   one component already is not compared again. Answers of the others bound their pairs: x and y differ by at least what x and y
   each differ from a centre, less twice what of these differences they may share, which shingles of one class alone can't be.
4. The prefixes, rare shingles first, make index lists of (token, set, size, position). Lists whose sets are in one component by
   then are skipped whole. From the others, pairs over different components are compared in blocks by size. Of the smaller set of
   a pair only the first places enter a list, those from which it can still share as much as with a set of its own size; the
   larger one gives its whole prefix. A pair is skipped if its sizes, what its positions leave to share, or its answers for a
   centre show that it can't reach the threshold.
5. Links that hold make components; copies take the component of their class.

No list of a hot token is collected anywhere: centres are chosen by sums that begin before the shuffle, pairs with a centre are
as many as its list is long, and a shingle of very many sets stands at the end of their order, mostly beyond the prefix.

Shingles are compared by 64-bit hashes, sets by 128 bits and their size. Defined results: a document without words has an empty
set and is a component of its own; rows that share a doc_id are one document, linked by whatever any of its texts links with;
rows without a doc_id are documents of their own (component_id is null where no row that they link with has one);
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import compact, discard, materialise, pieces
from .components import connected_components
from .language_id import blocks, text_buffer
from .substring_dedup import one_array, packed, spread
from .wordhash import mix, window_hashes, word_table

#: What tells a set from others.
IDENTITY = ["n_shingles", "h1", "h2"]
#: How many hashes choose a set's least shingle.
LEADS = 4


def shingle_sets(text: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, ascending, one text after another, and how many each has."""
    data, ends = text_buffer(text)
    _, _, owner, h = word_table(data, ends, lower=True)
    words = np.bincount(owner, minlength=len(ends))
    all_ = window_hashes(h, k)
    valid = owner[: len(all_)] == owner[k - 1 :] if len(all_) else np.zeros(0, bool)
    hashes, doc = [all_[valid]], [owner[: len(all_)][valid]]
    first = np.cumsum(words) - words
    for n in range(1, k):  # too few words: the whole sequence is one shingle
        short = np.flatnonzero(words == n)
        if len(short):
            hashes.append(mix(window_hashes(h, n)[first[short]] + np.uint64(n)))
            doc.append(short)
    hashes, doc = np.concatenate(hashes), np.concatenate(doc)
    order = np.argsort(hashes)
    order = order[np.argsort(doc[order], kind="stable")]
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    return hashes[new], np.bincount(doc[new], minlength=len(ends))


def chunk_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    parts = [shingle_sets(b.column("text"), k) for b in blocks(pa.RecordBatch.from_arrays([texts], ["text"]))]
    return (np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def keyed(docs: DataFrame, text: str) -> DataFrame:
    """doc_id, text and a hash of the text: together they tell rows apart that aren't equal."""
    return docs.select("doc_id", F.col(text).alias("text"), F.xxhash64(text).alias("v"))


def identities(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, v, n_shingles and two hashes that tell sets apart."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(whole):
                h, n = shingle_sets(batch.column("text"), k)
                sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h ^ np.uint64(salt)), dtype=np.uint64)]) for salt in (0x1234567, 0x7654321)]
                up = np.cumsum(n)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("v"), pa.array(n, pa.int64()), *(pa.array((s[up] - s[up - n]).view(np.int64)) for s in sums)], ["doc_id", "v", *IDENTITY])

    return docs.mapInArrow(count, "doc_id long, v long, n_shingles long, h1 long, h2 long")


def shared_sets(docs: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """Of the classes that may link: node, size, alone (shingles of this class only), leads (the least of the others by some hashes) and these others, from rare to frequent.

    classes: node, and doc_id and v of the row that has its text.
    """
    chunks, buckets = pieces(docs, 4), pieces(docs)
    chunk = F.pmod(F.xxhash64("doc_id", "v"), F.lit(chunks)).cast("int")
    at, classes = docs.withColumn("c", chunk), classes.select("node", "doc_id", "v").withColumn("c", chunk)

    def own(left: pa.Table, right: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nodes, sizes and shingles of a chunk's classes, by node."""
        if not left.num_rows or not right.num_rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        wanted = dict(zip(zip(right.column("doc_id").to_pylist(), right.column("v").to_pylist()), right.column("node").to_pylist()))
        row_of = {wanted[key]: i for i, key in enumerate(zip(left.column("doc_id").to_pylist(), left.column("v").to_pylist())) if key in wanted}
        nodes = np.array(sorted(row_of), dtype=np.int64)
        h, n = chunk_sets(one_array(left.column("text")).take(pa.array([row_of[x] for x in nodes.tolist()], pa.int64())), k)
        return nodes, n, h

    def send(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        _, _, h = own(left, right)
        rows = [(b, key[0].as_py(), mix(h[i]).astype("<u4").tobytes()) for b, i in packed(spread(h, buckets), buckets)]
        return pa.table([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())], ["b", "c", "h"])

    def count(table: pa.Table) -> pa.Table:
        parts = table.column("h").to_pylist()
        _, number, counts = np.unique(np.frombuffer(b"".join(parts), dtype="<u4"), return_inverse=True, return_counts=True)
        levels = np.minimum(255, np.ceil(8 * np.log2(counts))).astype(np.uint8)[number]  # 0: one class alone
        ends = np.cumsum([len(p) // 4 for p in parts])
        return pa.table([table.column("c"), table.column("b"), pa.array([x.tobytes() for x in np.split(levels, ends[:-1])], pa.binary())], ["c", "b", "levels"])

    def rest(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        kinds = {"node": pa.int64(), "n": pa.int64(), "alone": pa.int64(), "typical": pa.int64(), "leads": pa.list_(pa.int64()), "shared": pa.list_(pa.int64())}
        marks = right.filter(pa.compute.is_valid(right.column("b")))
        nodes, n, h = own(left, right.filter(pa.compute.is_null(right.column("b"))))
        found, level = dict(zip(marks.column("b").to_pylist(), marks.column("levels").to_pylist())), np.zeros(len(h), dtype=np.uint8)
        for b, i in packed(spread(h, buckets), buckets):
            level[i] = np.frombuffer(found[b], dtype=np.uint8)
        up = np.concatenate([np.zeros(1, np.int64), np.cumsum(level > 0)])
        end = np.cumsum(n)
        common = up[end] - up[end - n]
        ok = np.flatnonzero(n - common < n - least_overlap(n, percent) + 1)
        lists, leads, typical = [], [], []
        for a, b in zip((end[ok] - n[ok]).tolist(), end[ok].tolist()):
            some = np.flatnonzero(level[a:b]) + a  # shingles ascend: a stable sort by level leaves ties in that order
            lists.append(h[some[np.argsort(level[some], kind="stable")]].view(np.int64))
            typical.append(int(level[a:b].sum(dtype=np.int64)) * 1000 // (b - a))
            leads.append(np.unique([mix(h[some] + np.uint64(salt)).min() for salt in range(LEADS)]).view(np.int64) if len(some) else np.zeros(0, np.int64))
        return pa.table([pa.array(nodes[ok], pa.int64()), pa.array(n[ok]), pa.array((n - common)[ok]), pa.array(typical, pa.int64()), pa.array(leads, kinds["leads"]), pa.array(lists, kinds["shared"])], list(kinds))

    sent = at.groupBy("c").cogroup(classes.groupBy("c")).applyInArrow(send, "b int, c int, h binary")
    levels = sent.groupBy("b").applyInArrow(count, "c int, b int, levels binary")
    none = F.lit(None).cast("long")
    back = levels.select(none.alias("node"), none.alias("doc_id"), none.alias("v"), "c", "b", "levels").union(classes.select("node", "doc_id", "v", "c", F.lit(None).cast("int"), F.lit(None).cast("binary")))
    return at.groupBy("c").cogroup(back.groupBy("c")).applyInArrow(rest, "node long, n long, alone long, typical long, leads array<bigint>, shared array<bigint>")


def least_overlap(n, percent: int):
    return -(-percent * n // 100)


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """pairs (a, b) with inter and union, the sizes of the intersection and of the union."""
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("shared").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("shared").alias("sb"))
    out = pairs.join(left, "a").join(right, "b").select("a", "b", F.size(F.array_intersect("sa", "sb")).cast("long").alias("inter"), "na", "nb")
    return out.select("a", "b", "inter", (F.col("na") + F.col("nb") - F.col("inter")).alias("union"))


def jaccard_join(docs: DataFrame, k: int = 3, percent: int = 90, text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and class_id (smallest doc_id with an equal set) of every row of docs."""
    return jaccard_groups(keyed(docs, text), k, percent).select("doc_id", "n_shingles", "component_id", "class_id")


def jaccard_groups(source: DataFrame, k: int, percent: int, by_id: bool = True) -> DataFrame:
    """What jaccard_join returns, with v and, as component, a number of the component (null for documents without words); source is
    keyed(). by_id: texts of one doc_id are tied; else each row is a document of its own."""
    at = materialise(compact(identities(source, k)), "jaccard-sets")
    full = at.where("n_shingles > 0")
    classes = compact(full.groupBy(*IDENTITY).agg(F.min("doc_id").alias("low"), F.min(F.struct("doc_id", "v")).alias("r")))  # numbered after that
    classes = materialise(classes.select(F.monotonically_increasing_id().alias("node"), "low", F.col("r.doc_id").alias("doc_id"), F.col("r.v").alias("v"), *IDENTITY), "jaccard-classes")
    member = materialise(compact(full.join(classes.select("node", "low", *IDENTITY), IDENTITY).select("doc_id", "v", "n_shingles", "node", "low")), "jaccard-members")
    sets = materialise(compact(shared_sets(source, classes, k, percent)), "jaccard-shared")
    scratch = [sets]
    links = similar_pairs(sets, percent, scratch)
    if by_id:  # each class of a doc_id but the least is tied to that
        several = member.where("doc_id is not null").groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b").select("doc_id", "a")
        links = links.union(member.join(several, "doc_id").select("a", F.col("node").alias("b")).where("a <> b").distinct())
    label = connected_components(links)
    discard(*scratch)
    # The least doc_id of each component, over its classes.
    named = label.join(classes.select("node", "low"), "node")
    named = named.join(named.groupBy("component").agg(F.min("low").alias("component_id")), "component").select("node", "component_id", "component")
    named = member.join(named, "node", "left").withColumn("component_id", F.when(F.col("component").isNull(), F.col("low")).otherwise(F.col("component_id")))
    out = named.select("doc_id", "v", "n_shingles", "component_id", F.col("low").alias("class_id"), F.coalesce("component", "node").alias("component"))
    return out.union(at.where("n_shingles = 0").select("doc_id", "v", "n_shingles", F.col("doc_id").alias("component_id"), F.col("doc_id").alias("class_id"), F.lit(None).cast("long")))


def one_of_each(docs: DataFrame, k: int, percent: int, text: str = "text") -> DataFrame:
    """The rows of docs that stand for their component: the smallest doc_id's (rows without one come last, ties by a hash of the text).
    Documents without words all stay; rows that repeat a doc_id and its text stay one."""
    groups = jaccard_groups(keyed(docs, text), k, percent, by_id=False)
    first = groups.where("component is not null").groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "v")).alias("r"))
    stays = first.select("r.doc_id", "r.v").union(groups.where("component is null").select("doc_id", "v").distinct())
    stays = stays.select(F.struct("doc_id", "v").alias("_near_key"))
    at = docs.withColumn("_near_key", F.struct("doc_id", F.xxhash64(text).alias("v")))
    return at.join(stays, "_near_key", "left_semi").dropDuplicates(["_near_key"]).select(*docs.columns)


def similar_pairs(sets: DataFrame, percent: int, scratch: list[DataFrame]) -> DataFrame:
    """Pairs (a, b) of sets (see shared_sets) that reach the threshold: as many as connect what links connect.

    scratch takes the tables that they are read from."""
    good = F.col("inter") * 100 >= F.col("union") * percent
    near = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
    # Sets that resemble each other mostly have a least shingle in common, by some of several hashes: the least node that has it is their centre.
    led = sets.select("node", "n", "typical", F.explode("leads").alias("lead"))
    centre = led.groupBy("lead").agg(F.max(F.struct("typical", "node", "n")).alias("m"), F.count("*").alias("many")).where("many > 1").select("lead", F.col("m.node").alias("a"), F.col("m.n").alias("na"))
    pairs = led.select("lead", F.col("node").alias("b"), F.col("n").alias("nb")).join(centre, "lead").where("a <> b").select("a", "b").distinct()
    tested = materialise(compact(verify(pairs, sets, percent)), "jaccard-tested")
    links = tested.where(good).select("a", "b")
    label = star_labels(links)
    scratch += [tested, label]
    # Every set knows how far it is from its centres: |x - y| + |y - x| in shingles.
    away = tested.select("a", "b", (F.col("union") - F.col("inter")).alias("away"))
    away = away.select(F.col("b").alias("node"), F.col("a").alias("centre"), "away").union(away.select(F.col("a").alias("node"), F.col("a").alias("centre"), F.lit(0).cast("long")))
    away = away.groupBy("node").agg(F.collect_set(F.struct("centre", "away")).alias("from"))
    known = sets.select("node", "n", "alone", "shared").join(label, "node", "left").join(away, "node", "left").withColumn("component", F.coalesce("component", "node"))
    known = materialise(compact(known), "jaccard-known")
    prefix = (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - F.col("alone")).cast("int")
    lists = known.select("node", "n", "alone", "component", "from", F.floor(F.log2(F.col("n"))).cast("int").alias("block"), F.posexplode(F.slice("shared", F.lit(1), prefix)).alias("pos", "token"))
    # Lists whose sets are all in one component are skipped.
    open_ = lists.join(lists.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("token"), "token", "left_semi")
    open_ = materialise(compact(open_.withColumn("left", F.col("n") - F.col("alone") - F.col("pos"))), "jaccard-open")
    side = lambda s: [F.col("node").alias(s), F.col("n").alias(f"n{s}"), F.col("left").alias(f"left{s}"), F.col("component").alias(f"c{s}"), F.col("from").alias(f"f{s}"), F.col("alone").alias(f"s{s}")]
    # The smaller set a of a pair shares 2 percent / (100 + percent) of itself at least, which its later places can't; b is in its block of sizes or the next.
    smaller = open_.where(F.col("left") * (100 + percent) >= 2 * percent * F.col("n")).select("token", *side("a"), F.explode(F.array(F.col("block"), F.col("block") + 1)).alias("block"))
    cross = smaller.join(open_.select("token", "block", *side("b")), ["token", "block"]).where("(na < nb or na = nb and a < b) and ca <> cb").where(near)
    # ceil(percent / (100 + percent) * (na + nb)) must be shared; from this token on at most leftx are.
    cross = cross.where(F.least("lefta", "leftb") * (100 + percent) >= (F.col("na") + F.col("nb")) * percent)
    # Both differ from one centre by known numbers, of which they can share no more than isn't theirs alone.
    far = f"exists(fa, x -> exists(fb, y -> x.centre = y.centre and (x.away + y.away - 2 * greatest(0, least(x.away - sa, y.away - sb))) * {100 + percent} > (na + nb) * {100 - percent}))"
    cross = cross.where(~F.coalesce(F.expr(far), F.lit(False)))
    cross = cross.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    found = materialise(compact(verify(cross, sets, percent)), "jaccard-tested")
    scratch += [known, open_, found]
    return links.union(found.where(good).select("a", "b"))


def star_labels(links: DataFrame) -> DataFrame:
    """(node, component) of the nodes of links: equal components are connected, though not all that are connected have equal ones."""
    both = links.union(links.select("b", "a")).toDF("node", "next")
    label = materialise(compact(both.groupBy("node").agg(F.least("node", F.min("next")).alias("component"))), "jaccard-labels")
    for _ in range(2):  # the least label among neighbours, then that one's own label
        near = both.join(label.select(F.col("node").alias("next"), "component"), "next").groupBy("node").agg(F.min("component").alias("component"))
        up = label.select(F.col("node").alias("component"), F.col("component").alias("up"))
        last, label = label, materialise(compact(near.join(up, "component", "left").select("node", F.least("up", "component").alias("component"))), "jaccard-labels")
        discard(last)
    return label
