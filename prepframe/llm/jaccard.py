"""Operator 4: n-gram Jaccard join with prefix filters under several global token orders.

A document's set holds its distinct word shingles (64-bit hashes; a document with fewer
words has its whole word sequence as the only shingle).  Two sets with Jaccard >= t must
share k tokens within the first |s| - ceil(t |s|) + k tokens of each under *any* global
order of all tokens, as long as ceil(t |s|) >= k.  The join asks for that under several
orders at once, for k = 2 under the first and k = 1 under the further ones (different sets
of a single token have nothing in common):

1. Equal sets become one class (``set_id``); classes, not copies, are joined.
2. Order 0 is (frequent, hash): the share of low-hash tokens of every class is counted over
   all documents, and the most frequent of them are moved behind all others.  Only the
   bounded list of moved tokens is sent to the tasks; any such list gives an exact filter.
3. The further orders are other permutations of the hash.  Their prefixes travel with the
   class as 32-bit hashes; a candidate from order 0 must have a common one under each of
   them and sizes within the threshold before it is verified on the whole sets.
4. Every class is first verified against one representative only, of the token groups that
   name the same one most often (a star).  Links found merge classes into components; groups
   whose classes are one component are done.
5. Classes with few partners of fitting size left in a group meet them there; the others are
   ordered anew: the tokens of their *whole* sets are counted, and the frequent ones (again
   a bounded list) go behind all others.  A class with f of them shares at most f with any class that shares no other token with it.  So a pair
   meets only in a token outside the list, or if both classes have at least as many listed
   tokens as the threshold asks of their sizes: members of a large family that differ in a
   few tokens of their own never meet.  A second star of each class, now the member of its
   groups with the fewest tokens outside the list (the text that the others were copied
   from), joins most of the family before pairs of *different* components are verified.

No pair is dropped: a pair that is never verified lies within one component already, or
cannot share enough tokens.

A class goes by the smallest doc_id of its copies.  Edge cases: null, empty or blank texts have an empty set, size 0, and link with nothing
(each is its own component); repeated rows are returned once per input row and share a
component if their text has words; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prepframe.llm.common import cut_lineage, map_batches, prepare, probably_in, release
from prepframe.operators.components import connected_components

# Tokens moved behind all others in order 0: at most this many hashes are broadcast (8 bytes each).
MAX_MOVED = 50_000
# A token is moved only if it is in the counted part of more classes than this.
MOVE_ABOVE = 24
# Tokens that two sets must share within their prefixes under order 0.
SHARED = 2
ORDERS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)

_TABLE = np.random.RandomState(20240607).randint(0, 2**63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(n, 0x9E3779B97F4A7C15 | 1, np.uint64))


def shingle_sets(column: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text of a batch, computed over its bytes."""
    with np.errstate(over="ignore"):
        column = column.cast(pa.large_string())
        off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        raw = np.frombuffer(column.buffers()[2] or b"", np.uint8)[off[0] : off[-1]]
        off = off - off[0]
        if column.null_count:
            raise ValueError("texts must not be null")
        data = _LOWER[raw]
        n = len(data)
        inside = ~_SPACE[data]
        first = inside.copy()
        if n:
            first[1:] &= ~inside[:-1]
        edge = off[:-1][off[:-1] < n]
        first[edge] = inside[edge]
        starts = np.flatnonzero(first)
        if not len(starts):
            return [np.zeros(0, np.uint64)] * len(column)
        word = np.cumsum(first) - 1
        at = np.flatnonzero(inside)
        place = at - starts[word[at]]
        value = _TABLE[data[at]] * _powers(int(place.max()) + 1)[place]
        cut = np.searchsorted(at, starts)
        h = _mix(np.add.reduceat(value, cut))
        lo, hi = np.searchsorted(starts, off[:-1]), np.searchsorted(starts, off[1:])
        if len(h) >= width:
            s = np.zeros(len(h) - width + 1, np.uint64)
            for k in range(width):
                s = _mix(s * np.uint64(0x9E3779B97F4A7C15) + h[k : k + len(s)])
        out = []
        for a, b in zip(lo.tolist(), hi.tolist()):
            if b - a >= width:
                out.append(np.unique(s[a : b - width + 1]))
            elif b > a:
                one = np.uint64(b - a)
                for x in h[a:b]:
                    one = _mix(np.array([one * np.uint64(0xC2B2AE3D27D4EB4F) + x], np.uint64))[0]
                out.append(np.array([one], np.uint64))
            else:
                out.append(np.zeros(0, np.uint64))
        return out


def _set_id(s: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(s.tobytes())


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def _other_prefixes(s: np.ndarray, percent: int) -> bytes:
    """The prefixes under the further orders, 32 bits of each token's place, one after another."""
    out = []
    with np.errstate(over="ignore"):
        p = prefix_length(len(s), percent)
        for k in ORDERS:
            o = _mix(s * np.uint64(k))
            low = np.partition(o, p - 1)[:p] if p < len(o) else o
            out.append((low & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes())
    return b"".join(out)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text"))


def set_table(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, set_id, n) of every document; set_id is null for an empty set."""

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(b.column(1), width)
        return pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([_set_id(s) if len(s) else None for s in sets], pa.binary()),
             pa.array([len(s) for s in sets], pa.int64())],
            names=["doc_id", "set_id", "n"],
        )

    src = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return map_batches(src, fn, "doc_id long, set_id binary, n long")


def _prefix_tokens(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Plain hash-order prefix tokens of all documents, equal sets of a task once (for the counts)."""

    def fn(b: pa.RecordBatch) -> pa.RecordBatch | None:
        parts = {s.tobytes(): s[: prefix_length(len(s), percent)] for s in shingle_sets(b.column(0), width) if len(s)}
        if not parts:
            return None
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(list(parts.values())).view(np.int64))], names=["token"])

    return map_batches(_texts(docs), fn, "token long")


def _one_prefix(s: np.ndarray, late: np.ndarray, percent: int, whole: bool) -> tuple[np.ndarray, int, int]:
    """The prefix under order 0 for the moved tokens ``late``, how many of its tokens are not
    moved, and how many of the set's are moved (counted over the whole set if ``whole``)."""
    p = prefix_length(len(s), percent) + SHARED - 1

    def is_late(x: np.ndarray) -> np.ndarray:
        return late[np.minimum(np.searchsorted(late, x), len(late) - 1)] == x if len(late) else np.zeros(len(x), bool)

    part = s if whole else s[: 2 * p]
    slow = is_late(part)
    if (~slow).sum() < p and len(part) < len(s):
        part, slow = s, is_late(s)
    return np.concatenate([part[~slow], part[slow]])[:p], int(min(p, (~slow).sum())), int(slow.sum())


def _prefixes(docs: DataFrame, width: int, percent: int, moved) -> DataFrame:
    """(set_id, n, prefix, other) of every class: order 0 and the further orders."""

    def fn(b: pa.RecordBatch) -> pa.RecordBatch | None:
        got = {}
        for s in shingle_sets(b.column(0), width):
            if len(s) and (key := _set_id(s)) not in got:
                got[key] = (len(s), _one_prefix(s, moved.value, percent, False)[0], _other_prefixes(s, percent))
        if not got:
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array(list(got), pa.binary()), pa.array([x[0] for x in got.values()], pa.int64()),
             pa.array([x[1].view(np.int64) for x in got.values()], pa.list_(pa.int64())), pa.array([x[2] for x in got.values()], pa.binary())],
            names=["set_id", "n", "prefix", "other"],
        )

    rows = map_batches(_texts(docs), fn, "set_id binary, n long, prefix array<long>, other binary")
    return rows.groupBy("set_id").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("other").alias("other"))


def _meet_in_all_orders(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Candidates (a, b) of fitting sizes whose prefixes meet under every further order."""

    def fn(b: pa.RecordBatch) -> pa.RecordBatch | None:
        keep = []
        for i, (x, y) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist())):
            u, v = (np.frombuffer(z, np.uint32).reshape(len(ORDERS), -1) for z in (x, y))
            if all(np.isin(u[k], v[k]).any() for k in range(len(ORDERS))):
                keep.append(i)
        return b.select(["a", "b"]).take(pa.array(keep, pa.int64())) if keep else None

    left = classes.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("other").alias("oa"))
    right = classes.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("other").alias("ob"))
    sized = pairs.join(left, "a").join(right, "b").where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
    return map_batches(sized.select("a", "b", "oa", "ob"), fn, "a long, b long")


def _of_classes(docs: DataFrame, wanted: DataFrame, width: int, name: str, value) -> DataFrame:
    """(rep, ``name``) of the wanted classes: ``value`` of the set of the class's first document."""

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(b.column(1), width)
        return pa.RecordBatch.from_arrays([b.column(0), pa.array([value(s) for s in sets], pa.binary())], names=["rep", name])

    # The few others that pass the bitmap meet no pair in the join that follows.
    src = probably_in(docs, "doc_id", wanted).select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return map_batches(src, fn, f"rep long, {name} binary").groupBy("rep").agg(F.first(name).alias(name))


def _whole_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(rep, tokens) of the wanted classes."""
    return _of_classes(docs, wanted, width, "tokens", lambda s: s.tobytes())


def histogram(s: np.ndarray) -> bytes:
    """The size of a set and how many of its hashes fall into each of n/2 to n equal ranges (255 for more)."""
    bits = max(1, len(s).bit_length() - 1)
    counts = np.bincount((s >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return len(s).to_bytes(8, "little") + np.minimum(counts, 255).astype(np.uint8).tobytes()


def may_link(x: bytes, y: bytes, percent: int) -> bool:
    """False only if the histograms prove the similarity to lie below the threshold.

    The counts of equal ranges differ by no more than the symmetric difference of the sets."""
    n, m = int.from_bytes(x[:8], "little"), int.from_bytes(y[:8], "little")
    u, v = np.frombuffer(x, np.uint8, offset=8).astype(np.int64), np.frombuffer(y, np.uint8, offset=8).astype(np.int64)
    if len(u) > len(v):
        u = np.minimum(u.reshape(len(v), -1).sum(1), 255)
    elif len(v) > len(u):
        v = np.minimum(v.reshape(len(u), -1).sum(1), 255)
    apart = int(np.abs(u - v).sum())
    return (100 + percent) * (n + m - apart) >= 2 * percent * (n + m)


def _joined(pairs: DataFrame, table: DataFrame, name: str) -> DataFrame:
    """(a, b, x, y): the column of both classes beside every pair."""
    left = table.select(F.col("rep").alias("a"), F.col(name).alias("x"))
    right = table.select(F.col("rep").alias("b"), F.col(name).alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")


def _both(pairs: DataFrame) -> DataFrame:
    return cut_lineage(pairs.select(F.col("a").alias("rep")).union(pairs.select(F.col("b").alias("rep"))).distinct())


def _verify(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Candidates (a, b) whose whole sets reach the threshold.

    Histograms of the sets, an eighth of their size, travel with every pair first; whole sets
    only with the pairs that these cannot exclude."""

    def kept(test):
        def fn(b: pa.RecordBatch) -> pa.RecordBatch | None:
            keep = [i for i, (x, y) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist())) if test(x, y)]
            return b.select(["a", "b"]).take(pa.array(keep, pa.int64())) if keep else None

        return fn

    def similar(x: bytes, y: bytes) -> bool:
        u, v = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        at = np.searchsorted(u, v)
        both = int((u[np.minimum(at, len(u) - 1)] == v).sum())
        return 100 * both >= percent * (len(u) + len(v) - both)

    pairs = cut_lineage(pairs)
    release(docs.sparkSession)
    coarse = _of_classes(docs, _both(pairs), width, "counts", histogram)
    near = map_batches(_joined(pairs, coarse, "counts"), kept(lambda x, y: may_link(x, y, percent)), "a long, b long")
    near = cut_lineage(near)
    release(docs.sparkSession)
    sets = _whole_sets(docs, _both(near), width)
    return map_batches(_joined(near, sets, "tokens"), kept(similar), "a long, b long")


def _most_frequent(tokens: DataFrame, move_above: int, max_moved: int) -> np.ndarray:
    """The most frequent tokens, sorted (at most ``max_moved``)."""
    counted = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") > move_above)
    rows = counted.orderBy(F.desc("df"), "token").limit(max_moved).collect()  # limit: max_moved rows
    return np.sort(np.array([r["token"] for r in rows], np.int64).view(np.uint64))


def _groups(classes: DataFrame) -> DataFrame:
    """(at, token, rep, n, s, g) of the classes that share a prefix token; ``at`` is its place in
    the prefix, s the group's first class, g its size."""
    tokens = classes.select(F.posexplode("prefix").alias("at", "token"), "rep", "n")
    sizes = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("g"), F.min("rep").alias("s")).where("g > 1").select("token", "s", "g")
    return cut_lineage(tokens.join(sizes, "token"))


def _best_stars(groups: DataFrame) -> DataFrame:
    """(a, b): every class and the one star that it shares most tokens with."""
    shared = groups.where("rep != s").groupBy("s", "rep").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") >= SHARED)
    return shared.groupBy("rep").agg(F.max_by("s", F.struct("k", -F.col("s"))).alias("a")).select("a", F.col("rep").alias("b"))


def _open_groups(groups: DataFrame, comp: DataFrame, percent: int) -> DataFrame:
    """The postings, with ``comp`` and ``near``, that have a partner left to compare with.

    Sizes that the threshold allows together lie in the same or in neighbouring classes of
    size; ``near`` counts the members of the token's group in these classes, and a posting
    stays if they belong to more than one component."""
    step = math.log(100 / percent)
    named = groups.join(comp, "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    named = named.withColumn("size", F.floor(F.log("n") / step + 1e-9))
    counts = named.groupBy("token", "size").agg(F.count(F.lit(1)).alias("c"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    # One row per token and class of size: a group of the window holds a few dozen rows.
    w = Window.partitionBy("token").orderBy("size").rangeBetween(-1, 1)
    counts = counts.select("token", "size", F.sum("c").over(w).alias("near"), F.min("lo").over(w).alias("lo"), F.max("hi").over(w).alias("hi"))
    return named.join(counts.where("lo != hi").drop("lo", "hi"), ["token", "size"]).drop("size")


def _all_tokens(sets: DataFrame) -> DataFrame:
    """(token) of whole sets, a row for every set that has it."""

    def fn(b: pa.RecordBatch) -> pa.RecordBatch | None:
        parts = [np.frombuffer(x, np.int64) for x in b.column(0).to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(parts))], names=["token"]) if parts else None

    return map_batches(sets.select("tokens"), fn, "token long")


def _second_groups(sets: DataFrame, percent: int, moved) -> DataFrame:
    """(token, at, own, rep, n, f, s) under the second order 0: ``at`` is the token's place in
    the prefix, ``own`` says that it is outside the list, f listed tokens of the class; s is the
    group's class with the fewest others."""

    def fn(b: pa.RecordBatch) -> pa.RecordBatch | None:
        tokens, at, own, rep, n, f = [], [], [], [], [], []
        for i, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            s = np.frombuffer(raw, np.uint64)
            prefix, free, listed = _one_prefix(s, moved.value, percent, True)
            tokens.append(prefix.view(np.int64))
            at.append(np.arange(len(prefix), dtype=np.int32))
            own.append(at[-1] < free)
            rep += [i] * len(prefix)
            n += [len(s)] * len(prefix)
            f += [listed] * len(prefix)
        if not tokens:
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(tokens)), pa.array(np.concatenate(at)), pa.array(np.concatenate(own)), pa.array(rep, pa.int64()), pa.array(n, pa.int64()), pa.array(f, pa.int64())],
            names=["token", "at", "own", "rep", "n", "f"],
        )

    tokens = map_batches(sets.select("rep", "tokens"), fn, "token long, at int, own boolean, rep long, n long, f long")
    sizes = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("g"), F.min(F.struct(F.expr("n - f"), "rep")).alias("s")).where("g > 1")
    return tokens.join(sizes.select("token", F.col("s.rep").alias("s")), "token")


def _open_pairs(probes: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """(a, b) of different components, one of them among ``probes``, that share enough prefix
    tokens, fit in size, and share a token outside the list or have enough listed ones.

    A token counts only where the two sets can still share enough from its places on: beside the
    token and what follows it they share at most one, if it is the first or second that they
    share.  So the first SHARED of a pair that links always count."""
    left = probes.select("token", "own", F.col("at").alias("ia"), F.col("rep").alias("a"), F.col("n").alias("na"), F.col("f").alias("fa"), F.col("comp").alias("ca"))
    right = groups.select("token", F.col("at").alias("ib"), F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("f").alias("fb"), F.col("comp").alias("cb"), F.col("probe").alias("too"))
    # |x and y| >= percent / (100 + percent) * (|x| + |y|) for a link
    enough = F.least("fa", "fb") * (100 + percent) >= percent * (F.col("na") + F.col("nb"))
    reach = (F.least(F.col("na") - F.col("ia"), F.col("nb") - F.col("ib")) + SHARED - 1) * (100 + percent) >= percent * (F.col("na") + F.col("nb"))
    met = left.join(right, "token").where(
        reach & (F.col("ca") != F.col("cb")) & (~F.col("too") | (F.col("a") < F.col("b"))) & (F.col("own") | enough)
        & (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
    )
    met = met.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.count(F.lit(1)).alias("k"), F.max("own").alias("own"))
    return met.where(F.col("own") | (F.col("k") >= SHARED)).select("a", "b")


def similarity_components(
    docs: DataFrame, width: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text",
    move_above: int = MOVE_ABOVE, max_moved: int = MAX_MOVED,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every input row; ``percent`` must be over 50."""
    if percent <= 50:
        raise ValueError("two shared prefix tokens are only certain for a similarity over one half")
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    table = cut_lineage(set_table(docs, width))
    reps = table.where("set_id IS NOT NULL").groupBy("set_id").agg(F.min("doc_id").alias("rep"))

    first = _most_frequent(_prefix_tokens(docs, width, percent), move_above, max_moved)
    moved = spark.sparkContext.broadcast(first)
    classes = cut_lineage(_prefixes(docs, width, percent, moved).join(reps, "set_id").drop("set_id"))
    release(spark)
    groups = _groups(classes)
    release(spark)
    classes = classes.drop("prefix")
    links = cut_lineage(_verify(_meet_in_all_orders(_best_stars(groups), classes, percent), docs, width, percent))
    release(spark)
    comp = connected_components(links, "a", "b").withColumnRenamed("node", "rep")

    # Classes with many partners of fitting size left are ordered anew, by the tokens of their whole sets.
    left = cut_lineage(_open_groups(groups.drop("g", "s"), comp, percent))
    del groups
    release(spark)
    # A link shares SHARED tokens, all of them in groups left open.
    many = left.groupBy("rep").agg(F.count(F.lit(1)).alias("k"), F.max(F.col("near") > move_above).alias("large"))
    many = cut_lineage(many.where(F.col("large") & (F.col("k") >= SHARED)).select("rep"))
    sets = cut_lineage(_whole_sets(docs, many, width).join(many, "rep", "left_semi"))
    second = spark.sparkContext.broadcast(_most_frequent(_all_tokens(sets), move_above, max_moved))
    large = cut_lineage(_second_groups(sets, percent, second))
    del sets
    release(spark)
    stars = _verify(_meet_in_all_orders(_best_stars(large), classes, percent), docs, width, percent)
    links = cut_lineage(links.union(stars))
    comp = cut_lineage(connected_components(links, "a", "b").withColumnRenamed("node", "rep"))
    release(spark)

    # Cross-component pairs only.  Two classes that share a token of which both have many partners
    # are both among the reordered ones; all others meet as a partner of one that has few.
    few = left.drop("comp").join(comp, "rep", "left").select(
        "token", "at", "rep", "n", F.lit(False).alias("own"), F.col("n").alias("f"), F.coalesce("comp", "rep").alias("comp"), (F.col("near") <= move_above).alias("probe")
    )
    rest = cut_lineage(_open_groups(large, comp, percent).withColumn("probe", F.lit(True)))
    pairs = _open_pairs(few.where("probe"), few, percent).union(_open_pairs(rest, rest, percent)).distinct()
    more = _verify(_meet_in_all_orders(pairs, classes, percent), docs, width, percent)
    links = cut_lineage(links.union(more))
    del more, stars, left, few, rest, large, classes, pairs
    release(spark)
    comp = connected_components(links, "a", "b").withColumnRenamed("node", "rep")

    # Classes go by their smallest doc_id, so the smallest class is the smallest document.
    of_class = reps.join(comp, "rep", "left").select("set_id", F.coalesce("comp", "rep").alias("component_id"))
    return table.join(of_class, "set_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )
