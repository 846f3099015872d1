"""Distributed total order: running row numbers / running sums without a global window.

A ``Window`` with no ``partitionBy`` (or one whose partition key is hot) pulls a whole
group into one task.  ``ordered_totals`` instead, for inputs of any size,

1. draws a sample of rows (about ``SAMPLE_PER_BUCKET`` per bucket) and reads bucket
   boundaries over the *whole* sort tuple from it, so a heavily tied leading key is still
   split by the keys behind it;
2. names every row's bucket with a binary search over literal boundaries (no layout to
   keep, no copy of the rows);
3. takes running numbers/sums inside (bucket, group) with a plain window;
4. adds per-(bucket, group) offsets.  Only the first group of a bucket can have begun in
   an earlier bucket, so the non-zero offset table has fewer rows than there are
   buckets: a broadcast with a proven bound.

Everything is a JVM expression; values never pass through Python.  Used by dense ids,
ntile scores, exact percentiles, AUC and the series filters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from prepframe._session import cut_lineage, shuffle_partitions

SAMPLE_PER_BUCKET = 20


def _item(o) -> tuple[str, bool]:
    """``"name"`` or ``("name", ascending)``; nulls sort first ascending, last descending."""
    return (o, True) if isinstance(o, str) else (o[0], bool(o[1]))


def _plain_key(df: DataFrame, name: str) -> Column:
    """An order-preserving stand-in whose literals do not depend on calendars or time zones."""
    kind = df.schema[name].dataType
    if isinstance(kind, TimestampType):
        return F.unix_micros(name)
    if isinstance(kind, TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', `{name}`)")
    if isinstance(kind, DateType):
        return F.unix_date(name)
    return F.col(name)


def _not_after(bound: Column, row: list[Column], ascending: list[bool]) -> Column:
    """Whether the boundary tuple comes before or together with the row's tuple."""
    out = F.lit(True)
    for i in reversed(range(len(row))):
        b, r = bound[f"k{i}"], row[i]
        lo, hi = (b, r) if ascending[i] else (r, b)
        before = (lo.isNull() & hi.isNotNull()) | F.coalesce(lo < hi, F.lit(False))
        out = before | (b.eqNullSafe(r) & out)
    return out


def _keys(df: DataFrame, items: list[tuple[str, bool]]) -> list[Column]:
    return [_plain_key(df, c) for c, _ in items]


def _bounds(df: DataFrame, items: list[tuple[str, bool]], ranges: int) -> tuple[list, list]:
    """At most ``ranges - 1`` distinct boundary tuples in order, and the types of their fields.

    They come from a Bernoulli sample of rows (not of key values: a repeated tuple counts as
    often as it occurs) of about SAMPLE_PER_BUCKET rows a range."""
    up = [a for _, a in items]
    named = df.select(*[k.alias(f"k{i}") for i, k in enumerate(_keys(df, items))])
    n, wanted = named.count(), SAMPLE_PER_BUCKET * ranges
    drawn = named if n <= wanted else named.sample(fraction=wanted / n, seed=17)
    order = [F.col(c).asc() if a else F.col(c).desc() for c, a in zip(named.columns, up)]
    rows = drawn.repartition(1).sortWithinPartitions(*order).collect()  # bounded: about SAMPLE_PER_BUCKET * ranges rows
    picked = [rows[len(rows) * j // ranges] for j in range(1, ranges)] if rows else []
    return [r for i, r in enumerate(picked) if i == 0 or r != picked[i - 1]], [f.dataType for f in named.schema.fields]


def _number(df: DataFrame, items: list[tuple[str, bool]], bounds: list, kinds: list) -> Column:
    """How many of the boundary tuples do not come after the row: a binary search over one literal array."""
    if not bounds:
        return F.lit(0)
    keys, up = _keys(df, items), [a for _, a in items]
    literals = F.array(*[F.struct(*[F.lit(v).cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(r, kinds))]) for r in bounds])
    steps = [1 << j for j in reversed(range(len(bounds).bit_length()))]

    def step(at: Column, s: Column) -> Column:
        fits = (at + s <= len(bounds)) & _not_after(F.get(literals, at + s - 1), keys, up)
        return F.when(fits, at + s).otherwise(at)

    return F.aggregate(F.array(*[F.lit(j) for j in steps]), F.lit(0), step)


def _bucket(df: DataFrame, items: list[tuple[str, bool]], buckets: int) -> Column:
    """Bucket number of a row among at most ``buckets`` ranges of the sort tuple."""
    return _number(df, items, *_bounds(df, items, buckets))


# Parts of a bucket that a border's neighbourhood is made of.
PARTS_PER_BUCKET = 10


def with_halo(
    df: DataFrame, order_by: Sequence, partition_by: Sequence[str], before: int, after: int, bucket: str, own: str,
    nbuckets: int | None = None,
) -> DataFrame:
    """Rows by ranges of (partition, order) tuples, each range with the rows around it.

    Adds ``bucket`` and ``own``: every row once in its own range (``own`` true) and again in
    each range that begins at most ``before`` rows after it or ends at most ``after`` rows
    before it (``own`` false).  Whole parts of a range are copied, so a range has at least the
    rows asked for; ranges hold at least four times ``before + after`` rows, so copies stay a
    bounded share.  A window over (bucket, partition) that looks so far back and ahead then
    sees what it would see in the whole partition.  One pass counts the parts; no row is
    numbered, sorted or joined, and all columns are only carried along."""
    items = [(c, True) for c in partition_by] + [_item(o) for o in order_by]
    buckets = nbuckets or shuffle_partitions(df.sparkSession)
    bounds, kinds = _bounds(df, items, PARTS_PER_BUCKET * buckets)
    part = _number(df, items, bounds, kinds)
    counted = dict(df.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())  # one row per part: bounded
    sizes = [counted.get(p, 0) for p in range(len(bounds) + 1)]
    least = max(sum(sizes) / buckets, 4 * (before + after))
    home, first, held = [], [0], 0
    for p, n in enumerate(sizes):
        home.append(len(first) - 1)
        held += n
        if held >= least and p + 1 < len(sizes):
            first.append(p + 1)
            held = 0
    ends = [x - 1 for x in first[1:]] + [len(sizes) - 1]
    targets = [[h] for h in home]
    for r, (x, y) in enumerate(zip(first, ends)):
        for start, step, wanted in ((x - 1, -1, before), (y + 1, 1, after)):
            p = start
            while 0 <= p < len(sizes) and wanted > 0:
                targets[p].append(r)
                wanted -= sizes[p]
                p += step
    places = F.array(*[F.array(*[F.struct(F.lit(t).alias("b"), F.lit(t == home[p]).alias("o")) for t in ts]) for p, ts in enumerate(targets)])
    copies = df.withColumn(bucket, F.explode(F.get(places, part)))
    return copies.withColumn(own, F.col(bucket)["o"]).withColumn(bucket, F.col(bucket)["b"])


# Rows among which the last of the first k are found by numbering instead of another histogram.
SETTLED_ROWS = 100_000


def first_rows(df: DataFrame, order_by: Sequence, k: int, nbuckets: int | None = None) -> DataFrame:
    """The ``min(k, count)`` first rows in ``order_by`` order (unsorted).

    The k-th tuple is found by histogram refinement: ranges are counted, the one that holds
    the k-th row is split again until it is small or does not shrink (equal tuples).  What lies
    before it is a filter on the rows where they are; only the rows of that last range are
    numbered.  No task merges k rows and the table is not sorted."""
    items = [_item(o) for o in order_by]
    buckets = nbuckets or shuffle_partitions(df.sparkSession)
    before, inside, need = F.lit(False), F.lit(True), int(k)
    if need <= 0:
        return df.limit(0)
    while True:
        rest = df.where(inside)
        number = _number(df, items, *_bounds(rest, items, buckets))
        counts = sorted(map(tuple, rest.groupBy(number.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()))  # one row per range: bounded
        total = sum(n for _, n in counts)
        if total <= need:
            return df.where(before | inside)
        for p, n in counts:
            if n >= need:
                break
            need -= n
        before, inside = before | (inside & (number < p)), inside & (number == p)
        if n == need:
            return df.where(before | inside)
        if n <= SETTLED_ROWS or 2 * n > total:
            break
    last = ordered_totals(df.where(inside), order_by, nbuckets=buckets).where(F.col("_rn") <= need).drop("_rn")
    return df.where(before).union(last.select(*df.columns))


def ordered_totals(
    df: DataFrame,
    order_by: Sequence,
    partition_by: Sequence[str] = (),
    sums: Sequence[str] = (),
    nbuckets: int | None = None,
    group_totals: bool = False,
) -> DataFrame:
    """Add ``_rn`` (1-based position inside ``partition_by`` in ``order_by`` order) and
    ``_cum_<c>`` (inclusive running sum) for each column in ``sums``; with ``group_totals``
    also ``_tot_n`` and ``_tot_<c>``.

    ``order_by`` holds names or ``(name, ascending)`` pairs and should make the order total
    (a unique key last) when row numbers must not depend on the physical layout.
    """
    pcols, sums = list(partition_by), list(sums)
    items = [_item(o) for o in order_by]
    buckets = nbuckets or shuffle_partitions(df.sparkSession)
    marked = df.withColumn("_b", _bucket(df, [(c, True) for c in pcols] + items, buckets).cast("int"))
    order = [F.col(c).asc() if a else F.col(c).desc() for c, a in items]
    w = Window.partitionBy("_b", *pcols).orderBy(*order)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = marked.withColumn("_rn", F.row_number().over(w).cast("long"))
    for c in sums:
        local = local.withColumn("_cum_" + c, F.sum(F.coalesce(F.col(c), F.lit(0))).over(run))

    totals = marked.groupBy("_b", *pcols).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias("_t_" + c) for c in sums])
    if group_totals:
        totals = cut_lineage(totals)  # read for the offsets and for the groups
    before = Window.partitionBy(*pcols).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("_b").alias("_o_b"),
        *[F.col(c).alias("_o_" + c) for c in pcols],
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off_n"),
        *[F.coalesce(F.sum("_t_" + c).over(before), F.lit(0)).alias("_off_" + c) for c in sums],
    ).filter(F.col("_off_n") > 0)
    cond = F.col("_b") == F.col("_o_b")
    for c in pcols:
        cond = cond & F.col(c).eqNullSafe(F.col("_o_" + c))
    # fewer rows than buckets (see module doc): bounded broadcast
    out = local.join(F.broadcast(offsets), cond, "left")
    out = out.withColumn("_rn", F.col("_rn") + F.coalesce(F.col("_off_n"), F.lit(0)))
    for c in sums:
        out = out.withColumn("_cum_" + c, F.col("_cum_" + c) + F.coalesce(F.col("_off_" + c), F.lit(0)))
    out = out.drop("_b", "_o_b", "_off_n", *["_o_" + c for c in pcols], *["_off_" + c for c in sums])
    if group_totals:
        gt = totals.groupBy(*pcols).agg(F.sum("_n").alias("_tot_n"), *[F.sum("_t_" + c).alias("_tot_" + c) for c in sums])
        out = _attach_group_table(out, gt, pcols, "left")
    return out


def ntile_expr(rn: Column, n: Column, k: int) -> Column:
    """SQL ``ntile(k)`` from a 1-based row number and the group size."""
    q = F.floor(n / k)
    r = n - q * k  # first r tiles get q + 1 rows
    big = r * (q + 1)
    return (
        F.when(rn <= big, F.floor((rn - 1) / (q + 1)) + 1)
        .otherwise(r + F.floor((rn - 1 - big) / F.greatest(q, F.lit(1))) + 1)
        .cast("int")
    )


def _pick_percentiles(ranked, g, qs, names, n_col, below_cols=None, qi_col=None):
    """From ranked distinct values (``_v``, ``_c``, ``_cum__c``) pick the values at the
    interpolation ranks of every quantile; ``below_cols[i]`` (rows under the candidate
    range of quantile i) shifts the ranks when only candidates were ranked."""
    aggs = []
    for i, (q, name) in enumerate(zip(qs, names)):
        below = F.col(below_cols[i]) if below_cols else F.lit(0)
        mine = (F.col(qi_col) == i) if qi_col else F.lit(True)
        end = below + F.col("_cum__c")  # ranks [end - _c, end - 1], 0-based
        start = end - F.col("_c")
        pos = (F.col(n_col) - 1) * F.lit(float(q))
        lo, hi = F.floor(pos), F.ceil(pos)
        aggs.append(F.max(F.when(mine & (start <= lo) & (lo < end), F.col("_v"))).alias(f"_lo_{name}"))
        aggs.append(F.max(F.when(mine & (start <= hi) & (hi < end), F.col("_v"))).alias(f"_hi_{name}"))
        aggs.append(F.max(pos - lo).alias(f"_fr_{name}"))
    picked = ranked.groupBy(*g).agg(*aggs)
    out = [F.col(c) for c in g]
    for name in names:
        lo, hi, fr = F.col(f"_lo_{name}"), F.col(f"_hi_{name}"), F.col(f"_fr_{name}")
        out.append(F.when(fr == 0, lo).otherwise(lo + (hi - lo) * fr).alias(name))
    return picked, picked.select(*out)


# A table of groups goes to the rows up to so many groups; beyond, the rows are salted.
GROUPS_SENT = 10_000
SALTS = 64


def join_groups(df: DataFrame, table: DataFrame, g: Sequence[str], how: str = "inner") -> DataFrame:
    """Add a table's columns to the rows of their group (null-safe).

    A small table goes to the rows, which stay where they are.  A larger one is joined by group
    and salt, with a copy of each group per salt, so that the rows of one group are spread over
    SALTS tasks."""
    side = table.select(*[F.col(c).alias("_gk_" + c) for c in g], *[c for c in table.columns if c not in g])
    cond = F.lit(True)
    for c in g:
        cond = cond & F.col(c).eqNullSafe(F.col("_gk_" + c))
    if table.limit(GROUPS_SENT + 1).count() <= GROUPS_SENT:
        return df.join(F.broadcast(side), cond, how).drop(*["_gk_" + c for c in g])
    side = side.withColumn("_gk_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = df.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    out = salted.join(side, cond & (F.col("_salt") == F.col("_gk_salt")), how)
    return out.drop("_salt", "_gk_salt", *["_gk_" + c for c in g])


def _attach_group_table(df: DataFrame, table: DataFrame, g: list[str], how: str = "inner") -> DataFrame:
    """Add per-group columns: literals for the global case (one row), else a null-safe join."""
    if not g:
        row = table.collect()
        vals = row[0].asDict() if row else {}
        return df.withColumns({c: F.lit(v) for c, v in vals.items()})
    return join_groups(df, table, g, how)


def exact_percentiles(
    df: DataFrame,
    value: str,
    qs: Sequence[float],
    group_by: Sequence[str] = (),
    names: Sequence[str] | None = None,
    accuracy: int = 10_000,
) -> DataFrame:
    """Exact continuous percentiles (SQL ``percentile`` / ``quantile_cont``) per group.

    1. one aggregate: per group the row count and ``percentile_approx`` brackets
       ``[q - 3/accuracy, q + 3/accuracy]`` around every quantile (its rank error is
       at most n / accuracy, so each bracket contains the exact interpolation ranks);
    2. one pass: rows below each bracket are counted, rows inside it are the only
       candidates kept - about 6 n / accuracy per quantile;
    3. candidates are reduced to (group, value, count) and ranked with
       ``ordered_totals``; the picked ranks are shifted by the counts below.

    If a bracket ever misses (it should not), every distinct value is ranked.  Nulls and NaN are skipped.  One row per group: group keys + one
    column per quantile (``names`` or ``q_<i>``).
    """
    g = list(group_by)
    names = list(names) if names else [f"q_{i}" for i in range(len(qs))]
    k = len(qs)
    base = df.select(*g, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    d = 3.0 / accuracy
    probs = [max(0.0, q - d) for q in qs] + [min(1.0, q + d) for q in qs]
    brackets = base.groupBy(*g).agg(
        F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", probs, accuracy).alias("_pa")
    )
    brackets = brackets.select(
        *g, "_n", *[F.col("_pa")[i].alias(f"_blo{i}") for i in range(k)], *[F.col("_pa")[k + i].alias(f"_bhi{i}") for i in range(k)]
    )
    if g:
        brackets = cut_lineage(brackets)  # one row per group, read twice below
    rows = _attach_group_table(base, brackets, g)
    v = F.col("_v")
    # one pass: every row is "below bracket i" (value null) or "candidate of bracket i"
    tags = F.array(*[
        F.when(v < F.col(f"_blo{i}"), F.struct(F.lit(i).alias("qi"), F.lit(None).cast("double").alias("v")))
        .when(v <= F.col(f"_bhi{i}"), F.struct(F.lit(i).alias("qi"), v.alias("v")))
        for i in range(k)
    ])
    tagged = (
        rows.select(*g, F.explode(tags).alias("_t"))
        .where(F.col("_t").isNotNull())
        .groupBy(*g, F.col("_t.qi").alias("_qi"), F.col("_t.v").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    tagged = cut_lineage(tagged)  # candidates + one "below" row per (group, quantile): small
    below = tagged.where(F.col("_v").isNull()).groupBy(*g).agg(
        *[F.coalesce(F.sum(F.when(F.col("_qi") == i, F.col("_c"))), F.lit(0)).alias(f"_below{i}") for i in range(k)]
    )
    cand = tagged.where(F.col("_v").isNotNull())
    ranked = ordered_totals(cand, ["_v"], partition_by=g + ["_qi"], sums=["_c"])
    sizes = brackets.select(*g, "_n")
    if g:
        per_group = sizes.join(below, g, "left").fillna(0, [f"_below{i}" for i in range(k)])
    else:
        per_group = _attach_group_table(sizes, below, [])  # a global aggregate always has one row
    ranked = _attach_group_table(ranked, per_group, g)
    picked, result = _pick_percentiles(ranked, g, qs, names, "_n", [f"_below{i}" for i in range(k)], "_qi")
    result = cut_lineage(result)
    miss = F.lit(False)
    for nm in names:
        miss = miss | F.col(nm).isNull()
    misses = result.where(miss)
    if misses.limit(1).count() == 0:
        return result
    return _exact_percentiles_full(df, value, qs, g, names)


def _exact_percentiles_full(df, value, qs, g, names):
    """Rank every distinct value (the fallback: no bracketing)."""
    vals = (
        df.select(*g, F.col(value).cast("double").alias("_v"))
        .where(F.col("_v").isNotNull() & ~F.isnan("_v"))
        .groupBy(*g, "_v")
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    ranked = ordered_totals(vals, ["_v"], partition_by=g, sums=["_c"], group_totals=True)
    _, result = _pick_percentiles(ranked, g, qs, names, "_tot__c")
    return cut_lineage(result)
