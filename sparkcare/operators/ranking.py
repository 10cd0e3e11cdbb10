"""Exact global positions and quantiles without a single-task window and without a
stored or checkpointed copy.

``Window.orderBy(...)`` without ``partitionBy`` (or a window partitioned by a
hot key) sends every row of the frame (or of the hot group) to one task.  Here the line of
keys is cut at points taken from a sample: the cut points are literals of the plan, so a row's part
follows from its content alone, and a part is small enough for a window of its own.

Positions follow a total order made of content: the order columns, then a digest of the
whole row.  Rows with equal order columns therefore spread over parts like any others (only
rows that are equal in every column stay together, and they can change places), and neither a
recomputed task nor other cut points give another numbering: cut points decide where a row
is numbered, not its number.

Quantiles are selected, not sorted out: a sketch brackets each wanted rank, one pass counts
what lies below the bracket and gathers the distinct values inside it with their counts, and only
those are ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_PARTS = 4096
SAMPLE_PER_PART = 32
DIGEST, PART, OFF, PLACE = "_rk_digest", "_rk_part", "_rk_off", "_rk_place"


def parts_of(df: DataFrame, num_partitions: int | None = None) -> int:
    """How many parts to cut into: as many as the session shuffles into, up to MAX_PARTS."""
    return max(1, min(MAX_PARTS, num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def evenly(points: list, parts: int) -> list:
    """The ``parts`` - 1 points that cut a sorted sample into parts of equal size."""
    cuts = [points[len(points) * i // parts] for i in range(1, parts)] if points else []
    return [c for i, c in enumerate(cuts) if i == 0 or c != cuts[i - 1]]


def part_of(key: Column, cuts: list[Column]) -> Column:
    """How many of the ascending ``cuts`` are at or below ``key``, found in two steps of about
    a square root of their number."""
    if not cuts:
        return F.lit(0)
    width = max(1, int(len(cuts) ** 0.5))
    rows = [cuts[i:i + width] for i in range(0, len(cuts), width)]
    row = F.size(F.filter(F.array(*(r[0] for r in rows)), lambda c: c <= key))
    inner = F.element_at(F.array(*(F.array(*r) for r in rows)), F.greatest(row, F.lit(1)))
    return F.when(row == 0, F.lit(0)).otherwise(
        (row - 1) * width + F.size(F.filter(inner, lambda c: c <= key)))


def cut_points(df: DataFrame, keys: list[str], parts: int) -> list[Column]:
    """Ascending structs of ``keys`` that cut ``df`` into about equal parts, from a random
    sample of SAMPLE_PER_PART rows for each part (at most MAX_PARTS * SAMPLE_PER_PART)."""
    if parts < 2:
        return []
    sample = df.select(*keys).orderBy(F.rand(11)).limit(parts * SAMPLE_PER_PART).orderBy(*keys).collect()
    types = [df.schema[k].dataType for k in keys]
    return [F.struct(*(F.lit(v).cast(t).alias(k) for v, t, k in zip(row, types, keys))) for row in evenly(sample, parts)]


def rank_rows(df: DataFrame, order_cols: list, group_cols: list[str] | None = None,
              rank_col: str = "rank", start: int = 1, num_partitions: int | None = None) -> DataFrame:
    """Add ``rank_col``: the exact 1-based (or ``start``-based) position of each row in
    ``order_cols`` order within ``group_cols``.  Rows with equal order columns are ordered by
    a digest of the row, so the positions are distinct and the same in every run."""
    groups = list(group_cols or [])
    orders = {f"_rk_o{i}": F.col(c) if isinstance(c, str) else c for i, c in enumerate(order_cols)}
    keys = [*groups, *orders, DIGEST]
    rows = df.withColumns({**orders, DIGEST: F.unhex(F.md5(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})))})
    parts = parts_of(df, num_partitions)
    rows = rows.withColumn(PART, part_of(F.struct(*keys), cut_points(rows, keys, parts)))
    # One row per (part, group): at most parts + groups rows.
    before = Window.partitionBy(*(groups or [F.lit(0)])).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.groupBy(PART, *groups).agg(F.count(F.lit(1)).alias("_rk_n"))
               .select(F.col(PART).alias("_rk_p"), *(F.col(c).alias(f"_rk_g{i}") for i, c in enumerate(groups)),
                       F.coalesce(F.sum("_rk_n").over(before), F.lit(0)).alias(OFF)))
    inner = F.row_number().over(Window.partitionBy(PART, *groups).orderBy(*orders, DIGEST))
    same = F.col(PART) == F.col("_rk_p")
    for i, c in enumerate(groups):
        same = same & F.col(c).eqNullSafe(F.col(f"_rk_g{i}"))
    return rows.withColumn(PLACE, inner).join(offsets, same).select(
        *df.columns, (F.col(OFF) + F.col(PLACE) + F.lit(start - 1)).cast("bigint").alias(rank_col))


def with_sequence(df: DataFrame, order_cols: list, name: str = "sequence_num", start: int = 1,
                  num_partitions: int | None = None) -> DataFrame:
    """K5: surrogate sequence number in ``order_cols`` order (a database sequence's
    ``nextval`` per inserted row), computed without an unpartitioned window."""
    return rank_rows(df, order_cols, None, name, start, num_partitions)


# --- quantiles by selection ---------------------------------------------------------------

SMALL = 20_000        # groups of at most so many values are their own bracket
ACCURACY = 10_000     # ranks in a sketch are off by a ten-thousandth at most ...
GRID = 500            # ... and brackets reach two five-hundredths to either side of it
MOST_RANKED = 5_000_000
FEW_GROUPS = 1_000    # so many groups' brackets are handed to every task


def _at(old: Column, rank: Column, of: Column, step: int) -> Column:
    """The value ``step`` grid points from where ``rank`` of ``of`` values lies in a sketched ``grid``; beyond the
    grid, or for few values, the bracket's old end."""
    at = (F.floor(rank / of * GRID) + 1 + step).cast("int")
    return F.when((of <= SMALL) | (at < 1) | (at > GRID + 1), old).otherwise(F.get("grid", at - 1))


def _sketch() -> Column:
    return F.percentile_approx("v", [i / GRID for i in range(GRID + 1)], ACCURACY).alias("grid")


def _narrower(brackets: DataFrame, vals: DataFrame, names: list[str], k: int, spread: bool) -> DataFrame:
    """``brackets`` after another round: ``vals`` (groups, v) are sketched inside each."""
    sketch = _inside(vals, brackets, names, spread).groupBy(*names, "prob").agg(_sketch(), F.count(F.lit(1)).alias("inside"))
    wide = _null_safe(_null_safe(brackets, _below(vals, brackets, names, k, spread), [*names, "prob"]), sketch, [*names, "prob"])
    place = lambda end, step: _at(F.col(end), F.col(f"r_{end}") - F.col("below"), F.col("inside"), step).alias(end)
    return wide.select(*names, "prob", "n", "frac", "r_lo", "r_hi", place("lo", -2), place("hi", 3))


def _null_safe(left: DataFrame, right: DataFrame, names: list[str]) -> DataFrame:
    """Inner join on ``names``, nulls equal, with one set of them."""
    right = right.withColumnsRenamed({c: f"_{c}" for c in names})
    same = F.lit(True)
    for c in names:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return left.join(right, same).drop(*(f"_{c}" for c in names))


def _by_group(brackets: DataFrame, names: list[str], spread: bool) -> DataFrame:
    """One row per group: its ``brackets`` in order of prob.  Of few groups (``spread``) they go to the values:
    dealt by group, the values would meet in as few tasks as there are groups."""
    rows = brackets.groupBy(*names).agg(F.array_sort(F.collect_list(F.struct("prob", "lo", "hi"))).alias("brackets"))
    return F.broadcast(rows) if spread else rows


def _inside(vals: DataFrame, brackets: DataFrame, names: list[str], spread: bool) -> DataFrame:
    """(groups, prob, v): every value with the brackets it lies in."""
    near = F.filter("brackets", lambda b: (F.col("v") >= b["lo"]) & (F.col("v") <= b["hi"]))
    return _null_safe(vals, _by_group(brackets, names, spread), names).select(
        *names, "v", F.explode(near).alias("b")).select(*names, F.col("b.prob").alias("prob"), "v")


def _below(vals: DataFrame, brackets: DataFrame, names: list[str], k: int, spread: bool) -> DataFrame:
    """(groups, prob, below): how many values lie under each of a group's ``k`` brackets."""
    groups = _by_group(brackets, names, False).select(*names, *(
        F.get("brackets", F.lit(i))[c].alias(f"{c}{i}") for i in range(k) for c in ("prob", "lo")))
    sums = _null_safe(vals, F.broadcast(groups) if spread else groups, names).groupBy(*names).agg(F.array(*(F.struct(
        F.first(f"prob{i}").alias("prob"), F.count_if(F.col("v") < F.col(f"lo{i}")).alias("below")) for i in range(k))).alias("x"))
    return sums.select(*names, F.inline("x"))


def exact_quantiles(df: DataFrame, value_col: str, probs: list[float],
                    group_cols: list[str] | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation between order statistics (the
    ``percentile`` / ``quantile_cont`` definition), per group.

    Returns one row per group and probability: group cols, ``prob``, ``n`` (non-null
    values) and ``value``.  Each round of sketches narrows a bracket to less than a fiftieth of its
    values; one round does unless a group has more than 50 * MOST_RANKED values.  Many equal
    values are one distinct value with a count.
    """
    groups = list(group_cols or [])
    names = [f"_g{i}" for i in range(len(groups))] or ["_g"]
    vals = df.select(*(F.col(c).alias(n) for c, n in zip(groups, names)), *([] if groups else [F.lit(0).alias("_g")]),
                     F.col(value_col).cast("double").alias("v")).where(F.col("v").isNotNull())
    rank = (F.col("n") - 1) * F.col("prob")
    low, high = F.lit(float("-inf")), F.lit(float("nan"))  # NaN is above every number
    lo, hi = F.floor(rank) + 1, F.least(F.floor(rank) + 2, F.col("n"))
    sizes = vals.groupBy(*names).count().agg(F.max("count").alias("most"), F.count(F.lit(1)).alias("groups")).first()
    most, spread = sizes["most"] or 0, sizes["groups"] <= FEW_GROUPS
    few = most <= SMALL
    stats = vals.groupBy(*names).agg(F.count(F.lit(1)).alias("n"), *([] if few else [_sketch()]))
    brackets = (stats.withColumn("prob", F.explode(F.array(*map(F.lit, map(float, probs))))).select(
        *names, "prob", "n", (rank - F.floor(rank)).alias("frac"), lo.cast("long").alias("r_lo"), hi.cast("long").alias("r_hi"),
        (low if few else _at(low, lo, F.col("n"), -2)).alias("lo"), (high if few else _at(high, hi, F.col("n"), 3)).alias("hi")))
    while most / 50 > MOST_RANKED:
        brackets, most = _narrower(brackets, vals, names, len(probs), spread), most / 50
    brackets_below = _null_safe(brackets, _below(vals, brackets, names, len(probs), spread), [*names, "prob"])
    counts = _inside(vals, brackets, names, spread).groupBy(*names, "prob", "v").agg(F.count(F.lit(1)).alias("c"))
    upto = F.sum("c").over(Window.partitionBy(*names, "prob").orderBy("v"))
    ranked = _null_safe(counts.withColumn("upto", upto), brackets_below, [*names, "prob"])
    holds = lambda r: F.max(F.when((F.col("below") + F.col("upto") - F.col("c") < F.col(r))
                                   & (F.col("below") + F.col("upto") >= F.col(r)), F.col("v")))
    found = ranked.groupBy(*names, "prob", "n", "frac").agg(holds("r_lo").alias("x"), holds("r_hi").alias("y"))
    return found.select(*(F.col(n).alias(c) for c, n in zip(groups, names)), "prob", "n",
                        (F.col("x") + F.col("frac") * (F.col("y") - F.col("x"))).alias("value"))
