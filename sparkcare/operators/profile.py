"""Table profiling.

All counts and moments are hash aggregates with map-side partial aggregation,
so a hot value is combined inside each task before the shuffle.  Several
columns are profiled in ONE pass by unpivoting them to (column_name, value)
rows and grouping on the column name.  Quantiles are exact and come from
``ranking.exact_quantiles`` (range-partitioned sort), never from gathering a
group's values in one task.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import exact_quantiles, rank_rows

LETTER_VALUE_PROBS = [1 / 16, 1 / 8, 1 / 4, 1 / 2, 3 / 4, 7 / 8, 15 / 16]


def _count() -> Column:
    return F.count(F.lit(1))


def value_counts(df: DataFrame, col: str, include_null: bool = False,
                 value_name: str | None = None, count_name: str = "count") -> DataFrame:
    """A1 (nulls dropped, pandas) / A2 (null group kept, Polars group count).
    Rows are ordered by count descending, then value."""
    src = df if include_null else df.where(F.col(col).isNotNull())
    out = src.groupBy(F.col(col).alias(value_name or col)).agg(_count().alias(count_name))
    return out.orderBy(F.desc(count_name), F.asc_nulls_first(value_name or col))


def group_count(df: DataFrame, col: str) -> DataFrame:
    """A2: ``groupby([c]).count().sort('count', reverse=True)`` with the null group kept."""
    return value_counts(df, col, include_null=True)


def value_counts_struct(df: DataFrame, col: str, names=("category_value", "instance_count")) -> DataFrame:
    """A3 + P11: counts packed as ``struct(value, count)``, fields renamed, then unnested."""
    packed = (df.where(F.col(col).isNotNull()).groupBy(col).agg(_count().alias("count"))
              .select(F.struct(F.col(col).alias(names[0]), F.col("count").alias(names[1])).alias("value_count")))
    return packed.select("value_count.*").orderBy(F.desc(names[1]), F.asc(names[0]))


def top_values(df: DataFrame, col: str, k: int = 5) -> DataFrame:
    """L2: the k most frequent values (TakeOrderedAndProject: each task keeps its k best)."""
    return value_counts(df, col).limit(k)


def group_lists(df: DataFrame, key: str, cols: list[str], chunk_size: int = 10_000) -> DataFrame:
    """A4, text form (as the twin compares it): per key, the count and the sorted non-null
    values of each column, joined by '|'.  ``group_arrays`` has the values themselves.

    A group can be arbitrarily large, so its list is cut into chunks of at most
    ``chunk_size`` values (rows: key, column_name, chunk_no, n_values, values).
    Positions come from ``rank_rows`` (range-partitioned sort), so a hot key is
    spread over many tasks; no list longer than ``chunk_size`` is ever built.
    """
    long = df.select(F.col(key), F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in cols])).alias("x")) \
        .select(key, "x.column_name", "x.v").where(F.col("v").isNotNull())
    ranked = rank_rows(long, ["v"], [key, "column_name"], rank_col="_pos", start=0)
    chunks = ranked.withColumn("chunk_no", (F.col("_pos") / chunk_size).cast("bigint"))
    return (chunks.groupBy(key, "column_name", "chunk_no")
            .agg(F.count(F.lit(1)).alias("n_values"),
                 F.array_join(F.sort_array(F.collect_list("v")), "|").alias("values")))


def _in_chunks(df: DataFrame, key: str, item: Column, order: str, chunk_size: int) -> DataFrame:
    """k, chunk_no, items: per key the items in the order of a column, nulls first and kept,
    in arrays of at most ``chunk_size``."""
    rows = df.select(F.col(key).alias("k"), F.col(order).alias("o"), item.alias("item"))
    ranked = rank_rows(rows, ["o"], ["k"], rank_col="pos", start=0)
    chunk = F.floor(F.col("pos") / chunk_size).cast("bigint").alias("chunk_no")
    # the item inside a struct, because collect_list drops a bare null
    return ranked.groupBy("k", chunk).agg(F.transform(
        F.array_sort(F.collect_list(F.struct("pos", "item"))), lambda x: x["item"]).alias("items"))


def group_arrays(df: DataFrame, key: str, cols: list[str], chunk_size: int = 10_000) -> DataFrame:
    """A4: per key, its row count and each column's values as an array of the column's own
    type, sorted, nulls first: key, chunk_no, group_count, then ``cols``.

    Arrays are cut at ``chunk_size`` like the lists of ``group_lists``; every column of a
    key has the same number of values, so its chunks line up.  A null key is a group."""
    sizes = df.groupBy(F.col(key).alias("k")).agg(_count().alias("group_count"))
    out = None
    for i, c in enumerate(cols):
        part = _in_chunks(df, key, F.col(c), c, chunk_size).withColumnsRenamed(
            {"k": f"k{i}", "chunk_no": f"c{i}", "items": f"v{i}"})
        out = part if out is None else out.join(
            part, F.col("k0").eqNullSafe(F.col(f"k{i}")) & (F.col("c0") == F.col(f"c{i}")))
    return out.join(sizes, F.col("k0").eqNullSafe(F.col("k"))).select(
        F.col("k0").alias(key), F.col("c0").alias("chunk_no"), "group_count",
        *(F.col(f"v{i}").alias(c) for i, c in enumerate(cols)))


def group_value_counts(df: DataFrame, key: str, col: str, chunk_size: int = 10_000) -> DataFrame:
    """A4: per key, the distinct values of a column with their counts as an array of
    ``struct(value, count)`` in value order, a null among them: key, chunk_no, value_counts."""
    counts = df.groupBy(F.col(key).alias("k"), F.col(col).alias("value")).agg(_count().alias("count"))
    return _in_chunks(counts, "k", F.struct("value", "count"), "value", chunk_size).select(
        F.col("k").alias(key), "chunk_no", F.col("items").alias("value_counts"))


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """``isnull().sum()`` for every column in one aggregate; long result."""
    cols = cols or df.columns
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in cols])).alias("x")) \
        .select("x.*")


def table_profile(df: DataFrame) -> DataFrame:
    """``info()`` - column name, type, non-null count and row count in one pass."""
    cols = df.columns
    one = df.agg(_count().alias("_rows"), *[F.count(F.col(c)).alias(f"_nn{i}") for i, c in enumerate(cols)])
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"), F.lit(types[c]).alias("data_type"),
                 F.col(f"_nn{i}").alias("non_null"), F.col("_rows").alias("row_count"))
        for i, c in enumerate(cols)])).alias("x")).select("x.*")


def _unpivot_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in cols])).alias("x")) \
        .select("x.*")


def describe(df: DataFrame, cols: list[str], digits: int = 4) -> DataFrame:
    """Count, mean, std (sample), min, 25/50/75 % (exact, interpolated), max per
    numeric column; one row per column."""
    long = _unpivot_numeric(df, cols)
    moments = long.groupBy("column_name").agg(
        F.count("value").alias("count"), F.round(F.avg("value"), digits).alias("mean"),
        F.round(F.stddev_samp("value"), digits).alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    q = exact_quantiles(long, "value", [0.25, 0.5, 0.75], ["column_name"])
    qw = q.groupBy("column_name").agg(*[
        F.round(F.max(F.when(F.col("prob") == p, F.col("value"))), digits).alias(name)
        for p, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
    return moments.join(qw, "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def category_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count per value of several category columns in one shuffle."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols])).alias("x")) \
        .select("x.*")
    return long.groupBy("column_name", "value").agg(_count().alias("count"))


def group_mean(df: DataFrame, keys: list[str], value: str, digits: int = 4, ci: bool = False) -> DataFrame:
    """Mean of ``value`` per group; with ``ci`` also n, sample sd and a normal
    95 % interval (mean +- 1.96 sd / sqrt(n))."""
    aggs = [F.avg(value).alias("_mean")]
    if ci:
        aggs += [_count().alias("n"), F.stddev_samp(value).alias("_sd")]
    g = df.groupBy(*keys).agg(*aggs)
    out = [*keys, F.round("_mean", digits).alias(f"mean_{value}")]
    if ci:
        half = F.lit(1.96) * F.col("_sd") / F.sqrt(F.col("n"))
        out += ["n", F.round("_sd", digits).alias(f"sd_{value}"),
                F.round(F.col("_mean") - half, digits).alias("ci_low"),
                F.round(F.col("_mean") + half, digits).alias("ci_high")]
    return g.select(*out)


def letter_values(df: DataFrame, value: str, group_col: str, digits: int = 6) -> DataFrame:
    """A10: letter-value quantiles (1/16 ... 15/16) of ``value`` per group; exact."""
    q = exact_quantiles(df, value, LETTER_VALUE_PROBS, [group_col])
    return q.select(group_col, F.round("prob", 6).alias("prob"), "n", F.round("value", digits).alias("value"))


def histogram(df: DataFrame, cols: list[str], bins: int = 30, digits: int = 6) -> DataFrame:
    """Equal-width histogram per column (numpy rule: the top edge belongs to the
    last bin).  One pass for min/max, one for the counts; empty bins are listed."""
    long = _unpivot_numeric(df, cols).where(F.col("value").isNotNull())
    stats = long.groupBy("column_name").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    width = (F.col("hi") - F.col("lo"))
    idx = F.when(width == 0, F.lit(1)).otherwise(
        F.least(F.floor((F.col("value") - F.col("lo")) / width * bins) + 1, F.lit(bins))).cast("int")
    # stats has one row per column: a bounded, tiny build side
    counts = long.join(F.broadcast(stats), "column_name").groupBy("column_name", idx.alias("bin")) \
        .agg(_count().alias("count"))
    all_bins = stats.select("column_name", "lo", "hi", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    edge = lambda k: F.round(F.col("lo") + (F.col("hi") - F.col("lo")) * k / bins, digits)
    return all_bins.join(counts, ["column_name", "bin"], "left").select(
        "column_name", "bin", edge(F.col("bin") - 1).alias("bin_low"), edge(F.col("bin")).alias("bin_high"),
        F.coalesce("count", F.lit(0)).alias("count"))


SUMS_AT_ONCE = 90  # generated code holds up to 100 fields of an aggregate


def correlation(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Pearson correlation matrix (long form: col_a, col_b, corr) over the rows in which
    both columns have a value.

    Two passes: means and counts of all columns, then the matrix of centred products, one
    sum for each pair.  Sums of a column over the rows of another one are only needed where
    that one has nulls, so complete columns need no more than the matrix.  Sums are partial
    sums in generated code, SUMS_AT_ONCE in one aggregate."""
    cols = list(cols)
    first = df.agg(_count().alias("n"), *(F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)),
                   *(F.count(c).alias(f"k{i}") for i, c in enumerate(cols))).first()  # one row
    x = [F.col(c).cast("double") - F.lit(first[f"m{i}"] or 0.0) for i, c in enumerate(cols)]
    held = [first[f"k{i}"] for i in range(len(cols))]
    gaps = [k < first["n"] for k in held]
    sums: dict[str, Column] = {}

    def over(a: int, b: int, power: int) -> Column:
        """Sum of a power of a's centred values over the rows that have a value of b too."""
        name = f"s{power}_{a}_{b if gaps[b] else a}"
        value = x[a] if power == 1 else x[a] * x[a]
        sums[name] = F.sum(F.when(F.col(cols[b]).isNotNull(), value) if gaps[b] else value)
        return F.col(name)

    def rows(a: int, b: int) -> Column:
        if not (gaps[a] and gaps[b]):
            return F.nullif(F.lit(float(min(held[a], held[b]))), F.lit(0.0))
        sums[f"n_{a}_{b}"] = F.sum(F.when(F.col(cols[a]).isNotNull() & F.col(cols[b]).isNotNull(), F.lit(1.0)))
        return F.col(f"n_{a}_{b}")

    items = [F.struct(F.lit(c).alias("col_a"), F.lit(c).alias("col_b"), F.lit(1.0).alias("corr")) for c in cols]
    for i, j in combinations(range(len(cols)), 2):
        sums[f"p_{i}_{j}"] = F.sum(x[i] * x[j])
        n, si, sj = rows(i, j), over(i, j, 1), over(j, i, 1)
        vi, vj = over(i, j, 2) - si * si / n, over(j, i, 2) - sj * sj / n
        v = F.when((vi > 0) & (vj > 0), F.round((F.col(f"p_{i}_{j}") - si * sj / n) / F.sqrt(vi * vj), digits))
        for a, b in ((i, j), (j, i)):
            items.append(F.struct(F.lit(cols[a]).alias("col_a"), F.lit(cols[b]).alias("col_b"), v.alias("corr")))
    names = list(sums)
    one = None
    for at in range(0, len(names), SUMS_AT_ONCE):
        part = df.agg(*(sums[k].alias(k) for k in names[at:at + SUMS_AT_ONCE]))
        one = part if one is None else one.join(F.broadcast(part), F.lit(True))  # one row each
    if one is None:
        one = df.sparkSession.range(1)
    return one.select(F.explode(F.array(*items)).alias("x")).select("x.*")


def is_empty(df: DataFrame) -> bool:
    """Whether ``df`` has no row; reads no more than it takes to find one."""
    return df.isEmpty()


def empty_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """A14 for several frames: table_name, is_empty.  Each frame gives one row at most."""
    out = None
    for name, df in tables.items():
        one = df.select(F.lit(1).alias("x")).limit(1).agg((_count() == 0).alias("is_empty")).select(
            F.lit(name).alias("table_name"), "is_empty")
        out = one if out is None else out.unionByName(one)
    return out
