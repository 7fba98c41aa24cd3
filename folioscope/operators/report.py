"""Report tables: sheets, roll-ups, standard scores and histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def list_sheet(df: DataFrame, key: str, items: str, name: str) -> DataFrame:
    """(key, item) rows of a list column; a null or empty list is one row with a null item."""
    return df.select(key, F.explode_outer(items).alias(name))


def map_sheet(df: DataFrame, key: str, items: str) -> DataFrame:
    """(key, name, value) rows of a map column; a null or empty map is one row with nulls."""
    return df.select(key, F.explode_outer(items).alias("name", "value"))


def joined_lists(df: DataFrame) -> DataFrame:
    """List cells as comma-separated text, for flat files."""
    lists = {f.name for f in df.schema if f.dataType.typeName() == "array"}
    return df.select(*[F.array_join(c, ", ").alias(c) if c in lists else F.col(c) for c in df.columns])


def standard_scores(df: DataFrame, columns: list[str]) -> DataFrame:
    """``z_<column>``: distance from the mean in sample standard deviations.

    Mean and deviation are one aggregated row that every row gets; a window over the whole table would put it in one task.
    """
    moments = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("avg", F.avg), ("std", F.stddev_samp))]

    def score(c: str) -> Column:
        return F.round(F.try_divide(F.col(c) - F.col(f"avg_{c}"), F.col(f"std_{c}")), 6).alias(f"z_{c}")

    return _with_totals(df, moments).select(*df.columns, *[score(c) for c in columns])


def _with_totals(df: DataFrame, totals: list[Column]) -> DataFrame:
    """``df`` with one row of totals beside every row; that row is all that is broadcast."""
    one = df.agg(*totals).withColumn("_one", F.lit(1))
    return df.withColumn("_one", F.lit(1)).join(F.broadcast(one), "_one").drop("_one")


def order_statistics(df: DataFrame, value: str, ranks: list[int], ranges: int = 2_048, few: int = 20_000) -> list:
    """The values at the given ranks (from 0) among the non-null numbers of a column, exactly.

    Values are counted per range of equal width, the ranges that hold a rank are divided again, and the few values of the last ones
    are counted one by one. A step is one small aggregation of at most ``ranges`` rows for each rank, and no task holds the values. Ranges that
    can't be divided further hold one value.
    """
    v = F.col(value).cast("double")
    known = df.where(v.isNotNull())
    low, high = known.agg(F.min(v), F.max(v)).first()
    found = {}
    # per rank: the range, how many values lie below it, and how many in it
    open_ = {r: (low, high, 0) for r in ranks}
    while open_:
        spans = sorted({(a, b, below) for a, b, below in open_.values()})
        place = lambda a, b: F.least(F.floor((v - a) / (b - a) * ranges), F.lit(ranges - 1)).cast("long") if b > a else F.lit(0).cast("long")
        within = F.coalesce(*[F.when(v.between(a, b), F.struct(F.lit(i).alias("span"), place(a, b).alias("place"))) for i, (a, b, _) in enumerate(spans)])
        counted = known.select(v.alias("v"), within.alias("w")).where("w IS NOT NULL").groupBy("w").agg(F.count("*").alias("n"), F.min("v").alias("least"), F.max("v").alias("most")).collect()
        for rank, (a, b, below) in list(open_.items()):
            i = spans.index((a, b, below))
            for row in sorted((r for r in counted if r.w.span == i), key=lambda r: r.w.place):
                if below <= rank < below + row.n:
                    if row.least == row.most:
                        found[rank] = row.least
                        del open_[rank]
                    elif row.n <= few:
                        values = known.where(v.between(row.least, row.most)).groupBy(v.alias("v")).count().collect()
                        at = below
                        for x in sorted(values):
                            at += x["count"]
                            if rank < at:
                                found[rank] = x.v
                                break
                        del open_[rank]
                    else:
                        open_[rank] = (row.least, row.most, below)
                    break
                below += row.n
    return [found[r] for r in ranks]


def exact_median(df: DataFrame, value: str) -> float | None:
    """The middle value, or the mean of the two in the middle; null without values."""
    n = df.where(F.col(value).isNotNull()).count()
    if not n:
        return None
    low, high = order_statistics(df, value, [(n - 1) // 2, n // 2])
    return (low + high) / 2


def summary_stats(df: DataFrame, value: str) -> DataFrame:
    """(n, mean, median, largest) of a column; the median by selection, not by one task's list of values."""
    v = F.col(value)
    middle = exact_median(df, value)
    return df.agg(F.count(v).alias("n"), F.round(F.avg(v), 6).alias("mean"), F.lit(middle).cast("double").alias("median"), F.max(v).alias("largest"))


def log_histogram(df: DataFrame, value: str, low: float, high: float, bins: int = 30) -> DataFrame:
    """(bin, n) over log10 of the positive values."""
    return df.where(F.col(value) > 0).groupBy(F.width_bucket(F.log10(value), F.lit(low), F.lit(high), F.lit(bins)).cast("long").alias("bin")).agg(F.count("*").alias("n"))


def first_sorted(df: DataFrame, k: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(k)


def normalised(df: DataFrame, column: str) -> DataFrame:
    """``rel_<column>``: share of the column's total."""
    return _with_totals(df, [F.sum(column).alias("_total")]).withColumn(f"rel_{column}", F.try_divide(F.col(column), F.col("_total"))).drop("_total")
