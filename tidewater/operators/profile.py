"""Column profiling: null/blank counts, distinct counts, stats, frequencies, bins.

Every multi-column profile is ONE scan with N partial aggregates (map-side combined)
followed by a tiny unpivot of the single result row into long form
(column_name, metric columns...).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from tidewater.functions.scoring import nonblank_count, score_bin
from tidewater.functions.text import is_blank
from tidewater.session import stored


def _cols(df: DataFrame, cols: list[str] | None) -> list[str]:
    return list(cols) if cols else list(df.columns)


def _long(one_row: DataFrame, names: list[str], metrics: dict[str, str]) -> DataFrame:
    """Unpivot a one-row frame of ``{metric}__{i}`` columns into one row per column name."""
    rows = F.array(*[
        F.struct(F.lit(n).alias("column_name"),
                 *[F.col(f"{m}__{i}").alias(m) for m in metrics])
        for i, n in enumerate(names)])
    return one_row.select(F.inline(rows))


def profile_nulls(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Per column: rows that are NULL (or '' for strings), their % of all rows, and the total."""
    names = _cols(df, cols)
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs = [F.count(F.lit(1)).alias("_total")]
    for i, c in enumerate(names):
        aggs.append(F.count_if(is_blank(F.col(c), types[c])).alias(f"null_count__{i}"))
    one = df.agg(*aggs)
    derived = {}
    for i in range(len(names)):
        derived[f"null_pct__{i}"] = F.when(
            F.col("_total") > 0, F.col(f"null_count__{i}").cast("double") * 100 / F.col("_total"))
        derived[f"total_rows__{i}"] = F.col("_total")
    return _long(one.withColumns(derived), names,
                 {"null_count": "long", "null_pct": "double", "total_rows": "long"})


def profile_distinct(df: DataFrame, cols: list[str] | None = None, approx: bool = False,
                     rsd: float = 0.05) -> DataFrame:
    """Per column: number of distinct non-NULL values.

    Exact mode unpivots to (column, value-as-text) pairs and de-duplicates them with a
    map-side-combined aggregate, so 100+ columns cost one shuffle instead of an N-way
    Expand; approx mode is a single-pass HyperLogLog++ per column.
    """
    names = _cols(df, cols)
    if approx:
        one = df.agg(*[F.approx_count_distinct(c, rsd).alias(f"distinct_count__{i}")
                       for i, c in enumerate(names)])
        return _long(one, names, {"distinct_count": "long"})
    # -0.0 is 0.0 to SQL but not to text
    plain = {f.name: F.col(f"`{f.name}`") + 0.0 if f.dataType.typeName() in ("double", "float") else F.col(f"`{f.name}`")
             for f in df.schema.fields}
    pairs = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), plain[c].cast(StringType()).alias("_v")) for c in names])))
    # distinct pairs first (combined map-side); a column without values keeps its NULL pair and counts 0
    return pairs.distinct().groupBy("column_name").agg(F.count("_v").alias("distinct_count"))


def profile_stats(df: DataFrame, col: str, high: float = 100) -> DataFrame:
    """min / max / avg of a numeric column, rows above ``high`` and NULL rows (one row)."""
    c = F.col(col)
    return df.agg(F.min(c).alias("min_value"), F.max(c).alias("max_value"),
                  F.avg(c).alias("avg_value"),
                  F.count_if(c > high).alias("above_max"),
                  F.count_if(c.isNull()).alias("null_count"),
                  F.count(F.lit(1)).alias("total_rows"))


def value_freq(df: DataFrame, col: str | Column, name: str = "value") -> DataFrame:
    """Frequency of each value, most frequent first (ties by value)."""
    c = F.col(col) if isinstance(col, str) else col
    return (df.groupBy(c.alias(name)).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc_nulls_first(name)))


def topk_freq(df: DataFrame, col: str | Column, k: int = 20, name: str = "value") -> DataFrame:
    """The k most frequent values (a top-k report: the limit is the feature)."""
    return value_freq(df, col, name).limit(k)


def topk_exact(df: DataFrame, col: str, k: int = 20, name: str = "value", buckets: int = 1 << 16) -> DataFrame:
    """As ``topk_freq``, ties included, without counting every value of a column of many.

    First rows are counted by a hash bucket of their value: no more than ``buckets`` counts, whatever
    the column holds. A value's count is at most its bucket's. The values of the k fullest buckets are counted
    exactly; the k-th best of them is a lower bound, and only buckets that reach it can hold another
    of the k most frequent, so a second exact count is due of those alone. Bucket lists are
    broadcast: they are bounded by ``buckets``. Where nearly all counts are equal, all buckets reach the bound and
    everything is counted, as it must be.
    """
    bucket = F.pmod(F.xxhash64(F.col(col)), F.lit(buckets)).alias("_bucket")
    rows = df.select(F.col(col).alias(name), bucket)
    sizes = stored(rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows")), "buckets")
    fullest = sizes.orderBy(F.desc("_rows"), "_bucket").limit(k).select("_bucket")

    def counted(of: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(of), "_bucket", "left_semi").groupBy(name).agg(F.count(F.lit(1)).alias("count"))
    order = [F.desc("count"), F.asc_nulls_first(name)]
    first = stored(counted(fullest).orderBy(*order).limit(k), "top")
    bound = first.agg(F.when(F.count("*") >= k, F.min("count")).otherwise(0)).first()[0]
    others = sizes.where(F.col("_rows") >= bound).join(fullest, "_bucket", "left_anti").select("_bucket")
    return first.unionByName(counted(others)).orderBy(*order).limit(k)


def binned_distribution(df: DataFrame, score_col: str) -> DataFrame:
    return (df.groupBy(score_bin(score_col).alias("score_bin"))
            .agg(F.count(F.lit(1)).alias("count")).orderBy("score_bin"))


def nonblank_histogram(df: DataFrame, cols: list[str], name: str = "violation_count") -> DataFrame:
    """How many rows have 0, 1, 2, ... non-blank values among ``cols``."""
    return (df.groupBy(nonblank_count(cols).alias(name))
            .agg(F.count(F.lit(1)).alias("count")).orderBy(name))


def summarize(df: DataFrame, cols: list[str] | None = None,
              statistics: tuple[str, ...] = ("count", "mean", "stddev", "min", "25%", "50%", "75%", "max")) -> DataFrame:
    """Spark's built-in summary (count, mean, stddev, min, approx quartiles, max)."""
    sub = df.select(*_cols(df, cols))
    return sub.summary(*statistics)


def profile(df: DataFrame, cols: list[str] | None = None, approx_distinct: bool = False) -> DataFrame:
    """Long-form profile: column_name, null_count, null_pct, distinct_count, total_rows."""
    nulls = profile_nulls(df, cols)
    distinct = profile_distinct(df, cols, approx=approx_distinct)
    return nulls.join(distinct, "column_name")


def _numeric_metrics(accuracy: int = 10_000) -> dict:
    return {"count": F.count, "mean": F.avg, "stddev": F.stddev, "min": F.min, "max": F.max} | {
        f"{int(q * 100)}%": lambda c, q=q: F.percentile_approx(c, q, accuracy) for q in (0.25, 0.5, 0.75)}


def numeric_summary(df: DataFrame, cols: list[str], accuracy: int = 10_000) -> DataFrame:
    """Long form (column_name, metric, value): count, mean, stddev, min, quartiles and max of numeric columns.

    One pass with partial aggregates; quartiles are values of the column, their rank off by
    at most 1 / ``accuracy`` of the rows.
    """
    metrics = _numeric_metrics(accuracy)
    one = df.agg(*[fn(F.col(c)).cast("double").alias(f"{m}__{i}") for i, c in enumerate(cols) for m, fn in metrics.items()])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(m).alias("metric"), F.col(f"`{m}__{i}`").alias("value"))
        for i, c in enumerate(cols) for m in metrics])))


def profile_report(df: DataFrame, cols: list[str] | None = None, frequencies: list[str] = (), top: int = 20,
                   numeric: list[str] = (), score: str | None = None, slots: list[str] = (),
                   rows: dict[str, Column] | None = None) -> DataFrame:
    """The whole profile as one long frame (column_name, metric, label, value).

    Per column: total rows, NULL or blank rows, their share in % rounded to 2 places, distinct
    values. For ``frequencies``: the ``top`` values and their counts; for ``numeric``: the
    numeric summary; for ``score``: counts by bin; for ``slots``: rows by number of filled
    columns; for ``rows``: how many rows meet each named condition.

    Two aggregates read the rows: one row of all scalar metrics, and a count of each (column, value)
    pair, from which distinct values, frequencies, bins and filled columns all follow.
    """
    names = _cols(df, cols)
    types = {f.name: f.dataType for f in df.schema.fields}
    nothing = F.lit(None).cast("string")

    def row(column: str, metric: str, value: Column, label: Column = nothing) -> Column:
        return F.struct(F.lit(column).alias("column_name"), F.lit(metric).alias("metric"), label.alias("label"), value.cast("double").alias("value"))
    # 1: everything that is one number
    aggs = [F.count(F.lit(1)).alias("_total")]
    found = []
    for i, c in enumerate(names):
        aggs.append(F.count_if(is_blank(F.col(f"`{c}`"), types[c])).alias(f"n{i}"))
        share = F.when(F.col("_total") > 0, F.round(F.col(f"n{i}").cast("double") * 100 / F.col("_total"), 2))
        found += [row(c, "total_rows", F.col("_total")), row(c, "null_count", F.col(f"n{i}")), row(c, "null_pct", share)]
    for i, c in enumerate(numeric):
        for j, (m, fn) in enumerate(_numeric_metrics().items()):
            aggs.append(fn(F.col(f"`{c}`")).cast("double").alias(f"s{i}_{j}"))
            found.append(row(c, m, F.col(f"s{i}_{j}")))
    for i, (n, c) in enumerate((rows or {}).items()):
        aggs.append(F.count_if(c).alias(f"r{i}"))
        found.append(row("*", "rows_where", F.col(f"r{i}"), F.lit(n)))
    scalars = df.agg(*aggs).select(F.inline(F.array(*found)))

    # 2: how often each value stands in its column; numbers also by size, for the order of ties
    def pair(kind: str, column: str, value: Column, size: Column | None = None) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.lit(column).alias("column_name"), value.cast("string").alias("_v"),
                        (F.lit(None) if size is None else size).cast("double").alias("_size"))
    pairs = []
    for c in dict.fromkeys([*names, *frequencies]):
        number = types[c].typeName() in ("double", "float")
        value = F.col(f"`{c}`") + 0.0 if number else F.col(f"`{c}`")   # -0.0 is 0.0 to SQL but not to text
        pairs.append(pair("value", c, value, value if isinstance(types[c], NumericType) else None))
    if score:
        pairs.append(pair("bin", score, score_bin(score)))
    if slots:
        pairs.append(pair("rows_by_filled", "slots", nonblank_count(list(slots))))
    counted = (df.select(F.inline(F.array(*pairs))).groupBy("kind", "column_name", "_v", "_size").agg(F.count(F.lit(1)).alias("_n")))
    place = F.row_number().over(Window.partitionBy("kind", "column_name").orderBy(F.desc("_n"), F.asc_nulls_first("_size"), F.asc_nulls_first("_v")))
    is_value = F.col("kind") == "value"
    wanted = F.col("column_name").isin(*frequencies) if frequencies else F.lit(False)
    top_rows = (counted.where(is_value & wanted).withColumn("_place", place).where(F.col("_place") <= top)
                .select("column_name", F.lit("frequency").alias("metric"), F.col("_v").alias("label"), F.col("_n").cast("double").alias("value")))
    others = (counted.where(~is_value).select("column_name", F.col("kind").alias("metric"), F.col("_v").alias("label"), F.col("_n").cast("double").alias("value")))
    distinct = (counted.where(is_value & F.col("column_name").isin(*names)).groupBy("column_name")
                .agg(F.count("_v").cast("double").alias("value"), F.sum("_n"), F.max("_size"))
                .select("column_name", F.lit("distinct_count").alias("metric"), nothing.alias("label"), "value"))
    return scalars.unionByName(distinct).unionByName(top_rows).unionByName(others)
