"""Exact order statistics, percentiles and top-N cutoffs by radix selection.

One method at every size.  Values become order-preserving whole numbers (integers stay as
they are, doubles give their bits, so nothing is rounded and 64-bit ids keep every digit).
Rows are first reduced to a histogram, (group, key, count), which makes a hot value one row
and is written out once; many columns, groups and percentiles can share it (``percentiles_of``).
The wanted ranks are then found digit by digit, from the top: each round counts the rows of
each digit under the digits known so far, and the running sum of those counts says which
digit holds a rank.  The counts are exact, so the digit is certain.  A group's digits begin at
the highest bit in which its keys differ, so there are as many rounds as the widest group's
range of keys needs, one for 2^22 different whole numbers in a row; a round never holds more
than 2^22 digits for one rank, however many rows there are.  Counting combines map-side.

Group keys (``by``) and targets are few by nature (plan, stage, feature name, a handful of
percentiles); joins with them are left to the planner, which broadcasts by measured size.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnscope.session import materialize

_ALL = "_all"  # the group of ungrouped inputs
_LARGEST = 2**63 - 1
#: Bits of a key that one round finds.
_DIGIT = 22


def is_whole(df: DataFrame, value: str) -> bool:
    return df.schema[value].dataType.typeName() in ("byte", "short", "integer", "long", "date")


def order_key(df: DataFrame, value: str) -> Column:
    """An order-preserving bigint of a column.

    NaN is the largest double and -0.0 equals 0.0, as in Spark's own order.
    """
    v = F.col(value)
    if df.schema[value].dataType.typeName() == "date":
        return F.unix_date(v).cast("bigint")
    if is_whole(df, value):
        return v.cast("bigint")
    d = v.cast("double") + F.lit(0.0)
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), d).cast("bigint")
    return F.when(v.isNotNull(), F.when(bits < 0, bits.bitwiseXOR(F.lit(_LARGEST))).otherwise(bits))


def key_value(key: Column) -> Column:
    """The double of a key made from a double."""
    known = F.coalesce(key, F.lit(0).cast("bigint"))
    bits = F.when(known < 0, known.bitwiseXOR(F.lit(_LARGEST))).otherwise(known)
    return F.when(key.isNotNull(), F.java_method(F.lit("java.lang.Double"), F.lit("longBitsToDouble"), bits).cast("double"))


def _few(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Ungrouped targets are a fixed handful of rows; grouped ones are left to the planner."""
    return F.broadcast(rows) if list(by) == [_ALL] else rows


def _grouped(df: DataFrame, by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    return (df, list(by)) if by else (df.withColumn(_ALL, F.lit(0)), [_ALL])


def _select(counts: DataFrame, targets: DataFrame, by: list[str]) -> DataFrame:
    """(by..., tid, _key, _before, _at): the key at rank k of each target, the rows before it and those of its key.

    counts: by..., _key, _c, written out; targets: by..., tid, k.  Targets out of range have no row.
    Each round reads ``counts`` and the state of the round before once, so plans grow linearly.
    """
    low, high = F.min("_key"), F.max("_key")
    width = F.when(low == high, F.lit(0)).otherwise(F.length(F.bin(low.bitwiseXOR(high))))
    widths = materialize(counts.groupBy(*by).agg(width.alias("_bits")))  # a row for each group
    rounds = max(1, -(-(widths.agg(F.max("_bits")).first()[0] or 0) // _DIGIT))
    state = targets.select(*by, "tid", "k")
    for n in range(1, rounds + 1):
        digits = counts.join(_few(widths, by), by).withColumn("_digit", F.expr(f"shiftright(_key, greatest(_bits - {_DIGIT * n}, 0))"))
        if n == 1:  # all targets of a group share the first histogram
            hist = digits.groupBy(*by, "_digit").agg(F.sum("_c").alias("_c"))
            hist = hist.withColumn("_upto", F.sum("_c").over(Window.partitionBy(*by).orderBy("_digit").rowsBetween(Window.unboundedPreceding, 0)))
            placed = hist.join(_few(state, by), by).withColumn("_before", F.lit(0).cast("bigint"))
        else:  # only rows under the digits found so far
            digits = digits.withColumn("_found", F.expr(f"shiftright(_key, greatest(_bits - {_DIGIT * (n - 1)}, 0))")).join(_few(state, by), [*by, "_found"])
            hist = digits.groupBy(*by, "tid", "k", "_before", "_digit").agg(F.sum("_c").alias("_c"))
            placed = hist.withColumn("_upto", F.sum("_c").over(Window.partitionBy(*by, "tid").orderBy("_digit").rowsBetween(Window.unboundedPreceding, 0)))
        rank = F.col("k") - F.col("_before")
        hit = placed.where((rank >= F.col("_upto") - F.col("_c")) & (rank < F.col("_upto")))
        state = hit.select(*by, "tid", "k", (F.col("_before") + F.col("_upto") - F.col("_c")).alias("_before"), F.col("_digit").alias("_found"), F.col("_c").alias("_at"))
    return state.select(*by, "tid", F.col("_found").alias("_key"), "_before", "_at")


def _counts(df: DataFrame, value: str, by: list[str], weight: str | None = None) -> DataFrame:
    times = F.count(F.lit(1)) if weight is None else F.sum(weight)
    distinct = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(times.alias("_c"))
    return materialize(distinct.select(*by, order_key(df, value).alias("_key"), "_c"))


def _restored(df: DataFrame, value: str, key: Column) -> Column:
    """A key of the column as a value of its type."""
    kind = df.schema[value].dataType
    if kind.typeName() == "date":
        return F.date_from_unix_date(key.cast("int"))
    return (key if is_whole(df, value) else key_value(key)).cast(kind)


def order_statistics(df: DataFrame, value: str, targets: DataFrame, by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Exact ascending order statistics.

    ``targets`` has the ``by`` columns plus ``tid`` (any id) and ``k`` (the 0-based rank wanted,
    data-dependent).  Returns (by..., tid, k, value) in the column's own type; value is NULL
    where k is outside [0, n).  NULL values are ignored.  A row counts ``weight`` times, if given.
    """
    df, keys = _grouped(df, by)
    wanted, _ = _grouped(targets, by)
    wanted = wanted.select(*keys, "tid", F.col("k").cast("bigint").alias("k"))
    found = _select(_counts(df, value, keys, weight), wanted, keys).select(*keys, "tid", _restored(df, value, F.col("_key")).alias("value"))
    return wanted.join(found, [*keys, "tid"], "left").select(*by, "tid", "k", "value")


def exact_percentiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Exact percentiles with linear interpolation (position p * (n - 1)).

    Returns (by..., p, value); groups of NULLs only keep a NULL row for each p.  A row counts
    ``weight`` times, if given.
    """
    df, keys = _grouped(df, by)
    times = F.count(value) if weight is None else F.coalesce(F.sum(F.when(F.col(value).isNotNull(), F.col(weight))), F.lit(0).cast("bigint"))
    rows = df.groupBy(*keys).agg(times.alias("_n"))
    spec = F.array(*[F.struct(F.lit(i).alias("_i"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)])
    places = rows.select(*keys, "_n", F.inline(spec))
    if not by:  # an empty input has no group, but its percentiles are NULL
        places = places.unionByName(df.sparkSession.range(1).select(F.lit(0).alias(_ALL), F.lit(0).cast("bigint").alias("_n"), F.inline(spec))) \
            .groupBy(_ALL, "_i", "p").agg(F.max("_n").alias("_n"))
    h = F.col("p") * (F.col("_n") - 1)
    places = places.select(*keys, "_i", "p", F.floor(h).cast("bigint").alias("_lo"), (h - F.floor(h)).alias("_share"))
    both = places.select(*keys, F.inline(F.array(*[
        F.struct((F.col("_i") * 2 + j).alias("tid"), (F.col("_lo") + j).alias("k")) for j in (0, 1)])))
    stats = order_statistics(df, value, both, keys, weight)
    sided = stats.select(*keys, F.floor(F.col("tid") / 2).cast("int").alias("_i"), (F.col("tid") % 2).alias("_j"), F.col("value").cast("double").alias("_v"))
    ends = sided.groupBy(*keys, "_i").agg(F.max(F.when(F.col("_j") == 0, F.col("_v"))).alias("_a"), F.max(F.when(F.col("_j") == 1, F.col("_v"))).alias("_b"))
    share = F.col("_share")
    out = F.when(share == 0, F.col("_a")).otherwise(F.col("_a") + share * (F.col("_b") - F.col("_a")))
    return places.join(ends, [*keys, "_i"], "left").select(*by, "p", out.alias("value"))


def rank_cutoff(df: DataFrame, value: str, tie: str, quota: DataFrame, by: Sequence[str] = (), descending: bool = True) -> DataFrame:
    """Mark the first ``_take`` rows per group in (value, tie) order.

    ``quota`` holds the ``by`` columns and ``_take`` (rows wanted, may be data-dependent).  Order
    is value descending (or ascending) and then ``tie`` ascending, a total order when ``tie`` is
    unique.  Returns ``df`` with a boolean ``_selected``; rows without a value or of a group
    without a quota stay, unselected.  The cut value and the cut tie are found by radix
    selection, in the columns' own types; no row moves to a single partition.
    """
    columns = df.columns
    df, keys = _grouped(df, by)
    quota, _ = _grouped(quota, by)
    quota = quota.select(*keys, F.col("_take").cast("bigint").alias("_take"))
    key = order_key(df, value)
    ranked = df.withColumn("_ord", F.bitwise_not(key) if descending else key)  # ~x reverses the order of whole numbers
    some = ranked.where(F.col("_ord").isNotNull())
    counts = materialize(some.groupBy(*keys, F.col("_ord").alias("_key")).agg(F.count(F.lit(1)).alias("_c")))
    first = quota.where("_take > 0").select(*keys, F.col("_take").alias("tid"), (F.col("_take") - 1).alias("k"))
    cut = _select(counts, first, keys).select(*keys, F.col("_key").alias("_cut"), (F.col("tid") - F.col("_before")).alias("_wanted"), "_at")
    cut = materialize(cut)  # a row for each group
    split = cut.where(F.col("_wanted") < F.col("_at"))  # only here ties decide
    if split.isEmpty():
        bounds = cut.select(*keys, "_cut", F.lit(None).cast(df.schema[tie].dataType).alias("_tie_cut"))
    else:
        ties = some.join(_few(split, keys), keys).where(F.col("_ord") == F.col("_cut")).select(*keys, tie)
        within = split.select(*keys, F.lit(0).alias("tid"), (F.col("_wanted") - 1).alias("k"))
        found = _select(_counts(ties, tie, keys), within, keys).select(*keys, _restored(df, tie, F.col("_key")).alias("_tie_cut"))
        bounds = cut.select(*keys, "_cut").join(_few(found, keys), keys, "left")
    bounds = quota.select(*keys, "_take").join(_few(bounds, keys), keys, "left")
    marked = ranked.join(_few(bounds, keys), keys, "left")
    at_cut = (F.col("_ord") == F.col("_cut")) & (F.col("_tie_cut").isNull() | (F.col(tie) <= F.col("_tie_cut")))
    inside = F.col("_cut").isNull() | (F.col("_ord") < F.col("_cut")) | at_cut
    chosen = F.coalesce((F.col("_take") > 0) & F.col("_ord").isNotNull() & inside, F.lit(False))
    return marked.select(*columns, chosen.alias("_selected"))


@dataclass(frozen=True)
class Wanted:
    """Percentiles of a column, over all rows or for each value of ``by``."""

    column: str
    probs: tuple[float, ...]
    by: str | None = None


def percentiles_of(df: DataFrame, wanted: Sequence[Wanted]) -> DataFrame:
    """(column, grouping, of, p, value) of many percentiles, all from one histogram in the columns' own types.

    ``grouping`` is the name of the column that groups, "" if none does; ``of`` is its value as
    a string.  Interpolated like ``exact_percentiles``; a group of NULLs only has NULLs.
    """
    spark = df.sparkSession
    rows = [F.struct(F.lit(i).alias("i"), (F.lit("") if w.by is None else F.col(w.by).cast("string")).alias("of"), order_key(df, w.column).alias("_key"))
            for i, w in enumerate(wanted)]
    counts = materialize(df.select(F.inline(F.array(*rows))).groupBy("i", "of", "_key").agg(F.count(F.lit(1)).alias("_c")))
    known = counts.where(F.col("_key").isNotNull())
    sizes = counts.groupBy("i", "of").agg(F.coalesce(F.sum(F.when(F.col("_key").isNotNull(), F.col("_c"))), F.lit(0)).alias("_n"))
    specs = spark.createDataFrame([(i, w.column, w.by or "", j, float(p), is_whole(df, w.column)) for i, w in enumerate(wanted) for j, p in enumerate(w.probs)],
                                  "i int, column string, grouping string, j int, p double, _whole boolean")
    h = F.col("p") * (F.col("_n") - 1)
    places = sizes.join(F.broadcast(specs), "i").withColumn("_lo", F.floor(h).cast("bigint")).withColumn("_share", h - F.floor(h))  # a row for each percentile
    both = places.select("i", "of", F.inline(F.array(*[F.struct((F.col("j") * 2 + s).alias("tid"), (F.col("_lo") + s).alias("k")) for s in (0, 1)])))
    found = _select(known, both, ["i", "of"])
    sided = found.groupBy("i", "of", F.floor(F.col("tid") / 2).cast("int").alias("j")).agg(
        F.max(F.when(F.col("tid") % 2 == 0, F.col("_key"))).alias("_a"), F.max(F.when(F.col("tid") % 2 == 1, F.col("_key"))).alias("_b"))
    value = lambda k: F.when(F.col("_whole"), F.col(k).cast("double")).otherwise(key_value(F.col(k)))
    out = places.join(sided, ["i", "of", "j"], "left").withColumn("_a", value("_a")).withColumn("_b", value("_b"))
    share = F.col("_share")
    return out.select("column", "grouping", "of", "p", F.when(share == 0, F.col("_a")).otherwise(F.col("_a") + share * (F.col("_b") - F.col("_a"))).alias("value"))


def wide_percentiles(q: DataFrame, by: Sequence[str], names: dict[float, str]) -> DataFrame:
    """(by..., p, value) -> one row per group with a column per probability."""
    return q.groupBy(*by).agg(*[
        F.first(F.when(F.col("p") == float(p), F.col("value")), ignorenulls=True).alias(name)
        for p, name in names.items()])
