"""Donor, campaign and table aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from donorloom.functions.rules import sure
from donorloom.operators.scale import attach, durable, exact_quantiles

MAJOR_GIFT = 10000


def half_up(value: Column, places: int) -> Column:
    """Decimal rounding of a double by floor(x * 10^n + 0.5) / 10^n."""
    scale = float(10 ** places)
    return F.floor(value * scale + 0.5) / scale


def lifespan(first: Column, last: Column) -> Column:
    return (F.datediff(last, first) + 1) / 365


def donor_profile(gifts: DataFrame, donor: str, date: str, amount: str, major: float = MAJOR_GIFT) -> DataFrame:
    """First and last gift, counts, span in years, amounts and major-gift dates, in one grouping."""
    d, a = F.col(date), F.col(amount)
    big = F.when(a >= major, d)
    out = gifts.groupBy(donor).agg(
        F.min(d).alias("first_gift_date"), F.max(d).alias("last_gift_date"), F.count(d).alias("gifts"),
        F.min(a).alias("min_gift_amount"), F.max(a).alias("max_gift_amount"),
        (F.sum(a).cast("double") / F.count(a)).alias("donor_average_gift"),
        F.min(big).alias("min_major_gift_date"), F.max(big).alias("max_major_gift_date"))
    years = lifespan(F.col("first_gift_date"), F.col("last_gift_date"))
    return out.withColumns({
        "lifespan": years, "core_donor": years >= 2, "major_gift_definition": F.lit(major)})


def giving_history(gifts: DataFrame, donor: str, gift: str) -> DataFrame:
    """Multi or Single by rows (``donor_group``) and by distinct gift ids (``gift_history``)."""
    return gifts.groupBy(donor).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(gift).alias("gift_ids")
    ).withColumns({
        "donor_group": F.when(F.col("rows") > 1, "Multi").otherwise("Single"),
        "gift_history": F.when(F.col("gift_ids") > 1, "Multi").otherwise("Single"),
    })


def channel_behavior(
    gifts: DataFrame, donor: str, channel: str, multi: str = "MultiChannel", single: str | None = "SingleChannel",
) -> DataFrame:
    """Multi label for several channels; otherwise the single label, or the channel itself."""
    alone = F.lit(single) if single is not None else F.min(channel)
    return gifts.groupBy(donor).agg(
        F.count_distinct(channel).alias("channels"),
        alone.alias("_alone") if single is None else F.first(alone).alias("_alone"),
    ).select(donor, "channels", F.when(F.col("channels") > 1, multi).otherwise(F.col("_alone")).alias("behavior"))


def channel_set_label(gifts: DataFrame, donor: str, channel: str, labels: Mapping[str, str], multi: str = "Multi") -> DataFrame:
    """Label of a donor's sorted channel set; {"A,B": label}. The set holds labels, not rows."""
    sets = gifts.filter(F.col(channel).isNotNull()).groupBy(donor).agg(
        F.array_join(F.array_sort(F.collect_set(channel)), ",").alias("channels"))
    pairs = [F.lit(x) for pair in labels.items() for x in pair]
    return sets.withColumn("channel_group", F.coalesce(
        F.try_element_at(F.create_map(*pairs), F.col("channels")), F.lit(multi)))


def value_set(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Sorted distinct values per key, for columns with a small vocabulary (years, channels)."""
    return df.groupBy(*keys).agg(F.array_sort(F.collect_set(value)).alias(name))


def merge_quantities(codes: DataFrame, code: str, quantity: str, order: Sequence[Column]) -> DataFrame:
    """Repeated codes become one row (the first) with the summed quantity."""
    rest = [c for c in codes.columns if c not in (code, quantity)]
    rank = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    one = codes.groupBy(code).agg(
        F.min_by(F.struct(*rest), rank).alias("_row"), F.sum(quantity).alias(quantity))
    return one.select(*[F.col(c) if c in (code, quantity) else F.col(f"_row.{c}").alias(c) for c in codes.columns])


def mail_counts(mailings: DataFrame, code: str, person: str, date: str) -> DataFrame:
    """People mailed and latest mail date per code; a person counts once per code."""
    people = mailings.groupBy(code, person).agg(F.max(date).alias("_d"))
    return people.groupBy(code).agg(F.count(F.lit(1)).alias("quantity"), F.max("_d").alias("mail_date"))


def decouple_costs(codes: DataFrame, package: str = "package_name") -> DataFrame:
    """Package cost per piece without the list cost that is charged separately.

    The sums of a package are one grouping; the rows pick them up by a join.
    """
    q, lst, pkg = F.col("quantity"), F.col("list_cpp"), F.col("package_cpp")
    totals = codes.groupBy(package).agg(
        F.sum(F.coalesce(q * lst, F.lit(0))).alias("_list"), F.sum(q * pkg).alias("_package"),
        F.sum(q).alias("_mailed"), F.count(F.lit(1)).alias("_n"))
    out = attach(codes, totals, [package], "_n")
    cost = half_up((F.col("_package") - F.col("_list")).cast("double") / F.col("_mailed").cast("double"), 2)
    return out.withColumn("package_cpp", cost).drop("_list", "_package", "_mailed")


def revenue_by(df: DataFrame, keys: Sequence[str], amount: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(amount).alias("revenue")).orderBy(F.desc("revenue"), *keys)


def pivot_counts(df: DataFrame, row: str, column: str, values: Sequence, aggregate: Column) -> DataFrame:
    """Wide table with a fixed list of columns, so no extra job looks for them."""
    return df.groupBy(row).pivot(column, list(values)).agg(aggregate)


def membership_label(gifts: DataFrame, donor: str, member: Column) -> DataFrame:
    yes, no = F.count_if(sure(member)), F.count_if(~sure(member))
    return gifts.groupBy(donor).agg(
        F.when((yes > 0) & (no == 0), "Membership Only")
        .when((yes == 0) & (no > 0), "Non-Membership Only")
        .otherwise("Member/Non-Member").alias("donor_group"))


def column_profile(df: DataFrame) -> DataFrame:
    """unique, null, not-null and total per column.

    Values are counted in long form: one grouping on (column, value) and one on
    column. Distinct counts of all columns side by side would copy every row
    once per column and key.
    """
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in df.columns
    ])).alias("x")).select("x.*")
    values = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n")
    missing = F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0))
    return values.groupBy("column").agg(
        F.count("value").alias("unique"), missing.alias("null"),
        (F.count("value") + missing).alias("unique_plus_null"),
        (total - missing).alias("not_null"), total.alias("total"))


def non_null_counts(df: DataFrame) -> DataFrame:
    """(column, filled) from one aggregate row."""
    row = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    return row.unpivot([], list(df.columns), "column", "filled")


def rows_by_year(df: DataFrame, date: str, name: str = "gifts") -> DataFrame:
    return df.groupBy(F.year(date).cast("long").alias("year")).agg(F.count(F.lit(1)).alias(name))


def weekly_joins(first_gifts: DataFrame, date: str, year: int) -> DataFrame:
    """New donors per ISO week: average over the years on file, and one year."""
    bounds = first_gifts.agg(F.min(F.year(date)).alias("lo"), F.max(F.year(date)).alias("hi"))
    span = bounds.agg(F.max(F.col("hi") - F.col("lo"))).scalar()
    weeks = first_gifts.groupBy(F.weekofyear(date).cast("long").alias("week")).agg(
        F.count(F.lit(1)).alias("_all"),
        F.count_if(F.year(date) == year).alias("in_year"))
    return weeks.select("week", F.floor(F.col("_all") / span).alias("average"), "in_year")


def max_over_rest(df: DataFrame, column: str) -> DataFrame:
    """Largest value of one column for each combination of all the others."""
    return df.groupBy(*[c for c in df.columns if c != column]).agg(F.max(column).alias(column))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise Pearson correlations in long form, from one aggregate row."""
    pairs = [(a, b) for a in columns for b in columns]
    row = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    long = row.unpivot([], [f"{a}|{b}" for a, b in pairs], "pair", "r")
    return long.select(F.split_part("pair", F.lit("|"), F.lit(1)).alias("a"),
                       F.split_part("pair", F.lit("|"), F.lit(2)).alias("b"), "r")


def rfm(gifts: DataFrame, donor: str, gift: str, date: str, amount: str, as_of: Column) -> DataFrame:
    return gifts.groupBy(donor).agg(
        F.datediff(as_of, F.max(date)).alias("recency"), F.count_distinct(gift).alias("frequency"),
        F.max(amount).alias("monetary"))


def giving_before(
    mailings: DataFrame, gifts: DataFrame, donor: str, mail_date: str, gift_date: str, amount: str, tie: str,
) -> DataFrame:
    """Giving before each mailing: last-12-month sum, lifetime count, highest, latest amount and months since.

    Gifts are one row per donor and day, mailings one probe row per donor and
    mail date; one window over both answers every probe. No mailing is paired
    with the gifts before it.
    """
    # Gifts and probes in one grouping per donor and day, so that the frames below see each day once.
    probes = mailings.select(F.col(donor).alias("donor"), F.col(mail_date).cast("date").alias("day"), F.lit(True).alias("probe"))
    given = gifts.select(F.col(donor).alias("donor"), F.col(gift_date).cast("date").alias("day"), F.lit(False).alias("probe"),
                         F.col(amount).alias("amount"), F.col(tie).alias("tie"))
    line = given.unionByName(probes, allowMissingColumns=True).groupBy("donor", "day").agg(
        F.sum("amount").alias("total"), F.count_if(~F.col("probe")).alias("n"), F.max("amount").alias("top"),
        F.max_by("amount", "tie").alias("latest"), F.max("probe").alias("probe"))
    w = W.partitionBy("donor").orderBy("day")
    before = w.rowsBetween(W.unboundedPreceding, -1)
    line = line.withColumns({
        "count_before": F.coalesce(F.sum("n").over(before), F.lit(0)),
        "top_before": F.max("top").over(before),
        "last_day": F.last(F.when(F.col("n") > 0, F.col("day")), ignorenulls=True).over(before),
        "last_amount": F.last("latest", ignorenulls=True).over(before),
    })
    # The frame ends on the day itself, whose own gifts do not count.
    year = F.expr("sum(total) OVER (PARTITION BY donor ORDER BY day RANGE BETWEEN INTERVAL '1' YEAR PRECEDING AND CURRENT ROW)")
    line = line.withColumn("cume12", F.coalesce(year, F.lit(0)) - F.coalesce("total", F.lit(0)))
    return line.filter("probe").select(
        F.col("donor").alias(donor), F.col("day").alias(mail_date), "cume12", "count_before",
        F.coalesce("top_before", F.lit(0)).alias("highest"), F.coalesce("last_amount", F.lit(0)).alias("latest_amount"),
        F.floor(F.datediff("day", "last_day") / F.lit(30.436875) + 0.5).alias("months_since"))


def online_mix(gifts: DataFrame, donor: str, program: str, counted: Column, online: str = "Online") -> DataFrame:
    """Multi-Channel, DM Only, Online Only or Other Giving.

    Online gifts count where ``counted`` holds (before the mail date or period end), others always.
    """
    web = F.count_if(sure(counted & (F.col(program) == online))) > 0
    mail = F.count_if(sure(F.col(program) != online)) > 0
    return gifts.groupBy(donor).agg(
        F.when(web & mail, "Multi-Channel").when(mail, "DM Only").when(web, "Online Only")
        .otherwise("Other Giving").alias("channel_behavior"))


def value_flags(df: DataFrame, key: str, value: str, values: Sequence) -> DataFrame:
    """One boolean column per value: does the key ever have it."""
    return df.groupBy(key).agg(*[
        F.coalesce(F.max(F.col(value) == v), F.lit(False)).alias(f"{value}_{v}") for v in values])


def donor_clusters(df: DataFrame, columns: Sequence[str], clusters: int = 10, rounds: int = 20) -> tuple[DataFrame, DataFrame]:
    """K-means on standardised measures: the rows with their ``cluster``, and the centres.

    The start does not depend on partitions: rows are ranked by the sum of their
    standardised measures and cut at exact percentiles into as many groups as there
    are clusters; their means are the first centres. A round assigns every row to the
    nearest centre (ties to the first) and takes means again; it ends when no centre
    moves, or after ``rounds``. A cluster without rows keeps its centre. The driver
    holds the centres only. A null measure is an error, so no donor is left out.
    """
    spark = df.sparkSession
    z = [f"_z{i}" for i in range(len(columns))]
    df = durable(df)  # it is passed over once a round
    stats = df.agg(*[F.struct(F.avg(c), F.stddev_samp(c), F.count_if(F.col(c).isNull())) for c in columns]).first()
    if any(nulls for _, _, nulls in stats):
        raise ValueError("a measure is null")
    scaled = df.withColumns({n: (F.col(c) - F.lit(mean)) / F.lit(spread or 1.0) for n, c, (mean, spread, _) in zip(z, columns, stats)})
    scaled = scaled.withColumn("_sum", sum((F.col(n) for n in z), F.lit(0.0)))
    edges = [r["value"] for r in exact_quantiles(scaled, "_sum", [i / clusters for i in range(1, clusters)]).orderBy("p").collect()]
    edges = [e for e in edges if e is not None]  # clusters - 1 values
    group = sum(((F.col("_sum") > F.lit(e)).cast("int") for e in edges), F.lit(0))
    means = lambda rows: {r["cluster"]: list(r)[1:] for r in rows.groupBy("cluster").agg(*[F.avg(n) for n in z]).collect()}
    centres = means(scaled.withColumn("cluster", group))

    def assigned() -> DataFrame:
        squares = [F.struct(sum(((F.col(n) - F.lit(v)) * (F.col(n) - F.lit(v)) for n, v in zip(z, centre)), F.lit(0.0)).alias("d"), F.lit(k).alias("k"))
                   for k, centre in sorted(centres.items())]
        return scaled.withColumn("cluster", F.array_min(F.array(*squares))["k"] if squares else F.lit(0))

    for _ in range(rounds):
        new = centres | means(assigned())
        moved = max((abs(a - b) for k in new for a, b in zip(new[k], centres[k])), default=0.0)
        centres = new
        if moved < 1e-9:
            break
    found = spark.createDataFrame([(k, *map(float, c)) for k, c in sorted(centres.items())], "cluster int, " + ", ".join(f"{n} double" for n in z))
    return assigned().drop("_sum"), found

