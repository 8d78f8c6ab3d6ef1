"""Lookups, key resolution and table comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from donorloom.operators.scale import first_value, keep_first, keep_last, number_rows, running_last, spread_join
from donorloom.session import durable


def outer_with_codes(gifts: DataFrame, codes: DataFrame, key: str) -> DataFrame:
    """Full outer join on the source code; shared columns take the gift's value first.

    Written as a left join plus the codes nobody used: a left join can cut a
    hot code into pieces, a full join cannot.
    """
    shared = [c for c in gifts.columns if c in codes.columns and c != key]
    right = codes.withColumnsRenamed({c: f"_sc_{c}" for c in shared})
    matched = spread_join(gifts, right, [key])
    merged = matched.withColumns({c: F.coalesce(F.col(c), F.col(f"_sc_{c}")) for c in shared}).drop(
        *[f"_sc_{c}" for c in shared])
    unused = codes.join(gifts.select(key).distinct(), key, "left_anti")
    return merged.unionByName(unused, allowMissingColumns=True)


def missing_codes(gifts: DataFrame, codes: DataFrame, key: str) -> DataFrame:
    """Gift rows whose code is not in the table (or is null)."""
    known = codes.select(key).distinct().withColumn("_known", F.lit(True))
    return spread_join(gifts, known, [key]).filter(F.col("_known").isNull()).drop("_known")


def unknown_values(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Distinct codes in the data that the table does not know."""
    return rows.select(key).distinct().join(table.select(key), key, "left_anti")


def fill_from_lookup(
    df: DataFrame, target: str, lookup: DataFrame, key: str, value: str, tie: Sequence[Column],
) -> DataFrame:
    """Fill nulls of ``target`` from ``lookup`` by ``key``; for repeated keys the last by ``tie`` counts."""
    one = keep_last(lookup.filter(F.col(key).isNotNull()), [key], tie).select(key, F.col(value).alias("_found"))
    return spread_join(df, one, [key]).withColumn(target, F.coalesce(F.col(target), F.col("_found"))).drop("_found")


def crosswalk(df: DataFrame, key: str, pairs: DataFrame, old: str, new: str) -> DataFrame:
    """Replace ids by their new id where there is one; ``pairs`` has one row per old id."""
    mapping = pairs.select(F.col(old).alias(key), F.col(new).alias("_new"))
    return spread_join(df, mapping, [key]).withColumn(key, F.coalesce(F.col("_new"), F.col(key))).drop("_new")


def membership_flag(df: DataFrame, key: str, table: DataFrame, table_key: str, name: str) -> DataFrame:
    known = table.select(F.col(table_key).alias(key)).distinct().withColumn("_known", F.lit(True))
    return spread_join(df, known, [key]).withColumn(name, F.coalesce(F.col("_known"), F.lit(False))).drop("_known")


LOOKUP_ROWS = 200_000  # a lookup table of up to this many rows is broadcast


def _looked_up(rows: DataFrame, values: DataFrame, keys: Sequence[str], size: str | None = None) -> DataFrame:
    """Left join with a durable table of one row per key: rows stay where they are if it is small, else ``spread_join``."""
    if values.count() > LOOKUP_ROWS:
        return spread_join(rows, values, keys, size=size)
    return rows.join(F.broadcast(values.drop(size) if size else values), list(keys), "left")


def curated_code_key(gifts: DataFrame, codes: DataFrame, tie: Sequence[Column]) -> DataFrame:
    """Key of the best matching source-code row.

    Precedence: client + code + name + campaign, then client + code + name,
    then client + code, then the client's unsourced row of the gift's fiscal
    year. The first three forms of key are one table: (rank, parts of the key) with
    the first code row by ``tie``. The distinct key combinations of the gifts, without the
    year, unfold into the same forms, meet them in one join, and the smallest rank
    that is found wins. The gifts pick up this answer and the unsourced row of their year
    in one join each; a small table is broadcast, so that the gifts are not shuffled.
    ``gifts`` is read twice: one that takes joins to derive should be stored first.
    """
    def text(c: str) -> Column:
        return F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))

    parts = {"k_client": "client", "k_code": "source_code", "k_name": "campaign_name", "k_camp": "campaign_code"}
    named, year = list(parts), ["k_client", "k_fy"]
    forms = [named, ["k_client", "k_code", "k_name"], ["k_client", "k_code"]]

    def unfolded(df: DataFrame) -> DataFrame:
        """Each row under every form of key."""
        made = [F.struct(F.lit(rank).alias("rank"), *[(F.col(k) if k in keys else F.lit("")).alias(f"f_{k}") for k in named])
                for rank, keys in enumerate(forms)]
        return df.withColumn("_form", F.explode(F.array(*made))).select("*", "_form.*").drop("_form")

    key = ["rank", *[f"f_{k}" for k in named]]
    dim = codes.filter(F.col("sc_key_curated").isNotNull()).withColumns(
        {k: text(c) for k, c in parts.items()} | {"k_fy": text("fy")})
    first = first_value("sc_key_curated", tie)
    known = unfolded(dim).groupBy(*key).agg(first.alias("_named"))
    unsourced = dim.filter(F.col("k_camp").startswith("UNSOURCED-FY")).groupBy(*year).agg(first.alias("_unsourced"))
    rows = gifts.drop("sc_key_curated").withColumns(
        {k: text(c) for k, c in parts.items()} | {"k_fy": text("gift_fy")})
    counts = rows.groupBy(*named).agg(F.count(F.lit(1)).alias("_rows"))
    answer = unfolded(counts).join(known, key).groupBy(*named).agg(
        F.min_by("_named", "rank").alias("_named"), F.first("_rows").alias("_rows"))
    found = _looked_up(_looked_up(rows, durable(unsourced), year), durable(answer), named, "_rows")
    return found.select(*[F.col(f"`{c}`") for c in gifts.columns if c != "sc_key_curated"],
                        F.coalesce("_named", "_unsourced").alias("sc_key_curated"))


def most_recent_event(df: DataFrame, keys: Sequence[str], day: str, event: Column, name: str) -> DataFrame:
    """As-of lookup: date of the latest row with ``event`` on or before each row's day."""
    return running_last(df, keys, F.col(day), F.when(event, F.col(day)), name)


def month_number(date: Column) -> Column:
    return F.year(date) * 12 + F.month(date) - 1


def interval_join(rows: DataFrame, day: str, periods: DataFrame, start: str, end: str, keys: Sequence[str] = ()) -> DataFrame:
    """Every row with every period (of the same ``keys``) that holds its day, both ends included.

    Periods may overlap, leave gaps and differ in length; a null start or end is
    open. Periods unfold into the months they touch, within the months of the
    rows; rows and periods meet on the month in an equi-join that keeps a heavy
    month out of one task, and the exact bounds are compared after it. Rows without a
    day and periods that end before they start meet nothing.
    """
    at = rows.withColumn("_month", month_number(F.col(day))).filter(F.col(day).isNotNull())
    span = rows.agg(F.min(month_number(F.col(day))).alias("lo"), F.max(month_number(F.col(day))).alias("hi"))
    held = periods.withColumn("_span", span.select(F.struct("lo", "hi")).scalar()).withColumns({
        "_first": F.greatest(F.coalesce(month_number(F.col(start)), F.col("_span.lo")), F.col("_span.lo")),
        "_last": F.least(F.coalesce(month_number(F.col(end)), F.col("_span.hi")), F.col("_span.hi"))})
    binned = held.filter(F.col("_first") <= F.col("_last")).withColumn(
        "_month", F.explode(F.sequence("_first", "_last"))).drop("_span", "_first", "_last")
    # Periods by month are few next to the rows; made durable, the join's plan does not derive them again for each of its parts.
    met = spread_join(at, durable(binned), [*keys, "_month"], "inner")
    inside = (F.col(start).isNull() | (F.col(day) >= F.col(start))) & (F.col(end).isNull() | (F.col(day) <= F.col(end)))
    return met.filter(inside).drop("_month")


def compare_profiles(new: DataFrame, old: DataFrame, keys: Sequence[str], value: str, names=("updated", "previous")) -> DataFrame:
    """Two count tables side by side, zero where a key is missing on one side."""
    both = new.select(*keys, F.col(value).alias(names[0]), F.lit(None).cast("long").alias(names[1])).unionByName(
        old.select(*keys, F.lit(None).cast("long").alias(names[0]), F.col(value).alias(names[1])))
    return both.groupBy(*keys).agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])


DIFF_BUCKETS = 1 << 16


def _in_differing_buckets(rows: DataFrame, key: str) -> DataFrame:
    """Rows of those hash buckets of the key in which the two sides (weights 1 and -1) are not the same rows.

    Per bucket the signed sums of two 64-bit row hashes, in halves, are all zero
    where the sides agree; a wrong zero is as unlikely as a collision of 128 bits. One
    narrow grouping of at most ``DIFF_BUCKETS`` rows a task, and equal tables are done.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(DIFF_BUCKETS)).cast("int")
    hashes = [F.xxhash64(key, "row"), F.xxhash64(F.lit("second"), key, "row")]
    halves = [half for h in hashes for half in (h.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(h, 32))]
    sums = [F.sum(F.col("w") * half).alias(f"h{i}") for i, half in enumerate(halves)]
    unlike = F.lit(False)
    for i in range(len(halves)):
        unlike = unlike | (F.col(f"h{i}") != 0)
    found = durable(rows.groupBy(bucket.alias("_bucket")).agg(F.sum("w").alias("n"), *sums).filter(unlike | (F.col("n") != 0)).select("_bucket"))
    if found.count() > DIFF_BUCKETS // 2:
        return rows  # most buckets differ: sorting them out would not spare much
    return rows.withColumn("_bucket", bucket).join(F.broadcast(found), "_bucket", "left_semi").drop("_bucket")


def table_diff(left: DataFrame, right: DataFrame, key: str, ignore: Sequence[str] = ()) -> DataFrame:
    """All differing rows with a ``side``: left_only, left_changed, right_only or right_changed.

    Digests by key bucket tell where the tables differ; only those rows are
    shuffled, once, to stand by their key. Where a key is repeated, equal rows of
    both sides cancel first, as often as they are there, and of what is left the
    n-th row on the left is matched with the n-th on the right (by a hash of the
    row). Cells that agree (both null included) are blanked on changed rows.
    """
    columns = sorted((set(left.columns) | set(right.columns)) - {key} - set(ignore))
    kinds = dict(right.dtypes) | dict(left.dtypes)

    def packed(df: DataFrame, weight: int) -> DataFrame:
        row = F.struct(*[(F.col(c) if c in df.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in columns])
        return df.select(F.col(key).cast(kinds[key]).alias(key), row.alias("row"), F.lit(weight).alias("w"))

    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    unlike = F.col("l").isNull() | F.col("r").isNull() | ~same
    both = _in_differing_buckets(packed(left, 1).unionByName(packed(right, -1)), key)
    repeated = (F.col("nl") > 1) | (F.col("nr") > 1)
    by_key = durable(both.groupBy(key).agg(
        F.count_if(F.col("w") > 0).alias("nl"), F.count_if(F.col("w") < 0).alias("nr"), F.max(F.when(F.col("w") > 0, F.col("row"))).alias("l"),
        F.max(F.when(F.col("w") < 0, F.col("row"))).alias("r")).filter(repeated | unlike))
    changed = by_key.filter(~repeated).select(key, "l", "r")
    again = by_key.filter(repeated)
    if not again.isEmpty():
        again = again.select(F.col(key).alias("_key"))
        rest = both.join(again, F.col(key).eqNullSafe(F.col("_key")), "left_semi")
        changed = changed.unionByName(_matched(rest, key).filter(unlike).select(key, "l", "r"))

    def blanked(mine: str, other: str) -> Column:
        cells = [F.when(F.col(other).isNull() | ~F.col(f"{mine}.{c}").eqNullSafe(F.col(f"{other}.{c}")),
                        F.col(f"{mine}.{c}")).alias(c) for c in columns]
        side = F.when(F.col(other).isNull(), f"{_side(mine)}_only").otherwise(f"{_side(mine)}_changed")
        return F.when(F.col(mine).isNotNull(), F.struct(side.alias("side"), *cells))

    out = changed.select(key, F.explode(F.array(blanked("l", "r"), blanked("r", "l"))).alias("d"))
    # A side without any value left (all blank) says nothing, as in the four-way split.
    some = F.lit(False)
    for c in columns:
        some = some | F.col(f"d.{c}").isNotNull()
    return out.filter(F.col("d").isNotNull() & some).select(key, "d.*")


def _matched(rows: DataFrame, key: str) -> DataFrame:
    """(key, nth, l, r) of weighted rows that do not cancel."""
    rest = rows.groupBy(key, "row").agg(F.sum("w").alias("w")).filter("w <> 0")
    rest = rest.select(key, "row", (F.col("w") > 0).alias("is_left"), F.explode(F.sequence(F.lit(1), F.abs("w").cast("int"))).alias("copy"))
    mix = F.xxhash64("row")
    rest = number_rows(rest, [key, "is_left"], [F.shiftright(mix, 44)], [mix, F.col("row"), F.col("copy")], "nth")
    return rest.groupBy(key, "nth").agg(F.max(F.when(F.col("is_left"), F.col("row"))).alias("l"),
                                        F.max(F.when(~F.col("is_left"), F.col("row"))).alias("r"))


def _side(name: str) -> str:
    return {"l": "left", "r": "right"}[name]


def split_diff(diff: DataFrame) -> dict[str, DataFrame]:
    return {s: diff.filter(F.col("side") == s).drop("side")
            for s in ("left_only", "left_changed", "right_only", "right_changed")}


def whitemail_rows(codes: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Add one ``Whitemail`` row for each campaign that is not a source code itself."""
    absent = codes.join(codes.select(F.col("source_code").alias("campaign_code")).distinct(),
                        "campaign_code", "left_anti").filter(F.col("campaign_code").isNotNull())
    first = keep_first(absent, ["campaign_code"], order)
    rows = first.select(
        F.col("campaign_code").alias("source_code"), "campaign_code", "campaign_name",
        F.lit("Whitemail").alias("package_name"), F.lit("Whitemail").alias("package_code"), "mail_date")
    return codes.unionByName(rows, allowMissingColumns=True)


def backfill(df: DataFrame, side: DataFrame, key: str, values: Mapping[str, str]) -> DataFrame:
    """Fill nulls of target columns from a side table (one row per key): {target: side column}."""
    picked = side.select(key, *[F.col(s).alias(f"_f_{t}") for t, s in values.items()])
    out = spread_join(df, picked, [key]).withColumns({t: F.coalesce(F.col(t), F.col(f"_f_{t}")) for t in values})
    return out.drop(*[f"_f_{t}" for t in values])


def soft_credits(gifts: DataFrame, credits: DataFrame, key: str, credit_id: str, replaced: Sequence[str]) -> DataFrame:
    """Gifts with partial credits give way to one row per credit with the gift's other columns."""
    plain = gifts.join(credits.select(key).distinct(), key, "left_anti")
    rest = gifts.drop(*replaced)
    rows = credits.select(key, credit_id, *replaced).join(rest, key, "left").drop(key).withColumnRenamed(credit_id, key)
    return plain.unionByName(rows.select(*gifts.columns))


def matchback(gifts: DataFrame, mailings: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Gifts with the mailing they answer: distinct mailings by donor and campaign."""
    return spread_join(gifts, mailings.select(*keys, *columns).distinct(), keys)


def donor_attribute(gifts: DataFrame, side: DataFrame, donor: str, value: str, missing) -> DataFrame:
    one = side.select(donor, F.col(value).alias(f"_{value}"))
    out = spread_join(gifts, one, [donor])
    return out.withColumn(value, F.coalesce(F.col(f"_{value}"), F.lit(missing))).drop(f"_{value}")


def in_list(df: DataFrame, key: str, ids: DataFrame, name: str) -> DataFrame:
    """Flag rows whose id is in a list of ids."""
    return membership_flag(df, key, ids, key, name)
