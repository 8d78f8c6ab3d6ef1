"""Source-code text: decoding by position, repair, synthetic codes and keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from donorloom.functions.dates import fiscal_year, month_name
from donorloom.functions.rules import is_in, sure, starts_any
from donorloom.operators.scale import keep_last


@dataclass(frozen=True)
class Part:
    """One decoded column: 1-based character or (first, last) range, and its labels."""

    at: int | tuple[int, int] | None
    labels: Mapping[str, str] = field(default_factory=dict)

    def raw(self, code: Column) -> Column:
        if self.at is None:
            return F.lit(None).cast("string")
        if isinstance(self.at, tuple):
            first, last = self.at
            return F.substring(code, first, last - first + 1)
        return F.when(F.length(code) >= self.at, F.substring(code, self.at, 1))

    def decoded(self, code: Column) -> Column:
        raw = self.raw(code)
        if not self.labels:
            return raw
        pairs = [F.lit(x) for pair in self.labels.items() for x in pair]
        return F.coalesce(F.try_element_at(F.create_map(*pairs), raw), raw)


Layout = Mapping[str, Part]
RFM = ("recency_code", "frequency_code", "monetary_code")


def decode(df: DataFrame, code: str, layout: Layout) -> DataFrame:
    return df.withColumns({name: part.decoded(F.col(code)) for name, part in layout.items()})


def decode_by_year(
    df: DataFrame, code: str, layouts: Mapping[int, Layout], mail_date: str,
    start_month: int = 1, untouched: Column | None = None,
) -> DataFrame:
    """Two layouts: mailings before the newest layout's (fiscal) year, or without a date, use the older one.

    Rows where ``untouched`` holds and the new layout would apply get no decoded parts.
    """
    newest = max(layouts)
    old, new = layouts[newest - 1], layouts[newest]
    late = sure(fiscal_year(F.col(mail_date), start_month) >= newest)
    skip = sure(untouched) if untouched is not None else F.lit(False)
    nothing = F.lit(None).cast("string")

    def part(layout: Layout, name: str) -> Column:
        return layout[name].decoded(F.col(code)) if name in layout else nothing

    return df.withColumns({
        name: F.when(~late, part(old, name)).when(~skip, part(new, name))
        for name in dict.fromkeys([*old, *new])
    })


def decode_conditional(df: DataFrame, code: str, layout: Layout, prefix: str = "Q") -> DataFrame:
    """Codes with the prefix carry a list but no RFM; all others carry RFM but no list."""
    cold = sure(F.startswith(F.col(code), F.lit(prefix)))
    out = decode(df, code, layout)
    cleared = {c: F.when(~cold, F.col(c)) for c in RFM if c in out.columns}
    if "list_code" in out.columns:
        cleared["list_code"] = F.when(cold, F.col("list_code"))
    return out.withColumns(cleared)


def decode_override(df: DataFrame, code: str, layout: Layout, overrides: Mapping[str, str]) -> DataFrame:
    """Listed list codes take their recency and monetary label from the override of the code."""
    out = decode(df, code, layout)
    pairs = [F.lit(x) for pair in overrides.items() for x in pair]
    value = F.try_element_at(F.create_map(*pairs), F.col(code))
    listed = is_in(F.col("list_code"), list(overrides))
    return out.withColumns({
        c: F.when(listed, value).otherwise(F.col(c)) for c in ("recency_code", "monetary_code") if c in out.columns
    })


def decode_as(kind: str, df: DataFrame, code: str, **options) -> DataFrame:
    """Pick the decoder by configured kind; an unknown kind leaves the frame alone."""
    decoders = {
        "header": decode,
        "year": decode_by_year,
        "fiscal_year": decode_by_year,
        "conditional": decode_conditional,
        "override": decode_override,
    }
    return decoders[kind](df, code, **options) if kind in decoders else df


def synthetic_code(df: DataFrame, code: str, parts: Sequence[tuple[str, str]]) -> DataFrame:
    """Fill null codes with the configured parts, each with its own fill text."""
    made = F.concat(*[F.coalesce(F.col(c), F.lit(fill)) for c, fill in parts])
    return df.withColumn(code, F.coalesce(F.col(code), made))


def split_valid(df: DataFrame, patterns: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined): a row is valid when every column matches its pattern from the start."""
    tidy = df.withColumns({c: F.trim(F.upper(F.col(c))) for c in patterns})
    ok = F.lit(True)
    for c, pattern in patterns.items():
        ok = ok & sure(F.col(c).rlike(f"^(?:{pattern})"))
    return tidy.filter(ok), tidy.filter(~ok)


def count_invalid(df: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    """One row: failing values per column; empty text passes."""
    return df.agg(*[
        F.count_if(~sure(F.col(c).cast("string").rlike(f"^(?:{p})")) & ~sure(F.col(c) == "")).alias(c)
        for c, p in patterns.items()
    ])


def validate_batch(
    known: DataFrame, batch: DataFrame, code: str, casts: Mapping[str, Column], patterns: Mapping[str, str],
    parts: tuple[str, str, str] = ("appeal_id", "segment_code", "package_id"), length: int = 14,
) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined) after adding a batch: newest row per code, repaired codes, typed, checked by pattern.

    Rows without a code are dropped.
    """
    columns = [c for c in known.columns if c in batch.columns]
    both = known.select(*columns, F.lit(0).alias("_age")).unionByName(batch.select(*columns, F.lit(1).alias("_age")))
    both = both.withColumn(code, F.trim(F.col(code).cast("string")))
    newest = keep_last(both, [code], [F.col("_age"), *[F.col(c) for c in columns if c != code]]).drop("_age")
    fixed = newest.withColumn(code, repair_code(F.col(code), *[F.col(p) for p in parts], length=length)).withColumns(dict(casts))
    good, bad = split_valid(fixed, patterns)
    has_code = F.col(code).isNotNull() & (F.col(code) != "NAN")
    return good.filter(has_code), bad.filter(has_code)


def repair_code(code: Column, appeal: Column, segment: Column, package: Column, length: int = 14) -> Column:
    """Codes of the wrong length are rebuilt from their parts."""
    return F.when(sure(F.length(code) == length), code).otherwise(F.concat(appeal, segment, package))


def pad_right(col: Column, width: int, fill: str) -> Column:
    """Pad without ever cutting longer text."""
    return F.when(F.length(col) < width, F.rpad(col, width, fill)).otherwise(col)


def pad_left(col: Column, width: int, fill: str) -> Column:
    return F.when(F.length(col) < width, F.lpad(col, width, fill)).otherwise(col)


def client_campaign(client: Column, code: Column, name: Column, source: Column, fy: Column) -> Column:
    """``CLIENT-code-name-MD_FYyyyy``; the source code stands in when code and name are missing."""
    base = F.rtrim(F.concat(F.upper(client), F.lit("-"), F.coalesce(code, F.lit("")),
                            F.coalesce(F.concat(F.lit("-"), name), F.lit(""))), F.lit("-"))
    base = F.when(base == F.upper(client), F.concat(base, F.lit("-"), F.coalesce(source, F.lit("")))).otherwise(base)
    return F.concat(base, F.coalesce(F.concat(F.lit("-MD_FY"), fy.cast("string")), F.lit("")))


def inferred_campaign(client: Column, code: Column, name: Column, source: Column, fy: Column) -> Column:
    """Campaign key of a code that only occurs on gifts."""
    head = F.upper(client)
    dash = F.lit("-")
    base = (F.when(code.isNotNull() & name.isNotNull(), F.concat(head, dash, code, dash, name))
            .when(code.isNotNull(), F.concat(head, dash, code))
            .when(name.isNotNull(), F.concat(head, F.lit("-CN "), name))
            .when(source.isNotNull(), F.concat(head, dash, source))
            .otherwise(head))
    return F.concat(base, F.coalesce(F.concat(F.lit("-MD_FY"), fy.cast("string")), F.lit("")))


def default_campaign_name(fy: Column, mail_date: Column, package: Column) -> Column:
    year = F.coalesce(F.substring(fy.cast("string"), 3, 2), F.lit("XX"))
    return F.concat(F.lit("FY"), year, F.lit("_"), F.coalesce(month_name(mail_date), F.lit("")),
                    F.lit("_"), F.coalesce(package, F.lit("")))


def budget_key(df: DataFrame, name: str, required: Sequence[str], optional: Sequence[str] = ()) -> DataFrame:
    """Upper-case key of the parts; null values and absent optional columns read ``NULL``."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        return df

    def text(c: str) -> Column:
        if c not in df.columns:
            return F.lit("NULL")
        value = F.trim(F.col(c).cast("string"))
        return F.when(sure(~value.isin("nan", "None", "NaT")), value).otherwise(F.lit("NULL"))

    return df.withColumn(name, F.upper(F.concat_ws("_", *[text(c) for c in [*required, *optional]])))


def id_list(col: Column, mark: str = ";") -> Column:
    return F.split(col, mark)


def first_part(col: Column, mark: str = ";") -> Column:
    return F.split_part(col, F.lit(mark), F.lit(1))


def zip_part(col: Column, part: str = "first") -> Column:
    """Five-digit or four-digit part of a zip code; codes without a dash stay whole."""
    text = col.cast("string")
    wanted = F.split(text, "-").getItem(0 if part == "first" else 1)
    return F.when(F.contains(text, F.lit("-")), wanted).otherwise(text)


def leading_parts(col: Column, mark: str = "-", count: int = 2) -> Column:
    return F.substring_index(col, mark, count)


def unsourced_code(
    code: Column, campaign: Column, fy: Column, prefixes: Mapping[str, str], applies: Column,
) -> Column:
    """Replace an unknown code by the campaign code, or by ``<fy><type>Unsourced``."""
    kind = F.lit(None).cast("string")
    for prefix, text in prefixes.items():
        kind = F.when(F.startswith(code, F.lit(prefix)), text).otherwise(kind)
    use = sure(applies) & kind.isNotNull()
    made = F.coalesce(campaign, F.concat(fy.cast("string"), kind, F.lit("Unsourced")))
    return F.when(use, made).otherwise(code)


def row_hash(*columns: str) -> Column:
    return F.xxhash64(*[F.col(c) for c in columns])


def scanline_code(scan: Column, fallback: Column, first: int = 12, length: int = 10) -> Column:
    """A fixed slice of the scan line when it is long enough, else the fallback."""
    piece = F.substring(scan, first, length)
    return F.upper(F.when(sure(F.length(piece) == length), piece).otherwise(fallback))


def guarded_slice(code: Column, first: int, last: int, pattern: str) -> Column:
    """Characters ``first..last`` when they match the pattern, else empty text."""
    piece = F.upper(F.substring(code, first, last - first + 1))
    good = sure(F.length(code) >= last) & sure(piece.rlike(pattern))
    return F.when(good, piece).otherwise(F.lit(""))


def appeal_package_code(appeal: Column, package: Column, pattern: str) -> Column:
    """Package code, with the appeal in front unless it already starts with it; empty for bad appeals."""
    good = sure(appeal.rlike(pattern))
    joined = F.when(F.startswith(package, appeal), package).otherwise(F.concat(appeal, package))
    return F.when(good, joined).otherwise(F.lit(""))


def campaign_package_code(campaign: Column, package: Column, prefixes: Sequence[str]) -> Column:
    """``campaign-package`` for campaigns with the prefixes, the campaign alone without a package."""
    ours = starts_any(campaign, prefixes)
    full = sure(package != "")
    return F.when(ours & full, F.concat(campaign, F.lit("-"), package)).when(ours, campaign).otherwise(F.lit(""))
