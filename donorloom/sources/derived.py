"""Scans of datasets that earlier runs derived: staged gifts, campaign performance, lifecycle, pledges, response curves."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from donorloom.functions.clean import null_tokens, strip_point_zero
from donorloom.session import stored
from donorloom.sources.files import lenient_date


@dataclass(frozen=True)
class Derived:
    """Columns to type (dates), to clean (ids), and the date by which the newest rows come first, if rows are sorted."""

    dates: Sequence[str] = ()
    ids: Sequence[str] = ()
    newest: str | None = None


#: The kinds a run knows; another dataset is read with a ``Derived`` of its own.
KINDS = {
    "staged": Derived(("gift_date",)),
    "staged_since": Derived(("gift_date",), (), "gift_date"),
    "campaign_performance": Derived(("gift_date", "mail_date"), ("gift_id",), "gift_date"),
    "lifecycle": Derived(("gift_date",)),
    "lifecycle_sorted": Derived(("gift_date",), (), "gift_date"),
    "pledges": Derived(("recurring_gift_start",), (), "recurring_gift_start"),
    "response_curve": Derived(),
}


def scan_derived(
    spark: SparkSession, path: str, kind: str | Derived, client: str | None = None, renames: Mapping[str, str] | None = None,
    columns: Sequence[str] | None = None, since: int | None = None, parquet: bool = False,
) -> DataFrame:
    """A derived dataset with typed dates and clean ids, of ``client`` if it is named.

    Text that is no date becomes null, and ids lose a trailing ``.0``; null words
    become null. ``renames`` comes first, ``columns`` are the renamed columns to keep (others are not
    decoded from Parquet), and ``since`` keeps rows whose ``newest`` date is in that
    year or later. Rows are range-sorted, newest first, where the kind says so; a
    range sort reads its input twice, so the typed rows are stored before it and
    text is decoded once.
    """
    spec = KINDS[kind] if isinstance(kind, str) else kind
    df = spark.read.parquet(path) if parquet else spark.read.option("header", True).option("multiLine", False).csv(path)
    df = df.withColumnsRenamed(dict(renames or {}))
    if columns is not None:
        df = df.select(*[c for c in columns if c in df.columns])
    kinds = dict(df.dtypes)
    text = lambda c: null_tokens(F.trim(F.col(c).cast("string")))
    df = df.withColumns({
        **{c: F.col(c).cast("date") if kinds[c] in ("date", "timestamp") else lenient_date(text(c)) for c in spec.dates if c in kinds},
        **{c: strip_point_zero(text(c)) for c in spec.ids if c in kinds}})
    if since is not None:
        if spec.newest is None:
            raise ValueError("the dataset has no date to choose years by")
        df = df.filter(F.col(spec.newest) >= F.make_date(F.lit(since), F.lit(1), F.lit(1)))
    if client is not None:
        df = df.withColumn("client", F.lit(client))
    return df if spec.newest is None else stored(df).orderBy(F.col(spec.newest).desc_nulls_last())
