"""Registries for client hooks, and example rule sets made of the generic operators."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from donorloom.functions.bands import amount_flag, gift_level
from donorloom.functions.clean import null_tokens, strip_point_zero
from donorloom.functions.dates import fiscal_year
from donorloom.functions.rules import Registry, classify, is_in, matches_any

PARSE = Registry()
SOURCE_CODE = Registry()
FEATURES = Registry()

FEATURES.register("gift_month", lambda df: df.withColumn("gift_month", F.month("gift_date")))
FEATURES.register("gift_level", lambda df: df.withColumn("gift_level", gift_level(F.col("gift_amount"))))
FEATURES.register("gift_amount_flag", lambda df: df.withColumn("gift_amount_flag", amount_flag(F.col("gift_amount"))))
FEATURES.register("gift_fiscal", lambda df: df.withColumn("gift_fiscal", fiscal_year(F.col("gift_date"), 7)))

#: Points at which a client's own steps change a table: in parsing, with source codes, and in the base-table run.
POINTS = ("parse", "names", "filters", "dataset_filters", "raw_source_codes", "initiate_codes", "update_codes",
          "campaign_performance", "source_codes", "missing_codes", "donors", "donor_codes")
#: Points at which a client is told of a finished table and changes nothing.
NOTICES = ("gifts", "published")
SWITCHES = ("skip_trx_qa", "skip_gift_qa", "force_publish_source_code", "skip_campaign_filters")


@dataclass(frozen=True)
class Client:
    """A client's deviations from the standard run. Names that no run knows are refused when the client is made."""

    name: str
    steps: Mapping[str, Sequence[Callable[..., DataFrame]]] = field(default_factory=dict)
    notices: Mapping[str, Sequence[Callable[..., None]]] = field(default_factory=dict)
    switches: frozenset[str] = frozenset()

    def __post_init__(self) -> None:
        unknown = (set(self.steps) - set(POINTS)) | (set(self.notices) - set(NOTICES)) | (set(self.switches) - set(SWITCHES))
        if unknown:
            raise ValueError(f"unknown hooks of {self.name}: {sorted(unknown)}")

    def apply(self, point: str, df: DataFrame, *context: DataFrame) -> DataFrame:
        """``df`` through the client's steps at ``point``, in order; each may look at further tables."""
        if point not in POINTS:
            raise ValueError(point)
        for step in self.steps.get(point, ()):
            df = step(df, *context)
        return df

    def notify(self, point: str, table: DataFrame) -> None:
        for told in self.notices.get(point, ()):
            told(table)

    def has(self, switch: str) -> bool:
        if switch not in SWITCHES:
            raise ValueError(switch)
        return switch in self.switches


@PARSE.register("channel_from_appeal")
def channel_from_appeal(df: DataFrame) -> DataFrame:
    """Later rules win: mail, then solicitation, then event."""
    code = F.col("appeal_id")
    return df.withColumn("channel", classify([
        (matches_any(code, ["DM"]), "Direct Mail"),
        (matches_any(code, ["SOL"]), "Solicitation"),
        (matches_any(code, ["EV"]), "Event"),
    ], "Other", match="last"))


def by_table(df: DataFrame, name: str, table: Sequence[tuple[str, Sequence[tuple[str, str, Sequence[str]]]]], default: str) -> DataFrame:
    """Label rows by a table of rules: (label, conditions), the first rule whose conditions all hold.

    A condition is (column, "in" or "has", values); codes are trimmed, null words
    become null and a trailing ``.0`` goes before they are compared.
    """
    tests = {"in": is_in, "has": lambda c, values: matches_any(c, values, ignore_case=True)}

    def holds(conditions):
        every = F.lit(True)
        for column, test, values in conditions:
            every = every & tests[test](null_tokens(strip_point_zero(F.trim(F.col(column).cast("string")))), list(values))
        return every

    return df.withColumn(name, classify([(holds(conditions), label) for label, conditions in table], default))


@SOURCE_CODE.register("upper_code")
def upper_code(df: DataFrame) -> DataFrame:
    return df.withColumn("source_code", F.upper(F.regexp_replace(F.trim("source_code"), "-", "")))


@SOURCE_CODE.register("campaign_from_code")
def campaign_from_code(df: DataFrame) -> DataFrame:
    return df.withColumn("campaign_code", F.coalesce("campaign_code", F.substring("source_code", 1, 4)))
