"""A client's base-table run: hooks at named points, quality results, and publishing only without errors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from donorloom.operators import quality
from donorloom.operators.joins import outer_with_codes
from donorloom.plans import base_tables
from donorloom.plans.hooks import Client
from donorloom.session import durable, stored
from donorloom.sources.store import Store

TABLES = ("gift", "donor", "source_code")
RESULTS, LOG = "qa_results", "status_log"


class NotPublished(RuntimeError):
    """Quality errors kept the tables from being published."""


def record(store: Store, results: DataFrame) -> None:
    """Quality results replace the earlier ones of the same checks."""
    store.upsert(results, RESULTS, quality.RESULT_KEY)


def log(store: Store, process: str, step: str) -> None:
    store.append(quality.status_rows(store.spark, store.client, process, step), LOG)


def ingest(
    store: Store, client: Client, raw: DataFrame, raw_codes: DataFrame, renames: Mapping[str, str], suppressions: Sequence[tuple], start_month: int,
) -> None:
    """A delivery from raw text to the base tables, through every point at which a client may step in.

    Gifts become typed transactions (``parse``). Raw source codes are mended
    (``raw_source_codes``, ``initiate_codes`` with the transactions beside them), made
    standard, updated (``update_codes``) and named (``names``). Gifts and codes
    together are the campaign performance, with the client's dimensions
    (``filters``), measures (``campaign_performance``) and choice of rows
    (``dataset_filters``, unless ``skip_campaign_filters``). Both tables are written before
    the base tables are built from the same transactions and codes.
    """
    parsed = client.apply("parse", base_tables.transactions(raw, renames, suppressions, client.name, start_month))
    parsed, seen = quality.measured(parsed, quality.transaction_measures())
    store.overwrite(parsed, "transactions")
    trx = store.read("transactions")
    codes = client.apply("initiate_codes", client.apply("raw_source_codes", raw_codes), trx)
    codes = durable(client.apply("names", client.apply("update_codes", base_tables.standard_source_codes(codes, client.name, start_month))))
    performance = client.apply("filters", outer_with_codes(trx, codes, "source_code"))
    performance = client.apply("campaign_performance", performance)
    if not client.has("skip_campaign_filters"):
        performance = client.apply("dataset_filters", performance)
    store.overwrite(performance, "campaign_performance")
    build(store, client, trx, codes, start_month, seen.get)


def build(
    store: Store, client: Client, trx: DataFrame, codes: DataFrame, start_month: int, found: Mapping[str, object] | None = None,
) -> None:
    """Gift, donor and source-code tables into the silver layer, with a result for each check.

    ``trx`` has gift_id, donor_id, gift_date, gift_amount, channel, gift_type, source_code, campaign_code and
    campaign_name; ``codes`` is the standard source-code table with campaign_group. Codes that only
    gifts know and a placeholder per year are added to it. ``found`` are the transactions' measures if
    their write has counted them, and they are read from there; otherwise they are stored and counted
    first, as several steps read them. The gift table is counted by its own write.
    """
    if found is None:
        trx, counted = quality.measured(trx, quality.transaction_measures())
        trx = stored(trx)
        found = counted.get
    codes = client.apply("source_codes", codes)
    missing = client.apply("missing_codes", base_tables.inferred_codes(trx, codes, client.name, start_month))
    every = codes.unionByName(missing, allowMissingColumns=True).unionByName(
        base_tables.unsourced_years(trx, client.name, start_month), allowMissingColumns=True)
    store.overwrite(every, "source_code")
    table, seen = quality.measured(base_tables.gift_table(trx, store.read("source_code")), quality.amount_measures(found))
    store.overwrite(table, "gift")
    gifts = store.read("gift")
    client.notify("gifts", gifts)
    donors = base_tables.donor_table(gifts, start_month)
    store.overwrite(client.apply("donor_codes", client.apply("donors", donors, gifts), store.read("source_code")), "donor")

    keyed = lambda df: df.select(F.col("donor_id").alias("donor_key"))
    results = [quality.donor_key_checks(keyed(store.read("donor")), keyed(gifts), client.name),
               quality.source_code_checks(store.read("source_code"), gifts, client.name)]
    if not client.has("skip_trx_qa"):
        results.append(quality.transaction_results(quality.one_row(store.spark, found), client.name))
    if not client.has("skip_gift_qa"):
        totals = {"staged": found["staged"], **seen.get}
        results.append(quality.amount_results(quality.one_row(store.spark, totals), client.name))
    record(store, reduce(DataFrame.unionByName, results))


def publish(store: Store, client: Client) -> None:
    """Silver tables to curated if no check failed with an error; otherwise ``NotPublished``. Either way the log says so."""
    forced = ("source_code",) if client.has("force_publish_source_code") else ()
    results = store.read(RESULTS).filter((F.col("client") == client.name) & ~F.col("dataset").isin(*forced))
    errors = quality.failures(results).first().errors
    if errors:
        log(store, "Base tables", f"not published, {errors} errors")
        raise NotPublished(f"{client.name}: {errors} errors")
    for table in TABLES:
        store.publish(table)
    log(store, "Base tables", "published")
    client.notify("published", store.read("gift", "curated"))
