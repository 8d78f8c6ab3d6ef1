"""Mixing sources to target weights by hierarchical budgets, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from donorloom.llm.common import lookup
from donorloom.session import durable

LEVELS = ("domain", "language", "source")
BUCKET_ROWS = 1000  # rows wanted in a bucket of a leaf's order


@dataclass(frozen=True)
class Mix:
    """Target weights (whole numbers) of the children at each level, a default for those not named, the budget as a
    share of the tokens at hand in thousandths, and how often a leaf may be read."""

    domains: Mapping[str, int] = field(default_factory=lambda: {"0": 5, "1": 3, "2": 2})
    languages: Mapping[str, int] = field(default_factory=lambda: {"en": 4, "de": 2, "fr": 2, "es": 2})
    sources: Mapping[str, int] = field(default_factory=lambda: {"src0": 1})
    others: int = 2
    share: int = 800
    epochs: int = 2
    seed: int = 42

    def weights(self, level: str) -> Mapping[str, int]:
        return {"domain": self.domains, "language": self.languages, "source": self.sources}[level]


def domain_of(source: Column) -> Column:
    """Sources carry no domain here: the remainder of their number by 3 stands for one, "none" without a number."""
    number = F.regexp_extract(source, r"([0-9]{1,9})$", 1)
    return F.when(number == "", F.lit("none")).otherwise((number.try_cast("long") % 3).cast("string"))


def _columns(docs: DataFrame) -> list[Column]:
    """The row's place in the tree, its tokens (words of the whole text) and its id as text."""
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    return [domain_of(source).alias("domain"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("language"),
            source.alias("source"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id")]


def _tokens() -> Column:
    return F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(r"[^\x09-\x0D\x20]+")), F.lit(0)).cast("long")


def _weight(mix: Mix, level: str) -> Column:
    out = F.lit(mix.others)
    for name, weight in mix.weights(level).items():
        out = F.when(F.col(level) == name, F.lit(weight)).otherwise(out)
    return out.cast("decimal(38,0)")


def _filled(nodes: DataFrame, parents: list[str], level: str, mix: Mix) -> DataFrame:
    """``nodes`` with ``give``: their share of ``budget``, by weight, up to ``room``; what some cannot take goes to the
    siblings in proportion to their weights. Shares are whole and add up."""
    whole = lambda c: F.coalesce(c, F.lit(0)).cast("decimal(38,0)")
    siblings = W.partitionBy(*parents) if parents else W.partitionBy(F.lit(1))
    nodes = nodes.withColumn("w", _weight(mix, level)).withColumn("room", F.when(F.col("w") > 0, F.col("room")).otherwise(F.lit(0)))
    order = [F.when(F.col("w") > 0, F.col("room").cast("double") / F.col("w").cast("double")).otherwise(F.lit(0.0)), F.col(level)]
    rising = siblings.orderBy(*order)
    nodes = nodes.withColumn("before", whole(F.sum("room").over(rising.rowsBetween(W.unboundedPreceding, -1))))
    nodes = nodes.withColumn("rest", whole(F.sum("w").over(rising.rowsBetween(0, W.unboundedFollowing))))
    nodes = nodes.withColumn("full", F.col("room") * F.col("rest") <= F.col("w") * (F.col("budget") - F.col("before")))
    used = whole(F.sum(F.when(F.col("full"), F.col("room"))).over(siblings))
    open_w = F.when(F.col("full"), F.lit(0).cast("decimal(38,0)")).otherwise(F.col("w"))
    nodes = nodes.withColumn("left", F.col("budget") - used).withColumn("open", open_w)
    nodes = nodes.withColumn("total", whole(F.sum("open").over(siblings)))
    nodes = nodes.withColumn("upto", whole(F.sum("open").over(rising.rowsBetween(W.unboundedPreceding, 0))))
    part = F.expr("cast(upto * left div total as decimal(38,0)) - cast((upto - open) * left div total as decimal(38,0))")
    give = F.when(F.col("full"), F.col("room")).when(F.col("total") > 0, part).otherwise(F.lit(0))
    return nodes.withColumn("give", give.cast("decimal(38,0)")).drop("w", "before", "rest", "full", "left", "open", "total", "upto")


def budgets(rows: DataFrame, mix: Mix) -> DataFrame:
    """One row per leaf of ``rows(domain, language, source, tokens)``: n, tokens, give.

    A node has room for the tokens below it times the number of epochs. The
    budget goes down the tree by weights: a shortage at a leaf is shared by its
    sibling sources as far as they have room, what they cannot take by the sibling
    languages, and then by the domains. Nodes of weight 0 get nothing.
    """
    leaves = rows.groupBy(*LEVELS).agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("tokens"))
    usable = F.lit(True)
    for level in LEVELS:
        usable = usable & (_weight(mix, level) > 0)
    leaves = leaves.withColumn("room", F.when(usable, F.col("tokens") * mix.epochs).otherwise(F.lit(0)).cast("decimal(38,0)"))
    budget = leaves.agg(F.expr(f"coalesce(sum(cast(tokens as decimal(38,0))), 0) * {mix.share} div 1000").alias("b"))
    level1 = leaves.groupBy("domain").agg(F.sum("room").cast("decimal(38,0)").alias("room")).withColumn(
        "budget", budget.scalar().cast("decimal(38,0)"))
    level1 = _filled(level1, [], "domain", mix).select("domain", F.col("give").alias("budget"))
    level2 = leaves.groupBy("domain", "language").agg(F.sum("room").cast("decimal(38,0)").alias("room")).join(level1, "domain")
    level2 = _filled(level2, ["domain"], "language", mix).select("domain", "language", F.col("give").alias("budget"))
    level3 = _filled(leaves.join(level2, ["domain", "language"]), ["domain", "language"], "source", mix)
    return level3.select(*LEVELS, "n", "tokens", F.col("give").cast("long").alias("give"))


def _key(mix: Mix) -> Column:
    """Place of a row in the seeded order of its leaf's last epoch."""
    return F.md5(F.concat_ws("|", F.lit(str(mix.seed)), F.col("last").cast("string"), F.col("id")).cast("binary"))


def _bucket() -> Column:
    """Buckets follow the order; the number of buckets follows the leaf's size."""
    many = F.greatest(F.lit(1), F.least(F.lit(1 << 20), F.ceil(F.col("n") / BUCKET_ROWS)))
    return F.shiftright(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * many, 32)


def plan(docs: DataFrame, mix: Mix) -> tuple[DataFrame, DataFrame]:
    """(rows, leaves): narrow rows, and per leaf how many whole epochs it gives and where its last one is cut."""
    rows = durable(docs.select(*_columns(docs), _tokens().alias("tokens")))
    leaf = durable(budgets(rows, mix).withColumn("last", F.when(F.col("tokens") > 0, F.expr("give div tokens")).otherwise(F.lit(0))).withColumn(
        "want", F.when(F.col("tokens") > 0, F.expr("give % tokens")).otherwise(F.lit(-1))))
    placed = lookup(rows, leaf.select(*LEVELS, "n", "last", "want", F.col("n").alias("size")), LEVELS, "size").withColumn(
        "key", _key(mix)).withColumn("bucket", _bucket())
    sums = placed.groupBy(*LEVELS, "bucket").agg(F.sum("tokens").alias("s"), F.first("want").alias("want"), F.count(F.lit(1)).alias("m"))
    before = W.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    cut = sums.withColumn("before", F.coalesce(F.sum("s").over(before), F.lit(0))).filter(
        (F.col("before") <= F.col("want")) & (F.col("want") < F.col("before") + F.col("s")))
    cut = durable(cut.select(*LEVELS, "bucket", "before"))
    # One bucket of each leaf is looked at row by row. Rows with one key count together.
    inside = lookup(placed, cut.join(sums.select(*LEVELS, "bucket", "m"), [*LEVELS, "bucket"]), [*LEVELS, "bucket"], "m").filter("before is not null")
    same = inside.groupBy(*LEVELS, "key", "before", "want").agg(F.sum("tokens").alias("t"))
    running = F.col("before") + F.sum("t").over(W.partitionBy(*LEVELS).orderBy("key").rowsBetween(W.unboundedPreceding, 0))
    ends = same.withColumn("running", running).filter("running <= want").groupBy(*LEVELS).agg(F.max("key").alias("upto"))
    ends = cut.join(ends, list(LEVELS), "left").select(*LEVELS, F.col("bucket").alias("cut"), F.coalesce("upto", F.lit("")).alias("upto"))
    return rows, durable(leaf.join(ends, list(LEVELS), "left").select(*LEVELS, "n", "last", "cut", "upto"))


def _epochs(rows: DataFrame, leaves: DataFrame, mix: Mix) -> DataFrame:
    """``rows`` once per epoch that takes them."""
    placed = lookup(rows, leaves.withColumn("size", F.col("n")), LEVELS, "size")
    placed = placed.withColumn("key", _key(mix)).withColumn("bucket", _bucket())
    taken = F.coalesce((F.col("bucket") < F.col("cut")) | ((F.col("bucket") == F.col("cut")) & (F.col("key") <= F.col("upto"))), F.lit(False))
    times = F.col("last") + taken.cast("long")
    return placed.filter(times > 0).withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), times - 1)))


def mixture(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mixture of ``docs(doc_id, text, lang, source)``, a row per document and epoch that takes it: doc_id, domain,
    language, source, n_tokens, epoch.

    Each leaf of the domain-language-source tree gets a budget of tokens (see
    ``budgets``), gives its documents once per whole epoch and, in the last one,
    the longest prefix of its seeded order that the rest of the budget holds.
    Null languages and sources are leaves of their own, named empty. Rows that
    share a doc_id share a place in the order and are taken or left together.
    Null and empty texts have no tokens and are taken where their place is
    reached; a leaf without tokens gives nothing. An empty table gives an empty
    one; other columns are not looked at.
    """
    rows, leaves = plan(docs, mix)
    out = _epochs(rows, leaves, mix)
    return out.select(F.when(F.col("id") != "", F.col("id")).cast("long").alias("doc_id"), *LEVELS,
                      F.col("tokens").alias("n_tokens"), "epoch")


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The documents of the mixture with all their columns, repeated where several epochs take them."""
    _, leaves = plan(docs, mix)
    rows = docs.select(F.struct("*").alias("_row"), *_columns(docs))
    return _epochs(rows, leaves, mix).select("_row.*")


def oracle(mix: Mix = Mix()) -> str:
    """The same mixture in DuckDB SQL: budgets by trying every number of full children, one window per leaf."""
    def case(level: str) -> str:
        named = " ".join(f"WHEN '{k}' THEN {v}" for k, v in mix.weights(level).items())
        return f"(CASE {level} {named} ELSE {mix.others} END)::HUGEINT"

    def level(name: str, nodes: str, parents: str, key: str) -> str:
        by = f"PARTITION BY {parents}" if parents else ""
        return f"""
{name}a AS (SELECT *, {case(key)} AS w FROM {nodes}),
{name}b AS (SELECT *, sum(room) OVER (q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lower_room,
      sum(w) OVER (q ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM {name}a
      WINDOW q AS ({by} ORDER BY room::DOUBLE / w::DOUBLE, {key})),
{name}c AS (SELECT *, room * rest <= w * (budget - coalesce(lower_room, 0)) AS is_full FROM {name}b),
{name}d AS (SELECT *, budget - coalesce(sum(room) FILTER (WHERE is_full) OVER ({by}), 0) AS rem,
      sum(CASE WHEN is_full THEN 0 ELSE w END) OVER ({by}) AS tot,
      sum(CASE WHEN is_full THEN 0 ELSE w END) OVER ({by} ORDER BY room::DOUBLE / w::DOUBLE, {key} ROWS UNBOUNDED PRECEDING) AS upto FROM {name}c),
{name} AS (SELECT *, CASE WHEN is_full THEN room WHEN tot > 0 THEN (upto * rem)::HUGEINT // tot::HUGEINT - ((upto - w) * rem)::HUGEINT // tot::HUGEINT ELSE 0 END AS give FROM {name}d)"""

    return f"""
WITH t AS (SELECT doc_id, CASE WHEN regexp_extract(source, '([0-9]{{1,9}})$', 1) = '' THEN 'none'
        ELSE (regexp_extract(source, '([0-9]{{1,9}})$', 1)::BIGINT % 3)::VARCHAR END AS domain, lang AS language, source,
        len(regexp_extract_all(text, '[^\\x09-\\x0D\\x20]+'))::BIGINT AS tokens FROM documents),
leaf AS (SELECT domain, language, source, sum(tokens)::HUGEINT AS tokens, sum(tokens)::HUGEINT * {mix.epochs} AS room FROM t GROUP BY ALL),
n1 AS (SELECT domain, sum(room)::HUGEINT AS room, (SELECT sum(tokens)::HUGEINT * {mix.share} // 1000 FROM leaf) AS budget FROM leaf GROUP BY domain),
{level('d1', 'n1', '', 'domain')},
n2 AS (SELECT l.domain, language, sum(l.room)::HUGEINT AS room, any_value(give) AS budget FROM leaf l JOIN d1 ON l.domain = d1.domain GROUP BY ALL),
{level('d2', 'n2', 'domain', 'language')},
n3 AS (SELECT l.domain, l.language, source, tokens, l.room, give AS budget FROM leaf l JOIN d2 ON l.domain = d2.domain AND l.language = d2.language),
{level('d3', 'n3', 'domain, language', 'source')},
p AS (SELECT t.*, (give // d3.tokens)::BIGINT AS last, give % d3.tokens AS want FROM t JOIN d3 USING (domain, language, source) WHERE d3.tokens > 0),
o AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, language, source
      ORDER BY md5('{mix.seed}|' || last || '|' || doc_id) RANGE UNBOUNDED PRECEDING) AS running FROM p),
e AS (SELECT *, unnest(range(last + CASE WHEN running <= want THEN 1 ELSE 0 END)) AS epoch FROM o)
SELECT doc_id, domain, language, source, tokens AS n_tokens, epoch FROM e"""
