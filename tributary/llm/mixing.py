"""Mixing sources to target weights, by hierarchical budgeting.

A token budget flows down a tree domain -> language -> source in proportion to
the weights of the nodes.  A node never gets more than its subtree can supply
(its tokens times the epochs allowed); what it cannot take goes to its siblings
first, and only if they are full too to the siblings of its ancestors.  Each
leaf then takes whole epochs of its documents and, of one more epoch in a
seeded order, the longest prefix that fits the rest.

Everything is DataFrame operations.  The tree is a small table; a leaf that
holds a third of all rows is never ordered whole: token sums per bucket of the
order find the one bucket where the prefix ends, and only that is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.shared import written

LEVELS = ["domain", "lang", "source"]
NONE = "(none)"
_WORDS = r"[^\x20\x09-\x0D]+"

# Production weights; nodes that are not listed weigh 1.
WEIGHTS = {
    "domain": {"group0": 4, "group1": 3, "group2": 2, "group3": 1},
    "lang": {"en": 5, "de": 2, "fr": 2, "es": 1},
    "source": {"src0": 2},
}
BUDGET_PERCENT = 60
MAX_EPOCHS = 3
SEED = 17


def domain_of(source: Column) -> Column:
    """The domain of a source: by the number that ends its name, in groups of four."""
    number = F.regexp_extract(source, "([0-9]{1,9})$", 1).try_cast("int")
    return F.when(number.isNotNull(), F.concat(F.lit("group"), (number % 4).cast("string"))).otherwise("other")


def token_count(text: Column) -> Column:
    """Tokens of a text: its words."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORDS)), F.lit(0)).cast("long")


def _weight(level: str, weights: dict) -> Column:
    out = F.lit(1)
    for name, w in sorted(weights.get(level, {}).items()):
        out = F.when(F.col(level) == name, int(w)).otherwise(out)
    return out.cast("decimal(38,0)")


def _shares(nodes: DataFrame, level: str, parents: list[str], weights: dict) -> DataFrame:
    """Split ``budget`` of each parent among its children ``level`` with
    capacity ``cap``: those that cannot take their fair share are filled, the
    others share the rest by weight (rounded down)."""
    parent = Window.partitionBy(*parents)
    order = parent.orderBy(F.col("cap").cast("double") / F.col("w").cast("double"), level)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    wide = "decimal(38,0)"
    filled = ((F.col("budget").cast(wide) - F.coalesce(F.sum("cap").over(before), F.lit(0))) * F.col("w")
              >= F.col("cap").cast(wide) * F.sum("w").over(after))
    return (nodes.withColumn("w", _weight(level, weights)).withColumn("filled", filled)
            .withColumn("left", F.col("budget").cast(wide) - F.coalesce(
                F.sum(F.when(F.col("filled"), F.col("cap"))).over(parent), F.lit(0)))
            .withColumn("open", F.sum(F.when(~F.col("filled"), F.col("w"))).over(parent))
            .withColumn("budget", F.when(F.col("filled"), F.col("cap")).otherwise(
                F.expr("(left * w) div open")).cast("long"))
            .drop("w", "filled", "left", "open"))


def leaf_budgets(leaves: DataFrame, budget: DataFrame, weights: dict, max_epochs: int) -> DataFrame:
    """leaves (domain, lang, source, tokens) with the budget of each leaf, its
    whole epochs and the rest taken from one epoch more.  ``budget``: one row
    with one column ``budget``."""
    leaves = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    nodes = leaves.groupBy("domain").agg(F.sum("cap").cast("long").alias("cap")).withColumn("root", F.lit(0))
    nodes = nodes.join(budget.withColumn("root", F.lit(0)), "root")
    nodes = _shares(nodes, "domain", ["root"], weights).select("domain", "budget")
    for level, parents in (("lang", ["domain"]), ("source", ["domain", "lang"])):
        child = leaves.groupBy(*parents, level).agg(F.sum("cap").cast("long").alias("cap"))
        nodes = _shares(child.join(nodes, parents), level, parents, weights).drop("cap")
    return (leaves.drop("cap").join(nodes, LEVELS)
            .withColumn("whole", F.expr("if(tokens > 0, budget div tokens, 0)"))
            .withColumn("rest", F.expr("if(tokens > 0, budget % tokens, 0)")))


def _place(seed: int) -> Column:
    """A document's place in the order of its leaf's last epoch: 60 bits."""
    key = F.concat_ws(":", F.lit(str(seed)), (F.col("whole") + 1).cast("string"), F.col("id"))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def mix(docs: DataFrame, weights: dict | None = None, budget_percent: int = BUDGET_PERCENT,
        max_epochs: int = MAX_EPOCHS, seed: int = SEED, domain=domain_of) -> DataFrame:
    """``docs`` with ``domain``, ``n_tokens`` and ``epoch`` (1, 2, ...): one row
    per document and epoch that takes it.  Existing columns of these names are
    replaced.

    The budget is ``budget_percent`` of all tokens.  A null lang or source
    counts as a source of its own, "(none)".  Texts without a word (null and
    empty ones too) hold no token and are never taken.  Repeated rows share
    their place in the order and are taken or left together.  An empty input
    gives an empty result.
    """
    weights = WEIGHTS if weights is None else weights
    own = docs.drop("domain", "n_tokens", "epoch")
    tagged = (own.withColumn("domain", domain(F.col("source"))).withColumn("n_tokens", token_count(F.col("text")))
              .withColumn("_lang", F.coalesce("lang", F.lit(NONE)))
              .withColumn("_source", F.coalesce("source", F.lit(NONE)))
              .withColumn("id", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    slim = written(tagged.where("n_tokens > 0").select(
        "domain", F.col("_lang").alias("lang"), F.col("_source").alias("source"), "id", "n_tokens"), "mix-slim")
    leaves = slim.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    budget = slim.agg(F.expr(f"coalesce(sum(n_tokens), 0) * {int(budget_percent)} div 100").alias("budget"))
    plan = written(leaf_budgets(leaves, budget, weights, max_epochs), "mix-plan")
    # where does the prefix of the last epoch end?  first the bucket, then the row
    placed = (slim.join(plan.where("rest > 0").select(*LEVELS, "whole", "rest"), LEVELS)
              .withColumn("place", _place(seed)).withColumn("bucket", F.shiftright("place", 48)))
    sums = placed.groupBy(*LEVELS, "rest", "bucket").agg(F.sum("n_tokens").alias("tokens"))
    running = F.sum("tokens").over(Window.partitionBy(*LEVELS).orderBy("bucket"))
    cut = written(sums.withColumn("upto", running).where("upto > rest").groupBy(*LEVELS, "rest")
                  .agg(F.min_by(F.struct("bucket", (F.col("upto") - F.col("tokens")).alias("before")), "bucket")
                       .alias("c")).select(*LEVELS, "rest", "c.*"), "mix-cut")
    inside = (placed.join(cut.drop("rest"), [*LEVELS, "bucket"])
              .withColumn("upto", F.col("before") + F.sum("n_tokens").over(
                  Window.partitionBy(*LEVELS).orderBy("place", "id"))))
    last = inside.where("upto <= rest").groupBy(*LEVELS).agg(
        F.max(F.struct(F.col("place"), F.col("id"))).alias("last"))
    ends = written(
        plan.join(cut.select(*LEVELS, "bucket"), LEVELS, "left").join(last, LEVELS, "left")
        .select("domain", F.col("lang").alias("_lang"), F.col("source").alias("_source"),
                "whole", F.col("bucket").alias("_bucket"), F.col("last").alias("_last")), "mix-ends")
    place = F.struct(_place(seed).alias("place"), F.col("id"))
    taken = F.coalesce((F.shiftright(place["place"], 48) < F.col("_bucket")) | (place <= F.col("_last")), F.lit(False))
    return (tagged.where("n_tokens > 0").join(ends, ["domain", "_lang", "_source"])
            .withColumn("_times", F.col("whole") + F.when(taken, 1).otherwise(0))
            .where("_times > 0")
            .select(*own.columns, "domain", "n_tokens", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))).alias("epoch")))


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs).select("doc_id", "domain", "lang", "source", "n_tokens", "epoch")


def _case(level: str) -> str:
    rows = " ".join(f"WHEN '{k}' THEN {v}" for k, v in sorted(WEIGHTS[level].items()))
    return f"CAST(CASE {level} {rows} ELSE 1 END AS HUGEINT)"


def _level_sql(source: str, level: str, parent: str) -> str:
    return f"""
  SELECT * EXCLUDE (w, filled, budget, remaining, open_w),
         CAST(CASE WHEN filled THEN cap ELSE remaining * w // open_w END AS BIGINT) AS budget
  FROM (
    SELECT *, budget - coalesce(sum(CASE WHEN filled THEN cap END) OVER (PARTITION BY {parent}), 0) AS remaining,
           sum(CASE WHEN NOT filled THEN w END) OVER (PARTITION BY {parent}) AS open_w
    FROM (
      SELECT *, (budget - coalesce(sum(cap) OVER (PARTITION BY {parent} ORDER BY cap::DOUBLE / w::DOUBLE, {level}
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * w
                >= cap::HUGEINT * sum(w) OVER (PARTITION BY {parent} ORDER BY cap::DOUBLE / w::DOUBLE, {level}
                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS filled
      FROM (SELECT *, {_case(level)} AS w FROM ({source}))))"""


def op4_sql(budget_percent: int = BUDGET_PERCENT, max_epochs: int = MAX_EPOCHS, seed: int = SEED,
            documents: str = "documents") -> str:
    one = _level_sql("SELECT domain, sum(cap) AS cap, any_value(total) AS budget, 0 AS root FROM leaves "
                     "GROUP BY domain", "domain", "root")
    two = _level_sql("SELECT l.domain, l.lang, sum(l.cap) AS cap, any_value(b.budget) AS budget FROM leaves l "
                     "JOIN one b USING (domain) GROUP BY ALL", "lang", "domain")
    three = _level_sql("SELECT l.domain, l.lang, l.source, l.tokens, l.cap, b.budget FROM leaves l "
                       "JOIN two b USING (domain, lang)", "source", "domain, lang")
    return rf"""
WITH t AS (
  SELECT *, coalesce('group' || (TRY_CAST(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS INT) % 4), 'other') AS domain,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS n_tokens
  FROM {documents}),
s AS (SELECT *, coalesce(lang, '{NONE}') AS lg, coalesce(source, '{NONE}') AS src FROM t WHERE n_tokens > 0),
leaves AS (
  SELECT domain, lg AS lang, src AS source, sum(n_tokens)::BIGINT AS tokens,
         sum(n_tokens)::HUGEINT * {max_epochs} AS cap,
         (SELECT sum(n_tokens)::HUGEINT * {budget_percent} // 100 FROM s) AS total
  FROM s GROUP BY ALL),
one AS ({one}),
two AS ({two}),
three AS ({three}),
p AS (
  SELECT s.*, budget // tokens AS whole, budget % tokens AS rest,
         ('0x' || substr(md5('{seed}:' || (budget // tokens + 1) || ':' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS place
  FROM s JOIN three q ON s.domain = q.domain AND s.lg = q.lang AND s.src = q.source),
r AS (
  SELECT *, whole + CASE WHEN sum(n_tokens) OVER (PARTITION BY domain, lg, src
              ORDER BY place, coalesce(CAST(doc_id AS VARCHAR), '')) <= rest THEN 1 ELSE 0 END AS times FROM p)
SELECT doc_id, domain, lang, source, n_tokens, CAST(epoch AS INT) AS epoch
FROM (SELECT *, unnest(range(1, times + 1)) AS epoch FROM r)
"""
