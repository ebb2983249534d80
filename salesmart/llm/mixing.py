"""Operator 9 [native], mixing sources to target weights by hierarchical budgeting.

Leaves of the tree domain > language > source have a capacity of max_epochs times their tokens. A node's budget is
shared among its children by weight; a child whose whole subtree holds less than its share is filled, and what it
lacks goes to its siblings first. Only when a whole subtree is short does the rest reach the ancestor's other
children, since a subtree's capacity bounds its own share there. All shares are exact integer arithmetic.

A leaf's budget becomes full epochs plus a token prefix of the next one: its documents in the order of a seeded hash
of (seed, epoch, doc_id), as long as the running token sum stays within the rest. The running sum is two-level (hash
bucket, then inside a bucket), so a leaf with a third of all rows is spread over 4096 groups.

Defined cases: null domain, language or source are a leaf key '(none)', and so is the domain of a source of another form; null or empty text has no tokens and comes
along with its prefix; a weight of zero or below gives no budget; an empty table gives an empty result; rows repeated
with one id are separate documents, ties between them are broken by their tokens; extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import crosscheck_columns, stage, table, words

LEVELS = ("domain", "lang", "source")
#: Production parameters of the registered query: the domain of a source (of one that isn't src and a number: none), and weights (others weigh 1).
DOMAIN_SQL = ("CASE WHEN substr(source, 1, 3) = 'src' AND length(source) BETWEEN 4 AND 12 "
              "AND translate(substr(source, 4), '0123456789', '') = '' "
              "THEN concat('domain', cast(substr(source, 4) AS int) % 4) END")
WEIGHTS = {"domain": {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1},
           "lang": {"en": 6, "de": 2, "fr": 2, "es": 1}, "source": {"src0": 3}}
#: Tokens wanted, as a share of the tokens there are.
SHARE = (3, 5)
MAX_EPOCHS = 2
SEED = 17
_BIG = "decimal(20,0)"


def _weight(level: str, weights: dict) -> str:
    cases = "".join(f" WHEN '{k}' THEN {int(v)}" for k, v in weights.get(level, {}).items())
    return f"CASE {level}{cases} ELSE 1 END" if cases else "1"


def _share(nodes: DataFrame, parent: list[str], key: str, weights: dict) -> DataFrame:
    """Give each node (columns parent.., key, cap, have = the parent's budget) its budget ``got``."""
    n = nodes.withColumn("w", F.expr(_weight(key, weights)).cast("long")).where("w > 0")
    n = n.withColumn("ratio", F.col("cap").cast("double") / F.col("w").cast("double"))
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    up = by.orderBy("ratio", key).rowsBetween(Window.unboundedPreceding, -1)
    n = n.withColumn("before", F.coalesce(F.sum("cap").over(up), F.lit(0)))
    n = n.withColumn("open_w", F.sum("w").over(by) - F.coalesce(F.sum("w").over(up), F.lit(0)))
    n = n.withColumn("full", F.expr(f"cast(cap AS {_BIG}) * cast(open_w AS decimal(18,0)) <= "
                                    f"cast(w AS decimal(18,0)) * cast(have - before AS {_BIG})"))
    n = n.withColumn("filled", F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(by))
    n = n.withColumn("rest_w", F.sum(F.when(~F.col("full"), F.col("w")).otherwise(0)).over(by))
    got = F.when(F.col("full"), F.col("cap")).otherwise(F.expr(
        f"cast(w AS decimal(18,0)) * cast(have - filled AS {_BIG}) div cast(rest_w AS decimal(18,0))"))
    return n.withColumn("got", got.cast("long")).select(*nodes.columns, "got")


def leaf_budgets(leaves: DataFrame, weights: dict, share: tuple[int, int], max_epochs: int) -> DataFrame:
    """leaves: domain, lang, source, tokens. Adds ``budget``; one row per leaf, so this is small whatever the input."""
    leaves = leaves.withColumn("cap", F.col("tokens") * F.lit(max_epochs).cast("long"))
    total = F.expr(f"least(sum(cap), cast(sum(tokens) AS {_BIG}) * {int(share[0])} div {int(share[1])})")
    root = leaves.agg(total.cast("long").alias("have"))
    domains = leaves.groupBy("domain").agg(F.sum("cap").alias("cap")).crossJoin(F.broadcast(root))  # root: one row
    domains = _share(domains, [], "domain", weights).select("domain", F.col("got").alias("have"))
    langs = leaves.groupBy("domain", "lang").agg(F.sum("cap").alias("cap")).join(domains, "domain")
    langs = _share(langs, ["domain"], "lang", weights).select("domain", "lang", F.col("got").alias("have"))
    out = _share(leaves.join(langs, ["domain", "lang"]), ["domain", "lang"], "source", weights)
    return out.select("domain", "lang", "source", "tokens", F.col("got").alias("budget"))


def mix(docs: DataFrame, domain_sql: str = DOMAIN_SQL, weights: dict | None = None, share: tuple[int, int] = SHARE,
        max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """(row: all columns of docs, domain, lang, source, tokens, epoch, budget, copies), also where copies is 0."""
    crosscheck_columns(docs, "doc_id", "text", "lang", "source")
    weights = WEIGHTS if weights is None else weights
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"),
                       F.coalesce(F.expr(domain_sql), F.lit("(none)")).alias("domain"),
                       F.coalesce("lang", F.lit("(none)")).alias("lang"),
                       F.coalesce("source", F.lit("(none)")).alias("source"),
                       F.size(words(F.col("text"))).cast("long").alias("tokens"))
    leaves = stage(rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens")), "leaves")
    budgets = leaf_budgets(leaves, weights, share, max_epochs).withColumns({
        "epoch": F.expr("CASE WHEN tokens > 0 THEN budget div tokens ELSE 0 END").cast("long"),
        "rest": F.expr("CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END")})
    budgets = stage(budgets.withColumnRenamed("tokens", "leaf_tokens"), "budgets")
    # a join on the leaf alone would gather a hot source; its budget rows are repeated for every hash digit instead
    digit = F.explode(F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.lower(F.hex(i)))).alias("digit")
    spread = budgets.select("*", digit)
    # the digit comes from the id alone, the order inside the epoch from seed, epoch and id
    rows = rows.withColumn("digit", F.substring(F.md5(F.coalesce(F.col("id").cast("string"), F.lit(""))), 1, 1))
    r = rows.join(spread, [*LEVELS, "digit"])
    r = r.withColumn("h", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epoch").cast("string"),
                                            F.coalesce(F.col("id").cast("string"), F.lit("")))))
    r = r.withColumn("bucket", F.substring("h", 1, 3)).drop("digit")
    sums = r.groupBy(*LEVELS, "bucket").agg(F.sum("tokens").alias("held"))
    earlier = Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*LEVELS, "bucket", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("start"))
    r = r.join(sums, [*LEVELS, "bucket"])
    inside = (Window.partitionBy(*LEVELS, "bucket").orderBy("h", "id", "tokens")
              .rowsBetween(Window.unboundedPreceding, 0))
    upto = F.col("start") + F.sum("tokens").over(inside)
    taken = ((upto <= F.col("rest")) & (F.col("rest") > 0)).cast("int")
    return r.select("row", *LEVELS, "tokens", "epoch", "budget", (F.col("epoch") + taken).cast("long").alias("copies"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs that the mix takes, as often as it takes them, with the columns of docs."""
    m = mix(docs, **options).where("copies > 0")
    return m.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("i")).select("row.*")


def query(spark, sf_dir):
    m = mix(table(spark, sf_dir, "documents"))
    return m.select("row.doc_id", *LEVELS, "tokens", "budget", "epoch", "copies")


def _case(level: str) -> str:
    return _weight(level, WEIGHTS)


def _level(name: str, source: str, parent: list[str], key: str) -> str:
    p = ", ".join(parent) or "1"
    return f"""
{name}_a AS (SELECT *, cap::DOUBLE / w::DOUBLE AS ratio FROM (SELECT *, {_case(key)} AS w FROM {source})),
{name}_b AS (SELECT *, coalesce(sum(cap) OVER u, 0)::HUGEINT AS before,
    (sum(w) OVER (PARTITION BY {p}) - coalesce(sum(w) OVER u, 0))::HUGEINT AS open_w FROM {name}_a
    WINDOW u AS (PARTITION BY {p} ORDER BY ratio, {key} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
{name}_c AS (SELECT *, cap::HUGEINT * open_w <= w::HUGEINT * (have::HUGEINT - before) AS filled FROM {name}_b),
{name} AS (SELECT *, CASE WHEN filled THEN cap::HUGEINT ELSE
    w::HUGEINT * (have::HUGEINT - (sum(CASE WHEN filled THEN cap ELSE 0 END) OVER (PARTITION BY {p}))::HUGEINT)
    // (sum(CASE WHEN filled THEN 0 ELSE w END) OVER (PARTITION BY {p}))::HUGEINT END AS got FROM {name}_c)"""


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, coalesce(CASE WHEN substr(source, 1, 3) = 'src' AND length(source) BETWEEN 4 AND 12
           AND translate(substr(source, 4), '0123456789', '') = ''
         THEN 'domain' || (TRY_CAST(substr(source, 4) AS INT) % 4) END, '(none)') AS domain, coalesce(lang, '(none)') AS lang,
         coalesce(source, '(none)') AS source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS tokens
  FROM documents),
leaf AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS tokens, (sum(tokens) * {MAX_EPOCHS})::BIGINT AS cap
         FROM d GROUP BY ALL),
root AS (SELECT least(sum(cap)::HUGEINT, sum(tokens)::HUGEINT * {SHARE[0]} // {SHARE[1]}) AS have FROM leaf),
top AS (SELECT domain, sum(cap) AS cap, any_value(have) AS have FROM leaf, root GROUP BY domain),
{_level('l1', 'top', [], 'domain')},
mid AS (SELECT leaf.domain, leaf.lang, sum(leaf.cap) AS cap, any_value(l1.got) AS have
        FROM leaf JOIN l1 USING (domain) GROUP BY ALL),
{_level('l2', 'mid', ['domain'], 'lang')},
low AS (SELECT leaf.*, l2.got AS have FROM leaf JOIN l2 ON leaf.domain = l2.domain AND leaf.lang = l2.lang),
{_level('l3', 'low', ['domain', 'lang'], 'source')},
b AS (SELECT domain, lang, source, got::BIGINT AS budget,
        CASE WHEN tokens > 0 THEN got // tokens ELSE 0 END::BIGINT AS epoch,
        CASE WHEN tokens > 0 THEN got % tokens ELSE 0 END::BIGINT AS rest FROM l3),
o AS (SELECT d.doc_id, d.domain, d.lang, d.source, d.tokens, b.budget, b.epoch, b.rest,
        sum(d.tokens) OVER (PARTITION BY d.domain, d.lang, d.source
          ORDER BY md5('{SEED}:' || b.epoch || ':' || d.doc_id), d.doc_id, d.tokens
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
      FROM d JOIN b ON d.domain = b.domain AND d.lang = b.lang AND d.source = b.source)
SELECT doc_id, domain, lang, source, tokens, budget, epoch,
       epoch + CASE WHEN upto <= rest AND rest > 0 THEN 1 ELSE 0 END AS copies FROM o
"""
