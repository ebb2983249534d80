"""Operator 6, n-gram Jaccard join with adaptive multi-match prefixes, returning the components of the links.

A document's set holds the hashes of its distinct n-word shingles; equal sets become one class, represented by its
smallest id. Two sets of similarity t or more share at least l tokens among their first |x| - ceil(t|x|) + l tokens of
a fixed global order, for every l up to the smaller overlap bound. Each document takes the l that makes its estimated
candidate cost least: the summed frequency of its prefix tokens (each posting is read once) plus that sum over l times
its size (at most so many candidates reach l matches, and each is verified in full). A pair is a candidate when it
shares min(l_x, l_y) prefix tokens and its sets' rests leave room for the similarity.

The global order puts listed frequent tokens last and, of the others, a fixed low share of the hash range first. The
order may be any, so the bound on the broadcast list of frequent tokens costs time only, never a link. Components need
not compare all pairs of a large group: crowded buckets first link their members to the bucket's smallest one, and only
pairs whose members are still apart then are enumerated, at places in their prefixes that leave room for the similarity. All links that join different components are verified
exactly, so the components are those of the whole link graph.

Defined cases: null or blank texts have an empty set and are linked with nothing, not even each other; fewer words than
n are one shingle of the whole sequence; null ids get no component (null) unless a row with an id has the same set; rows
that repeat an id keep their rows, and if their texts differ the id joins both texts' groups; empty tables
give empty results; extra columns are ignored. Sets are compared by 64-bit shingle hashes (a collision, about one in
10^10 for two sets, could change a borderline similarity).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import crosscheck_columns, lower_ascii, marked, release, shingle_hashes, small_batches, stage, staged_so_far, table, words
from salesmart.llm.components import components

#: Longest adaptive prefix, frequent tokens ordered last (8 bytes each in a broadcast), their least frequency, and the
#: members that make a bucket crowded.
MAX_MATCHES = 4
HOT = 65536
HOT_DF = 16
CROWDED = 8
#: Size classes of a group's members, to a factor of e: one percent each.
SLOTS_PER_E = 100
#: Cost of reading one posting, and of verifying a candidate for each of its tokens.
READ_COST, VERIFY_COST = 1.0, 0.05


def token_set(text: Column, n: int) -> Column:
    return F.sort_array(F.array_distinct(shingle_hashes(words(lower_ascii(F.coalesce(text, F.lit("")))), n)))



def _prefixes(hot: np.ndarray, df: np.ndarray, bound: int, pct: int, whole: bool):
    """Choose each document's number of matches and cut its prefix.

    tokens hold a document's set, or, unless ``whole``, its part below the bound. A document that has too few tokens
    there which aren't frequent is crowded: it gets no prefix, and has to come again with its whole set.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for rep, n, tokens in zip(pdf["rep"], pdf["n"], pdf["tokens"]):
                t = np.asarray(tokens, np.int64)
                freq = np.ones(len(t))
                if len(hot):
                    at = np.minimum(np.searchsorted(hot, t), len(hot) - 1)
                    freq = np.where(hot[at] == t, df[at], 1)
                order = np.lexsort((t, t >= bound, freq > 1))
                t, freq = t[order], freq[order]
                least = (n * pct + 99) // 100
                most = min(MAX_MATCHES, least)
                if not whole and np.count_nonzero((freq == 1) & (t < bound)) < n - least + most:
                    out.append((rep, n, None, None, True))
                    continue
                read = np.cumsum(freq)
                costs = []
                for m in range(1, most + 1):
                    s = read[n - least + m - 1]
                    costs.append((s * READ_COST + s / m * n * VERIFY_COST, m))
                m = min(costs)[1]
                out.append((rep, n, m, t[:n - least + m], False))
            yield pd.DataFrame(out, columns=["rep", "n", "m", "prefix", "crowded"])
    return run


def _frequent(tokens: DataFrame) -> pd.DataFrame:
    """The HOT most frequent of the tokens (a column token) that HOT_DF sets have, sorted by token."""
    df = tokens.groupBy("token").count().where(F.col("count") >= HOT_DF)
    return df.orderBy(F.desc("count"), "token").limit(HOT).toPandas().sort_values("token", ignore_index=True)


def _may_reach(shared, na, pa, nb, pb, pct: int) -> Column:
    """Whether two sets of na and nb tokens that share so many of their pa and pb prefix tokens can be near enough.

    Of the common tokens, those up to the prefix end that comes first in the order are all shared prefix tokens; the
    others are at most the rest of that set.
    """
    overlap = shared + F.greatest(na - pa, nb - pb)
    return (100 + pct) * overlap >= pct * (na + nb)


def _verified(pairs: DataFrame, docs: DataFrame, n_gram: int, pct: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the similarity; sets are made for the documents concerned only.

    No filter on the sets here: it would be pushed below the bitmap's join and make the sets of all documents.
    """
    pairs = stage(pairs, "pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    ids = stage(ids, "ids")
    sets = marked(docs, F.col("id"), ids).where("maybe")
    sets = stage(sets.select("id", token_set(F.col("text"), n_gram).alias("s")), "sets")
    both = (pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b"))
    inter = F.size(F.array_intersect("sa", "sb"))
    return both.where(100 * inter >= pct * (F.size("sa") + F.size("sb") - inter)).select("a", "b")


def _sharing(pairs: DataFrame, prefixes: DataFrame, pct: int) -> DataFrame:
    """The pairs (a, b) whose prefixes share as many tokens as both documents' choices of matches ask for."""
    side = prefixes.select(F.col("rep").alias("a"), F.col("m").alias("ma"), F.col("n").alias("na"), F.col("prefix").alias("xa"))
    other = prefixes.select(F.col("rep").alias("b"), F.col("m").alias("mb"), F.col("n").alias("nb"), F.col("prefix").alias("xb"))
    both = stage(pairs, "met").join(side, "a").join(other, "b").withColumn("shared", F.size(F.array_intersect("xa", "xb")))
    return both.where(F.col("shared") >= F.least("ma", "mb")).where(_may_reach(
        F.col("shared"), F.col("na"), F.size("xa"), F.col("nb"), F.size("xb"), pct)).select("a", "b").distinct()


def _open_posts(posts: DataFrame, labels: DataFrame) -> DataFrame:
    """posts with the label of their component, of tokens that more than one component has."""
    posts = posts.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    posts = posts.withColumn("label", F.coalesce("label", "rep"))
    spread = posts.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi")
    return posts.join(spread.select("token"), "token", "left_semi")


def jaccard_components(docs: DataFrame, n_gram: int = 3, pct: int = 90) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id; links need 100 * intersection >= pct * union."""
    crosscheck_columns(docs, "doc_id", "text")
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    low = min(1.0, 2.5 * (100 - pct) / 100)
    bound = int(-(1 << 63) + low * (1 << 64)) if low < 1 else (1 << 63) - 1
    rows = docs.select("id", token_set(F.col("text"), n_gram).alias("s"))
    rows = rows.select("id", F.size("s").alias("n"), F.xxhash64("s").alias("k1"), F.hash("s", F.lit(n_gram)).alias("k2"),
                       F.filter("s", lambda t: t < bound).alias("low"))
    began = staged_so_far()
    rows = stage(rows.select("id", "n", "k1", "k2", F.col("low").alias("tokens")), "rows")

    # classes of equal sets; only their smallest ids go on
    keys = ["n", "k1", "k2"]
    classes = stage(rows.where("n > 0 AND id IS NOT NULL").groupBy(*keys).agg(F.min("id").alias("rep")), "classes")
    reps = rows.join(classes.select("rep", *keys), (rows["id"] == classes["rep"]) & (rows["n"] == classes["n"])
                     & (rows["k1"] == classes["k1"]) & (rows["k2"] == classes["k2"]))
    # an id with several texts stands for each of them
    reps = reps.select("rep", rows["n"], rows["k1"], rows["k2"], "tokens").dropDuplicates(["rep", *keys]).drop("k1", "k2")
    # read twice below; from here on the tokens are in reps alone
    reps = stage(reps, "reps")
    rows = stage(rows.drop("tokens"), "narrow")
    classes = stage(classes, "classes")
    release(spark, began, keep=3)
    begun = began + 3

    # frequent tokens come last in the order. First they are counted in the low share of the hash range; only documents
    # that have too few other tokens there are read again, and the frequent ones of their tokens above the share added
    schema = "rep long, n int, m int, prefix array<long>, crowded boolean"
    hot = _frequent(reps.select(F.explode("tokens").alias("token")))
    cut = stage(reps.mapInPandas(_prefixes(hot["token"].to_numpy(np.int64), hot["count"].to_numpy(np.int64), bound, pct,
                                           False), schema), "cut")
    crowd = stage(cut.where("crowded").select("rep", "n"), "crowd")
    again = marked(docs, F.col("id"), crowd.select("rep")).where("maybe")
    again = again.select("id", token_set(F.col("text"), n_gram).alias("tokens")).join(
        crowd, (F.col("id") == F.col("rep")) & (F.size("tokens") == F.col("n")))
    again = again.select("rep", "n", "tokens", F.xxhash64("tokens").alias("k")).dropDuplicates(["rep", "n", "k"])
    again = stage(again.drop("k"), "again")
    # low tokens keep their status of the first pass: so its prefixes are prefixes of the second order too
    high = _frequent(again.select(F.explode("tokens").alias("token")).where(F.col("token") >= bound))
    hot = pd.concat([high, hot]).sort_values("token")
    second = again.mapInPandas(_prefixes(hot["token"].to_numpy(np.int64), hot["count"].to_numpy(np.int64), bound, pct, True),
                               schema)
    prefixes = stage(cut.where("NOT crowded").unionByName(second).drop("crowded").withColumn("p", F.size("prefix")),
                     "prefixes")
    release(spark, begun)
    release(spark, began, keep=3)  # reps: narrow, classes and prefixes stay
    posts = prefixes.select("rep", "n", "m", "p", F.posexplode("prefix").alias("pos", "token"))

    # crowded buckets of like sizes: every member against the smallest one
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / pct))).cast("int")
    sized = posts.withColumn("band", band)
    heads = sized.groupBy("token", "band").agg(F.count("*").alias("members"), F.min("rep").alias("a"))
    heads = stage(heads.where(F.col("members") >= CROWDED).drop("members"), "heads")
    star = (sized.join(heads, ["token", "band"]).where("a != rep").groupBy("a", F.col("rep").alias("b"))
            .agg(F.count("*").alias("shared")).select("a", "b"))
    star = _sharing(star, prefixes, pct)
    since = staged_so_far()
    first = stage(_verified(star, docs, n_gram, pct), "first")
    release(spark, since)

    # all other candidates: members that are still apart, of tokens that more than one component has
    posts = stage(_open_posts(posts, components(first)), "posts")
    # the first common token leaves room behind it for the rest of what the sizes ask for: na - pos >= overlap, and nb
    # likewise. Groups are split by size, so that their bounds are nearly their members'
    posts = posts.withColumn("slot", F.floor(F.log(F.col("n").cast("double")) * SLOTS_PER_E).cast("int"))
    groups = stage(posts.groupBy("token", "label", "slot").agg(
        F.min("n").alias("lo"), F.max("n").alias("hi"), F.min("pos").alias("pos")), "groups")

    def room(pos: str, own: str, other: str) -> str:
        return f"{pos} <= (100L * {own} - {pct} * {other}) div {100 + pct}"
    meet = groups.alias("x").join(groups.alias("y"), F.expr(
        f"x.token = y.token AND x.label < y.label AND 100 * x.hi >= {pct} * y.lo AND 100 * y.hi >= {pct} * x.lo "
        f"AND {room('x.pos', 'x.hi', 'y.lo')} AND {room('y.pos', 'y.hi', 'x.lo')}"))
    meet = meet.select("x.token", F.col("x.label").alias("la"), F.col("y.label").alias("lb"), F.col("x.slot").alias("ta"),
                       F.col("y.slot").alias("tb"), F.col("y.lo").alias("least_nb"))
    one = posts.select("token", F.col("label").alias("la"), F.col("slot").alias("ta"), F.col("rep").alias("a"),
                       F.col("n").alias("na"), F.col("pos").alias("qa"))
    two = posts.select("token", F.col("label").alias("lb"), F.col("slot").alias("tb"), F.col("rep").alias("b"),
                       F.col("n").alias("nb"), F.col("pos").alias("qb"))
    at = [F.col(f"g.{c}") == F.col(f"o.{c}") for c in ("token", "la", "ta")]
    pairs = meet.alias("g").join(one.alias("o"), at[0] & at[1] & at[2] & F.expr(room("qa", "na", "least_nb")))
    pairs = pairs.select("g.token", "lb", "tb", "a", "na", "qa")
    at = [F.col(f"g.{c}") == F.col(f"o.{c}") for c in ("token", "lb", "tb")]
    pairs = pairs.alias("g").join(two.alias("o"), at[0] & at[1] & at[2] & F.expr(
        f"100 * na >= {pct} * nb AND 100 * nb >= {pct} * na AND {room('qa', 'na', 'nb')} AND {room('qb', 'nb', 'na')}"))
    pairs = _sharing(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a != b").distinct(),
                     prefixes, pct)
    since = staged_so_far()
    rest = stage(_verified(pairs, docs, n_gram, pct), "rest")
    release(spark, since)
    links = first.unionByName(rest)
    # an id that stands for several texts ties their classes together
    many = rows.where("n > 0 AND id IS NOT NULL").join(classes, keys).where("id != rep")
    repeated = rows.where("id IS NOT NULL").groupBy("id").agg(F.countDistinct("k1", "k2").alias("c")).where("c > 1")
    links = links.unionByName(many.join(repeated, "id", "left_semi").select(F.col("id").alias("a"), F.col("rep").alias("b")))
    labels = components(links).withColumnRenamed("node", "rep")

    named = stage(classes.join(labels, "rep", "left").select(*keys, F.coalesce("label", "rep").alias("label")), "named")
    out = rows.select("id", *keys).join(named, keys, "left")
    return out.select(F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"),
                      F.coalesce("label", "id").alias("component_id"))


def keep_one(docs: DataFrame, n_gram: int = 5, pct: int = 80) -> DataFrame:
    """The rows of docs of the smallest id of each component, with all their columns. Rows without an id stay."""
    found = jaccard_components(docs, n_gram, pct).where("doc_id != component_id").select("doc_id").distinct()
    gone = stage(found.withColumnRenamed("doc_id", "gone"), "gone")
    rows = marked(docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("key")), F.col("key"), gone)
    # only rows that the bitmap marks, most of which go, are shuffled
    left = rows.where("maybe").hint("merge").join(gone, F.col("key") == F.col("gone"), "left_anti")
    return rows.where("NOT maybe").select("row.*").unionByName(left.select("row.*"))


def query(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) >= 3
    THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
c AS (SELECT list_sort(s) AS s, min(doc_id) AS rep, len(any_value(s)) AS n FROM s WHERE len(s) > 0 GROUP BY list_sort(s)),
t AS (SELECT rep, n, unnest(s) AS t FROM c),
p AS (SELECT x.rep AS a, y.rep AS b, any_value(x.n) + any_value(y.n) AS total, count(*) AS inter
      FROM t x JOIN t y ON x.t = y.t AND x.rep < y.rep AND 100 * x.n >= 90 * y.n AND 100 * y.n >= 90 * x.n
      GROUP BY x.rep, y.rep),
e AS (SELECT a, b FROM p WHERE 100 * inter >= 90 * (total - inter)),
l AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e UNION ALL SELECT rep, rep FROM c),
r AS (SELECT a AS node, b AS seen FROM l UNION SELECT r.node, l.b FROM r JOIN l ON r.seen = l.a),
k AS (SELECT node, min(seen) AS label FROM r GROUP BY node)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(k.label, s.doc_id) AS component_id
FROM s LEFT JOIN c ON c.s = list_sort(s.s) LEFT JOIN k ON k.node = c.rep
"""
