"""Operator 11, centroid clustering with ns-bounds (norm of a sum instead of sum of norms).

Lloyd's rounds over integer vectors, exact at every round. Each vector carries one upper bound (the distance to its own
centroid), one lower bound (the distance to any other) and the round they were evaluated in. Nothing is loosened in
storage: the history of all centroids is kept, and when a round needs the bounds it loosens them by the norm of the
total displacement between the round of evaluation and now, which is never more than the sum of the drifts of the rounds
between. Where the loosened bounds still separate, the vector stays without any distance; else first the distance to its
own centroid is evaluated again, and where that fails too, all centroids are scanned exactly and the bounds renewed.

On Spark a round is a map over the stored vectors, which writes them with their new state, and an aggregate over the
vectors that moved: their components are taken from the sums of the old cluster and added to those of the new one.
Centroids, sums and history are k rows a round and the only things the driver holds.

All distances that decide are integers. Bounds are doubles with a margin, so a tie never passes as separated.

Defined cases: vectors that are null, not of ``dim`` components or hold a null or non-finite one are left out; scaled
components beyond +-2^27 are set to that bound, so that squared distances fit a long; a null vec_id is no starting
centroid but is clustered; rows that repeat a vec_id are separate vectors (ties between starts go by their components);
fewer vectors than centroids give as many centroids; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import Scratch, crosscheck_columns, table

#: Production parameters of the registered query.
DIM, K, ROUNDS, SCALE, SEED = 64, 40, 5, 256, 2
#: Largest component: 64 squared differences of it fit a long.
LIMIT = 1 << 27
#: Below this sums of squares are exact in doubles, so one matrix product gives all distances.
EXACT_IN_DOUBLES = 1 << 21
#: Relative margin of the bounds against rounding of square roots.
MARGIN = 1e-9
ROWS_PER_BATCH = 8192


def integer_vectors(embeddings: DataFrame, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """vec_id and v (array of int) of the usable vectors."""
    crosscheck_columns(embeddings, "vec_id", "embedding")

    def usable(x: Column) -> Column:
        y = x.cast("double")
        return x.isNotNull() & ~F.isnan(y) & (F.abs(y) != float("inf"))

    def scaled(x: Column) -> Column:
        y = F.least(F.greatest(x.cast("double") * scale, F.lit(-float(LIMIT))), F.lit(float(LIMIT)))
        return F.floor(y).cast("int")
    e = F.col("embedding")
    kept = embeddings.where(e.isNotNull() & (F.size(e) == dim) & F.forall(e, usable))
    return kept.select("vec_id", F.transform("embedding", scaled).alias("v"))


def starts(vectors: DataFrame, k: int = K, seed: int = SEED) -> np.ndarray:
    """The k vectors with the smallest hashes of their id, in that order."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.where("vec_id is not null").select(h.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r.v for r in rows], dtype=np.int64)


@dataclass
class History:
    """Centroids of every round so far, oldest first; ``moved`` gives total displacements between two rounds."""

    rounds: list[np.ndarray] = field(default_factory=list)

    @property
    def now(self) -> np.ndarray:
        return self.rounds[-1]

    def moved(self) -> np.ndarray:
        """[round of evaluation, centroid]: an upper bound of the norm of the displacement from then to now."""
        now = self.now.astype(np.float64)
        return np.stack([np.sqrt(((now - then) ** 2).sum(axis=1)) for then in self.rounds]) * (1 + MARGIN)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of x to all rows of c, as integers."""
    if max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)) < EXACT_IN_DOUBLES:
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :]).astype(np.int64)
    return np.stack([((x - row) ** 2).sum(axis=1) for row in c], axis=1)


@dataclass
class State:
    """A batch's clusters (-1: never evaluated), bounds, and the rounds that the bounds were evaluated in."""

    own: np.ndarray
    upper: np.ndarray
    upper_round: np.ndarray
    lower: np.ndarray
    lower_round: np.ndarray


def assigned(x: np.ndarray, was: State, history: History, moved: np.ndarray) -> tuple[State, np.ndarray]:
    """The batch's state under the newest centroids, and which rows were scanned against all of them."""
    now, t = history.now, len(history.rounds) - 1
    new = State(*[getattr(was, c).copy() for c in STATE_COLUMNS])
    if t:
        # the nearest other centroid has come closer by the largest displacement but the own centroid's, at most
        order = np.argsort(moved, axis=1)
        top, second = order[:, -1], order[:, max(-2, -order.shape[1])]
        r = was.lower_round
        lower = was.lower - np.where(top[r] == was.own, moved[r, second[r]], moved[r, top[r]])
        upper = was.upper + moved[was.upper_round, was.own]
        some = np.flatnonzero(~apart(upper, lower))
        near = np.sqrt(((x[some] - now[was.own[some]]) ** 2).sum(axis=1).astype(np.float64))
        new.upper[some], new.upper_round[some] = near, t
        scan = some[~apart(near, lower[some])]
    else:
        scan = np.arange(len(x))
    if len(scan):
        d = squared(x[scan], now)
        best, rows = d.argmin(axis=1), np.arange(len(scan))  # the first of equal ones: the smaller number
        new.own[scan], new.upper[scan] = best, np.sqrt(d[rows, best].astype(np.float64))
        d[rows, best] = np.iinfo(np.int64).max
        new.lower[scan] = np.sqrt(d.min(axis=1).astype(np.float64)) if len(now) > 1 else np.inf
        new.upper_round[scan] = new.lower_round[scan] = t
    return new, scan


def apart(upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Surely nearer than any other, whatever the roots were rounded by."""
    return upper * (1 + MARGIN) < lower * (1 - MARGIN)


STATE_COLUMNS = {"own": pa.int32(), "upper": pa.float64(), "upper_round": pa.int32(), "lower": pa.float64(),
                 "lower_round": pa.int32()}
SCHEMA = ("vec_id {id}, v array<int>, own int, upper double, upper_round int, lower double, lower_round int, was int, "
          "scanned boolean")


def one_round(history: History):
    """A map over Arrow batches of the state: every vector with its cluster under the newest centroids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moved = history.moved()
        for b in batches:
            if not b.num_rows:
                continue
            v = b.column("v")
            x = np.asarray(v.flatten()).reshape(b.num_rows, -1).astype(np.int64)
            before = State(*[np.asarray(b.column(c)) for c in STATE_COLUMNS])
            new, scan = assigned(x, before, history, moved)
            scanned = np.zeros(b.num_rows, dtype=bool)
            scanned[scan] = True
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), v, *[pa.array(getattr(new, c), type=t) for c, t in STATE_COLUMNS.items()],
                 pa.array(before.own, type=pa.int32()), pa.array(scanned)],
                names=["vec_id", "v", *STATE_COLUMNS, "was", "scanned"])
    return run


def change(state: DataFrame, dim: int) -> dict[int, tuple[int, list[int]]]:
    """By cluster, how its count and its sums change: rows that moved leave the old one and come to the new one."""
    ends = F.array(F.struct(F.col("own").alias("c"), F.lit(1).alias("sign")),
                   F.struct(F.col("was").alias("c"), F.lit(-1).alias("sign")))
    rows = state.where("own <> was").select("v", F.explode(ends).alias("end")).where("end.c >= 0")
    sums = [F.sum(F.col("v")[i].cast("long") * F.col("end.sign")).alias(f"s{i}") for i in range(dim)]
    got = rows.groupBy("end.c").agg(F.sum("end.sign").alias("n"), *sums).collect()  # k rows at most
    return {r[0]: (r[1], list(r[2:])) for r in got}


def cluster(embeddings: DataFrame, k: int = K, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE,
            seed: int = SEED) -> tuple[DataFrame, History, Scratch]:
    """The state of all vectors after the last assignment, and the centroids of all rounds."""
    spark = embeddings.sparkSession
    scratch = Scratch(spark)
    vectors = integer_vectors(embeddings, dim, scale)
    history = History()
    first = starts(vectors, k, seed)
    state = vectors.select("*", F.lit(-1).alias("own"), F.lit(0.0).alias("upper"), F.lit(0).alias("upper_round"),
                           F.lit(0.0).alias("lower"), F.lit(0).alias("lower_round"), F.lit(-1).alias("was"),
                           F.lit(True).alias("scanned"))
    if not len(first):
        return state.where("false"), history, scratch
    history.rounds.append(first)
    schema = SCHEMA.format(id=embeddings.schema["vec_id"].dataType.simpleString())
    count, sums = np.zeros(len(first), dtype=object), np.zeros(first.shape, dtype=object)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    for t in range(rounds + 1):
        state = scratch.stage(state.mapInArrow(one_round(history), schema), f"round-{t}")
        scratch.keep(1)
        if t == rounds:
            break
        for c, (n, s) in change(state, dim).items():
            count[c] += n
            sums[c] += np.array(s, dtype=object)
        centroids = history.now.copy()
        for c in np.flatnonzero(count):
            centroids[c] = [s // int(count[c]) for s in sums[c]]  # floor of exact integers
        history.rounds.append(centroids)
    return state, history, scratch


def centroid_table(spark, history: History, dim: int = DIM) -> DataFrame:
    """cluster, centroid: one row for each of the k final centroids."""
    rows = [(i, [int(x) for x in c]) for i, c in enumerate(history.now)] if history.rounds else []
    return spark.createDataFrame(rows, "cluster int, centroid array<bigint>")


def clustering(embeddings: DataFrame, k: int = K, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE,
               seed: int = SEED) -> DataFrame:
    """One row per usable vector: vec_id, cluster, distance, its cluster's and the whole inertia, the centroid's hash."""
    state, history, scratch = cluster(embeddings, k, rounds, dim, scale, seed)
    spark = embeddings.sparkSession
    # k rows, a size known beforehand: broadcast
    centroids = F.broadcast(centroid_table(spark, history, dim))
    gap = F.zip_with("v", "centroid", lambda a, b: (a - b) * (a - b))
    near = state.withColumnRenamed("own", "cluster").join(centroids, "cluster").select(
        "vec_id", "cluster", F.aggregate(gap, F.lit(0).cast("long"), lambda acc, x: acc + x).alias("distance"))
    per = near.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # k rows at most
    total = sum(r.cluster_inertia for r in per)
    inertia = spark.createDataFrame([(r.cluster, r.cluster_inertia, total) for r in per],
                                    "cluster int, cluster_inertia bigint, inertia bigint")
    facts = F.broadcast(inertia.join(centroid_table(spark, history, dim), "cluster").select(
        "cluster", "cluster_inertia", "inertia",
        F.sha2(F.concat_ws(",", F.transform("centroid", lambda x: x.cast("string"))), 256).alias("centroid_sha256")))
    return near.join(facts, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                                              "centroid_sha256")


def query(spark, sf_dir):
    return clustering(table(spark, sf_dir, "embeddings"))


def oracle(k: int = K, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: int = SEED) -> str:
    """DuckDB SQL: every round assigns by all distances and takes new means; nothing of the bounds."""
    parts = [f"""
v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id,
         list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = {dim}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE)))) = {dim}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v AS m
  FROM (SELECT sha256('{seed}:' || CAST(vec_id AS VARCHAR)) AS h, v FROM v WHERE vec_id IS NOT NULL
        ORDER BY h, v LIMIT {k}) s)"""]
    for t in range(rounds + 1):
        parts.append(f"""
a{t} AS MATERIALIZED (
  SELECT rid, any_value(vec_id) AS vec_id, any_value(v) AS v, min(d) AS d, arg_min(c, d * 1000 + c) AS c
  FROM (SELECT rid, vec_id, v, c, CAST(list_sum(list_transform(range(1, {dim} + 1), lambda i: (v[i] - m[i]) * (v[i] - m[i])))
               AS BIGINT) AS d FROM v, c{t}) x GROUP BY rid)""")
        if t < rounds:
            parts.append(f"""
e{t} AS MATERIALIZED (
  SELECT c, i, CAST(sum(x) - ((sum(x) % count(*)) + count(*)) % count(*) AS BIGINT) // count(*) AS y
  FROM (SELECT c, unnest(v) AS x, unnest(range(1, {dim} + 1)) AS i FROM a{t}) u GROUP BY c, i),
c{t + 1} AS MATERIALIZED (
  SELECT c{t}.c, coalesce(n.m, c{t}.m) AS m
  FROM c{t} LEFT JOIN (SELECT c, list(y ORDER BY i) AS m FROM e{t} GROUP BY c) n ON n.c = c{t}.c)""")
    return f"""WITH {','.join(parts)}
SELECT a.vec_id, CAST(a.c AS INT) AS cluster, a.d AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c{rounds}.m, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} ON c{rounds}.c = a.c
"""


ORACLE = oracle()
