"""Helpers shared by the operators: reading tables, cutting lineage, words and stable splits."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.session import ensure_checkpoint_dir

#: The white space of the contracts, U+0020 and U+0009 to U+000D, as a Java pattern.
SPACE = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Rows in an Arrow batch handed to Python: with texts of 100 KB a batch stays near 25 MB.
ROWS_PER_BATCH = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch of whole texts can hold in a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))


class Scratch:
    """Stored intermediate tables of one computation, under the shared checkpoint folder.

    An object of its own for each computation, so two that run in one driver never touch each other's tables.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write df and read it back, which cuts its lineage. The files are removed when the driver ends, or by keep()."""
        path = f"{ensure_checkpoint_dir(self.spark)}/llm-{uuid.uuid4().hex}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path).getParent()
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).deleteOnExit(where)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep(self, newest: int) -> None:
        """Remove the stored tables but for the newest ones, when these hold all that is read from then on."""
        gone, self.paths = self.paths[:len(self.paths) - newest], self.paths[len(self.paths) - newest:]
        for path in gone:
            where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


#: Folders that stage() wrote and release() has not removed, in order.
_staged: list[str] = []


def release(spark: SparkSession, since: int, keep: int = 1) -> None:
    """Remove the staged folders made after the first ``since`` ones, but for the newest ``keep``.

    To be called when the newest ones hold all that is read from then on: the others are of no use, also not to
    compute a lost part again, because reading a staged table is where lineage ends.
    """
    gone = _staged[since:len(_staged) - keep]
    for path in gone:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    del _staged[since:len(_staged) - keep]


def staged_so_far() -> int:
    return len(_staged)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write df under the shared checkpoint folder and read it back, which cuts its lineage.

    The files are removed when the driver ends. Finished shuffles are released right away: their files would
    otherwise stay on the executors' disks until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    _staged.append(path)
    back = spark.read.schema(df.schema).parquet(path)
    del df  # else its shuffles count as in use
    gc.collect()
    spark._jvm.System.gc()
    return back


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def words(text: Column) -> Column:
    """The words of a text: maximal runs without white space; null gives none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def let(value: Column, body) -> Column:
    """body(value) with value computed once, also where body uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def shingle_hashes(ws: Column, n: int) -> Column:
    """64-bit hashes of all n-word shingles of a word array; fewer words form one shingle, no words none."""
    def of(w):
        size = F.size(w)
        runs = F.transform(F.sequence(F.lit(0), size - n), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(n)]))
        return (F.when(size >= n, runs).when(size == 0, F.array().cast("array<bigint>"))
                .otherwise(F.array(F.xxhash64(w))))
    return let(ws, of)


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo: the split of rows into learning and held-out ones."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus, F.lit(-1))


#: Words of 64 bits in a membership bitmap: 2^23 bits, so at most SLOTS rows of 12 bytes are broadcast at any size.
SLOTS = 1 << 17


def marked(rows: DataFrame, key: Column, keys: DataFrame, name: str = "maybe") -> DataFrame:
    """rows with a boolean column: false where key is surely not in the one column of keys, true where it may be.

    The keys become a bitmap of fixed size, so wide rows can be filtered in their scan without a shuffle, however many
    keys there are; with very many keys it only lets more rows through. An exact step has to follow.
    """
    def slot(x):
        return F.shiftright(x, 6).bitwiseAND(F.lit(SLOTS - 1)).cast("int")

    def bit(x):
        return F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(F.lit(63)).cast("int"))
    x = F.xxhash64(keys[keys.columns[0]])
    bits = keys.select(slot(x).alias("_slot"), bit(x).alias("_bits")).groupBy("_slot").agg(
        F.bit_or("_bits").alias("_bits"))
    y = F.xxhash64(key)
    out = rows.withColumn("_key_slot", slot(y)).withColumn("_key_bit", bit(y))
    out = out.join(F.broadcast(bits), F.col("_key_slot") == F.col("_slot"), "left")
    found = F.coalesce(F.col("_bits").bitwiseAND(F.col("_key_bit")) != 0, F.lit(False))
    return out.select(*rows.columns, found.alias(name))


#: Type of the two columns of a packed id, for the schemas of functions on pandas.
ID = "doc_id long, no_id boolean"


def packed_id(doc_id: Column) -> list[Column]:
    """A possibly null id as two columns without nulls: pandas would turn a column with a null into doubles."""
    return [F.coalesce(doc_id.cast("long"), F.lit(0).cast("long")).alias("doc_id"), doc_id.isNull().alias("no_id")]


def unpacked_id() -> Column:
    return F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id")


def crosscheck_columns(df: DataFrame, *names: str) -> None:
    """Fail early, with the column's name, where a needed column is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {missing}; there are {df.columns}")
