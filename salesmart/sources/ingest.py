"""Staging ingest: landed files of the source systems become the typed staging relations.

The extractors drop JSON-lines or CSV files into a landing folder, one folder per relation. A delivery may be damaged
(a truncated line, a letter in an amount, a missing key) and may come twice (the extractor retries a file it was not
sure about). ``ingest`` reads every delivered file once as text, parses each line by the relation's schema, and splits
the rows:

* **accepted** rows have all columns typed;
* **quarantine** rows keep the raw line, its file and the reason: ``malformed`` (not JSON / CSV of that width),
  ``bad type: <columns>`` (a present value that its type cannot hold), ``missing: <columns>`` (a required one is absent);
* the **ledger** has one row per delivered file: its content digest, its lines, accepted and quarantined counts, and
  ``status``: ``loaded``, or ``repeated`` for a file whose content was delivered before (under whatever name), whose rows
  count nowhere else.

A file's digest is made of its lines without bringing them together: the number of lines and the sums of two hashes of
each line, a grouped aggregate combined map-side, so a file of any size is no unit of work. Of files with one digest the
first by (delivery time, path) is loaded. Earlier deliveries are known from a ledger given by the caller, and
``IngestTable`` keeps one next to the accepted and quarantined rows: each delivery is a folder of its own, named by the
hash of what it delivers, so that a job that is run again writes the same folders again.

Lines are read whole whatever they hold; nothing is dropped silently: lines of loaded files = accepted + quarantined.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW, FILE = "raw_line", "delivered_file"
LEDGER_SCHEMA = ("delivered_file string, digest string, lines long, accepted long, quarantined long, status string, "
                 "delivered_at timestamp")


@dataclass(frozen=True)
class Landed:
    """How a relation is delivered: its columns, the ones that must be present, and the format of a line."""

    schema: T.StructType
    required: tuple[str, ...] = ()
    fmt: str = "json"
    #: CSV only: the separator, and whether each file starts with a line of column names.
    sep: str = ","
    header: bool = True

    def __post_init__(self):
        if self.fmt not in ("json", "csv"):
            raise ValueError(f"files of format {self.fmt!r} cannot be read; json and csv can")
        missing = set(self.required) - set(self.schema.names)
        if missing:
            raise ValueError(f"required columns that the schema lacks: {sorted(missing)}")


@dataclass(frozen=True)
class Ingested:
    accepted: DataFrame
    quarantine: DataFrame
    ledger: DataFrame
    #: One row per file with its digest and status, without the counts that need the lines parsed.
    files: DataFrame


def landed_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line of the files below path, with its file and the file's time of delivery; blank lines are none."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    return lines.select(F.col("value").alias(RAW), F.col("_metadata.file_path").alias(FILE),
                        F.col("_metadata.file_modification_time").alias("delivered_at")).where(F.trim(RAW) != "")


def file_digests(lines: DataFrame) -> DataFrame:
    """One row per file: lines, digest of its content (whatever the order of its lines), delivered_at."""
    x, y = F.xxhash64(RAW), F.xxhash64(F.lit(7), RAW)
    # halves are summed apart, so that sums of many hashes stay within a long
    halves = [F.sum(part).alias(name) for name, part in (
        ("s0", F.shiftright(x, 32)), ("s1", x.bitwiseAND(F.lit(0xFFFFFFFF))),
        ("s2", F.shiftright(y, 32)), ("s3", y.bitwiseAND(F.lit(0xFFFFFFFF))))]
    sums = lines.groupBy(FILE).agg(F.max("delivered_at").alias("delivered_at"), F.count("*").alias("lines"), *halves)
    digest = F.sha2(F.concat_ws(":", "lines", "s0", "s1", "s2", "s3"), 256)
    return sums.select(FILE, "delivered_at", "lines", digest.alias("digest"))


def _texts(landed: Landed) -> T.StructType:
    """The schema with every column as text: what is there, before it is typed."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in landed.schema])


def _parsed(landed: Landed) -> Column:
    """A struct of texts, null where the line is no JSON object / no CSV line of this width."""
    texts = _texts(landed)
    if landed.fmt == "json":
        # FAILFAST would stop the job: a corrupt-record column marks the line instead
        wide = T.StructType([*texts.fields, T.StructField("_corrupt", T.StringType())])
        got = F.from_json(RAW, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
        whole = got.isNotNull() & got["_corrupt"].isNull() & F.trim(RAW).startswith("{")
    else:
        wide = T.StructType([*texts.fields, T.StructField("_corrupt", T.StringType())])
        got = F.from_csv(RAW, ", ".join(f"`{f.name}` STRING" for f in wide),
                         {"sep": landed.sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
        whole = got.isNotNull() & got["_corrupt"].isNull()
    return F.when(whole, F.struct(*[got[n].alias(n) for n in texts.names]))


def _exact(landed: Landed) -> Column:
    """A struct of the decimal columns, read as decimals from the JSON line: as texts they would pass through doubles."""
    wide = T.StructType([T.StructField(f.name, T.DecimalType(38, 18)) for f in landed.schema
                         if isinstance(f.dataType, T.DecimalType)])
    return F.from_json(RAW, wide) if landed.fmt == "json" and wide.fields else None


def _typed(text: Column, kind: T.DataType, exact: Column | None = None) -> Column:
    """The value of a text, null where the type cannot hold it. Whole numbers take no fraction, decimals no further digit.

    ``exact`` is a decimal's value as read from JSON; where there is one it stands for the text.
    """
    value = F.trim(text)
    if exact is not None:
        small = exact.try_cast(kind)
        return F.coalesce(F.when(small == exact, small), F.when(exact.isNull(), _typed(text, kind)))
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, (T.LongType, T.IntegerType, T.ShortType)):
        return F.when(value.rlike(r"^[+-]?[0-9]+$"), value.try_cast(kind))
    if isinstance(kind, T.DecimalType):
        digits = rf"^[+-]?[0-9]+(\.[0-9]{{1,{max(kind.scale, 1)}}})?$"
        return F.when(value.rlike(digits), value.try_cast(kind))
    if isinstance(kind, T.DateType):
        return F.when(value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), value.try_cast(kind))
    if isinstance(kind, T.BooleanType):
        return F.when(F.lower(value).isin("true", "false"), F.lower(value) == "true")
    return value.try_cast(kind)


def checked(lines: DataFrame, landed: Landed) -> DataFrame:
    """lines with the typed columns as struct ``row`` and ``reason`` (null where the line is accepted)."""
    held = lines.withColumn("texts", _parsed(landed))
    exact = _exact(landed)
    if exact is not None:
        held = held.withColumn("exact", exact)
    typed = {f.name: _typed(F.col("texts")[f.name], f.dataType, F.col("exact")[f.name] if exact is not None and isinstance(
        f.dataType, T.DecimalType) else None) for f in landed.schema}
    held = held.withColumn("row", F.struct(*[v.alias(n) for n, v in typed.items()]))
    names = list(typed)
    wrong = F.array_compact(F.array(*[F.when(F.col("texts")[n].isNotNull() & F.col("row")[n].isNull(), F.lit(n)) for n in names]))
    absent = F.array_compact(F.array(F.lit(None).cast("string"), *[
        F.when(F.col("texts")[n].isNull(), F.lit(n)) for n in landed.required]))
    reason = (F.when(F.col("texts").isNull(), F.lit("malformed"))
              .when(F.size(wrong) > 0, F.concat(F.lit("bad type: "), F.array_join(wrong, ", ")))
              .when(F.size(absent) > 0, F.concat(F.lit("missing: "), F.array_join(absent, ", "))))
    # a generator of one row: a test of the reason stays above it, where it would otherwise be pushed below the parsed
    # columns and parse the line anew for each of their uses
    outcome = F.inline(F.array(F.struct(F.col("row"), reason.alias("reason"))))
    return held.select(*lines.columns, outcome)


def without_headers(lines: DataFrame, landed: Landed) -> DataFrame:
    """CSV lines but for the lines of column names. A header is told by its text: files are split, so no task has all."""
    if landed.fmt != "csv" or not landed.header:
        return lines
    return lines.where(F.trim(RAW) != landed.sep.join(landed.schema.names))


def _counts(rows: DataFrame) -> DataFrame:
    """One row per file: its accepted and quarantined lines."""
    return rows.groupBy(FILE).agg(F.count(F.when(F.col("reason").isNull(), 1)).alias("accepted"),
                                  F.count("reason").alias("quarantined"))


def _ledger(files: DataFrame, counts: DataFrame) -> DataFrame:
    return files.join(counts, FILE, "left").select(
        FILE, "digest", "lines", F.coalesce("accepted", F.lit(0)).cast("long").alias("accepted"),
        F.coalesce("quarantined", F.lit(0)).cast("long").alias("quarantined"), "status", "delivered_at")


def ingest(spark: SparkSession, path: str, landed: Landed, known: DataFrame | None = None,
           files: DataFrame | None = None) -> Ingested:
    """The accepted rows, the quarantine and the ledger of all files below path.

    known: the ledger of earlier deliveries; a file whose digest it has as loaded, under any name, is repeated, unless it
    is that very file (so an ingest that is run again over one folder gives the same). files: the files' digests, where
    they are known already.
    """
    lines = without_headers(landed_lines(spark, path), landed)
    files = file_digests(lines) if files is None else files
    # one row per file from here on; the first of equal files is a minimum, not a sorted group
    first = files.groupBy("digest").agg(F.min(F.struct("delivered_at", FILE)).alias("first"))
    if known is not None:
        before = known.where("status = 'loaded'").groupBy("digest").agg(
            F.min(F.struct("delivered_at", FILE)).alias("before"))
        first = first.join(before, "digest", "left").withColumn("first", F.coalesce("before", "first")).drop("before")
    files = files.join(first, "digest").withColumn(
        "status", F.when(F.col(FILE) == F.col(f"first.{FILE}"), "loaded").otherwise("repeated"))
    loaded = files.where("status = 'loaded'").select(FILE)
    rows = checked(lines.join(loaded, FILE, "left_semi"), landed)
    return Ingested(rows.where("reason IS NULL").select("row.*"),
                    rows.where("reason IS NOT NULL").select(FILE, RAW, "reason"), _ledger(files, _counts(rows)), files)


def _stored(rows: DataFrame, folder: str) -> DataFrame:
    """rows written to a folder and read back: what is made of them does not make them again."""
    rows.write.mode("overwrite").parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


@dataclass
class IngestTable:
    """The stored outcome of all deliveries of one relation: accepted, quarantine and ledger, one folder per delivery."""

    root: str
    landed: Landed
    parts: tuple[str, ...] = field(default=("accepted", "quarantine", "ledger"), init=False)

    def _read(self, spark: SparkSession, part: str, schema: T.StructType) -> DataFrame:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{part}")
        if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{self.root}/{part}")

    def rows(self, spark: SparkSession) -> DataFrame:
        """The staging relation: all accepted rows."""
        return self._read(spark, "accepted", self.landed.schema)

    def quarantine(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "quarantine", T.StructType.fromDDL(f"{FILE} string, {RAW} string, reason string"))

    def ledger(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "ledger", T.StructType.fromDDL(LEDGER_SCHEMA))

    def deliver(self, spark: SparkSession, path: str) -> dict[str, int]:
        """Ingest the files below path that no earlier delivery loaded; returns files and rows by outcome.

        The delivery's folder is named by its files' paths and digests. The ledger is written last: a delivery that was
        cut off is written again over its own folders, one that is in the ledger changes nothing.
        """
        known = self.ledger(spark)
        done = known.select(FILE, "digest")
        pending = f"{self.root}/_pending/{uuid.uuid4().hex}"
        try:
            return self._deliver(spark, path, pending, known, done)
        finally:
            folder = spark._jvm.org.apache.hadoop.fs.Path(pending)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

    def _deliver(self, spark: SparkSession, path: str, pending: str, known: DataFrame, done: DataFrame) -> dict[str, int]:
        """The lines are read twice: once for the digests, once to be parsed. Both outcomes are stored under pending."""
        files = _stored(file_digests(without_headers(landed_lines(spark, path), self.landed)), f"{pending}/files")
        fresh = files.join(done, [FILE, "digest"], "left_anti")
        named = fresh.agg(F.count("*").alias("n"), F.sum(F.xxhash64(FILE, "digest").cast("decimal(38,0)")).alias("h")).first()
        if not named.n:
            return {"files": 0, "repeated": 0, "accepted": 0, "quarantined": 0}
        name = f"delivery={named.n}-{int(named.h) % (1 << 64):016x}"
        got = ingest(spark, path, self.landed, known, files)
        new = _stored(got.files.select(*files.columns, "status").join(done, [FILE, "digest"], "left_anti"), f"{pending}/new")
        loaded = new.where("status = 'loaded'").select(FILE)
        lines = without_headers(landed_lines(spark, path), self.landed).join(loaded, FILE, "left_semi")
        kept = F.when(F.col("reason").isNotNull(), F.col(RAW)).alias(RAW)   # an accepted line is in its row
        rows = _stored(checked(lines, self.landed).select(FILE, kept, "reason", "row"), f"{pending}/rows")
        rows.where("reason IS NULL").select("row.*").write.mode("overwrite").parquet(f"{self.root}/accepted/{name}")
        rows.where("reason IS NOT NULL").select(FILE, RAW, "reason").write.mode("overwrite").parquet(
            f"{self.root}/quarantine/{name}")
        new = _stored(_ledger(new, _counts(rows)), f"{self.root}/ledger/{name}")
        out = new.agg(F.count("*").alias("files"), F.count(F.when(F.col("status") == "repeated", 1)).alias("repeated"),
                      F.sum("accepted").alias("accepted"), F.sum("quarantined").alias("quarantined")).first()
        return out.asDict()
