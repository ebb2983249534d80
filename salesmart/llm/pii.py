"""Operator 4 [native], PII: patterns, and information-theoretic sanitisation of the terms that go with what they find.

Patterns find e-mail addresses, IP numbers, card numbers and phone numbers. A found value is a protected entity e; all
terms of the documents that mention it are candidates t. Over the whole corpus, with documents as trials, p(e | t) is
the share of the documents with t that mention e, and t's disclosure is PMI(e; t) / IC(e) = 1 + log p(e | t) / -log p(e):
1 when t occurs with e alone, 0 when it is independent of e. Terms that go with e in at least SUPPORT documents of
different contexts of e (copies of the CONTEXT code points around it count once) are removed at a disclosure of REMOVE
or more, and generalised to their kind at GENERALISE or more, at all their places in all documents.

All steps are DataFrame functions: matches are exploded with the lengths between them, and a window per document sums
these to code-point places. Patterns are written so that the regex engine neither recurses per repetition nor starts
anew inside a run, which very long runs of digits or letters need.

Defined cases: null text counts as empty and has no spans; documents without matches have zero counts; rows that repeat
an id and a text share their spans; null ids are kept apart by their texts; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import crosscheck_columns, let, marked, stage, table

#: The kinds in their order, and their patterns (possessive repeats match what greedy ones match here,
#: since nothing follows them that they could give back; a run's inside is no start unless a match has just ended).
KINDS = ("email", "ip", "card", "phone", "term")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a kind's pattern to be tried.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
CONTEXT = 120
SUPPORT = 2
GENERALISE, REMOVE = 0.9, 0.97
TERM = r"[\p{L}\p{N}]+"
NOT_TERM = r"[^\p{L}\p{N}]+"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check; every second digit from the right counts double."""
    def of(ds):
        weights = F.transform(ds, lambda d, i: F.when((F.size(ds) - 1 - i) % 2 == 0, d.cast("int"))
                              .otherwise(F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)))
        return F.aggregate(weights, F.lit(0), lambda a, x: a + x) % 10 == 0
    return let(F.array_remove(F.split(digits, ""), ""), of)


def _valid(kind: Column, value: Column) -> Column:
    part = F.regexp_replace(value, r"(?<![0-9])0+(?=[0-9])", "")
    ip = F.forall(F.split(part, r"\."), lambda p: (F.char_length(p) <= 3) & (F.lpad(p, 3, "0") <= F.lit("255")))
    n = F.char_length(_digits(value))
    return (F.when(kind == "email", F.lit(True)).when(kind == "ip", ip)
            .when(kind == "card", n.between(13, 19) & _luhn(_digits(value)))
            .when(kind == "phone", n.between(9, 15)).otherwise(F.lit(False)))


def _key(docs: DataFrame) -> DataFrame:
    """(id, th, text): a document is its id and text."""
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    return docs.select(F.col("doc_id").alias("id"), text).select("id", F.xxhash64("text").alias("th"), "text")


def mentions(docs: DataFrame) -> DataFrame:
    """(id, th, kind, value, start, end, before, after): the valid base matches and the text around them."""
    rows = _key(docs).where(F.contains("text", F.lit("@")) | F.col("text").rlike("[0-9]"))
    found = None
    for kind, pattern in PATTERNS.items():
        part = rows.where(F.contains("text", F.lit(NEEDS[kind]))) if kind in NEEDS else rows
        gaps, values = F.split("text", pattern, -1), F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        part = part.select("id", "th", gaps.alias("gaps"), values.alias("values")).where("size(values) > 0")
        # one row per match: the lengths of the gap before it and of itself, the last and first of the gaps around it
        part = part.select("id", "th", F.lit(kind).alias("kind"), F.posexplode(F.transform("values", lambda v, i: F.struct(
            v.alias("value"), F.char_length(F.get("gaps", i)).alias("gap"), F.char_length(v).alias("len"),
            F.right(F.get("gaps", i), F.lit(CONTEXT + 1)).alias("before"),
            F.left(F.get("gaps", i + 1), F.lit(CONTEXT + 1)).alias("after")))).alias("i", "m"))
        found = part if found is None else found.unionByName(part)
    found = found.select("id", "th", "kind", "i", "m.*").dropDuplicates(["id", "th", "kind", "i"])
    upto = Window.partitionBy("id", "th", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    found = found.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(upto))
    found = found.withColumn("start", F.col("end") - F.col("len"))
    return found.where(_valid(F.col("kind"), F.col("value"))).select(
        "id", "th", "kind", "value", "start", "end", "before", "after")


def _terms(text: Column) -> Column:
    """The distinct terms of a text, in lower case."""
    runs = F.array_distinct(F.array_remove(F.split(text, NOT_TERM), ""))
    return F.array_distinct(F.transform(runs, F.lower))


def corpus_terms(docs: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that hold each of the wanted terms (term, n), and all rows (one row: total)."""
    total = docs.agg(F.count("*").alias("total"))
    rows = _key(docs).select(F.explode(_terms(F.col("text"))).alias("term"))
    every = marked(rows, F.col("term"), wanted).where("maybe")
    return every.groupBy("term").agg(F.count("*").alias("n")).join(wanted, "term"), total


def disclosing_terms(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Decisions: kind, value, term, disclosure, action."""
    seen = found.groupBy("th", "kind", "value").agg(F.min(F.xxhash64("before", "after")).alias("ctx"))
    seen = stage(seen, "seen")
    # rows of a text are so many trials
    copies = marked(_key(docs).select("th"), F.col("th"), seen.select("th")).where("maybe").groupBy("th").agg(
        F.count("*").alias("w"))
    seen = stage(seen.join(copies, "th"), "weighed")
    entities = seen.groupBy("kind", "value", "ctx").agg(F.sum("w").alias("w")).groupBy("kind", "value").agg(
        F.sum("w").alias("places"), F.count("*").alias("contexts"))
    entities = entities.where(F.col("contexts") >= SUPPORT).drop("contexts").crossJoin(F.broadcast(
        docs.agg(F.count("*").alias("total"))))  # one row
    # a term of more rows than this cannot reach the disclosure, since at most all of e's rows hold it
    log_e = F.log2(F.col("places") / F.col("total"))
    entities = entities.where("places < total").withColumn("most", F.log2("places") - (1 - GENERALISE) * log_e + 1e-6)
    seen = stage(seen.join(entities.drop("total"), ["kind", "value"]), "entities")
    held = marked(_key(docs), F.col("th"), seen.select("th")).where("maybe")
    held = held.select("th", F.explode(_terms(F.col("text"))).alias("term")).where(F.char_length("term") >= 3)
    held = stage(held.distinct(), "held")
    wanted = held.groupBy("term").agg(F.count("*").alias("texts")).where(F.col("texts") >= SUPPORT).select("term")
    places, total = corpus_terms(docs, stage(wanted, "wanted"))
    limit = seen.agg(F.max("most").alias("limit"))
    places = places.crossJoin(F.broadcast(limit)).where(F.log2("n") <= F.col("limit")).select("term", "n")  # one row
    pairs = seen.join(held.join(stage(places, "places"), "term"), "th").where(F.log2("n") <= F.col("most"))
    pairs = pairs.groupBy("kind", "value", "term", "ctx").agg(F.sum("w").alias("joint"), F.max("places").alias("places"),
                                                              F.max("n").alias("n"))
    pairs = pairs.groupBy("kind", "value", "term").agg(
        F.sum("joint").alias("joint"), F.count("*").alias("contexts"), F.max("places").alias("places"), F.max("n").alias("n"))
    out = pairs.where(F.col("contexts") >= SUPPORT).crossJoin(F.broadcast(total))  # one row
    out = out.withColumn("disclosure", F.round(1 + F.log2(F.col("joint") / F.col("n")) / -log_e, 9))
    action = F.when(F.col("disclosure") >= REMOVE, F.lit("remove")).otherwise(F.lit("generalise"))
    return out.where(F.col("disclosure") >= GENERALISE).select("kind", "value", "term", "disclosure", action.alias("action"))


def term_places(docs: DataFrame, found: DataFrame, decided: DataFrame) -> DataFrame:
    """(id, th, start, end, action): all places of the decided terms in all texts, but those in found values."""
    terms = stage(decided.groupBy("term").agg(F.max("action").alias("action")), "terms")
    rows = _key(docs)
    holds = marked(rows.select("th", F.explode(_terms(F.col("text"))).alias("term")), F.col("term"), terms.select("term"))
    holds = stage(holds.where("maybe").join(terms, "term", "left_semi").select("th").distinct(), "holds")
    rows = marked(rows, F.col("th"), holds).where("maybe")
    gaps, values = F.split("text", TERM, -1), F.regexp_extract_all("text", F.lit(TERM), F.lit(0))
    rows = rows.select("id", "th", gaps.alias("gaps"), values.alias("values"))
    each = rows.select("id", "th", F.posexplode(F.transform("values", lambda v, i: F.struct(
        F.lower(v).alias("term"), F.char_length(F.get("gaps", i)).alias("gap"), F.char_length(v).alias("len")))).alias("i", "t"))
    each = each.select("id", "th", "i", "t.*").dropDuplicates(["id", "th", "i"])
    upto = Window.partitionBy("id", "th").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    each = each.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(upto))
    each = each.withColumn("start", F.col("end") - F.col("len")).join(terms, "term")
    taken = found.groupBy("id", "th").agg(F.collect_list(F.struct("start", "end")).alias("taken"))
    taken = taken.select(F.col("id").alias("id1"), F.col("th").alias("th1"), "taken")
    each = each.join(taken, F.col("id").eqNullSafe(F.col("id1")) & (F.col("th") == F.col("th1")), "left")
    inside = F.exists("taken", lambda m: (F.col("start") < m["end"]) & (m["start"] < F.col("end")))
    return each.where(F.col("taken").isNull() | ~inside).select("id", "th", "start", "end", "action")


def find_spans(docs: DataFrame) -> DataFrame:
    """One row per document with spans: id, th, spans (sorted array of kind order, start, end, kind, action)."""
    crosscheck_columns(docs, "doc_id", "text")
    found = stage(mentions(docs), "mentions")
    order = F.expr("CASE kind " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(KINDS)) + " END")
    base = found.select("id", "th", order.alias("o"), "start", "end", "kind", F.lit("mask").alias("action"))
    terms = term_places(docs, found, disclosing_terms(docs, found))
    terms = terms.select("id", "th", F.lit(4).alias("o"), "start", "end", F.lit("term").alias("kind"), "action")
    spans = base.unionByName(terms)
    return spans.groupBy("id", "th").agg(F.array_sort(F.collect_list(F.struct("o", "start", "end", "kind", "action"))).alias("spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def sanitised(docs: DataFrame) -> DataFrame:
    """(row: all columns of docs, clean_text): values masked by their kind, terms removed or generalised."""
    found = stage(find_spans(docs), "spans")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id0"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("th0"))
    rows = marked(rows, F.xxhash64("id0", "th0"), found.select(F.xxhash64("id", "th").alias("k")))
    met = rows.where("maybe").join(found, F.col("id0").eqNullSafe(F.col("id")) & (F.col("th0") == F.col("th")), "left")
    by_place = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("s"), (-s["end"]).alias("e"), s["kind"].alias("k"),
                                                                    s["action"].alias("a"))))
    empty = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def add(acc, s):
        word = F.when(s["k"] != "term", F.concat(F.lit("["), F.upper(s["k"]), F.lit("]"))).when(
            s["a"] == "remove", F.lit("")).otherwise(F.lit("[TERM]"))
        piece = F.substring("row.text", (acc["at"] + 1).cast("int"), (s["s"] - acc["at"]).cast("int"))
        return F.when(s["s"] < acc["at"], acc).otherwise(F.struct(
            (-s["e"]).alias("at"), F.concat(acc["out"], F.array(piece, word)).alias("out")))
    done = F.aggregate(by_place, empty, add)
    clean = let(done, lambda d: F.concat(F.array_join(d["out"], ""), F.substring("row.text", (d["at"] + 1).cast("int"), F.lit(1 << 30))))
    changed = met.select("row", F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(clean).alias("clean_text"))
    return changed.unionByName(rows.where("NOT maybe").select("row", F.col("row.text").alias("clean_text")))


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = stage(find_spans(docs), "spans").withColumnsRenamed({"id": "id1", "th": "th1"})
    rows = _key(docs).select("id", "th")
    out = rows.join(found, F.col("id").eqNullSafe(F.col("id1")) & (F.col("th") == F.col("th1")), "left")
    spans = F.coalesce("spans", F.array().cast(found.schema["spans"].dataType))
    counts = [_count(spans, k).alias(f"n_{k}") for k in KINDS]
    base = F.filter(spans, lambda s: s["kind"] != "term")
    return out.select(F.col("id").alias("doc_id"), *counts, F.sha2(_joined(base), 256).alias("base_sha256"),
                      _joined(spans).alias("spans"))


ORACLE = None
