"""Operator 12 [native], licence scan by a positional rare-token index; DataFrame functions only.

Templates are short word sequences: licence notices, and exact phrases. The index of a template holds its words with
their positions; how rare a word is comes from the documents themselves (document frequency over all of them, for the
few hundred words that templates use, so the table that reaches the driver has a size that does not grow).

A file is looked up in three steps, all within its row:
1. Of the templates, those whose mandatory key phrases' words all occur in the file are eligible.
2. For each, the ``rare`` licence words of highest IDF that the file has are looked up: each of their places in the
   file, less each of their positions in the template, is a relative position. Relative positions that at least
   ``votes`` places agree on remain: the intersection of the postings.
3. At these the key phrases have to stand word for word where the template has them, and the words that agree have to
   hold ``share`` of the template's IDF weight.

An exact phrase is a template that is all key phrase, so its places are found whole: its rarest word is looked up.
IDF weights are whole thousandths, so scores are the same on every engine.

Defined cases: null or empty text has no words, no label and a score of 0; a template may begin before the text or end
after it as long as its key phrases and share are there; of templates that carry one label the label comes once; rows
that repeat an id are scanned each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import crosscheck_columns, let, lower_ascii, table

#: Fixed value: what separates words, as a Java pattern.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    #: Phrases of the text that have to stand in the file; each is located at its first place in the text.
    key: tuple[str, ...]
    share: float = 0.75
    rare: int = 4
    votes: int = 2
    #: Counted as places of a phrase.
    base: bool = False


def phrase(label: str, text: str) -> Template:
    return Template(label, text, (text,), share=1.0, rare=1, votes=1, base=True)


# The phrases with their labels.
PHRASES = (phrase("mit", "under the mit license"), phrase("apache-2", "apache license version 2"),
           phrase("cc-by-nc", "cc by nc"))

# Opening words of public licences and of the notices they ask for.
NOTICES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
             "associated documentation files", ("permission is hereby granted", "free of charge")),
    Template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in "
             "compliance with the license", ("apache license", "you may not use this file")),
    Template("apache-2", "unless required by applicable law or agreed to in writing software distributed under the "
             "license is distributed on an as is basis without warranties or conditions of any kind",
             ("distributed on an as is basis", "conditions of any kind")),
    Template("gpl-3", "licensed under the gnu general public license version 3",
             ("gnu general public license", "version 3")),
    Template("gpl-2", "licensed under the gnu general public license version 2",
             ("gnu general public license", "version 2")),
    Template("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
             "general public license as published by the free software foundation either version 3 of the license",
             ("gnu general public license", "version 3")),
    Template("gpl-2", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
             "general public license as published by the free software foundation either version 2 of the license",
             ("gnu general public license", "version 2")),
    Template("lgpl", "under the terms of the gnu lesser general public license as published by the free software "
             "foundation", ("gnu lesser general public license",)),
    Template("agpl-3", "under the terms of the gnu affero general public license as published by the free software "
             "foundation", ("gnu affero general public license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
             "provided that the following conditions are met",
             ("redistribution and use in source and binary forms", "conditions are met")),
    Template("bsd-3", "neither the name of the copyright holder nor the names of its contributors may be used to endorse "
             "or promote products derived from this software", ("endorse or promote products",)),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0",
             ("mozilla public license",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
             "hereby granted", ("with or without fee", "hereby granted")),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             ("unencumbered software", "public domain")),
    Template("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license",
             ("creative commons attribution noncommercial",)),
    Template("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license",
             ("creative commons attribution sharealike",)),
    Template("cc-by-sa", "licensed under cc by sa", ("cc by sa",), votes=1),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license",
             ("creative commons attribution 4",)),
    Template("cc0", "cc0 1 0 universal public domain dedication", ("cc0", "public domain"), share=0.5),
)
TEMPLATES = PHRASES + NOTICES


def key_words(t: Template) -> list[tuple[int, str]]:
    """Position and word of everything in the template's key phrases."""
    words, out = t.text.split(), {}
    for k in t.key:
        run = k.split()
        at = next(i for i in range(len(words)) if words[i:i + len(run)] == run)
        out |= {at + j: w for j, w in enumerate(run)}
    return sorted(out.items())


def vocabulary(templates=TEMPLATES) -> list[str]:
    return sorted({w for t in templates for w in t.text.split()})


def file_words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), NO_WORD), "")


def text_list(words) -> Column:
    return F.array(*[F.lit(w) for w in words])


def idf(docs: DataFrame, templates=TEMPLATES) -> dict[str, int]:
    """IDF of the templates' words over all documents, in whole thousandths, 1 at least."""
    vocab = vocabulary(templates)
    seen = docs.select(F.explode(F.array_append(F.array_intersect(file_words(F.col("text")), text_list(vocab)),
                                                F.lit(""))).alias("word"))
    df = {r.word: r.n for r in seen.groupBy("word").agg(F.count("*").alias("n")).collect()}  # a row per template word
    n = df.pop("", 0)  # every document adds one
    return {w: weight(n, df.get(w, 0)) for w in vocab}


def weight(n: int, df: int) -> int:
    """IDF in thousandths of bits, 1 at least."""
    return 1 + round(1000 * math.log2((n + 1) / (df + 1)))


def index(templates, weights: dict[str, int]) -> Column:
    """The templates with their postings as one constant array."""
    def long(x: int) -> Column:
        return F.lit(x).cast("int")

    def one(i: int, t: Template) -> Column:
        words = t.text.split()
        ranked = sorted(set(words), key=lambda w: (-weights[w], w))
        at = [F.struct(long(p).alias("p"), F.lit(w).alias("w"), long(weights[w]).alias("g")) for p, w in enumerate(words)]
        key = [F.struct(long(p).alias("p"), F.lit(w).alias("w")) for p, w in key_words(t)]
        # the share as a least weight, so that the test is on integers
        least = math.ceil(t.share * sum(weights[w] for w in words))
        return F.struct(long(i).alias("id"), F.lit(t.label).alias("label"), F.lit(t.base).alias("base"),
                        long(t.rare).alias("rare"), long(t.votes).alias("votes"), long(least).alias("least"),
                        long(sum(weights[w] for w in words)).alias("whole"), text_list(ranked).alias("ranked"),
                        F.array(*at).alias("words"), F.array(*key).alias("key"),
                        text_list(sorted({w for _, w in key_words(t)})).alias("needed"))
    return F.array(*[one(i, t) for i, t in enumerate(templates)])


def places(t: Column, ws: Column, present: Column) -> Column:
    """Verified places of one eligible template: start, weight that agrees."""
    rare = F.slice(F.filter(t["ranked"], lambda w: F.array_contains(present, w)), F.lit(1), t["rare"])

    def looked_up(rare):
        hits = F.filter(F.sequence(F.lit(0), F.size(ws) - 1), lambda i: F.array_contains(rare, F.get(ws, i)))
        starts = F.sort_array(F.flatten(F.transform(hits, lambda i: F.transform(
            F.filter(t["words"], lambda x: x["w"] == F.get(ws, i)), lambda x: i - x["p"]))))
        return let(starts, lambda s: F.array_distinct(
            F.filter(s, lambda x, j: F.get(s, j + t["votes"] - 1) == x)))

    def agreed(o):
        return F.aggregate(t["words"], F.lit(0), lambda acc, x: acc + F.when(
            F.get(ws, o + x["p"]) == x["w"], x["g"]).otherwise(F.lit(0)))
    keyed = F.filter(let(rare, looked_up), lambda o: F.forall(
        t["key"], lambda x: F.coalesce(F.get(ws, o + x["p"]) == x["w"], F.lit(False))))
    weighed = F.transform(keyed, lambda o: F.struct(o.alias("start"), agreed(o).alias("weight")))
    return F.filter(weighed, lambda m: m["weight"] >= t["least"])


def matches(text: Column, templates, weights: dict[str, int]) -> Column:
    """struct of n_words and the verified places of all templates: label, base, start, score."""
    vocab = text_list(vocabulary(templates))
    held = index(templates, weights)

    def of(ws):
        def found(present):
            eligible = F.filter(held, lambda t: F.forall(t["needed"], lambda w: F.array_contains(present, w)))
            return F.flatten(F.transform(eligible, lambda t: F.transform(
                places(t, ws, present), lambda m: F.struct(
                    t["label"].alias("label"), t["base"].alias("base"), m["start"].alias("start"),
                    (m["weight"] / t["whole"]).alias("score")))))
        return F.struct(F.size(ws).cast("long").alias("n_words"),
                        let(F.array_intersect(ws, vocab), found).alias("found"))
    return let(file_words(text), of)


def license_matches(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """Every row with n_words and found: array of label, base, start (word, from 0), score."""
    crosscheck_columns(docs, "doc_id", "text")
    weights = idf(docs, templates)
    return docs.select("doc_id", matches(F.col("text"), templates, weights).alias("m")).select(
        "doc_id", "m.n_words", "m.found")


def license_scan(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """The digest of the matches: one row per document."""
    rows = license_matches(docs, templates)
    base = F.filter("found", lambda m: m["base"])

    def labels(found) -> Column:
        return F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(found, lambda m: m["label"]))))

    def starts(found) -> Column:
        return F.transform(found, lambda m: m["start"].cast("long"))
    return rows.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts(base)).alias("first_word"),
        F.array_max(starts(base)).alias("last_word"), labels(base).alias("base_labels"), labels("found").alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda m: m["score"])), F.lit(0.0)).alias("score"))


def query(spark, sf_dir):
    return license_scan(table(spark, sf_dir, "documents"))


def oracle(templates=TEMPLATES) -> str:
    """DuckDB SQL: the same index as joins over one row per word place."""
    def rows(values) -> str:
        return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in values)
    listed = rows((i, t.label, t.base, t.rare, t.votes, t.share) for i, t in enumerate(templates))
    posted = rows((i, p, w) for i, t in enumerate(templates) for p, w in enumerate(t.text.split()))
    keyed = rows((i, p, w) for i, t in enumerate(templates) for p, w in key_words(t))
    return f"""
WITH t(id, label, base, rare, votes, share) AS (VALUES {listed}),
tw(id, p, w) AS (VALUES {posted}),
tk(id, p, w) AS (VALUES {keyed}),
d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS ws FROM documents),
o AS MATERIALIZED (
  SELECT rid, i, w FROM (SELECT rid, unnest(ws) AS w, unnest(range(0, len(ws))) AS i FROM d) x
  WHERE w IN (SELECT w FROM tw)),
present AS (SELECT DISTINCT rid, w FROM o),
g AS MATERIALIZED (
  SELECT v.w, 1 + CAST(round(1000 * log2(((SELECT count(*) FROM d) + 1) / (coalesce(df, 0) + 1))) AS BIGINT) AS g
  FROM (SELECT DISTINCT w FROM tw) v LEFT JOIN (SELECT w, count(*) AS df FROM present GROUP BY w) c ON c.w = v.w),
whole AS (
  SELECT tw.id, sum(g) AS whole, ceil(any_value(t.share) * sum(g)) AS least
  FROM tw JOIN g ON g.w = tw.w JOIN t ON t.id = tw.id GROUP BY tw.id),
eligible AS (
  SELECT rid, n.id FROM (SELECT DISTINCT id, w FROM tk) n JOIN present ON present.w = n.w
  GROUP BY rid, n.id HAVING count(*) = (SELECT count(DISTINCT w) FROM tk WHERE tk.id = n.id)),
looked AS (
  SELECT rid, id, w FROM (
    SELECT e.rid, e.id, x.w, row_number() OVER (PARTITION BY e.rid, e.id ORDER BY g.g DESC, x.w) AS k
    FROM eligible e JOIN (SELECT DISTINCT id, w FROM tw) x ON x.id = e.id
    JOIN present ON present.rid = e.rid AND present.w = x.w JOIN g ON g.w = x.w) r
  JOIN t USING (id) WHERE k <= t.rare),
starts AS (
  SELECT l.rid, l.id, o.i - tw.p AS s FROM looked l JOIN o ON o.rid = l.rid AND o.w = l.w
  JOIN tw ON tw.id = l.id AND tw.w = l.w
  GROUP BY l.rid, l.id, o.i - tw.p HAVING count(*) >= (SELECT votes FROM t WHERE t.id = l.id)),
whole_key AS (
  SELECT s.rid, s.id, s.s FROM starts s JOIN tk ON tk.id = s.id JOIN o ON o.rid = s.rid AND o.i = s.s + tk.p AND o.w = tk.w
  GROUP BY s.rid, s.id, s.s HAVING count(*) = (SELECT count(*) FROM tk WHERE tk.id = s.id)),
found AS (
  SELECT k.rid, k.id, k.s, sum(g.g) AS weight FROM whole_key k JOIN tw ON tw.id = k.id
  JOIN o ON o.rid = k.rid AND o.i = k.s + tw.p AND o.w = tw.w JOIN g ON g.w = tw.w GROUP BY k.rid, k.id, k.s),
m AS (
  SELECT f.rid, t.label, t.base, f.s, CAST(f.weight AS DOUBLE) / CAST(whole.whole AS DOUBLE) AS score
  FROM found f JOIN whole ON whole.id = f.id JOIN t ON t.id = f.id WHERE f.weight >= whole.least),
r AS (
  SELECT rid, count(*) FILTER (WHERE base) AS n_base, min(s) FILTER (WHERE base) AS first_word,
         max(s) FILTER (WHERE base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score FROM m GROUP BY rid)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score
FROM d LEFT JOIN r ON r.rid = d.rid
"""


ORACLE = oracle()
