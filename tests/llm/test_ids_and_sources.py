"""Ids that doubles cannot hold next to null ids, ids that stand for several texts, and sources of any form."""

import duckdb
import pytest

import corpus_pipeline
from salesmart.llm import best_fit_packing, jaccard_join, language_crf, lattice_lm, mixing

BIG = 1 << 60
TEXT = "the quick brown fox jumps over the lazy dog while seven old friends watch from a hill near the river"


@pytest.fixture(scope="module")
def big(spark):
    rows = [(BIG + i, f"{TEXT} {i}", "en", "src1", 100) for i in range(1, 4)] + [(None, TEXT, "en", "src2", 100)] * 2
    rows += [(-BIG - 5, "der schnelle braune Fuchs springt", "de", "src1", 30), (BIG + 9, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)


def ids(rows):
    return sorted((r.doc_id for r in rows), key=str)


def test_packing_keeps_ids(big):
    got = best_fit_packing.best_fit_pack(big).collect()
    assert ids(got) == ids(big.collect())
    assert {r.doc_id: r.n_tokens for r in got if r.doc_id and r.doc_id > 0} == {
        BIG + 1: 21, BIG + 2: 21, BIG + 3: 21, BIG + 9: 0}


def test_language_keeps_ids(big):
    got = language_crf.identify(big, language_crf.train(big)).collect()
    assert ids(got) == ids(big.collect())
    assert {r.doc_id for r in got if r.lang_pred == "und"} == {BIG + 9}


def test_lm_scores_keep_ids(big):
    got = lattice_lm.lm_scores(big, rounds=1).collect()
    assert ids(got) == ids(big.collect())
    assert {r.doc_id: r.n_tokens for r in got}[BIG + 2] == 22


def test_jaccard_join_and_mixing_keep_ids(big):
    assert ids(jaccard_join.jaccard_components(big).collect()) == ids(big.collect())
    assert ids(mixing.mix(big).select("row.doc_id").collect()) == ids(big.collect())


def test_an_id_with_two_texts_of_one_size_keeps_both_links(spark):
    a, b = [" ".join(f"{x}{i}" for i in range(60)) for x in "ab"]
    rows = [(5, a), (5, b), (9, b + " end"), (11, a + " end"), (12, "else " * 3)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "doc_id long, text string")
        got = {(r.doc_id, r.component_id) for r in jaccard_join.jaccard_components(df).collect()}
        assert got == {(5, 5), (9, 5), (11, 5), (12, 12)}


SOURCES = ["web", "src", "src7", "src-1", "SRC2", "", None, "src12345678901234", "src٣", "src1.5", "src 4", "srcweb", "src0"]


def test_mixing_of_sources_of_any_form_matches_sql(spark, tmp_path):
    rows = [(i, "w " * (i % 7 + 1), ["en", "de", None][i % 3], SOURCES[i % len(SOURCES)], 9) for i in range(260)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = mixing.query(spark, str(tmp_path))
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    rel = con.sql(mixing.ORACLE)
    cols = sorted(rel.columns)
    want = sorted(rel.project(", ".join(cols)).fetchall(), key=repr)
    assert sorted((tuple(r) for r in got.select(*cols).collect()), key=repr) == want
    assert {r.domain for r in got.collect()} == {"(none)", "domain0", "domain3"}


def test_pipeline_with_sources_of_any_form_and_big_ids(spark, tmp_path):
    """Every stage keeps ids whole; budgets hold and every token of the mix is packed once."""
    def words(i):
        return " ".join(f"{'x' if i % 4 == 3 else 'w'}{(i * 31 + j * 7) % 401}" for j in range(40 + i % 9))
    rows = [(BIG + i, words(i), "en", SOURCES[i % len(SOURCES)], 9) for i in range(400)]
    labels = [(BIG + i, int(i % 4 != 3), 0) for i in range(400)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        path = f"{tmp_path}/{name.replace(' ', '-')}"
        out.write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        assert {r.doc_id for r in docs.select("doc_id").collect()} <= {r.doc_id for r in before.select("doc_id").collect()}
    held = docs.collect()
    assert held
    # the mix stage's input is what its budgets are made of
    mixed = mixing.mix(before).collect()
    for leaf in {(r.domain, r.lang, r.source) for r in mixed}:
        own = [r for r in mixed if (r.domain, r.lang, r.source) == leaf]
        assert sum(r.tokens * r.copies for r in own) <= own[0].budget
    assert len(held) == sum(r.copies for r in mixed)
    packed = corpus_pipeline.pack(spark, docs, str(tmp_path)).collect()
    assert sum(r.n_tokens for r in packed) == sum(len(r.text.split()) for r in held)
    assert ids(packed) == ids(held)
