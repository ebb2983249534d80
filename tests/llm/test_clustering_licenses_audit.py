"""Operators 11 to 13 against plain Python over small tables."""

import hashlib
import itertools
import math
import re

import numpy as np
import pytest

from salesmart.llm import filter_audit, license_scan, ns_kmeans
from salesmart.llm.common import Scratch

VECTORS = "vec_id long, embedding array<float>, label int, own string, v string, was string"


def lloyd(rows, k, rounds, scale, seed):
    """Plain rounds over all distances: (vec_id, cluster, distance) sorted, centroids."""
    vs = [(i, [math.floor(scale * float(x)) for x in e]) for i, e in rows]
    first = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in vs if i is not None)[:k]
    cs = [list(v) for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cs))
    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in vs]
        for j in range(len(cs)):
            mine = [v for (_, v), o in zip(vs, own) if o == j]
            if mine:
                cs[j] = [sum(col) // len(mine) for col in zip(*mine)]
    return sorted((str(i), *reversed(nearest(v))) for i, v in vs), cs


def vectors(seed=3, n=300, dim=6):
    g = np.random.default_rng(seed)
    centers = g.normal(0, 1, (8, dim))
    out = [(int(i) + (1 << 60), [float(np.float32(x)) for x in centers[i % 8] + g.normal(0, 0.3, dim)]) for i in range(n)]
    out += [out[5], (None, out[7][1]), (7, [0.0] * dim), (8, [0.0] * dim), (9, [-1e4] * dim)]
    return out


def test_clustering_equals_plain_rounds(spark):
    rows = vectors()
    bad = [(1, None), (2, [1.0]), (3, [None] * 6), (4, [float("nan")] * 6), (5, [float("inf")] + [0.0] * 5)]
    df = spark.createDataFrame([(i, e, 1, "x", "x", "x") for i, e in rows + bad], VECTORS).repartition(3)
    got = ns_kmeans.clustering(df, k=12, rounds=5, dim=6)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    got = got.collect()
    want, cs = lloyd(rows, 12, 5, 256, 2)
    assert sorted((str(r.vec_id), r.cluster, r.distance) for r in got) == want
    by = {j: sum(d for _, c, d in want if c == j) for j in range(12)}
    for r in got:
        assert (r.cluster_inertia, r.inertia) == (by[r.cluster], sum(by.values()))
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, cs[r.cluster])).encode()).hexdigest()


def test_clustering_small_tables(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert ns_kmeans.clustering(empty, dim=6).collect() == []
    three = spark.createDataFrame([(i, [float(i)] * 6, 0, "", "", "") for i in range(3)], VECTORS)
    assert [r.distance for r in ns_kmeans.clustering(three, k=12, dim=6).collect()] == [0, 0, 0]
    one = ns_kmeans.clustering(three, k=1, dim=6, rounds=2).collect()
    assert {r.cluster for r in one} == {0} and one[0].inertia == 2 * 6 * 256 ** 2
    huge = spark.createDataFrame([(1, [3e38] * 6, 0, "", "", ""), (2, [-3e38] * 6, 0, "", "", "")], VECTORS)
    got = ns_kmeans.clustering(huge, k=1, dim=6, rounds=1).collect()
    assert sum(r.distance for r in got) == got[0].inertia == 2 * 6 * ns_kmeans.LIMIT ** 2


def test_bounds_use_the_total_displacement_and_save_scans(spark):
    """A centroid that goes away and comes back has not moved: its history says so, its summed drifts would not."""
    there, back = np.array([[0, 0], [100, 0]]), np.array([[50, 0], [100, 0]])
    history = ns_kmeans.History([there, back, there])
    assert history.moved()[0] == pytest.approx([0, 0]) and history.moved()[1] == pytest.approx([50, 0])
    x = np.array([[10, 0], [49, 3], [-7, 1]])
    state = ns_kmeans.State(np.full(3, -1), *[np.zeros(3, dtype=d) for d in (float, int, float, int)])
    first, scan = ns_kmeans.assigned(x, state, ns_kmeans.History([there]), ns_kmeans.History([there]).moved())
    assert len(scan) == 3
    _, scan = ns_kmeans.assigned(x, first, history, history.moved())
    assert len(scan) == 0
    g = np.random.default_rng(0)
    x = np.concatenate([g.normal(0, 20, (200, 4)) + c for c in g.normal(0, 400, (10, 4))]).astype(np.int64)
    df = spark.createDataFrame([(i, [float(a) / 256 for a in v], 0, "", "", "") for i, v in enumerate(x)], VECTORS)
    state, history, _ = ns_kmeans.cluster(df, k=10, dim=4)
    assert len(history.rounds) == 6
    assert state.where("scanned").count() < 0.2 * len(x), "most vectors keep their cluster by their bounds"


def tokens(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(
        c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]


def scanned(texts):
    """Brute force: every template at every relative position that its rare words agree on."""
    files = [tokens(t) for t in texts]
    weights = {w: license_scan.weight(len(files), sum(w in f for f in files)) for w in license_scan.vocabulary()}
    out = []
    for f in files:
        found, have = [], set(f)
        for t in license_scan.TEMPLATES:
            ws, key = t.text.split(), license_scan.key_words(t)
            if not {w for _, w in key} <= have:
                continue
            rare = sorted((w for w in set(ws) if w in have), key=lambda w: (-weights[w], w))[:t.rare]
            for o in range(-len(ws), len(f)):
                at = {p for p in range(len(ws)) if 0 <= o + p < len(f) and f[o + p] == ws[p]}
                held, whole = sum(weights[ws[p]] for p in at), sum(weights[w] for w in ws)
                if (sum(ws[p] in rare for p in at) >= t.votes and all(p in at for p, _ in key)
                        and held >= math.ceil(t.share * whole)):
                    found.append((t.label, t.base, o, held / whole))
        base = [m for m in found if m[1]]
        out.append((len(f), len(base), min((m[2] for m in base), default=None), max((m[2] for m in base), default=None),
                    ",".join(sorted({m[0] for m in base})), ",".join(sorted({m[0] for m in found})),
                    max((m[3] for m in found), default=0.0)))
    return out


LICENSES = [
    "Released under the MIT License. Released under the mit\tlicense!", "under the MIT-License", "under the mit license2",
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
    "with the License. All else under CC BY-NC 4.0; cc by nc, cc by nc", "apache license version 2 apache license version 2",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
    "License as published by the Free Software Foundation, either version 3 of the License, or later.",
    "this software is free and you can share it and or change it under the terms of the GNU General Public License as published by the Free Software "
    "Foundation, either version 2 of the License", "gnu general public license and version 3 elsewhere " * 40,
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: neither the name of nobody", "ÜNDER the mit license", "license " * 500 + "mit under the",
    "under the mit license " * 2000]


def test_license_scan_equals_brute_force(spark, docs):
    extra = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(LICENSES)], "doc_id long, text string")
    rows = docs.unionByName(extra, allowMissingColumns=True).repartition(3).cache()
    got = license_scan.license_scan(rows)
    assert got.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    held = rows.collect()
    want = sorted((str(r.doc_id), *map(str, s)) for r, s in zip(held, scanned([r.text for r in held])))
    assert sorted((str(r[0]), *map(str, r[1:])) for r in got.collect()) == want
    by = {r.doc_id: r for r in got.collect()}
    assert (by[1000].n_base, by[1000].first_word, by[1000].last_word) == (2, 1, 6)
    assert by[1002].n_base == 0 and by[1003].labels == "apache-2,cc-by-nc" and by[1003].n_base == 4
    assert by[1005].labels == "gpl-3" and by[1005].base_labels == "" and 0.9 < by[1005].score <= 1
    assert by[1006].labels == "gpl-2" and by[1008].labels == "bsd" and by[1011].n_base == 2000


def test_license_scan_of_nothing(empty):
    assert license_scan.license_scan(empty).collect() == []


def audited(rows, labels):
    """Every order applied step by step, by sets of rows."""
    def words(t):
        return [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
    text = [r.text or "" for r in rows]
    smallest = {}
    for r, t in zip(rows, text):
        if r.doc_id is not None:
            smallest[t] = min(smallest.get(t, r.doc_id), r.doc_id)
    test = {"A": lambda r, t: len(words(t)) < 100, "B": lambda r, t: 100 * len(set(words(t))) < 80 * len(words(t)),
            "C": lambda r, t: 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": lambda r, t: bool(re.search(r"[#$%&*|]", t)),
            "E": lambda r, t: r.doc_id is not None and r.doc_id > smallest[t]}
    bad = {f: {i for i, (r, t) in enumerate(zip(rows, text)) if test[f](r, t)} for f in test}
    good, toxic = ({i for i, r in enumerate(rows) if r.doc_id is not None and any(
        x[0] == r.doc_id and x[c] == 1 for x in labels)} for c in (1, 2))
    out, shapley = {}, {}
    for part in {r.lang or "" for r in rows}:
        mine = {i for i, r in enumerate(rows) if (r.lang or "") == part}
        for order in map("".join, itertools.permutations("ABCDE")):
            left = set(mine)
            for step, f in enumerate(order, 1):
                fails = mine & bad[f]
                removed = left & fails
                only = {i for i in fails if sum(i in bad[g] for g in bad) == 1}
                out[part, order, step] = (len(left - removed), len(removed), len(fails - removed), len(only),
                                          len(removed & good), len(removed & toxic))
                shapley[part, f] = shapley.get((part, f), 0) + len(removed)
                left -= removed
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_filter_audit_equals_every_order_step_by_step(spark, docs, empty):
    texts = ["LOUD " * 30, "a $ b", " ".join(f"w{i}" for i in range(120)), " ".join(f"w{i % 90}" for i in range(120)) + " #",
             "LOUD " * 30, " ".join(f"W{i}" for i in range(120)) + "|", " ".join(f"w{i % 90}" for i in range(120)) + " #"]
    extra = spark.createDataFrame([((1 << 60) + i, t, ["en", "", None, "de"][i % 4]) for i, t in enumerate(texts * 3)],
                                  "doc_id long, text string, lang string")
    rows = docs.unionByName(extra, allowMissingColumns=True).repartition(3).cache()
    labels = [(i, i % 2, i % 3 == 0) for i in range(12)] + [(0, 1, 1), (None, 1, 1), (3, None, None), (99, 1, 1)]
    labels = [(a, b, None if c is None else int(c)) for a, b, c in labels] + [((1 << 60) + i, 1, i % 2) for i in range(9)]
    table = spark.createDataFrame([(*x, "x", "x") for x in labels], "doc_id long, quality int, toxic int, mask string, h string")
    got = filter_audit.filter_audit(rows, table)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                           "toxic_lost", "shapley"]
    got = got.collect()
    want = audited(rows.collect(), labels)
    assert len(got) == len(want) == 600 * len({r.part for r in got})
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got} == want
    assert filter_audit.filter_audit(empty, table).collect() == []
    none = filter_audit.filter_audit(rows, table.limit(0)).collect()
    assert sum(r.good_lost + r.toxic_lost for r in none) == 0


def test_filter_audit_with_other_filters(docs, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    filters = {"L": lambda text, ws: text.contains("fox"), "S": lambda text, ws: text == ""}
    got = {(r.part, r.filter_order, r.step): r for r in filter_audit.filter_audit(docs, labels, filters, copy="K").collect()}
    assert {k[1] for k in got} == set(map("".join, itertools.permutations("LSK")))
    total = docs.where("lang is null").count()
    assert got["", "LSK", 1].kept + got["", "LSK", 1].removed == total


def test_scratch_folders_of_two_computations_are_apart(spark):
    a, b = Scratch(spark), Scratch(spark)
    left, right = a.stage(spark.range(5).toDF("x"), "t"), b.stage(spark.range(7).toDF("x"), "t")
    a.stage(left, "u")
    a.keep(1)
    assert right.count() == 7 and len(b.paths) == 1
