"""Disclosure values of the sanitisation against a plain count over all values and terms."""

import math
import random
import re

import pytest

from salesmart.llm import pii


def plain(texts):
    """(value, term) -> disclosure; every address stands in surroundings of its own, so texts are contexts."""
    terms = [set(re.findall(r"[^\W_]+", t.lower())) for t in texts]
    values = [set(re.findall(r"[a-z]+@[a-z]+\.org", t)) for t in texts]
    out, total = {}, len(texts)
    for e in set().union(*values):
        rows = [i for i in range(total) if e in values[i]]
        if len({texts[i] for i in rows}) < pii.SUPPORT or len(rows) == total:
            continue
        for t in set().union(*(terms[i] for i in rows)):
            joint = [i for i in rows if t in terms[i]]
            if len(t) < 3 or len({texts[i] for i in joint}) < pii.SUPPORT:
                continue
            share = len(joint) / sum(t in x for x in terms)
            d = 1 + math.log2(share) / -math.log2(len(rows) / total)
            if d >= pii.GENERALISE:
                out[e, t] = d
    return out


def test_disclosure_equals_plain_counts(spark):
    rng = random.Random(4)
    people = [f"{a}{b}@mail.org" for a in "abcdef" for b in "xyz"]
    texts = []
    for i in range(400):
        some = [f"word{rng.randint(0, 60)}" for _ in range(rng.randint(3, 12))]
        for e in rng.sample(people, rng.choice([0, 0, 1, 2])):
            k = people.index(e)
            some += [f"before{i}x{k}", e, f"after{i}x{k}"] + [f"Secret{k}"] * (rng.random() < .9) + [f"team{k % 4}"]
        some += [f"secret{rng.randint(0, 17)}"] * (rng.random() < .04)
        texts.append(" ".join(some))
    texts += texts[:25]     # repeated texts are trials of their own and one context
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.value, r.term): (r.disclosure, r.action) for r in pii.disclosing_terms(docs, pii.mentions(docs)).collect()}
    want = plain(texts)
    assert len(want) >= 15 and any(d < pii.REMOVE for d in want.values())
    assert {k: d for k, (d, _) in got.items()} == pytest.approx(want)
    assert all(action == ("remove" if d >= pii.REMOVE else "generalise") for d, action in got.values())
