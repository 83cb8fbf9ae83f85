"""Lexical search against scores computed document by document, and edge rows."""

import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from quotelake.llm import lexical_search as ls

TERM = re.compile(ls.TERM)
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked(docs, items, k=10):
    """(item_id, rank, doc_id, score) by definition, for rows in any number."""
    counted = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    n_docs, length = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, counts in counted:
            norm = 25 + 75 * sum(counts.values()) * n_docs // length
            score = 0
            for t in terms(text):
                if t in counts:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * (10**9 * counts[t] // (1000 * counts[t] + 8 * norm))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        best = sorted(scores, key=lambda s: s[:3])[:k]
        out += [(item, i + 1, s[3], -s[0]) for i, s in enumerate(best)]
    return sorted(out, key=repr)


def frames(spark, docs, items):
    extra = "doc_id long, text string, doc long, n string, score string"
    return (
        spark.createDataFrame([(*d, 1, "x", "y") for d in docs], extra),
        spark.createDataFrame([(*i, 1, "x") for i in items], "item_id long, text string, row long, terms string"),
    )


def found(spark, docs, items, **options):
    rows = ls.search(*frames(spark, docs, items), **options).collect()
    return sorted([tuple(r) for r in rows], key=repr)


def test_search_edges(spark):
    docs = [
        (1, None),
        (2, ""),
        (3, " -- \n"),
        (4, "Red fox, red FOX; naïve Ünder 42"),
        (5, "red fox red fox naïve Ünder 42"),
        (5, "red fox red fox naïve Ünder 42"),
        (None, "red fox"),
        (6, "blue " * 60_000 + "whale"),
        (7, "İ ünder naïve"),
    ]
    items = [
        (1, "RED fox red"),
        (1, "RED fox red"),
        (2, None),
        (3, "!?"),
        (None, "whale 42 nothing"),
        (4, "Ünder NAÏVE naïve"),
    ]
    assert found(spark, docs, items) == ranked(docs, items)


def test_search_of_nothing(spark):
    assert found(spark, [], [(1, "a")]) == []
    assert found(spark, [(1, "a")], []) == []
    assert found(spark, [(1, "a")], [(1, "b")]) == []


def corpus(n):
    """Families of similar documents over frequent and rare words, some of them equal."""
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    weight = [1 / (i + 1) for i in range(400)]
    docs = []
    for i in range(n):
        if i % 3 == 0:
            base = rng.choices(vocabulary, weight, k=60)
        text = base[:45] + rng.choices(vocabulary, weight, k=rng.randrange(40))
        docs.append((i, " ".join(text if i % 5 else base)))
    items = [(i, " ".join(rng.choices(vocabulary, weight, k=20))) for i in range(12)]
    items += [(20 + i, docs[i * 17][1]) for i in range(4)]
    return docs, items


def test_search_equals_brute_force_while_it_skips_blocks(spark, monkeypatch):
    monkeypatch.setattr(ls, "ITEM_BYTES", 700)  # several blocks of items
    docs, items = corpus(900)
    assert found(spark, docs, items, sample=4) == ranked(docs, items)


def test_blocks_bound_their_members_and_most_are_skipped(spark):
    docs, items = corpus(900)
    held, _ = frames(spark, docs, items)
    asked = ls.Items([terms(t) for _, t in items])
    index = ls.forward(held, asked).cache()
    weights = ls.statistics(index, asked)
    known = ls.known_scores(index, asked, weights, 10, 1)
    plan = ls.Plan(asked, ls.greatest_impacts(index, asked, weights), known, weights)
    ordered = ls.similar_order(index, asked, weights, plan)
    lists = ls.blocks(ordered, weights, plan)
    pairs = {tuple(r) for r in ls.candidates(ordered, weights, plan).collect()}
    best = ranked(docs, items)
    place = {doc: i for i, (doc, _) in enumerate(items)}
    number = {r.doc_id: r.doc for r in index.select("doc", "doc_id").collect()}
    assert {(number[d], place[i]) for i, _, d, _ in best} <= pairs
    assert len(pairs) < 0.5 * len(docs) * len(items)
    # With the exact tenth score known, no list of an item's frequent words is read.
    assert not plan.essential.all()
    members = lists.groupBy("term").agg(F.sum(F.octet_length("members") / 8).alias("n")).collect()
    holders = Counter(t for d, text in docs for t in set(terms(text)))
    names = {i: t.decode() for t, i in asked.ids.items()}
    assert {names[r.term]: int(r.n) for r in members} == {
        t: holders[t] for t in (names[r.term] for r in members)
    }
    index.unpersist()
