"""Personal data: fixed patterns against their regular expressions, planted contexts."""

import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from quotelake.llm import pii
from quotelake.llm.queries import QUERIES

DOCS = "doc_id long, text string, row long, spans string, found string, base string"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    turned = [int(d) for d in digits[::-1]]
    return sum(turned[::2] + [sum(divmod(2 * d, 10)) for d in turned[1::2]]) % 10 == 0


def holds(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def by_definition(text):
    found = [
        (kind, *m.span())
        for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text or "")
        if holds(kind, m.group())
    ]
    return sorted(found, key=lambda s: (s[1], list(PATTERNS).index(s[0])))


@pytest.mark.parametrize("letters", ["ab@.-é ", "0125.. ", "0148 -", "+01 ().-9", "a1@.+ -2%("])
def test_fixed_patterns_equal_their_expressions(letters):
    rng = random.Random(letters)
    for n in range(3000):
        text = "".join(rng.choices(letters, k=rng.randrange(1, 60)))
        assert pii.base_spans(text) == by_definition(text), text


def test_cards_pass_luhn():
    assert pii.base_spans("4111 1111-1111 1111, 4111111111111112") == [("card", 0, 19)]


def test_fixed_patterns_take_long_runs_in_linear_time():
    start = time.perf_counter()
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "@a" * 150_000, "+1" + "(" * 300_000):
        pii.base_spans(text)
    assert time.perf_counter() - start < 20


def docs(spark, rows):
    return spark.createDataFrame([(*row, 1, "x", "y", "z") for row in rows], DOCS)


def spans(spark, rows, **options):
    found = pii.find_pii(docs(spark, rows), **options).collect()
    return [(r.doc_id, [tuple(s) for s in r.base], [tuple(s) for s in r.spans]) for r in found]


PLANTED = (
    [(i, f"please call me at +1 (555) 010-{i:04d} today") for i in range(12)]
    + [(20 + i, f"mail: user{i}@mail.example.com, or write") for i in range(12)]
    + [(40 + i, f"order number {i}23456789 was of the {i}0.0.0.{i} kind") for i in range(3)]
)


def test_contexts_find_unseen_identifiers(spark):
    rows = PLANTED + [
        (100, "please call me at 555-010-7777 today"),
        (101, "mail: jo[at]mail.example, or write, or call 555-010-7777!"),
        (102, "call me now, 555-010-8888 is free"),
        (103, "order number 9923456789 was of the year"),
    ]
    found = {d: (base, whole) for d, base, whole in spans(spark, rows)}
    assert found[100] == ([], [("phone", 18, 30)])
    text = rows[-3][1]
    assert found[101][0] == []
    assert [(k, text[a:b]) for k, a, b in found[101][1]] == [
        ("email", "jo[at]mail.example"),
        ("phone", "555-010-7777"),
    ]
    # Contexts without seeds, or with few, find nothing.
    assert found[102] == ([], []) and found[103] == ([], [])
    for doc_id, text in PLANTED:
        assert found[doc_id][0] == by_definition(text) and set(found[doc_id][0]) <= set(found[doc_id][1])


def test_a_found_instance_makes_its_other_contexts_confident(spark):
    """Second round: 'reach us on _' has seeds enough only with what the first one found."""
    rows = PLANTED + [(200 + i, f"please call me at 555-020-{i:04d} today") for i in range(2)]
    rows += [(210 + i, f"do reach us on 555-020-{i:04d} always") for i in range(2)]
    rows += [(220 + i, f"do reach us on +1 (555) 030-{i:04d} always") for i in range(4)]
    rows += [(230, "do reach us on 555-040-0000 always")]
    first = {d: whole for d, _, whole in spans(spark, rows, rounds=1)}
    later = {d: whole for d, _, whole in spans(spark, rows)}
    assert first[230] == [] and later[230] == [("phone", 15, 27)]


def test_pure_contexts_only(spark):
    mixed = [(i, f"at of {x} the end") for i, x in enumerate(["a@b.co", "1.2.3.4"] * 20)]
    assert all(base == whole for _, base, whole in spans(spark, mixed + [(99, "at of 123-456-789 the end")]))


def test_pii_edges(spark):
    long = "word " * 60_000 + "a@b.example.com"
    rows = [
        (1, None),
        (2, ""),
        (3, long),
        (None, "ü 1.2.3.4, +1 (555) 010-1234"),
        (None, "ü 1.2.3.4, +1 (555) 010-1234"),
        (4, "999.1.1.1 1.2.3.4.5.6.7.8.9"),
    ]
    found = sorted(spans(spark, rows), key=repr)
    assert found == sorted(((d, by_definition(t), by_definition(t)) for d, t in rows), key=repr)
    assert spans(spark, []) == []


def test_a_hot_pattern_counts_its_instances_once(spark):
    rows = [(i, "call me at +1 (555) 010-1234 today") for i in range(400)]
    rows += [(1000 + i, f"call me at 555-020-{i:04d} today") for i in range(5)]
    assert all(base == whole for _, base, whole in spans(spark, rows))


def test_masked_text(spark):
    rows = docs(spark, [(1, "é a@b.co, 10.0.0.1"), (2, None), (3, "plain")])
    found = pii.find_pii(rows.select("doc_id", "text"))
    out = rows.select("doc_id", "text").join(found, "doc_id")
    got = {r.doc_id: r.m for r in out.select("doc_id", pii.masked(F.col("text"), F.col("spans")).alias("m")).collect()}
    assert got == {1: "é [email], [ip]", 2: "", 3: "plain"}


def test_query_equals_definition(spark, sf_dir):
    texts = {
        r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    }
    rows = QUERIES["op13_pii"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = by_definition(texts[r.doc_id])
        told = [":".join(map(str, s)) for s in base]
        assert r.base_sha256 == hashlib.sha256(",".join(told).encode()).hexdigest()
        kinds = [s[0] for s in base]
        assert [r[f"n_{k}"] for k in PATTERNS] == [kinds.count(k) for k in PATTERNS]
        assert set(told) <= set(r.spans.split(",")) | {""} and (base or not r.spans)
