"""Registered queries of the operators against their SQL, or against brute force."""

import base64
import hashlib
import math
import zlib
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from compare import difference
from pyspark.sql import functions as F

from quotelake.llm.oracles import ORACLES
from quotelake.llm.queries import QUERIES, RANKS


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, llm_db, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), llm_db, ORACLES[name]) is None


def texts(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    return {row.doc_id: row.text or "" for row in rows}


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def components_of(sets, percent):
    """Smallest reachable id of each id, by all pairs."""
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            met = len(sets[a] & sets[b])
            if met and 100 * met >= percent * (len(sets[a]) + len(sets[b]) - met):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: find(d) for d in sets}


def shingles(text, width):
    lowered = text.translate({c: c + 32 for c in range(65, 91)}).encode().split()
    n = min(width, len(lowered))
    return {tuple(lowered[i : i + n]) for i in range(len(lowered) - n + 1)} if n else set()


def test_near_dedup_equals_brute_force(spark, sf_dir):
    sets = {d: shingles(t, 3) for d, t in texts(spark, sf_dir).items()}
    expected = components_of(sets, 85)
    for row in QUERIES["op5_minhash_near_dedup"](spark, sf_dir).collect():
        assert row.n_shingles == len(sets[row.doc_id])
        assert row.component_id == expected[row.doc_id]
        assert row.kept == (row.doc_id == row.component_id)


def test_quality_classifier_returns_all_rows(spark, sf_dir):
    rows = QUERIES["op2_quality_classifier"](spark, sf_dir).collect()
    assert len(rows) == len(texts(spark, sf_dir))
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)


def test_quality_classifier_separates_held_out_rows(spark):
    data = "/root/testdata/sf0.1"  # holds out several hundred labelled rows
    labels = spark.read.parquet(f"{data}/labels.parquet").select("doc_id", "quality")
    held = QUERIES["op2_quality_classifier"](spark, data).where("held_out")
    rows = held.join(labels.where("quality IS NOT NULL"), "doc_id").collect()
    assert len(rows) > 200
    for quality in (0, 1):
        right = [r.predicted == quality for r in rows if r.quality == quality]
        assert sum(right) >= 0.9 * len(right) > 0


def test_mixing_reaches_its_targets(spark, sf_dir):
    from quotelake.llm.queries import TARGETS

    rows = QUERIES["op3_mixing"](spark, sf_dir).collect()
    mass = {d: sum(r.tokens * r.rate * r[f"p_{d}"] for r in rows) for d in TARGETS}
    whole = sum(mass.values())
    assert all(abs(mass[d] / whole - share) < 1e-3 for d, share in TARGETS.items())
    assert all(r.rate >= 0 and math.floor(r.rate) <= r.copies <= r.rate + 1 for r in rows)


def test_mixing_stage_keeps_held_out_clean_rows_of_each_language(spark):
    from corpus_pipeline import TARGETS
    from quotelake.llm import mixing
    from quotelake.llm.common import held_out

    data = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{data}/documents.parquet")
    labelled = mixing.label_domains(spark.read.parquet(f"{data}/labels.parquet"))
    known = labelled.where(~held_out(F.col("doc_id"), 2))
    mixed = mixing.mix(docs, known, TARGETS, rounding="nearest").select("doc_id", "copies")
    unseen = labelled.where(held_out(F.col("doc_id"), 2)).join(mixed, "doc_id")
    rows = unseen.join(docs.select("doc_id", "lang"), "doc_id").collect()
    for lang in ("de", "en", "es", "fr"):
        clean = [r.copies for r in rows if r.lang == lang and r.domain == "clean"]
        assert clean and sum(c == 0 for c in clean) <= 0.03 * len(clean)
    toxic = [r.copies for r in rows if r.domain == "toxic"]
    assert toxic and sum(c > 0 for c in toxic) <= 0.2 * len(toxic)


def test_bpe_equals_the_library(spark, sf_dir):
    with open(public_tokenizers.path(RANKS), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    source = texts(spark, sf_dir)
    rows = QUERIES["op8_byte_bpe"](spark, sf_dir).collect()
    assert len(rows) == len(source)
    for row in rows:
        ids = library.encode_ordinary(source[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == sha256(",".join(map(str, ids)).encode())
        assert row.decoded_sha256 == sha256(source[row.doc_id].encode())


def test_lm_base_equals_brute_force(spark, sf_dir):
    tokens = {d: [*t.encode().lower().split(), None] for d, t in texts(spark, sf_dir).items()}
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d in tokens}
    counts = Counter(w for d, ws in tokens.items() if not held[d] for w in ws)
    whole, unit = sum(counts.values()), sum(counts.values()) + 0.5 * (len(counts) + 1)
    rows = QUERIES["op10_lm_scoring"](spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(tokens)
    for r in rows:
        ws = tokens[r.doc_id]
        base = sum(math.log10((counts[w] + 0.5) / unit) for w in ws)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(ws), whole)
        assert r.n_known == sum(counts[w] > 0 for w in ws)
        assert r.base_score == pytest.approx(base)
        assert r.score < 0


def test_lm_beats_word_counts_on_held_out_rows(spark):
    rows = QUERIES["op10_lm_scoring"](spark, "/root/testdata/sf0.01").where("held_out")
    score, base = rows.agg(F.sum("score"), F.sum("base_score")).first()
    assert base < score < 0
