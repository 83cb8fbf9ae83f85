"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import base64
import math
import os
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from quotelake.llm import (
    bpe,
    chat,
    embedding_dedup,
    line_dedup,
    lm_scoring,
    mixing,
    near_dedup,
    quality_classifier,
    quality_rules,
    sharding,
)
from quotelake.llm.components import components
from quotelake.llm.queries import RANKS

DOCS = "doc_id long, text string, d string, lines string, words string, __x long"


def docs(spark, *rows):
    return spark.createDataFrame([(i, t, "x", "y", "z", 1) for i, t in rows], DOCS)


LONG = "one two three four five six seven eight nine ten " * 20_000
EDGE = [(1, None), (2, ""), (3, " \n\t"), (None, "a line without an id"), (5, LONG)]


def test_line_dedup_edges(spark):
    rows = EDGE + [
        (6, "Shared line here\nown line of six\nshort\nshared LINE here"),
        (7, "  shared line here\t\nshort\n\nown line of seven"),
        (7, "  shared line here\t\nshort\n\nown line of seven"),
        (8, "A LINE WITHOUT AN ID"),
    ]
    kept = line_dedup.dedup_lines(docs(spark, *rows), batches=3).collect()
    found = {(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in kept}
    assert len(kept) == len(rows)
    assert (1, "", 1, 0) in found and (2, "", 1, 0) in found and (3, " \n\t", 2, 0) in found
    assert (6, rows[5][1], 4, 0) in found
    assert (7, "short\n\nown line of seven", 4, 1) in found
    # A null doc_id comes after all others.
    assert (8, "A LINE WITHOUT AN ID", 1, 0) in found and (None, "", 1, 1) in found
    assert kept[0].d == "x"
    assert line_dedup.dedup_lines(docs(spark)).count() == 0


def test_line_runs_are_compacted_and_remember(spark):
    store = line_dedup.LineRuns(spark, fanout=2, buckets=2)
    for i in range(5):
        batch = docs(spark, (i, f"the same line\nline of batch {i}"))
        gone = store.add(line_dedup.hashed_lines(batch)).collect()
        assert [g.pos for g in gone] == ([] if i == 0 else [0])
    assert [len(level) for level in store.levels] == [1, 0, 1]


def test_line_dedup_of_a_hot_line(spark):
    rows = [(i, "the one common line\nline number " + str(i)) for i in range(500)]
    kept = line_dedup.dedup_lines(docs(spark, *rows), batches=2)
    assert kept.agg(F.sum("n_dropped")).first()[0] == 499


def test_chat_edges(spark):
    said = "</s>[INST] ok [/INST] <|end|>\n<|part|> \\ \\\\ <\\| <"
    rows = [
        (1, 1, "assistant", said),
        (1, 0, "user", None),
        (1, 2, "assistant", "more"),
        (1, 2, "assistant", "more"),
        (2, None, None, "<|start|>user<|text|>"),
        (None, 0, "user", LONG),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_chats(frame.withColumn("turns", F.lit(1)))
    read = {
        r.conv_id: r
        for r in out.select(
            "conv_id",
            chat.read_turns(F.col("formatted")).alias("turns"),
            chat.learned_text(F.col("segments")).alias("learned"),
            F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("joined"),
            "formatted",
        ).collect()
    }
    turns = [tuple(t) for t in read[1].turns]
    assert turns == [("user", ""), ("assistant", said), ("assistant", "more"), ("assistant", "more")]
    assert read[1].learned == said + "moremore" and read[1].joined == read[1].formatted
    assert [tuple(t) for t in read[2].turns] == [("", "<|start|>user<|text|>")]
    assert read[None].turns[0].text == LONG and read[2].learned == ""
    assert chat.format_chats(frame.limit(0)).count() == 0


def test_quality_rules_edges(spark):
    repeated = "alpha beta gamma delta epsilon zeta eta theta"
    rows = EDGE + [(6, f"{repeated} x {repeated}"), (7, "word " * 30)]
    out = quality_rules.cascade(docs(spark, *rows), report=("n_words", "n_repeat_words"))
    found = {r.doc_id: r for r in out.collect()}
    assert found[1].n_words == 0 and found[1].rejected_by == "few_words"
    assert (found[6].n_words, found[6].n_repeat_words) == (17, 16)
    assert found[7].n_repeat_words == 30 and found[5].n_repeat_words == 200_000
    assert quality_rules.cascade(docs(spark)).count() == 0


def test_sharding_fits_and_splits_a_hot_key(spark):
    rows = [(i, "x" * 10) for i in range(200)] + [(7, "y" * 10)] * 60 + [(900, "z" * 500), (901, None)]
    out = sharding.assign_shards(docs(spark, *rows), limit=100).collect()
    assert len(out) == len(rows)
    sizes = {}
    for r in out:
        sizes[r.shard] = sizes.get(r.shard, 0) + r.bytes
    assert all(r.shard_bytes == sizes[r.shard] for r in out)
    assert {r.doc_id for r in out if not r.fits} == {900}
    assert all(size <= 100 for shard, size in sizes.items() if size != 500)
    # Prefixes of one another never both exist, and a split was needed.
    shards = sorted(sizes)
    assert not any(b.startswith(a) for a, b in zip(shards, shards[1:]))
    assert sharding.assign_shards(docs(spark), 100).count() == 0
    assert {r.shard for r in sharding.assign_shards(docs(spark, (1, "a")), 100).collect()} == {""}


def test_near_dedup_edges(spark):
    base = [f"w{i}" for i in range(100)]
    near = [" ".join([*base[:k], "other", *base[k + 1 :]]) for k in range(0, 100, 20)]
    rows = EDGE + [(10, " ".join(base)), (11, " ".join(base).upper()), (12, "two words")]
    rows += [(13, "two  words"), (14, "two other"), (11, " ".join(base))]
    rows += [(20 + i, t) for i, t in enumerate(near)] + [(40, LONG.replace("ten", "tin", 1))]
    out = near_dedup.near_duplicates(docs(spark, *rows), percent=85, width=3).collect()
    assert len(out) == len(rows)
    found = {r.doc_id: r for r in out}
    assert (found[1].n_shingles, found[1].component_id, found[1].kept) == (0, 1, True)
    assert found[2].component_id == 2 and found[3].component_id == 3
    assert found[11].component_id == 10 and not found[11].kept
    assert (found[12].n_shingles, found[13].component_id, found[14].component_id) == (1, 12, 14)
    assert all(found[20 + i].component_id == 10 for i in range(len(near)))
    assert found[None].kept and found[None].component_id is None
    assert near_dedup.near_duplicates(docs(spark)).count() == 0


def test_near_copies_of_one_text_are_one_component(spark):
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(400):
        words = list(base)
        words[rng.integers(60)] = f"x{i}"
        rows.append((i, " ".join(words)))
    out = near_dedup.near_duplicates(docs(spark, *rows), percent=85, width=1).collect()
    assert {r.component_id for r in out} == {0}


def test_near_dedup_of_two_texts_under_one_id(spark):
    first = " ".join(f"a{i}" for i in range(60))
    second = " ".join(f"b{i}" for i in range(60))
    rows = [(5, first), (5, second), (7, first + " tail"), (8, second + " tail"), (2, second + " end")]
    out = near_dedup.near_duplicates(docs(spark, *rows), percent=85, width=3).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in out) == [
        (2, 2, True),
        (5, 2, False),
        (5, 5, True),
        (7, 5, False),
        (8, 2, False),
    ]


@pytest.mark.parametrize("block", [4, 512])
def test_near_dedup_of_a_long_list_equals_brute_force(spark, monkeypatch, block):
    """Copies of one text that differ in one to eight words: not all link, and none with all."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rng = np.random.default_rng(5)
    rows = []
    for i in range(60):
        line = [f"w{j}" for j in range(100)]
        for j in rng.choice(20, rng.integers(1, 9), replace=False):
            line[5 * j] = f"x{rng.integers(3)}"
        rows.append((i, " ".join(line)))
    sets = [{tuple(t.split()[j : j + 3]) for j in range(98)} for _, t in rows]
    least = list(range(60))
    for _ in range(60):
        for a in range(60):
            for b in range(60):
                if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                    least[a] = min(least[a], least[b])
    assert 2 < len(set(least)) < 60
    out = near_dedup.near_duplicates(docs(spark, *rows), percent=85, width=3).collect()
    assert {r.doc_id: r.component_id for r in out} == dict(enumerate(least))


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(8, 60)] + [(3, 59), (3, 3), (9, 7)]
    frame = spark.createDataFrame(path + star, "a long, b long")
    found = {r.v: r.component for r in components(frame).collect()}
    assert {found[i] for i in range(100, 161)} == {100}
    assert {found[i] for i in [3, *range(7, 60)]} == {3}
    assert components(frame.limit(0)).count() == 0


def test_embedding_edges(spark):
    one, two = [1.0, 0.0, 0.0], [1.0, 0.1, 0.0]
    rows = [
        (1, one, 1),
        (2, one, 1),
        (3, two, 1),
        (4, one, 2),
        (5, None, 1),
        (6, [0.0, 0.0, 0.0], 1),
        (7, [1.0, None, 0.0], 1),
        (8, [1.0, float("nan"), 0.0], 1),
        (9, [1.0, float("inf"), 0.0], 1),
        (10, one, None),
        (11, [], 1),
        (12, [1.0, 0.0], 1),
        (13, [0.0, 1.0, 0.0], 1),
        (None, one, 1),
    ]
    schema = "vec_id long, embedding array<float>, label int"
    frame = spark.createDataFrame(rows, schema)
    out = {
        r.vec_id: (r.n_links, r.component_id, r.kept)
        for r in embedding_dedup.near_vectors(frame.withColumn("c", F.lit(0))).collect()
    }
    assert out[1] == (2, 1, True) and out[2] == (2, 1, False) and out[3] == (2, 1, False)
    assert all(out[i] == (0, i, True) for i in range(4, 14))
    assert out[None] == (0, None, True)
    assert embedding_dedup.near_vectors(frame.limit(0)).count() == 0


def test_embedding_blocks_count_each_link_once(spark):
    rng = np.random.default_rng(2)
    centre = rng.standard_normal(16)
    vecs = [(centre + 0.1 * rng.standard_normal(16)).tolist() for _ in range(120)]
    frame = spark.createDataFrame(
        [(i, v, 1) for i, v in enumerate(vecs)], "vec_id long, embedding array<double>, label int"
    )
    x = np.array(vecs)
    x /= np.linalg.norm(x, axis=1)[:, None]
    expected = (x @ x.T >= 0.93).sum(axis=1) - 1
    out = embedding_dedup.near_vectors(frame, block=16).collect()
    assert [r.n_links for r in sorted(out)] == expected.tolist()


def test_quality_classifier_edges(spark):
    good = [(i, "Plain words of a text, and more of them. " * (3 + i % 5)) for i in range(40)]
    bad = [(100 + i, "BUY!! NOW!! ### " * (3 + i % 5)) for i in range(40)]
    frame = docs(spark, *(EDGE + good + bad))
    labels = spark.createDataFrame(
        [(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad] + [(None, 1), (1, None)],
        "doc_id long, quality int",
    )
    out = quality_classifier.score_quality(frame, labels).collect()
    assert len(out) == len(EDGE) + 80 and all(0 <= r.score <= 1 for r in out)
    found = {r.doc_id: r.score for r in out}
    assert min(found[i] for i, _ in good) > 0.5 > max(found[i] for i, _ in bad)
    assert quality_classifier.score_quality(frame.limit(0), labels).count() == 0
    assert {r.score for r in quality_classifier.score_quality(frame, labels.limit(0)).collect()} == {0.5}


def test_mixing_edges(spark):
    rows = EDGE + [(10 + i, "red green blue " * 5) for i in range(20)]
    rows += [(50 + i, "one two three " * 5) for i in range(10)]
    labelled = spark.createDataFrame(
        [(10 + i, "a") for i in range(10)] + [(50 + i, "b") for i in range(5)] + [(None, "a"), (11, None)],
        "doc_id long, domain string",
    )
    frame = docs(spark, *rows)
    out = mixing.mix(frame, labelled, {"a": 0.5, "b": 0.5})
    found = out.collect()
    assert len(found) == len(rows) and all(r.rate >= 0 for r in found)
    mass = {d: sum(r.tokens * r.rate * r.posterior[d] for r in found) for d in "ab"}
    assert mass["a"] == pytest.approx(mass["b"], rel=1e-3)
    assert mixing.mix(frame.limit(0), labelled, {"a": 1.0}).count() == 0
    assert mixing.mix(frame, labelled.limit(0), {"a": 0.5, "b": 0.5}).count() == len(rows)


def test_mixing_drops_nothing_without_evidence(spark):
    frame = docs(spark, *EDGE, (6, "red green"))
    none = spark.createDataFrame([(99, "a")], "doc_id long, domain string")
    out = mixing.mix(frame, none, {"a": 1.0, "b": 0.0, "c": 0.0}, rounding="nearest").collect()
    assert [(r.rate, r.copies) for r in out] == [(1.0, 1)] * 6


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path(RANKS), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def test_bpe_edges(spark, library):
    codec = bpe.Codec(
        bpe.read_ranks(public_tokenizers.path(RANKS)), public_tokenizers.PATTERN
    )
    rows = EDGE[:4] + [
        (6, "a" * 5000),
        (7, "ab" * 400 + "aab" * 300),
        (8, "naïve café – 東京 😀   x's I'LL we'll 12345  \n\n end"),
        (8, "naïve café"),
        (9, "\x1c\x1d tab\there <|endoftext|>"),
        (10, "the the the " * 1000),
    ]
    frame = docs(spark, *rows).withColumn("ids", F.lit(0)).withColumn("code", F.lit("q"))
    out = bpe.encode_texts(frame, codec).select("doc_id", "text", "ids", codec.decode(F.col("ids")).alias("back"))
    found = out.collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.ids == library.encode_ordinary(r.text or "")
        assert bytes(r.back) == (r.text or "").encode()
    assert bpe.encode_texts(frame.limit(0), codec).count() == 0


def test_bpe_rows_of_several_slices_and_a_long_word(spark, library):
    codec = bpe.Codec(
        bpe.read_ranks(public_tokenizers.path(RANKS)), public_tokenizers.PATTERN
    )
    word = "".join("abcde"[i * i % 7 % 5] for i in range(200_000))
    long = " ".join(f"word{i} again" for i in range(60_000))
    rows = [(1, long), (2, None), (3, word), (3, word), (4, long + "!"), (5, "end")]
    rows += [(6, "the same row")] * 50
    found = bpe.encode_texts(docs(spark, *rows).coalesce(1), codec).collect()
    assert sorted(r.doc_id for r in found) == sorted(i for i, _ in rows)
    expected = {t: library.encode_ordinary(t or "") for t in {t for _, t in rows}}
    assert all(r.ids == expected[r.text] for r in found)


def brute_ctw(train, text, depth):
    """log10 probability of a text by counts of contexts, straight from the definition."""
    counts = {}

    def line(t):
        return bytes([10]) * depth + b"".join(w + b" " for w in t) + b"\n"

    def bits(raw):
        for i in range(depth, len(raw)):
            node = 1
            for k in range(7, -1, -1):
                bit = raw[i] >> k & 1
                yield raw[i - depth : i], node, bit
                node = node * 2 + bit

    for t in train:
        for context, node, bit in bits(line(t)):
            for d in range(depth + 1):
                counts.setdefault((context[depth - d :], node), [0, 0])[bit] += 1

    def kt(a, b):
        g = math.lgamma
        return g(a + 0.5) + g(b + 0.5) - g(a + b + 1) - math.log(math.pi)

    weighted = {}
    for d in range(depth, -1, -1):
        for (context, node), (a, b) in list(counts.items()):
            if len(context) == d:
                split = sum(
                    w for (c, n), w in weighted.items() if n == node and len(c) == d + 1 and c[1:] == context
                )
                own = kt(a, b)
                weighted[context, node] = own if d == depth else math.log(0.5) + np.logaddexp(own, split)
    total = 0.0
    for context, node, bit in bits(line(text)):
        said, left, one = 0.0, 1.0, 0.5
        for d in range(depth + 1):
            key = (context[depth - d :], node)
            if key not in counts:
                break
            a, b = counts[key]
            chance = (b + 0.5) / (a + b + 1)
            one = said + left * chance
            own = 1.0 if d == depth else math.exp(math.log(0.5) + kt(a, b) - weighted[key])
            said, left = said + left * own * chance, left * (1 - own)
        total += math.log10(one if bit else 1 - one)
    return total


def test_lm_scores_equal_the_definition(spark):
    train = ["the cat sat on the mat", "a cat and a hat", "", None, "The CAT"]
    rows = [(i, t) for i, t in enumerate(train)] + [(50, "the hat sat"), (51, "zebra"), (51, None)]
    out = lm_scoring.score_texts(docs(spark, *rows), F.col("doc_id") < 50, depth=2).collect()
    words = [lm_scoring.text_words(t) for t in train]
    assert len(out) == len(rows) and {r.train_tokens for r in out} == {6 + 5 + 2 + 5}
    for r, t in zip(sorted(out, key=lambda r: (r.doc_id, -r.n_tokens)), [t for _, t in rows]):
        assert r.score == pytest.approx(brute_ctw(words, lm_scoring.text_words(t), 2))
    empty = lm_scoring.score_texts(docs(spark), F.col("doc_id") < 50)
    assert empty.count() == 0
    none = lm_scoring.score_texts(docs(spark, (1, "ab")), F.lit(False), depth=2).collect()
    assert none[0].score == pytest.approx(4 * 8 * math.log10(0.5))


def test_lm_scores_equal_the_definition_below_the_roots_of_buckets(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "BLOCK", 40)  # chunks of several blocks
    monkeypatch.setattr(lm_scoring, "PRICED", 30)
    train = ["the cat sat on the mat", "the cat sat on the hat", "", None, "été 🦊 the cat"] * 3
    rows = [(i, t) for i, t in enumerate(train)] + [(50, "the hat sat on the cat"), (51, "zebra")]
    out = lm_scoring.score_texts(
        docs(spark, *rows), F.col("doc_id") < 50, depth=5, least_chunks=2
    ).collect()
    words = [lm_scoring.text_words(t) for t in train]
    assert len(out) == len(rows)
    for r, t in zip(sorted(out, key=lambda r: r.doc_id), [t for _, t in rows]):
        assert r.score == pytest.approx(brute_ctw(words, lm_scoring.text_words(t), 5))


def test_lm_estimates_of_large_counts_equal_those_of_small_ones():
    zeros, ones = np.array([0, 1, 4095, 4096, 70_000]), np.array([0, 5000, 4096, 0, 3])
    for a, b, found in zip(zeros, ones, lm_scoring._Estimate()(zeros, ones)):
        exact = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1)
        assert found == pytest.approx(exact - math.log(math.pi), abs=1e-9)


def test_lm_stages_less_than_twice_its_texts(spark, monkeypatch):
    paths = []

    def kept(df, name, *partitions, stage=lm_scoring.staged):
        out = stage(df, name, *partitions)
        paths.extend(out.inputFiles())
        return out

    monkeypatch.setattr(lm_scoring, "staged", kept)
    draw = random.Random(5)
    names = ["".join(draw.choices("abcdefghij", k=6)) for _ in range(4000)]
    rows = [(i, " ".join(draw.choices(names, k=1500))) for i in range(100)]
    out = lm_scoring.score_texts(docs(spark, *rows), F.col("doc_id") % 5 > 0, least_chunks=4)
    assert out.where("score < 0").count() == len(rows)
    staged_bytes = sum(os.path.getsize(p.removeprefix("file://")) for p in paths)
    assert staged_bytes < 2 * sum(len(t) for _, t in rows)


HELPERS = ("d", "t", "dropped", "lines", "ends", "text", "words", "n_words", "_text")


def test_columns_named_like_helpers_pass_through(spark):
    rows = [(1, "a line of some length\nown one"), (2, "a line of some length\nother"), (3, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    frame = frame.select("*", *[F.concat(F.lit(h), "doc_id").alias(f"__{h}") for h in HELPERS])
    deduped = {r.doc_id: r for r in line_dedup.dedup_lines(frame).collect()}
    assert {i: (r.text, r.n_lines, r.n_dropped) for i, r in deduped.items()} == {
        1: ("a line of some length\nown one", 2, 0),
        2: ("other", 2, 1),
        3: ("", 1, 0),
    }
    judged = {r.doc_id: r for r in quality_rules.cascade(frame, report=("n_words",)).collect()}
    assert {i: r.n_words for i, r in judged.items()} == {1: 7, 2: 6, 3: 0}
    for found in (deduped, judged):
        for i, row in found.items():
            assert all(row[f"__{h}"] == f"{h}{i}" for h in HELPERS)
