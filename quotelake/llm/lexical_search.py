"""Ranked lexical search over posting lists in geometric blocks.

Terms are runs of ASCII letters and digits and of any wider characters; A-Z count
as a-z. The index has the documents' terms that items ask for. Each posting list
is clustered: its documents are dealt to the pivot with which their impacts have
the greatest inner product, and a block stores its members and the greatest
impact of each coordinate. A block is skipped when the sum of these maxima over
an item's terms stays below a score that ten documents are known to reach;
members of all other blocks are scored exactly, so the result is exact.

That known score comes from a sample of one document in ``SAMPLE``, whatever the
size. Lists are read only for an item's essential terms: what its other terms can
add up to, by their greatest impacts, stays below the known score, so a document
without an essential term cannot be ranked.

Documents are ordered by the signs of random projections and cut into sections
of similar ones; the list of a frequent word is clustered section by section, so
no task holds a list as a whole. Items are taken in blocks of bounded size, which
are the only thing that goes through the driver.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quotelake.llm.common import lower_ascii, staged

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
ITEM_BYTES = 1 << 20  # of item text searched at once
SAMPLE = 64  # one document of so many gives the known scores
PLANES = 24  # signs that order documents by similarity
SECTION = 1024  # documents clustered together
CELLS = 1 << 22  # impacts of a section as a dense matrix
PAIRS = 1 << 16  # candidates of one Arrow batch, about
BLOCK = 8  # documents of a block, on average

# Separators become spaces and A-Z become a-z, so that split() gives the terms.
_FOLD = bytes(
    b if b >= 128 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower()
)


class Items:
    """A block of items: the terms of each, and where each term is asked for."""

    def __init__(self, terms: list[list[str]]):
        known = sorted({term for words in terms for term in words})
        self.ids = {term.encode(): i for i, term in enumerate(known)}
        self.size = len(known)
        self.terms, self.counts = [], []
        for words in terms:
            counted = sorted(Counter(self.ids[w.encode()] for w in words).items())
            self.terms.append(np.array([t for t, _ in counted], dtype=np.int64))
            self.counts.append(np.array([c for _, c in counted], dtype=np.int64))

    def scores(self, impacts: np.ndarray, chosen=None) -> np.ndarray:
        """Score of each (chosen) item by one impact per term."""
        chosen = range(len(self.terms)) if chosen is None else chosen
        return np.array([(impacts[self.terms[i]] * self.counts[i]).sum() for i in chosen], np.int64)


class Weights:
    """Corpus statistics that turn term counts into impacts."""

    def __init__(self, n_docs: int, n_terms: int, holders: np.ndarray):
        self.n_docs, self.n_terms = n_docs, n_terms
        self.weight = np.array(
            [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) for df in holders],
            dtype=np.int64,
        )

    def impacts(self, n: int, ids: np.ndarray, tf: np.ndarray) -> np.ndarray:
        length = 100 - 75 + (75 * n * self.n_docs) // self.n_terms
        return self.weight[ids] * ((1_000_000_000 * tf) // (1000 * tf + 8 * length))


def forward(docs: DataFrame, items: Items) -> DataFrame:
    """(doc, doc_id, n, ids, tf): length and asked-for terms of each document with terms."""

    def run(source):
        for batch in source:
            out = {"doc": [], "n": [], "ids": [], "tf": []}
            doc_ids = []
            for doc, doc_id, text in zip(*batch.columns):
                words = text.as_py().translate(_FOLD).split() if text.is_valid else ()
                if not words:
                    continue
                found = [(items.ids[w], c) for w, c in Counter(words).items() if w in items.ids]
                pairs = np.array(sorted(found), dtype=np.int32).reshape(-1, 2)
                out["doc"].append(doc.as_py())
                out["n"].append(len(words))
                out["ids"].append(pairs[:, 0].tobytes())
                out["tf"].append(pairs[:, 1].tobytes())
                doc_ids.append(doc_id)
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
            columns = [pa.array(v, k) for v, k in zip(out.values(), kinds)]
            columns.insert(1, pa.array([d.as_py() for d in doc_ids], batch.schema.field("doc_id").type))
            yield pa.RecordBatch.from_arrays(columns, ["doc", "doc_id", "n", "ids", "tf"])

    rows = docs.select(
        F.monotonically_increasing_id().alias("doc"), "doc_id", F.col("text").cast("binary")
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc long, doc_id {kind}, n long, ids binary, tf binary")


def _arrays(ids: bytes, tf: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, np.int32).astype(np.int64), np.frombuffer(tf, np.int32).astype(np.int64)


def _per_term(rows: DataFrame, size: int, start, fold) -> np.ndarray:
    """One number per term: folded in each task, then over tasks by ``fold``'s name."""

    def run(source):
        total = np.zeros(size, dtype=np.int64)
        for batch in source:
            for row in zip(*(batch.column(c).to_pylist() for c in ("n", "ids", "tf"))):
                start(total, *row)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["t", "x"])

    merged = rows.select("n", "ids", "tf").mapInArrow(run, "t long, x long").groupBy("t").agg(fold("x"))
    out = np.zeros(size, dtype=np.int64)
    for t, x in merged.collect():  # a row per term of the item block
        out[t] = x
    return out


def statistics(index: DataFrame, items: Items) -> Weights:
    n_docs, n_terms = index.agg(F.count("*"), F.sum("n")).first()

    def count(total, _, ids, tf):
        total[np.frombuffer(ids, np.int32)] += 1

    return Weights(n_docs, n_terms or 1, _per_term(index, items.size, count, F.sum))


def greatest_impacts(index: DataFrame, items: Items, weights: Weights) -> np.ndarray:
    def most(total, n, ids, tf):
        ids, tf = _arrays(ids, tf)
        total[ids] = np.maximum(total[ids], weights.impacts(n, ids, tf))

    return _per_term(index, items.size, most, F.max)


def known_scores(index: DataFrame, items: Items, weights: Weights, k: int, sample: int) -> np.ndarray:
    """Per item a score that k sampled documents reach (0 if fewer have a score)."""

    def run(source):
        best = np.zeros((k, len(items.terms)), dtype=np.int64)
        impacts = np.zeros(items.size, dtype=np.int64)
        for batch in source:
            for n, ids, tf in zip(*(column.to_pylist() for column in batch.columns)):
                ids, tf = _arrays(ids, tf)
                impacts[ids] = weights.impacts(n, ids, tf)
                best[0] = np.maximum(best[0], items.scores(impacts))
                best.sort(axis=0)
                impacts[ids] = 0
        place = np.tile(np.arange(len(items.terms)), k)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(best.ravel())], ["i", "x"])

    drawn = index.where(F.pmod(F.xxhash64("doc"), F.lit(sample)) == 0).select("n", "ids", "tf")
    scores = drawn.mapInArrow(run, "i long, x long").where(F.col("x") > 0)
    order = Window.partitionBy("i").orderBy(F.desc("x"))
    found = scores.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k)
    out = np.zeros(len(items.terms), dtype=np.int64)
    for i, x, n in found.groupBy("i").agg(F.min("x"), F.count("*")).collect():  # a row per item
        out[i] = x if n == k else 0
    return out


class Plan:
    """Which items read which lists, and the scores they have to reach."""

    def __init__(self, items: Items, greatest: np.ndarray, known: np.ndarray, weights: Weights):
        self.items, self.known = items, known
        self.askers: dict[int, list[int]] = {}
        for i, (terms, counts) in enumerate(zip(items.terms, items.counts)):
            order = np.argsort(weights.weight[terms], kind="stable")  # frequent terms first
            reach = np.cumsum((greatest[terms] * counts)[order])
            for t in terms[order][reach >= known[i]]:
                self.askers.setdefault(int(t), []).append(i)
        self.essential = np.zeros(items.size, dtype=bool)
        self.essential[list(self.askers)] = True
        self._kept: dict[int, np.ndarray] = {}
        self._room = 1 << 22

    def coordinates(self, term: int) -> np.ndarray:
        """Terms of the items that read this list: what its summaries have to bound."""
        found = self._kept.get(term)
        if found is None:
            found = np.unique(np.concatenate([self.items.terms[i] for i in self.askers[term]]))
            if self._room > len(found):
                self._kept[term] = found
                self._room -= len(found)
        return found

    def __getstate__(self):
        return {**self.__dict__, "_kept": {}, "_room": 1 << 22}


def similar_order(index: DataFrame, items: Items, weights: Weights, plan: Plan) -> DataFrame:
    """Documents with an essential term, neighbours in a range being similar ones."""

    def run(source):
        planes = np.random.default_rng(20240131).standard_normal((items.size, PLANES))
        places = 1 << np.arange(PLANES)[::-1]
        for batch in source:
            keep, codes = [], []
            for n, ids, tf in zip(*(batch.column(c).to_pylist() for c in ("n", "ids", "tf"))):
                ids, tf = _arrays(ids, tf)
                keep.append(bool(plan.essential[ids].any()))
                if keep[-1]:
                    side = weights.impacts(n, ids, tf) @ planes[ids] > 0
                    codes.append(int(side @ places))
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(codes, pa.int64())], [*kept.schema.names, "code"]
            )

    coded = index.select("doc", "n", "ids", "tf").mapInArrow(
        run, "doc long, n long, ids binary, tf binary, code long"
    )
    return coded.repartitionByRange("code", "doc").sortWithinPartitions("code", "doc")


def _sections(docs, ids, impacts):
    """Cut similar documents into sections whose impacts fit a dense matrix."""
    if not docs:
        return
    terms, place = np.unique(np.concatenate(ids), return_inverse=True)
    if len(docs) > 1 and (len(docs) > SECTION or len(docs) * len(terms) > CELLS):
        half = len(docs) // 2
        yield from _sections(docs[:half], ids[:half], impacts[:half])
        yield from _sections(docs[half:], ids[half:], impacts[half:])
        return
    row = np.repeat(np.arange(len(docs)), [len(x) for x in ids])
    dense = np.zeros((len(docs), len(terms)), dtype=np.int64)
    dense[row, place] = np.concatenate(impacts)
    yield np.array(docs, dtype=np.int64), terms, dense


def _clusters(rows: np.ndarray) -> np.ndarray:
    """A block number per row: the pivot of greatest inner product."""
    pivots = max(1, len(rows) // BLOCK)
    if pivots == 1:
        return np.zeros(len(rows), dtype=np.int64)
    scaled = rows.astype(np.float64)
    chosen = scaled[np.linspace(0, len(rows) - 1, pivots).astype(int)]
    norm = np.sqrt((chosen * chosen).sum(axis=1))
    return np.argmax(scaled @ (chosen / np.maximum(norm, 1)[:, None]).T, axis=1)


def _built(plan: Plan, weights: Weights):
    """What turns similar documents into blocks of posting lists, batch by batch."""

    def section_blocks(docs, terms, dense):
        out = {"term": [], "members": [], "at": [], "most": []}
        for column in np.flatnonzero(plan.essential[terms]):
            term = int(terms[column])
            holders = np.flatnonzero(dense[:, column])
            if not len(holders):
                continue
            wanted = plan.coordinates(term)
            there = np.searchsorted(terms, wanted)
            there[there == len(terms)] = 0
            at = np.flatnonzero(terms[there] == wanted)
            rows = dense[np.ix_(holders, there[at])]
            block = _clusters(rows)
            order = np.argsort(block, kind="stable")
            starts = np.flatnonzero(np.diff(block[order], prepend=-1))
            most = np.maximum.reduceat(rows[order], starts, axis=0)
            for members, top in zip(np.split(docs[holders[order]], starts[1:]), most):
                held = np.flatnonzero(top)
                out["term"].append(term)
                out["members"].append(members.tobytes())
                out["at"].append(at[held].astype(np.int32).tobytes())
                out["most"].append(top[held].tobytes())
            if len(out["term"]) >= 4096:
                yield out
                out = {name: [] for name in out}
        if out["term"]:
            yield out

    def run(source):
        for batch in source:
            docs, ids, impacts = batch.column("doc").to_pylist(), [], []
            for n, i, tf in zip(*(batch.column(c).to_pylist() for c in ("n", "ids", "tf"))):
                i, tf = _arrays(i, tf)
                ids.append(i)
                impacts.append(weights.impacts(n, i, tf))
            for section in _sections(docs, ids, impacts):
                yield from section_blocks(*section)

    return run


def blocks(ordered: DataFrame, weights: Weights, plan: Plan) -> DataFrame:
    """The index as a table: (term, members, at, most), a row per block of a posting list.

    ``members`` are documents, ``most`` the greatest impacts of the members at the
    places ``at`` of the list's coordinates that are not 0.
    """
    built = _built(plan, weights)

    def run(source):
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
        for out in built(source):
            columns = [pa.array(v, k) for v, k in zip(out.values(), kinds)]
            yield pa.RecordBatch.from_arrays(columns, list(out))

    return ordered.mapInArrow(run, "term long, members binary, at binary, most binary")


def candidates(ordered: DataFrame, weights: Weights, plan: Plan) -> DataFrame:
    """(doc, item) of members of all blocks whose bound reaches the known score.

    Blocks are judged in the task that builds them.
    """
    built = _built(plan, weights)

    def run(source):
        summary = np.zeros(plan.items.size, dtype=np.int64)
        docs, found, size = [], [], 0

        def flush():
            pairs = [pa.array(np.concatenate(x)) for x in (docs, found)]
            docs.clear(), found.clear()
            return pa.RecordBatch.from_arrays(pairs, ["doc", "item"])

        for out in built(source):
            for term, members, at, most in zip(*out.values()):
                where = plan.coordinates(term)[np.frombuffer(at, np.int32)]
                summary[where] = np.frombuffer(most, np.int64)
                askers = np.array(plan.askers[term], dtype=np.int64)
                bound = plan.items.scores(summary, askers)
                summary[where] = 0
                reached = askers[(bound >= plan.known[askers]) & (bound > 0)]
                if len(reached):
                    members = np.frombuffer(members, np.int64)
                    docs.append(np.repeat(members, len(reached)))
                    found.append(np.tile(reached, len(members)))
                    size += len(docs[-1])
                    if size >= PAIRS:
                        yield flush()
                        size = 0
        if docs:
            yield flush()

    # A document meets an item in each list of its essential terms; one is enough.
    return ordered.mapInArrow(run, "doc long, item long").distinct()


def exact_scores(found: DataFrame, index: DataFrame, weights: Weights, plan: Plan) -> DataFrame:
    """(item, doc_id, score) of the candidates that reach the known score."""
    asked = found.groupBy("doc").agg(F.collect_list("item").alias("asked"))
    rows = index.join(asked, "doc").select("doc_id", "n", "ids", "tf", "asked")

    def run(source):
        impacts = np.zeros(plan.items.size, dtype=np.int64)
        for batch in source:
            items, places, scores = [], [], []
            columns = (batch.column(c).to_pylist() for c in ("n", "ids", "tf", "asked"))
            for place, (n, ids, tf, asked) in enumerate(zip(*columns)):
                ids, tf = _arrays(ids, tf)
                impacts[ids] = weights.impacts(n, ids, tf)
                asked = np.array(asked, dtype=np.int64)
                score = plan.items.scores(impacts, asked)
                impacts[ids] = 0
                reached = (score >= plan.known[asked]) & (score > 0)
                items.append(asked[reached])
                scores.append(score[reached])
                places.append(np.full(len(items[-1]), place))
            if items:
                place = pa.array(np.concatenate(places), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(items), pa.int64()),
                        batch.column("doc_id").take(place),
                        pa.array(np.concatenate(scores), pa.int64()),
                    ],
                    ["item", "doc_id", "score"],
                )

    kind = index.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"item long, doc_id {kind}, score long")


def _search_block(docs: DataFrame, asked: list, k: int, sample: int) -> DataFrame:
    items = Items([terms for _, terms in asked])
    index = staged(forward(docs, items), "forward")
    weights = statistics(index, items)
    known = known_scores(index, items, weights, k, sample)
    plan = Plan(items, greatest_impacts(index, items, weights), known, weights)
    found = candidates(similar_order(index, items, weights, plan), weights, plan)
    scored = exact_scores(found, index, weights, plan)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = docs.sparkSession.createDataFrame(
        [(i, row) for i, (row, _) in enumerate(asked)], "item long, row long"
    )
    return ranked.join(names, "item").select("row", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10, sample: int = SAMPLE) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item.

    Scores are those of the contract (BM25 in integers). Equal scores rank by
    ascending doc_id, null ids last; documents with score 0 are not ranked. Each
    row of ``docs`` (doc_id, text) is a document and each row of ``items``
    (item_id, text) an item, also if it repeats another one or has a null id; null
    and empty texts have no terms. Other columns are not read. No documents or no
    items, no rows.
    """
    spark: SparkSession = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = staged(
        items.select(
            F.monotonically_increasing_id().alias("row"),
            "item_id",
            F.regexp_extract_all(lower_ascii(text), F.lit(TERM), F.lit(0)).alias("terms"),
        ),
        "items",
    ).where(F.size("terms") > 0)
    size = rows.agg(F.sum(F.octet_length(F.array_join("terms", " ")).cast("long"))).first()[0] or 0
    n_blocks = -(-size // ITEM_BYTES)
    part = F.pmod(F.xxhash64("row"), F.lit(max(1, n_blocks)))
    found = []
    for b in range(n_blocks):
        asked = rows.where(part == b).select("row", "terms").collect()  # about ITEM_BYTES
        if asked:
            found.append(_search_block(docs, [tuple(r) for r in asked], k, sample))
    kind = docs.schema["doc_id"].dataType.simpleString()
    none = spark.createDataFrame([], f"row long, rank int, doc_id {kind}, score long")
    ranked = reduce(DataFrame.unionByName, found, none)
    return ranked.join(rows.select("row", "item_id"), "row").select(
        "item_id", "rank", "doc_id", "score"
    )
