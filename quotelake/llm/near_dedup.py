"""Near-duplicate documents from bottom-k sketches of one hash function.

The k smallest shingle hashes of a document are its sketch. Documents whose
Jaccard similarity is at least t share, but for a chance below 1e-5, a number
``need`` of the values in two sketches (five standard deviations below the mean;
small sets are whole in their sketch and share what t asks), so a link must show
in the inverted lists of the rarest ``size - need + 1`` values of each side.
Passages that many documents share fall outside these lists unless they make up
the documents. On the full sets of what is listed, shingles that one set alone
holds bound the similarity of its document with any other.

Within a list a hub is compared with all members first; it shares most of its set,
so that most copies of one text join there. Members of different components are
then compared where the bound allows it, a long list in blocks. The union of two
sketches estimates similarity, and what may reach t is confirmed on the full sets.

Documents with equal sets are one vertex throughout: the row of a stored table of
the sets, so that a doc_id may stand for several texts.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import staged
from quotelake.llm.components import components
from quotelake.llm.shingles import Shingler, mix

SKETCH = 32
BLOCK = 512  # members of a list that one task compares with the others


def least_overlap(percent: int, k: int) -> int:
    """Values two sketches share at the similarity, less five standard deviations."""
    t = percent / 100
    return max(1, math.floor(k * t - 5 * math.sqrt(k * t * (1 - t))))


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0] + [len(p) for p in parts])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))


def _names(found: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set of shingles."""
    spread = mix(found.view(np.uint64))
    first = int(spread.sum(dtype=np.uint64).view(np.int64))
    spread = mix(spread + np.uint64(0x632BE59BD9B4E019))
    return first, int(spread.sum(dtype=np.uint64).view(np.int64))


def sketches(docs: DataFrame, width: int, k: int = SKETCH) -> DataFrame:
    """(doc_id, n, h1, h2, sketch): set size, 128 bits that name the set, its k least values."""

    def batches(source):
        shingler = Shingler(width)
        for batch in source:
            ids, texts = batch.column(0), batch.column(1)
            n, h1, h2, parts = [], [], [], []
            for text in texts:
                found = shingler.of(text.as_py())
                first, second = _names(found)
                n.append(len(found))
                h1.append(first)
                h2.append(second)
                parts.append(found[:k])
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(n, pa.int64()),
                    pa.array(h1, pa.int64()),
                    pa.array(h2, pa.int64()),
                    _lists(parts),
                ],
                names=["doc_id", "n", "h1", "h2", "sketch"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        batches, "doc_id long, n long, h1 long, h2 long, sketch array<long>"
    )


def full_sets(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, h1, h2, full): all distinct shingles, sorted, and the bits that name them."""

    def batches(source):
        shingler = Shingler(width)
        for batch in source:
            sets = [shingler.of(t.as_py()) for t in batch.column(1)]
            names = [_names(found) for found in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([a for a, _ in names], pa.int64()),
                    pa.array([b for _, b in names], pa.int64()),
                    _lists(sets),
                ],
                names=["doc_id", "h1", "h2", "full"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        batches, "doc_id long, h1 long, h2 long, full array<long>"
    )


def _need(size, percent: int, k: int):
    whole = F.ceil(size * F.lit(percent) / F.lit(100))
    return F.least(whole, F.lit(least_overlap(percent, k))).cast("int")


def prefix_lists(heads: DataFrame, percent: int, k: int) -> DataFrame:
    """(v, c, n): postings of the rarest values of each sketch that can show a link."""
    postings = heads.select("c", "n", F.size("sketch").alias("s"), F.explode("sketch").alias("v"))
    shared = postings.groupBy("v").agg(F.count("*").alias("df")).where(F.col("df") > 1)
    need = _need(F.col("s"), percent, k)
    # Values of one document come first in the order of rarity and lead nowhere.
    ranked = (
        postings.join(shared, "v")
        .groupBy("c", "n", "s")
        .agg(F.array_sort(F.collect_list(F.struct("df", "v"))).alias("rare"))
        .where(F.size("rare") >= need)
    )
    return ranked.select(
        "c", "n", F.explode(F.slice("rare", 1, F.size("rare") - need + 1)).alias("x")
    ).select("c", "n", F.col("x.v").alias("v"))


def _sized(pairs: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b), a < b, whose sizes allow the similarity."""
    small, large = F.least("na", "nb"), F.greatest("na", "nb")
    return (
        pairs.where(100 * small >= percent * large)
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def _estimated(pairs: DataFrame, heads: DataFrame, percent: int, k: int) -> DataFrame:
    """Pairs whose similarity in the union of both sketches may reach the one asked for."""
    left = heads.select(F.col("c").alias("a"), F.col("sketch").alias("sa"))
    right = heads.select(F.col("c").alias("b"), F.col("sketch").alias("sb"))
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
    both = F.size(F.array_intersect(F.array_intersect("sa", "sb"), F.col("u")))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .withColumn("u", union)
        .where(k * both >= (least_overlap(percent, k) - 1) * F.size("u"))
        .select("a", "b")
    )


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs with ``met``, the size of their sets' intersection, and whether they link."""
    full_a = sets.select(F.col("c").alias("a"), F.col("full").alias("fa"))
    full_b = sets.select(F.col("c").alias("b"), F.col("full").alias("fb"))
    met = F.size(F.array_intersect("fa", "fb"))
    both = F.size("fa") + F.size("fb")
    return (
        pairs.join(full_a, "a")
        .join(full_b, "b")
        .select("a", "b", met.alias("met"), both.alias("both"))
        .select(
            "a", "b", "met", (100 * F.col("met") >= percent * (F.col("both") - F.col("met"))).alias("ok")
        )
    )


def shared_sizes(sets: DataFrame) -> DataFrame:
    """(c, shared): how many shingles of a set are in another set too.

    Counted from the shingles of a single set, so a shingle crosses the network
    once, and once per task if many sets of the task hold it.
    """
    holders = (
        sets.select("c", F.explode("full").alias("x"))
        .groupBy("x")
        .agg(F.count("*").alias("n"), F.min("c").alias("c"))
    )
    own = holders.where(F.col("n") == 1).groupBy("c").agg(F.count("*").alias("own"))
    sizes = sets.select("c", F.size("full").cast("long").alias("n"))
    return sizes.join(own, "c", "left").select(
        "c", (F.col("n") - F.coalesce("own", F.lit(0))).alias("shared")
    )


def _reach(n, shared, percent: int):
    """The largest size a linked set can have: no pair meets in more than is shared."""
    return F.floor(shared * F.lit(100 + percent) / F.lit(percent)) - n


def _hubs(lists: DataFrame) -> DataFrame:
    """Each list's hub on its rows: the member that shares the largest part of its set."""
    ranked = F.struct(
        (-F.col("shared") / F.col("n")).alias("r"), F.xxhash64("c").alias("o"), "c", "n", "reach"
    )
    hubs = lists.groupBy("v").agg(F.min(ranked).alias("hub"), F.count("*").alias("all"))
    hubs = hubs.where(F.col("all") > 1).select(
        "v",
        "all",
        F.col("hub.c").alias("hub"),
        F.col("hub.n").alias("hub_n"),
        F.col("hub.reach").alias("hub_reach"),
    )
    return lists.join(hubs, "v")


def link_components(
    docs: DataFrame, marks: DataFrame, percent: int, width: int, k: int = SKETCH
) -> DataFrame:
    """(v, component) over the sets of ``marks`` (c, doc_id, h1, h2, n, sketch)."""
    lists = staged(prefix_lists(marks, percent, k), "lists")
    wanted = marks.join(lists.select("c").distinct(), "c", "left_semi")
    named = ["doc_id", "h1", "h2"]
    found = full_sets(
        docs.select("doc_id", "text").join(wanted.select("doc_id").distinct(), "doc_id"), width
    )
    sets = staged(
        found.dropDuplicates(named).join(wanted.select("c", *named), named).select("c", "full"),
        "sets",
    )
    # Sets that share too little with all others together have no link.
    reach = shared_sizes(sets)
    lists = lists.join(reach, "c").where(100 * F.col("shared") >= percent * F.col("n"))
    lists = staged(
        lists.withColumn("reach", _reach(F.col("n"), F.col("shared"), percent)), "reach"
    )
    heads = staged(
        marks.select("c", "sketch").join(lists.select("c").distinct(), "c", "left_semi"), "heads"
    )
    hubbed = staged(_hubs(lists), "hubs")
    pairs = hubbed.where(
        (F.col("c") != F.col("hub"))
        & (F.col("hub_n") <= F.col("reach"))
        & (F.col("n") <= F.col("hub_reach"))
    ).select(
        F.col("c").alias("a"),
        F.col("n").alias("na"),
        F.col("hub").alias("b"),
        F.col("hub_n").alias("nb"),
    )
    likely = _estimated(_sized(pairs, percent), heads, percent, k)
    judged = staged(_confirmed(likely, sets, percent), "judged")
    links = judged.where("ok").select("a", "b")
    names = staged(components(links), "components").withColumnRenamed("v", "c")
    # What each row and its list's hub have in common, where compared.
    ends = [("a", "b"), ("b", "a")]
    mets = [judged.select(F.col(x).alias("hub"), F.col(y).alias("c"), "met") for x, y in ends]
    own = F.when(F.col("hub") == F.col("c"), F.col("n").cast("int"))
    members = (
        hubbed.select("v", "all", "hub", "c", "n", "shared", "reach")
        .join(mets[0].unionByName(mets[1]), ["hub", "c"], "left")
        .withColumn("met", F.coalesce(own, "met"))
        .join(names, "c", "left")
        .withColumn("component", F.coalesce("component", "c"))
        .drop("hub")
    )
    found = _estimated(
        _sized(_rest(staged(members, "members"), percent), percent), heads, percent, k
    )
    fresh = staged(_confirmed(found, sets, percent), "judged").where("ok").select("a", "b")
    return components(links.unionByName(fresh))


def _rest(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that can still link, each in one list.

    A row outside its list's main component (the one of most rows) meets that
    component's rows and, once, the other rows. What both have in common is in the
    hub too, or among what each shares with others beside it. The rows met are dealt to
    blocks of bounded size, so a list of many copies is many tasks' work.
    """
    sizes = members.groupBy("v", "component").agg(
        F.count("*").alias("rows"), F.min("n").alias("least")
    )
    mains = sizes.groupBy("v").agg(
        F.max(F.struct("rows", "component")).alias("best"),
        F.sum("rows").alias("total"),
        F.min("least").alias("least"),
    )
    # Lists of one component are done.
    mains = mains.where(F.col("total") > F.col("best.rows")).select(
        "v", "least", F.col("best.component").alias("main")
    )
    rows = staged(members.join(mains, "v"), "open")
    # Each pair counts in the least of the lists that hold both.
    places = staged(rows.groupBy("c").agg(F.collect_set("v").alias("places")), "places")
    columns = ["c", "n", "component", "shared", "reach", "met", "places"]
    blocks = F.ceil(F.col("all") / F.lit(BLOCK)).cast("int")
    outside = (F.col("component") != F.col("main")) & (F.col("reach") >= F.col("least"))
    mine = (
        rows.where(outside)
        .join(places, "c")
        .select("v", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), *columns)
    )
    other = rows.join(places, "c").select(
        "v",
        F.pmod(F.xxhash64("c"), blocks).cast("int").alias("block"),
        "main",
        *[F.col(c).alias(f"{c}_") for c in columns],
    )
    beside = F.least(F.col("shared") - F.col("met"), F.col("shared_") - F.col("met_"))
    most = F.when(
        F.col("met").isNotNull() & F.col("met_").isNotNull(), F.least("met", "met_") + beside
    ).otherwise(F.least("shared", "shared_"))
    met_in = F.array_min(F.array_intersect("places", "places_"))
    pairs = mine.join(
        other,
        (mine["v"] == other["v"])
        & (mine["block"] == other["block"])
        & (F.col("component") != F.col("component_"))
        & ((F.col("component_") == F.col("main")) | (F.col("c") < F.col("c_")))
        & (F.col("n_") <= F.col("reach"))
        & (F.col("n") <= F.col("reach_"))
        & ((100 + percent) * most >= percent * (F.col("n") + F.col("n_")))
        & (met_in == mine["v"]),
    )
    return pairs.select(
        F.col("c").alias("a"), F.col("n").alias("na"), F.col("c_").alias("b"), F.col("n_").alias("nb")
    )


def near_duplicates(
    docs: DataFrame, percent: int = 80, width: int = 5, k: int = SKETCH
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs`` (doc_id, text are read).

    Linked documents have ``100 * intersection >= percent * union`` over distinct
    shingles of ``width`` words. A null or blank text has none and links with
    nothing; a shorter text is one shingle. Ties do not arise: a component is
    named by its smallest doc_id. Rows that repeat a doc_id are joined by their
    texts only, two texts under one doc_id are two documents; a row without doc_id
    takes no part and stays (component null).
    """
    rows = staged(sketches(docs.select("doc_id", "text"), width, k), "sketches")
    real = rows.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    # Equal sets have equal sizes and sketches.
    marks = real.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("sketch").alias("sketch")
    )
    # Stored, so that a row keeps its number.
    marks = staged(marks.withColumn("c", F.monotonically_increasing_id()), "marks")
    found = link_components(docs, marks, percent, width, k).withColumnRenamed("v", "c")
    classes = marks.select("c", "doc_id", "h1", "h2")
    linked = staged(classes.join(found, "c"), "linked")
    least = linked.groupBy("component").agg(F.min("doc_id").alias("least"))
    least = linked.select("c", "component").join(least, "component").select("c", "least")
    named = classes.join(least, "c", "left").select(
        "h1", "h2", F.coalesce("least", "doc_id").alias("component")
    )
    usable = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("h1"))
    joined = rows.select("doc_id", "n", usable.alias("h1"), "h2").join(named, ["h1", "h2"], "left")
    component = F.coalesce("component", "doc_id")
    return joined.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
