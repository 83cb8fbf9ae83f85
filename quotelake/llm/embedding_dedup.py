"""Near-duplicate vectors from sign hashes of random hyperplanes in several tables.

Vectors meet in a table when all their signs agree. A pair is judged, by cosine
in double precision, in the first table in which it meets, so each link is
counted once without a list of links. A bucket is cut into blocks and pairs of
blocks, each a group of bounded size; a group gives link counts per vector and
at most one edge per vector, enough to connect what its links connect.

Equal vectors are one vertex with a weight. With 8 signs and 24 tables a pair at
cosine 0.93 is missed with a chance below 3e-5, a closer one less often.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import staged
from quotelake.llm.components import components

SIGNS, TABLES, BLOCK = 8, 24, 1024


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, vec) of rows that can have links."""
    clean = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    ) & F.exists("embedding", lambda x: x != 0)
    return vectors.where(
        F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.coalesce(clean, F.lit(False))
    ).select(
        F.col("vec_id").cast("long"),
        F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("vec"),
    )


def hashed(heads: DataFrame, signs: int, tables: int) -> DataFrame:
    """Each head once per table, with the codes of all tables as bytes."""

    def batches(source):
        planes = {}
        for batch in source:
            for c, label, weight, vec in zip(*(col.to_pylist() for col in batch.columns)):
                x = np.asarray(vec, dtype=np.float64)
                x = x / np.abs(x).max()
                x = x / np.sqrt(x @ x)
                if len(x) not in planes:
                    rng = np.random.default_rng((20240131, len(x)))
                    planes[len(x)] = rng.standard_normal((tables * signs, len(x)))
                bits = (planes[len(x)] @ x > 0).reshape(tables, signs)
                codes = bits @ (1 << np.arange(signs))
                key = codes.astype(">u4").tobytes()
                yield pa.RecordBatch.from_pydict(
                    {
                        "label": [label] * tables,
                        "dim": [len(x)] * tables,
                        "t": np.arange(tables, dtype=np.int32),
                        "code": codes.astype(np.int64),
                        "c": [c] * tables,
                        "w": [weight] * tables,
                        "codes": [key] * tables,
                        "vec": [x.tobytes()] * tables,
                    },
                    schema=pa.schema(
                        [
                            ("label", pa.string()),
                            ("dim", pa.int32()),
                            ("t", pa.int32()),
                            ("code", pa.int64()),
                            ("c", pa.int64()),
                            ("w", pa.int64()),
                            ("codes", pa.binary()),
                            ("vec", pa.binary()),
                        ]
                    ),
                )

    return heads.select("c", "label", "weight", "vec").mapInArrow(
        batches,
        "label string, dim int, t int, code long, c long, w long, codes binary, vec binary",
    )


def _judge(threshold: float):
    def group(table: pa.Table) -> pa.Table:
        t = table.column("t")[0].as_py()
        block = np.asarray(table.column("block"))
        mine, theirs = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        ids = np.asarray(table.column("c"))
        weight = np.asarray(table.column("w"))
        vecs = np.frombuffer(b"".join(table.column("vec").to_pylist())).reshape(len(ids), -1)
        codes = np.frombuffer(b"".join(table.column("codes").to_pylist()), dtype=">u4")
        codes = codes.reshape(len(ids), -1)
        left, right = np.flatnonzero(block == mine), np.flatnonzero(block == theirs)
        links = vecs[left] @ vecs[right].T >= threshold
        for u in range(t):  # met in an earlier table: judged there
            links &= codes[left, u][:, None] != codes[right, u][None, :]
        if mine == theirs:
            np.fill_diagonal(links, False)
        counts = np.zeros(len(ids), np.int64)
        counts[left] += links @ weight[right]
        if mine != theirs:
            counts[right] += links.T @ weight[left]
        # Spread the smallest position over what is linked.
        root = np.arange(len(ids))
        while True:
            low = np.where(links, root[right][None, :], len(ids)).min(axis=1, initial=len(ids))
            up = np.where(links, root[left][:, None], len(ids)).min(axis=0, initial=len(ids))
            new = root.copy()
            np.minimum.at(new, left, low)
            np.minimum.at(new, right, up)
            new = new[new]
            if (new == root).all():
                break
            root = new
        linked = counts > 0
        return pa.table(
            {
                "c": ids[linked],
                "root": ids[root[linked]],
                "links": counts[linked],
            }
        )

    return group


def near_vectors(
    vectors: DataFrame,
    threshold: float = 0.93,
    signs: int = SIGNS,
    tables: int = TABLES,
    block: int = BLOCK,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``vectors``.

    Rows link when their labels are equal and the cosine reaches the threshold.
    A row links with nothing when its label or vector is null, the vector is
    empty or zero, holds nulls or non-finite values, or has another length. Equal vectors of one
    label link with each other; a row without vec_id stays alone. An empty table
    gives no rows; columns besides vec_id, label and embedding are not read.
    """
    rows = staged(
        usable(vectors).select(
            "*", F.xxhash64("vec").alias("h1"), F.xxhash64(F.lit("second"), "vec").alias("h2")
        ),
        "vectors",
    )
    classes = staged(
        rows.groupBy("label", "h1", "h2").agg(
            F.min("vec_id").alias("c"), F.count("*").alias("weight")
        ),
        "classes",
    )
    heads = (
        classes.join(rows.select(F.col("vec_id").alias("c"), "h1", "h2", "vec"), ["c", "h1", "h2"])
        .dropDuplicates(["c", "label", "h1", "h2"])
        .select("c", "label", "weight", "vec")
    )
    placed = staged(hashed(heads, signs, tables), "signs")
    bucket = ["label", "dim", "t", "code"]
    sizes = placed.groupBy(*bucket).agg(F.count("*").alias("n")).where(F.col("n") > 1)
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    cut = (
        placed.join(sizes, bucket)
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "*",
            F.least("block", "other").alias("i"),
            F.greatest("block", "other").alias("j"),
        )
        .drop("other", "n", "blocks")
    )
    judged = staged(
        cut.groupBy(*bucket, "i", "j").applyInArrow(
            _judge(threshold), "c long, root long, links long"
        ),
        "judged",
    )
    counts = judged.groupBy("c").agg(F.sum("links").alias("links"))
    found = components(judged.select(F.col("c").alias("a"), F.col("root").alias("b")))
    named = (
        classes.join(counts, "c", "left")
        .join(found.withColumnRenamed("v", "c"), "c", "left")
        .select(
            "label",
            "h1",
            "h2",
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component", "c").alias("component"),
        )
    )
    linked = rows.select("vec_id", "label", "h1", "h2").join(named, ["label", "h1", "h2"])
    linked = linked.select("vec_id", "n_links", "component").dropDuplicates(["vec_id"])
    out = vectors.select(F.col("vec_id").cast("long")).join(linked, "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
