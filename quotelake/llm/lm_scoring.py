"""Scoring of texts by a context-tree weighting model over bytes.

A text is read as its lower-cased words, each ended by a space, and an end
mark. Each byte is eight binary decisions; a decision has a node per context of
0 to DEPTH preceding bytes, with a Krichevsky-Trofimov estimate from training
counts. The weight of a node against its children follows from the training
data as in context-tree weighting, bottom up, and the mixture of all depths is
then resolved top down, so a (context, byte) has one price.

Only grams (context and byte) move between tasks. Documents are dealt to chunks
of bounded size; a chunk sends its distinct grams and words with training counts
and gets back their prices, so no task holds the model. Grams that agree in the
newest bytes of their context go to one of as many buckets as the size asks for,
packed as one row per chunk and bucket. Prices cover every gram of every document.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import staged

DEPTH = 6  # at most: a gram and its training bit fill 57 of 63 bits
CHUNK_BYTES = 32 << 20
ROOT = 3  # newest context bytes whose subtrees stay whole in one task
BLOCK = 4 << 20  # bytes of text a task counts at once
PRICED = 1 << 20  # bytes of text whose prices a task looks up at once
ANSWER = pa.schema(
    [("chunk", pa.int32()), ("size", pa.int64()), ("grams", pa.binary()), ("prices", pa.binary())]
)
END = 10  # the byte of the end mark; words hold no white space
SPACE = 32


def text_words(text: str | None) -> list[bytes]:
    """Words of a text with A-Z lower-cased; white space is space and the controls 9 to 13."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def grams(found: list[bytes], depth: int) -> np.ndarray:
    """For each byte to predict, the ``depth`` bytes before it and itself, as one integer."""
    raw = b" ".join(found) + bytes([SPACE] if found else []) + bytes([END])
    windows = np.ndarray(len(raw), ">i8", bytes([END]) * 7 + raw, strides=(1,))
    return windows.astype(np.int64) & (1 << 8 * (depth + 1)) - 1


def _rotated(gram: np.ndarray, depth: int) -> np.ndarray:
    """Grams with the ``_root(depth)`` newest context bytes moved to the front: subtrees lie together."""
    root = _root(depth)
    head = gram >> 8 & (1 << 8 * root) - 1
    return head << 8 * (depth - root + 1) | gram >> 8 * (root + 1) << 8 | gram & 255


def _turned_back(code: np.ndarray, depth: int) -> np.ndarray:
    """Grams as they were before ``_rotated``."""
    root = _root(depth)
    older = code >> 8 & (1 << 8 * (depth - root)) - 1
    return older << 8 * (root + 1) | code >> 8 * (depth - root + 1) << 8 | code & 255


def _root(depth: int) -> int:
    return min(ROOT, depth)


def _pack(values: np.ndarray) -> bytes:
    """Eight-byte numbers byte by byte of their places, compressed."""
    return pa.compress(
        np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T), codec="zstd", asbytes=True
    )


def _unpack(data: bytes, size: int, kind: type) -> np.ndarray:
    raw = pa.decompress(data, decompressed_size=8 * size, codec="zstd", asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(8, size)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with the sums of their counts."""
    if not len(keys):
        return keys, n
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(n[order], first)


def _ask(depth: int, buckets: int):
    """From a chunk's texts its distinct grams by bucket and its words, with training counts.

    A gram row holds those of one bucket, sorted, and a null word; the end of texts
    is the word "\\n".
    """
    low = 8 * (depth - _root(depth) + 1)

    def chunk(docs: pa.Table) -> pa.Table:
        learned, other = Counter(), Counter()
        found_grams, counts, parts, held = [], [], [], 0

        def count():
            # A code is a gram with a low bit that tells training rows apart.
            codes, n = np.unique(np.concatenate(parts), return_counts=True)
            n[codes & 1 == 0] = 0
            codes, first = np.unique(codes >> 1, return_index=True)
            found_grams.append(codes)
            counts.append(np.add.reduceat(n, first))
            parts.clear()
            if sum(map(len, found_grams)) > BLOCK:
                merge()

        def merge():
            codes, n = _summed(np.concatenate(found_grams), np.concatenate(counts))
            found_grams[:], counts[:] = [codes], [n]

        for learn, text in zip(
            docs.column("learn").to_pylist(), docs.column("text").to_pylist()
        ):
            found = text_words(text)
            parts.append(grams(found, depth) << 1 | int(learn))
            (learned if learn else other).update(found)
            (learned if learn else other)[b"\n"] += 1
            held += len(parts[-1])
            if held > BLOCK:
                count()
                held = 0
        if parts:
            count()
        merge()
        codes = _rotated(found_grams[0], depth)
        order = np.argsort(codes)
        codes, n = codes[order], counts[0][order]
        bucket = ((codes >> low) * 2654435761 >> 12 & 0xFFFFF) % buckets
        order = np.argsort(bucket, kind="stable")
        ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
        rows = []
        for k in np.flatnonzero(np.diff(ends)).tolist():
            at = order[ends[k] : ends[k + 1]]
            rows.append((k, len(at), _pack(np.diff(codes[at], prepend=0)), _pack(n[at])))
        names = list(learned.keys() | other.keys())
        blank, no_words = [None] * len(names), [None] * len(rows)
        columns = [list(c) for c in zip(*rows)]
        number = docs.column("chunk")[0].as_py()
        return pa.table(
            {
                "chunk": pa.array([number] * (len(rows) + len(names)), pa.int32()),
                "bucket": pa.array(columns[0] + blank, pa.int32()),
                "size": pa.array(columns[1] + blank, pa.int64()),
                "grams": pa.array(columns[2] + blank, pa.binary()),
                "counts": pa.array(columns[3] + blank, pa.binary()),
                "word": pa.array(no_words + names, pa.binary()),
                "n": pa.array(no_words + [learned[w] for w in names], pa.int64()),
            }
        )

    return chunk


def _log_gamma(x: Column) -> Column:
    """ln(gamma(x)) for x > 0: Stirling's series, eight steps further on."""
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    product = x
    for k in range(1, 8):
        product = product * (x + k)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - F.log(product)


def _log_kt(zeros: Column, ones: Column) -> Column:
    """The log of the Krichevsky-Trofimov probability of a node's training bits."""
    return (
        _log_gamma(zeros + 0.5)
        + _log_gamma(ones + 0.5)
        - _log_gamma(zeros + ones + 1)
        - math.log(math.pi)
    )


def _log_gammas(x: np.ndarray) -> np.ndarray:
    """As ``_log_gamma`` inside tasks."""
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    product = x.copy()
    for k in range(1, 8):
        product *= x + k
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - np.log(product)


class _Estimate:
    """As ``_log_kt`` inside tasks; most counts are small and looked up."""

    def __init__(self):
        self.small = {shift: _log_gammas(np.arange(4096) + shift) for shift in (0.5, 1.0)}

    def _of(self, n: np.ndarray, shift: float) -> np.ndarray:
        found = self.small[shift][np.minimum(n, 4095)]
        large = np.flatnonzero(n > 4095)
        found[large] = _log_gammas(n[large] + shift)
        return found

    def __call__(self, zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
        return (
            self._of(zeros, 0.5) + self._of(ones, 0.5) - self._of(zeros + ones, 1.0)
        ) - math.log(math.pi)


class _Subtrees:
    """The nodes of a bucket below contexts of ``_root(depth)`` bytes.

    ``levels`` goes from full depth up to the roots: the sorted distinct grams of a
    level, their counts, and for each the place of its gram one level up.
    """

    def __init__(self, asked: pa.Table, depth: int):
        sizes, codes, counts = (asked.column(c).to_pylist() for c in ("size", "grams", "counts"))
        self.asked = [np.cumsum(_unpack(c, m, np.int64)) for c, m in zip(codes, sizes)]
        n = [_unpack(c, m, np.int64) for c, m in zip(counts, sizes)]
        keys, n = _summed(np.concatenate(self.asked), np.concatenate(n))
        self.grams = keys
        self.levels = []
        for width in range(8 * (depth - _root(depth) + 1), 8, -8):
            shorter = keys >> width << width - 8 | keys & (1 << width - 8) - 1
            above, up = np.unique(shorter, return_inverse=True)
            self.levels.append((keys, n, up))
            keys, n = above, np.bincount(up, n, len(above)).astype(np.int64)
        self.levels.append((keys, n, None))
        self.log_kt = _Estimate()

    def nodes(self, k: int) -> list[dict[str, np.ndarray]]:
        """By level, the nodes that decide bit ``k`` of bytes, weighted bottom up."""
        found = []
        split = None
        for keys, n, up in self.levels:
            name = keys >> 8 - k
            new = np.append(True, name[1:] != name[:-1])
            first, place = np.flatnonzero(new), np.cumsum(new) - 1
            bit = keys >> 7 - k & 1
            ones = np.add.reduceat(n * bit, first)
            zeros = np.add.reduceat(n, first) - ones
            kt = self.log_kt(zeros, ones)
            if found:
                below = found[-1]
                below["parent"] = place[below.pop("up")]
                split = np.bincount(below["parent"], below["weighted"], len(first))
                weighted = np.logaddexp(kt, split) - math.log(2)
            else:
                weighted = kt
            found.append(
                {
                    "name": name[first],
                    "place": place,
                    "bit": bit,
                    "zeros": zeros,
                    "ones": ones,
                    "kt": kt,
                    "weighted": weighted,
                    "up": None if up is None else up[first],
                }
            )
        return found


def _above_roots(name: np.ndarray, k: int, depth: int) -> np.ndarray:
    """(context, node) one byte above the roots, as one integer, of roots' nodes."""
    context = name >> k & (1 << 8 * (_root(depth) - 1)) - 1
    return context << 8 | name & (1 << k) - 1 | 1 << k


def _sums(depth: int):
    """From a bucket's grams what its roots add to the nodes above them."""

    def bucket(asked: pa.Table) -> pa.Table:
        trees = _Subtrees(asked, depth)
        parts = []
        for k in range(8):
            roots = trees.nodes(k)[-1]
            keys, place = np.unique(_above_roots(roots["name"], k, depth), return_inverse=True)
            sums = [np.bincount(place, roots[c], len(keys)) for c in ("zeros", "ones", "weighted")]
            parts.append((keys, *sums))
        keys, zeros, ones, split = (np.concatenate(c) for c in zip(*parts))
        number = asked.column("bucket")[0].as_py()
        return pa.table(
            {
                "bucket": np.full(len(keys), number, np.int32),
                "context": keys >> 8,
                "node": (keys & 255).astype(np.int32),
                "zeros": zeros,
                "ones": ones,
                "split": split,
            }
        )

    return bucket


def _mixed(level: DataFrame) -> DataFrame:
    """A level with its weighted probability and the weight of its own estimate."""
    level = level.withColumn("kt", _log_kt(F.col("zeros"), F.col("ones")))
    high, low = F.greatest("kt", "split"), F.least("kt", "split")
    mixed = math.log(0.5) + high + F.log1p(F.exp(low - high))
    level = level.withColumn("weighted", mixed)
    own = F.exp(F.least(F.lit(0.0), math.log(0.5) + F.col("kt") - F.col("weighted")))
    return level.select("context", "node", "zeros", "ones", "weighted", own.alias("own"))


def _tree(sums: DataFrame, root: int) -> DataFrame:
    """(context, node, said, left, last) of the contexts of ``root - 1`` bytes.

    The weights are found bottom up. Top down, ``said`` is what nodes down to this
    one say, ``left`` the weight left for deeper ones, and ``last`` the chance of a 1 if
    there is nothing deeper. A node without training bits passes its parent's on.
    """
    added = [F.sum(c).alias(c) for c in ("zeros", "ones", "split")]
    levels = {root - 1: staged(_mixed(sums.groupBy("context", "node").agg(*added)), "ctw")}
    for d in range(root - 2, -1, -1):
        up = F.col("context").bitwiseAND(F.lit((1 << 8 * d) - 1))
        level = (
            levels[d + 1]
            .groupBy(up.alias("context"), "node")
            .agg(
                F.sum("zeros").alias("zeros"),
                F.sum("ones").alias("ones"),
                F.sum("weighted").alias("split"),
            )
        )
        levels[d] = staged(_mixed(level), "ctw")
    seen = F.col("zeros") + F.col("ones") > 0
    chance = (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1)
    above = None
    for d in range(root):
        level = levels[d].select("context", "node", chance.alias("kt"), seen.alias("seen"), "own")
        if above is None:
            level = level.withColumn("said", F.lit(0.0)).withColumn("left", F.lit(1.0))
            level = level.withColumn("last", F.lit(0.5))
        else:
            up = F.col("context").bitwiseAND(F.lit((1 << 8 * (d - 1)) - 1))
            level = level.withColumn("up", up).join(
                above.withColumnRenamed("context", "up"), ["up", "node"]
            )
        one = F.when(F.col("seen"), F.col("said") + F.col("left") * F.col("kt")).otherwise(
            F.col("last")
        )
        above = level.select(
            "context",
            "node",
            (F.col("said") + F.col("left") * F.col("own") * F.col("kt")).alias("said"),
            (F.col("left") * (1 - F.col("own"))).alias("left"),
            one.alias("last"),
        )
    return above


def _answers(depth: int):
    """To each chunk that asked a bucket the prices of its grams, top down from the roots."""

    def bucket(asked: pa.Table, above: pa.Table) -> pa.Table:
        if not asked.num_rows:
            return ANSWER.empty_table()
        trees = _Subtrees(asked, depth)
        names = above.column("context").to_numpy() << 8 | above.column("node").to_numpy()
        order = np.argsort(names)
        names = names[order]
        given = [above.column(c).to_numpy()[order] for c in ("said", "left", "last")]
        price = np.zeros(len(trees.grams))
        for k in range(8):
            levels = trees.nodes(k)
            at = np.searchsorted(names, _above_roots(levels[-1]["name"], k, depth))
            said, left, last = (c[at] for c in given)
            for d in range(len(levels) - 1, -1, -1):
                level = levels[d]
                total = level["zeros"] + level["ones"]
                chance = (level["ones"] + 0.5) / (total + 1)
                one = np.where(total > 0, said + left * chance, last)
                if d:
                    own = np.exp(np.minimum(0, math.log(0.5) + level["kt"] - level["weighted"]))
                    parent = levels[d - 1]["parent"]
                    said = (said + left * own * chance)[parent]
                    left, last = (left * (1 - own))[parent], one[parent]
            leaves = levels[0]
            ones = one[leaves["place"]]
            price += np.log10(np.where(leaves["bit"] == 1, ones, 1 - ones))
        return pa.table(
            {
                "chunk": asked.column("chunk"),
                "size": asked.column("size"),
                "grams": asked.column("grams"),
                "prices": pa.array(
                    [_pack(price[np.searchsorted(trees.grams, c)]) for c in trees.asked],
                    pa.binary(),
                ),
            }
        )

    return bucket


def gram_prices(asked: DataFrame, depth: int) -> DataFrame:
    """(chunk, size, grams, prices): log10 of the chance of each gram's byte after its context.

    Subtrees of contexts that agree in their newest bytes stay arrays in the task of
    their bucket; the few nodes above, which all buckets add to, are tables.
    """
    buckets = asked.groupBy("bucket")
    sums = staged(
        buckets.applyInArrow(
            _sums(depth),
            "bucket int, context long, node int, zeros double, ones double, split double",
        ),
        "sums",
    )
    above = sums.select("bucket", "context", "node").join(
        _tree(sums, _root(depth)), ["context", "node"]
    )
    return buckets.cogroup(above.groupBy("bucket")).applyInArrow(
        _answers(depth), "chunk int, size long, grams binary, prices binary"
    )


def _score(base_total: int, base_kinds: int, depth: int):
    unit = base_total + 0.5 * (base_kinds + 1)

    def chunk(docs: pa.Table, prices: pa.Table) -> pa.Table:
        sent = prices.filter(prices.column("grams").is_valid())
        sizes, packed, priced = (sent.column(c).to_pylist() for c in ("size", "grams", "prices"))
        codes = np.concatenate(
            [np.cumsum(_unpack(c, m, np.int64)) for c, m in zip(packed, sizes)]
        )
        cost = np.concatenate([_unpack(c, m, np.float64) for c, m in zip(priced, sizes)])
        codes = _turned_back(codes, depth)
        order = np.argsort(codes)
        codes, cost = codes[order], cost[order]
        named = prices.filter(prices.column("word").is_valid())
        known = dict(zip(named.column("word").to_pylist(), named.column("n").to_pylist()))
        rows = {k: [] for k in ("doc_id", "learn", "n_tokens", "n_known", "base_score", "score")}
        parts, held = [], 0

        def price():
            # Sorted grams are found in a fraction of the time of scattered ones.
            block = np.concatenate(parts)
            order = np.argsort(block)
            costs = np.empty(len(block))
            costs[order] = cost[np.searchsorted(codes, block[order])]
            starts = np.cumsum([0, *map(len, parts[:-1])])
            rows["score"].extend(np.add.reduceat(costs, starts).tolist())
            parts.clear()

        for doc_id, learn, text in zip(
            docs.column("doc_id").to_pylist(),
            docs.column("learn").to_pylist(),
            docs.column("text").to_pylist(),
        ):
            found = text_words(text)
            found.append(b"\n")
            counts = np.fromiter(map(known.__getitem__, found), np.float64, len(found))
            rows["doc_id"].append(doc_id)
            rows["learn"].append(learn)
            rows["n_tokens"].append(len(counts))
            rows["n_known"].append(int((counts > 0).sum()))
            rows["base_score"].append(float(np.log10((counts + 0.5) / unit).sum()))
            parts.append(grams(found[:-1], depth))
            held += len(parts[-1])
            if held > PRICED:
                price()
                held = 0
        if parts:
            price()
        return pa.table(
            rows,
            schema=pa.schema(
                [
                    ("doc_id", pa.int64()),
                    ("learn", pa.bool_()),
                    ("n_tokens", pa.int64()),
                    ("n_known", pa.int64()),
                    ("base_score", pa.float64()),
                    ("score", pa.float64()),
                ]
            ),
        )

    return chunk


def score_texts(
    docs: DataFrame,
    learn: Column,
    depth: int = DEPTH,
    chunk_bytes: int = CHUNK_BYTES,
    least_chunks: int = 16,
) -> DataFrame:
    """(doc_id, learn, n_tokens, n_known, train_tokens, base_score, score) per row.

    ``learn`` marks the rows the model learns from (null: no). ``base_score`` is the
    log10 probability under smoothed counts of tokens, ``score`` that under the
    context trees; code length per byte is ``-score * log2(10)`` over the bytes. Null
    and empty texts are an end mark. Without rows to learn from all bytes are
    equally likely. Rows that repeat a doc_id are scored one by one; an empty
    table gives no rows; doc_id, text and what ``learn`` names are read.
    """
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    chunks = max(least_chunks, -(-size // chunk_bytes))
    dealt = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(learn, F.lit(False)).alias("learn"),
        F.col("text").cast("string").alias("text"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int").alias("chunk"),
    )
    used = staged(
        dealt.select("chunk", "learn", "text").groupBy("chunk").applyInArrow(
            _ask(depth, 2 * chunks),
            "chunk int, bucket int, size long, grams binary, counts binary, word binary, n long",
        ),
        "used",
    )
    asked = used.where(F.col("bucket").isNotNull()).drop("word", "n")
    word_rows = used.where(F.col("word").isNotNull()).select("chunk", "word", "n")
    words = staged(word_rows.groupBy("word").agg(F.sum("n").alias("n")), "words")
    total, kinds = words.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum((F.col("n") > 0).cast("int")), F.lit(0))
    ).first()
    needed = gram_prices(asked, depth).unionByName(
        word_rows.drop("n").join(words, "word"), allowMissingColumns=True
    )
    scored = (
        dealt.groupBy("chunk")
        .cogroup(needed.groupBy("chunk"))
        .applyInArrow(
            _score(total, kinds, depth),
            "doc_id long, learn boolean, n_tokens long, n_known long, base_score double, score double",
        )
    )
    return scored.withColumn("train_tokens", F.lit(total).cast("long"))
