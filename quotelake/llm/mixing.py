"""Mixing documents to target weights of domains with soft membership.

A classifier fitted on a labelled table gives each document a posterior over the
domains: naive Bayes over words, which backs off to the words of the whole sample
where a domain's labels do not show that it differs. Rates w >= 0, one per
document, then minimise

    |sum_i t_i w_i p_i - total * target|^2 + ridge * sum_i t_i (w_i - 1)^2

over token counts t and posteriors p, by projected gradient. The gradient of a
document needs only the residual, one number per domain, so an iteration is one
aggregation, and a rate is a fold over the residuals so far: nothing the size of
the table is stored between iterations.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import staged, words

TRAIN_ROWS = 20_000
UNIT = 1 << 30
PSEUDO = 0.5  # words added to a domain's count of a word and to the expected count


@dataclass(frozen=True)
class Membership:
    """Domains, log priors, log norms, and (token, w0, w1, ...): log ratios of telling words.

    The log probability of a text is the prior, less the norm for each token, and the
    ratio of each telling one, up to what all domains share.
    """

    domains: tuple[str, ...]
    priors: tuple[float, ...]
    norms: tuple[float, ...]
    telling: DataFrame
    rows: int  # fitted on


def tokens(text: Column) -> Column:
    """Hashes of the words, and of the shapes (letters as one) of words with other characters.

    A junk word that no labelled row has is still known by its shape.
    """
    shapes = words(F.regexp_replace(text, "\\p{L}+", "a"))
    return F.concat(
        F.transform(words(text), lambda w: F.xxhash64(w)),
        F.transform(
            F.filter(shapes, lambda w: w != "a"), lambda w: F.xxhash64(F.lit("shape"), w)
        ),
    )


def fit_membership(
    docs: DataFrame, labelled: DataFrame, domains: tuple[str, ...], train_rows: int = TRAIN_ROWS
) -> Membership:
    """Fit on at most ``train_rows`` labelled rows (doc_id, domain), those of least hash.

    A word is telling if the rows with it in some domain are sqrt(ln(rows)) deviations
    off what the domain's share of all rows gives, as by the Bayesian information
    criterion; in other domains it is, and all other words are, as frequent as in the
    whole sample. So a rare word speaks for no domain, however
    small. The driver gets a few numbers per domain. A domain without rows keeps
    flat weights and the prior of one row.
    """
    ids = (
        labelled.where(F.col("domain").isin(*domains) & F.col("doc_id").isNotNull())
        .orderBy(F.xxhash64("doc_id"), "doc_id", "domain")
        .limit(train_rows)
    )
    sample = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    sample = sample.select("domain", tokens(F.col("text")).alias("tokens"))

    def marked(found, n, rows):
        return F.transform(
            found, lambda x: F.struct(x.alias("token"), F.lit(n).alias("n"), F.lit(rows).alias("m"))
        )

    both = F.concat(marked(F.col("tokens"), 1, 0), marked(F.array_distinct("tokens"), 0, 1))

    def per_domain(column, name):
        return [
            F.sum(F.when(F.col("domain") == d, F.col(column)).otherwise(0)).alias(f"{name}{i}")
            for i, d in enumerate(domains)
        ]

    counts = staged(
        sample.select("domain", F.inline(both))
        .groupBy("token")
        .agg(*per_domain("n", "n"), *per_domain("m", "m")),
        "word_counts",
    )
    seen = dict(sample.groupBy("domain").count().collect())
    k = range(len(domains))
    said = counts.agg(*[F.coalesce(F.sum(f"n{i}"), F.lit(0)) for i in k]).first()
    rows = sum(seen.values()) + len(domains)
    deviations = math.sqrt(math.log(rows))
    shares = [(seen.get(d, 0) + 1) / rows for d in domains]
    everywhere = sum(F.col(f"n{i}") for i in k)
    with_word = sum(F.col(f"m{i}") for i in k)

    def ratio(i):
        by_rows = with_word * shares[i]
        off = F.abs(F.col(f"m{i}") - by_rows) >= deviations * F.sqrt(by_rows * (1 - shares[i]) + 1)
        expected = everywhere * (said[i] / max(sum(said), 1))
        return F.when(off, (F.col(f"n{i}") + PSEUDO) / (expected + PSEUDO)).otherwise(1.0)

    ratios = counts.select("token", everywhere.alias("n"), *[ratio(i).alias(f"r{i}") for i in k])
    ratios = staged(ratios.where(" OR ".join(f"r{i} <> 1" for i in k)), "telling_words")
    moved = ratios.agg(*[F.sum(F.col("n") * (F.col(f"r{i}") - 1)) for i in k]).first()
    return Membership(
        domains,
        tuple(map(math.log, shares)),
        tuple(math.log1p((x or 0.0) / max(sum(said), 1)) for x in moved),
        ratios.select("token", *[F.log(f"r{i}").alias(f"w{i}") for i in k]),
        sum(seen.values()),
    )


def memberships(docs: DataFrame, model: Membership) -> DataFrame:
    """(doc_id, t, p): number of words and posterior of each row; null text has none.

    The telling words are few and meet the words of a text in its own task; only one
    row per document is shuffled.
    """
    k = range(len(model.domains))
    split = docs.select(
        "doc_id",
        F.monotonically_increasing_id().alias("row"),
        F.size(words(F.col("text"))).alias("t"),
        tokens(F.coalesce("text", F.lit(""))).alias("tokens"),
    )
    each = split.select(
        "doc_id", "row", "t", F.size("tokens").alias("size"), F.explode_outer("tokens").alias("token")
    )
    sums = (
        each.join(F.broadcast(model.telling), "token", "left")
        .groupBy("row", "doc_id", "t", "size")
        .agg(*[F.coalesce(F.sum(f"w{i}"), F.lit(0.0)).alias(f"w{i}") for i in k])
    )
    logs = [model.priors[i] - F.col("size") * model.norms[i] + F.col(f"w{i}") for i in k]

    def softmax(found):
        top = F.array_max(found)
        up = F.transform(found, lambda x: F.exp(x - top))
        whole = F.aggregate(up, F.lit(0.0), lambda n, x: n + x)
        return F.transform(up, lambda x: x / whole)

    p = F.transform(F.array(F.array(*logs)), softmax)[0]
    return sums.select("doc_id", F.col("t").cast("double").alias("t"), p.alias("p"))


def _rate(steps: list[list[float]], ridge: float) -> Column:
    """The rate of a row after the given steps, each one number per domain."""
    if not steps:
        return F.lit(1.0)
    table = F.array(*[F.array(*map(F.lit, step)) for step in steps])

    def move(w, step):
        slope = F.aggregate(
            F.zip_with(F.col("p"), step, lambda p, q: p * q), F.lit(0.0), lambda n, x: n + x
        )
        return F.greatest(F.lit(0.0), w - slope - ridge * (w - 1.0))

    return F.aggregate(table, F.lit(1.0), move)


def solve_rates(
    members: DataFrame,
    targets: list[float],
    total: float | None = None,
    ridge: float = 1e-6,
    tolerance: float = 1e-6,
    iterations: int = 40,
) -> tuple[Column, list[float]]:
    """The rate as an expression over (t, p), and the token shares it reaches.

    ``targets`` are shares of ``total`` tokens; without a total it is the largest
    for which no domain has to be repeated. Steps are scaled per domain by its
    share of all tokens, which bounds the step length by one.
    """
    k, whole = len(targets), sum(targets)
    targets = [x / whole for x in targets]
    t, p = F.col("t"), F.col("p")

    def masses(rate):
        sums = [F.sum(t * rate * p[i]) for i in range(k)]
        return [x or 0.0 for x in members.agg(*sums).first()]

    share = masses(F.lit(1.0))
    if total is None:
        total = min((share[i] / x for i, x in enumerate(targets) if x > 0), default=0.0)
    steps, reached = [], share
    for _ in range(iterations):
        residual = [reached[i] - total * targets[i] for i in range(k)]
        if sum(map(abs, residual)) <= tolerance * max(total, 1.0):
            break
        steps.append([r / s if s > 0 else 0.0 for r, s in zip(residual, share)])
        reached = masses(_rate(steps, ridge))
    mass = sum(reached) or 1.0
    return _rate(steps, ridge), [x / mass for x in reached]


def mix(
    docs: DataFrame,
    labelled: DataFrame,
    targets: dict[str, float],
    total: float | None = None,
    rounding: str = "hash",
) -> DataFrame:
    """(doc_id, tokens, posterior, rate, copies) per row of ``docs``.

    ``labelled`` has (doc_id, domain); ``targets`` has the share of each domain.
    ``copies`` is the rate rounded up or down by a hash of doc_id, so that it has
    the rate as its mean, or with ``rounding="nearest"`` the nearest number, but not 0 unless the text
    makes the domains asked for less likely than the labels do. Without labelled rows
    all rates are 1. Null and empty texts have no tokens: they follow the prior
    and do not count. Repeated rows are rated one by one; a null doc_id is rated
    like others; an empty table gives no rows. Only doc_id and text are read.
    """
    domains = tuple(sorted(targets))
    model = fit_membership(docs, labelled, domains)
    members = staged(memberships(docs, model), "memberships")
    rate, _ = solve_rates(members, [targets[d] for d in domains], total)
    if not model.rows:
        rate = F.lit(1.0)
    rated = members.withColumn("rate", F.round(rate, 9))
    drawn = F.pmod(F.xxhash64(F.lit("copies"), "doc_id"), F.lit(UNIT)) / F.lit(float(UNIT))
    whole = F.floor("rate")
    up = drawn < F.col("rate") - whole
    if rounding == "nearest":
        up = F.col("rate") - whole >= 0.5
    copies = whole + F.coalesce(up, F.lit(False)).cast("long")
    if rounding == "nearest":
        asked = [i for i, d in enumerate(domains) if targets[d] > 0]
        known = sum(math.exp(model.priors[i]) for i in asked)
        unspoken = sum(F.col("p")[i] for i in asked) >= known - 1e-9
        copies = F.when(unspoken, F.greatest(copies, F.lit(1))).otherwise(copies).cast("long")
    return rated.select(
        "doc_id",
        F.col("t").cast("long").alias("tokens"),
        F.map_from_arrays(F.array(*map(F.lit, domains)), F.col("p")).alias("posterior"),
        "rate",
        copies.alias("copies"),
    )


def label_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) from the labels table: low, toxic or clean; null labels are left out."""
    domain = (
        F.when(F.col("quality") == 0, "low")
        .when((F.col("quality") == 1) & (F.col("toxic") == 1), "toxic")
        .when((F.col("quality") == 1) & (F.col("toxic") == 0), "clean")
    )
    return labels.select("doc_id", domain.alias("domain")).where(F.col("domain").isNotNull())
