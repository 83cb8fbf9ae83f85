"""Quality rules as a short-circuit cascade.

Rules are predicates over statistics of a text. Each rule's cost (seconds) and
selectivity (share it rejects) are measured on a bounded sample; rules that
reject most per second come first. A document meets a rule only if the ones
before let it pass, as a chain of CASE branches; statistics a caller wants
reported are computed for every row and shared with the rules. The order changes
cost and the name of the first rule that rejects, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import free_prefix, words
from quotelake.llm.line_dedup import lines_of

WINDOW = 8
SYMBOLS = "[#*$%&|<>]"
SAMPLE_DOCS = 2000


@dataclass(frozen=True)
class Rule:
    """``rejects`` takes a lookup of statistics by name and gives true for a bad text."""

    name: str
    rejects: Callable[[Callable[[str], Column]], Column]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is evaluated once, also inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def n_symbols(text: Column) -> Column:
    return (F.char_length(text) - F.char_length(F.regexp_replace(text, SYMBOLS, ""))).cast("long")


def worded_lines(text: Column) -> Column:
    return F.filter(lines_of(text), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))


def n_dup_lines(text: Column) -> Column:
    return let(
        worded_lines(text),
        lambda lines: (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
    )


def _covered(hashes: Column, width: int) -> Column:
    """Words under windows that occur twice, from the gaps between their starts."""

    def again(pairs):
        return F.filter(
            F.transform(
                pairs,
                lambda x, k: F.when(
                    (x["h"] == F.get(pairs, k - 1)["h"]) | (x["h"] == F.get(pairs, k + 1)["h"]),
                    x["i"],
                ),
            ),
            lambda i: i.isNotNull(),
        )

    def spans(starts):
        return F.transform(
            starts,
            lambda x, k: F.least(
                F.lit(width), F.coalesce(F.get(starts, k + 1) - x, F.lit(width))
            ),
        )

    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return let(
        pairs,
        lambda p: let(
            F.array_sort(again(p)),
            lambda s: F.aggregate(spans(s), F.lit(0), lambda n, x: n + x).cast("long"),
        ),
    )


def repeated_words(found: Column, width: int = WINDOW) -> Column:
    """Words inside windows of ``width`` words (a power of 2) that come twice or more.

    A window is compared by a 64-bit hash, built by doubling from hashes of its
    halves; only lists with an equal pair are sorted.
    """

    def windows(hashes, half):
        if half == width:
            return F.when(
                F.size(F.array_distinct(hashes)) < F.size(hashes), _covered(hashes, width)
            ).otherwise(F.lit(0).cast("long"))
        rest = F.size(hashes) - half
        joined = F.zip_with(
            F.slice(hashes, 1, rest),
            F.slice(hashes, half + 1, rest),
            lambda a, b: F.xxhash64(a, b),
        )
        return let(joined, lambda hs: windows(hs, 2 * half))

    return F.when(
        F.size(found) > width,
        let(F.transform(found, lambda w: F.xxhash64(w)), lambda hs: windows(hs, 1)),
    ).otherwise(F.lit(0).cast("long"))


# Statistics by name, over a text that is not null and its words.
STATISTICS: dict[str, Callable[[Column, Column], Column]] = {
    "n_words": lambda text, ws: F.size(ws).cast("long"),
    "word_chars": lambda text, ws: F.aggregate(
        ws, F.lit(0).cast("long"), lambda n, w: n + F.char_length(w).cast("long")
    ),
    "n_symbols": lambda text, ws: n_symbols(text),
    "n_dup_lines": lambda text, ws: n_dup_lines(text),
    "n_lines": lambda text, ws: F.size(worded_lines(text)).cast("long"),
    "n_repeat_words": lambda text, ws: repeated_words(ws),
    "n_upper": lambda text, ws: F.regexp_count(text, F.lit("\\p{Lu}")).cast("long"),
}


def _over(part: str, percent: int, whole: str):
    return lambda s: 100 * s(part) > percent * s(whole)


RULES = (
    Rule("few_words", lambda s: s("n_words") < 20),
    Rule("repeats", _over("n_repeat_words", 30, "n_words")),
    Rule("symbols", _over("n_symbols", 8, "word_chars")),
    Rule("dup_lines", _over("n_dup_lines", 50, "n_lines")),
    Rule("shouting", _over("n_upper", 50, "word_chars")),
    Rule("long_words", lambda s: s("word_chars") > 15 * s("n_words")),
    Rule("short_words", lambda s: s("word_chars") < 2 * s("n_words")),
)


@dataclass(frozen=True)
class Measured:
    """A rule with what the sample showed."""

    rule: Rule
    seconds: float
    rejected: int

    @property
    def gain(self) -> float:
        return self.rejected / max(self.seconds, 1e-6)


def _computed(name: str, prefix: str = "__") -> Column:
    return STATISTICS[name](F.col(f"{prefix}text"), F.col(f"{prefix}words"))


def _split(docs: DataFrame, prefix: str = "__") -> DataFrame:
    text = F.col(f"{prefix}text")
    return docs.withColumn(f"{prefix}text", F.coalesce("text", F.lit(""))).withColumn(
        f"{prefix}words", words(text)
    )


def measure(docs: DataFrame, rules=RULES, sample_docs: int = SAMPLE_DOCS) -> list[Measured]:
    """Rules with time and rejections on about ``sample_docs`` documents, best first.

    The sample bounds this step only; verdicts cover all rows.
    """
    share = min(1.0, sample_docs / max(1, docs.count()))
    sample = _split(docs.select("text").sample(share, 20240131)).persist()
    sample.count()
    found = []
    for rule in rules:
        began = time.perf_counter()
        rejected = sample.where(rule.rejects(_computed)).count()
        found.append(Measured(rule, time.perf_counter() - began, rejected))
    sample.unpersist()
    return sorted(found, key=lambda m: (-m.gain, m.rule.name))


def cascade(
    docs: DataFrame, rules=RULES, report: tuple = (), sample_docs: int = SAMPLE_DOCS
) -> DataFrame:
    """All columns of ``docs``, the reported statistics and ``rejected_by`` (null: kept).

    A null text is an empty one. Rows are judged one by one, so ties, repeated
    rows and other columns play no part; an empty table gives an empty table.
    """
    order = [m.rule for m in measure(docs, rules, sample_docs)]
    p = free_prefix(docs.columns)
    counted = _split(docs, p).select(
        "*", *[_computed(name, p).alias(f"{p}n_{name}") for name in report]
    )
    chain = F
    for rule in order:
        said = rule.rejects(lambda n: F.col(f"{p}n_{n}") if n in report else _computed(n, p))
        chain = chain.when(said, F.lit(rule.name))
    verdict = chain if order else F.lit(None).cast("string")
    passed = [F.col(f"`{c}`") for c in docs.columns if c not in (*report, "rejected_by")]
    return counted.select(
        *passed, *[F.col(f"{p}n_{n}").alias(n) for n in report], verdict.alias("rejected_by")
    )
