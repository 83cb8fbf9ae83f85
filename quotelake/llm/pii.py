"""Personal data: fixed patterns as seeds, contexts learnt from them.

Seeds are emails, IP addresses, card and phone numbers found by pattern. Their
surroundings give lexical patterns (two words before; one word before and one
after). Tokens that could be identifiers but match no fixed pattern are
candidates and share those patterns. On the graph of patterns and instances
confidence goes back and forth, per kind: a pattern's is the mean score of the
distinct instances it surrounds, an instance's is the noisy-or of its confident
patterns; seeds keep their score. Candidates that reach ``SURE`` are personal
data of that kind wherever they stand.

Texts are read once, and in place. What is shuffled is one row per pattern and
distinct instance, so a pattern, instance or document that is repeated by a third
of all rows is combined before it meets others.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import staged

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 4
SUPPORT = 5.0  # what the scores of a pattern's instances have to add up to
CONFIDENT = 0.8  # least confidence of a pattern that may find candidates
SURE = 0.9  # least score of a candidate that counts as personal data

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_MARK = re.compile(r"[0-9@]|[(\[]at[)\]]")  # every seed and candidate holds one
_TOKEN = re.compile(r"[^ \t\n\x0b\x0c\r]+")
_EDGE = ".,;:!?\"'()[]{}<>|"
WINDOW = 64  # code points beside a span in which its neighbours are looked for


def _emails(text: str):
    """Spans of emails; each address has one @, so the scan goes from @ to @."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        else:
            end = at + 1
        at = text.find("@", end)


def _ips(text: str):
    """Spans of four numbers parted by dots, four after four in longer chains."""
    for chain in _NUMBERS.finditer(text):
        at, parts = chain.start(), chain.group().split(".")
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p) <= 3 or len(p.lstrip("0")) <= 3 for p in four) and all(
                int(p[-3:]) <= 255 for p in four
            ):
                yield at, end
            at = end + 1


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        value = int(d) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _cards(text: str):
    for found in _CARD.finditer(text):
        if found.end() - found.start() < 38:
            digits = found.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                yield found.span()


def _phones(text: str):
    for found in _PHONE.finditer(text):
        if 9 <= sum("0" <= c <= "9" for c in found.group()) <= 15:
            yield found.span()


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all seeds by start, then kind; ends are exclusive."""
    found = [("email", *span) for span in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        found += [("ip", *span) for span in _ips(text)]
        found += [("card", *span) for span in _cards(text)]
        if "+" in text:
            found += [("phone", *span) for span in _phones(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def possible_kinds(token: str) -> list[str]:
    """The kinds a token that matches no fixed pattern could be an identifier of."""
    digits = sum("0" <= c <= "9" for c in token)
    letters = sum(c.isalpha() for c in token)
    kinds = []
    if letters >= 2 and ("@" in token or "[at]" in token or "(at)" in token):
        kinds.append("email")
    if digits >= 4 and (token.count(".") == 3 or token.count(":") >= 3):
        kinds.append("ip")
    if digits >= 8 and not letters:
        kinds.append("card")
    if digits >= 6 and not letters:
        kinds.append("phone")
    return kinds


def _plain(word: str) -> str:
    """A word of a context: ASCII lower case, digits all alike."""
    return _DIGIT.sub("0", word.lower() if word.isascii() else word)


def contexts(text: str, start: int, end: int) -> list[str]:
    """The two patterns around a span: two words before, and one on either side."""
    before = ["^", "^", *_TOKEN.findall(text[max(0, start - WINDOW) : start])][-2:]
    after = _TOKEN.findall(text[end : end + WINDOW])
    first, last = map(_plain, before)
    follows = _plain(after[0]) if after else "$"
    return [f"{first} {last} _", f"{last} _ {follows}"]


def _mentions(text: str, seeds: list[tuple[str, int, int]]):
    """(kind or None, possible kinds, start, end, instance, patterns) of seeds and candidates."""
    for kind, start, end in seeds:
        yield kind, [kind], start, end, _plain_instance(text[start:end]), contexts(text, start, end)
    at = 0
    for token in _TOKEN.finditer(text):
        raw = token.group()
        if not _MARK.search(raw):
            continue
        while at < len(seeds) and seeds[at][2] <= token.start():
            at += 1
        if any(s < token.end() and e > token.start() for _, s, e in seeds[at : at + 8]):
            continue
        left = len(raw) - len(raw.lstrip(_EDGE))
        body = raw.strip(_EDGE)
        kinds = possible_kinds(body)
        if kinds:
            start = token.start() + left
            end = start + len(body)
            yield None, kinds, start, end, _plain_instance(body), contexts(text, start, end)


def _plain_instance(text: str) -> str:
    return text.lower() if text.isascii() else text


_MENTION = (
    "struct<seed:string,kinds:array<string>,start:long,end:long,instance:string,patterns:array<string>>"
)


def mentions(docs: DataFrame) -> DataFrame:
    """(row, doc_id, found) with the seeds and candidates of each document's whole text."""

    def run(source):
        kind = pa.struct(
            [
                ("seed", pa.string()),
                ("kinds", pa.list_(pa.string())),
                ("start", pa.int64()),
                ("end", pa.int64()),
                ("instance", pa.string()),
                ("patterns", pa.list_(pa.string())),
            ]
        )
        names = [field.name for field in kind]
        for batch in source:
            found = []
            for text in batch.column("text"):
                text = text.as_py() or ""
                if _MARK.search(text):
                    rows = _mentions(text, base_spans(text))
                    found.append([dict(zip(names, row)) for row in rows])
                else:
                    found.append([])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(found, pa.list_(kind))],
                ["row", "doc_id", "found"],
            )

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"row long, doc_id {kind}, found array<{_MENTION}>")


def graph(found: DataFrame) -> DataFrame:
    """(pattern, instance, seed, kinds): each pattern and distinct instance once."""
    edges = found.select(F.explode("found").alias("m")).select(
        F.explode("m.patterns").alias("pattern"), "m.instance", "m.seed", "m.kinds"
    )
    return edges.groupBy("pattern", "instance").agg(
        F.min("seed").alias("seed"), F.max("kinds").alias("kinds")
    )


def _confident(scored: DataFrame, support: float, confident: float) -> DataFrame:
    """(pattern, kind, confidence) from (pattern, instance, scores by kind)."""
    sums = scored.groupBy("pattern").agg(
        F.count("*").alias("n"), *[F.sum(F.col("score")[k]).alias(k) for k in KINDS]
    )
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("mass")) for k in KINDS])
    return (
        sums.select("pattern", "n", F.explode(kinds).alias("x"))
        .select("pattern", "x.kind", "x.mass", (F.col("x.mass") / F.col("n")).alias("confidence"))
        .where((F.col("mass") >= support) & (F.col("confidence") >= confident))
        .select("pattern", "kind", "confidence")
    )


def _seed_scores(seed: Column) -> Column:
    return F.create_map(
        *[x for k in KINDS for x in (F.lit(k), F.coalesce(seed == k, F.lit(False)).cast("double"))]
    )


def discover(
    edges: DataFrame,
    rounds: int = ROUNDS,
    support: float = SUPPORT,
    confident: float = CONFIDENT,
    sure: float = SURE,
) -> DataFrame:
    """(instance, kind, score) of the candidates that are personal data.

    Each round scores patterns by their instances, then candidates by their
    patterns. Scores only grow, as seeds keep theirs.
    """
    scored = edges.withColumn("score", _seed_scores(F.col("seed")))
    candidates = edges.where(F.col("seed").isNull()).select("pattern", "instance", "kinds")
    found = None
    for _ in range(rounds):
        patterns = _confident(scored, support, confident)
        found = staged(
            candidates.join(patterns, "pattern")
            .where(F.array_contains("kinds", F.col("kind")))
            .groupBy("instance", "kind")
            .agg((1 - F.product(1 - F.col("confidence"))).alias("score")),
            "instances",
        )
        by_kind = found.groupBy("instance").pivot("kind", list(KINDS)).agg(F.max("score"))
        score = F.create_map(
            *[x for k in KINDS for x in (F.lit(k), F.coalesce(F.col(k), F.lit(0.0)))]
        )
        rest = edges.where(F.col("seed").isNull()).join(by_kind, "instance", "left")
        scored = (
            edges.where(F.col("seed").isNotNull())
            .withColumn("score", _seed_scores(F.col("seed")))
            .unionByName(rest.withColumn("score", score).drop(*KINDS))
        )
    best = F.max_by("kind", F.struct("score", -F.array_position(F.lit(list(KINDS)), F.col("kind"))))
    return (
        found.where(F.col("score") >= sure)
        .groupBy("instance")
        .agg(best.alias("kind"), F.max("score").alias("score"))
    )


def find_pii(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, base, spans) of each row of ``docs`` (doc_id, text).

    ``base`` has the spans of the fixed patterns and ``spans`` those and the ones
    discovered, as array<struct<kind, start, end>> by start, then kind as in
    ``KINDS``; places count code points, ends are exclusive. A null or empty text
    has none. Rows may repeat or lack a doc_id; each gives its own row. Other
    columns are not read. ``options`` are those of ``discover``.
    """
    found = staged(mentions(docs), "mentions")
    edges = staged(graph(found), "pattern_graph")
    known = discover(edges, **options).select("instance", F.col("kind").alias("learnt"))
    candidates = (
        found.select("row", F.explode("found").alias("m"))
        .where(F.col("m.seed").isNull())
        .select("row", "m.start", "m.end", "m.instance")
    )
    added = (
        candidates.join(known, "instance")
        .groupBy("row")
        .agg(F.collect_list(F.struct(F.col("learnt").alias("kind"), "start", "end")).alias("added"))
    )
    seeds = F.transform(
        F.filter("found", lambda m: m["seed"].isNotNull()),
        lambda m: F.struct(m["seed"].alias("kind"), m["start"].alias("start"), m["end"].alias("end")),
    )
    none = F.array().cast("array<struct<kind:string,start:long,end:long>>")

    def sort_key(s):
        place = F.array_position(F.lit(list(KINDS)), s["kind"])
        return F.struct(s["start"].alias("start"), place.alias("place"), s["end"], s["kind"])

    whole = F.array_sort(F.transform(F.concat(seeds, F.coalesce("added", none)), sort_key))
    spans = F.transform(
        whole, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    )
    return found.join(added, "row", "left").select(
        "doc_id", seeds.alias("base"), spans.alias("spans")
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlaps are one."""
    whole = F.coalesce(text, F.lit(""))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(state, s):
        since = F.greatest(state["at"], s["start"])
        kept = F.substring(whole, (state["at"] + 1).cast("int"), (since - state["at"]).cast("int"))
        mark = F.when(s["start"] >= state["at"], F.concat(F.lit("["), s["kind"], F.lit("]")))
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.concat(state["out"], kept, F.coalesce(mark, F.lit(""))).alias("out"),
        )

    def rest(state):
        return F.concat(state["out"], F.substring(whole, (state["at"] + 1).cast("int"), F.length(whole)))

    return F.aggregate(spans, start, step, rest)
