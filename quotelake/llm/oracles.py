"""SQL of the queries that SQL can express, for DuckDB."""

from __future__ import annotations

from quotelake.llm import chat, sharding
from quotelake.llm.queries import SHARD_BYTES

BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, pos, line, {LOWER.format(f"trim(line, {BLANKS})")} AS key
  FROM (SELECT doc_id, l.line, l.pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
             LATERAL (SELECT unnest(ls) AS line, generate_subscripts(ls, 1) AS pos) l)
), owners AS (
  SELECT key, min(doc_id) AS owner, max(doc_id) AS final FROM lines
  WHERE length(key) >= 10 GROUP BY key
), marked AS (
  SELECT l.doc_id, l.pos, l.line,
         coalesce(o.owner < o.final AND l.doc_id > o.owner, false) AS gone
  FROM lines l LEFT JOIN owners o ON l.key = o.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), ''))
         AS kept_sha256
FROM marked GROUP BY doc_id
"""

_ESCAPED = "replace(replace({}, '\\', '\\\\'), '<|', '<\\|')"

CHAT_FORMAT = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM (SELECT conv_id, turn, role, text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
        UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
), placed AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before FROM said
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
         AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
                       FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length({_ESCAPED.format("text")}) + CASE WHEN before IS NOT DISTINCT FROM role
             THEN {len(chat.PART)}
             ELSE {len(chat.START + chat.TEXT + chat.END)} + length({_ESCAPED.format("role")}) END
           )::BIGINT AS formatted_chars
FROM placed GROUP BY conv_id
"""

# Keys are unique in the table, so the address of the key alone places a row.
SHARDING = f"""
WITH sized AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS bytes,
         ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT AS h FROM documents
), levels AS (
  SELECT depth, h >> ({sharding.BITS} - depth) AS prefix, sum(bytes)::BIGINT AS shard_bytes,
         count(*) AS shard_rows
  FROM sized, range(0, {sharding.BITS + 1}) r(depth) GROUP BY ALL
), placed AS (
  SELECT doc_id, bytes, h, min(depth) AS depth
  FROM sized, range(0, {sharding.BITS + 1}) r(depth) JOIN levels USING (depth)
  WHERE prefix = h >> ({sharding.BITS} - depth)
    AND (shard_bytes <= {SHARD_BYTES} OR shard_rows = 1)
  GROUP BY doc_id, bytes, h
)
SELECT doc_id, bytes,
       substr(lpad(bin(h), {sharding.BITS}, '0'), 1, depth::INT) AS shard, depth::INT AS depth,
       shard_bytes, shard_rows, shard_bytes <= {SHARD_BYTES} AS fits
FROM placed JOIN levels USING (depth) WHERE prefix = h >> ({sharding.BITS} - depth)
"""

_WORD = "'[^\\x20\\x09-\\x0D]+'"

QUALITY_RULES = f"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), {_WORD}) AS ws FROM documents
), windows AS (
  SELECT doc_id, i, list_slice(ws, i, i + 7) AS win
  FROM split, LATERAL (SELECT unnest(range(1, len(ws) - 6)) AS i)
), starts AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n
                         FROM windows) WHERE n > 1
), covered AS (
  SELECT doc_id, sum(least(8, coalesce(after - i, 8)))::BIGINT AS n FROM (
    SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS after FROM starts)
  GROUP BY doc_id
), lines AS (
  SELECT doc_id, (count(*) - count(DISTINCT line)) AS n
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM split)
  WHERE regexp_matches(line, {_WORD}) GROUP BY doc_id
), worded AS (
  SELECT doc_id, count(*) AS n
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM split)
  WHERE regexp_matches(line, {_WORD}) GROUP BY doc_id
), counted AS (
  SELECT s.doc_id, len(ws)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0)::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(l.n, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         coalesce(w.n, 0) AS n_lines,
         length(regexp_replace(text, '[^\\p{{Lu}}]', '', 'g')) AS upper
  FROM split s LEFT JOIN lines l USING (doc_id) LEFT JOIN covered c USING (doc_id)
       LEFT JOIN worded w USING (doc_id)
), based AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (100 * n_symbols > 8 * word_chars
         OR 100 * n_dup_lines > 50 * n_lines OR 100 * upper > 50 * word_chars
         OR word_chars > 15 * n_words OR word_chars < 2 * n_words) AS kept
FROM based
"""

EMBEDDINGS = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach AS (
  SELECT vec_id AS v, vec_id AS r FROM embeddings
  UNION SELECT reach.v, links.b FROM reach JOIN links ON reach.r = links.a
)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links,
       component_id, vec_id = component_id AS kept
FROM embeddings JOIN (SELECT v, min(r) AS component_id FROM reach GROUP BY v) ON v = vec_id
"""

def _best(*offers: str) -> str:
    """The cheapest of some edit sequences, then the least audit."""
    return f"list_min([{', '.join(offers)}])"


def _after(state: str, cost: str, edit: str, line: str | None = None) -> str:
    """The sequence of a state with one more edit and, unless deleted, one more turn."""
    said = f"{state}.t || chr(10) || {line}" if line else f"{state}.t"
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}', 't': {said}}}"


def _inserted(columns: str, source: str) -> str:
    """States n, s, u, v (nothing, s, u, a at the end) with empty turns inserted."""
    user = [_after(x, "5", "I", "'user:'") for x in "nsv"]
    helper = _after("u", "5", "I", "'assistant:'")
    return f"""SELECT {columns}, n, s, u, {_best("v", helper)} AS v
        FROM (SELECT {columns}, n, s, {_best("u", *user)} AS u, v FROM ({source}))"""


def _kept(state: str, initial: str) -> str:
    """Keep a row of that initial, else an offer that is never the cheapest."""
    cost = f"CASE WHEN go OR initial <> '{initial}' THEN {_FAR} ELSE late END"
    return _after(state, cost, "K", "role || ':' || text")


def _renamed(state: str, role: str) -> str:
    cost = f"CASE WHEN go THEN {_FAR} ELSE late + 1 END"
    return _after(state, cost, "R", f"'{role}:' || text")


_FAR = 1_000_000_000
_NO = f"{{'c': {_FAR}::BIGINT, 'a': '', 't': ''}}"
_KEY = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"
_CRC = f"""xor(4294967295::BIGINT, list_reduce(
  list_prepend(4294967295::BIGINT,
    list_transform(string_split({_KEY}, ''), lambda ch: ord(ch)::BIGINT)),
  lambda acc, b: list_reduce(list_prepend(xor(acc, b), range(8)::BIGINT[]),
    lambda x, k: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END::BIGINT))))"""
_MOVED = f"""
  SELECT w.conv_id, w.pos + 1 AS pos,
    {_after("n", "2", "D")} AS n,
    {_best(_after("s", "2", "D"), _kept("n", "s"))} AS s,
    {_best(_after("u", "2", "D"), *[_kept(x, "u") for x in "nsv"],
           *[_renamed(x, "user") for x in "nsv"])} AS u,
    {_best(_after("v", "2", "D"), _kept("u", "a"), _renamed("u", "assistant"))} AS v
  FROM walk w JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.pos = w.pos + 1"""

CONVERSATION_REPAIR = f"""
WITH RECURSIVE coded AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_CRC} % 20 AS kind FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS again
  FROM coded
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role,
           md5(strlen(role)::VARCHAR || ':' || role || text), again) AS pos,
         left(role, 1) AS initial, rtrim(text, {BLANKS}) AS ended
  FROM damaged
), repeated AS (
  SELECT *, ended = '' AS blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again_said,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) AS before
  FROM placed
), judged AS (
  SELECT *, NOT blank AND again_said AS duplicate, blank OR again_said AS go,
         NOT blank AND NOT again_said AND right(ended, 1) NOT IN ('.', '!', '?') AS truncated,
         CASE WHEN NOT blank AND NOT again_said AND right(ended, 1) NOT IN ('.', '!', '?')
              THEN 5 ELSE 0 END AS late
  FROM repeated
), walk AS (
  {_inserted("conv_id, pos", f"SELECT DISTINCT conv_id, 0::BIGINT AS pos, "
             f"{{'c': 0::BIGINT, 'a': '', 't': ''}} AS n, {_NO} AS s, {_NO} AS u, {_NO} AS v "
             "FROM judged")}
  UNION ALL
  {_inserted("conv_id, pos", _MOVED)}
), facts AS (
  SELECT conv_id, count(*) AS n_rows,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE blank) AS blank,
         count(*) FILTER (WHERE duplicate) AS duplicate,
         count(*) FILTER (WHERE truncated) AS truncated,
         count(*) FILTER (WHERE before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id
), ends AS (
  SELECT f.*, {_best("w.n", "w.v")} AS best
  FROM facts f JOIN walk w ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND w.pos = f.n_rows
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost,
       coalesce(best.a, '') AS audit, sha256(coalesce(substr(best.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
     LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""

_TERMS = f"""SELECT {{}}, unnest(regexp_extract_all({LOWER.format("text")},
  '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM {{}}"""

LEXICAL_SEARCH = f"""
WITH counted AS (
  SELECT doc_id, term, count(*)::BIGINT AS tf FROM ({_TERMS.format("doc_id", "documents")})
  GROUP BY ALL
), long AS (
  SELECT doc_id, sum(tf)::BIGINT AS n FROM counted GROUP BY doc_id
), whole AS (
  SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS l FROM long
), weighed AS (
  SELECT term, floor(1000 * ln((2 * any_value(nd) + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM counted, whole GROUP BY term
), asked AS (
  SELECT item_id, term, count(*)::BIGINT AS c FROM ({_TERMS.format("item_id", "benchmark")})
  GROUP BY ALL
), scored AS (
  SELECT a.item_id, d.doc_id,
         sum(a.c * w.w * ((1000000000 * d.tf) // (1000 * d.tf + 8 * (25 + (75 * g.n * nd) // l))))
           ::BIGINT AS score
  FROM asked a JOIN counted d USING (term) JOIN weighed w USING (term) JOIN long g USING (doc_id),
       whole GROUP BY a.item_id, d.doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank,
       doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""

ORACLES = {
    "op7_embedding_near_dedup": EMBEDDINGS,
    "op1_line_dedup": LINE_DEDUP,
    "op4_chat_format": CHAT_FORMAT,
    "op6_sharding": SHARDING,
    "op9_quality_rules": QUALITY_RULES,
    "op11_lexical_search": LEXICAL_SEARCH,
    "op12_conversation_repair": CONVERSATION_REPAIR,
}
