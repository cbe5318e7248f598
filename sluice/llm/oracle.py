"""DuckDB SQL that recomputes the queries of this subpackage from the raw tables."""

from __future__ import annotations

from sluice.llm.mixing import ALPHA, DIMS, NULL_VALUE, ROUNDS, TOPICS

_CHAT = r"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), esc AS (
  SELECT *,
    replace(replace(replace(replace(role, '\', '\b'), '<turn', '\lturn'), '</turn', '\l/turn'), chr(10), '\n') AS r,
    replace(replace(replace(text, '\', '\b'), '<turn', '\lturn'), '</turn', '\l/turn') AS t
  FROM rows_
)
SELECT conv_id,
  count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(length(r) + length(t) + length('<turn>') + 1 + length('</turn>') + 1) AS BIGINT) AS formatted_chars
FROM esc GROUP BY conv_id
"""

_EXACT = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
), g AS (
  SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM n JOIN g USING (t)
"""

_LINES = r"""
WITH d AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), w AS (
  SELECT doc_id, unnest(range(len(lines) - 2)) AS pos, lines FROM d WHERE len(lines) >= 3
), keyed AS (
  SELECT doc_id, pos, array_to_string(lines[pos + 1 : pos + 3], chr(10)) AS k FROM w
), later AS (
  SELECT doc_id, pos FROM keyed
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, pos) > 1
), covered AS (
  SELECT DISTINCT doc_id, pos + unnest([0, 1, 2]) AS pos FROM later
), l AS (
  SELECT doc_id, unnest(range(len(lines))) AS pos, unnest(lines) AS line FROM d
)
SELECT l.doc_id, count(*) AS n_lines, count(c.pos) AS n_removed,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY l.pos) FILTER (c.pos IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN covered c ON c.doc_id = l.doc_id AND c.pos = l.pos
GROUP BY l.doc_id
"""


def mixing_sql(docs: str = "documents") -> str:
    """Cells, raking rounds and the sampling decision as chained CTEs."""
    topic = "CASE " + " ".join(
        f"WHEN regexp_matches(t, '{p}') THEN '{n}'" for n, p in TOPICS
    ) + " ELSE 'prose' END"
    parts = [
        f"""c0 AS MATERIALIZED (
  SELECT *, coalesce(source, '{NULL_VALUE}') AS s, coalesce(lang, '{NULL_VALUE}') AS l,
    coalesce(text, '') AS t FROM {docs})""",
        f"""cell AS MATERIALIZED (
  SELECT c0.*, {topic} AS topic,
    CAST(len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS tokens
  FROM c0)""",
        """sums AS MATERIALIZED (
  SELECT s AS source, l AS lang, topic, CAST(sum(tokens) AS BIGINT) AS tokens FROM cell GROUP BY ALL)""",
        "live AS (SELECT * FROM sums WHERE tokens > 0)",
    ]
    for d in DIMS:
        parts.append(
            f"""t_{d} AS MATERIALIZED (
  SELECT {d}, pow(sum(tokens), {ALPHA}) / sum(pow(sum(tokens), {ALPHA})) OVER () AS tg FROM live GROUP BY {d})"""
        )
    last = "w0"
    parts.append(
        "w0 AS MATERIALIZED (SELECT source, lang, topic, CAST(tokens AS DOUBLE) AS w FROM live)"
    )
    for i in range(ROUNDS):
        for d in DIMS:
            now = f"w{i}_{d}"
            parts.append(
                f"{now} AS MATERIALIZED (SELECT source, lang, topic, "
                f"w * tg / sum(w) OVER (PARTITION BY {d}) AS w FROM {last} JOIN t_{d} USING ({d}))"
            )
            last = now
    parts.append(
        f"""rate AS (
  SELECT source, lang, topic, coalesce(w / tokens, 0) AS r
  FROM sums LEFT JOIN {last} USING (source, lang, topic))"""
    )
    parts.append(
        "p AS MATERIALIZED (SELECT source, lang, topic, CASE WHEN max(r) OVER () > 0 "
        "THEN r / max(r) OVER () ELSE 1.0 END AS p FROM rate)"
    )
    return "WITH " + ",\n".join(parts)


_MIXING = (
    mixing_sql()
    + """
SELECT doc_id, p.source, p.lang, p.topic, tokens, round(p, 6) AS probability,
  CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE) / pow(2, 52) < p AS sampled
FROM cell JOIN p ON cell.s = p.source AND cell.l = p.lang AND cell.topic = p.topic
"""
)

_SUBSTRINGS = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), p AS (
  SELECT doc_id, unnest(range(len(w) - 12)) AS pos, w FROM d WHERE len(w) >= 13
), k AS (
  SELECT doc_id, pos, array_to_string(w[pos + 1 : pos + 13], ' ') AS k FROM p
), gone AS (
  SELECT doc_id, pos FROM (SELECT doc_id, pos, min(doc_id) OVER (PARTITION BY k) AS least FROM k)
  WHERE least < doc_id
), covered AS (
  SELECT DISTINCT doc_id, pos + o AS pos FROM gone, range(13) AS t(o)
), each AS (
  SELECT doc_id, unnest(range(len(w))) AS pos, unnest(w) AS word FROM d
), kept AS (
  SELECT e.doc_id, count(c.pos) AS n_removed,
    string_agg(word, ' ' ORDER BY e.pos) FILTER (c.pos IS NULL) AS t
  FROM each e LEFT JOIN covered c ON c.doc_id = e.doc_id AND c.pos = e.pos GROUP BY e.doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

_BENCHMARK = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), sized AS (SELECT item_id, w, least(13, len(w)) AS n FROM b WHERE len(w) > 0),
bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[pos + 1 : pos + n], ' ') AS k
  FROM (SELECT *, unnest(range(len(w) - n + 1)) AS pos FROM sized)
), lens AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, pos, array_to_string(w[pos + 1 : pos + n], ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS pos FROM d, lens WHERE len(w) >= n)
), hit AS (SELECT doc_id, item_id, pos, dw.n FROM dw JOIN bw USING (n, k)),
covered AS (
  SELECT doc_id, count(DISTINCT pos + o) AS n_hit FROM hit, range(13) AS t(o) WHERE o < n GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

_NEAR = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[pos + 1 : pos + n], ' ') AS g
  FROM (SELECT doc_id, w, least(5, len(w)) AS n, unnest(range(len(w) - least(5, len(w)) + 1)) AS pos
        FROM d WHERE len(w) > 0)
), sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
link AS MATERIALIZED (
  SELECT p.a, p.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
    FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN sizes sa ON sa.doc_id = a JOIN sizes sb ON sb.doc_id = b
  WHERE 100 * c >= 75 * (sa.n + sb.n - c)
), reach AS (
  SELECT a AS doc_id, a AS r FROM (SELECT DISTINCT a FROM link)
  UNION SELECT l.b, r FROM reach JOIN link l ON l.a = reach.doc_id
), comp AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id,
  coalesce(component_id, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN comp USING (doc_id)
"""

_MIDDLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('1:' || CAST(doc_id AS VARCHAR)) AS h FROM documents
), k AS (
  SELECT *, len(u) AS n,
    CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
    CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM k
), p AS (
  SELECT *, array_to_string(u[1:lo], '') AS pre, array_to_string(u[lo + 1 : hi], '') AS mid,
    array_to_string(u[hi + 1 :], '') AS suf FROM c
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""

ORACLE = {
    "op12_fill_in_middle": _MIDDLE,
    "op3_chat_formatting": _CHAT,
    "op5_mixing": _MIXING,
    "op6_line_dedup": _LINES,
    "op8_exact_dedup": _EXACT,
    "op7_substring_dedup": _SUBSTRINGS,
    "op9_minhash_near_dedup": _NEAR,
    "op10_decontamination": _BENCHMARK,
}
