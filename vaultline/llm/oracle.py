"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

_SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _crc32(text: str) -> str:
    """crc32 of an ASCII text, bit by bit."""
    byte = f"list_transform(string_split({text}, ''), lambda ch: ord(ch)::BIGINT)"
    bits = "list_reduce(range(8), lambda d, i: xor(d >> 1, (d & 1) * 3988292384), xor(c, b))"
    return f"xor(list_reduce({byte}, lambda c, b: {bits}, 4294967295::BIGINT), 4294967295::BIGINT)"


def _field(name: str) -> str:
    return f"coalesce(strlen({name}::VARCHAR)::VARCHAR || ':' || {name}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


# A conversation's edits row by row: the cheapest audit to each state, then the
# least one.  No cheapest repair has an insert: taking it out together with a
# neighbour in the repaired order leaves a legal order and costs 2 at most, not 5.
_TURNS = f"""
WITH RECURSIVE fated AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS fate
  FROM conversations
), said AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy
  FROM fated WHERE fate <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM said
), marked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    rtrim(text, {_SPACES}) AS ends, left(role, 1) AS initial,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed
), faulty AS (
  SELECT *, CASE WHEN ends = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(ends, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault FROM marked
), edits AS (
  -- state: 0 nothing yet, 1 after system, 2 after user, 3 after assistant
  SELECT f.conv_id, f.i, s.state, e.edit,
    CASE e.edit WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END + CASE WHEN e.edit <> 'D' AND f.fault = 'truncated' THEN 5 ELSE 0 END AS cost,
    CASE WHEN e.edit = 'D' THEN s.state WHEN e.edit = 'R' THEN CASE WHEN s.state = 2 THEN 3 ELSE 2 END
      WHEN f.initial = 's' AND s.state = 0 THEN 1 WHEN f.initial = 'u' AND s.state <> 2 THEN 2 WHEN f.initial = 'a' AND s.state = 2 THEN 3 END AS next,
    CASE WHEN e.edit = 'D' THEN '' WHEN e.edit = 'K' THEN chr(10) || f.role || ':' || f.text
      ELSE chr(10) || CASE WHEN s.state = 2 THEN 'assistant' ELSE 'user' END || ':' || f.text END AS line
  FROM faulty f, (VALUES (0), (1), (2), (3)) s(state), (VALUES ('D'), ('K'), ('R')) e(edit)
  WHERE e.edit = 'D' OR f.fault IS NULL OR f.fault = 'truncated'
), best AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS state, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS got FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT b.conv_id, b.i + 1, e.next, min({{'c': b.got.c + e.cost, 'a': b.got.a || e.edit, 't': b.got.t || e.line}})
  FROM best b JOIN edits e ON b.conv_id IS NOT DISTINCT FROM e.conv_id AND e.i = b.i + 1 AND e.state = b.state
  WHERE e.next IS NOT NULL
  GROUP BY b.conv_id, b.i + 1, e.next
), last AS (
  SELECT b.conv_id, min(b.got) AS got FROM best b
  WHERE b.state IN (0, 3) AND b.i = (SELECT count(*) FROM faulty f WHERE f.conv_id IS NOT DISTINCT FROM b.conv_id)
  GROUP BY b.conv_id
), sums AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id
)
SELECT l.conv_id, coalesce(s.gaps, 0)::BIGINT AS gaps, coalesce(s.blank, 0)::BIGINT AS blank, coalesce(s.duplicate, 0)::BIGINT AS duplicate,
  coalesce(s.truncated, 0)::BIGINT AS truncated, coalesce(s.illegal, 0)::BIGINT AS illegal, l.got.c::BIGINT AS cost, l.got.a AS audit,
  sha256(l.got.t[2:]) AS repaired_sha256
FROM last l LEFT JOIN sums s ON l.conv_id IS NOT DISTINCT FROM s.conv_id
"""

_MANIFEST = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS idx, {_leaf("text")} AS leaf,
    CASE WHEN {_crc32("doc_id::VARCHAR")} % 3 = 0 THEN {_leaf(f"translate(text, {_LOWER})")} ELSE {_leaf("text")} END AS altered
  FROM documents
), nodes AS (
  SELECT lang, 0 AS level, idx, leaf AS digest, count(*) OVER (PARTITION BY lang) AS width FROM leaves
  UNION ALL
  SELECT lang, any_value(level) + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx)), any_value((width + 7) // 8) FROM nodes WHERE width > 1 GROUP BY lang, idx // 8
), runs AS (
  SELECT lang, level, idx // 8 AS up, list(digest ORDER BY idx) AS ds FROM nodes WHERE width > 1 GROUP BY lang, level, idx // 8
), subroots AS (
  SELECT lang, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx FROM nodes WHERE width = 1
), tops AS (
  SELECT 0 AS level, idx, digest, (SELECT count(*) FROM subroots) AS width FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx)), any_value((width + 7) // 8) FROM tops WHERE width > 1 GROUP BY idx // 8
), topruns AS (
  SELECT level, idx // 8 AS up, list(digest ORDER BY idx) AS ds FROM tops WHERE width > 1 GROUP BY level, idx // 8
), walk AS (
  SELECT doc_id, lang, 0 AS level, idx, altered AS digest, '' AS proof FROM leaves
  UNION ALL
  SELECT w.doc_id, w.lang, w.level + 1, w.idx // 8, sha256(array_to_string(r.ds[1:w.idx % 8] || [w.digest] || r.ds[w.idx % 8 + 2:], '')),
    w.proof || array_to_string(r.ds[1:w.idx % 8] || r.ds[w.idx % 8 + 2:], '')
  FROM walk w JOIN runs r ON r.lang IS NOT DISTINCT FROM w.lang AND r.level = w.level AND r.up = w.idx // 8
), ends AS (
  SELECT w.doc_id, s.idx, s.digest AS subroot, w.digest, w.proof
  FROM (SELECT *, max(level) OVER (PARTITION BY doc_id, lang) AS most FROM walk) w JOIN subroots s ON s.lang IS NOT DISTINCT FROM w.lang
  WHERE w.level = w.most
), climb AS (
  SELECT doc_id, subroot, 0 AS level, idx, digest, proof FROM ends
  UNION ALL
  SELECT c.doc_id, c.subroot, c.level + 1, c.idx // 8, sha256(array_to_string(r.ds[1:c.idx % 8] || [c.digest] || r.ds[c.idx % 8 + 2:], '')),
    c.proof || array_to_string(r.ds[1:c.idx % 8] || r.ds[c.idx % 8 + 2:], '')
  FROM climb c JOIN topruns r ON r.level = c.level AND r.up = c.idx // 8
)
SELECT c.doc_id, l.leaf, c.subroot, t.digest AS root, sha256(c.proof) AS proof_sha256, c.digest AS folded_root, c.digest = t.digest AS verified
FROM (SELECT *, max(level) OVER (PARTITION BY doc_id) AS most FROM climb) c JOIN leaves l USING (doc_id), (SELECT digest FROM tops WHERE width = 1) t
WHERE c.level = c.most
"""

_LINES = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place FROM documents
), keyed AS (
  SELECT *, translate(trim(line, {_SPACES}), {_LOWER}) AS key FROM lines
), firsts AS (
  SELECT key, min(doc_id) AS holder FROM keyed WHERE length(key) >= 10 GROUP BY key
), marked AS (
  SELECT k.doc_id, k.line, k.place, coalesce(f.holder <> k.doc_id, FALSE) AS gone FROM keyed k LEFT JOIN firsts f ON k.key = f.key
)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

ORACLE: dict[str, str] = {
    "op11_repair_turns": _TURNS,
    "op12_merkle_manifest": _MANIFEST,
    "op13_dedup_lines": _LINES,
}
