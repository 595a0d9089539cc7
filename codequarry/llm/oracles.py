"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from codequarry.llm import mixing, rules
from codequarry.llm import secrets as S

_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _texts(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _rule(rule: rules.Rule) -> str:
    sides = [f"{rule.measure} >= {rule.low}"] if rule.low is not None else []
    sides += [f"{rule.measure} <= {rule.high}"] if rule.high is not None else []
    return " AND ".join(sides) or "true"


QUALITY_RULES = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, {_WORDS} AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents
), w AS (
  SELECT rid, i, array_to_string(words[i:i + 7], ' ') AS win
  FROM (SELECT rid, words, unnest(range(1, len(words) - 6)) AS i FROM d)
), again AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS c FROM w) WHERE c > 1
), spans AS (
  SELECT rid, sum(least(8, coalesce(nxt - i, 8)))::BIGINT AS n
  FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM again) GROUP BY rid
), m AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
         len(lines)::BIGINT AS n_lines,
         len(list_filter(words, lambda x: lower(regexp_replace(x, '[.,;:!?]+$', '')) IN ({_texts(rules.STOP_WORDS)}))) AS n_stop
  FROM d LEFT JOIN spans USING (rid)
), r AS (
  SELECT *, CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word_length,
         CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbols_per_word,
         CASE WHEN n_words > 0 THEN n_stop / n_words ELSE 0 END AS stop_word_ratio,
         CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS duplicate_line_ratio,
         n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {' AND '.join(_rule(r) for r in rules.DEFAULT_RULES)} AS kept
FROM r
"""

_WEIGHTS = ", ".join(str(float(w)) for w in mixing.WEIGHTS)

SOURCE_MIX = f"""
WITH d AS (
  SELECT doc_id, source, len({_WORDS})::BIGINT AS size,
         substr(md5(coalesce(doc_id::VARCHAR, '')), 1, {mixing.DIGITS}) AS hash
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         list_extract([{_WEIGHTS}]::DOUBLE[],
           ((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1)::INT) AS w
  FROM d GROUP BY source
), c AS (
  SELECT *, ({mixing.MAX_COPIES} * source_size)::DOUBLE AS cap,
         row_number() OVER (ORDER BY {mixing.MAX_COPIES} * source_size / w, source NULLS LAST) AS k FROM s
), l AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
         sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wrest,
         sum(source_size) OVER ()::DOUBLE AS total FROM c
), lev AS (
  SELECT arg_min((total - below) / wrest, k) AS level FROM l WHERE (total - below) / wrest <= cap / w
), t AS (
  SELECT source, source_size, least(cap, w * level) AS target FROM c, lev
), q AS (
  SELECT source, source_size, target,
         CASE WHEN source_size > 0 THEN least(floor(target / source_size), {mixing.MAX_COPIES})::BIGINT ELSE 0 END AS copies
  FROM t
), r AS (
  SELECT doc_id, size, source_size, target, copies, greatest(0, target - copies * source_size) AS rest,
         sum(size) OVER (PARTITION BY d.source ORDER BY hash RANGE UNBOUNDED PRECEDING) AS upto,
         sum(size) OVER (PARTITION BY d.source, hash) AS own, max(source_size) OVER () AS m
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source
)
SELECT doc_id, size, source_size, target,
       size * least({mixing.MAX_COPIES}, copies + CASE
         WHEN upto <= rest OR (upto - own <= rest AND own > 0 AND upto - rest < rest - (upto - own)) THEN 1 ELSE 0 END) AS taken
FROM r
"""

LINE_DEDUP = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), l AS (
  SELECT rid, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d
), k AS (
  SELECT *, translate(trim(line, {_SPACE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), often AS (
  SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT rid) >= 10
)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) - count(*) FILTER (WHERE o.key IS NULL))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE o.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN often o ON k.key = o.key GROUP BY rid, doc_id
"""


def _sql_secrets() -> str:
    def quoted(pattern: str) -> str:
        return "'" + pattern.replace("'", "''") + "'"

    places = []
    kinds = [
        (S.KINDS[0], S.ASSIGN, 2, f"length(v) >= {S.MIN_VALUE}"),
        (S.KINDS[1], S.ACCESS, 0, f"length(m) >= {S.MIN_ACCESS}"),
        (S.KINDS[2], S.HEX, 0, f"length(m) >= {S.MIN_HEX}"),
    ] + [(c.kind, c.pattern, 0, f"regexp_matches(m, {quoted(c.must)})") for c in S.CLASSES]
    for rank, (kind, pattern, group, keep) in enumerate(kinds):
        p = quoted(pattern)
        places.append(f"""
  SELECT rid, {rank} AS rank, '{kind}' AS kind, s, s + length(m) AS e, m FROM (
    SELECT rid, m, v, (list_sum(list_transform(g[1:i], lambda x: length(x)))
             + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0))::BIGINT AS s
    FROM (SELECT rid, g, ms, unnest(ms) AS m, unnest(vs) AS v, unnest(range(1, len(ms) + 1)) AS i
          FROM (SELECT rid, string_split_regex(t, {p}) AS g, regexp_extract_all(t, {p}) AS ms,
                       regexp_extract_all(t, {p}, {group}) AS vs FROM d)))
  WHERE {keep}""")
    weights = ", ".join(str(S.weight(n)) for n in range(max(c.window for c in S.CLASSES) + 1))
    sized = " ".join(f"WHEN '{c.kind}' THEN {c.window}" for c in S.CLASSES)
    bounds = " ".join(f"WHEN '{c.kind}' THEN {S.bound(c)}" for c in S.CLASSES)
    allowed = " AND ".join(f"NOT regexp_matches(v, {quoted(a)})" for a in S.ALLOW)
    joined = "coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank, e)"
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), p AS ({' UNION ALL '.join(places)}
), w AS (
  SELECT rid, rank, kind, s, m, n, bound, unnest(range(0, length(m) - n + 1)) AS i
  FROM (SELECT *, CASE kind {sized} END AS n, CASE kind {bounds} END AS bound FROM p WHERE rank >= {len(S.KINDS)})
), ch AS (
  SELECT rid, rank, kind, s, m, n, bound, i, substr(m, i + j + 1, 1) AS c
  FROM (SELECT *, unnest(range(0, n)) AS j FROM w)
), cc AS (
  SELECT rid, rank, kind, s, m, n, bound, i, c, count(*) AS k FROM ch GROUP BY ALL
), high AS (
  SELECT rid, rank, kind, s, m, n, i FROM cc GROUP BY rid, rank, kind, s, m, n, bound, i
  HAVING sum(([{weights}]::BIGINT[])[k + 1]) <= bound
), f AS (
  SELECT rid, rank, kind, s, e FROM p WHERE rank < {len(S.KINDS)}
  UNION ALL
  SELECT rid, rank, kind, a, e FROM (
    SELECT rid, rank, kind, (s + min(i))::BIGINT AS a, (s + max(i) + n)::BIGINT AS e, substr(m, (min(i) + 1)::INT, (max(i) - min(i) + n)::INT) AS v
    FROM high GROUP BY rid, rank, kind, s, m, n) WHERE {allowed}
)
SELECT doc_id, count(*) FILTER (WHERE rank = 0)::BIGINT AS n_assign, count(*) FILTER (WHERE rank = 1)::BIGINT AS n_access,
       count(*) FILTER (WHERE rank = 2)::BIGINT AS n_hex,
       sha256({joined} FILTER (WHERE rank < {len(S.KINDS)}), '')) AS base_sha256, {joined}, '') AS spans
FROM d LEFT JOIN f USING (rid) GROUP BY rid, doc_id
"""


SECRET_SCAN = _sql_secrets()

# Windows are compared as hashes of their words; each row is a document of its own.
SUBSTRING_DEDUP = f"""
WITH d AS (
  SELECT row_number() OVER (ORDER BY doc_id NULLS LAST) AS rid, doc_id, {_WORDS} AS words FROM documents
), w AS (
  SELECT rid, i, md5(array_to_string(words[i:i + 19], ' ')) AS win
  FROM (SELECT rid, words, unnest(range(1, len(words) - 18)) AS i FROM d)
), later AS (
  SELECT rid, i FROM (SELECT rid, i, row_number() OVER (PARTITION BY win ORDER BY rid, i) AS k FROM w) WHERE k > 1
), gone AS (
  SELECT DISTINCT rid, i + j AS pos FROM (SELECT rid, i, unnest(range(20)) AS j FROM later)
), word AS (
  SELECT rid, doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM d
), kept AS (
  SELECT rid, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS txt
  FROM word ANTI JOIN gone USING (rid, pos) GROUP BY rid
)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(txt, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""
