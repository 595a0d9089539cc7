"""Text, id and URL functions over documents, conversations and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from codequarry import fixed_values as V
from codequarry.functions import identity, paths, text, urls
from registry.common import (
    sql_drop_markers,
    sql_escape,
    sql_list,
    sql_offline,
    sql_redact,
    sql_strip,
    sql_text,
    table,
)

HOSTS = "m.ththth.example.net,Thther.example.org, blog.tiontion.example.com,spam-farm.example.org"
_HOST_LIST = [h.strip().lower() for h in HOSTS.split(",")]


def redact(spark, d):
    docs = table(spark, d, "documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("key"), "text"
    )
    talk = table(spark, d, "conversations").select(
        F.lit("turn").alias("kind"), (F.col("conv_id") * 1000 + F.col("turn")).alias("key"), "text"
    )
    return docs.unionByName(talk).select("kind", "key", text.redact_secrets("text").alias("clean"))


REDACT_SQL = f"""
SELECT kind, key, {sql_redact('text')} AS clean FROM (
  SELECT 'document' AS kind, doc_id AS key, text FROM documents
  UNION ALL SELECT 'turn', conv_id * 1000 + turn, text FROM conversations)
"""


def redact_counts(spark, d):
    hits = text.secret_hits("text")
    rows = table(spark, d, "documents").select("source", hits.alias("h"))
    return rows.groupBy("source").agg(
        F.count_if(F.exists("h", lambda n: n > 0)).alias("documents"),
        *[F.sum(F.col("h")[i]).cast("bigint").alias(f"rule_{i + 1}") for i in range(4)],
    )


_COUNTS = [
    f"len(regexp_extract_all(text, {sql_text(p.replace('(?iu)', '(?i)'))}))"
    for p, _ in V.SECRET_RULES
]
REDACT_COUNTS_SQL = f"""
SELECT source, count(*) FILTER (WHERE a + b + c + e > 0) AS documents,
  sum(a)::BIGINT AS rule_1, sum(b)::BIGINT AS rule_2, sum(c)::BIGINT AS rule_3,
  sum(e)::BIGINT AS rule_4
FROM (SELECT source, {_COUNTS[0]} AS a, {_COUNTS[1]} AS b, {_COUNTS[2]} AS c, {_COUNTS[3]} AS e
      FROM documents) GROUP BY source
"""


def clean_question(spark, d):
    # Every turn is asked as it is, and once more with markers of the list around it.
    turns = table(spark, d, "conversations")
    marked = F.concat(
        F.lit("  You ARE now "), "text", F.lit("\tjailJAILBREAKbreak　System prompt ")
    )
    return turns.select(
        "conv_id", "turn",
        text.clean_question("text", 2000).alias("cleaned"),
        text.clean_question(marked, 2000).alias("cleaned_marked"),
        text.valid_question("text", 2000).alias("admissible"),
    )


def _sql_question(expression: str) -> str:
    return sql_strip(sql_drop_markers(f"left({sql_strip(expression)}, 2000)"))


_MARKED_SQL = (
    "' ' || chr(160) || 'You ARE now ' || text || chr(9) || 'jailJAILBREAKbreak' || chr(12288)"
    " || 'System prompt '"
)
CLEAN_QUESTION_SQL = f"""
SELECT conv_id, turn, {_sql_question('text')} AS cleaned,
  {_sql_question(_MARKED_SQL)} AS cleaned_marked,
  length(text) BETWEEN 1 AND 2000 AS admissible
FROM conversations
"""


def safe_output(spark, d):
    return table(spark, d, "pages").select(
        "page_id", text.escape_html("html").alias("escaped"), text.safe_output("html").alias("safe")
    )


SAFE_OUTPUT_SQL = f"""
SELECT page_id, {sql_escape('html')} AS escaped, {sql_escape(sql_redact('html'))} AS safe FROM pages
"""


def wrap_untrusted(spark, d):
    return table(spark, d, "documents").select("doc_id", text.wrap_untrusted("text").alias("wrapped"))


_OPEN = " || chr(10) || ".join(sql_text(line) for line in V.UNTRUSTED_OPEN.rstrip("\n").split("\n"))
WRAP_SQL = f"""
SELECT doc_id, {_OPEN} || chr(10) || {sql_drop_markers(sql_redact('text'), '[filtered]')}
  || chr(10) || {sql_text(V.UNTRUSTED_CLOSE.strip())} AS wrapped
FROM documents
"""


def url_check(spark, d):
    return table(spark, d, "pages").select(
        "page_id",
        urls.reject_reason("url", HOSTS).alias("reason"),
        urls.scheme("url").alias("scheme"),
        urls.host("url").alias("host"),
        urls.path("url").alias("path"),
        urls.normalised("url").alias("normalised"),
    )


_URL_PARTS = r"""
SELECT page_id, url,
  lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) AS scheme,
  lower(regexp_extract(url, '^[^:]*://([^/?#:]*)', 1)) AS host,
  regexp_replace(trim(regexp_extract(url, '^[^:]*://[^/?#]*([^?#]*)', 1), '/'), '\.git$', '') AS path
FROM pages
"""
URL_CHECK_SQL = f"""
WITH u AS ({_URL_PARTS}),
p AS (SELECT *, list_filter(string_split(path, '/'), lambda x: x <> '') AS parts FROM u)
SELECT page_id,
  CASE WHEN scheme NOT IN ('http', 'https') THEN 'scheme'
       WHEN host NOT IN ({sql_list(_HOST_LIST)}) THEN 'host'
       WHEN len(parts) < 2 THEN 'parts'
       WHEN len(list_filter(parts[1:2], lambda x: contains(x, '..') OR starts_with(x, '.'))) > 0
         THEN 'unsafe' END AS reason,
  scheme, host, path, rtrim(url, '/') AS normalised
FROM p
"""


def url_owner(spark, d):
    pages = table(spark, d, "pages")
    return pages.select(
        "page_id",
        identity.repository_id(urls.normalised("url")).alias("repository_id"),
        urls.owner("url").alias("owner"),
        urls.repository_name("url").alias("name"),
        identity.valid_repository_id(identity.repository_id("url")).alias("id_ok"),
        identity.valid_branch(urls.path("url")).alias("branch_ok"),
    )


URL_OWNER_SQL = f"""
WITH u AS ({_URL_PARTS})
SELECT page_id, left(sha256(rtrim(url, '/')), 12) AS repository_id,
  split_part(path, '/', 1) AS owner,
  CASE WHEN contains(path, '/') THEN split_part(path, '/', 1) || '/' || split_part(path, '/', 2) END
    AS name,
  TRUE AS id_ok,
  regexp_full_match(path, '[a-zA-Z0-9._/-]{{1,128}}') AS branch_ok
FROM u
"""


def path_parts(spark, d):
    path = urls.path("url")
    return table(spark, d, "pages").select(
        "page_id",
        paths.file_name(path).alias("name"),
        paths.stem(path).alias("stem"),
        paths.suffix(path).alias("suffix"),
        paths.parent_path(path).alias("parent"),
    )


PATH_PARTS_SQL = rf"""
WITH u AS ({_URL_PARTS}), n AS (SELECT *, string_split(path, '/')[-1] AS name FROM u),
s AS (SELECT *, regexp_extract(name, '.(\.[^.]+)$', 1) AS suffix FROM n)
SELECT page_id, name, left(name, length(name) - length(suffix)) AS stem, suffix,
  CASE WHEN contains(path, '/') THEN left(path, length(path) - length(name) - 1) ELSE '' END AS parent
FROM s
"""


def labels_and_titles(spark, d):
    part = table(spark, d, "part")
    name = F.concat_ws(" - ", "p_name", "p_brand", "p_type")
    return part.select(
        "p_partkey",
        text.diagram_label(name).alias("label"),
        text.title_word(F.col("p_name")).alias("title"),
        F.array_join(F.array_sort(text.setting_values(name)), ",").alias("setting"),
        text.head(name, V.CARD_CHARS).alias("card"),
    )


LABELS_SQL = """
WITH n AS (SELECT *, concat_ws(' - ', p_name, p_brand, p_type) AS n FROM part)
SELECT p_partkey, left(replace(replace(n, ' ', '_'), '-', '_'), 30) AS label,
  array_to_string(list_transform(string_split(p_name, ' '),
    lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ') AS title,
  lower(trim(n)) AS setting, left(n, 350) AS card
FROM n
"""


def offline_answer(spark, d):
    # The context is the page as it stands, in fenced pieces at its paragraphs.
    pages = table(spark, d, "pages")
    context = F.replace("html", F.lit("<p>"), F.lit("```"))
    return pages.select("page_id", text.offline_answer(context, F.col("url")).alias("answer"))


OFFLINE_SQL = f"""
SELECT page_id, {sql_offline("replace(html, '<p>', '```')", "url")} AS answer FROM pages
"""


def content_hashes(spark, d):
    return table(spark, d, "documents").select(
        "doc_id",
        identity.content_hash("text").alias("sha256"),
        text.newline_count("text").alias("newlines"),
    )


HASH_SQL = """
SELECT doc_id, sha256(text) AS sha256,
  (length(text) - length(replace(text, chr(10), '')))::INTEGER AS newlines FROM documents
"""

QUERIES = {
    "redact": (redact, REDACT_SQL),
    "redact_counts": (redact_counts, REDACT_COUNTS_SQL),
    "clean_question": (clean_question, CLEAN_QUESTION_SQL),
    "safe_output": (safe_output, SAFE_OUTPUT_SQL),
    "wrap_untrusted": (wrap_untrusted, WRAP_SQL),
    "url_check": (url_check, URL_CHECK_SQL),
    "url_owner": (url_owner, URL_OWNER_SQL),
    "path_parts": (path_parts, PATH_PARTS_SQL),
    "labels_and_titles": (labels_and_titles, LABELS_SQL),
    "offline_answer": (offline_answer, OFFLINE_SQL),
    "content_hashes": (content_hashes, HASH_SQL),
}
