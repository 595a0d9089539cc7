"""Shared by the registered queries: tables and SQL spellings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from codequarry import fixed_values as V


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_list(values) -> str:
    return ", ".join(sql_text(v) for v in values)


# chr(...) keeps control characters out of the SQL text.
SQL_SPACE = " || ".join(f"chr({point})" for point in V.SPACE_CODE_POINTS)
SQL_SPACE_SET = f"({SQL_SPACE})"


def sql_strip(expression: str) -> str:
    return f"trim({expression}, {SQL_SPACE_SET})"


def sql_redact(expression: str) -> str:
    for pattern, label in V.SECRET_RULES:
        # RE2 folds case for Unicode without the extra flag
        spelled = pattern.replace("(?iu)", "(?i)")
        expression = f"regexp_replace({expression}, {sql_text(spelled)}, {sql_text(label)}, 'g')"
    return expression


def sql_drop_markers(expression: str, by: str = "") -> str:
    for marker in V.INSTRUCTION_MARKERS:
        expression = (
            f"regexp_replace({expression}, {sql_text('(?i)' + marker)}, {sql_text(by)}, 'g')"
        )
    return expression


def sql_escape(expression: str) -> str:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        expression = f"replace({expression}, '{char}', '{entity}')"
    return expression


def sql_offline(context: str, question: str) -> str:
    pieces = (
        f"list_filter(list_transform(string_split({context}, '```'), "
        f"lambda s: {sql_strip('s')}), lambda s: s <> '')[1:4]"
    )
    numbered = (
        f"list_transform({pieces}, lambda s, i: i::VARCHAR || '. ' || left(s, 400) || '...' || chr(10))"
    )
    opening = (
        f"[{sql_text(V.OFFLINE_QUESTION)} || {question} || chr(10), "
        f"{sql_text(V.OFFLINE_CONTEXT.rstrip())} || chr(10)]"
    )
    return f"array_to_string(list_concat({opening}, {numbered}), chr(10))"


def sql_entity_id(repo: str, path: str, kind: str, name: str, parent: str) -> str:
    return (
        f"left(sha256({repo} || ':' || {path} || ':' || {kind} || ':' || {name} || ':' || {parent}), 16)"
    )


def _mixed(k: str) -> str:
    """One block of MurmurHash3 (32 bits): multiply, rotate by 15, multiply."""
    first = f"(({k})::HUGEINT * 3432918353 % 4294967296)::BIGINT"
    return f"(list_transform([{first}], lambda x: (((x << 15) | (x >> 17)) & 4294967295)::HUGEINT * 461845907 % 4294967296)[1])::BIGINT"


def sql_word_bucket(word: str, width: int) -> str:
    """Bucket of a word as Spark's feature hashing has it: MurmurHash3 of its UTF-8 bytes, seed 42."""
    digits = f"hex(encode({word}))"
    size = f"octet_length(encode({word}))"
    little = lambda at, n: "('0x' || " + " || ".join(f"substr({digits}, ({at} + {2 * i} + 1)::INT, 2)" for i in reversed(range(n))) + ")::BIGINT"
    blocks = f"list_transform(range({size} // 4), lambda i: {_mixed(little('8 * i', 4))})"
    step = ("((list_transform([xor(h, k)], lambda y: ((y << 13) | (y >> 19)) & 4294967295)[1])::HUGEINT * 5 + 3864292196) % 4294967296")
    body = f"list_reduce([42::BIGINT] || {blocks}, lambda h, k: ({step})::BIGINT)"
    at = f"8 * ({size} // 4)"
    tail = (f"CASE {size} % 4 WHEN 1 THEN {_mixed(little(at, 1))} WHEN 2 THEN {_mixed(little(at, 2))} "
            f"WHEN 3 THEN {_mixed(little(at, 3))} ELSE 0 END")
    last = f"xor(xor({body}, {tail}), {size}::BIGINT)"
    for shift, factor in ((16, 2246822507), (13, 3266489909), (16, None)):
        last = f"(list_transform([{last}], lambda z: xor(z, z >> {shift}))[1])"
        if factor:
            last = f"({last}::HUGEINT * {factor} % 4294967296)::BIGINT"
    signed = f"(list_transform([{last}], lambda z: CASE WHEN z >= 2147483648 THEN z - 4294967296 ELSE z END)[1])"
    return f"((({signed} % {width}) + {width}) % {width})"


def sql_hashed_vectors(name: str, rows: str, width: int = 384) -> str:
    """CTEs up to ``name``(key, bucket, x): unit vectors of hashed word counts of ``rows`` (key, text), sparse."""
    return rf"""
{name}_words AS (SELECT key, unnest(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}_]+')) AS word FROM ({rows})),
{name}_known AS (SELECT word, {sql_word_bucket('word', width)} AS bucket FROM (SELECT DISTINCT word FROM {name}_words WHERE word <> '')),
{name}_counts AS (SELECT key, bucket, count(*) AS c FROM {name}_words JOIN {name}_known USING (word) GROUP BY 1, 2),
{name} AS (SELECT key, bucket, (c / sqrt(sum(c * c) OVER (PARTITION BY key)::DOUBLE))::FLOAT::DOUBLE AS x FROM {name}_counts)
"""
