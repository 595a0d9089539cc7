"""Extraction and what follows it, over source files written from ``orders``.

Spark writes one Python file per order row, and the same rows tell SQL what a
reader of those files must find. Documents (prose) are read as files as well.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from codequarry.operators import chunks as chunk_ops
from codequarry.operators import extract, graph
from codequarry.plans import ingest, reports
from codequarry.session import materialise, spread_scan
from registry.common import sql_entity_id, sql_hashed_vectors, sql_redact, table

KEY = "repository_id"
# Rows of a file of a table whose readers sort what they read.
SORTED_ROWS = 50_000

_FILE = '''"""Order %1$s."""
import status_%2$s
from customers import customer_%3$s, account
import status_%2$s


class Order(Base, Customer_%3$s, metaclass=Meta):
    """Priority %4$s"""
    limit = %1$s

    def total(self, rate=%5$s):
        """Total of the order."""
        return rate

    @property
    def day(self):
        return "%6$s"

    def day(self, value):
        self.value = value


async def main(key={"a": (%1$s, ")")}):
    password = "secret-%1$s-%3$s"
    def inner():
        return None
    return key
'''
# The same files with mistakes of five kinds in one method, before and behind what is found.
_WRONG = ("x = = 1", "print 'old', rate", "rate = (rate,", "raise Error, rate", "return rate 1")
_TOP = ("def (:", "x = [1, 2", "class 9:", "for in x", "else ::")
_BROKEN = _FILE.replace("        return rate\n", "        %7$s\n        return rate\n").replace(
    "\n\nasync def main", "\n%8$s\nasync def main")
_NAMES = ("key", "status", "customer", "priority", "cents", "day", "wrong", "top")


def order_files(spark, d):
    columns = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "o_orderdate")
    orders = spread_scan(table(spark, d, "orders").select(*columns))
    text = F.format_string(
        _FILE,
        F.col("o_orderkey").cast("string"),
        F.col("o_orderstatus"),
        F.col("o_custkey").cast("string"),
        F.col("o_orderpriority"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string"),
        F.date_format("o_orderdate", "yyyy-MM-dd"),
    )
    rows = orders.select(
        F.substring(F.sha2("o_orderpriority", 256), 1, 12).alias(KEY),
        F.concat(F.lit("orders/order_"), F.col("o_orderkey").cast("string"), F.lit(".py")).alias(
            "rel_path"
        ),
        text.cast("binary").alias("content"),
    )
    return rows.withColumn("length", F.octet_length("content").cast("bigint"))


def _sql_text(template: str) -> str:
    """SQL expression of a piece of the file."""
    for position, name in enumerate(_NAMES, 1):
        template = template.replace(f"%{position}$s", "\x00" + name + "\x00")
    pieces = []
    for i, piece in enumerate(template.split("\x00")):
        if i % 2:
            pieces.append(piece)
        else:
            quoted = ["'" + line.replace("'", "''") + "'" for line in piece.split("\n")]
            pieces.append(" || chr(10) || ".join(quoted))
    return "(" + " || ".join(pieces) + ")"


_MODULE = sql_entity_id("repo", "path", "'Module'", "path", "''")
_CLASS = sql_entity_id("repo", "path", "'Class'", "'Order'", "module")


def _found(text: str) -> list[tuple]:
    """type, name, parent, first line, last line, signature, docstring, text, repeated"""
    rows = text.split("\n")
    lines = lambda first, last: "\n".join(rows[first - 1 : last])
    at = lambda start, n=0: [i for i, row in enumerate(rows, 1) if row.startswith(start)][n]
    total, day, again, main = at("    def total"), at("    def day"), at("    def day", 1), at("async def main")
    return [
        ("Module", None, "''", 1, len(rows), None, None, text, False),
        ("Import", lines(2, 2), "module", 2, 2, None, None, lines(2, 2), False),
        ("Import", lines(3, 3), "module", 3, 3, None, None, lines(3, 3), False),
        ("Import", lines(4, 4), "module", 4, 4, None, None, lines(4, 4), True),
        ("Class", "Order", "module", 7, again + 1, None, "Priority %4$s", lines(7, again + 1), False),
        ("Method", "total", "class", total, day - 3, "total(self, rate=%5$s)", "Total of the order.",
         lines(total, day - 3).lstrip(), False),
        ("Method", "day", "class", day, day + 1, "day(self)", None, lines(day, day + 1).lstrip(), False),
        ("Method", "day", "class", again, again + 1, "day(self, value)", None, lines(again, again + 1).lstrip(), True),
        ("Function", "main", "module", main, main + 4, 'main(key={"a": (%1$s, ")")})', None, lines(main, main + 4), False),
    ]


def _entity_sql(number: int, row: tuple) -> str:
    kind, name, parent, first, last, signature, docstring, body, repeated = row
    shown = "stem" if name is None else _sql_text(name)
    keyed = "path" if name is None else _sql_text(name)
    optional = lambda x: "NULL::VARCHAR" if x is None else _sql_text(x)
    content = _sql_text(body) if kind == "Import" else sql_redact(_sql_text(body))
    parent_id = {"module": "module", "class": "class"}.get(parent, "''")
    return (
        f"SELECT {number} AS ordinal, {sql_entity_id('repo', 'path', f'''{chr(39)}{kind}{chr(39)}''', keyed, parent_id)} AS id, "
        f"repo AS repository_id, {shown} AS name, '{kind}' AS entity_type, path AS file_path, "
        f"{first} AS line_start, {last} AS line_end, {optional(signature)} AS signature, "
        f"{optional(docstring)} AS docstring, {content} AS content, {parent_id} AS parent_id, "
        f"{str(repeated).upper()} AS repeated, module, class, customer FROM ids"
    )


ENTITIES_CTE = f"""
raw AS (SELECT o_orderkey::VARCHAR AS key, o_orderstatus AS status, o_custkey::VARCHAR AS customer,
  o_orderpriority AS priority, round(o_totalprice * 100)::BIGINT::VARCHAR AS cents,
  strftime(o_orderdate, '%Y-%m-%d') AS day, left(sha256(o_orderpriority), 12) AS repo,
  'orders/order_' || o_orderkey || '.py' AS path, 'order_' || o_orderkey AS stem FROM orders),
modules AS (SELECT *, {_MODULE} AS module FROM raw),
ids AS (SELECT *, {_CLASS} AS class FROM modules),
entities AS ({' UNION ALL '.join(_entity_sql(i, row) for i, row in enumerate(_found(_FILE)))})
"""


def _case(rows: tuple) -> str:
    return "CASE o_orderkey % 5 " + " ".join(
        "WHEN {} THEN '{}'".format(i, row.replace("'", "''")) for i, row in enumerate(rows)) + " END"


_BROKEN_CTE = ENTITIES_CTE[: ENTITIES_CTE.index("entities AS (")].replace(
    "o_orderstatus AS status,", f"o_orderstatus AS status, {_case(_WRONG)} AS wrong, {_case(_TOP)} AS top,"
) + f"entities AS ({' UNION ALL '.join(_entity_sql(i, row) for i, row in enumerate(_found(_BROKEN)))})"
RELATIONS_CTE = f"""
relations AS (
  SELECT repository_id, parent_id AS source_id, id AS target_id,
    CASE entity_type WHEN 'Import' THEN 'IMPORTS' WHEN 'Class' THEN 'CONTAINS' ELSE 'DEFINES' END
      AS relation_type, repeated FROM entities WHERE entity_type <> 'Module'
  UNION ALL
  SELECT repository_id, id, left(sha256(repository_id || ':' || file_path || ':Class:' || base || ':'
    || module), 16), 'INHERITS', FALSE
  FROM (SELECT *, unnest(['Base', 'Customer_' || customer]) AS base FROM entities
        WHERE entity_type = 'Class'))
"""
NODES_CTE = f"""
nodes AS (SELECT id, repository_id, name, entity_type AS node_type, file_path,
  line_start AS start_line, line_end AS end_line,
  {sql_redact("coalesce(nullif(docstring, ''), signature)")} AS content
  FROM entities WHERE NOT repeated)
"""
_CHUNK = (
    "concat_ws(chr(10), '# ' || entity_type || ': ' || name, 'File: ' || nullif(file_path, ''), "
    "'Signature: ' || nullif(signature, ''), 'Docstring: ' || nullif(docstring, ''), "
    "nullif(content, ''))"
)


def _facts(spark, d):
    return extract.facts(order_files(spark, d))


def extracted_entities(spark, d):
    return extract.entities(_facts(spark, d)).drop("bases")


def extracted_relations(spark, d):
    return extract.relations(extract.entities(_facts(spark, d)))


def ingest_nodes(spark, d):
    return extract.nodes(extract.entities(_facts(spark, d)))


def ingest_edges(spark, d):
    return extract.edges(extracted_relations(spark, d))


def ingest_chunks(spark, d):
    rows = chunk_ops.chunk_rows(extract.entities(_facts(spark, d)))
    return rows.filter(~F.col("repeated")).drop("repeated")


def ingest_totals(spark, d):
    return ingest.ingest_totals(extract.entities(_facts(spark, d)))


def extracted_module_stats(spark, d):
    return graph.module_stats(ingest_nodes(spark, d))


def extracted_overview(spark, d):
    # A report reads its nodes several times, from a table as it would be stored.
    return reports.overview(materialise(ingest_nodes(spark, d), "nodes", SORTED_ROWS))


def extracted_dangling(spark, d):
    """Inherited classes that no file of the repository defines."""
    # Nodes and edges read no texts, which are most of what facts hold: only chunks do, and none are made here.
    named = materialise(_facts(spark, d).drop("content"), "facts")
    made = ingest.from_facts(named.withColumn("content", F.lit(None).cast("string")))
    return graph.dangling_targets(made.edges, made.nodes).groupBy(KEY).agg(
        F.count(F.lit(1)).alias("targets"), F.sum("edges").cast("bigint").alias("edges")
    )


def _prose_facts(spark, d):
    docs = spread_scan(table(spark, d, "documents")).select(
        F.col("source").alias(KEY),
        F.concat(F.lit("docs/"), F.col("doc_id").cast("string"), F.lit(".py")).alias("rel_path"),
        F.col("text").cast("binary").alias("content"),
    )
    return extract.facts(docs)


def prose_modules(spark, d):
    """Documents read as files: a module each, with all of its text."""
    return extract.entities(_prose_facts(spark, d)).drop("bases", "signature", "docstring")


def prose_chunks_whole(spark, d):
    """Chunks of the documents joined again: all of each text, under its title and path."""
    chunks = chunk_ops.chunk_rows(extract.entities(_prose_facts(spark, d)))
    parts = F.sort_array(F.collect_list(F.struct("part", "content")))
    return chunks.groupBy("repository_id", "file_path").agg(
        F.max(F.length("content")).alias("longest"), F.array_join(F.transform(parts, lambda p: p["content"]), "").alias("content")
    ).select("repository_id", "file_path", (F.col("longest") <= 6000).alias("fits"), "content")


def prose_chunk_parts(spark, d):
    """Every chunk of the documents with the node that it belongs to."""
    entities = extract.entities(_prose_facts(spark, d))
    chunks = chunk_ops.chunk_rows(entities).select("id", "entity_id", "part", KEY, F.sha2("content", 256).alias("sha256"))
    owners = extract.nodes(entities).select(KEY, F.col("id").alias("entity_id"), F.col("name").alias("node"))
    return chunks.join(owners, [KEY, "entity_id"], "left")


# Pieces end behind the last white space that fits; what is left goes on.
PARTS_SQL = f"""
WITH RECURSIVE t AS (
  SELECT doc_id, source AS repository_id, left(sha256(source || ':docs/' || doc_id || '.py:Module:docs/' || doc_id || '.py:'), 16) AS id,
    {sql_redact("concat_ws(chr(10), '# Module: ' || doc_id, 'File: docs/' || doc_id || '.py', nullif(text, ''))")} AS content
  FROM documents
), cut AS (
  SELECT id, repository_id, doc_id, 0 AS part, '' AS piece, content AS rest FROM t
  UNION ALL
  SELECT id, repository_id, doc_id, part + 1, left(rest, n), substr(rest, n + 1) FROM (
    SELECT *, CASE WHEN length(rest) <= 6000 THEN length(rest) WHEN kept = 0 THEN 6000 ELSE kept END AS n FROM (
      SELECT *, length(regexp_replace(left(rest, 6000), '[^ \t\n\x0B\f\r]*$', '')) AS kept FROM cut WHERE rest <> ''))
)
SELECT CASE WHEN part = 1 THEN id ELSE id || '#' || part END AS id, id AS entity_id, part, repository_id,
  sha256(piece) AS sha256, doc_id::VARCHAR AS node FROM cut WHERE part > 0
"""




def broken_files(spark, d):
    """``order_files`` with a broken statement in a method and a broken line between the definitions."""
    orders = spread_scan(table(spark, d, "orders"))
    pick = lambda rows: F.element_at(F.array(*[F.lit(x) for x in rows]), (F.col("o_orderkey") % 5 + 1).cast("int"))
    text = F.format_string(
        _BROKEN, F.col("o_orderkey").cast("string"), F.col("o_orderstatus"), F.col("o_custkey").cast("string"),
        F.col("o_orderpriority"), F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string"),
        F.date_format("o_orderdate", "yyyy-MM-dd"), pick(_WRONG), pick(_TOP),
    )
    return orders.select(
        F.substring(F.sha2("o_orderpriority", 256), 1, 12).alias(KEY),
        F.concat(F.lit("orders/order_"), F.col("o_orderkey").cast("string"), F.lit(".py")).alias("rel_path"),
        text.cast("binary").alias("content"), F.octet_length(text).cast("bigint").alias("length"),
    )


def broken_entities(spark, d):
    """Entities of files with errors: all that intact ones have."""
    return extract.entities(extract.facts(broken_files(spark, d))).drop("bases", "ordinal")


def broken_relations(spark, d):
    return extract.relations(extract.entities(extract.facts(broken_files(spark, d))))


def broken_errors(spark, d):
    """The lines left out, as spans, with the number of errors in each."""
    return extract.error_spans(extract.parse_errors(extract.facts(broken_files(spark, d))))


def hashed_vectors(spark, d):
    """Document vectors: width, length, buckets in use, and a sum that depends on which they are."""
    docs = spread_scan(table(spark, d, "documents").select("doc_id", "text"))
    made = chunk_ops.with_norm(chunk_ops.hashed_vectors(docs, "text"))
    spots = F.transform("embedding", lambda x, i: x.cast("double") * (i + 1))
    return made.select(
        "doc_id", F.size("embedding").alias("width"), F.round("norm", 3).alias("norm"),
        F.size(F.filter("embedding", lambda x: x > 0)).alias("buckets"),
        F.round(F.aggregate(spots, F.lit(0.0), lambda a, x: a + x), 4).alias("moment"),
    )



def _broken_line(mark: str) -> int:
    return next(i for i, line in enumerate(_BROKEN.split("\n"), 1) if mark in line)


_ENTITY_COLUMNS = (
    "id, repository_id, name, entity_type, file_path, line_start, line_end, signature, docstring, "
    "content, parent_id, ordinal, repeated"
)
QUERIES = {
    "extracted_entities": (
        extracted_entities, f"WITH {ENTITIES_CTE} SELECT {_ENTITY_COLUMNS} FROM entities",
    ),
    "extracted_relations": (
        extracted_relations, f"WITH {ENTITIES_CTE}, {RELATIONS_CTE} SELECT * FROM relations",
    ),
    "ingest_nodes": (ingest_nodes, f"WITH {ENTITIES_CTE}, {NODES_CTE} SELECT * FROM nodes"),
    "ingest_edges": (
        ingest_edges,
        f"""WITH {ENTITIES_CTE}, {RELATIONS_CTE}
        SELECT DISTINCT repository_id, source_id AS source_node_id, target_id AS target_node_id,
          relation_type AS edge_type FROM relations""",
    ),
    "ingest_chunks": (
        ingest_chunks,
        f"""WITH {ENTITIES_CTE}
        SELECT id, id AS entity_id, 1 AS part, repository_id, file_path, name AS entity_name, entity_type,
          {sql_redact(_CHUNK)} AS content, line_start, line_end
        FROM entities WHERE entity_type <> 'Import' AND NOT repeated""",
    ),
    "ingest_totals": (
        ingest_totals,
        f"""WITH {ENTITIES_CTE}
        SELECT repository_id, count(*) FILTER (WHERE entity_type = 'Module') AS files,
          count(*) AS entities, count(*) FILTER (WHERE entity_type <> 'Import') AS chunks,
          count(*) FILTER (WHERE NOT repeated) AS distinct_entities,
          count(*) FILTER (WHERE entity_type <> 'Import' AND NOT repeated) AS distinct_chunks
        FROM entities GROUP BY 1""",
    ),
    "extracted_module_stats": (
        extracted_module_stats,
        f"""WITH {ENTITIES_CTE}, {NODES_CTE}
        SELECT repository_id, file_path AS path, count(*) FILTER (WHERE node_type = 'Class') AS classes,
          count(*) FILTER (WHERE node_type = 'Function') AS functions,
          count(*) FILTER (WHERE node_type = 'Method') AS methods
        FROM nodes WHERE node_type IN ('Class', 'Function', 'Method') GROUP BY 1, 2""",
    ),
    "extracted_overview": (
        extracted_overview,
        f"""WITH {ENTITIES_CTE}, {NODES_CTE},
        stats AS (SELECT repository_id, file_path AS path,
          count(*) FILTER (WHERE node_type = 'Class') AS c,
          count(*) FILTER (WHERE node_type = 'Function') AS f
          FROM nodes WHERE node_type IN ('Class', 'Function', 'Method') GROUP BY 1, 2
          QUALIFY row_number() OVER (PARTITION BY repository_id ORDER BY file_path) <= 20),
        m AS (SELECT repository_id, string_agg('- `' || path || '`: ' || c || ' classes, ' || f
          || ' functions', chr(10) ORDER BY path) AS t FROM stats GROUP BY 1),
        heads AS (SELECT *, row_number() OVER (PARTITION BY repository_id ORDER BY name, id) AS n FROM nodes),
        e AS (SELECT repository_id, string_agg('- **' || node_type || '** `' || name || '` in `'
          || file_path || '`', chr(10) ORDER BY n) AS t FROM heads WHERE n <= 20 GROUP BY 1)
        SELECT repository_id, '# Repository Overview' || chr(10) || chr(10) || '## Modules' || chr(10)
          || chr(10) || m.t || chr(10) || chr(10) || '## Key entities' || chr(10) || chr(10) || e.t
          AS content FROM m JOIN e USING (repository_id)""",
    ),
    "extracted_dangling": (
        extracted_dangling,
        f"""WITH {ENTITIES_CTE}, {RELATIONS_CTE}, {NODES_CTE},
        missing AS (SELECT r.repository_id, target_id, count(*) AS n
          FROM (SELECT DISTINCT repository_id, source_id, target_id, relation_type FROM relations) r
          ANTI JOIN nodes ON nodes.id = target_id AND nodes.repository_id = r.repository_id GROUP BY 1, 2)
        SELECT repository_id, count(*) AS targets, sum(n)::BIGINT AS edges FROM missing GROUP BY 1""",
    ),
    "prose_modules": (
        prose_modules,
        f"""SELECT left(sha256(source || ':docs/' || doc_id || '.py:Module:docs/' || doc_id || '.py:'), 16)
          AS id, source AS repository_id, doc_id::VARCHAR AS name, 'Module' AS entity_type,
          'docs/' || doc_id || '.py' AS file_path, 1 AS line_start,
          (length(text) - length(replace(text, chr(10), '')) + 1)::INTEGER AS line_end,
          {sql_redact('text')} AS content, '' AS parent_id, 0 AS ordinal, FALSE AS repeated
        FROM documents""",
    ),
    "prose_modules_whole": (
        prose_modules,
        f"""SELECT left(sha256(source || ':docs/' || doc_id || '.py:Module:docs/' || doc_id || '.py:'), 16)
          AS id, source AS repository_id, doc_id::VARCHAR AS name, 'Module' AS entity_type,
          'docs/' || doc_id || '.py' AS file_path, 1 AS line_start,
          (length(text) - length(replace(text, chr(10), '')) + 1)::INTEGER AS line_end,
          {sql_redact('text')} AS content, '' AS parent_id, 0 AS ordinal, FALSE AS repeated
        FROM documents""",
    ),
    "prose_chunks_whole": (
        prose_chunks_whole,
        f"""SELECT source AS repository_id, 'docs/' || doc_id || '.py' AS file_path, TRUE AS fits,
          {sql_redact("concat_ws(chr(10), '# Module: ' || doc_id, 'File: docs/' || doc_id || '.py', nullif(text, ''))")}
          AS content FROM documents""",
    ),
    "prose_chunk_parts": (prose_chunk_parts, PARTS_SQL),
    "broken_entities": (
        broken_entities, f"WITH {_BROKEN_CTE} SELECT {_ENTITY_COLUMNS.replace('ordinal, ', '')} FROM entities",
    ),
    "broken_relations": (
        broken_relations, f"WITH {_BROKEN_CTE}, {RELATIONS_CTE} SELECT * FROM relations",
    ),
    "broken_errors": (
        broken_errors,
        f"""SELECT left(sha256(o_orderpriority), 12) AS repository_id, 'orders/order_' || o_orderkey || '.py' AS rel_path,
          line AS line_start, line AS line_end, 1::BIGINT AS errors
        FROM orders, (SELECT unnest([{_broken_line('%7$s')}, {_broken_line('%8$s')}]) AS line)""",
    ),
    "hashed_vectors": (
        hashed_vectors,
        f"""WITH {sql_hashed_vectors('v', "SELECT doc_id AS key, text FROM documents")}
        SELECT doc_id, 384 AS width, round(coalesce(sqrt(sum(x * x)), 0), 3) AS norm, count(x)::INTEGER AS buckets,
          round(coalesce(sum(x * (bucket + 1)), 0), 4) AS moment
        FROM documents LEFT JOIN v ON key = doc_id GROUP BY doc_id""",
    ),
}
