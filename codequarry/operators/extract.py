"""Source files → entities, relations, nodes and edges.

One narrow stage: an Arrow-batched visitor per file reports facts, and every
further step is a built-in expression. Ids contain the file path, so repeats of
an id are inside one file: the visitor flags them, and neither nodes nor edges
need a shuffle to be unique.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from pyspark.sql.pandas.types import to_arrow_schema

from codequarry import fixed_values as V
from codequarry import schemas
from codequarry.functions import identity, paths, text
from codequarry.limits import DEFAULT_LIMITS, Limits
from codequarry.operators.visitor import python_facts

Visitor = Callable[[str], Iterable[dict]]

_VISITORS: dict[str, Visitor] = {}
_SUFFIXES: dict[str, str] = {}
# Facts handed back at a time, so that a batch of big files stays small.
_ROWS_OUT = 2048
_CHARS_OUT = 1 << 20


def register_language(language: str, suffixes: Iterable[str], visitor: Visitor) -> None:
    """Make files with these endings go through ``visitor``."""
    _VISITORS[language] = visitor
    _SUFFIXES.update({ending: language for ending in suffixes})


def visitor_for(language: str) -> Visitor:
    if language not in _VISITORS:
        raise ValueError(f"no visitor is registered for language {language!r}")
    return _VISITORS[language]


def language_of(path: Column | str) -> Column:
    """Language by file ending; null where none is registered."""
    pairs = [F.lit(x) for pair in sorted(_SUFFIXES.items()) for x in pair]
    return F.try_element_at(F.create_map(*pairs), paths.suffix(path))


register_language("python", [".py"], python_facts)


class _Columns:
    """Facts as rows in the order of the schema, handed on as one Arrow batch."""

    def __init__(self, schema: pa.Schema):
        self.schema = schema
        self.rows: list[tuple] = []
        self.chars = 0

    def __len__(self) -> int:
        return len(self.rows)

    def batch(self) -> pa.RecordBatch:
        lists = zip(*self.rows)
        arrays = [pa.array(values, field.type) for values, field in zip(lists, self.schema, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def _add_file(columns: _Columns, repository_id: str, rel_path: str, found: Iterable[dict]) -> None:
    """Add the facts of one file, marking what its earlier facts already named."""
    seen: set[tuple] = set()
    inherited: set[tuple] = set()
    add = columns.rows.append
    for ordinal, fact in enumerate(found):
        get = fact.get
        key = kind, name, owner = fact["kind"], get("name"), get("owner")
        content, bases = get("content"), None
        if get("bases"):
            links = [(name, base) for base in fact["bases"]]
            bases = []
            for link in links:
                bases.append({"name": link[1], "repeated": link in inherited})
                inherited.add(link)
        add((
            repository_id, rel_path, ordinal, kind, name, owner, get("line_start"), get("line_end"),
            get("signature"), get("docstring"), content, bases, key in seen, get("parse_error"),
        ))
        if content:
            columns.chars += len(content)
        seen.add(key)


def _visit(visitors: dict[str, Visitor], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = _Columns(schema)
        for batch in batches:
            *named, sources = batch.columns
            # Texts become Python strings one at a time, whatever the size of the batch.
            for (repository_id, rel_path, language), source in zip(zip(*(c.to_pylist() for c in named)), sources):
                # A syntax tree has no cycles: looking for them while it grows finds nothing.
                gc.disable()
                try:
                    _add_file(columns, repository_id, rel_path, visitors[language](source.as_py()))
                finally:
                    gc.enable()
                if len(columns) >= _ROWS_OUT or columns.chars >= _CHARS_OUT:
                    made, columns = columns.batch(), _Columns(schema)
                    yield made
                    del made
            # Gone before the next one is read.
            batch = named = sources = source = None
        if len(columns):
            yield columns.batch()

    return run


def facts(files: DataFrame) -> DataFrame:
    """Raw facts of eligible files (``repository_id, rel_path, content``)."""
    wanted = files.select(
        "repository_id",
        "rel_path",
        language_of("rel_path").alias("language"),
        paths.text_of("content").alias("source"),
    ).filter(F.col("language").isNotNull())
    return wanted.mapInArrow(_visit(dict(_VISITORS), to_arrow_schema(schemas.FACTS)), schemas.FACTS)


def parse_errors(facts_df: DataFrame) -> DataFrame:
    """Lines that the reader of a file had to leave out, and why; all else in the file is read."""
    return facts_df.filter(F.col("kind") == "Error").select(
        "repository_id", "rel_path", "line_start", "line_end", "parse_error"
    )


def error_spans(errors: DataFrame) -> DataFrame:
    """``parse_errors`` as (repository_id, rel_path, line_start, line_end, errors): lines
    that lie next to each other are one span, with the number of its errors."""
    by_file = Window.partitionBy("repository_id", "rel_path").orderBy("line_start", "line_end")
    reached = F.max("line_end").over(by_file.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce(F.col("line_start") > reached + 1, F.lit(True)).cast("int")
    spans = errors.withColumn("_new", new).withColumn("_span", F.sum("_new").over(by_file))
    return spans.groupBy("repository_id", "rel_path", "_span").agg(
        F.min("line_start").alias("line_start"), F.max("line_end").alias("line_end"), F.count(F.lit(1)).alias("errors"),
    ).drop("_span")


def _docstring_text(raw: Column) -> Column:
    # Quotes are stripped as character sets; a string prefix blocks the front.
    for quote in ('"', "'", '"', "'"):
        raw = F.btrim(raw, F.lit(quote))
    return raw


def _shown(limits: Limits) -> Column:
    """The text of a fact as far as its entity shows it; other languages' visitors decide for themselves."""
    content = F.col("content")
    python = F.coalesce(language_of("rel_path") == "python", F.lit(False))
    module, block = F.col("kind") == "Module", F.col("kind").isin(*V.COUNTED_TYPES)
    for kind, chars in ((module, limits.module_chars), (block, limits.block_chars)):
        if chars is not None:
            content = F.when(python & kind, text.head("content", chars)).otherwise(content)
    return content


def entities(facts_df: DataFrame, limits: Limits = DEFAULT_LIMITS, redacted: bool = False) -> DataFrame:
    """Entities with ids and redacted content, repeats included and flagged.

    Texts are shown as far as ``limits`` says, cut first and redacted after, unless the
    facts' content is ``redacted`` already: a second time changes nothing.
    """
    shown = _shown(limits) if redacted else text.redact_secrets(_shown(limits))
    repo, path = F.col("repository_id"), F.col("rel_path")
    module = identity.module_id(repo, path)
    is_module = F.col("kind") == "Module"
    parent = (
        F.when(is_module, F.lit(""))
        .when(F.col("owner").isNotNull(), identity.class_id(repo, path, F.col("owner")))
        .otherwise(module)
    )
    key_name = F.when(is_module, path).otherwise(F.col("name"))
    rows = facts_df.filter(F.col("kind") != "Error").withColumn("parent_id", parent)
    return rows.select(
        identity.entity_id(repo, path, F.col("kind"), key_name, F.col("parent_id")).alias("id"),
        "repository_id",
        F.when(is_module, paths.stem(path)).otherwise(F.col("name")).alias("name"),
        F.col("kind").alias("entity_type"),
        path.alias("file_path"),
        "line_start",
        "line_end",
        "signature",
        _docstring_text(F.col("docstring")).alias("docstring"),
        F.when(F.col("kind") == "Import", F.col("content"))
        .otherwise(shown)
        .alias("content"),
        "parent_id",
        "bases",
        "ordinal",
        "repeated",
    )


def relations(entities_df: DataFrame) -> DataFrame:
    """Relations as met in the source; ``repeated`` marks all but the first."""
    kind = (
        F.when(F.col("entity_type") == "Import", "IMPORTS")
        .when(F.col("entity_type") == "Class", "CONTAINS")
        .otherwise("DEFINES")
    )
    own = F.struct(
        F.col("parent_id").alias("source_id"),
        F.col("id").alias("target_id"),
        kind.alias("relation_type"),
        F.col("repeated").alias("repeated"),
    )
    base_id = lambda b: identity.class_id(
        F.col("repository_id"), F.col("file_path"), b["name"]
    )
    inherits = F.transform(
        "bases",
        lambda b: F.struct(
            F.col("id").alias("source_id"),
            base_id(b).alias("target_id"),
            F.lit("INHERITS").alias("relation_type"),
            b["repeated"].alias("repeated"),
        ),
    )
    both = F.concat(F.array(own), F.coalesce(inherits, F.expr("array()").cast(
        "array<struct<source_id:string,target_id:string,relation_type:string,repeated:boolean>>"
    )))
    rows = entities_df.filter(F.col("entity_type") != "Module")
    return rows.select("repository_id", F.explode(both).alias("r")).select(
        "repository_id", "r.*"
    )


def nodes(entities_df: DataFrame) -> DataFrame:
    """One node per id; the docstring, or else the signature, is its content."""
    shown = F.coalesce(text.blank_to_null("docstring"), F.col("signature"))
    return entities_df.filter(~F.col("repeated")).select(
        "id",
        "repository_id",
        "name",
        F.col("entity_type").alias("node_type"),
        "file_path",
        F.col("line_start").alias("start_line"),
        F.col("line_end").alias("end_line"),
        text.redact_secrets(shown).alias("content"),
    )


def edges(relations_df: DataFrame) -> DataFrame:
    return relations_df.filter(~F.col("repeated")).select(
        "repository_id",
        F.col("source_id").alias("source_node_id"),
        F.col("target_id").alias("target_node_id"),
        F.col("relation_type").alias("edge_type"),
    )
