"""Raw JSON documents: parse, route by type, reject bad input.

Documents arrive as text (one per row).  Each type is parsed with an
explicit schema by ``from_json``; nothing is inferred and nothing runs per
row in Python.  One rule rejects: the text must be a JSON object that fits
the schema value by value, and have an ``id``.  A reject keeps its text and
columns and gets a reason.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.schemas import COHORT_DOC, COHORT_MEMBERS_KEY, ENTITY_DOC, LEGACY_ENTITY_DOC
from cohortkit.functions.columns import url_key
from cohortkit.session import scratch_path
from cohortkit.sources.files import COMPRESSION, CORRUPT, materialize

REASON = "reason"
DOC = "doc"


def _entity_columns(d: Column) -> list[Column]:
    # zipped fields rather than a lambda per element: they stay in generated code
    stats, abilities = d.getField("stats"), d.getField("abilities")
    return [
        d.getField("id").alias("id"),
        d.getField("name").alias("name"),
        F.arrays_zip(stats["stat"]["name"].alias("name"), stats["base_stat"].alias("value")).alias("measures"),
        F.arrays_zip(abilities["ability"]["name"].alias("tag"), abilities["is_hidden"].alias("hidden")).alias("tags"),
        d.getField("types").getField("type").getField("name").alias("kinds"),
    ]


def _cohort_columns(d: Column) -> list[Column]:
    return [
        d.getField("id").alias("cohort_id"),
        d.getField("name").alias("name"),
        d.getField(COHORT_MEMBERS_KEY).getField("name").alias("members"),
        d.getField("abilities").getField("name").alias("tags"),
    ]


def _reason(fits: Column, has_id: Column) -> Column:
    return F.when(~F.coalesce(fits, F.lit(False)), F.lit("does not parse")).when(~has_id, F.lit("no id"))


@dataclass(frozen=True)
class DocKind:
    """How documents of one type are read: ``parse`` turns the text into a
    value, ``columns`` the value into typed columns, ``fits`` tells whether the
    text was such a document and ``key`` whether it names its object."""
    parse: Callable[[Column], Column]
    columns: Callable[[Column], list[Column]]
    fits: Callable[[Column], Column]
    key: Callable[[Column], Column]

    def marks(self, value: Column) -> tuple[Column, Column]:
        """The struct of typed columns, and the reason of a reject."""
        return F.struct(*self.columns(value)), _reason(self.fits(value), self.key(value).isNotNull())


def _json_kind(schema: T.StructType, columns: Callable[[Column], list[Column]]) -> DocKind:
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return DocKind(lambda raw: F.from_json(raw, full, {"columnNameOfCorruptRecord": CORRUPT}), columns,
                   lambda d: d.isNotNull() & d.getField(CORRUPT).isNull(), lambda d: d.getField("id"))


def _tree(v: Column) -> Column:
    tree = F.try_variant_get(v, "$.chain", "variant")
    return F.when(~F.is_variant_null(tree), tree)


def _tree_key(v: Column) -> Column:
    return F.try_variant_get(v, "$.id", "bigint")


def _tree_fits(v: Column) -> Column:
    # an object, and no other value, casts to a struct; one short field of it is
    # looked at, where its whole schema would mean a walk over every node
    is_object = lambda path, field: F.try_variant_get(v, path, f"struct<{field}:variant>").isNotNull()
    raw_key = F.try_variant_get(v, "$.id", "variant")
    return is_object("$", "id") & (_tree(v).isNull() | is_object("$.chain", "species")) & (raw_key.isNull() | F.is_variant_null(raw_key) | _tree_key(v).isNotNull())


ENTITIES = _json_kind(ENTITY_DOC, _entity_columns)
COHORTS = _json_kind(COHORT_DOC, _cohort_columns)
#: The tree as a variant, so that a tree of any depth fits (the JSON parser
#: itself refuses more than 1000 nested brackets: a reject like other
#: unparsable text).
CHAINS = DocKind(F.try_parse_json, lambda v: [_tree_key(v).alias("chain_id"), _tree(v).alias("chain")], _tree_fits, _tree_key)


def _mark(docs: DataFrame, raw_col: str, kind: DocKind) -> DataFrame:
    """The documents with the struct ``doc`` of their parsed columns and the
    ``reason`` of a reject (null for a good document): one parse for both.  They
    pass through a generator, so that a filter on the reason stays above and
    does not parse the text again for each of its terms."""
    parsed = docs.select("*", kind.parse(F.col(raw_col)).alias("__d"))
    doc, reason = kind.marks(F.col("__d"))
    return parsed.select(*docs.columns, F.inline(F.array(F.struct(doc.alias(DOC), reason.alias(REASON)))))


def split_marked(marked: DataFrame, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """``(good, rejected)`` of marked documents: ``keep`` and the parsed columns;
    the input columns and the reason."""
    good = marked.where(F.col(REASON).isNull()).select(*keep, f"{DOC}.*")
    return good, marked.where(F.col(REASON).isNotNull()).drop(DOC)


def mark_entities(docs: DataFrame, raw_col: str = "raw") -> DataFrame:
    return _mark(docs, raw_col, ENTITIES)


def mark_cohorts(docs: DataFrame, raw_col: str = "raw") -> DataFrame:
    return _mark(docs, raw_col, COHORTS)


def mark_chains(docs: DataFrame, raw_col: str = "raw") -> DataFrame:
    return _mark(docs, raw_col, CHAINS)


def parse_entities(docs: DataFrame, raw_col: str = "raw",
                   keep: Sequence[str] = (), workdir: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Entity documents (text) to ``(id, name, measures, tags, kinds)`` (A1-A3).

    measures: ``[(stat.name, base_stat)]``; tags: ``[(ability.name,
    is_hidden)]``; kinds: ``[type.name]``.  ``keep`` columns of the input
    are passed through.  Returns ``(good, rejected)``.  For callers that read
    both: with ``workdir`` the marked documents are written there first, a good
    one without its text, so ``docs`` is read and parsed once.
    """
    marked = mark_entities(docs, raw_col)
    if workdir:
        dropped = F.when(F.col(REASON).isNotNull() | F.lit(raw_col in keep), F.col(raw_col))
        marked = materialize(marked.withColumn(raw_col, dropped), workdir)
    return split_marked(marked, keep)


def entities_from_docs(docs: DataFrame, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """As :func:`parse_entities` for objects that the JSON reader already
    parsed into :data:`ENTITY_DOC` columns (:func:`read_json_arrays`), by the
    same rule: what the reader flagged as corrupt is a reject."""
    fits = F.col(CORRUPT).isNull() if CORRUPT in docs.columns else F.lit(True)
    d = F.struct(*[F.col(f.name) for f in ENTITY_DOC.fields])
    marked = docs.select("*", F.struct(*_entity_columns(d)).alias(DOC), _reason(fits, F.col("id").isNotNull()).alias(REASON))
    return split_marked(marked, keep)


def parse_cohorts(docs: DataFrame, raw_col: str = "raw",
                  keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Cohort documents (text) to ``(cohort_id, name, members, tags)`` (A4/A5)."""
    return split_marked(mark_cohorts(docs, raw_col), keep)


def parse_chains(docs: DataFrame, raw_col: str = "raw",
                 keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Chain documents (text) to ``(chain_id, chain)``, the tree as a variant."""
    return split_marked(mark_chains(docs, raw_col), keep)


def parse_listing(docs: DataFrame, raw_col: str = "raw", keep: Sequence[str] = ()) -> DataFrame:
    """Listing documents (``results[].url``) to one ``key`` per result, the
    second-to-last segment of its url."""
    schema = "results array<struct<url:string>>"
    urls = docs.select(*keep, F.explode(F.from_json(raw_col, schema)["results"]["url"]).alias("__url"))
    return urls.select(*keep, url_key("__url").alias("key"))


def parse_legacy_entities(docs: DataFrame, raw_col: str = "raw") -> tuple[DataFrame, DataFrame]:
    """Entities in the old landed form (pairs as JSON arrays) to the typed
    form (H8): values cast to bigint, flags to boolean.

    A value that does not cast becomes NULL (``try_cast``), never a silent 0
    and never a failed job.
    """
    return split_marked(_mark(docs, raw_col, LEGACY_ENTITIES))


def _legacy_columns(d: Column) -> list[Column]:
    return [
        d.getField("id").alias("id"),
        d.getField("name").alias("name"),
        F.transform(d.getField("stats"), lambda s: F.struct(
            F.try_element_at(s, F.lit(1)).alias("name"),
            F.try_element_at(s, F.lit(2)).try_cast("bigint").alias("value"))).alias("measures"),
        F.transform(d.getField("abilities"), lambda a: F.struct(
            F.try_element_at(a, F.lit(1)).alias("tag"),
            F.try_element_at(a, F.lit(2)).try_cast("boolean").alias("hidden"))).alias("tags"),
        d.getField("types").alias("kinds"),
    ]


LEGACY_ENTITIES = _json_kind(LEGACY_ENTITY_DOC, _legacy_columns)

#: The kinds of the job, by the type their documents are landed under.
KINDS = {"entity": ENTITIES, "cohort": COHORTS, "chain": CHAINS}
ROUTE, STATUS = "__route", "__status"


def marked_by_type(docs: DataFrame, kinds: Mapping[str, DocKind], type_col: str = "type", raw_col: str = "raw") -> DataFrame:
    """Every document parsed once, by the schema of its type, in one projection
    over one scan: a struct ``doc_<type>`` per type (null for the others), the
    ``reason`` of a reject, its route (a known type or ``unknown``) and its
    status (``good`` or ``reject``).  A good document's text is left out."""
    is_type = {name: F.col(type_col) == F.lit(name) for name in kinds}
    parsed = docs.select("*", *[F.when(is_type[n], k.parse(F.col(raw_col))).alias(f"__d_{n}") for n, k in kinds.items()])
    marks = {n: k.marks(F.col(f"__d_{n}")) for n, k in kinds.items()}
    reason, route = F.lit("unknown type"), F.lit("unknown")
    for n in kinds:
        reason = F.when(is_type[n], marks[n][1]).otherwise(reason)
        route = F.when(is_type[n], F.lit(f"type {n}")).otherwise(route)
    known = parsed.select(*docs.columns, *[F.when(is_type[n], marks[n][0]).alias(f"doc_{n}") for n in kinds],
                          reason.alias(REASON), route.alias(ROUTE))
    reject = F.col(REASON).isNotNull()
    return known.withColumn(raw_col, F.when(reject, F.col(raw_col))).withColumn(STATUS, F.when(reject, "reject").otherwise("good"))


def route_documents(docs: DataFrame, kinds: Mapping[str, DocKind], type_col: str = "type", raw_col: str = "raw",
                    keep: Sequence[str] = (), workdir: str | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """Route mixed documents by type to their parsers.

    Returns ``({type: keep and parsed columns}, rejected)``; rejected holds the
    columns of documents of an unknown type and of documents that do not fit
    their type, with the reason.  The documents are scanned and parsed once
    (:func:`marked_by_type`) and written once below ``workdir`` (default: a
    fresh folder under ``spark.checkpoint.dir``), partitioned by route and
    status; every result reads its own partitions.  Runs one job when called.
    """
    path = workdir or scratch_path(docs.sparkSession, "routed")
    marked_by_type(docs, kinds, type_col, raw_col).write.mode("overwrite").option("compression", COMPRESSION).partitionBy(ROUTE, STATUS).parquet(path)
    schema = marked_by_type(docs, kinds, type_col, raw_col).schema
    routed = docs.sparkSession.read.schema(schema).parquet(path)
    good, reject = F.col(STATUS) == "good", F.col(STATUS) == "reject"
    parsed = {n: routed.where((F.col(ROUTE) == f"type {n}") & good).select(*keep, f"doc_{n}.*") for n in kinds}
    return parsed, routed.where(reject).select(*docs.columns, REASON)
