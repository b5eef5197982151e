"""Registered queries: one per operator of the inventory, on the test tables.

Each entry is ``(spark, sf_dir) -> DataFrame``.  Queries run the library's
operators over the whole stand-in tables of :mod:`cohortkit.plans.fixtures`.
Doubles are rounded to 6 decimals at the very end (presentation only) so
the DuckDB oracle comparison does not depend on summation order.  The few
sink queries (JSON / landing / Parquet) write below
``spark.checkpoint.dir`` when called and return a DataFrame over the
written files.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.functions.columns import array_size, clean_name, pretty_label, url_key
from cohortkit.operators.base import (
    base_join,
    base_join_members,
    distinct_rows,
    drop_incomplete,
    explode_members,
    join_inner,
    join_left,
    project_alias,
    project_drop,
    reattach,
)
from cohortkit.operators.chains import all_members, first_branch, first_branch_edges, walk_edges
from cohortkit.operators.coverage import best_coverage, entity_sort_key, group_coverage, with_coverage, with_rank
from cohortkit.operators.hashed import bucket_table, fit_hashed, hashed_counts, hashed_weights, hashing
from cohortkit.operators.holders import expand_holders, holder_counts, holder_index, number_entities
from cohortkit.operators.measures import (
    entity_extremes,
    group_extremes,
    group_measure_avg,
    kind_measure_avg,
    measure_pivot,
    with_row_mean,
)
from cohortkit.operators.partials import BatchStates, state_averages, state_coverage, state_extremes
from cohortkit.operators.reduction import base_join_reduced
from cohortkit.operators.similarity import (
    cosine_to_centroid,
    inverse_document_frequency,
    row_count,
    similar_pairs,
    term_frequency,
    tfidf_weights,
)
from cohortkit.operators.tags import explode_tags, filter_flag, tag_list, tag_members, tag_split
from cohortkit.plans.contract import contract_report
from cohortkit.plans.fixtures import MEASURE_COLS, MEASURE_NAMES, Fixture
from cohortkit.plans.jobs import JobConfig, run_job
from cohortkit.schemas import ENTITY_DOC
from cohortkit.session import scratch_path
from cohortkit.sources.documents import (
    KINDS,
    entities_from_docs,
    mark_entities,
    parse_chains,
    parse_cohorts,
    parse_entities,
    parse_legacy_entities,
    parse_listing,
    route_documents,
    split_marked,
)
from cohortkit.sources.files import (
    land,
    latest_version,
    materialize,
    publish,
    publish_bucketed,
    read_bucketed,
    read_json_arrays,
    read_json_elements,
    read_landing,
    read_published,
    write_json_arrays,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

THRESHOLD = 0.75
KEYS = ("id", "cohort_id", "chain_id")


def query(name: str) -> Callable[[Query], Query]:
    def reg(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return reg


def r6(df: DataFrame) -> DataFrame:
    """Round every double column to 6 decimals (last step only)."""
    return df.select([F.round(F.col(f.name), 6).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                      else F.col(f.name) for f in df.schema.fields])


def _base(fx: Fixture) -> DataFrame:
    return base_join(fx.entity, fx.cohort, fx.chain, tasks=fx.tasks)


def _cohort_avg(fx: Fixture) -> DataFrame:
    wide = measure_pivot(_base(fx), MEASURE_NAMES, keep=("id", "cohort_id"))
    return group_measure_avg(wide, ["cohort_id"], MEASURE_COLS)


AVG_COLS = ["avg_all", *[f"avg_{c}" for c in MEASURE_COLS]]

# ---------------------------------------------------------------- A: sources


@query("parse_measures")
def q_parse_measures(spark, sf):
    good, _ = parse_entities(Fixture(spark, sf).entity_docs)
    return good.select("id", F.inline("measures"))


@query("parse_tags")
def q_parse_tags(spark, sf):
    good, _ = parse_entities(Fixture(spark, sf).entity_docs)
    return good.select("id", F.inline("tags"))


@query("parse_kinds")
def q_parse_kinds(spark, sf):
    good, _ = parse_entities(Fixture(spark, sf).entity_docs)
    return good.select("id", F.explode("kinds").alias("kind"))


@query("parse_cohort")
def q_parse_cohort(spark, sf):
    """Members and tags of every cohort document, one row per item."""
    good, _ = parse_cohorts(Fixture(spark, sf).cohort_docs)
    items = good.select("cohort_id", "name", F.lit("member").alias("kind"), F.explode("members").alias("item"))
    return items.unionByName(good.select("cohort_id", "name", F.lit("tag").alias("kind"), F.explode("tags").alias("item")).distinct())


@query("parse_listing")
def q_parse_listing(spark, sf):
    return parse_listing(Fixture(spark, sf).listing_docs, keep=("id",))


@query("chain_first_branch")
def q_chain_first_branch(spark, sf):
    good, _ = parse_chains(Fixture(spark, sf).customer_tree_docs)
    return first_branch(good)


@query("chain_all_members")
def q_chain_all_members(spark, sf):
    good, _ = parse_chains(Fixture(spark, sf).customer_tree_docs)
    return all_members(good)


@query("chain_edges_first_branch")
def q_chain_edges_first_branch(spark, sf):
    roots, edges = Fixture(spark, sf).region_tree_edges
    return first_branch_edges(roots, edges)


@query("chain_edges_all_members")
def q_chain_edges_all_members(spark, sf):
    roots, edges = Fixture(spark, sf).region_tree_edges
    return walk_edges(roots, edges)


@query("route_documents")
def q_route_documents(spark, sf):
    fx = Fixture(spark, sf)
    docs = (fx.entity_docs.unionByName(fx.cohort_docs).unionByName(fx.customer_tree_docs)
            .unionByName(fx.page_docs))
    routed, rejected = route_documents(docs, KINDS)
    items = (
        routed["entity"].select(F.lit("entity").alias("route"), F.col("id").alias("doc_id"),
                                F.coalesce(array_size("tags"), F.lit(0).cast("bigint")).alias("n_items"))
        .unionByName(routed["cohort"].select(F.lit("cohort").alias("route"), F.col("cohort_id").alias("doc_id"),
                                             array_size("members").alias("n_items")))
        .unionByName(first_branch(routed["chain"]).select(
            F.lit("chain").alias("route"), F.col("chain_id").alias("doc_id"),
            array_size("members").alias("n_items")))
        .unionByName(rejected.select(F.lit("rejected").alias("route"), F.col("id").alias("doc_id"),
                                     F.lit(0).cast("bigint").alias("n_items")))
    )
    return items.groupBy("route", "doc_id").agg(F.sum("n_items").alias("n_items"))


@query("reject_bad_documents")
def q_reject_bad_documents(spark, sf):
    fx = Fixture(spark, sf)
    docs = fx.entity_docs.select(F.lit("orders").alias("source"), "id", "raw").unionByName(
        fx.table("pages").select(F.lit("pages").alias("source"), F.col("page_id").alias("id"),
                                 F.col("html").alias("raw")))
    good, bad = parse_entities(docs, keep=("source",), workdir=scratch_path(spark, "marked"))
    return (good.select("source", "id", F.lit(True).alias("accepted"))
            .unionByName(bad.select("source", "id", F.lit(False).alias("accepted"))))


@query("url_key")
def q_url_key(spark, sf):
    pages = Fixture(spark, sf).table("pages")
    return pages.select("page_id", url_key("url").alias("url_key"))


def _file_objects(fx: Fixture) -> DataFrame:
    """Objects to land as arrays, a bounded number (some 3 MB) per file."""
    return fx.entity_objects.select(F.floor(F.col("id") / 5000).alias("file_key"), "obj")


@query("scan_json")
def q_scan_json(spark, sf):
    fx = Fixture(spark, sf)
    path = scratch_path(spark, "scan_json")
    write_json_arrays(_file_objects(fx), path, "file_key")
    good, _ = entities_from_docs(read_json_arrays(spark, path, ENTITY_DOC))
    return good.select("id", "name", array_size("tags").alias("n_tags"))


@query("scan_json_elements")
def q_scan_json_elements(spark, sf):
    """The same files, element by element; a reject loses nothing but itself."""
    fx = Fixture(spark, sf)
    path = scratch_path(spark, "scan_json")
    write_json_arrays(_file_objects(fx), path, "file_key")
    good, _ = parse_entities(read_json_elements(spark, path))
    return good.select("id", "name", array_size("tags").alias("n_tags"))


def _landed_twice(spark, sf, docs: DataFrame) -> str:
    """All documents landed once, those of finished orders once more."""
    path = scratch_path(spark, "landing")
    land(docs, path, ingest=1)
    finished = Fixture(spark, sf).table("orders").where(F.col("o_orderstatus") == F.lit("F")).select(F.col("o_orderkey").alias("id"))
    land(docs.join(finished, "id", "left_semi"), path, ingest=2)
    return path


@query("landing_dedup")
def q_landing_dedup(spark, sf):
    path = _landed_twice(spark, sf, Fixture(spark, sf).entity_docs)
    marked = materialize(mark_entities(read_landing(spark, path, "entity")), scratch_path(spark, "parsed"))
    good, _ = split_marked(marked, keep=("ingest",))
    return latest_version(good, ["id"], "ingest").select("id", "name", "ingest")


@query("landing_rejects")
def q_landing_rejects(spark, sf):
    """Landed documents cut short, without id, with an unfit value, and HTML."""
    path = scratch_path(spark, "landing")
    land(Fixture(spark, sf).bad_docs, path, ingest=1)
    marked = materialize(mark_entities(read_landing(spark, path, "entity")), scratch_path(spark, "parsed"))
    good, bad = split_marked(marked)
    return (good.groupBy(F.lit("good").alias("reason")).agg(F.count(F.lit(1)).alias("n_docs"), F.sum("id").alias("sum_id"))
            .unionByName(bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n_docs"), F.lit(None).cast("bigint").alias("sum_id"))))


@query("parquet_roundtrip")
def q_parquet_roundtrip(spark, sf):
    """Both published datasets, read back."""
    fx = Fixture(spark, sf)
    root = scratch_path(spark, "published")
    publish({"tag_split": tag_split(explode_tags(fx.order_customer_tags)),
             "cohort_coverage": group_coverage(_base(fx), "cohort_id")}, root)
    split = read_published(spark, root, "tag_split").select(
        F.lit("tag_split").alias("dataset"), "tag", "hidden", "name", F.lit(None).cast("double").alias("value"))
    coverage = read_published(spark, root, "cohort_coverage").select(
        F.lit("cohort_coverage").alias("dataset"), F.col("cohort_id").cast("string").alias("tag"),
        F.lit(None).cast("boolean").alias("hidden"), F.lit(None).cast("string").alias("name"), F.col("avg_coverage").alias("value"))
    return r6(split.unionByName(coverage))


@query("scan_parquet")
def q_scan_parquet(spark, sf):
    fx = Fixture(spark, sf)
    root = scratch_path(spark, "published")
    publish({"base": project_drop(_base(fx), ["measures", "tags", "kinds"])}, root)
    return read_published(spark, root, "base").select("id", "name", "cohort_id")


@query("typed_cast")
def q_typed_cast(spark, sf):
    """Values cast to numbers and flags cast to booleans."""
    good, _ = parse_legacy_entities(Fixture(spark, sf).legacy_entity_docs)
    values = good.select("id", F.inline("measures")).select("id", "name", "value", F.lit(None).cast("boolean").alias("flag"))
    flags = good.select("id", F.inline("tags")).select("id", F.col("tag").alias("name"), F.lit(None).cast("bigint").alias("value"),
                                                       F.col("hidden").alias("flag"))
    return values.unionByName(flags)


# ------------------------------------------------- B/C: projections and joins


@query("project_alias")
def q_project_alias(spark, sf):
    return project_alias(Fixture(spark, sf).entity, {"id": "entity_id", "name": "entity_name"})


@query("explode_members")
def q_explode_members(spark, sf):
    return explode_members(Fixture(spark, sf).cohort, "cohort_id")


@query("join_inner")
def q_join_inner(spark, sf):
    fx = Fixture(spark, sf)
    return join_inner(fx.entity, explode_members(fx.cohort, "cohort_id"), "cohort_id").select(
        "id", "name", "cohort_id")


def _joined(fx: Fixture) -> DataFrame:
    inner = join_inner(fx.entity, explode_members(fx.cohort, "cohort_id"), "cohort_id")
    return join_left(inner, explode_members(fx.chain, "chain_id"), "chain_id")


@query("join_left")
def q_join_left(spark, sf):
    return _joined(Fixture(spark, sf)).select("id", "name", "cohort_id", "chain_id")


@query("dropna_any")
def q_dropna_any(spark, sf):
    return drop_incomplete(_joined(Fixture(spark, sf))).select("id", "name", "cohort_id", "chain_id")


@query("base_join")
def q_base_join(spark, sf):
    return _base(Fixture(spark, sf)).select("id", "name", "cohort_id", "chain_id",
                                            array_size("tags").alias("n_tags"))


@query("base_join_bucketed")
def q_base_join_bucketed(spark, sf):
    """The base join of a later run, from tables published in buckets by name."""
    fx, root = Fixture(spark, sf), scratch_path(spark, "bucketed")
    publish_bucketed(fx.entity, root, "entity", "name", 16)
    publish_bucketed(explode_members(fx.cohort, "cohort_id"), root, "cohort_members", "member", 16)
    publish_bucketed(explode_members(fx.chain, "chain_id"), root, "chain_members", "member", 16)
    base = base_join_members(*[read_bucketed(spark, root, n) for n in ("entity", "cohort_members", "chain_members")])
    return base.select("id", "name", "cohort_id", "chain_id", array_size("tags").alias("n_tags"))


@query("base_join_reduced")
def q_base_join_reduced(spark, sf):
    """The base join of entities that a filter over the cohort members let pass."""
    fx = Fixture(spark, sf)
    members = materialize(explode_members(fx.cohort, "cohort_id"), scratch_path(spark, "cohort_members"))
    base = base_join_reduced(fx.entity, members, explode_members(fx.chain, "chain_id"))
    return base.select("id", "name", "cohort_id", "chain_id", array_size("tags").alias("n_tags"))


@query("project_drop")
def q_project_drop(spark, sf):
    return project_drop(_base(Fixture(spark, sf)), ["measures", "tags", "kinds"])


@query("distinct_rows")
def q_distinct_rows(spark, sf):
    base = _base(Fixture(spark, sf))
    return distinct_rows(base.select("cohort_id", F.sort_array("kinds").alias("kinds")))


@query("join_reattach")
def q_join_reattach(spark, sf):
    base = _base(Fixture(spark, sf))
    lists = tag_list(explode_tags(base))
    return reattach(base.select("id", "name", "cohort_id", "chain_id"), lists, "name")


@query("preview")
def q_preview(spark, sf):
    base = _base(Fixture(spark, sf)).select("id", "name", "cohort_id", "chain_id")
    return with_rank(base.orderBy("id", "cohort_id", "chain_id").limit(20))


# ------------------------------------------------------------ D/H: measures


@query("measure_pivot")
def q_measure_pivot(spark, sf):
    return measure_pivot(Fixture(spark, sf).entity, MEASURE_NAMES, keep=("id",))


@query("row_mean")
def q_row_mean(spark, sf):
    wide = measure_pivot(Fixture(spark, sf).entity, MEASURE_NAMES, keep=("id",))
    return r6(with_row_mean(wide, MEASURE_COLS).select("id", "row_mean"))


@query("cohort_measure_avg")
def q_cohort_measure_avg(spark, sf):
    return with_rank(r6(_cohort_avg(Fixture(spark, sf))).orderBy("cohort_id"))


@query("kind_measure_avg")
def q_kind_measure_avg(spark, sf):
    wide = measure_pivot(_base(Fixture(spark, sf)), MEASURE_NAMES, keep=("id", "kinds"), drop_source=True)
    return r6(kind_measure_avg(wide, MEASURE_COLS))


@query("kind_cohort_measure_avg")
def q_kind_cohort_measure_avg(spark, sf):
    wide = measure_pivot(_base(Fixture(spark, sf)), MEASURE_NAMES, keep=("id", "cohort_id", "kinds"))
    return r6(kind_measure_avg(wide, MEASURE_COLS, by=("cohort_id",)))


@query("measure_extremes")
def q_measure_extremes(spark, sf):
    return group_extremes(_cohort_avg(Fixture(spark, sf)), "cohort_id", AVG_COLS)


@query("entity_extremes")
def q_entity_extremes(spark, sf):
    wide = measure_pivot(_base(Fixture(spark, sf)), MEASURE_NAMES, keep=("id", "name"))
    return r6(entity_extremes(wide, MEASURE_COLS))


def _cohort_pick(spark: SparkSession, sf: str, fn: str) -> DataFrame:
    picked = spark.sql(f"SELECT cohort_id, avg_qty FROM {{averages}} "
                       f"WHERE avg_qty IN (SELECT {fn}(avg_qty) FROM {{averages}})", averages=_cohort_avg(Fixture(spark, sf)))
    return r6(picked)


@query("cohort_fastest")
def q_cohort_fastest(spark, sf):
    return _cohort_pick(spark, sf, "max")


@query("cohort_slowest")
def q_cohort_slowest(spark, sf):
    return _cohort_pick(spark, sf, "min")


@query("label_clean")
def q_label_clean(spark, sf):
    part = Fixture(spark, sf).table("part").select("p_partkey", F.concat_ws("-", "p_brand", "p_type").alias("name"))
    col_name = clean_name("name")
    return part.select("p_partkey", "name", col_name.alias("col_name"),
                       pretty_label(F.concat(F.lit("avg("), col_name, F.lit(")"))).alias("label"))


# ------------------------------------------------- partial states per batch


def _batch_states(spark: SparkSession, sf: str) -> BatchStates:
    """Three batches, one after the other: open and finished orders, the
    finished ones in an older version; those again, as they are; the rest."""
    orders = Fixture(spark, sf).table("orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))
    wide = measure_pivot(with_coverage(_base(Fixture(spark, sf))), MEASURE_NAMES, keep=("id", "name", "cohort_id", "coverage"))
    wide = materialize(wide.join(orders, "id"), scratch_path(spark, "batches"))
    old = wide.withColumn("qty", F.when(F.col("status") == "F", F.col("qty") * 100).otherwise(F.col("qty")))
    states = BatchStates(spark, scratch_path(spark, "states"), ["cohort_id"], MEASURE_COLS)
    states.add(1, old.where(F.col("status").isin("O", "F")))
    states.add(2, wide.where(F.col("status") == "F"))
    states.add(3, wide.where(~F.coalesce(F.col("status").isin("O", "F"), F.lit(False))))
    return states


@query("incremental_measure_avg")
def q_incremental_measure_avg(spark, sf):
    return r6(state_averages(_batch_states(spark, sf).states(), ["cohort_id"], MEASURE_COLS))


@query("incremental_coverage")
def q_incremental_coverage(spark, sf):
    return r6(state_coverage(_batch_states(spark, sf).states(), ["cohort_id"]))


@query("incremental_extremes")
def q_incremental_extremes(spark, sf):
    return r6(state_extremes(_batch_states(spark, sf).states(), MEASURE_COLS))


# ------------------------------------------------------------ coverage, sort


@query("cohort_coverage")
def q_cohort_coverage(spark, sf):
    return with_rank(r6(group_coverage(_base(Fixture(spark, sf)), "cohort_id")).orderBy("cohort_id"))


@query("coverage")
def q_coverage(spark, sf):
    cov = with_coverage(Fixture(spark, sf).entity)
    return r6(cov.select("id", "n_kinds", "n_tags", "coverage"))


@query("best_coverage")
def q_best_coverage(spark, sf):
    return r6(best_coverage(_base(Fixture(spark, sf)), "cohort_id"))


@query("entity_sort_key")
def q_entity_sort_key(spark, sf):
    return r6(with_rank(entity_sort_key(Fixture(spark, sf).entity).select("id", "name", "sort_key")))


@query("entity_sort_key_derived")
def q_entity_sort_key_derived(spark, sf):
    return r6(with_rank(entity_sort_key(Fixture(spark, sf).entity, by_key=False).select("id", "name", "sort_key")))


# ----------------------------------------------------------------- tags


@query("filter_flag")
def q_filter_flag(spark, sf):
    return filter_flag(explode_tags(_base(Fixture(spark, sf)))).select("name", "tag")


@query("tag_members")
def q_tag_members(spark, sf):
    return tag_members(explode_tags(_base(Fixture(spark, sf))))


@query("tag_list")
def q_tag_list(spark, sf):
    return tag_list(explode_tags(_base(Fixture(spark, sf))))


@query("tag_split")
def q_tag_split(spark, sf):
    return tag_split(explode_tags(Fixture(spark, sf).order_customer_tags))


@query("tag_split_parts")
def q_tag_split_parts(spark, sf):
    return tag_split(explode_tags(Fixture(spark, sf).entity))


@query("tag_split_full")
def q_tag_split_full(spark, sf):
    return tag_split(explode_tags(Fixture(spark, sf).order_customer_tags), full=True)


def _holder_index(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Orders tagged with their customer (few holders) and with the years their
    lines were shipped in (many); the written index and the numbers."""
    fx = Fixture(spark, sf)
    years = fx.table("lineitem").select(F.concat(F.lit("E"), F.col("l_orderkey").cast("string")).alias("name"),
                                        F.concat(F.lit("Y"), F.year("l_shipdate").cast("string")).alias("tag"),
                                        (F.col("l_returnflag") == "R").alias("hidden"))
    long = explode_tags(fx.order_customer_tags).unionByName(years)
    numbers = materialize(number_entities(long), scratch_path(spark, "numbers"))
    return materialize(holder_index(long, numbers), scratch_path(spark, "holders")), numbers


@query("tag_holder_counts")
def q_tag_holder_counts(spark, sf):
    return holder_counts(_holder_index(spark, sf)[0])


@query("tag_holders_expanded")
def q_tag_holders_expanded(spark, sf):
    return expand_holders(*_holder_index(spark, sf))


@query("tag_holders_both_ways")
def q_tag_holders_both_ways(spark, sf):
    return expand_holders(*_holder_index(spark, sf), both_ways=True)


# ----------------------------------------------------------- similarity


@query("tag_tf")
def q_tag_tf(spark, sf):
    return term_frequency(_base(Fixture(spark, sf)), KEYS)


@query("tag_idf")
def q_tag_idf(spark, sf):
    base = _base(Fixture(spark, sf))
    return r6(inverse_document_frequency(term_frequency(base, KEYS), row_count(base)))


@query("tag_tfidf")
def q_tag_tfidf(spark, sf):
    w = tfidf_weights(_base(Fixture(spark, sf)), KEYS)
    return r6(w.select(*KEYS, "tag", "weight"))


def _written_base(spark: SparkSession, sf: str) -> DataFrame:
    """The base table written to the shared folder, as the job does."""
    return materialize(_base(Fixture(spark, sf)), scratch_path(spark, "base"))


@query("tag_hashed_tfidf")
def q_tag_hashed_tfidf(spark, sf):
    """TF-IDF by bucket from the saved and loaded MLlib stages."""
    base = _written_base(spark, sf)
    counted = hashed_counts(base, KEYS, hashing())  # written once for fit and weights
    model = fit_hashed(base, scratch_path(spark, "hashed_model"), counted=counted)
    return r6(hashed_weights(base, KEYS, model, counted))


@query("tag_hash_buckets")
def q_tag_hash_buckets(spark, sf):
    """The bucket of every tag and how many tags share it."""
    return bucket_table(_base(Fixture(spark, sf)))


@query("similar_pairs")
def q_similar_pairs(spark, sf):
    return r6(similar_pairs(_written_base(spark, sf), THRESHOLD))


@query("pairs_differ")
def q_pairs_differ(spark, sf):
    return r6(similar_pairs(_written_base(spark, sf), THRESHOLD, differ_on=("cohort_id",)))


@query("dense_cosine")
def q_dense_cosine(spark, sf):
    emb = Fixture(spark, sf).table("embeddings")
    return r6(cosine_to_centroid(emb, "vec_id", "label", "embedding"))


@query("udf_cosine")
def q_udf_cosine(spark, sf):
    emb = Fixture(spark, sf).table("embeddings")
    return r6(cosine_to_centroid(emb, "vec_id", "label", "embedding", use_udf=True))


# ----------------------------------------------------------- K: pipeline

ORDERS_CONTRACT = T.StructType([
    T.StructField("o_orderkey", T.LongType(), nullable=False),
    T.StructField("o_custkey", T.LongType(), nullable=False),
    T.StructField("o_orderstatus", T.StringType()),
    T.StructField("o_totalprice", T.DoubleType(), nullable=False),
    T.StructField("o_orderdate", T.DateType()),
    T.StructField("o_orderpriority", T.LongType()),
    T.StructField("o_comment", T.StringType()),
])


@query("contract_violations")
def q_contract_violations(spark, sf):
    return contract_report(Fixture(spark, sf).table("orders"), ORDERS_CONTRACT)


def _job(spark: SparkSession, sf: str, chain_mode: str) -> tuple[DataFrame, str]:
    """The whole job on documents landed twice, with bad ones among them."""
    fx = Fixture(spark, sf)
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "out")
    chains = materialize(fx.chain_star_docs, scratch_path(spark, "chain_docs"))  # landed twice, made once
    docs = fx.entity_docs.unionByName(fx.cohort_docs).unionByName(chains).unionByName(fx.page_docs)
    land(docs, landing, ingest=1)
    # newer versions: all chains again, and web pages as entities
    land(chains.unionByName(fx.table("pages").select(
        F.lit("entity").alias("type"), F.col("page_id").alias("id"), F.col("html").alias("raw"))), landing, ingest=2)
    cfg = JobConfig.from_mapping({"landing_path": landing, "output_path": out, "measure_names": MEASURE_NAMES,
                                  "threshold": THRESHOLD, "chain_mode": chain_mode})
    return run_job(spark, cfg), out


def _job_results(spark: SparkSession, sf: str, chain_mode: str) -> DataFrame:
    """Every row of the job's published results as ``(dataset, key, value)``."""
    _, out = _job(spark, sf, chain_mode)
    read = lambda name: read_published(spark, out, name)
    text = lambda *cols: F.concat_ws(":", *[F.col(c).cast("string") for c in cols])
    one = F.lit(1.0)
    rows = [
        read("cohort_measure_avg").unpivot(["cohort_id"], AVG_COLS, "measure", "value").select(
            F.lit("cohort_measure_avg").alias("dataset"), text("cohort_id", "measure").alias("key"), "value"),
        read("cohort_coverage").select(F.lit("cohort_coverage").alias("dataset"), text("cohort_id").alias("key"),
                                       F.col("avg_coverage").alias("value")),
        read("tag_split").select(F.lit("tag_split").alias("dataset"), text("tag", "hidden", "name").alias("key"), one.alias("value")),
        read("similar_pairs").select(F.lit("similar_pairs").alias("dataset"), text("name_i", "name_j").alias("key"),
                                     F.col("score").alias("value")),
        read("cohort").select(F.lit("cohort").alias("dataset"), "cohort_id", "name", F.explode("tags").alias("tag")).select(
            "dataset", text("cohort_id", "name", "tag").alias("key"), one.alias("value")),
        read("rejects").groupBy("type", "reason", "ingest").agg(F.count(F.lit(1)).cast("double").alias("value")).select(
            F.lit("rejects").alias("dataset"), text("type", "reason", "ingest").alias("key"), "value"),
    ]
    return r6(reduce(DataFrame.unionByName, rows))


@query("etl_run")
def q_etl_run(spark, sf):
    return _job(spark, sf, "all")[0]


@query("etl_results")
def q_etl_results(spark, sf):
    return _job_results(spark, sf, "all")


@query("etl_results_first_branch")
def q_etl_results_first_branch(spark, sf):
    return _job_results(spark, sf, "first_branch")
