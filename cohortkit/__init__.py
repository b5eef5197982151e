"""cohortkit: DataFrame operators for nested entity data on Spark.

Entities carry measures, flagged tags and kinds; cohorts and chains are
groups of entity names.  The operators join entities to their groups and
compute per-cohort averages and coverage, flagged / unflagged tag holders,
extremes, and TF-IDF cosine similarity between entities of different
groups with a prefix-filtered sparse self-join.

Every operator is a function ``(DataFrame, ..., column names) -> DataFrame``
that only builds a logical plan; the sinks in :mod:`cohortkit.sources.files`,
``similar_pairs`` (which writes its vector table once) and the job runner in
:mod:`cohortkit.plans.jobs` run Spark jobs.
"""

from cohortkit.operators.base import base_join, base_join_members, collect_chunked, explode_members
from cohortkit.operators.chains import (
    all_members,
    first_branch,
    first_branch_edges,
    walk_edges,
)
from cohortkit.operators.coverage import best_coverage, group_coverage, with_coverage
from cohortkit.operators.measures import (
    entity_extremes,
    group_extremes,
    group_measure_avg,
    kind_measure_avg,
    measure_pivot,
)
from cohortkit.operators.similarity import (
    cosine_to_centroid,
    inverse_document_frequency,
    similar_pairs,
    term_frequency,
    tfidf_weights,
)
from cohortkit.operators.tags import explode_tags, filter_flag, tag_list, tag_members, tag_split
from cohortkit.plans.contract import assert_contract, assert_schema, contract_report
from cohortkit.plans.jobs import JobConfig, run_job
from cohortkit.sources.documents import (
    entities_from_docs,
    parse_chains,
    parse_cohorts,
    parse_entities,
    parse_listing,
    route_documents,
)
from cohortkit.sources.files import (
    land,
    latest_version,
    materialize,
    publish,
    read_landing,
    read_published,
)

__all__ = [
    "JobConfig", "all_members", "assert_contract", "assert_schema", "base_join", "base_join_members",
    "best_coverage", "collect_chunked", "contract_report",
    "cosine_to_centroid", "entities_from_docs", "entity_extremes", "explode_members", "explode_tags",
    "filter_flag", "first_branch", "first_branch_edges", "group_coverage", "group_extremes",
    "group_measure_avg", "inverse_document_frequency", "kind_measure_avg", "land", "latest_version",
    "materialize", "measure_pivot", "parse_chains", "parse_cohorts", "parse_entities", "parse_listing",
    "publish", "read_landing", "read_published", "route_documents", "run_job",
    "similar_pairs", "tag_list", "tag_members", "tag_split", "term_frequency", "tfidf_weights",
    "walk_edges", "with_coverage",
]
