"""DuckDB oracle SQL, one statement per registered query.

Every statement starts with the flat views of FIXTURES.md §3 as CTEs over
the pre-registered tables, then computes the query's answer directly (brute
force where the Spark side uses an algorithm, e.g. the full sparse
self-join for similar pairs).  Column names and types match the Spark
output; doubles are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

_VIEWS = """
ent_flat AS (
  SELECT o_orderkey AS id, concat('E', cast(o_orderkey AS string)) AS name FROM orders),
m AS (
  SELECT o_orderkey AS id,
         cast(round(sum(l_quantity)) AS bigint) AS qty,
         cast(round(sum(l_extendedprice) * 100) AS bigint) AS price,
         cast(round(sum(l_discount) * 100) AS bigint) AS disc,
         cast(round(sum(l_tax) * 100) AS bigint) AS tax,
         cast(count(*) AS bigint) AS n_lines,
         cast(round(max(o_totalprice) * 100) AS bigint) AS total
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey),
measures_flat AS (
  SELECT id, 'qty' AS name, qty AS value FROM m
  UNION ALL SELECT id, 'price-cents', price FROM m
  UNION ALL SELECT id, 'disc-pct', disc FROM m
  UNION ALL SELECT id, 'tax-pct', tax FROM m
  UNION ALL SELECT id, 'line-count', n_lines FROM m
  UNION ALL SELECT id, 'total-cents', total FROM m),
tags_flat AS (
  SELECT l_orderkey AS id, cast(l_partkey AS string) AS tag, l_returnflag = 'R' AS hidden FROM lineitem),
kinds_flat AS (
  SELECT DISTINCT l_orderkey AS id, p_type AS kind FROM lineitem JOIN part ON l_partkey = p_partkey),
cohort_flat AS (
  SELECT DISTINCT cast(year(l_shipdate) AS bigint) AS cohort_id, concat('E', cast(l_orderkey AS string)) AS member
  FROM lineitem),
cohort_tag_flat AS (SELECT DISTINCT cast(year(l_shipdate) AS bigint) AS cohort_id, l_returnflag AS tag FROM lineitem),
chain_flat AS (
  SELECT cast(c_nationkey AS bigint) AS chain_id, concat('E', cast(o_orderkey AS string)) AS member
  FROM orders JOIN customer ON o_custkey = c_custkey),
base_flat AS (
  SELECT e.id, e.name, g.cohort_id, c.chain_id
  FROM ent_flat e JOIN cohort_flat g ON e.name = g.member
  LEFT JOIN chain_flat c ON e.name = c.member
  WHERE c.chain_id IS NOT NULL AND EXISTS (SELECT 1 FROM tags_flat t WHERE t.id = e.id)),
wide AS (
  SELECT id, qty, price AS price_cents, disc AS disc_pct, tax AS tax_pct,
         n_lines AS line_count, total AS total_cents,
         qty + price + disc + tax + n_lines + total AS row_sum
  FROM m),
tag_n AS (SELECT id, count(*) AS n_tags FROM tags_flat GROUP BY id),
kind_n AS (SELECT id, count(*) AS n_kinds FROM kinds_flat GROUP BY id),
base_w AS (SELECT b.*, w.* EXCLUDE (id) FROM base_flat b JOIN wide w USING (id)),
cust_tags AS (
  SELECT concat('E', cast(o_orderkey AS string)) AS name, cast(o_custkey AS string) AS tag,
         o_orderstatus = 'F' AS hidden FROM orders),
tf AS (
  SELECT b.id, b.cohort_id, b.chain_id, b.name, n.tag, n.tf FROM base_flat b JOIN (
    SELECT b.name, t.tag, count(*) AS tf FROM base_flat b JOIN tags_flat t ON t.id = b.id GROUP BY ALL) n USING (name)),
n_base AS (SELECT count(*) AS m FROM base_flat),
dfq AS (SELECT tag, count(*) AS df FROM tf GROUP BY tag),
tfidf AS (
  SELECT tf.*, dfq.df, ln((n_base.m + 1.0) / (dfq.df + 1.0)) AS idf,
         tf.tf * ln((n_base.m + 1.0) / (dfq.df + 1.0)) AS weight
  FROM tf JOIN dfq USING (tag) CROSS JOIN n_base),
unit AS (
  SELECT t.id, t.cohort_id, t.chain_id, t.name, t.tag,
         t.weight / sqrt(sum(t.weight * t.weight) OVER (PARTITION BY t.id, t.cohort_id, t.chain_id)) AS u
  FROM tfidf t WHERE t.weight > 0),
cos_all AS (
  SELECT a.name AS name_i, b.name AS name_j, a.cohort_id AS ci, b.cohort_id AS cj,
         a.chain_id AS hi, b.chain_id AS hj, sum(a.u * b.u) AS score
  FROM unit a JOIN unit b ON a.tag = b.tag
  WHERE (a.id, a.cohort_id, a.chain_id) <> (b.id, b.cohort_id, b.chain_id)
  GROUP BY a.id, a.cohort_id, a.chain_id, a.name, b.id, b.cohort_id, b.chain_id, b.name),
sim_pairs AS (
  SELECT name_i, name_j, score FROM cos_all WHERE ci <> cj AND hi <> hj AND score > 0.75),
cohort_avg AS (
  SELECT cohort_id, avg(row_sum) / 6 AS avg_all, avg(qty) AS avg_qty, avg(price_cents) AS avg_price_cents,
         avg(disc_pct) AS avg_disc_pct, avg(tax_pct) AS avg_tax_pct, avg(line_count) AS avg_line_count,
         avg(total_cents) AS avg_total_cents
  FROM base_w GROUP BY cohort_id),
cust_path AS (
  SELECT c_custkey AS chain_id, r_name, n_name, c_name, c_mktsegment
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
first_nation AS (SELECT n_regionkey, min(n_nationkey) AS nk FROM nation GROUP BY n_regionkey),
first_cust AS (SELECT c_nationkey, min(c_custkey) AS ck FROM customer GROUP BY c_nationkey),
tag_rows AS (SELECT DISTINCT t.tag, t.hidden, b.name FROM base_flat b JOIN tags_flat t ON t.id = b.id),
both_ways AS (SELECT tag FROM tag_rows GROUP BY tag HAVING bool_or(hidden) AND NOT bool_and(hidden)),
cust_both AS (SELECT tag FROM cust_tags GROUP BY tag HAVING bool_or(hidden) AND NOT bool_and(hidden)),
coverage_avg AS (
  SELECT b.cohort_id, avg(cast(k.n_kinds AS double) / t.n_tags) AS avg_coverage
  FROM base_flat b JOIN tag_n t USING (id) JOIN kind_n k USING (id) GROUP BY b.cohort_id)
"""

PRELUDE = "WITH " + _VIEWS.strip() + "\n"


def _avg_cols(prefix: str = "") -> str:
    cols = ["avg_all", "avg_qty", "avg_price_cents", "avg_disc_pct", "avg_tax_pct",
            "avg_line_count", "avg_total_cents"]
    return ", ".join(f"round({prefix}{c}, 6) AS {c}" for c in cols)


_AVG_AGGS = """avg(row_sum) / 6 AS avg_all, avg(qty) AS avg_qty, avg(price_cents) AS avg_price_cents,
  avg(disc_pct) AS avg_disc_pct, avg(tax_pct) AS avg_tax_pct, avg(line_count) AS avg_line_count,
  avg(total_cents) AS avg_total_cents"""

_MEASURE_UNPIVOT = " UNION ALL ".join(
    f"SELECT {key}, '{label}' AS measure, cast({expr} AS double) AS value FROM {src}"
    for label, expr in [("all", "row_sum / 6"), ("qty", "qty"), ("price_cents", "price_cents"),
                        ("disc_pct", "disc_pct"), ("tax_pct", "tax_pct"), ("line_count", "line_count"),
                        ("total_cents", "total_cents")]
    for key, src in [("{key}", "{src}")]
)

_COHORT_UNPIVOT = " UNION ALL ".join(
    f"SELECT cohort_id, '{c}' AS measure, {c} AS value FROM cohort_avg"
    for c in ["avg_all", "avg_qty", "avg_price_cents", "avg_disc_pct", "avg_tax_pct",
              "avg_line_count", "avg_total_cents"])


def _q(body: str) -> str:
    return PRELUDE + body.strip()


ORACLE: dict[str, str] = {
    # A: sources
    "parse_measures": _q("SELECT id, name, value FROM measures_flat"),
    "parse_tags": _q("SELECT id, tag, hidden FROM tags_flat"),
    "parse_kinds": _q("SELECT id, kind FROM kinds_flat"),
    "parse_cohort": _q("""
        SELECT cohort_id, concat('Y', cast(cohort_id AS string)) AS name, 'member' AS kind, member AS item FROM cohort_flat
        UNION ALL SELECT cohort_id, concat('Y', cast(cohort_id AS string)), 'tag', tag FROM cohort_tag_flat"""),
    "parse_listing": _q("SELECT page_id AS id, string_split(url, '/')[-2] AS key FROM pages"),
    "chain_first_branch": _q("SELECT chain_id, [r_name, n_name, c_name] AS members FROM cust_path"),
    "chain_all_members": _q("""
        SELECT chain_id, r_name AS member, cast(0 AS bigint) AS depth FROM cust_path
        UNION ALL SELECT chain_id, n_name, cast(1 AS bigint) FROM cust_path
        UNION ALL SELECT chain_id, c_name, cast(2 AS bigint) FROM cust_path
        UNION ALL SELECT chain_id, c_mktsegment, cast(2 AS bigint) FROM cust_path"""),
    "chain_edges_first_branch": _q("""
        SELECT cast(r.r_regionkey AS bigint) AS chain_id,
               list_filter([r.r_name, n.n_name, c.c_name], lambda x: x IS NOT NULL) AS members
        FROM region r
        LEFT JOIN first_nation fn ON fn.n_regionkey = r.r_regionkey
        LEFT JOIN nation n ON n.n_nationkey = fn.nk
        LEFT JOIN first_cust fc ON fc.c_nationkey = n.n_nationkey
        LEFT JOIN customer c ON c.c_custkey = fc.ck"""),
    "chain_edges_all_members": _q("""
        SELECT cast(r_regionkey AS bigint) AS chain_id, r_name AS member, cast(0 AS bigint) AS depth FROM region
        UNION ALL SELECT cast(n.n_regionkey AS bigint), n.n_name, cast(1 AS bigint)
          FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey
        UNION ALL SELECT cast(n.n_regionkey AS bigint), c.c_name, cast(2 AS bigint)
          FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
          JOIN region r ON r.r_regionkey = n.n_regionkey"""),
    "route_documents": _q("""
        SELECT 'entity' AS route, e.id AS doc_id, cast(coalesce(t.n_tags, 0) AS bigint) AS n_items
          FROM ent_flat e LEFT JOIN tag_n t USING (id)
        UNION ALL SELECT 'cohort', cohort_id, cast(count(*) AS bigint) FROM cohort_flat GROUP BY cohort_id
        UNION ALL SELECT 'chain', chain_id, cast(3 AS bigint) FROM cust_path
        UNION ALL SELECT 'rejected', page_id, cast(0 AS bigint) FROM pages"""),
    "reject_bad_documents": _q("""
        SELECT 'orders' AS source, id, true AS accepted FROM ent_flat
        UNION ALL SELECT 'pages', page_id, false FROM pages"""),
    "url_key": _q("SELECT page_id, string_split(url, '/')[-2] AS url_key FROM pages"),
    "scan_json": _q("""
        SELECT e.id, e.name, cast(t.n_tags AS bigint) AS n_tags FROM ent_flat e LEFT JOIN tag_n t USING (id)"""),
    "landing_dedup": _q("""
        SELECT o_orderkey AS id, concat('E', cast(o_orderkey AS string)) AS name,
               cast(CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END AS bigint) AS ingest FROM orders"""),
    "landing_rejects": _q("""
        SELECT 'good' AS reason, count(*) AS n_docs, cast(sum(o_orderkey) AS bigint) AS sum_id FROM orders WHERE o_orderkey % 4 = 3
        UNION ALL SELECT 'no id', count(*), NULL FROM orders WHERE o_orderkey % 4 = 1
        UNION ALL SELECT 'does not parse', count(*), NULL FROM (
          SELECT o_orderkey FROM orders WHERE o_orderkey % 4 IN (0, 2) UNION ALL SELECT page_id FROM pages)"""),
    "parquet_roundtrip": _q("""
        SELECT DISTINCT 'tag_split' AS dataset, tag, hidden, name, cast(NULL AS double) AS value
        FROM cust_tags JOIN cust_both USING (tag)
        UNION ALL SELECT 'cohort_coverage', cast(cohort_id AS string), NULL, NULL, round(avg_coverage, 6) FROM coverage_avg"""),
    "scan_parquet": _q("SELECT id, name, cohort_id FROM base_flat"),
    "typed_cast": _q("""
        SELECT id, name, value, cast(NULL AS boolean) AS flag FROM measures_flat
        UNION ALL SELECT id, tag, NULL, hidden FROM tags_flat"""),
    # B/C
    "project_alias": _q("SELECT id AS entity_id, name AS entity_name FROM ent_flat"),
    "explode_members": _q("SELECT cohort_id, member FROM cohort_flat"),
    "join_inner": _q("SELECT e.id, e.name, g.cohort_id FROM ent_flat e JOIN cohort_flat g ON e.name = g.member"),
    "join_left": _q("""
        SELECT e.id, e.name, g.cohort_id, c.chain_id FROM ent_flat e
        JOIN cohort_flat g ON e.name = g.member LEFT JOIN chain_flat c ON e.name = c.member"""),
    "dropna_any": _q("SELECT id, name, cohort_id, chain_id FROM base_flat"),
    "base_join": _q("""
        SELECT b.id, b.name, b.cohort_id, b.chain_id, cast(t.n_tags AS bigint) AS n_tags
        FROM base_flat b JOIN tag_n t USING (id)"""),
    "project_drop": _q("SELECT id, name, cohort_id, chain_id FROM base_flat"),
    "distinct_rows": _q("""
        SELECT DISTINCT b.cohort_id, k.kinds FROM base_flat b
        JOIN (SELECT id, list_sort(list(kind)) AS kinds FROM kinds_flat GROUP BY id) k USING (id)"""),
    "join_reattach": _q("""
        SELECT b.id, b.name, b.cohort_id, b.chain_id, l.tags FROM base_flat b
        JOIN (SELECT b2.name, list_sort(list(t.tag)) AS tags FROM base_flat b2
              JOIN tags_flat t ON t.id = b2.id GROUP BY b2.name) l USING (name)"""),
    "preview": _q("""
        SELECT id, name, cohort_id, chain_id, row_number() OVER (ORDER BY id, cohort_id, chain_id) AS rank
        FROM base_flat ORDER BY rank LIMIT 20"""),
    # D/H: measures
    "measure_pivot": _q("""
        SELECT e.id, w.qty, w.price_cents, w.disc_pct, w.tax_pct, w.line_count, w.total_cents
        FROM ent_flat e LEFT JOIN wide w USING (id)"""),
    "row_mean": _q("SELECT e.id, round(w.row_sum / 6, 6) AS row_mean FROM ent_flat e LEFT JOIN wide w USING (id)"),
    "cohort_measure_avg": _q(f"""
        SELECT cohort_id, {_avg_cols()}, row_number() OVER (ORDER BY cohort_id) AS rank FROM cohort_avg"""),
    "kind_measure_avg": _q(f"""
        SELECT kind, {_avg_cols()} FROM (
          SELECT k.kind, {_AVG_AGGS} FROM base_w b JOIN kinds_flat k USING (id) GROUP BY k.kind)"""),
    "kind_cohort_measure_avg": _q(f"""
        SELECT kind, cohort_id, {_avg_cols()} FROM (
          SELECT k.kind, b.cohort_id, {_AVG_AGGS} FROM base_w b JOIN kinds_flat k USING (id)
          GROUP BY k.kind, b.cohort_id)"""),
    "measure_extremes": _q(f"""
        , long AS ({_COHORT_UNPIVOT}),
        hi AS (SELECT measure, cohort_id, value,
                      row_number() OVER (PARTITION BY measure ORDER BY value DESC, cohort_id) AS r FROM long),
        lo AS (SELECT measure, cohort_id, value,
                      row_number() OVER (PARTITION BY measure ORDER BY value ASC, cohort_id) AS r FROM long)
        SELECT hi.measure, hi.cohort_id AS max_cohort_id, cast(trunc(hi.value) AS bigint) AS max_value,
               lo.cohort_id AS min_cohort_id, cast(trunc(lo.value) AS bigint) AS min_value
        FROM hi JOIN lo ON hi.measure = lo.measure AND hi.r = 1 AND lo.r = 1"""),
    "entity_extremes": _q(f"""
        , long AS ({_MEASURE_UNPIVOT.format(key="id, name", src="base_w")}),
        hi AS (SELECT measure, id, name, value,
                      row_number() OVER (PARTITION BY measure ORDER BY value DESC, id) AS r FROM long),
        lo AS (SELECT measure, id, name, value,
                      row_number() OVER (PARTITION BY measure ORDER BY value ASC, id) AS r FROM long)
        SELECT hi.measure, hi.id AS max_id, hi.name AS max_name, round(hi.value, 6) AS max_value,
               lo.id AS min_id, lo.name AS min_name, round(lo.value, 6) AS min_value
        FROM hi JOIN lo ON hi.measure = lo.measure AND hi.r = 1 AND lo.r = 1"""),
    "cohort_fastest": _q("""
        SELECT cohort_id, round(avg_qty, 6) AS avg_qty FROM cohort_avg
        WHERE avg_qty IN (SELECT max(avg_qty) FROM cohort_avg)"""),
    "cohort_slowest": _q("""
        SELECT cohort_id, round(avg_qty, 6) AS avg_qty FROM cohort_avg
        WHERE avg_qty IN (SELECT min(avg_qty) FROM cohort_avg)"""),
    "label_clean": _q("""
        SELECT p_partkey, name, replace(name, '-', '_') AS col_name,
               upper(substr(s, 1, 1)) || lower(substr(s, 2)) AS label
        FROM (SELECT p_partkey, name, replace(replace(replace(replace('avg(' || replace(name, '-', '_') || ')',
                     'avg', ''), '_', ' '), '(', ''), ')', '') AS s
              FROM (SELECT p_partkey, p_brand || '-' || p_type AS name FROM part))"""),
    # coverage, sort
    "cohort_coverage": _q("""
        SELECT cohort_id, round(avg_coverage, 6) AS avg_coverage, row_number() OVER (ORDER BY cohort_id) AS rank
        FROM coverage_avg"""),
    "coverage": _q("""
        SELECT e.id, cast(k.n_kinds AS bigint) AS n_kinds, cast(t.n_tags AS bigint) AS n_tags,
               round(cast(k.n_kinds AS double) / t.n_tags, 6) AS coverage
        FROM ent_flat e LEFT JOIN tag_n t USING (id) LEFT JOIN kind_n k USING (id)"""),
    "best_coverage": _q("""
        SELECT cohort_id, id, name, round(coverage, 6) AS coverage FROM (
          SELECT b.cohort_id, b.id, b.name, cast(k.n_kinds AS double) / t.n_tags AS coverage,
                 row_number() OVER (PARTITION BY b.cohort_id
                                    ORDER BY cast(k.n_kinds AS double) / t.n_tags DESC, b.id) AS r
          FROM base_flat b JOIN tag_n t USING (id) JOIN kind_n k USING (id)) WHERE r = 1"""),
    "entity_sort_key": _q("""
        SELECT e.id, e.name, round(CASE WHEN w.id IS NULL THEN NULL ELSE 6.0 / t.n_tags END, 6) AS sort_key,
               row_number() OVER (ORDER BY e.id, e.name) AS rank
        FROM ent_flat e LEFT JOIN tag_n t USING (id) LEFT JOIN wide w USING (id)"""),
    "entity_sort_key_derived": _q("""
        SELECT id, name, round(k, 6) AS sort_key, row_number() OVER (ORDER BY k NULLS LAST, id) AS rank FROM (
          SELECT e.id, e.name, CASE WHEN w.id IS NULL THEN NULL ELSE cast(6 AS double) / t.n_tags END AS k
          FROM ent_flat e LEFT JOIN tag_n t USING (id) LEFT JOIN wide w USING (id))"""),
    # tags
    "filter_flag": _q("SELECT b.name, t.tag FROM base_flat b JOIN tags_flat t ON t.id = b.id WHERE t.hidden"),
    "tag_members": _q("SELECT DISTINCT tag, name FROM tag_rows"),
    "tag_list": _q("""
        SELECT b.name, list_sort(list(t.tag)) AS tags FROM base_flat b JOIN tags_flat t ON t.id = b.id
        GROUP BY b.name"""),
    "tag_split": _q("SELECT DISTINCT tag, hidden, name FROM cust_tags JOIN cust_both USING (tag)"),
    "tag_split_parts": _q("""
        SELECT DISTINCT tag, hidden, concat('E', cast(id AS string)) AS name FROM tags_flat
        WHERE tag IN (SELECT tag FROM tags_flat GROUP BY tag HAVING bool_or(hidden) AND NOT bool_and(hidden))"""),
    "tag_split_full": _q("SELECT DISTINCT tag, hidden, name FROM cust_tags"),
    # similarity
    "tag_tf": _q("SELECT id, cohort_id, chain_id, tag, tf FROM tf"),
    "tag_idf": _q("SELECT tag, df, round(idf, 6) AS idf FROM (SELECT DISTINCT tag, df, idf FROM tfidf)"),
    "tag_tfidf": _q("SELECT id, cohort_id, chain_id, tag, round(weight, 6) AS weight FROM tfidf"),
    "similar_pairs": _q("SELECT name_i, name_j, round(score, 6) AS score FROM sim_pairs"),
    "pairs_differ": _q("SELECT name_i, name_j, round(score, 6) AS score FROM cos_all WHERE ci <> cj AND score > 0.75"),
    "dense_cosine": _q("""
        , pos AS (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS p FROM embeddings),
        cent AS (SELECT label, list(v ORDER BY p) AS centroid FROM (
                   SELECT label, p, avg(cast(x AS double)) AS v FROM pos GROUP BY label, p) GROUP BY label)
        SELECT e.vec_id, e.label,
               round(list_dot_product(cast(e.embedding AS double[]), c.centroid)
                     / (sqrt(list_dot_product(cast(e.embedding AS double[]), cast(e.embedding AS double[])))
                        * sqrt(list_dot_product(c.centroid, c.centroid))), 6) AS cosine
        FROM embeddings e JOIN cent c ON e.label = c.label"""),
    # K
    "contract_violations": _q("""
        SELECT 'o_orderkey' AS column_name, true AS present, true AS type_ok,
               cast(count(*) - count(o_orderkey) AS bigint) AS null_count, cast(0 AS bigint) AS cast_failures,
               count(*) - count(o_orderkey) = 0 AS ok FROM orders
        UNION ALL SELECT 'o_custkey', true, true, cast(count(*) - count(o_custkey) AS bigint), 0,
               count(*) - count(o_custkey) = 0 FROM orders
        UNION ALL SELECT 'o_orderstatus', true, true, cast(count(*) - count(o_orderstatus) AS bigint), 0, true FROM orders
        UNION ALL SELECT 'o_totalprice', true, true, cast(count(*) - count(o_totalprice) AS bigint), 0,
               count(*) - count(o_totalprice) = 0 FROM orders
        UNION ALL SELECT 'o_orderdate', true, false, cast(count(*) - count(o_orderdate) AS bigint), 0, false FROM orders
        UNION ALL SELECT 'o_orderpriority', true, false, cast(count(*) - count(o_orderpriority) AS bigint),
               cast(count(*) FILTER (WHERE o_orderpriority IS NOT NULL AND try_cast(o_orderpriority AS bigint) IS NULL) AS bigint),
               false FROM orders
        UNION ALL SELECT 'o_comment', false, false, cast(NULL AS bigint), cast(NULL AS bigint), false"""),
    "etl_run": _q("""
        SELECT 'base' AS dataset, cast(count(*) AS bigint) AS n_rows FROM base_flat
        UNION ALL SELECT 'cohort_measure_avg', cast(count(DISTINCT cohort_id) AS bigint) FROM base_flat
        UNION ALL SELECT 'cohort_coverage', cast(count(DISTINCT cohort_id) AS bigint) FROM base_flat
        UNION ALL SELECT 'tag_split', cast(count(*) AS bigint) FROM tag_rows JOIN both_ways USING (tag)
        UNION ALL SELECT 'similar_pairs', cast(count(*) AS bigint) FROM sim_pairs
        UNION ALL SELECT 'entity', cast(count(*) AS bigint) FROM ent_flat
        UNION ALL SELECT 'cohort', cast(count(DISTINCT cohort_id) AS bigint) FROM cohort_flat
        UNION ALL SELECT 'cohort_members', cast(count(*) AS bigint) FROM cohort_flat
        UNION ALL SELECT 'chain_members', cast(count(*) AS bigint) FROM chain_flat
        UNION ALL SELECT 'rejects', cast(2 * count(*) AS bigint) FROM pages"""),
}

_JOB_RESULTS = f"""
        SELECT 'cohort_measure_avg' AS dataset, concat(cohort_id, ':', measure) AS key, round(value, 6) AS value
          FROM ({_COHORT_UNPIVOT})
        UNION ALL SELECT 'cohort_coverage', cast(cohort_id AS string), round(avg_coverage, 6) FROM coverage_avg
        UNION ALL SELECT 'tag_split', concat(tag, ':', hidden, ':', name), 1.0 FROM tag_rows JOIN both_ways USING (tag)
        UNION ALL SELECT 'similar_pairs', concat(name_i, ':', name_j), round(score, 6) FROM sim_pairs
        UNION ALL SELECT 'cohort', concat(cohort_id, ':Y', cohort_id, ':', tag), 1.0 FROM cohort_tag_flat
        UNION ALL SELECT 'rejects', 'page:unknown type:1', cast(count(*) AS double) FROM pages
        UNION ALL SELECT 'rejects', 'entity:does not parse:2', cast(count(*) AS double) FROM pages"""
ORACLE["etl_results"] = _q(_JOB_RESULTS)
# in first-branch mode a chain holds its root and the first child only: the two
# lowest names of each nation, as its star document lists them
_TWO_LOWEST = """chain_flat AS (
  SELECT chain_id, member FROM (
    SELECT cast(c_nationkey AS bigint) AS chain_id, concat('E', cast(o_orderkey AS string)) AS member,
           row_number() OVER (PARTITION BY c_nationkey ORDER BY concat('E', cast(o_orderkey AS string))) AS r
    FROM orders JOIN customer ON o_custkey = c_custkey) WHERE r <= 2),
base_flat AS ("""
_start, _end = _VIEWS.index("chain_flat AS ("), _VIEWS.index("base_flat AS (")
ORACLE["etl_results_first_branch"] = ("WITH " + (_VIEWS[:_start] + _TWO_LOWEST + _VIEWS[_end + len("base_flat AS ("):]).strip()
                                      + "\n" + _JOB_RESULTS.strip())

# The UDF variant computes the same numbers as the built-in one.
ORACLE["udf_cosine"] = ORACLE["dense_cosine"]

# the same rows by another way
ORACLE["base_join_bucketed"] = ORACLE["base_join"]
ORACLE["base_join_reduced"] = ORACLE["base_join"]
ORACLE["scan_json_elements"] = ORACLE["scan_json"]
ORACLE["incremental_measure_avg"] = _q(f"SELECT cohort_id, {_avg_cols()} FROM cohort_avg")
ORACLE["incremental_coverage"] = _q("SELECT cohort_id, round(avg_coverage, 6) AS avg_coverage FROM coverage_avg")
ORACLE["incremental_extremes"] = ORACLE["entity_extremes"]

_HELD = """, held AS (SELECT DISTINCT tag, hidden, name FROM (
          SELECT tag, hidden, name FROM cust_tags UNION ALL
          SELECT concat('Y', cast(year(l_shipdate) AS string)), l_returnflag = 'R', concat('E', cast(l_orderkey AS string)) FROM lineitem)),
        n_held AS (SELECT tag, count(*) FILTER (hidden) AS n_set, count(*) FILTER (NOT hidden) AS n_unset FROM held GROUP BY tag)
        """
ORACLE["tag_holder_counts"] = _q(_HELD + "SELECT tag, n_set, n_unset, n_set > 0 AND n_unset > 0 AS both_ways FROM n_held")
ORACLE["tag_holders_expanded"] = _q(_HELD + "SELECT tag, hidden, name FROM held")
ORACLE["tag_holders_both_ways"] = _q(_HELD + "SELECT tag, hidden, name FROM held JOIN n_held USING (tag) WHERE n_set > 0 AND n_unset > 0")

# MLlib's bucket of a text: MurmurHash3 (x86, 32 bits, seed 42) of its UTF-8 bytes, modulo the number of
# buckets.  The numbers are that hash's fixed constants; products of two 32-bit numbers fit UBIGINT.
_BUCKETS = """, byte_list AS (
          SELECT tag, n, list_transform(range(0, n), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::UBIGINT) AS b
          FROM (SELECT DISTINCT tag, hex(encode(tag)) AS h, length(hex(encode(tag))) // 2 AS n FROM tf)),
        word_list AS (
          SELECT tag, n, list_transform(range(0, n // 4 + 1), lambda i: coalesce(b[4 * i + 1], 0)::UBIGINT + coalesce(b[4 * i + 2], 0) * 256
            + coalesce(b[4 * i + 3], 0) * 65536 + coalesce(b[4 * i + 4], 0) * 16777216) AS w FROM byte_list),
        scrambled AS (
          SELECT tag, n, list_transform(list_transform(w, lambda k: k * 3432918353::UBIGINT % 4294967296),
            lambda k: (k * 32768 % 4294967296 + k // 131072) * 461845907::UBIGINT % 4294967296) AS k FROM word_list),
        body AS (
          SELECT tag, n, k[n // 4 + 1] AS rest, list_reduce(list_transform(k[1:n // 4], lambda x: x::UBIGINT), lambda h, x:
            ((xor(h, x) * 8192 % 4294967296 + xor(h, x) // 524288) * 5 + 3864292196) % 4294967296, 42::UBIGINT) AS h FROM scrambled),
        ended AS (SELECT tag, xor(xor(h, rest), n::UBIGINT) AS h FROM body),
        mix1 AS (SELECT tag, xor(h, h // 65536) * 2246822507::UBIGINT % 4294967296 AS h FROM ended),
        mix2 AS (SELECT tag, xor(h, h // 8192) * 3266489909::UBIGINT % 4294967296 AS h FROM mix1),
        buckets AS (SELECT tag, cast(xor(h, h // 65536) % 262144 AS bigint) AS bucket FROM mix2)
        """
ORACLE["tag_hash_buckets"] = _q(_BUCKETS + "SELECT tag, bucket, count(*) OVER (PARTITION BY bucket) AS n_sharing FROM buckets")
ORACLE["tag_hashed_tfidf"] = _q(_BUCKETS + """, bucket_tf AS (
          SELECT id, cohort_id, chain_id, bucket, cast(sum(tf) AS bigint) AS tf FROM tf JOIN buckets USING (tag) GROUP BY ALL),
        bucket_df AS (SELECT bucket, count(*) AS df FROM bucket_tf GROUP BY bucket)
        SELECT id, cohort_id, chain_id, bucket, tf, round(tf * ln((m + 1.0) / (df + 1.0)), 6) AS weight
        FROM bucket_tf JOIN bucket_df USING (bucket) CROSS JOIN n_base""")
