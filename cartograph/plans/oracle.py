"""Independent SQL (DuckDB dialect) for every registered query.

The SQL is written from the semantics, not from the Spark plans: each string must run on
the driver's pre-registered views (events, orders, lineitem, ...).
"""

from __future__ import annotations

# Clean logs of the bindings as CTE bodies.
LOG_A = """
SELECT * FROM (
  SELECT user_id,
         TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
         TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS category_id,
         CASE event_type WHEN 'view' THEN 'pv' WHEN 'click' THEN 'fav'
              WHEN 'signup' THEN 'cart' WHEN 'purchase' THEN 'buy' ELSE event_type END
           AS behavior_type,
         CAST(floor(epoch(ts)) AS BIGINT) AS ts
  FROM events) a
WHERE behavior_type IN ('pv', 'cart', 'fav', 'buy') AND user_id IS NOT NULL
  AND item_id IS NOT NULL AND category_id IS NOT NULL AND ts IS NOT NULL
"""

LOG_B = """
SELECT * FROM (
  SELECT o_custkey AS user_id, l_partkey AS item_id, l_suppkey AS category_id,
         CASE l_linenumber % 4 WHEN 0 THEN 'pv' WHEN 1 THEN 'cart' WHEN 2 THEN 'fav'
              WHEN 3 THEN 'buy' END AS behavior_type,
         CAST(floor(epoch(o_orderdate)) AS BIGINT) AS ts
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey) b
WHERE behavior_type IN ('pv', 'cart', 'fav', 'buy') AND user_id IS NOT NULL
  AND item_id IS NOT NULL AND category_id IS NOT NULL AND ts IS NOT NULL
"""

# Binding C: dirty text lines from binding A, then the text parser.
_JTRIM = "regexp_replace({x}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"


def _jtrim(x: str) -> str:
    return _JTRIM.format(x=x)


def _plong(x: str) -> str:
    return f"CASE WHEN regexp_full_match({x}, '[+-]?[0-9]+') THEN TRY_CAST({x} AS BIGINT) END"


LOG_C = f"""
SELECT * FROM (
  SELECT {_plong(_jtrim('p[1]'))} AS user_id, {_plong(_jtrim('p[2]'))} AS item_id,
         {_plong(_jtrim('p[3]'))} AS category_id, {_jtrim('p[4]')} AS behavior_type,
         {_plong(_jtrim('p[5]'))} AS ts
  FROM (
    SELECT CASE WHEN contains(l, ',') THEN string_split(l, ',')
                ELSE regexp_split_to_array(l, '\\s+') END AS p
    FROM (
      SELECT {_jtrim('value')} AS l FROM (
        SELECT CASE CASE WHEN e % 20 = 0 THEN -1 ELSE e % 10 END
          WHEN -1 THEN concat_ws(' ', u || chr(127), i, c, b, t)
          WHEN 0 THEN concat_ws(' ', u, i, c, b, t)
          WHEN 1 THEN concat_ws(' , ', u, i, c, b, t)
          WHEN 2 THEN concat_ws(',', u, i, c, upper(b), t)
          WHEN 3 THEN concat_ws(',', u, i, c, b, t, 'extra')
          WHEN 4 THEN concat_ws(',', u, i, c, b)
          WHEN 5 THEN concat_ws(',', '1.5', i, c, b, t)
          WHEN 6 THEN concat_ws(',', '+' || u, i, c, b, t)
          WHEN 7 THEN chr(9) || ' '
          WHEN 8 THEN 'user_id,item_id,category_id,behavior_type,timestamp'
          ELSE concat_ws(',', u, i, c, b, t) END AS value
        FROM (
          SELECT event_id AS e, CAST(user_id AS VARCHAR) AS u,
                 CAST(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS VARCHAR) AS i,
                 CAST(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS VARCHAR) AS c,
                 CASE event_type WHEN 'view' THEN 'pv' WHEN 'click' THEN 'fav'
                      WHEN 'signup' THEN 'cart' WHEN 'purchase' THEN 'buy'
                      ELSE event_type END AS b,
                 CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR) AS t
          FROM events) r) v) w
    WHERE length(l) > 0
      AND NOT ((contains(l, 'user_id') AND contains(l, 'timestamp'))
               OR starts_with(l, 'user_id') OR starts_with(l, 'timestamp'))) x
  WHERE len(p) = 5) y
WHERE behavior_type IN ('pv', 'cart', 'fav', 'buy') AND user_id IS NOT NULL
  AND item_id IS NOT NULL AND category_id IS NOT NULL AND ts IS NOT NULL
"""

# A chain from customer keys: user i with the items i and i + 1 and six of their own.
LOG_N = """
SELECT CAST(c_custkey AS BIGINT) AS user_id,
       CAST(CASE WHEN i < 2 THEN c_custkey + i ELSE -(100 * c_custkey + i - 1) END AS BIGINT) AS item_id,
       'fav' AS behavior_type FROM customer CROSS JOIN range(8) v(i)
"""

# Binding A with text ids: every third item and every user of an even number are no numbers.
LOG_T = f"""
SELECT * REPLACE (CASE WHEN user_id % 2 = 0 THEN 'u-' ELSE '' END || user_id AS user_id,
                  CASE WHEN item_id % 3 = 0 THEN 'item ' ELSE '' END || item_id AS item_id) FROM ({LOG_A}) t
"""

# Clean-log lines of binding A with faults by user_id % 7, validated again.
LOG_R = f"""
SELECT CASE WHEN user_id % 7 = 3 THEN '-' ELSE '' END || user_id AS user_id,
       CASE WHEN user_id % 7 = 4 THEN 'item' ELSE '' END || item_id AS item_id,
       CAST(category_id AS VARCHAR) AS category_id, behavior_type, CAST(ts AS VARCHAR) AS ts
FROM ({LOG_A}) r WHERE user_id % 7 NOT IN (2, 3, 5)
"""

LOGS = {"a": LOG_A, "b": LOG_B, "c": LOG_C, "n": LOG_N, "r": LOG_R, "t": LOG_T}


def with_log(log: str, body: str) -> str:
    return f"WITH log AS ({LOGS[log]})\n{body}"


ACTIVITY = """
act AS (
  SELECT user_id, max(ts) AS max_ts, greatest(0, max(ts)) AS last_ts,
         count(*) AS cnt,
         CAST(sum(CASE behavior_type WHEN 'buy' THEN 4 WHEN 'cart' THEN 3
                  WHEN 'fav' THEN 2 ELSE 1 END) AS BIGINT) AS score_sum
  FROM log GROUP BY user_id),
bnd AS (
  SELECT max(max_ts) AS cutoff, min(last_ts) AS last_min, max(last_ts) AS last_max,
         min(cnt) AS cnt_min, max(cnt) AS cnt_max,
         min(score_sum) AS score_min, max(score_sum) AS score_max FROM act)
"""


def _days(cutoff: str, last: str) -> str:
    return f"(CAST({cutoff} - {last} AS DOUBLE) / CAST(86400.0 AS DOUBLE))"


def _scaled(x: str, lo: str, hi: str) -> str:
    rng = f"(CASE WHEN ({hi}) - ({lo}) < 1e-12 THEN 1.0::DOUBLE ELSE ({hi}) - ({lo}) END)"
    return f"least(1.0::DOUBLE, greatest(0.0::DOUBLE, (({x}) - ({lo})) / {rng}))"


def raw_features_sql(log: str) -> str:
    return with_log(log, f""", {ACTIVITY.strip()}
SELECT user_id, {_days('cutoff', 'last_ts')} AS f1, CAST(cnt AS DOUBLE) AS f2,
       CAST(score_sum AS DOUBLE) AS f3
FROM act CROSS JOIN bnd""")


def feature_bounds_sql(log: str) -> str:
    return with_log(log, f""", {ACTIVITY.strip()}
SELECT {_days('cutoff', 'last_max')} AS f1_min, {_days('cutoff', 'last_min')} AS f1_max,
       CAST(cnt_min AS DOUBLE) AS f2_min, CAST(cnt_max AS DOUBLE) AS f2_max,
       CAST(score_min AS DOUBLE) AS f3_min, CAST(score_max AS DOUBLE) AS f3_max
FROM bnd""")


def user_features_body() -> str:
    f1 = _scaled(_days('cutoff', 'last_ts'), _days('cutoff', 'last_max'),
                 _days('cutoff', 'last_min'))
    f2 = _scaled("CAST(cnt AS DOUBLE)", "CAST(cnt_min AS DOUBLE)", "CAST(cnt_max AS DOUBLE)")
    f3 = _scaled("CAST(score_sum AS DOUBLE)", "CAST(score_min AS DOUBLE)",
                 "CAST(score_max AS DOUBLE)")
    return f"""{ACTIVITY.strip()},
feat AS (SELECT user_id, {f1} AS f1, {f2} AS f2, {f3} AS f3 FROM act CROSS JOIN bnd)"""


def user_features_sql(log: str) -> str:
    return with_log(log, f""", {user_features_body()}
SELECT user_id, f1, f2, f3 FROM feat""")


EDGES = """
edges AS (SELECT DISTINCT item_id, user_id FROM log
          WHERE user_id >= 0 AND behavior_type IN ('cart', 'fav', 'buy'))
"""


def inverted_index_sql(log: str, width: int) -> str:
    return with_log(log, f""", {EDGES.strip()}
SELECT item_id, user_id // {width} AS part, count(*) AS n_users,
       string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY user_id) AS users
FROM edges GROUP BY item_id, user_id // {width}""")


BASKETS = """
baskets AS (SELECT DISTINCT user_id, CAST(item_id AS VARCHAR) AS item FROM log
            WHERE behavior_type = 'buy' AND user_id >= 0),
pairs AS (SELECT a.item AS item_a, b.item AS item_b, count(*) AS cnt
          FROM baskets a JOIN baskets b ON a.user_id = b.user_id AND a.item < b.item
          GROUP BY a.item, b.item)
"""


def pair_counts_sql(log: str) -> str:
    return with_log(log, f""", {BASKETS.strip()}
SELECT item_a, item_b, cnt FROM pairs""")


def top_pairs_sql(log: str, n: int = 1000) -> str:
    return with_log(log, f""", {BASKETS.strip()}
SELECT item_a, item_b, cnt,
       CAST(row_number() OVER (ORDER BY cnt DESC, item_a, item_b) AS INTEGER) AS rank
FROM pairs ORDER BY cnt DESC, item_a, item_b LIMIT {n}""")


def _dist(p: str, c: str) -> str:
    terms = [f"({p}.f{i} - {c}.c{i}) * ({p}.f{i} - {c}.c{i})" for i in (1, 2, 3)]
    return f"sqrt({terms[0]} + {terms[1]} + {terms[2]})"


def _kmeans_ctes(log: str, k: int, rounds: int, seed: int = 42, tol: float = 1e-6) -> str:
    """Feature CTEs, the k start centres (c0) and ``rounds`` unrolled Lloyd rounds (c1..)."""
    key = f"md5('{seed}:' || CAST(user_id AS VARCHAR))"
    parts = [f"WITH log AS ({LOGS[log]}), {user_features_body()}",
             f"""c0 AS (
  SELECT CAST(row_number() OVER (ORDER BY {key}, user_id) - 1 AS INTEGER) AS cid,
         f1 AS c1, f2 AS c2, f3 AS c3, false AS done, 0 AS it
  FROM feat ORDER BY {key}, user_id LIMIT {k})"""]
    for i in range(1, rounds + 1):
        prev = f"c{i - 1}"
        parts.append(f"""a{i} AS (
  SELECT p.user_id, p.f1, p.f2, p.f3, c.cid,
         row_number() OVER (PARTITION BY p.user_id ORDER BY {_dist('p', 'c')}, c.cid) AS rn
  FROM feat p CROSS JOIN {prev} c)""")
        parts.append(f"""m{i} AS (
  SELECT cid, sum(f1) / count(*) AS m1, sum(f2) / count(*) AS m2, sum(f3) / count(*) AS m3,
         count(*) AS n
  FROM a{i} WHERE rn = 1 GROUP BY cid)""")
        parts.append(f"""n{i} AS (
  SELECT c.cid, c.c1 AS o1, c.c2 AS o2, c.c3 AS o3, c.done, c.it,
         coalesce(m.m1, c.c1) AS n1, coalesce(m.m2, c.c2) AS n2, coalesce(m.m3, c.c3) AS n3,
         coalesce(m.n, 0) AS n
  FROM {prev} c LEFT JOIN m{i} m ON c.cid = m.cid)""")
        parts.append(f"""s{i} AS (
  SELECT sum(sqrt((o1 - n1) * (o1 - n1) + (o2 - n2) * (o2 - n2) + (o3 - n3) * (o3 - n3)))
         AS shift FROM n{i})""")
        parts.append(f"""c{i} AS (
  SELECT cid,
         CASE WHEN done OR shift < {tol} THEN o1 ELSE n1 END AS c1,
         CASE WHEN done OR shift < {tol} THEN o2 ELSE n2 END AS c2,
         CASE WHEN done OR shift < {tol} THEN o3 ELSE n3 END AS c3,
         done OR shift < {tol} AS done,
         CASE WHEN done THEN it ELSE {i} END AS it, n, n1, n2, n3
  FROM n{i} CROSS JOIN s{i})""")
    return ",\n".join(parts)


def kmeans_init_sql(log: str, k: int) -> str:
    return _kmeans_ctes(log, k, 0) + "\nSELECT cid AS cluster_id, c1 AS f1, c2 AS f2, c3 AS f3 FROM c0"


def _label_sql(centres: str) -> str:
    return f"""
SELECT user_id, cid AS cluster_id FROM (
  SELECT p.user_id, c.cid,
         row_number() OVER (PARTITION BY p.user_id ORDER BY {_dist('p', 'c')}, c.cid) AS rn
  FROM feat p CROSS JOIN {centres} c) z WHERE rn = 1"""


def kmeans_assign_sql(log: str, k: int) -> str:
    return _kmeans_ctes(log, k, 0) + _label_sql("c0")


def kmeans_step_sql(log: str, k: int) -> str:
    return _kmeans_ctes(log, k, 1) + """
SELECT cid AS cluster_id, round(n1, 9) AS f1, round(n2, 9) AS f2, round(n3, 9) AS f3,
       CAST(n AS BIGINT) AS n FROM n1"""


def kmeans_centers_sql(log: str, k: int, rounds: int = 30) -> str:
    return _kmeans_ctes(log, k, rounds) + f"""
SELECT cid AS cluster_id, round(c1, 6) AS f1, round(c2, 6) AS f2, round(c3, 6) AS f3
FROM c{rounds}"""


def kmeans_labels_sql(log: str, k: int, rounds: int = 30) -> str:
    return _kmeans_ctes(log, k, rounds) + _label_sql(f"c{rounds}")


TEXT_EDGES = """
edges AS (SELECT DISTINCT item_id, user_id FROM log WHERE behavior_type IN ('cart', 'fav', 'buy'))
"""


def _rank_ctes(log: str, target: int | str, rounds: int, alpha: float = 0.85, n: int = 10) -> str:
    return f"""WITH RECURSIVE log AS ({LOGS[log]}), {(EDGES if isinstance(target, int) else TEXT_EDGES).strip()},
g AS (SELECT true AS src_item, item_id AS src, false AS dst_item, user_id AS dst FROM edges
      UNION ALL
      SELECT false AS src_item, user_id AS src, true AS dst_item, item_id AS dst FROM edges),
deg AS (SELECT src_item, src, count(*) AS degree FROM g GROUP BY src_item, src),
ge AS (SELECT g.src_item, g.src, g.dst_item, g.dst, CAST(d.degree AS DOUBLE) AS deg
       FROM g JOIN deg d ON g.src_item = d.src_item AND g.src = d.src),
pr(it, is_item, node, score) AS (
  SELECT 0, src_item, src,
         CASE WHEN NOT src_item AND src = {target} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
  FROM deg
  UNION ALL
  SELECT p.it + 1, ge.dst_item, ge.dst,
         sum({alpha} * (p.score / ge.deg))
           + CASE WHEN NOT ge.dst_item AND ge.dst = {target} THEN {1 - alpha} ELSE 0.0 END
  FROM pr p JOIN ge ON p.is_item = ge.src_item AND p.node = ge.src
  WHERE p.it < {rounds}
  GROUP BY p.it, ge.dst_item, ge.dst),
final AS (SELECT is_item, node, score FROM pr WHERE it = {rounds}),
seen AS (SELECT DISTINCT item_id FROM log WHERE user_id = {target}),
cand AS (SELECT node AS item_id, score FROM final
         WHERE is_item AND node NOT IN (SELECT item_id FROM seen)),
top AS (SELECT item_id, score,
               row_number() OVER (ORDER BY {significant('score', 12)} DESC, item_id) AS rank
        FROM cand ORDER BY {significant('score', 12)} DESC, item_id LIMIT {n})"""


def recommend_sql(log: str, target: int, n: int = 10) -> str:
    return _rank_ctes(log, target, 30, n=n) + f"""
SELECT CAST({target} AS BIGINT) AS user_id, CAST(rank AS INTEGER) AS rank, item_id,
       {significant('score', 7)} AS score FROM top"""


def recommend_text_sql(log: str, target: str) -> str:
    return _rank_ctes(log, f"'{target}'", 30) + f"""
SELECT '{target}' AS user_id, CAST(rank AS INTEGER) AS rank, item_id, {significant('score', 7)} AS score FROM top"""


def kmeans_labels_text_sql(log: str, k: int) -> str:
    """Labels of the features as they are written, with the users of even numbers renamed."""
    user = "CASE WHEN user_id % 2 = 0 THEN 'u-' ELSE '' END || user_id"
    back = ", ".join(f"CAST({java_fixed(c, 4)} AS DOUBLE) AS {c}" for c in ("f1", "f2", "f3"))
    whole = kmeans_labels_sql(log, k)
    head, rest = whole.split(",\nc0 AS", 1)
    head = head.replace("feat AS (", "feat0 AS (", 1)
    return f"{head},\nfeat AS (SELECT {user} AS user_id, {back} FROM feat0),\nc0 AS{rest}"


def recommend_line_sql(log: str, target: int) -> str:
    return _rank_ctes(log, target, 30) + f"""
SELECT '{target}' || chr(9) || coalesce(
         (SELECT string_agg(CAST(item_id AS VARCHAR) || ':' || {java_fixed('score', 3)}, ','
                            ORDER BY rank) FROM top), '') AS value"""


def pr_scores_sql(log: str, target: int, rounds: int) -> str:
    return _rank_ctes(log, target, rounds) + f"""
SELECT is_item, node, {significant('score', 7)} AS score FROM final"""


def significant(x: str, n: int) -> str:
    """x rounded to n significant decimal digits."""
    return f"CAST(printf('%.{n - 1}e', {x}) AS DOUBLE)"


def java_fixed(x: str, n: int) -> str:
    """Text of x with n decimals, rounded half-up on its shortest decimal form (Java's %.nf)."""
    return (f"CAST(CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 18)), {n}) "
            f"AS DECIMAL(38, {n})) AS VARCHAR)")


def clean_lines_sql(log: str) -> str:
    return with_log(log, """SELECT concat_ws(',', CAST(user_id AS VARCHAR), CAST(item_id AS VARCHAR),
  CAST(category_id AS VARCHAR), behavior_type, CAST(ts AS VARCHAR)) AS value FROM log""")


def feature_lines_sql(log: str) -> str:
    return with_log(log, f""", {user_features_body()}
SELECT concat_ws(',', CAST(user_id AS VARCHAR), {java_fixed('f1', 4)}, {java_fixed('f2', 4)},
                 {java_fixed('f3', 4)}) AS value FROM feat""")


def features_roundtrip_sql(log: str) -> str:
    back = [f"CAST({java_fixed(c, 4)} AS DOUBLE) AS {c}" for c in ("f1", "f2", "f3")]
    return with_log(log, f""", {user_features_body()}
SELECT user_id, {', '.join(back)} FROM feat""")


def index_lines_sql(log: str) -> str:
    return with_log(log, f""", {EDGES.strip()}
SELECT CAST(item_id AS VARCHAR) || chr(9) ||
       string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY user_id) AS value
FROM edges GROUP BY item_id""")


def pair_lines_sql(log: str, n: int = 1000) -> str:
    return with_log(log, f""", {BASKETS.strip()}
SELECT item_a || ',' || item_b || chr(9) || CAST(cnt AS VARCHAR) AS value
FROM pairs ORDER BY cnt DESC, item_a, item_b LIMIT {n}""")


def center_lines_sql(log: str, k: int, rounds: int = 30) -> str:
    nums = ", ".join(java_fixed(c, 4) for c in ("c1", "c2", "c3"))
    return _kmeans_ctes(log, k, rounds) + f"""
SELECT CAST(cid AS VARCHAR) || chr(9) || concat_ws(',', {nums}) AS value FROM c{rounds}"""


def label_lines_sql(log: str, k: int, rounds: int = 30) -> str:
    return _kmeans_ctes(log, k, rounds) + f"""
SELECT CAST(user_id AS VARCHAR) || ',' || CAST(cluster_id AS VARCHAR) AS value
FROM ({_label_sql(f"c{rounds}")}) z"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["clean_log_events"] = with_log("a", "SELECT * FROM log")
    q["clean_log_orders"] = with_log("b", "SELECT * FROM log")
    q["clean_text"] = with_log("c", "SELECT * FROM log")
    q["cutoff_ts"] = with_log("b", "SELECT max(ts) AS max_ts FROM log")
    q["user_raw_features"] = raw_features_sql("b")
    q["feature_bounds"] = feature_bounds_sql("b")
    q["user_features"] = user_features_sql("b")
    q["user_features_events"] = user_features_sql("a")
    q["user_features_text"] = user_features_sql("c")
    q["deep_edges"] = with_log("b", f", {EDGES.strip()}\nSELECT item_id, user_id FROM edges")
    q["item_degree"] = with_log("b", f", {EDGES.strip()}\n"
                                "SELECT item_id, count(*) AS degree FROM edges GROUP BY item_id")
    q["inverted_index"] = inverted_index_sql("b", 100_000)
    q["inverted_index_split"] = inverted_index_sql("a", 3)
    q["buy_baskets"] = with_log("b", f", {BASKETS.strip()}\nSELECT user_id, item FROM baskets")
    q["pair_counts"] = pair_counts_sql("b")
    q["pair_counts_split"] = pair_counts_sql("a")
    q["top_pairs"] = top_pairs_sql("b")
    q["top_pairs_events"] = top_pairs_sql("a")
    q["kmeans_init"] = kmeans_init_sql("b", 5)
    q["kmeans_assign"] = kmeans_assign_sql("b", 5)
    q["kmeans_step"] = kmeans_step_sql("b", 5)
    q["kmeans_centers"] = kmeans_centers_sql("b", 5)
    q["kmeans_labels"] = kmeans_labels_sql("b", 5)
    q["kmeans_centers_events"] = kmeans_centers_sql("a", 4)
    q["kmeans_labels_events"] = kmeans_labels_sql("a", 4)
    q["graph_degree"] = with_log("b", f""", {EDGES.strip()},
g AS (SELECT true AS src_item, item_id AS src FROM edges
      UNION ALL SELECT false AS src_item, user_id AS src FROM edges)
SELECT src_item AS is_item, src AS node, count(*) AS degree FROM g GROUP BY src_item, src""")
    q["seen_items"] = with_log("b", "SELECT DISTINCT item_id FROM log WHERE user_id = 899")
    q["pr_step"] = pr_scores_sql("b", 899, 1)
    q["pr_scores"] = pr_scores_sql("b", 899, 30)
    q["recommend_top10"] = recommend_sql("b", 899)
    q["recommend_top10_events"] = recommend_sql("a", 7)
    q["recommend_cold_user"] = recommend_sql("b", -1)
    q["recommend_chain"] = recommend_sql("n", 1, 100)
    q["recommend_text_ids"] = recommend_text_sql("t", "u-8")
    q["recommend_text_cold"] = recommend_text_sql("t", "nobody")
    q["kmeans_labels_text_ids"] = kmeans_labels_text_sql("a", 4)
    q["graph_repeated_edges"] = with_log("a", """
SELECT true AS is_item, item_id AS node, count(*) AS degree FROM log
WHERE behavior_type <> 'pv' GROUP BY item_id
UNION ALL SELECT false, user_id, count(*) FROM log WHERE behavior_type <> 'pv' GROUP BY user_id""")
    q["index_text_ids"] = with_log("r", """,
edges AS (SELECT DISTINCT item_id, CAST(user_id AS BIGINT) AS user_id FROM log
          WHERE behavior_type IN ('cart', 'fav', 'buy'))
SELECT item_id || chr(9) || string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY user_id) AS value
FROM edges GROUP BY item_id""")
    q["clean_log_revalidated"] = with_log("r", "SELECT * FROM log")
    q["roundtrip_raw_text"] = q["clean_text"]
    q["roundtrip_pairs_text"] = pair_lines_sql("b")
    q["roundtrip_centers_text"] = center_lines_sql("b", 5)
    q["roundtrip_labels_text"] = label_lines_sql("b", 5)
    q["overwrite_twice"] = with_log("a", "SELECT * FROM log")
    q["recommend_line"] = recommend_line_sql("b", 899)
    q["clean_lines"] = clean_lines_sql("b")
    q["feature_lines"] = feature_lines_sql("b")
    q["index_lines"] = index_lines_sql("b")
    q["pair_lines"] = pair_lines_sql("b")
    q["center_lines"] = center_lines_sql("b", 5)
    q["label_lines"] = label_lines_sql("b", 5)
    q["roundtrip_clean_text"] = with_log("b", "SELECT * FROM log")
    q["roundtrip_features_text"] = features_roundtrip_sql("b")
    q["roundtrip_index_text"] = with_log("b", f", {EDGES.strip()}\nSELECT item_id, user_id FROM edges")
    q["stream_clean_events"] = with_log("a", "SELECT * FROM log")
    q["batch_text_recommendation"] = recommend_line_sql("c", 7)
    return q
