"""SQL (DuckDB dialect) of the queries that SQL can express."""

from __future__ import annotations

from . import centroids, divergence, quality

CAPITALS = quality.CAPITALS
_WINDOW_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def decontamination() -> str:
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{CAPITALS}', '{CAPITALS.lower()}'), '{_WINDOW_WORD}')"
    return f"""
WITH dw AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
iw AS (SELECT CAST(item_id AS VARCHAR) AS item, {words} AS w FROM benchmark WHERE item_id IS NOT NULL),
ig AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS g
       FROM (SELECT item, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
             FROM iw WHERE len(w) > 0) x),
dg AS (SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
       FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i
             FROM dw, (SELECT DISTINCT k FROM ig) ks WHERE len(w) >= k) x),
hit AS (SELECT r, i, k, item FROM dg JOIN ig USING (k, g)),
words AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hit) x GROUP BY r),
items AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS own
          FROM (SELECT DISTINCT r, item FROM hit) x GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
       sha256(coalesce(own, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM dw LEFT JOIN words USING (r) LEFT JOIN items USING (r)"""


def _distance(c: str, ref: str) -> str:
    p, q = f"({c}[i] / list_sum({c}))", f"({ref}[i] / list_sum({ref}))"
    part = "CASE WHEN {0} > 0 THEN {0} * log2(2 * {0} / ({1} + {2})) ELSE 0 END"
    return f"""CASE WHEN list_sum({c}) = 0 OR coalesce(list_sum({ref}), 0) = 0 THEN 0.0 ELSE
    sqrt(greatest(0.0, list_sum(list_transform(range(1, len({c}) + 1),
      lambda i: {part.format(p, p, q)} + {part.format(q, p, q)})) / 2)) END"""


def _near(frm: str, refs: str) -> str:
    return f"""SELECT *, class_distance <= {quality.CLASS_LIMIT} + {quality.CLASS_ALLOWANCE}
           / sqrt(greatest(list_sum(classes), 1)) AND word_distance <= {quality.WORD_LIMIT}
           + {quality.WORD_ALLOWANCE} / sqrt(greatest(n_words, 1)) AS near
  FROM (SELECT c.*, {_distance('classes', 'ref_classes')} AS class_distance,
               {_distance('common', 'ref_common')} AS word_distance
        FROM {frm} c LEFT JOIN {refs} USING (lang)) z"""


def _references(frm: str) -> str:
    def sums(c: str, n: int) -> str:
        return "[" + ", ".join(f"coalesce(sum({c}[{i + 1}]), 0)::DOUBLE" for i in range(n)) + f"] AS ref_{c}"
    return (f"SELECT lang, {sums('classes', len(quality.CLASSES))}, {sums('common', quality.N_COMMON + 1)} "
            f"FROM {frm} GROUP BY lang")


def quality_rules() -> str:
    spaces = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    listed = " ".join(f"WHEN {_text(k)} THEN [{', '.join(map(_text, v))}]" for k, v in quality.COMMON_WORDS.items())
    punctuation = _text(quality.PUNCTUATION)
    return f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
                  CASE WHEN lang IN ({', '.join(map(_text, quality.COMMON_WORDS))}) THEN lang ELSE '' END AS lang
           FROM documents),
s AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w, translate(t, {spaces}, '') AS a FROM t),
s2 AS (SELECT *, translate(a, {_text(quality.SYMBOLS)}, '') AS b FROM s),
s3 AS (SELECT *, translate(b, '{quality.DIGITS}', '') AS c FROM s2),
s4 AS (SELECT *, translate(c, {punctuation}, '') AS d FROM s3),
s5 AS (SELECT *, translate(d, '{CAPITALS}', '') AS e,
              list_transform(w, lambda x: lower(translate(x, {punctuation}, ''))) AS seen,
              CASE lang {listed} ELSE CAST([] AS VARCHAR[]) END AS listed,
              list_filter(string_split(t, chr(10)), lambda x: translate(x, {spaces}, '') <> '') AS lines FROM s4),
g AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
      FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM s WHERE len(w) > 2) x),
rep AS (SELECT r, count(DISTINCT p) AS n
        FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p
              FROM (SELECT *, count(*) OVER (PARTITION BY r, g) AS m FROM g) y WHERE m > 1) x GROUP BY r),
h AS (SELECT *, list_transform(listed, lambda l: len(list_filter(seen, lambda x: x = l))) AS hits FROM s5),
f AS (SELECT h.r, doc_id, lang, CAST(len(w) AS BIGINT) AS n_words, length(a) AS word_chars,
             length(a) - length(b) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             coalesce(rep.n, 0) AS n_repeat_words,
             [greatest(2 * length(e) - strlen(e), 0), length(d) - length(e), length(t) - length(a),
              length(a) - length(b), length(b) - length(c), length(c) - length(d), strlen(e) - length(e)] AS classes,
             list_append(hits, greatest(len(w) - coalesce(list_sum(hits), 0), 0)) AS common
      FROM h LEFT JOIN rep USING (r)),
j AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f),
p AS (SELECT * FROM j WHERE NOT base_failed),
ref1 AS ({_references('p')}),
n1 AS ({_near('p', 'ref1')}),
ref2 AS ({_references('(SELECT * FROM n1 WHERE near) y')}),
n2 AS ({_near('j', 'ref2')})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND near AS kept, round(class_distance, 6) AS class_distance,
       round(word_distance, 6) AS word_distance FROM n2"""


def walsh_centroids() -> str:
    """The assignments and means of every round as one step each, by plain distances."""
    d = centroids.DIMENSIONS
    far = "list_sum(list_transform(range(1, {0}), lambda i: (v.x[i] - c.c[i]) * (v.x[i] - c.c[i])))".format(d + 1)
    mean = ", ".join(f"(sum(x[{i}]) - ((sum(x[{i}]) % count(*)) + count(*)) % count(*)) // count(*)" for i in range(1, d + 1))
    steps = [f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding,
             lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS HUGEINT)) AS x
           FROM embeddings WHERE len(embedding) = {d} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {d}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, x) - 1 AS j, x AS c
       FROM (SELECT sha256('3:' || CAST(vec_id AS VARCHAR)) AS h, x FROM v ORDER BY h, x LIMIT {centroids.CENTROIDS}) f)"""]
    for n in range(centroids.ROUNDS + 1):
        steps.append(f"""a{n} AS MATERIALIZED (SELECT r, min(struct_pack(d := d, j := j)) AS best
       FROM (SELECT v.r, c.j, {far} AS d FROM v, c{n} c) e GROUP BY r)""")
        if n < centroids.ROUNDS:
            steps.append(f"""c{n + 1} AS MATERIALIZED (SELECT j, coalesce(m.c, c{n}.c) AS c FROM c{n} LEFT JOIN
       (SELECT best.j AS j, [{mean}] AS c FROM a{n} JOIN v USING (r) GROUP BY best.j) m USING (j))""")
    n = centroids.ROUNDS
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, CAST(best.j AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance,
       CAST(sum(best.d) OVER (PARTITION BY best.j) AS BIGINT) AS cluster_inertia,
       CAST(sum(best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{n} JOIN v USING (r) JOIN c{n} ON c{n}.j = best.j"""


def source_divergence() -> str:
    share = "1 + ({} + 2)::HUGEINT * " + str(divergence.UNIT) + " // ({} + 2 * terms)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), '{CAPITALS}', '{CAPITALS.lower()}'),
                                     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT r) >= {divergence.LEAST_DOCS}),
n AS (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(total, 0) AS total, coalesce(terms, 0) AS terms,
             sum(coalesce(total, 0)) OVER (PARTITION BY lang) AS lang_total
      FROM (SELECT DISTINCT lang, source FROM d) o
      LEFT JOIN (SELECT lang, source, sum(n) AS total FROM n GROUP BY ALL) y USING (lang, source)
      LEFT JOIN (SELECT lang, count(*) AS terms FROM k GROUP BY ALL) z USING (lang)),
p AS (SELECT lang, source, term, coalesce(n, 0) AS n, {share.format('coalesce(n, 0)', 'total')} AS p,
             {share.format('sum(coalesce(n, 0)) OVER (PARTITION BY lang, term)', 'lang_total')} AS q
      FROM g JOIN k USING (lang) LEFT JOIN n USING (lang, source, term)),
pairs AS (SELECT lang, x.source, y.source AS item, coalesce(value, 0) AS value
          FROM g x JOIN g y USING (lang) LEFT JOIN
               (SELECT lang, x.source AS s1, y.source AS s2, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
                FROM p x JOIN p y USING (lang, term) GROUP BY ALL) f
               ON f.lang = x.lang AND s1 = x.source AND s2 = y.source
          WHERE x.source <> y.source),
tops AS (SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
UNION ALL
SELECT * FROM (SELECT lang, source, 'term' AS part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM tops) u
WHERE rank <= {divergence.TOP}"""


def oracle_sql() -> dict[str, str]:
    return {
        "op5_quality_rules": quality_rules(),
        "op8_benchmark_decontamination": decontamination(),
        "op11_walsh_centroids": walsh_centroids(),
        "op13_source_divergence": source_divergence(),
    }
