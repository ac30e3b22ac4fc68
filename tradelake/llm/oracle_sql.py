"""SQL twins (DuckDB) of the queries that SQL can express."""

from __future__ import annotations

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

URLS = """
WITH parsed AS (
    SELECT page_id, coalesce(url, '') AS u, strpos(coalesce(url, ''), '://') AS place FROM pages
), bare AS (
    SELECT page_id, CASE WHEN place > 0 THEN regexp_extract(substr(u, place + 3), '^[^?#]*') ELSE '' END AS rest FROM parsed
), split AS (
    SELECT page_id, {lower} AS host, substr(rest, length(regexp_extract(rest, '^[^/]*')) + 1) AS path FROM bare
), rules(rule, rule_host, rule_path, verdict) AS (
    VALUES ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
           ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'),
           ('com/de/', 'com', '/de/', 'block')
), best AS (
    SELECT s.*, r.rule, r.verdict,
           row_number() OVER (PARTITION BY page_id, host, path
                              ORDER BY length(rule_host) DESC NULLS LAST, length(rule_path) DESC) AS place
    FROM split s LEFT JOIN rules r
      ON (s.host = r.rule_host OR ends_with(s.host, '.' || r.rule_host)) AND starts_with(s.path, r.rule_path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM best WHERE place = 1
""".format(lower=LOWER.format("regexp_extract(rest, '^[^/]*')"))

EXACT = """
WITH hashed AS (
    SELECT doc_id, sha256({lower}) AS text_sha256 FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM hashed
""".format(lower=LOWER.format("coalesce(text, '')"))

LINES = """
WITH docs AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), numbered AS (
    SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS i FROM docs
), paired AS (
    SELECT doc_id, i, line || chr(10) || lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS body FROM numbered
), placed AS (
    SELECT doc_id, i, row_number() OVER (PARTITION BY body ORDER BY doc_id, i) = 1 AS stays,
           count(*) OVER (PARTITION BY body) AS n FROM paired WHERE body IS NOT NULL
), gone AS (
    SELECT doc_id, unnest([i, i + 1]) AS i FROM placed WHERE NOT stays
    EXCEPT
    SELECT doc_id, unnest([i, i + 1]) AS i FROM placed WHERE stays AND n > 1
), marked AS (
    SELECT l.doc_id, l.i, line, g.i IS NOT NULL AS gone,
           lag(g.i IS NOT NULL) OVER (PARTITION BY l.doc_id ORDER BY l.i) AS before
    FROM numbered l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed_lines,
       count(*) FILTER (gone AND NOT coalesce(before, false)) AS n_removed_chunks,
       coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text
FROM marked GROUP BY doc_id
"""


NEAR = """
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all({lower}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
    FROM worded
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), meets AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM meets JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
    WHERE 100 * shared >= 85 * (p.n + q.n - shared)
), edges AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
    SELECT a AS doc_id, a AS other FROM edges
    UNION
    SELECT reach.doc_id, edges.b FROM reach JOIN edges ON reach.other = edges.a
), least AS (
    SELECT doc_id, min(other) AS least FROM reach GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(least, d.doc_id) AS component_id,
       coalesce(least, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least l ON l.doc_id = d.doc_id
""".format(lower=LOWER.format("coalesce(text, '')"))


def _codes(rounds: int = 2) -> str:
    """Codebooks of 64 entries for 16 parts; distances are whole numbers, kept exact by doubles."""
    steps = [
        """kept AS (
    SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
    SELECT r, p, v[p * (len(v) // 16) + 1 : (p + 1) * (len(v) // 16)] AS x FROM kept, range(16) t(p)
), book0 AS (
    SELECT p, r - 1 AS e, x AS c FROM parts WHERE r <= 64
)"""
    ]
    for i in range(rounds + 1):
        steps.append(f"""code{i} AS (
    SELECT r, p, any_value(x) AS x,
           min(((list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c)) * 64 + e)::BIGINT) AS k
    FROM parts JOIN book{i} USING (p) GROUP BY r, p
)""")
        if i < rounds:
            steps.append(f"""mean{i} AS (
    SELECT p, e, list(m ORDER BY i) AS c
    FROM (SELECT p, k % 64 AS e, i, floor(sum(x[i]) / count(*)) AS m
          FROM code{i}, range(1, 1 + (SELECT max(len(x)) FROM parts)) t(i) GROUP BY ALL) GROUP BY p, e
), book{i + 1} AS (
    SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{i} b LEFT JOIN mean{i} m ON b.p = m.p AND b.e = m.e
)""")
    steps.append(f"""coded AS (
    SELECT r, string_agg(lower(printf('%02x', k % 64)), '' ORDER BY p) AS code, sum(k // 64)::BIGINT AS error
    FROM code{rounds} GROUP BY r
), books AS (
    SELECT sha256(string_agg(y::BIGINT::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256
    FROM (SELECT p, e, unnest(c) AS y, unnest(range(len(c))) AS i FROM book{rounds})
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN kept USING (r), books""")
    return "WITH " + ", ".join(steps)


# The checksum bit by bit; the numbers are those of the common CRC-32.
RESAMPLED = """
WITH texts AS (
    SELECT 0 AS target, doc_id AS id, text FROM documents
    UNION ALL
    SELECT 1, item_id, text FROM benchmark
), worded AS (
    SELECT target, id, regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM texts
), features AS (
    SELECT target, id, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS feature FROM worded
), distinct_features AS (
    SELECT DISTINCT feature, hex(feature) AS x FROM features
), bucketed AS (
    SELECT feature, xor(list_reduce(
        list_prepend(4294967295, list_transform(range(0, len(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
        lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda d, z: xor(d >> 1, 3988292384 * (d & 1)))
    ), 4294967295) % 10000 AS bucket FROM distinct_features
), placed AS (
    SELECT target, id, bucket FROM features JOIN bucketed USING (feature)
), totals AS (
    SELECT count(*) FILTER (target = 0) AS s_all, count(*) FILTER (target = 1) AS t_all FROM placed
), gains AS (
    SELECT bucket, floor(1000 * ln((count(*) FILTER (target = 1) + 1)::DOUBLE * (s_all + 10000)
                                   / ((count(*) FILTER (target = 0) + 1)::DOUBLE * (t_all + 10000))))::BIGINT AS gain
    FROM placed, totals GROUP BY bucket, s_all, t_all
), weights AS (
    SELECT id, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
    FROM placed JOIN gains USING (bucket) WHERE target = 0 GROUP BY id
), scored AS (
    SELECT id AS doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(len(w), 0) >= 20 AS fits,
           coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || id), 1, 8))::BIGINT + 0.5::DOUBLE)
                                                      / 4294967296)))::BIGINT AS score
    FROM worded LEFT JOIN weights USING (id) WHERE target = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY fits ORDER BY score DESC, doc_id) AS place,
           count(*) FILTER (fits) OVER () * 25 // 100 AS drawn FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN fits AND place <= drawn THEN place END AS rank FROM ranked
""".replace("{lower}", LOWER.format("coalesce(text, '')"))

ORACLE = {
    "op2_url_filters": URLS,
    "op6_exact_dedup": EXACT,
    "op7_line_dedup": LINES,
    "op11_minhash_near_dedup": NEAR,
    "op12_vector_code_compression": _codes(),
    "op13_importance_resampling": RESAMPLED,
}
