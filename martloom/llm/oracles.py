"""SQL for DuckDB that gives the rows of the registered queries, where SQL can express them."""

OP6 = """
    WITH v AS (
        SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS x
        FROM embeddings
        WHERE vec_id IS NOT NULL AND len(embedding) > 0
          AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)),
    s AS (
        SELECT q.vec_id AS query_id, c.vec_id,
               CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x)
        WHERE q.vec_id % 50 = 0),
    r AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)
                       AS INTEGER) AS rank
        FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""


def _apportioned(rows: str, within: str, weight: str, seats: str, keys: str) -> str:
    """Sainte-Laguë quotas: ``keys`` and ``quota`` of the rows of a table."""
    part = f"PARTITION BY {within}" if within else ""
    return f"""(
        WITH a AS (
            SELECT *, CAST({weight} AS DOUBLE) AS w_, {seats} AS s_,
                   CASE WHEN {weight} > 0
                        THEN CAST({weight} AS DOUBLE) / sum(CAST({weight} AS DOUBLE)) OVER ({part})
                        ELSE 0.0 END AS p_,
                   count(*) OVER ({part}) AS n_
            FROM {rows}),
        b AS (
            SELECT *, CAST(greatest(0, floor(s_ * p_ - (n_ * p_ / 2 + 1.5))) AS BIGINT) AS low_,
                   CAST(ceil(s_ * p_ + (n_ * p_ / 2 + 1.5)) AS BIGINT) AS high_
            FROM a),
        c AS (SELECT *, s_ - sum(low_) OVER ({part}) AS open_ FROM b),
        d AS (SELECT *, unnest(range(low_, high_ + 1)) AS k_ FROM c),
        e AS (
            SELECT *, row_number() OVER ({part} ORDER BY w_ / (2 * k_ + 1) DESC, {keys}, k_) <= open_
                      AND w_ > 0 AS won_
            FROM d)
        SELECT {keys}, CAST(min(low_) + sum(CAST(won_ AS INTEGER)) AS BIGINT) AS quota
        FROM e GROUP BY {keys})"""


OP8 = rf"""
    WITH sizes AS (
        SELECT doc_id, source IS NULL AS no_source, coalesce(source, '') AS source,
               CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT)
                   AS size,
               md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':'
                   || md5(coalesce(text, ''))) AS draw
        FROM documents),
    totals AS (
        SELECT no_source, source, CAST(sum(size) AS BIGINT) AS source_size
        FROM sizes GROUP BY ALL),
    ranked AS (
        SELECT *, 2 * source_size AS ceiling,
               [3, 1, 2][(row_number() OVER (ORDER BY no_source, source) - 1) % 3 + 1] AS weight
        FROM totals),
    levels AS (
        SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM totals)
                   - (sum(ceiling) OVER up_to - ceiling))
               / ((SELECT sum(weight) FROM ranked) - (sum(weight) OVER up_to - weight)) AS level
        FROM ranked
        WINDOW up_to AS (ORDER BY ceiling / weight, no_source, source ROWS UNBOUNDED PRECEDING)),
    targets AS (
        SELECT *, CASE WHEN level * weight >= ceiling THEN CAST(ceiling AS DOUBLE)
                       ELSE (SELECT max(level) FROM levels WHERE level * weight < ceiling) * weight
                  END AS target
        FROM levels),
    seated AS (SELECT *, CAST(round(sum(target) OVER () / 64) AS BIGINT) AS seats FROM targets),
    sources AS (
        SELECT no_source, source, source_size, target, passes,
               CASE WHEN passes >= 2 THEN 0
                    ELSE greatest(0, quota - CAST(round(passes * source_size / 64) AS BIGINT))
               END AS rest,
               CAST(greatest(1, ceil(source_size / 131072)) AS BIGINT) AS shards
        FROM (SELECT t.*, quota,
                     CAST(coalesce(floor(target / nullif(source_size, 0)), 0) AS BIGINT) AS passes
              FROM targets t
              JOIN {_apportioned("seated", "", "target", "seats", "no_source, source")} q
              USING (no_source, source))),
    dealt AS (
        SELECT s.*, source_size, target, passes, rest,
               CAST('0x' || substr(draw, 1, 8) AS BIGINT) % shards AS number
        FROM sizes s JOIN sources USING (no_source, source)),
    summed AS (
        SELECT no_source, source, number, rest, CAST(sum(size) AS BIGINT) AS length
        FROM dealt GROUP BY ALL),
    quotas AS (
        SELECT *, CAST('0x' || substr(md5('mix:' || source || ':' || number), 1, 8) AS BIGINT)
                  % greatest(blocks, 1) AS start
        FROM (SELECT no_source, source, number, greatest(blocks, 1) AS of_, blocks,
                     least(quota, blocks) AS quota
              FROM (SELECT *, CAST(ceil(length / 64) AS BIGINT) AS blocks FROM summed)
              JOIN {_apportioned("summed", "no_source, source", "length", "rest",
                                 "no_source, source, number")} q
              USING (no_source, source, number))),
    laid AS (
        SELECT *, sum(size) OVER (PARTITION BY no_source, source, number
                                  ORDER BY draw, doc_id, size ROWS UNBOUNDED PRECEDING) AS stop
        FROM dealt JOIN quotas USING (no_source, source, number)),
    places AS (
        SELECT *, stop // 64 AS b1, stop % 64 AS i1, (stop - size) // 64 AS b0,
               (stop - size) % 64 AS i0
        FROM laid),
    counted AS (
        SELECT *, (b1 * quota + start) // of_ AS c1, ((b1 + 1) * quota + start) // of_ AS d1,
               (b0 * quota + start) // of_ AS c0, ((b0 + 1) * quota + start) // of_ AS d0
        FROM places)
    SELECT doc_id, size, source_size, target,
           CAST(passes * size + (c1 - c0) * 64 + i1 * (d1 - c1) - i0 * (d0 - c0) AS BIGINT) AS taken
    FROM counted"""

# Fixed value: the base32 alphabet.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

OP10 = f"""
    WITH p AS (
        SELECT page_id, coalesce(html, '') AS payload,
               CAST(unhex(sha1(coalesce(html, ''))) AS BIT)::VARCHAR AS bits
        FROM pages),
    f AS (
        SELECT *, row_number() OVER same AS place, first_value(page_id) OVER same AS first
        FROM p WINDOW same AS (PARTITION BY payload ORDER BY page_id NULLS LAST))
    SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes,
           array_to_string([substr('{BASE32}', 1 + CAST(
               16 * CAST(substr(bits, 5 * i + 1, 1) AS INT)
               + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INT)
               + 4 * CAST(substr(bits, 5 * i + 3, 1) AS INT)
               + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INT)
               + CAST(substr(bits, 5 * i + 5, 1) AS INT) AS BIGINT), 1)
               FOR i IN range(32)], '') AS payload_digest,
           CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN place > 1 THEN first END AS refers_to
    FROM f"""


OP12 = r"""
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
        FROM documents),
    s AS (
        SELECT doc_id, list_distinct([array_to_string(words[i : i + 4], ' ')
                       FOR i IN range(1, greatest(1, len(words) - 4) + 1)]) AS shingles,
               len(words) AS n_words
        FROM w),
    d AS (
        SELECT doc_id, CASE WHEN n_words > 0 THEN shingles ELSE [] END AS shingles FROM s),
    t AS (SELECT doc_id, len(shingles) AS n, shingle
          FROM (SELECT doc_id, shingles, unnest(shingles) AS shingle FROM d)),
    p AS (
        SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS n_a, any_value(b.n) AS n_b,
               count(*) AS n_both
        FROM t a JOIN t b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
             AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
        GROUP BY 1, 2),
    l AS (SELECT a, b FROM p WHERE 100 * n_both >= 80 * (n_a + n_b - n_both)),
    e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    r AS (SELECT doc_id, doc_id AS reached FROM d
          UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.reached)
    SELECT r.doc_id, CAST(any_value(len(d.shingles)) AS BIGINT) AS n_shingles,
           min(reached) AS component_id
    FROM r JOIN d USING (doc_id) GROUP BY r.doc_id"""


def _part_codes() -> str:
    """Codebooks of 4 parts after 4 rounds of k-means, and the codes; unrolled round by round."""
    steps = [
        """v AS (
        SELECT vec_id, label, floor_ AS x
        FROM (SELECT vec_id, label, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS floor_
              FROM embeddings
              WHERE len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding))),
    p AS (
        SELECT vec_id, label, part,
               x[part * len(x) // 4 + 1 : (part + 1) * len(x) // 4] AS x
        FROM v, (SELECT unnest(range(4)) AS part)),
    s AS (SELECT *, list_inner_product(x, x) AS own FROM p),
    b0 AS (
        SELECT part, entry, x, own
        FROM (SELECT *, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry FROM s)
        WHERE entry < 256)"""
    ]
    for at in range(5):
        steps.append(
            f"""a{at} AS MATERIALIZED (
        SELECT vec_id, part,
               min({{'d': s.own - 2 * list_inner_product(s.x, b.x) + b.own, 'e': entry}}) AS best
        FROM s JOIN b{at} b USING (part) GROUP BY vec_id, part)"""
        )
        if at < 4:
            steps.append(
                f"""m{at} AS (
        SELECT part, best.e AS entry, i, floor(sum(x[i]) / count(*)) AS mean
        FROM (SELECT a.part, best, x, unnest(range(1, len(x) + 1)) AS i
              FROM a{at} a JOIN s ON a.vec_id = s.vec_id AND a.part = s.part)
        GROUP BY part, best.e, i),
    n{at} AS (SELECT part, entry, list(mean ORDER BY i) AS x FROM m{at} GROUP BY part, entry),
    b{at + 1} AS MATERIALIZED (
        SELECT part, entry, x, list_inner_product(x, x) AS own
        FROM (SELECT b.part, b.entry, coalesce(n.x, b.x) AS x
              FROM b{at} b LEFT JOIN n{at} n ON b.part = n.part AND b.entry = n.entry))"""
            )
    return f"""
    WITH {", ".join(steps)},
    c AS (
        SELECT vec_id, string_agg(printf('%02x', CAST(best.e AS INTEGER)), '' ORDER BY part) AS code,
               CAST(sum(best.d) AS BIGINT) AS error
        FROM a4 GROUP BY vec_id),
    h AS (
        SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, i))
                   AS codebooks_sha256
        FROM (SELECT part, entry, unnest(x) AS x, unnest(range(len(x))) AS i FROM b4))
    SELECT vec_id, code, error,
           CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM c JOIN v USING (vec_id), h"""


OP13 = _part_codes()
