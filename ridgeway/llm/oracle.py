"""SQL for the queries that SQL can express."""

from __future__ import annotations

# RFC 4648 base32 of a hex SHA-1: its 160 bits are cut into 32 groups of five.
WARC = """
WITH paged AS (
    SELECT page_id, coalesce(html, '') AS payload FROM pages
), hashed AS (
    SELECT page_id, payload, strlen(payload) AS n, sha1(payload) AS hex,
           max(page_id) OVER (PARTITION BY payload) AS stored
    FROM paged
), bits AS (
    SELECT *, list_aggregate(list_transform(range(40), lambda i:
        lpad(bin(strpos('0123456789abcdef', substr(hex, CAST(i + 1 AS INTEGER), 1)) - 1), 4, '0')
    ), 'string_agg', '') AS b
    FROM hashed
)
SELECT page_id, n AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + list_sum(list_transform(range(5), lambda j:
               CAST(substr(b, CAST(i * 5 + j + 1 AS INTEGER), 1) AS INTEGER) * CAST(pow(2, 4 - j) AS INTEGER)
           )) AS INTEGER), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = stored THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = stored THEN NULL ELSE stored END AS refers_to
FROM bits
"""

CONTENT_SORT = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


IMPACT_TOPK = """
WITH scaled AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM scaled q, scaled c
    WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
    SELECT query_id, vec_id, score,
           row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
    FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

LEXICAL = """
WITH counted AS (
    SELECT row_number() OVER () AS place, doc_id, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
    FROM documents
), docs AS (
    SELECT place, doc_id, terms, len(terms) AS n FROM counted WHERE len(terms) > 0
), size AS (
    SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM docs
), tf AS (
    SELECT place, doc_id, n, term, count(*) AS tf
    FROM (SELECT place, doc_id, n, unnest(terms) AS term FROM docs) GROUP BY ALL
), df AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM tf, size GROUP BY term, docs
), asked AS (
    SELECT place AS item, item_id, unnest(list_distinct(regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))) AS term
    FROM (SELECT *, row_number() OVER () AS place FROM benchmark)
), scored AS (
    SELECT item, item_id, place, doc_id, CAST(sum(w * ((1000000000 * tf)
               // (1000 * tf + 20 * (50 + (50 * n * docs) // length)))) AS BIGINT) AS score
    FROM asked JOIN tf USING (term) JOIN df USING (term), size
    GROUP BY item, item_id, place, doc_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS FIRST) AS rank
    FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""

COLLOCATIONS = """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(string_split_regex(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS w
    FROM documents
), starts AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces
), counted AS (
    SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, k, count(*) AS f
    FROM starts, (SELECT unnest(range(1, 6)) AS k)
    WHERE i + k - 1 <= len(w)
    GROUP BY ALL
), totals AS (
    SELECT lang, sum(f) AS n FROM counted WHERE k = 1 GROUP BY lang
), frequent AS (
    SELECT *, string_split(phrase, ' ') AS p FROM counted WHERE f >= 100
), kept AS (
    SELECT * FROM frequent c
    WHERE k >= 2 AND NOT EXISTS (
        SELECT 1 FROM frequent d
        WHERE d.lang = c.lang AND d.k > c.k AND 100 * d.f >= 100 * c.f
          AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' '))
), cuts AS (
    SELECT kept.lang, kept.phrase, kept.f AS a, j, l.f AS l, r.f AS r, n,
           (1000 * kept.f::HUGEINT * n::HUGEINT) // (l.f::HUGEINT * r.f::HUGEINT) AS score
    FROM kept CROSS JOIN (SELECT unnest(range(1, 5)) AS j) JOIN totals USING (lang)
    JOIN frequent l ON l.lang = kept.lang AND l.phrase = array_to_string(kept.p[1:j], ' ')
    JOIN frequent r ON r.lang = kept.lang AND r.phrase = array_to_string(kept.p[j + 1:], ' ')
    WHERE j < kept.k
), least AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM least
)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""

# Greedy filling is a reduction over the row of group ends; the binary search, the cuts
# from the right and those from the left are recursions.
SHARDING = """
WITH RECURSIVE docs AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256(coalesce(text, '')) AS digest,
           strlen(coalesce(text, '')) + 1 AS size
    FROM documents
), crc_table AS (
    -- remainders of all bytes by the reflected polynomial of CRC-32
    SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, i:
               xor(c >> 1, (c & 1) * 3988292384)) ORDER BY b) AS t
    FROM (SELECT CAST(range AS BIGINT) AS b FROM range(256))
), summed AS (
    SELECT doc_id, digest, size, xor(list_reduce(
               list_prepend(CAST(4294967295 AS BIGINT), list_transform(
                   regexp_extract_all(hex(encode(text)), '..'), lambda h: CAST('0x' || h AS BIGINT))),
               lambda c, b: xor(c >> 8, t[CAST((xor(c, b) & 255) + 1 AS INTEGER)])), 4294967295) AS text_crc32
    FROM docs, crc_table
), groups AS (
    SELECT digest, CAST(sum(size) AS BIGINT) AS bytes,
           row_number() OVER (ORDER BY sum(size) DESC, digest) AS place
    FROM docs GROUP BY digest
), alone(n, total, stop) AS (
    SELECT 0, (SELECT CAST(sum(bytes) AS BIGINT) FROM groups), FALSE
    UNION ALL
    SELECT n + (bytes * (16 - n) > total)::INT, total - CASE WHEN bytes * (16 - n) > total THEN bytes ELSE 0 END,
           bytes * (16 - n) <= total
    FROM alone JOIN groups ON place = n + 1 WHERE NOT stop
), apart AS (
    SELECT max(n) AS n FROM alone
), rest AS (
    SELECT digest, CAST(sum(bytes) OVER (ORDER BY digest) AS BIGINT) AS upto, bytes
    FROM groups WHERE place > (SELECT n FROM apart)
), row_of AS (
    SELECT list_prepend(CAST(0 AS BIGINT), list(upto ORDER BY upto)) AS ends, CAST(sum(bytes) AS BIGINT) AS total,
           16 - (SELECT n FROM apart) AS k
    FROM rest
), search(low, high) AS (
    SELECT CAST(0 AS BIGINT), total FROM row_of
    UNION ALL
    SELECT CASE WHEN fits THEN low ELSE middle END, CASE WHEN fits THEN middle ELSE high END
    FROM (
        SELECT low, high, (low + high) // 2 AS middle,
               list_reduce(list_prepend(CAST(0 AS BIGINT), range(k)), lambda pos, i:
                   list_max(list_filter(ends, lambda e: e <= pos + (low + high) // 2))) = total AS fits
        FROM search, row_of WHERE high - low > 1
    )
), capacity AS (
    SELECT min(high) AS c FROM search
), back(j, least) AS (
    SELECT CAST(k AS BIGINT), total FROM row_of
    UNION ALL
    SELECT j - 1, list_min(list_filter(ends, lambda e: e >= least - c))
    FROM back, row_of, capacity WHERE j > 1
), cuts(j, pos) AS (
    SELECT CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM row_of
    UNION ALL
    SELECT j + 1, CASE WHEN wanted - pos > c THEN list_max(list_filter(ends, lambda e: e <= pos + c)) ELSE wanted END
    FROM (
        SELECT j, pos, c, ends, greatest(least, CASE WHEN share - below <= above - share THEN below ELSE above END) AS wanted
        FROM (
            SELECT cuts.j, cuts.pos, c, ends, least, share,
                   list_max(list_filter(ends, lambda e: e <= share)) AS below,
                   list_min(list_filter(ends, lambda e: e >= share)) AS above
            FROM (SELECT cuts.j, cuts.pos, pos + (total - pos + k - j - 1) // (k - j) AS share FROM cuts, row_of) cuts
            JOIN back ON back.j = cuts.j + 1, row_of, capacity
            WHERE cuts.j + 1 < k
        )
    )
), dealt AS (
    SELECT g.digest, CASE WHEN g.place <= n THEN g.place - 1
               ELSE n + (SELECT count(*) FROM cuts WHERE j > 0 AND pos < rest.upto) END AS shard
    FROM groups g CROSS JOIN apart LEFT JOIN rest USING (digest)
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM summed JOIN dealt USING (digest)
"""


def statements() -> dict[str, str]:
    return {
        "op4_warc_chunks": WARC,
        "op6_content_sort": CONTENT_SORT,
        "op10_impact_topk": IMPACT_TOPK,
        "op11_k2_treap": LEXICAL,
        "op12_collocations": COLLOCATIONS,
        "op13_sharding": SHARDING,
    }
