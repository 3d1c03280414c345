"""DuckDB twins of the queries SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP2 = f"""
WITH docs AS (SELECT doc_id, {_WORDS.format(_LOWER.format("text"))} AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS.format(_LOWER.format("text"))} AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
         array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS i
        FROM docs, sizes WHERE len(w) >= n)),
found AS (SELECT d.doc_id, d.n, d.i, x.item_id FROM doc_windows d JOIN item_windows x ON d.n = x.n AND d.win = x.win),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
which AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit USING (doc_id) LEFT JOIN which USING (doc_id)
"""

OP9 = f"""
WITH d AS (SELECT doc_id, {_LOWER.format("text")} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""


def _u(name: str) -> str:
    """A number in (0, 1) from the MD5 of id and child (``name``: SQL)."""
    return f"((CAST('0x' || substr(md5(k || '/' || {name}), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0)"


def _first(*draws: tuple[str, int]) -> str:
    """0-based position of the smallest draw of (name, weight)."""
    costs = "[" + ", ".join(f"-ln({_u(name)}) / {weight}" for name, weight in draws) + "]"
    return f"CAST(list_position({costs}, list_min({costs})) - 1 AS INTEGER)"


def _below(region: int) -> str:
    """The shard of a document inside a region: rack, then shard."""
    racks = [_first(*[(f"'shard{(region * 2 + rack) * 4 + s}'", 1) for s in range(4)]) for rack in (0, 1)]
    rack = _first(*[(f"'rack{region}.{r}'", 4) for r in (0, 1)])
    return f"CASE {rack} WHEN 0 THEN {region * 8} + {racks[0]} ELSE {region * 8 + 4} + {racks[1]} END"


# CRC-32 byte by byte; its table comes from the reversed polynomial 0xEDB88320
_CRC_TABLE = """crc_table AS (
  SELECT list(list_reduce(list_prepend(i::BIGINT, range(8)),
                          lambda c, n: CASE WHEN c % 2 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END)
              ORDER BY i) AS t FROM range(256) r(i))"""

OP10 = f"""
WITH {_CRC_TABLE},
d AS (SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), 'null') AS k, hex(encode(coalesce(text, ''))) AS h FROM documents),
bytes AS (SELECT doc_id, k, length(h) // 2 + 1 AS size,
                 list_transform(range(0, length(h) // 2),
                                lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT)) AS b FROM d),
summed AS (SELECT doc_id, k, CAST(size AS BIGINT) AS size,
                  xor(list_reduce(list_prepend(4294967295::BIGINT, b),
                                  lambda c, x: xor(c >> 8, t[CAST(xor(c, x) & 255 AS BIGINT) + 1])),
                      4294967295::BIGINT) AS text_crc32
           FROM bytes, crc_table),
drawn AS (SELECT *, {_first(("'region0'", 8), ("'region1'", 8))} AS r,
                 {_first(("'region0'", 8), ("'region1'", 8), ("'added16'", 1))} AS g,
                 {_below(0)} AS in0, {_below(1)} AS in1, substr(md5(k || '/slot'), 1, 2) AS part FROM summed),
placed AS (SELECT *, CASE r WHEN 0 THEN in0 ELSE in1 END AS shard,
                  CASE g WHEN 0 THEN in0 WHEN 1 THEN in1 ELSE 16 END AS grown_shard FROM drawn)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY part, doc_id, text_crc32) - 1 AS slot,
       CAST(grown_shard AS INTEGER) AS grown_shard
FROM placed
"""

OP11 = f"""
WITH {_CRC_TABLE},
docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(_LOWER.format("text"))} AS w FROM documents),
wanted AS (SELECT {_WORDS.format(_LOWER.format("text"))} AS w FROM benchmark),
spelt AS (SELECT f, hex(encode(f)) AS h FROM (SELECT unnest(w) AS f FROM docs UNION SELECT unnest(w) FROM wanted)),
bytes AS (SELECT f, list_transform(range(0, length(h) // 2),
                                   lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT)) AS b
          FROM spelt),
bucket AS (SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, b),
                                     lambda c, x: xor(c >> 8, t[CAST(xor(c, x) & 255 AS BIGINT) + 1])),
                         4294967295::BIGINT) % 10000 AS g FROM bytes, crc_table),
own AS (SELECT r, g FROM (SELECT r, unnest(w) AS f FROM docs) JOIN bucket USING (f)),
counts AS (SELECT g, sum(s)::DOUBLE AS s, sum(t)::DOUBLE AS t
           FROM (SELECT g, 1 AS s, 0 AS t FROM own
                 UNION ALL SELECT g, 0, 1 FROM (SELECT unnest(w) AS f FROM wanted) JOIN bucket USING (f)) GROUP BY g),
sums AS (SELECT coalesce(sum(s), 0)::DOUBLE + 10000 AS a, coalesce(sum(t), 0)::DOUBLE + 10000 AS b FROM counts),
gain AS (SELECT g, CAST(floor(1000 * ln((t + 1) * a / ((s + 1) * b))) AS BIGINT) AS gain FROM counts, sums),
weights AS (SELECT r, CAST(sum(gain) AS BIGINT) AS weight FROM own JOIN gain USING (g) GROUP BY r),
scored AS (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
                  coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256(
                      '2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE)
                      / 4294967296::DOUBLE))) AS BIGINT) AS score
           FROM docs LEFT JOIN weights USING (r)),
placed AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
           FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN placed USING (r)
"""

OP12 = f"""
WITH RECURSIVE
d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))))
        END AS sh FROM d),
sets AS (SELECT row_number() OVER () AS r, sh, len(sh) AS n, min(doc_id) AS first_id FROM s WHERE len(sh) > 0 GROUP BY sh),
tokens AS (SELECT r, n, unnest(sh) AS f FROM sets),
pairs AS (SELECT a.r AS x, b.r AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS i
          FROM tokens a JOIN tokens b ON a.f = b.f AND a.r < b.r GROUP BY a.r, b.r),
links AS (SELECT x, y FROM pairs WHERE 100 * i >= 85 * (nx + ny - i)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT r AS x, r AS y FROM sets UNION SELECT reach.x, l.y FROM reach JOIN both_ways l ON reach.y = l.x),
least AS (SELECT reach.x AS r, min(first_id) AS component_id FROM reach JOIN sets ON reach.y = sets.r GROUP BY reach.x)
SELECT doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles,
       CASE WHEN len(s.sh) = 0 THEN doc_id ELSE component_id END AS component_id,
       doc_id IS NOT DISTINCT FROM CASE WHEN len(s.sh) = 0 THEN doc_id ELSE component_id END AS kept
FROM s LEFT JOIN sets ON s.sh = sets.sh LEFT JOIN least USING (r)
"""

OP13 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
             max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
b AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
             CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
             + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
             + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 4 ELSE 0 END
             + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
             + CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS fails
      FROM d LEFT JOIN l USING (doc_id)),
masks AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM b GROUP BY part, fails),
f AS (SELECT chr(CAST(65 + i AS INTEGER)) AS name, CAST(1 << i AS INTEGER) AS bit FROM range(5) r(i)),
orders AS (SELECT [a.name, b.name, c.name, d.name, e.name] AS names, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
           FROM f a JOIN f b ON b.bit <> a.bit JOIN f c ON c.bit NOT IN (a.bit, b.bit)
           JOIN f d ON d.bit NOT IN (a.bit, b.bit, c.bit) JOIN f e ON e.bit NOT IN (a.bit, b.bit, c.bit, d.bit)),
steps AS (SELECT array_to_string(names, '') AS filter_order, CAST(k AS INTEGER) AS step, bits[k] AS bit,
                 coalesce(list_sum(bits[1:k - 1]), 0)::INTEGER AS before
          FROM (SELECT *, unnest(range(1, 6)) AS k FROM orders)),
counted AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN fails & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN fails & before = 0 AND fails & bit > 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN fails & before > 0 AND fails & bit > 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN fails & before = 0 AND fails & bit > 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN fails & before = 0 AND fails & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM masks, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted
"""

ORACLES = {
    "op2_benchmark_decontamination": OP2,
    "op9_exact_dedup": OP9,
    "op10_sharding": OP10,
    "op11_importance_resampling": OP11,
    "op12_minhash_near_dedup": OP12,
    "op13_filter_audit": OP13,
}
