"""DuckDB twins of the registered queries that SQL can express."""

from __future__ import annotations

SQL: dict[str, str] = {}

_AT = "CAST('0x' || substr(md5({0}), 1, 13) AS BIGINT) / 4503599627370496.0"

#: CRC-32 by half bytes: 16 values of the reflected polynomial 0xEDB88320
_CRC = """
crc_table AS (
  SELECT list(v ORDER BY k) AS t FROM (
    SELECT k, list_reduce(range(4), lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, k) AS v
    FROM range(16) r(k))),
texts AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
hexed AS (
  SELECT doc_id, source, text, strlen(text) + 16 AS size, string_split(lower(hex(encode(text))), '') AS h FROM texts),
crcs AS (
  SELECT doc_id, source, size, CASE WHEN text = '' THEN 0 ELSE xor(list_reduce(
    list_transform(range(len(h)), lambda i: CAST('0x' || h[CASE WHEN i % 2 = 0 THEN i + 2 ELSE i END] AS BIGINT)),
    lambda a, x: xor(a >> 4, t[(xor(a, x) & 15) + 1]), 4294967295), 4294967295) END AS crc
  FROM hexed, crc_table)"""

SQL["op5_interleaved_shards"] = f"""
WITH {_CRC},
placed AS (
  SELECT *, CASE WHEN source IS NULL THEN '-' ELSE '+' || source END AS sk,
         {_AT.format("'shards-1|' || coalesce(doc_id::VARCHAR, '~') || '|' || crc || '|' || size")} AS pos FROM crcs),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY sk ORDER BY pos, doc_id NULLS FIRST, crc, size) - 1 AS place,
         count(*) OVER (PARTITION BY sk) AS n FROM placed),
whole AS (
  SELECT *, row_number() OVER (ORDER BY (place + 0.5::DOUBLE) / n, sk, place) - 1 AS p, count(*) OVER () AS total FROM ranked)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'rows' AS law, (p * 40 // total)::INT AS shard,
       p - CAST(ceil((p * 40 // total) * total / 40.0) AS BIGINT) AS slot, NULL::INT AS grown_shard
FROM whole"""

SQL["op6_quality_rules"] = r"""
WITH base AS (
  SELECT row_number() OVER () AS rid, doc_id, CASE WHEN source IS NULL THEN '-' ELSE '+' || source END AS host,
         coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
wins AS (
  SELECT rid, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] || ' ' || w[i+4] AS k
  FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM base)),
twice AS (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt
          FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM wins) WHERE c > 1),
covered AS (SELECT rid, sum(least(5, coalesce(nxt - i, 5))) AS n_repeat_words FROM twice GROUP BY rid),
judged AS (
  SELECT doc_id, host, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
           - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM base LEFT JOIN covered USING (rid)),
failed AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM judged),
hosts AS (SELECT host, count(*) AS n, sum(base_failed::INT) AS f FROM failed GROUP BY host),
whole AS (SELECT sum(n)::DOUBLE AS n, sum(f)::DOUBLE AS f, count(*)::DOUBLE AS h, sum(f * f / n::DOUBLE) AS q FROM hosts),
spread AS (SELECT f / n AS m, (q - f * f / n - (h - 1) * (f / n) * (1 - f / n)) / greatest(n - h, 1) AS v FROM whole),
prior AS (SELECT m, CASE WHEN v > 0 THEN least(greatest(m * (1 - m) / v - 1, 1.0), 10000.0) ELSE 10000.0 END AS s FROM spread),
verdict AS (SELECT host, (f + m * s) / (n + s) > 0.5 AS rejected FROM hosts, prior)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT (base_failed OR rejected) AS kept
FROM failed JOIN verdict USING (host)"""


SQL["op9_source_mix"] = rf"""
WITH sized AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '-' ELSE '+' || source END AS sk,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
placed AS (SELECT *, {_AT.format("'mix-1|' || coalesce(doc_id::VARCHAR, '~') || '|' || size")} AS pos FROM sized),
laid AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY sk ORDER BY pos, doc_id NULLS FIRST, size
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM placed),
sources AS (
  SELECT sk, sum(size) AS source_size, 3.0::DOUBLE * sum(size) AS cap,
         [5.0::DOUBLE, 2.0, 1.0][(row_number() OVER (ORDER BY sk = '-', sk) - 1) % 3 + 1] AS weight FROM laid GROUP BY sk),
filling AS (
  SELECT *, coalesce(sum(cap) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled,
         sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open,
         sum(source_size) OVER () AS total FROM sources WINDOW f AS (ORDER BY cap / weight, sk)),
targets AS (SELECT sk, source_size, total, least(cap, max((total - filled) / open) OVER () * weight) AS target FROM filling)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target,
       coalesce(list_sum(list_transform(range(3), lambda e: least(size, greatest(0,
         least(floor(target + 0.5) - e * source_size, source_size) - before)))), 0)::BIGINT AS taken
FROM laid JOIN targets USING (sk)"""

SQL["op4_topk_inner_product"] = """
WITH own AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda v: CAST(floor(64 * v::DOUBLE) AS BIGINT)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v))) = len(embedding)),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i]))::BIGINT AS score
  FROM own a JOIN own b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 20 = 0),
ranked AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM scored)
SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 20"""

SQL["op7_jaccard_components"] = r"""
WITH RECURSIVE worded AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT rid, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3]))) END AS s
  FROM worded),
classes AS (SELECT s, len(s) AS n, min(rid) AS c FROM sets WHERE len(s) > 0 GROUP BY s),
grams AS (SELECT c, n, unnest(s) AS g FROM classes),
shared AS (
  SELECT a.c AS a, b.c AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k
  FROM grams a JOIN grams b ON a.g = b.g AND a.c < b.c AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n) GROUP BY 1, 2),
links AS (SELECT a, b FROM shared WHERE 185 * k >= 85 * (na + nb)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT c AS a, c AS b FROM classes UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
groups AS (SELECT a AS c, min(b) AS grp FROM reach GROUP BY a),
placed AS (SELECT doc_id, len(x.s) AS n, grp FROM sets x LEFT JOIN classes k ON x.s = k.s AND len(x.s) > 0 LEFT JOIN groups USING (c)),
least_id AS (SELECT grp, min(doc_id) AS id FROM placed WHERE n > 0 GROUP BY grp)
SELECT doc_id, n::BIGINT AS n_shingles, CASE WHEN n > 0 THEN id ELSE doc_id END AS component_id
FROM placed LEFT JOIN least_id USING (grp)"""

#: fixed values: the spellings that count as equal, as in ``licences.SPELLINGS``
_SPELLINGS = (
    (r"\blicenc(e|es|ed|ing|or|ors)\b", r"licens\1"), (r"isation(s?)\b", r"ization\1"), (r"\bfavour", "favor"),
    (r"\bhonour", "honor"), (r"\bbehaviour", "behavior"), (r"\backnowledgement", "acknowledgment"),
    (r"\bjudgement", "judgment"), (r"\bfulfil ", "fulfill "), (r"\bwhilst\b", "while"), (r"\bsub license", "sublicense"),
    (r"\bnon commercial", "noncommercial"), (r"\bper cent\b", "percent"), (r"\bcopyright holder", "copyright owner"))


def _canonical_sql(text: str) -> str:
    # without look-ahead: a copyright line is dropped when it holds a year or a sign
    out = (f"array_to_string(list_filter(string_split(lower({text}), chr(10)), lambda l: NOT regexp_matches(l, "
           r"'^[^\p{L}\p{N}©]*(copyright\b.*(©|\(c\)|[0-9]{4}|<|\[)|©|\(c\)|all rights reserved)')), chr(10))")
    out = f"regexp_replace({out}, 'https?://', ' ', 'g')"
    out = rf"trim(regexp_replace({out}, '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
    for pattern, replacement in _SPELLINGS:
        out = f"regexp_replace({out}, '{pattern}', '{replacement}', 'g')"
    return out


def _licence_sql() -> str:
    from veritab.llm.licence_texts import KNOWN_LICENCES

    rows = ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in KNOWN_LICENCES)
    return f"""
WITH known AS (
  SELECT sha256(form) AS digest, min(id) AS licence_id
  FROM (SELECT id, {_canonical_sql('text')} AS form FROM (VALUES {rows}) v(id, text)) WHERE form <> '' GROUP BY 1),
docs AS (SELECT doc_id, {_canonical_sql('text')} AS form FROM documents),
digests AS (SELECT doc_id, CASE WHEN form <> '' THEN sha256(form) END AS digest FROM docs)
SELECT doc_id, d.digest, licence_id, licence_id IS NOT NULL AS is_licence FROM digests d LEFT JOIN known k ON d.digest = k.digest"""


SQL["op3_licence_lookup"] = _licence_sql()


SQL["op11_fill_in_middle"] = r"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w FROM documents),
drawn AS (
  SELECT *, len(w) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(w) + 1) AS x, CAST('0x' || h[9:16] AS BIGINT) % (len(w) + 1) AS y,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 50 THEN 'plain'
              WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM split),
parts AS (
  SELECT *, array_to_string(w[1:least(x, y)], '') AS p, array_to_string(w[least(x, y) + 1:greatest(x, y)], '') AS m,
         array_to_string(w[greatest(x, y) + 1:], '') AS s FROM drawn)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM parts"""


SQL["op12_phrase_collocations"] = r"""
WITH pieces AS MATERIALIZED (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^.,;:!?\x0A-\x0D]+')) AS piece FROM documents)),
starts AS MATERIALIZED (
  SELECT lang, unnest(list_transform(range(1, len(w) + 1), lambda i: w[i:i + 3])) AS w FROM pieces),
counts AS MATERIALIZED (
  SELECT lang, phrase, m, count(*)::HUGEINT AS f FROM (
    SELECT lang, w[1] AS phrase, 1 AS m FROM starts
    UNION ALL SELECT lang, array_to_string(w[1:2], ' '), 2 FROM starts WHERE len(w) >= 2
    UNION ALL SELECT lang, array_to_string(w[1:3], ' '), 3 FROM starts WHERE len(w) >= 3
    UNION ALL SELECT lang, array_to_string(w, ' '), 4 FROM starts WHERE len(w) = 4)
  GROUP BY lang, phrase, m),
totals AS (SELECT lang, sum(f) AS n FROM counts WHERE m = 1 GROUP BY lang),
candidates AS MATERIALIZED (SELECT lang, phrase, string_split(phrase, ' ') AS w, m, f AS a FROM counts WHERE m > 1 AND f >= 30),
cut AS (
  SELECT c.*, unnest(range(1, m)) AS k FROM candidates c),
asked AS (SELECT *, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail FROM cut),
scored AS (
  SELECT q.lang, q.phrase, q.a, q.k, x.f AS l, y.f AS r, (2000000 * q.a) // (x.f + y.f) AS score FROM asked q
  JOIN counts x ON x.lang = q.lang AND x.phrase = q.head JOIN counts y ON y.lang = q.lang AND y.phrase = q.tail),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
held AS (
  SELECT lang, a, unnest(CASE WHEN m = 3 THEN [w[1:2], w[2:3]] ELSE [w[1:2], w[2:3], w[3:4], w[1:3], w[2:4]] END) AS p
  FROM candidates WHERE m > 2),
most AS (SELECT lang, array_to_string(p, ' ') AS phrase, max(a) AS most FROM held GROUP BY ALL),
kept AS (
  SELECT o.* FROM lowest o LEFT JOIN most p ON p.lang = o.lang AND p.phrase = o.phrase
  WHERE p.most IS NULL OR 100 * p.most < 80 * o.a)
SELECT k.lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept) k
JOIN totals t ON t.lang = k.lang WHERE rank <= 2000"""
