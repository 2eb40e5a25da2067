"""DuckDB SQL for the queries that SQL can express."""

from platelake.llm import quality, urls

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
PLAIN = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
         r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

_ALONE = ", ".join(f"({1 << i}, '{rule}')" for i, rule in enumerate(quality.RULES))

QUALITY = rf"""
WITH w AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t, {WORDS} AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), g AS (
  SELECT r, p, array_to_string(list_slice(words, p, p + 4), ' ') AS gram
  FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS p FROM w)
), again AS (
  SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, gram) AS n FROM g) WHERE n > 1
), cover AS (
  SELECT r, count(*) AS n FROM (SELECT DISTINCT r, unnest(range(p, p + 5)) AS q FROM again) GROUP BY r
), m AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(cover.n, 0) AS BIGINT) AS n_repeat_words,
         len(lines) AS n_lines, len(regexp_extract_all(t, '[A-Z]')) AS n_upper,
         len(regexp_extract_all(t, '!')) AS n_marks
  FROM w LEFT JOIN cover USING (r)
), f AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         CAST(CASE WHEN n_words < 10 THEN 1 ELSE 0 END
              + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
              + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
              + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
              + CASE WHEN word_chars < 2 * n_words OR word_chars > 20 * n_words THEN 16 ELSE 0 END
              + CASE WHEN 2 * n_upper > word_chars THEN 32 ELSE 0 END
              + CASE WHEN 2 * n_marks > n_words THEN 64 ELSE 0 END AS BIGINT) AS fail_bits
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       fail_bits = 0 AS kept, fail_bits, only_rule,
       CASE WHEN only_rule IS NOT NULL THEN count(*) FILTER (fail_bits = 0) OVER ()
         + count(*) OVER (PARTITION BY fail_bits) END AS kept_without
FROM f LEFT JOIN (VALUES {_ALONE}) alone(fail_bits, only_rule) USING (fail_bits)
"""

WARC = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), h AS (
  SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes,
         sha1(payload) AS payload_digest
  FROM p
), o AS (
  SELECT payload_digest, max(page_id) AS original FROM h WHERE payload_bytes >= 1000
  GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN original <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN original <> page_id THEN original END AS refers_to
FROM h LEFT JOIN o USING (payload_digest)
"""

_LINES = r"""
  SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
"""
_KEY = (r"translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), "
        r"'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")

LINES = rf"""
WITH l AS ({_LINES}),
k AS (SELECT *, {_KEY} AS key FROM l),
f AS (SELECT key, min(doc_id) AS first_id FROM k WHERE length(key) >= 10
      GROUP BY key HAVING count(DISTINCT doc_id) > 1),
j AS (SELECT k.doc_id, pos, line, first_id IS NOT NULL AND first_id <> k.doc_id AS dropped
      FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), ''))
         AS kept_sha256
FROM j GROUP BY doc_id
"""

CONTAMINATION = rf"""
WITH d AS (SELECT doc_id, {PLAIN} AS words FROM documents),
b AS (SELECT item_id, {PLAIN} AS words FROM benchmark),
grams AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS n,
         array_to_string(list_slice(words, p, p + 9), ' ') AS gram
  FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS p
        FROM b WHERE len(words) > 0)
), sizes AS (SELECT DISTINCT n FROM grams),
places AS (
  SELECT doc_id, n, p, array_to_string(list_slice(words, p, p + n - 1), ' ') AS gram
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS p FROM d, sizes)
), hits AS (SELECT doc_id, item_id, places.n, p FROM places JOIN grams USING (n, gram)),
covered AS (
  SELECT doc_id, count(*) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def _sql(pattern: str) -> str:
    return pattern.replace("'", "''")


def _host(url: str) -> str:
    rest = f"substr({url}, strpos({url}, '://') + 3)"
    return (f"CASE WHEN strpos(coalesce({url}, ''), '://') = 0 THEN '' ELSE "
            f"translate(regexp_extract({rest}, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
            "'abcdefghijklmnopqrstuvwxyz') END")


def _spread(name: str, shares: str, weight: str) -> str:
    """The rounds of one propagation, a common table each."""
    out = [f"{name}0 AS (SELECT host, {weight} AS score FROM weights)"]
    for k in range(urls.ROUNDS):
        out.append(
            f"{name}{k + 1} AS (SELECT host, {weight} + {urls.DAMPING} * coalesce(got, 0) AS score "
            "FROM weights LEFT JOIN (SELECT dst AS host, sum(share * score) AS got "
            f"FROM {shares} JOIN {name}{k} ON src = host GROUP BY dst) USING (host))")
    return ",\n".join(out)


_RULES = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}', '{r.name}')" for r in urls.RULES)

URLS = rf"""
WITH rules(verdict, rule_host, rule_path, rule) AS (VALUES {_RULES}),
p AS MATERIALIZED (
  SELECT row_number() OVER () AS r, page_id, coalesce(html, '') AS html, {_host("url")} AS host,
         CASE WHEN strpos(coalesce(url, ''), '://') = 0 THEN '' ELSE
         regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) END AS path
  FROM pages
), best AS (
  SELECT r, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS rule_verdict
  FROM p JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
    AND starts_with(path, rule_path)
  GROUP BY r
), judged AS MATERIALIZED (SELECT * FROM p LEFT JOIN best USING (r)),
attributes AS (
  SELECT host AS src, regexp_replace(unnest(regexp_extract_all(html, '{_sql(urls.LINK)}', 0)),
    '{_sql(urls.ATTRIBUTE)}', '') AS value FROM p
), found AS (
  SELECT src, CASE WHEN value[1] IN ('"', '''') THEN value[2:-2] ELSE value END AS ref FROM attributes
),
links AS MATERIALIZED (
  SELECT src, dst, count(*) AS n
  FROM (SELECT src, CASE WHEN starts_with(ref, '//') THEN {_host("':' || ref")}
        WHEN regexp_matches(ref, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN {_host("ref")} ELSE '' END AS dst
        FROM found)
  WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst
), seeds AS (
  SELECT host, avg(CASE WHEN rule_verdict = 'allow' THEN 1.0::DOUBLE ELSE 0 END) AS trusted,
         avg(CASE WHEN rule_verdict = 'block' THEN 1.0::DOUBLE ELSE 0 END) AS blocked
  FROM judged WHERE host <> '' GROUP BY host
), weights AS MATERIALIZED (
  SELECT host, coalesce(trusted, 0) AS trusted, coalesce(blocked, 0) AS blocked
  FROM (SELECT host FROM seeds UNION SELECT src FROM links UNION SELECT dst FROM links) everyone
  LEFT JOIN seeds USING (host)
), ahead AS MATERIALIZED (
  SELECT src, dst, n / sum(n) OVER (PARTITION BY src) AS share FROM links
), back AS MATERIALIZED (
  SELECT dst AS src, src AS dst, n / sum(n) OVER (PARTITION BY dst) AS share FROM links
), {_spread("trust", "ahead", "trusted")},
{_spread("distrust", "back", "blocked")}
SELECT page_id, host, path, rule, coalesce(rule_verdict, CASE
  WHEN round(distrust.score, 9) >= {urls.FLOOR}
    AND round(distrust.score * (1 - {urls.SHARE}) - trust.score * {urls.SHARE}, 9) >= 0
  THEN 'block' ELSE 'allow' END) AS verdict
FROM judged LEFT JOIN trust{urls.ROUNDS} AS trust USING (host)
LEFT JOIN distrust{urls.ROUNDS} AS distrust USING (host)
"""

NEGATIVES = """
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM (SELECT * FROM v WHERE vec_id % 100 = 0) a JOIN v b ON a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= 10
"""


def _encoded(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END"


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, bit by bit."""
    codes = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    shift = "list_reduce(range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(crc, byte))"
    return f"xor(list_reduce({codes}, lambda crc, byte: {shift}, 4294967295), 4294967295)"


def _tree(name: str, levels: int) -> str:
    """Levels of the trees over ``<name>0`` (g, rank, n, hash), each with what
    stands left and right of a node in its run."""
    out = []
    for k in range(levels):
        beside = "OVER (PARTITION BY g, rank // 8 ORDER BY rank ROWS BETWEEN"
        out.append(
            f"{name}{k}s AS MATERIALIZED (SELECT *, "
            f"coalesce(string_agg(hash, '') {beside} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, "
            f"coalesce(string_agg(hash, '') {beside} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r "
            f"FROM {name}{k})")
        out.append(
            f"{name}{k + 1} AS MATERIALIZED (SELECT g, rank // 8 AS rank, (max(n) + 7) // 8 AS n, "
            "CASE WHEN max(n) > 1 THEN sha256(string_agg(hash, '' ORDER BY rank)) ELSE min(hash) END "
            f"AS hash FROM {name}{k} GROUP BY g, rank // 8)")
    return ",\n".join(out)


# 16 million rows of a language, 4,096 languages.
_DEEP, _TOP = 8, 4


def _fold() -> str:
    """The hash of a leaf taken up one level after another."""
    out, steps = [], [f"d{k}" for k in range(_DEEP)] + [f"t{k}" for k in range(_TOP)]
    for k, step in enumerate(steps):
        h = f"f.h{k - 1}" if k else "f.start"
        place = (f"s.g = f.g AND s.rank = f.rank // {8 ** k}" if k < _DEEP
                 else f"s.rank = f.top_rank // {8 ** (k - _DEEP)}")
        out.append(
            f"f{k + 1} AS (SELECT f.*, s.l || s.r AS p{k}, CASE WHEN s.n > 1 "
            f"THEN sha256(s.l || {h} || s.r) ELSE {h} END AS h{k} FROM f{k} f JOIN {step}s s ON {place})")
    return ",\n".join(out)


_FIELDS = ("doc_id", "source", "lang", "n_chars")
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_HEAD = " || ".join(_encoded(c) for c in _FIELDS)
_LAST = _DEEP + _TOP

MANIFEST = f"""
WITH docs AS MATERIALIZED (
  SELECT doc_id, CASE WHEN lang IS NULL THEN '-' ELSE '=' || lang END AS g,
         sha256({_HEAD} || {_encoded("text")}) AS leaf,
         CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0
              THEN sha256({_HEAD} || {_encoded(_LOWER)}) END AS tampered
  FROM documents
), placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank,
         count(*) OVER (PARTITION BY g) AS n
  FROM docs
), d0 AS (SELECT g, rank, n, leaf AS hash FROM placed),
{_tree("d", _DEEP)},
tops AS MATERIALIZED (
  SELECT g AS of_g, row_number() OVER (ORDER BY g) - 1 AS rank, count(*) OVER () AS n, hash
  FROM d{_DEEP}
), t0 AS (SELECT '' AS g, rank, n, hash FROM tops),
{_tree("t", _TOP)},
f0 AS (
  SELECT placed.*, tops.rank AS top_rank, tops.hash AS subroot, coalesce(tampered, leaf) AS start
  FROM placed JOIN tops ON of_g = placed.g
),
{_fold()}
SELECT doc_id, leaf, subroot, t{_TOP}.hash AS root,
       sha256({" || ".join(f"p{k}" for k in range(_LAST))}) AS proof_sha256,
       h{_LAST - 1} AS folded_root, h{_LAST - 1} = t{_TOP}.hash AS verified
FROM f{_LAST}, t{_TOP}
"""

ORACLE = {
    "op2_quality_rules": QUALITY,
    "op6_warc": WARC,
    "op7_line_dedup": LINES,
    "op9_url_filter": URLS,
    "op10_decontamination": CONTAMINATION,
    "op11_hard_negatives": NEGATIVES,
    "op13_manifest": MANIFEST,
}
