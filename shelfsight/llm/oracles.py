"""DuckDB texts of the queries that SQL can express over whole tables."""

from __future__ import annotations

_OP7 = r"""
WITH sized AS (
  SELECT doc_id, source, text,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 2.0::DOUBLE * CAST(sum(size) AS DOUBLE) AS cap,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
      WHEN 0 THEN 5::DOUBLE WHEN 1 THEN 2::DOUBLE ELSE 1::DOUBLE END AS w
  FROM sized GROUP BY source),
total AS (SELECT 1.5::DOUBLE * CAST(sum(source_size) AS DOUBLE) AS words, sum(w) AS w FROM sources),
levels AS (  -- capping the sources up to each ratio; too few or too many give a lower level
  SELECT (words - coalesce(sum(cap) OVER upto, 0)) / nullif(total.w - sum(s.w) OVER upto, 0) AS level
  FROM sources s, total
  WINDOW upto AS (ORDER BY cap / s.w RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  UNION ALL SELECT words / w FROM total),
targets AS (
  SELECT source, source_size, least(cap, w * (SELECT max(level) FROM levels)) AS target FROM sources),
drawn AS (
  SELECT doc_id, size, sized.source, source_size, target,
    md5(concat_ws(':', '7', CAST(doc_id AS VARCHAR), md5(text))) AS draw,
    CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS every,
    CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) % source_size ELSE 0 END AS rest
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source),
placed AS (  -- words of the source up to the document's draw, and before it
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY draw), 0) AS through,
    sum(size) OVER (PARTITION BY source, draw) AS words,
    count(*) OVER (PARTITION BY source, draw) AS copies
  FROM drawn)
SELECT doc_id, size, source_size, target, CAST(
  CASE WHEN size = 0 THEN 0
    WHEN through <= rest THEN size * (every + 1)
    WHEN through - words <= rest THEN size * every + (rest - through + words) // copies
    ELSE size * every END AS BIGINT) AS taken
FROM placed
"""

_KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_CHECKS = {
    "email": "true",
    "ip": "len(list_filter(string_split(m, '.'), lambda p: CAST(p AS HUGEINT) > 255)) = 0",
    "card": r"""length(d) BETWEEN 12 AND 19 AND list_sum(list_transform(string_split(reverse(d), ''),
      lambda c, i: CASE WHEN i % 2 = 1 THEN CAST(c AS INT)
        ELSE CAST(c AS INT) * 2 - CASE WHEN CAST(c AS INT) > 4 THEN 9 ELSE 0 END END)) % 10 = 0""",
    "phone": "length(d) BETWEEN 9 AND 15",
}


def _op10() -> str:
    found = " UNION ALL ".join(
        rf"""SELECT doc_id, {number} AS kind, '{name}' AS name, s AS start, s + length(m) AS stop FROM (
  SELECT doc_id, m, regexp_replace(m, '[^0-9]', '', 'g') AS d,
    list_sum(list_transform(pieces[1:i], lambda x: length(x)))
      + coalesce(list_sum(list_transform(matches[1:i - 1], lambda x: length(x))), 0) AS s
  FROM (SELECT doc_id, pieces, matches, unnest(matches) AS m, generate_subscripts(matches, 1) AS i FROM (
    SELECT doc_id, string_split_regex(text, '{pattern}') AS pieces,
      regexp_extract_all(text, '{pattern}') AS matches FROM documents)))
WHERE {_CHECKS[name]}"""
        for number, (name, pattern) in enumerate(_KINDS.items())
    )
    counts = ", ".join(
        f"CAST(count(*) FILTER (name = '{name}') AS BIGINT) AS n_{name}" for name in _KINDS
    )
    return f"""WITH found AS ({found}),
digests AS (SELECT doc_id, {counts},
  string_agg(name || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY start, kind) AS spans
  FROM found GROUP BY doc_id)
SELECT doc_id, {", ".join(f"coalesce(n_{n}, 0) AS n_{n}" for n in _KINDS)},
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN digests USING (doc_id)"""


_OP1 = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (
  SELECT doc_id, p, w[p] AS w3, w[p - 1] AS w2, w[p - 2] AS w1
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM texts)),
counted AS (
  SELECT doc_id, p,
    count(*) OVER (PARTITION BY w3) - count(*) OVER (PARTITION BY doc_id, w3) AS c1,
    CASE WHEN p > 1 THEN count(*) OVER (PARTITION BY p > 1, w2, w3)
      - count(*) OVER (PARTITION BY doc_id, p > 1, w2, w3) ELSE 0 END AS c2,
    CASE WHEN p > 2 THEN count(*) OVER (PARTITION BY p > 2, w1, w2, w3)
      - count(*) OVER (PARTITION BY doc_id, p > 2, w1, w2, w3) ELSE 0 END AS c3,
    greatest(count(*) OVER () - count(*) OVER (PARTITION BY doc_id), 1) AS rest
  FROM words),
chained AS (
  SELECT *, lag(c1) OVER o AS context1, lag(c2) OVER o AS context2, least(p, 3) AS longest
  FROM counted WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
scored AS (
  SELECT doc_id, c1 > 0 AS known, CASE
    WHEN c3 > 0 THEN ln(c3) - ln(context2)
    WHEN c2 > 0 THEN ln(c2) - ln(context1) + (longest - 2) * ln(0.4::DOUBLE)
    WHEN c1 > 0 THEN ln(c1) - ln(rest) + (longest - 1) * ln(0.4::DOUBLE)
    ELSE -ln(rest) + longest * ln(0.4::DOUBLE) END AS score
  FROM chained),
sums AS (
  SELECT doc_id, count(*) FILTER (known) AS n_known, sum(score) AS log_score FROM scored GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_known, 0) AS n_known,
  round(coalesce(log_score, 0), 4) AS log_score,
  round(CASE WHEN len(w) > 0 THEN log_score / len(w) END, 6) AS mean_log_score
FROM texts LEFT JOIN sums USING (doc_id)
"""

#: The pairs meet on a shared shingle; the closure of the links is walked by SQL itself.
_OP9 = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) < 2 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w)), lambda p: w[p] || ' ' || w[p + 1]) END) AS s
    FROM texts WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
ends AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT reach.doc_id, ends.b FROM reach JOIN ends ON ends.a = reach.other),
parts AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, component_id = doc_id AS kept
FROM documents JOIN parts USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""


#: CRC-32 of a text, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
  list_transform(range(1, 2 * octet_length(encode({text})), 2),
    lambda i: CAST('0x' || substr(hex(encode({text})), i, 2) AS BIGINT))),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
    lambda a, i: xor(a >> 1, 3988292384 * (a & 1)))))"""


def _op12() -> str:
    def field(column):
        return (
            f"coalesce(CAST(octet_length(encode(CAST({column} AS VARCHAR))) AS VARCHAR)"
            f" || ':' || CAST({column} AS VARCHAR), '-')"
        )

    head = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    crc = _CRC32.format(text="CAST(doc_id AS VARCHAR)")

    def climb(name, first):
        return f"""{name} AS (
  {first}
  UNION ALL
  SELECT tree, level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (total + 2) // 3
  FROM {name} WHERE total > 1 GROUP BY tree, level, pos // 3, total)"""

    def others(nodes):
        return f"""SELECT n.tree, n.level, n.pos,
    string_agg(o.digest, '' ORDER BY o.pos) FILTER (WHERE o.pos < n.pos) AS l,
    string_agg(o.digest, '' ORDER BY o.pos) FILTER (WHERE o.pos > n.pos) AS r
  FROM {nodes} n JOIN {nodes} o
    ON o.tree = n.tree AND o.level = n.level AND o.pos // 3 = n.pos // 3
  WHERE n.total > 1 GROUP BY n.tree, n.level, n.pos"""

    return f"""WITH RECURSIVE hashed AS (
  SELECT doc_id, source, sha256({head} || {field("text")}) AS leaf,
    CASE WHEN {crc} % 2 = 0 THEN sha256({head} || {field("replace(text, chr(10), '')")}) END AS claim
  FROM documents),
places AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS total FROM hashed),
{climb("nodes", "SELECT tree, 0 AS level, pos, leaf AS digest, total FROM places")},
{climb("tops", """SELECT 0 AS tree, 1000 AS level, tree AS pos, digest,
    count(*) OVER () AS total FROM nodes WHERE total = 1""")},
sides AS ({others("nodes")} UNION ALL {others("tops")}),
ways AS (
  SELECT tree AS t, pos AS p, 0 AS level, tree, pos, coalesce(claim, leaf) AS digest, '' AS proof FROM places
  UNION ALL
  SELECT t, p, CASE WHEN s.level IS NULL THEN 1000 ELSE w.level + 1 END,
    CASE WHEN s.level IS NULL THEN 0 ELSE w.tree END,
    CASE WHEN s.level IS NULL THEN w.t ELSE w.pos // 3 END,
    CASE WHEN s.level IS NULL THEN digest
      ELSE sha256(coalesce(s.l, '') || digest || coalesce(s.r, '')) END,
    proof || coalesce(s.l, '') || coalesce(s.r, '')
  FROM ways w LEFT JOIN sides s ON s.tree = w.tree AND s.level = w.level AND s.pos = w.pos
  WHERE s.level IS NOT NULL OR w.level < 1000),
ends AS (SELECT t, p, digest, proof FROM ways
  QUALIFY row_number() OVER (PARTITION BY t, p ORDER BY level DESC) = 1)
SELECT doc_id, leaf, n.digest AS subroot, r.digest AS root, sha256(e.proof) AS proof_sha256,
  e.digest AS folded_root, e.digest = r.digest AS verified
FROM places a JOIN ends e ON e.t = a.tree AND e.p = a.pos
JOIN nodes n ON n.tree = a.tree AND n.total = 1
CROSS JOIN (SELECT digest FROM tops WHERE total = 1) r"""


_OP11 = r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents)
  GROUP BY ALL),
hashed AS (SELECT run, times, doc_id || ':' || run AS t FROM runs),
checked AS (SELECT run, times, {crc} AS h FROM hashed),
spelt AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
    ELSE run END AS word, times FROM checked),
words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM spelt WHERE length(word) >= 5
  GROUP BY word HAVING sum(times) >= 3),
cuts AS (
  SELECT word, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS p FROM words)),
near AS (
  SELECT a.word AS a, b.word AS b FROM cuts a JOIN cuts b ON a.p = b.p AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT c.word, w.word FROM cuts c JOIN words w ON w.word = c.rest
  UNION SELECT w.word, c.word FROM cuts c JOIN words w ON w.word = c.rest),
best AS (
  SELECT a, count(*) OVER (PARTITION BY a) AS n_near, b, n AS b_n,
    row_number() OVER (PARTITION BY a ORDER BY n DESC, b) AS place
  FROM near JOIN words ON word = b),
formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN b_n >= 2 * n THEN b END AS form,
    CASE WHEN b_n >= 2 * n THEN b_n END AS form_n
  FROM words LEFT JOIN best ON a = word AND place = 1),
ways AS (
  SELECT word, word AS here, 0 AS step FROM formed
  UNION ALL SELECT w.word, f.form, step + 1 FROM ways w JOIN formed f ON f.word = w.here WHERE f.form IS NOT NULL)
SELECT f.word, form, w.last AS root, n, n_near, form_n
FROM formed f JOIN (SELECT word, arg_max(here, step) AS last FROM ways GROUP BY word) w ON w.word = f.word
""".replace("{crc}", _CRC32.format(text="t"))

ORACLES = {
    "op1_lm_score": _OP1, "op9_minhash": _OP9, "op7_mixing": _OP7, "op10_pii": _op10(),
    "op11_variants": _OP11, "op12_manifest": _op12(),
}
