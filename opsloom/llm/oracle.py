"""SQL that the training-data queries are checked against, where SQL can express them.

Token counts, encodings and packing need a tokenizer, SimHash a seeded hash that the checking
engine lacks, secrets a recursion over decoders, toxicity a fitted model, and nearest neighbours
are approximate; their tests compare with libraries and brute force instead.
"""

from __future__ import annotations

from opsloom.llm import line_quality

REPEATED_PASSAGES = """
WITH texts AS (
  SELECT doc_id, octet_length(b) AS n_bytes, hex(b) AS h
  FROM (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents)),
windows AS (
  SELECT doc_id, p, md5_number(substring(h, 2 * p + 1, 200)) AS w
  FROM (SELECT doc_id, h, unnest(range(n_bytes - 99)) AS p FROM texts WHERE n_bytes >= 100)),
again AS (
  SELECT doc_id, p, p + 100 AS upto FROM (SELECT doc_id, p,
    row_number() OVER (PARTITION BY w ORDER BY doc_id, p) AS place FROM windows) WHERE place > 1),
runs AS (
  SELECT doc_id, min(p) AS a, max(upto) AS b FROM (
    SELECT doc_id, p, upto, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM (
      SELECT doc_id, p, upto, CASE WHEN p <= lag(upto) OVER (PARTITION BY doc_id ORDER BY p)
        THEN 0 ELSE 1 END AS fresh FROM again)) GROUP BY doc_id, run),
kept AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
    string_agg(piece, '' ORDER BY a) AS pieces FROM (
    SELECT doc_id, a, b, substring(h, 2 * coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) + 1,
      2 * (a - coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0))) AS piece
    FROM runs JOIN texts USING (doc_id)) GROUP BY doc_id)
SELECT doc_id, n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(pieces || substring(h, 2 * last + 1), h))) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)"""


HARD_NEGATIVES = """
WITH vectors AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding)),
scored AS (
  SELECT a.id AS anchor_id, b.id, a.label = b.label AS alike, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM vectors a JOIN vectors b ON a.id <> b.id WHERE a.id % 50 = 0),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, positive_score, id AS negative_id, score AS negative_score,
  row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS rank
FROM positives JOIN scored USING (anchor_id)
WHERE NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3"""


PREFIX_TRIE = """
WITH turns AS (
  SELECT conv_id AS c, octet_length(encode(coalesce(text, ''))) AS bytes,
    md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
sizes AS (SELECT c, count(*) AS size FROM turns GROUP BY c),
heads AS (
  SELECT c, c - c % 5 AS lender, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(length(c::VARCHAR)),
      lambda i: ord(substring(c::VARCHAR, i + 1, 1))::BIGINT)),
    lambda crc, b: list_reduce([xor(crc, b), 1, 1, 1, 1, 1, 1, 1, 1]::BIGINT[],
      lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) % 9 AS h
  FROM sizes),
lent AS (
  SELECT heads.c, lender, h, least(h, coalesce(size, 0)) AS m
  FROM heads LEFT JOIN sizes ON sizes.c = heads.lender),
rebuilt AS (
  SELECT c, place - h + m AS d, digest, bytes FROM turns JOIN lent USING (c) WHERE place > h
  UNION ALL
  SELECT lent.c, place, digest, bytes FROM turns JOIN lent ON turns.c = lent.lender AND place <= m),
paths AS (
  SELECT c, d, bytes, string_agg(digest, '') OVER (PARTITION BY c ORDER BY d) AS path FROM rebuilt
  UNION ALL SELECT c, 0, 0, '' FROM sizes),
lengths AS (SELECT c, max(d) AS len FROM paths GROUP BY c),
nodes AS (
  SELECT path, d, min(c) AS conv_id, count(*) AS n_convs, min(bytes) AS bytes,
    coalesce(string_agg(CASE WHEN d = len THEN c::VARCHAR END, ',' ORDER BY c), '') AS ends
  FROM paths JOIN lengths USING (c) GROUP BY path, d),
counted AS (
  SELECT n.*, p.conv_id AS parent_conv_id, coalesce(k.n_children, 0) AS n_children
  FROM nodes n LEFT JOIN nodes p ON n.d > 0 AND p.path = n.path[:-33]
  LEFT JOIN (SELECT path[:-33] AS path, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1) k
    ON k.path = n.path),
above AS (
  SELECT path AS below, substring(path, 1, 32 * unnest(range(0, d + 1))::INTEGER) AS path FROM counted),
subtrees AS (
  SELECT above.path, sum(CASE WHEN b.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
    sum((b.n_convs - 1) * b.bytes) AS saved_tokens
  FROM above JOIN counted b ON b.path = above.below GROUP BY above.path)
SELECT conv_id, CAST(d AS BIGINT) AS depth, parent_conv_id, n_convs, n_children,
  CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(ends) AS ends_sha256
FROM counted JOIN subtrees USING (path)"""


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def line_quality_sql(rules: line_quality.LineRules = line_quality.LineRules()) -> str:
    word = r"[^\x20\x09-\x0D]+"
    closing = "|".join(
        literal(c)[1:-1] if c.isalnum() or ord(c) > 127 or c in "!\"':;" else "\\" + c
        for c in line_quality.CLOSING
    )
    boilerplate = " OR ".join(f"contains(lower(line), {literal(p)})" for p in line_quality.BOILERPLATE)

    def count(text: str, unwanted: str) -> str:
        return f"length(regexp_replace({text}, '{unwanted}', '', 'g'))"

    return rf"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{word}') AS words
  FROM documents),
lines AS (
  SELECT doc_id, line, min(i) AS i, count(*) - 1 AS repeats FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
      generate_subscripts(string_split(text, chr(10)), 1) AS i FROM docs)
  WHERE regexp_matches(line, '{word}') GROUP BY doc_id, line),
measured AS (
  SELECT doc_id, line, repeats, len(regexp_extract_all(line, '{word}')) AS n,
    {count('line', '[^|»›·•>]')} AS separators, {count('line', '[^#*$%&<>]')} AS symbols,
    {count('line', '[^A-ZÀ-ÖØ-Þ]')} AS capitals, {count('line', r'[^\p{L}]')} AS letters,
    regexp_matches(line, '({closing})(\s|$)') AS closed
  FROM lines),
judged AS (
  SELECT doc_id, sum(repeats) AS n_dup_lines, sum(CASE
    WHEN separators >= 2 AND separators >= {rules.separator_share} * n THEN 0
    WHEN n <= {rules.boilerplate_words} AND ({boilerplate}) THEN 0
    WHEN symbols > greatest(2, {rules.symbol_share} * n) THEN 0
    WHEN capitals >= 12 AND letters >= 20 AND capitals > {rules.capital_share} * letters THEN 0
    WHEN n >= {rules.open_words} AND NOT closed THEN 0 ELSE n END) AS words_left
  FROM measured GROUP BY doc_id),
placed AS (SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM docs),
windows AS (
  SELECT doc_id, i, w, lead(w) OVER o AS w1, lead(w, 2) OVER o AS w2 FROM placed
  WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w, w1, w2) AS c
    FROM windows WHERE w2 IS NOT NULL) WHERE c > 1),
repeated AS (
  SELECT doc_id, count(DISTINCT j) AS n_repeat_words FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM twice) GROUP BY doc_id),
counted AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    {count('text', '[^#*$%&|<>]')} AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(words_left, 0) AS words_left
  FROM docs LEFT JOIN judged USING (doc_id) LEFT JOIN repeated USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.repeat_percent} * n_words AS base_failed,
  NOT (n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.repeat_percent} * n_words)
    AND words_left >= {1 - rules.most_lost} * n_words AS kept
FROM counted"""


def oracle_sql() -> dict[str, str]:
    return {
        "op7_repeated_passages": REPEATED_PASSAGES,
        "op8_line_quality": line_quality_sql(),
        "op11_hard_negatives": HARD_NEGATIVES,
        "op13_prefix_trie": PREFIX_TRIE,
    }
