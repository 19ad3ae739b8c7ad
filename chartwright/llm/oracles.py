"""DuckDB SQL for the operators that SQL can express, stated by brute force."""

# every 13-word window of every item (a shorter item is one window), looked up
# at every place of every document
OP4 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS m, array_to_string(w[s : s + least(13, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS s FROM i WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, m, s, array_to_string(w[s : s + m - 1], ' ') AS win
  FROM (SELECT doc_id, w, m, unnest(generate_series(1, len(w) - m + 1)) AS s
        FROM d, (SELECT DISTINCT m FROM iw) WHERE len(w) >= m)),
hit AS (SELECT doc_id, dw.m, s, item_id FROM dw JOIN iw USING (m, win)),
places AS (SELECT DISTINCT doc_id, unnest(generate_series(s, s + m - 1)) AS p FROM hit),
n AS (SELECT doc_id, count(*) AS n_hit FROM places GROUP BY 1),
names AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS l
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(l, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN names USING (doc_id)
"""

# all pairs that share a shingle, compared exactly; components by repeated least neighbours
OP6 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[p : p + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2
  HAVING 100 * count(*) >= 75 * ((SELECT n FROM n WHERE doc_id = a.doc_id) + (SELECT n FROM n WHERE doc_id = b.doc_id) - count(*))),
reach(doc_id, c) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT l.b, r.c FROM reach r JOIN links l ON l.a = r.doc_id WHERE r.c < l.b)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, r.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(c) AS component_id FROM reach GROUP BY 1) r USING (doc_id)
"""

OP8 = """
WITH r AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, role IS NOT NULL AS named, coalesce(text, '') AS words
  FROM conversations WHERE conv_id IS NOT NULL),
m AS (
  SELECT r.*, participant, CAST(coalesce(floor(turn / 64), 0) AS BIGINT) AS chunk_no, named AND speaker = participant AS own,
    CASE WHEN named AND speaker = participant THEN '<|im_start|>assistant' WHEN named AND speaker = 'system' THEN '<|im_start|>system'
         ELSE '<|im_start|>user name=' || speaker END || chr(10) || words || '<|im_end|>' || chr(10) AS piece
  FROM r JOIN (SELECT DISTINCT conv_id, speaker AS participant FROM r WHERE named AND speaker <> 'system') USING (conv_id)),
p AS (
  SELECT *, sum(length(piece)) OVER (PARTITION BY conv_id, participant ORDER BY turn NULLS FIRST, speaker, words, piece
                                     ROWS UNBOUNDED PRECEDING) AS upto FROM m)
SELECT conv_id, participant, chunk_no, count(*) AS n_turns, CAST(min(upto - length(piece)) AS BIGINT) AS start,
  sha256(string_agg(piece, '' ORDER BY upto)) AS text_sha256,
  coalesce(string_agg(CAST(CAST(upto - 11 - length(words) AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(upto - 11 AS BIGINT) AS VARCHAR), ','
    ORDER BY upto) FILTER (WHERE own), '') AS mask
FROM p GROUP BY 1, 2, 3
"""

OP9 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages WHERE page_id IS NOT NULL),
s AS (SELECT page_id, h, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, payload_bytes, sha256(h) AS payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM s
"""

# every anchor against every row; negatives of each positive's window
OP12 = """
WITH v AS (
  SELECT vec_id, min(struct_pack(l := label, e := embedding)) AS s
  FROM (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS embedding FROM embeddings)
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 GROUP BY 1),
r AS (SELECT vec_id, s.l AS label, list_transform(s.e, lambda x: floor(256 * x)) AS q FROM v),
p AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS alike, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
pos AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS k FROM p WHERE alike) WHERE k <= 5),
neg AS (
  SELECT pos.anchor_id, pos.id AS positive_id, p.id AS negative_id, pos.score AS positive_score, p.score AS negative_score,
    row_number() OVER (PARTITION BY pos.anchor_id, pos.id ORDER BY p.score DESC, p.id) AS rank
  FROM pos JOIN p ON p.anchor_id = pos.anchor_id AND NOT p.alike AND 50 * pos.score <= 100 * p.score AND 100 * p.score <= 95 * pos.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 3
"""


def _merkle(levels: int = 8) -> str:
    """Every level of the trees written out, and every leaf's path folded level by level; enough for 8 ** levels leaves a group."""
    size = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}) || ':' || {c} END"
    leaf = lambda text: "sha256(" + " || ".join(size(c) for c in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)) + ")"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    sql = f"""
WITH bits AS (SELECT unnest(generate_series(0, 255)) AS b, 0 AS x),
crc AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(CAST(b AS BIGINT), CAST(generate_series(1, 8) AS BIGINT[])),
      lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM bits)),
d AS (
  SELECT *, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
    lambda c, s: xor(c >> 8, t[CAST(xor(c, s) & 255 AS INTEGER) + 1])) AS raw FROM documents, crc),
l AS (
  SELECT doc_id, lang, {leaf("text")} AS leaf,
    CASE WHEN xor(raw, 4294967295) % 3 = 0 THEN {leaf(lower)} ELSE {leaf("text")} END AS changed FROM d),
t0 AS (
  SELECT lang AS g, CAST(row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS BIGINT) AS p, leaf AS h,
    CAST(count(*) OVER (PARTITION BY lang) AS BIGINT) AS n, doc_id, changed FROM l)"""
    for tree in ("t", "u"):
        if tree == "u":
            sql += f""",
u0 AS (SELECT 1 AS g, CAST(row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS BIGINT) AS p, h, CAST(count(*) OVER () AS BIGINT) AS n, g AS lang FROM t{levels})"""
        for k in range(1, levels + 1):
            sql += f""",
{tree}{k} AS (
  SELECT g, CASE WHEN n = 1 THEN p ELSE p // 8 END AS p, CASE WHEN max(n) = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY p)) END AS h,
    CASE WHEN n = 1 THEN 1 ELSE (n + 7) // 8 END AS n FROM {tree}{k - 1} GROUP BY g, n, 2)"""
    # the path of each leaf: own place, proof so far, digest so far
    sql += """,
w0 AS (SELECT doc_id, g, p, h AS leaf, changed AS f, '' AS proof, row_number() OVER () AS id FROM t0)"""
    at = "w0"
    for tree in ("t", "u"):
        if tree == "u":
            sql += f""",
v0 AS (SELECT w.* REPLACE (1 AS g, u0.p AS p), w.g AS lang, u0.h AS subroot FROM {at} w JOIN u0 ON u0.lang IS NOT DISTINCT FROM w.g)"""
            at = "v0"
        name = "w" if tree == "t" else "v"
        for k in range(levels):
            sql += f""",
{name}r{k} AS (SELECT g, p // 8 AS run, list(h ORDER BY p) AS hs, any_value(n) AS n FROM {tree}{k} GROUP BY 1, 2),
{name}{k + 1} AS (
  SELECT w.* REPLACE (CASE WHEN r.n = 1 THEN w.p ELSE w.p // 8 END AS p,
    CASE WHEN r.n = 1 THEN f ELSE sha256(array_to_string(hs[1 : p % 8], '') || f || array_to_string(hs[p % 8 + 2 :], '')) END AS f,
    CASE WHEN r.n = 1 THEN proof ELSE proof || array_to_string(hs[1 : p % 8], '') || array_to_string(hs[p % 8 + 2 :], '') END AS proof)
  FROM {at} w JOIN {name}r{k} r ON r.g IS NOT DISTINCT FROM w.g AND r.run = w.p // 8)"""
            at = f"{name}{k + 1}"
    return sql + f"""
SELECT doc_id, leaf, subroot, u.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = u.h AS verified
FROM {at}, (SELECT h FROM u{levels}) u
"""


OP13 = _merkle()

SQL = {
    "op4_decontamination": OP4,
    "op6_jaccard_join": OP6,
    "op8_chat_formatting": OP8,
    "op9_warc": OP9,
    "op12_hard_negatives": OP12,
    "op13_merkle_manifest": OP13,
}
