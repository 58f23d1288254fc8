"""DuckDB counterparts of the queries that SQL can express."""

from __future__ import annotations

from tablewright.llm.license_scan import read_templates

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

JACCARD = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingle FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), e AS (
  SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * common >= 80 * (a.n + b.n - common)
), u AS (
  SELECT x, y FROM e UNION ALL SELECT y, x FROM e
), r(doc_id, reached) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, u.y FROM r JOIN u ON r.reached = u.x
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id) c USING (doc_id)
"""

DECONTAMINATION = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), i AS (
  SELECT item_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), g AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS size,
    unnest(list_transform(range(1, greatest(len(words) - 9, 1) + 1), lambda k: array_to_string(words[k:k + 9], ' '))) AS gram
  FROM i WHERE len(words) > 0
), t AS (
  SELECT doc_id, size, unnest(list_transform(range(1, len(words) - size + 2),
    lambda k: {{'k': k, 'gram': array_to_string(words[k:k + size - 1], ' ')}}), recursive := true)
  FROM d, (SELECT DISTINCT size FROM g) WHERE len(words) >= size
), m AS (
  SELECT t.doc_id, t.k, t.size, g.item_id FROM t JOIN g USING (size, gram)
), h AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + size)) AS place FROM m) GROUP BY doc_id
), f AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN f USING (doc_id)
"""

WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

# A template's hits by place, put into all windows of its span that hold the place.
LICENSES = f"""
WITH t AS (
  SELECT * FROM (VALUES {", ".join(
    "({}, '{}', {}, [{}], {}::VARCHAR[][])".format(t.number, t.license, t.span, ", ".join(f"'{x}'" for x in t.shingles), t.marked()) for t in read_templates()
  )}) AS v(template, license, span, parts, marks)
), d AS (
  SELECT doc_id, regexp_extract_all({LOWER}, {WORDS}) AS words FROM documents
), g AS (
  SELECT doc_id, unnest(list_transform(range(1, len(words) - 3), lambda i: {{'i': i, 'gram': array_to_string(words[i:i + 4], ' ')}}), recursive := true)
  FROM d WHERE len(words) >= 5
), p AS (
  SELECT template, license, span, greatest(1, span // 4) AS step, len(parts) AS m, marks, unnest(parts) AS gram FROM t
), h AS (
  SELECT doc_id, i - 1 AS place, template, license, span, step, m, marks, gram FROM g JOIN p USING (gram)
), w AS (
  SELECT *, unnest(range(greatest(0, -((-(place - span - step + 1)) // step)), place // step + 1)) AS win FROM h
), c AS (
  SELECT doc_id, license, template, win * step AS first, count(DISTINCT gram) / m AS contained
  FROM w WHERE win * step <= place AND place < win * step + span + step GROUP BY doc_id, license, template, win, step, m, marks
  HAVING count(DISTINCT gram) / m >= 0.8 AND len(list_filter(marks, lambda held: NOT list_has_any(list(gram), held))) = 0
)
SELECT doc_id, license, max(contained) AS contained, min_by(first, (-contained, first)) AS first_word FROM c GROUP BY doc_id, license
"""

# CRC-32 of a text of ASCII characters; ``crc`` is a table of one row that holds the polynomial's 256 remainders.
CRC_TABLE = """crc AS (
  SELECT list(c ORDER BY i) AS remainders FROM (SELECT i, list_reduce(range(8),
    lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i::BIGINT) AS c FROM range(256) r(i))
)"""
CRC = """xor(list_reduce(list_transform(string_split({}, ''), lambda c: ord(c)::BIGINT),
    lambda a, b: xor(a >> 8, remainders[(xor(a, b) & 255) + 1]), 4294967295::BIGINT), 4294967295)"""

# A node is told by its depth and its smallest member.
TRIE = f"""
WITH {CRC_TABLE}, c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), o AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, substr(sha256(strlen(role) || ':' || role || text), 1, 32)) AS turns
  FROM c GROUP BY conv_id
), h AS (
  SELECT conv_id, {CRC.format("conv_id::VARCHAR")} % 9 AS h FROM o, crc
), r AS (
  SELECT o.conv_id, coalesce(b.turns[1:h], []) || o.turns[h + 1:] AS turns
  FROM o JOIN h USING (conv_id) LEFT JOIN o b ON b.conv_id = o.conv_id - o.conv_id % 5
), p AS (
  SELECT conv_id, len(turns) AS n, turns, unnest(range(0, len(turns) + 1)) AS depth FROM r
), m AS (
  SELECT conv_id, n, depth, coalesce(strlen(turns[depth].text), 0) AS bytes, min(conv_id) OVER (PARTITION BY depth, turns[1:depth]) AS node FROM p
), g AS (
  SELECT node, depth, count(*) AS n_convs, any_value(bytes) AS bytes,
    sha256(coalesce(string_agg(CASE WHEN n = depth THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM m GROUP BY node, depth
), u AS (
  SELECT g.node, g.depth, m.node AS parent FROM g LEFT JOIN m ON m.conv_id = g.node AND m.depth = g.depth - 1
), k AS (
  SELECT parent AS node, depth - 1 AS depth, count(*) AS n_children FROM u WHERE parent IS NOT NULL GROUP BY ALL
), w AS (
  SELECT g.node, g.depth, (n_convs - 1) * bytes AS own, CASE WHEN n_children IS NULL THEN 1 ELSE 0 END AS leaf FROM g LEFT JOIN k USING (node, depth)
), s AS (
  SELECT m.node, m.depth, sum(own) AS saved, sum(leaf) AS leaves FROM w JOIN m ON m.conv_id = w.node AND m.depth <= w.depth GROUP BY ALL
)
SELECT g.node AS conv_id, g.depth::BIGINT AS depth, u.parent AS parent_conv_id, n_convs, coalesce(n_children, 0)::BIGINT AS n_children,
  leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, ends_sha256
FROM g JOIN u USING (node, depth) JOIN s USING (node, depth) LEFT JOIN k USING (node, depth)
"""

VECTORS = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), p AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id < b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), u AS (
  SELECT x, y FROM p UNION ALL SELECT y, x FROM p
), r(vec_id, reached) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, u.y FROM r JOIN u ON r.reached = u.x
)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN (SELECT vec_id, min(reached) AS component_id FROM r GROUP BY vec_id) USING (vec_id)
LEFT JOIN (SELECT x AS vec_id, count(*) AS n_links FROM u GROUP BY x) USING (vec_id)
"""


def manifest_sql(group_levels: int = 14, table_levels: int = 10) -> str:
    """Levels beyond a tree's height change nothing. Trees of up to 3 ** levels nodes."""

    def field(name: str) -> str:
        return f"CASE WHEN {name} IS NULL THEN '-' ELSE strlen({name}::VARCHAR) || ':' || {name}::VARCHAR END"

    def leaf(text: str) -> str:
        parts = [field(c) for c in ("doc_id", "source", "lang", "n_chars")]
        return f"sha256({' || '.join(parts)} || {text})"

    def climb(name: str, levels: int, keys: str) -> list[str]:
        """From ``name0`` (tree, place, n, hash) and ``f_name0`` (its rows, place, n, node, proof), level by level."""
        out = []
        for k in range(levels):
            out += [
                f"""{name}r{k} AS (SELECT tree, place // 3 AS up, n, list(hash ORDER BY place) AS run FROM {name}{k} GROUP BY tree, place // 3, n)""",
                f"""{name}{k + 1} AS (SELECT tree, up AS place, CASE WHEN n > 1 THEN (n + 2) // 3 ELSE 1 END AS n,
                    CASE WHEN n > 1 THEN sha256(array_to_string(run, '')) ELSE run[1] END AS hash FROM {name}r{k})""",
                f"""f_{name}{k + 1} AS (SELECT {keys}, f.tree, f.place // 3 AS place,
                    CASE WHEN n > 1 THEN sha256(array_to_string(run[1:f.place % 3], '') || node || array_to_string(run[f.place % 3 + 2:], '')) ELSE node END AS node,
                    CASE WHEN n > 1 THEN proof || array_to_string(run[1:f.place % 3], '') || array_to_string(run[f.place % 3 + 2:], '') ELSE proof END AS proof
                    FROM f_{name}{k} f JOIN {name}r{k} r ON r.tree = f.tree AND r.up = f.place // 3)""",
            ]
        return out

    text, bare = field("text"), field(r"replace(text, chr(10), '')")
    return ", ".join([
        f"""WITH {CRC_TABLE}""",
        f"""d AS (SELECT doc_id, source, {leaf(text)} AS leaf, CASE WHEN {CRC.format("doc_id::VARCHAR")} % 2 = 0 THEN {leaf(bare)} ELSE {leaf(text)} END AS claimed
            FROM documents, crc)""",
        """t AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM d)""",
        """l AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, claimed) - 1 AS place, count(*) OVER (PARTITION BY tree) AS n FROM t)""",
        """g0 AS (SELECT tree, place, n, leaf AS hash FROM l)""",
        """f_g0 AS (SELECT doc_id, leaf, tree, place, claimed AS node, '' AS proof FROM l)""",
        *climb("g", group_levels, "doc_id, leaf"),
        f"""b0 AS (SELECT 0 AS tree, tree AS place, count(*) OVER () AS n, hash FROM g{group_levels})""",
        f"""f_b0 AS (SELECT doc_id, leaf, hash AS subroot, 0 AS tree, f.tree AS place, node, proof FROM f_g{group_levels} f JOIN g{group_levels} USING (tree))""",
        *climb("b", table_levels, "doc_id, leaf, subroot"),
    ]) + f"""
    SELECT doc_id, leaf, subroot, hash AS root, sha256(proof) AS proof_sha256, node AS folded_root, node = hash AS verified
    FROM f_b{table_levels}, b{table_levels}
    """  # fmt: skip


SQL = {
    "op1_license_scan": LICENSES,
    "op6_jaccard_join": JACCARD,
    "op10_decontamination": DECONTAMINATION,
    "op11_prefix_trie": TRIE,
    "op12_embedding_dedup": VECTORS,
    "op13_merkle_manifest": manifest_sql(),
}
