"""DuckDB counterparts of the operators' queries, where SQL can express them."""

from __future__ import annotations

_WORDS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

OP10 = f"""
WITH item AS (
  SELECT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL
), item_window AS (
  SELECT DISTINCT item_id, array_to_string(w[i : i + 12], ' ') AS key,
         least(13, len(w)) AS size
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i
        FROM item WHERE len(w) > 0)
), doc AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce({_WORDS}, []) AS w FROM documents
), sizes AS (SELECT DISTINCT size FROM item_window),
doc_window AS (
  SELECT rid, i, size, array_to_string(w[i : i + size - 1], ' ') AS key
  FROM (SELECT rid, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM doc, sizes WHERE len(w) >= size)
), hit AS (
  SELECT d.rid, d.i, d.size, b.item_id
  FROM doc_window d JOIN item_window b ON d.key = b.key AND d.size = b.size
), per_doc AS (
  SELECT rid, count(DISTINCT p) AS n_hit
  FROM (SELECT rid, unnest(range(i, i + size)) AS p FROM hit) GROUP BY rid
), named AS (
  SELECT rid, list_sort(list(DISTINCT item_id::VARCHAR)) AS items
  FROM hit WHERE item_id IS NOT NULL GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(len(items), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN per_doc USING (rid) LEFT JOIN named USING (rid)
"""

OP1 = """
WITH payload AS (
  SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS size FROM pages
), marked AS (
  SELECT *, max(page_id) OVER (PARTITION BY body) AS last_id FROM payload
)
SELECT page_id, size::BIGINT AS payload_bytes, sha1(body) AS payload_digest,
       CASE WHEN size >= 1000 AND page_id <> last_id THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN size >= 1000 AND page_id <> last_id THEN last_id END AS refers_to
FROM marked
"""

OP5 = r"""
WITH doc AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id, 9223372036854775807) AS sid,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), win AS (
  SELECT rid, sid, i, array_to_string(w[i : i + 49], ' ') AS k
  FROM (SELECT rid, sid, w, unnest(range(1, len(w) - 48)) AS i FROM doc WHERE len(w) >= 50)
), owner AS (SELECT k, min(sid) AS first_sid FROM win GROUP BY k),
hit AS (
  SELECT DISTINCT rid, p
  FROM (SELECT rid, unnest(range(i, i + 50)) AS p
        FROM win JOIN owner USING (k) WHERE first_sid < sid)
), gone AS (SELECT rid, count(*) AS n FROM hit GROUP BY rid),
kept AS (
  SELECT rid, string_agg(word, ' ' ORDER BY p) AS text
  FROM (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM doc)
       ANTI JOIN hit USING (rid, p)
  GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM doc LEFT JOIN gone USING (rid) LEFT JOIN kept USING (rid)
"""

OP2 = """
WITH code AS (SELECT vec_id, list_transform(range(1, 65), lambda i: embedding[i] > 0) AS bits FROM embeddings),
query AS (SELECT DISTINCT vec_id, bits FROM code WHERE vec_id % 50 = 0),
near AS (
  SELECT q.vec_id AS query_id, q.bits, c.vec_id AS neighbour_id,
         len(list_filter(range(1, 65), lambda i: q.bits[i] <> c.bits[i]))::BIGINT AS distance
  FROM query q, code c WHERE c.vec_id IS DISTINCT FROM q.vec_id
)
SELECT query_id, rank::INTEGER AS rank, neighbour_id, distance
FROM (SELECT *, row_number() OVER (PARTITION BY query_id, bits ORDER BY distance, neighbour_id) AS rank
      FROM near)
WHERE rank <= 10
"""

def _crc32(text: str) -> str:
    """SQL for the unsigned CRC-32 of ASCII text: eight shifts for each byte."""
    shift = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    eight = f"list_reduce(range(8), lambda c, k: {shift}, xor(acc, byte))"
    codes = f"list_transform(string_split({text}, ''), lambda ch: ascii(ch)::BIGINT)"
    return f"xor(list_reduce({codes}, lambda acc, byte: {eight}, 4294967295::BIGINT), 4294967295)"


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


def _levels(name: str, nodes: str, count: int) -> str:
    """CTEs name_0 (the nodes: tree, node, digest, size) to name_count; a node of the next level has its children."""
    parts = [f"{name}_0 AS ({nodes})"]
    for k in range(1, count + 1):
        parts.append(f"""{name}_{k} AS (
  SELECT tree, node // 16 AS node, sha256(string_agg(digest, '' ORDER BY node)) AS digest,
         ((max(size) + 15) // 16) AS size, list(digest ORDER BY node) AS below
  FROM {name}_{k - 1} WHERE size > 1 GROUP BY tree, node // 16)""")
    return ",\n".join(parts)


def _tops(name: str, count: int) -> str:
    return " UNION ALL ".join(f"SELECT tree, digest FROM {name}_{k} WHERE size = 1" for k in range(count + 1))


def _climb(name: str, start: str, tree: str, node: str, step: str, count: int) -> str:
    """CTEs that fold ``own`` and add siblings to ``proof`` on every level above."""
    parts, before = [], start
    for k in range(1, count + 1):
        slot = f"((b.{node} // {16 ** (k - 1)}) % 16)"
        left = f"array_to_string(n.below[1 : {slot}], '')"
        right = f"array_to_string(n.below[{slot} + 2 :], '')"
        parts.append(f"""{step}_{k} AS (
  SELECT b.* EXCLUDE (own, proof),
         CASE WHEN n.below IS NULL THEN b.own ELSE sha256({left} || b.own || {right}) END AS own,
         CASE WHEN n.below IS NULL THEN b.proof ELSE b.proof || {left} || {right} END AS proof
  FROM {before} b LEFT JOIN {name}_{k} n ON n.tree = b.{tree} AND n.node = b.{node} // {16**k})""")
        before = f"{step}_{k}"
    return ",\n".join(parts)


# Levels of sixteen-fold trees that the SQL writes out: up to 16^6 leaves a source, 16^3 sources.
_LEAF_LEVELS, _SOURCE_LEVELS = 6, 3
_HASHED = ["doc_id", "source", "lang", "n_chars"]
_LEAF = "sha256(" + " || ".join(_field(name) for name in [*_HASHED, "text"]) + ")"
_TAMPERED = "sha256(" + " || ".join([*map(_field, _HASHED), _field("lowered")]) + ")"
OP11 = f"""
WITH doc AS (
  SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered,
         {_LEAF} AS leaf FROM documents
), leaf AS (
  SELECT doc_id, leaf,
         CASE WHEN {_crc32("doc_id::VARCHAR")} % 5 = 0 THEN {_TAMPERED} ELSE leaf END AS own,
         dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS node,
         count(*) OVER (PARTITION BY source) AS size
  FROM doc
),
{_levels("t", "SELECT tree, node, leaf AS digest, size FROM leaf", _LEAF_LEVELS)},
sub AS ({_tops("t", _LEAF_LEVELS)}),
{_levels("s", "SELECT 0 AS tree, tree AS node, digest, count(*) OVER () AS size FROM sub", _SOURCE_LEVELS)},
root AS ({_tops("s", _SOURCE_LEVELS)}),
start AS (SELECT *, 0 AS top, '' AS proof FROM leaf),
{_climb("t", "start", "tree", "node", "up", _LEAF_LEVELS)},
{_climb("s", f"up_{_LEAF_LEVELS}", "top", "tree", "over", _SOURCE_LEVELS)}
SELECT doc_id, leaf, sub.digest AS subroot, root.digest AS root, sha256(proof) AS proof_sha256,
       own AS folded_root, own = root.digest AS verified
FROM over_{_SOURCE_LEVELS} o JOIN sub ON sub.tree = o.tree, root
"""


def _codebook_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    distance = "list_sum(list_transform(range(1, len(v) + 1), lambda i: (v[i] - e[i]) * (v[i] - e[i])))"
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""near_{k} AS MATERIALIZED (
  SELECT rid, p.part, min(ROW({distance}, entry)) AS best
  FROM piece p JOIN book_{k} b ON b.part = p.part GROUP BY rid, p.part)""")
        if k < rounds:
            steps.append(f"""book_{k + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.e, b.e) AS e FROM book_{k} b LEFT JOIN (
    SELECT part, entry, list(mean ORDER BY pos) AS e FROM (
      SELECT part, best[2] AS entry, pos, floor(sum(c) / count(*))::BIGINT AS mean
      FROM (SELECT rid, part, unnest(v) AS c, unnest(range(len(v))) AS pos FROM piece)
           JOIN near_{k} USING (rid, part)
      GROUP BY part, best[2], pos) GROUP BY part, entry) m USING (part, entry))""")
    chain = ",\n".join(steps)
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS rid, vec_id, label,
         list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), piece AS MATERIALIZED (
  SELECT rid, part, v[part * (len(v) // {parts}) + 1 : (part + 1) * (len(v) // {parts})] AS v
  FROM kept, range({parts}) r(part)
), book_0 AS (SELECT part, rid AS entry, v AS e FROM piece WHERE rid < {entries}),
{chain},
coded AS (
  SELECT rid, string_agg(printf('%02x', best[2]), '' ORDER BY part) AS code, sum(best[1])::BIGINT AS error
  FROM near_{rounds} GROUP BY rid
), books AS (
  SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book_{rounds}
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (rid), books
"""


OP12 = _codebook_sql()

OP13 = """
WITH doc AS (
  SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), line AS (
  SELECT rid, unnest(range(len(lines))) AS pos, unnest(lines) AS line FROM doc
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM line
), frequent AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT rid) >= 10
), cut AS (
  SELECT rid, count(*) AS n_lines, count(f.key) AS n_dropped,
         string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.key IS NULL) AS kept
  FROM keyed k LEFT JOIN frequent f ON k.key = f.key GROUP BY rid
)
SELECT doc_id, n_lines::BIGINT AS n_lines, n_dropped::BIGINT AS n_dropped, sha256(coalesce(kept, '')) AS kept_sha256
FROM doc JOIN cut USING (rid)
"""

ORACLES: dict[str, str] = {
    "op1_warc": OP1,
    "op2_topk_search": OP2,
    "op5_substring_dedup": OP5,
    "op10_decontamination": OP10,
    "op11_merkle": OP11,
    "op12_codebooks": OP12,
    "op13_line_dedup": OP13,
}
