"""SQL for the manifest and the hard negatives, written from their contracts."""

from __future__ import annotations

FAN = 3


def _level(name: str, k: int) -> str:
    """Level k + 1 of the trees, and what stands left and right of each node of level k in its run."""
    return f"""
, {name}{k + 1} AS (
  SELECT tree, i // {FAN} AS i, CAST(ceil(n / {FAN}) AS BIGINT) AS n, CASE WHEN n = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h
  FROM {name}{k} GROUP BY tree, i // {FAN}, n
), {name}_beside{k} AS (
  SELECT a.tree, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
  FROM {name}{k} a JOIN {name}{k} b ON a.tree IS NOT DISTINCT FROM b.tree AND a.i // {FAN} = b.i // {FAN} WHERE a.n > 1 GROUP BY a.tree, a.i
)"""


def _fold(name: str, k: int, before: str, place: str, tree: str) -> str:
    """One step up: the node's hash with what stands beside it, which goes to the proof."""
    return f"""
, {name}_fold{k} AS (
  SELECT x.* REPLACE (CASE WHEN s.l IS NULL THEN node ELSE sha256(s.l || node || s.r) END AS node, proof || coalesce(s.l || s.r, '') AS proof)
  FROM {before} x LEFT JOIN {name}_beside{k} s ON {tree} AND x.{place} // {FAN**k} = s.i
)"""


def manifest(levels: int = 12, top_levels: int = 6) -> str:
    """Enough for FAN ** levels rows a source and FAN ** top_levels sources; crc32 is worked out bit by bit."""

    def leaf(text: str) -> str:
        values = ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)
        return "sha256(" + " || ".join(f"coalesce(CAST(strlen({v}) AS VARCHAR) || ':' || {v}, '-')" for v in values) + ")"

    bits = """list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(range(1, strlen(CAST(doc_id AS VARCHAR)) + 1),
      lambda k: list_transform(range(8), lambda b: (ascii(substr(CAST(doc_id AS VARCHAR), CAST(k AS INTEGER), 1)) >> CAST(b AS INTEGER)) & 1))))"""
    parts = [
        f"""
WITH d AS (
  SELECT doc_id, source, {leaf("text")} AS leaf, {leaf("replace(text, chr(10), '')")} AS other,
    list_reduce({bits}, lambda c, b: xor(xor(c, b) >> 1, CASE WHEN xor(c, b) & 1 = 1 THEN 3988292384 ELSE 0 END)) AS crc
  FROM documents
), rows0 AS (
  SELECT source AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n,
    leaf AS h, doc_id, CASE WHEN crc & 1 = 1 THEN other ELSE leaf END AS candidate
  FROM d
)""",
        *(_level("rows", k) for k in range(levels)),
        f""", top0 AS (
  SELECT 0 AS tree, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS i, count(*) OVER () AS n, h, tree AS source FROM rows{levels}
)""",
        *(_level("top", k) for k in range(top_levels)),
        """
, way AS (
  SELECT r.doc_id, r.h AS leaf, r.tree, r.i, t.i AS j, t.h AS subroot, r.candidate AS node, '' AS proof
  FROM rows0 r JOIN top0 t ON r.tree IS NOT DISTINCT FROM t.source
)""",
    ]
    before = "way"
    for name, count, place, tree in (("rows", levels, "i", "x.tree IS NOT DISTINCT FROM s.tree"), ("top", top_levels, "j", "s.tree = 0")):
        for k in range(count):
            parts.append(_fold(name, k, before, place, tree))
            before = f"{name}_fold{k}"
    parts.append(f"""
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, node AS folded_root, node = h AS verified
FROM {before} CROSS JOIN (SELECT h FROM top{top_levels})""")
    return "".join(parts)


HARD_NEGATIVES = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM r a JOIN r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS place FROM s WHERE same) WHERE place <= 5
), n AS (
  SELECT p.anchor_id, p.other_id AS positive_id, s.other_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY s.score DESC, s.other_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id WHERE NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
