"""DuckDB forms of the registered queries that SQL can express."""

from __future__ import annotations

CHAT = """WITH t AS (
    SELECT DISTINCT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text FROM conversations),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text) - 1 AS pos FROM t),
c AS (SELECT conv_id, count(*) AS n, list(struct_pack(r := role, x := text) ORDER BY pos) AS ts FROM p GROUP BY conv_id),
shorter AS (SELECT DISTINCT a.conv_id, a.n FROM c a JOIN c b ON a.ts[1] = b.ts[1]
            WHERE b.n > a.n AND b.ts[1:a.n] = a.ts),
top AS (SELECT conv_id, n FROM c
        WHERE NOT EXISTS (SELECT 1 FROM shorter s WHERE s.conv_id IS NOT DISTINCT FROM c.conv_id)
        QUALIFY row_number() OVER (PARTITION BY ts ORDER BY conv_id NULLS LAST) = 1)
SELECT p.conv_id, CAST(any_value(n) AS BIGINT) AS n_turns, CAST(pos // 256 AS BIGINT) AS part,
       CAST(ceil(any_value(n) / 256) AS BIGINT) AS n_parts,
       string_agg('<|im_start|>' || replace(role, '<|im_', '<| im_') || chr(10) || replace(text, '<|im_', '<| im_')
                  || '<|im_end|>' || chr(10), '' ORDER BY pos) AS rendered
FROM p JOIN top ON p.conv_id IS NOT DISTINCT FROM top.conv_id
GROUP BY p.conv_id, pos // 256"""

WARC = """WITH d AS (
    SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS least FROM d),
r AS (SELECT *, n >= 100 AND least IS NOT NULL AND page_id IS DISTINCT FROM least AS again FROM f)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN least END AS refers_to
FROM r"""

_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

DECONTAMINATE = f"""WITH items AS (
    SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
sized AS (SELECT item, w, least(13, len(w)) AS size FROM items WHERE len(w) > 0),
wanted AS (SELECT DISTINCT item, size, array_to_string(w[s:s + size - 1], ' ') AS key
           FROM (SELECT item, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM sized)),
docs AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
places AS (SELECT rid, w, size, unnest(range(1, len(w) - size + 2)) AS s
           FROM docs, (SELECT DISTINCT size FROM wanted) WHERE len(w) >= size),
hits AS (SELECT rid, s, places.size AS size, item FROM places JOIN wanted
         ON wanted.size = places.size AND wanted.key = array_to_string(w[s:s + places.size - 1], ' ')),
covered AS (SELECT rid, count(DISTINCT word) AS n_hit
            FROM (SELECT rid, unnest(range(s, s + size)) AS word FROM hits) GROUP BY rid),
found AS (SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids
          FROM hits GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN covered USING (rid) LEFT JOIN found USING (rid)"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _leaf(text: str) -> str:
    parts = [f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
             for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(parts)})"


# CRC-32 (reflected polynomial 0xEDB88320), bit by bit.
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
                                  lambda v, z: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END))))"""


def _tree(name: str, height: int) -> str:
    """Common table expressions of the levels of trees whose leaves are
    ``{name}0 (tree, place, size, id, hash, now)``: nodes by level, then per
    leaf the proof and the folded hash."""
    out = []
    for k in range(height):
        out.append(f"""{name}{k + 1} AS (SELECT tree, place // 8 AS place, CASE WHEN any_value(size) = 1 THEN 1
        ELSE (any_value(size) + 7) // 8 END AS size,
        CASE WHEN any_value(size) = 1 THEN any_value(hash) ELSE sha256(string_agg(hash, '' ORDER BY place)) END AS hash
    FROM {name}{k} GROUP BY tree, place // 8)""")
        left = "'' " if not k else "proof"
        src = f"(SELECT tree, place AS leaf, place, size, now, '' AS proof FROM {name}0)" if not k else f"{name}p{k - 1}"
        out.append(f"""{name}s{k} AS (SELECT a.tree, a.place, a.size,
        coalesce(string_agg(b.hash, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS lefts,
        coalesce(string_agg(b.hash, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS rights
    FROM {name}{k} a JOIN {name}{k} b ON a.tree = b.tree AND a.place // 8 = b.place // 8 GROUP BY ALL),
{name}p{k} AS (SELECT p.tree, leaf, p.place // 8 AS place, proof || lefts || rights AS proof,
        CASE WHEN s.size = 1 THEN now ELSE sha256(lefts || now || rights) END AS now
    FROM {src} p JOIN {name}s{k} s ON p.tree = s.tree AND p.place = s.place)""")
    return ",\n".join(out)


# Seven levels hold two million rows of a language, three 512 languages.
MERKLE = f"""WITH leaves AS (SELECT doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS tree,
        {_leaf('text')} AS hash,
        CASE WHEN {_CRC32} % 3 = 0 THEN {_leaf(_LOWER.format('text'))} END AS claimed FROM documents),
t0 AS (SELECT tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, hash) - 1 AS place,
        count(*) OVER (PARTITION BY tree) AS size, doc_id, hash, coalesce(claimed, hash) AS now FROM leaves),
{_tree('t', 7)},
f0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS size, tree AS id, hash,
        hash AS now FROM t7),
{_tree('f', 3)}
SELECT t0.doc_id, t0.hash AS leaf, f0.hash AS subroot, f3.hash AS root, sha256(tp6.proof || fp2.proof) AS proof_sha256,
       g.now AS folded_root, g.now = f3.hash AS verified
FROM t0 JOIN tp6 ON t0.tree = tp6.tree AND t0.place = tp6.leaf
JOIN f0 ON f0.id = t0.tree JOIN fp2 ON fp2.leaf = f0.place CROSS JOIN f3
JOIN (SELECT c.tree AS id, c.leaf, CASE WHEN s2.size = 1 THEN n1 ELSE sha256(s2.lefts || n1 || s2.rights) END AS now
      FROM (SELECT c.*, CASE WHEN s1.size = 1 THEN n0 ELSE sha256(s1.lefts || n0 || s1.rights) END AS n1
            FROM (SELECT tp6.tree, tp6.leaf, f0.place AS tree_at,
                         CASE WHEN s0.size = 1 THEN tp6.now ELSE sha256(s0.lefts || tp6.now || s0.rights) END AS n0
                  FROM tp6 JOIN f0 ON f0.id = tp6.tree JOIN fs0 s0 ON s0.place = f0.place) c
            JOIN fs1 s1 ON s1.place = tree_at // 8) c
      JOIN fs2 s2 ON s2.place = tree_at // 64) g ON g.id = t0.tree AND g.leaf = t0.place"""

COLLOCATIONS = f"""WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
        {_LOWER.format("coalesce(text, '')")} AS t FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM d),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda s: array_to_string(w[s:s + k - 1], ' '))) AS phrase
      FROM p, range(1, 4) r(k)),
f AS (SELECT lang, k, phrase, count(*) AS f, string_split(phrase, ' ') AS w FROM g GROUP BY lang, k, phrase),
tot AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
big AS (SELECT * FROM f WHERE f >= 10),
cuts AS (SELECT c.lang, c.k, c.phrase, c.w, c.f AS a, l.f AS l, r.f AS r, l.k AS cut,
                CAST((1000000::HUGEINT * c.f * c.f) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
         FROM (SELECT *, unnest(range(1, k)) AS cut FROM big WHERE k > 1) c
         JOIN big l ON l.lang = c.lang AND l.k = c.cut AND l.phrase = array_to_string(c.w[1:c.cut], ' ')
         JOIN big r ON r.lang = c.lang AND r.k = c.k - c.cut AND r.phrase = array_to_string(c.w[c.cut + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase, k ORDER BY score, cut) = 1),
cover AS (SELECT lang, part, max(f) AS f FROM (
            SELECT lang, f, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part FROM big WHERE k = 3)
          GROUP BY lang, part),
kept AS (SELECT best.* FROM best LEFT JOIN cover ON cover.lang = best.lang AND best.k = 2 AND cover.part = best.phrase
         WHERE cover.f IS NULL OR 100 * cover.f < 50 * a),
ranks AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       n, score FROM ranks JOIN tot USING (lang) WHERE rank <= 2000"""

# Every pair compared: the index must find them all.
EMBEDDINGS = """WITH RECURSIVE v AS (SELECT row_number() OVER () AS rid, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS MATERIALIZED (SELECT * FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
       AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.rid AS a, b.rid AS b FROM ok a JOIN ok b ON a.rid <> b.rid
          WHERE CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) >= 0.95 ELSE false END),
reach AS (SELECT rid AS a, rid AS b FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT v.vec_id, CAST((SELECT count(*) FROM links WHERE links.a = v.rid) AS BIGINT) AS n_links, c.component_id,
       v.vec_id IS NOT DISTINCT FROM c.component_id AS kept
FROM v JOIN (SELECT reach.a AS rid, min(o.vec_id) AS component_id FROM reach JOIN v o ON o.rid = reach.b GROUP BY reach.a) c
     ON c.rid = v.rid"""


def oracle_sql() -> dict[str, str]:
    return {"op1_chat": CHAT, "op7_warc": WARC, "op8_decontaminate": DECONTAMINATE, "op11_merkle": MERKLE,
            "op12_collocations": COLLOCATIONS, "op13_embeddings": EMBEDDINGS}
