"""The queries' SQL, for DuckDB on the same tables.

Training, genetic packing, greedy slot maps and PageRank have none; tests
compare those with brute force.
"""

from __future__ import annotations

from quadspark.llm.repetition import LINE_CHARS_LIMIT, NGRAM_LIMITS

_WORDS = r"coalesce(regexp_extract_all({}, '[^\x20\x09-\x0D]+'), [])"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Component of every vertex, from tables ``vertices (id)`` and ``links (a, b)``.
_COMPONENTS = """
    reach(id, other) AS (
        SELECT id, id FROM vertices
        UNION
        SELECT r.id, l.b FROM reach r JOIN (SELECT a, b FROM links UNION ALL SELECT b, a FROM links) l ON r.other = l.a),
    components AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)"""

SUBSTRING = f"""
    WITH d AS (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents),
    starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50),
    windows AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS g FROM starts),
    earlier AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS least FROM windows),
    gone AS (SELECT DISTINCT doc_id, i + j AS p FROM earlier, range(50) AS t(j) WHERE least < doc_id),
    words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
    lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)"""

ARC = """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
    coded AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, array_to_string(list_transform(range(32), lambda
        k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            1 + ((('0x' || substr(hex, 1 + 10 * (k // 8), 10))::BIGINT >> (35 - 5 * (k % 8))) & 31)::INT, 1)), '') AS payload_digest
        FROM p),
    same AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM coded)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
        CASE WHEN page_id <> last THEN last END AS refers_to
    FROM same"""

ROTATION = f"""
    WITH RECURSIVE good AS (
        SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    vertices AS (SELECT vec_id AS id FROM good),
    links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y
        ON x.label = y.label AND len(x.v) = len(y.v) AND x.vec_id < y.vec_id
        WHERE list_cosine_similarity(x.v, y.v) >= 0.98),
    {_COMPONENTS},
    degrees AS (SELECT id, count(*) AS n FROM (SELECT a AS id FROM links UNION ALL SELECT b FROM links) GROUP BY id)
    SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
        coalesce(component_id, vec_id) IS NOT DISTINCT FROM vec_id AS kept
    FROM embeddings LEFT JOIN degrees ON vec_id = degrees.id LEFT JOIN components ON vec_id = components.id"""

FOREST = f"""
    WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
    shingles AS (
        SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM shingles x JOIN shingles y
        ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
    links AS (SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
        WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)),
    vertices AS (SELECT doc_id AS id FROM d),
    {_COMPONENTS}
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
    FROM d JOIN components ON d.doc_id = id LEFT JOIN sizes ON d.doc_id = sizes.doc_id"""


def _covered(n: int) -> str:
    """Words inside n-grams that a document has twice or more, and characters inside those it has earlier."""
    return f"""
    grams{n} AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS times,
            row_number() OVER (PARTITION BY doc_id, g ORDER BY i) AS k
        FROM (SELECT doc_id, i, array_to_string(w[i:i + {n - 1}], ' ') AS g
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - {n - 2})) AS i FROM d WHERE len(w) >= {n}))),
    inside{n} AS (SELECT doc_id, count(*) AS words, sum(length(w[p])) FILTER (later) AS chars
        FROM (SELECT doc_id, i + j AS p, bool_or(k > 1) AS later FROM grams{n}, range({n}) AS t(j) WHERE times > 1 GROUP BY ALL)
        JOIN d USING (doc_id) GROUP BY doc_id)"""


REPETITION = f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS.format('text')} AS w FROM documents),
    {','.join(map(_covered, NGRAM_LIMITS))},
    lines AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line) AS k
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
        WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
    repeats AS (SELECT doc_id, sum(length(line)) AS chars, count(*) FILTER (k > 1) AS again,
        sum(length(line)) FILTER (k > 1) AS again_chars FROM lines GROUP BY doc_id),
    found AS (SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(again, 0) AS n_dup_lines,
        coalesce(inside5.words, 0) AS n_repeat_words,
        {' AND '.join(f'coalesce(inside{n}.chars, 0) <= {limit} * word_chars' for n, limit in NGRAM_LIMITS.items())}
        AND coalesce(again_chars, 0) <= {LINE_CHARS_LIMIT} * coalesce(repeats.chars, 0) AS passed
        FROM d {' '.join(f'LEFT JOIN inside{n} USING (doc_id)' for n in NGRAM_LIMITS)} LEFT JOIN repeats USING (doc_id))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
        n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
        NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND passed AS kept
    FROM found"""

MIXING = f"""
    WITH d AS (SELECT doc_id, source, len({_WORDS.format('text')}) AS size,
        md5('0:' || doc_id::VARCHAR || ':' || coalesce(length(text), 0)::VARCHAR) AS digest,
        md5(coalesce(text, '')) AS text_digest FROM documents),
    sources AS (SELECT source, sum(size)::BIGINT AS source_size,
        [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM d GROUP BY source),
    filled AS (SELECT *, 2.0 * source_size AS most,
        (1.5 * sum(source_size) OVER () - coalesce(sum(2.0 * source_size) OVER before, 0)) / sum(weight) OVER here AS unit
        FROM sources WINDOW
            before AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
            here AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
    targets AS (SELECT source, source_size, round(least(most, weight * (SELECT max(unit) FROM filled)), 6) AS target FROM filled),
    placed AS (SELECT d.*, source_size, target, round(target) AS flow,
        sum(size) OVER (PARTITION BY d.source ORDER BY digest, doc_id, text_digest ROWS UNBOUNDED PRECEDING) - size AS place
        FROM d JOIN targets ON d.source IS NOT DISTINCT FROM targets.source)
    SELECT doc_id, size, source_size, target, (greatest(0, least(flow, place + size) - place)
        + greatest(0, least(flow, source_size + place + size) - source_size - place))::BIGINT AS taken
    FROM placed"""

def _field(name: str, value: str | None = None) -> str:
    text = f"({value or name})::VARCHAR"
    return f"CASE WHEN {name} IS NULL THEN '-' ELSE octet_length(encode({text})) || ':' || {text} END"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', 'n_chars')))} || {_field('text', text)})"


#: crc32 as DuckDB has none: eight shifts for each byte of a decimal number.
_CRC = """list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda r, byte: list_reduce(list_prepend(xor(r, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda x, none: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))"""

MANIFEST = f"""
    WITH RECURSIVE leaves AS (
        SELECT doc_id, coalesce('+' || source, '') AS tree, {_leaf('text')} AS leaf,
            CASE WHEN xor({_CRC}, 4294967295) % 5 = 0 THEN {_leaf(_LOWER)} ELSE {_leaf('text')} END AS claim
        FROM documents),
    placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
        count(*) OVER (PARTITION BY tree) AS n FROM leaves),
    nodes AS (
        SELECT tree, 0 AS level, pos, n, leaf AS digest FROM placed
        UNION ALL
        SELECT tree, level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos))
        FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 16, n),
    subroots AS (SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
    upper AS (
        SELECT 0 AS level, pos, n, digest FROM subroots
        UNION ALL
        SELECT level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos))
        FROM upper WHERE n > 1 GROUP BY level, pos // 16, n),
    heights AS (SELECT tree, max(level) AS height FROM nodes GROUP BY tree),
    runs AS (
        SELECT tree, level, pos // 16 AS run, list(digest ORDER BY pos) AS members FROM nodes WHERE n > 1 GROUP BY ALL
        UNION ALL
        SELECT h.tree, h.height + u.level, u.run, u.members FROM heights h,
            (SELECT level, pos // 16 AS run, list(digest ORDER BY pos) AS members FROM upper WHERE n > 1 GROUP BY ALL) u),
    tops AS (SELECT s.tree, height, s.pos, digest AS subroot FROM subroots s JOIN heights USING (tree)),
    steps AS (
        SELECT p.doc_id, p.tree, p.pos AS leaf_pos, 0 AS level, CASE WHEN height = 0 THEN t.pos ELSE p.pos END AS pos,
            claim AS value, '' AS proof FROM placed p JOIN tops t USING (tree)
        UNION ALL
        SELECT s.doc_id, s.tree, s.leaf_pos, s.level + 1,
            CASE WHEN s.level + 1 = t.height THEN t.pos ELSE s.pos // 16 END,
            sha256(array_to_string(r.members[:s.pos % 16], '') || s.value || array_to_string(r.members[s.pos % 16 + 2:], '')),
            s.proof || array_to_string(r.members[:s.pos % 16], '') || array_to_string(r.members[s.pos % 16 + 2:], '')
        FROM steps s JOIN tops t USING (tree) JOIN runs r ON r.tree = s.tree AND r.level = s.level AND r.run = s.pos // 16),
    ends AS (SELECT tree, leaf_pos, max_by(value, level) AS value, max_by(proof, level) AS proof FROM steps GROUP BY ALL),
    root AS (SELECT digest AS root FROM upper WHERE n = 1)
    SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, value AS folded_root, value = root AS verified
    FROM placed p JOIN ends e ON p.tree = e.tree AND p.pos = e.leaf_pos JOIN tops t ON t.tree = p.tree, root"""

INFILL = """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
        sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS hex FROM documents),
    draws AS (SELECT *, len(u) AS n, list_transform(range(4), lambda k: ('0x' || hex[8 * k + 1:8 * k + 8])::BIGINT) AS h FROM d),
    cuts AS (SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS low, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS high,
        CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
            WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM draws),
    parts AS (SELECT *, array_to_string(u[:low], '') AS p, array_to_string(u[low + 1:high], '') AS m,
        array_to_string(u[high + 1:], '') AS s FROM cuts)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
        CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
            ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
        sha256(text) AS restored_sha256
    FROM parts"""

SQL = {
    "op1_substring_dedup": SUBSTRING,
    "op3_arc_to_warc": ARC,
    "op4_rotated_codes": ROTATION,
    "op6_minhash_forest": FOREST,
    "op9_repetition": REPETITION,
    "op10_flow_mixing": MIXING,
    "op11_merkle_manifest": MANIFEST,
    "op13_fill_in_middle": INFILL,
}
