"""DuckDB SQL for the registered queries that SQL can express; the others are tested against brute force."""

from __future__ import annotations

from .quality import STOP_WORDS

_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)



def _record(text: str) -> str:
    """SHA-256 of a document's fields, each with its length before it."""
    field = lambda x: f"CASE WHEN {x} IS NULL THEN '-' ELSE octet_length(encode({x}::VARCHAR)) || ':' || {x}::VARCHAR END"
    return "sha256(" + " || ".join(field(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL = {
    "op1_substring_dedup": r"""
        WITH d AS (
          SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        win AS (
          SELECT doc_id, i, w[i:i + 12] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
        first AS (SELECT g, min(doc_id) AS m FROM win GROUP BY g),
        gone AS (
          SELECT DISTINCT doc_id, i + j AS p
          FROM (SELECT win.doc_id, i FROM win JOIN first USING (g) WHERE m < win.doc_id), range(13) r(j)),
        word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
        kept AS (
          SELECT word.doc_id, count(gone.p) AS n_removed,
                 coalesce(string_agg(x, ' ' ORDER BY word.p) FILTER (WHERE gone.p IS NULL), '') AS kept
          FROM word LEFT JOIN gone USING (doc_id, p) GROUP BY word.doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)""",
    "op3_chat_format": """
        WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
        conv AS (
          SELECT conv_id, count(*) AS n,
                 list({'r': role, 't': text} ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS s
          FROM t GROUP BY conv_id),
        one AS (SELECT s, n, min(conv_id) AS conv_id, count(*) AS n_copies FROM conv GROUP BY s, n),
        top AS (SELECT * FROM one a WHERE NOT EXISTS (
          SELECT 1 FROM one b WHERE b.s[1] = a.s[1] AND b.n > a.n AND b.s[1:a.n] = a.s))
        SELECT conv_id, n AS n_turns, n_copies,
               list_aggregate(list_transform(s, lambda x: '<|im_start|>'
                 || replace(replace(coalesce(x.r, 'unknown'), '<|im_start|>', ''), '<|im_end|>', '') || chr(10)
                 || replace(replace(coalesce(x.t, ''), '<|im_start|>', ''), '<|im_end|>', '')
                 || '<|im_end|>' || chr(10)), 'string_agg', '') AS rendered
        FROM top""",
    "op7_quality_rules": rf"""
        WITH d AS (
          SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                 list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
          FROM documents),
        win AS (
          SELECT doc_id, i, w[i:i + 4] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
        again AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
        rep AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM again, range(5) r(j) GROUP BY doc_id),
        c AS (
          SELECT doc_id, len(w)::BIGINT AS n_words,
                 coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
                 len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
                 (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
                 coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
                 len(l)::BIGINT AS n_lines,
                 len(list_filter(w, lambda x: lower(x) IN ({_STOP})))::BIGINT AS n_stop_words
          FROM d LEFT JOIN rep USING (doc_id)),
        b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c)
        SELECT *, NOT base_failed AND word_chars / greatest(n_words, 1) BETWEEN 2 AND 14
                  AND n_symbols / greatest(n_words, 1) <= 0.1 AND (n_words < 60 OR n_stop_words / n_words >= 0.03)
                  AND n_dup_lines / greatest(n_lines, 1) <= 0.4 AS kept
        FROM b""",
    "op9_exact_top_k": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
          SELECT q.vec_id AS query_id, c.vec_id,
                 list_inner_product(q.e::DOUBLE[], c.e::DOUBLE[])::BIGINT AS score
          FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
        SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
        FROM s QUALIFY rank <= 20""",
    "op12_merkle_manifest": f"""
        WITH RECURSIVE c AS (
          SELECT *, xor(list_reduce(
                   list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
                   lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                     lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) AS crc
          FROM documents),
        h AS (
          SELECT doc_id, lang, {_record("text")} AS leaf,
                 CASE WHEN crc % 3 = 0 THEN {_record(_LOWER)} END AS other
          FROM c),
        d AS (
          SELECT doc_id, leaf, other, dense_rank() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS tree,
                 row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
          FROM h),
        up AS (
          SELECT 0 AS level, tree, pos, leaf AS hash FROM d
          UNION ALL
          SELECT any_value(level) + 1, tree, pos // 8, sha256(string_agg(hash, '' ORDER BY pos))
          FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM up) WHERE n > 1 GROUP BY tree, pos // 8),
        sub AS (SELECT tree, max(level) AS height, arg_max(hash, level) AS subroot FROM up GROUP BY tree),
        top AS (
          SELECT 0 AS level, tree AS pos, subroot AS hash FROM sub
          UNION ALL
          SELECT any_value(level) + 1, pos // 8, sha256(string_agg(hash, '' ORDER BY pos))
          FROM (SELECT *, count(*) OVER () AS n FROM top) WHERE n > 1 GROUP BY pos // 8),
        root AS (SELECT max(level) AS height, arg_max(hash, level) AS root FROM top),
        run AS (
          SELECT level, tree, pos // 8 AS up, list(hash ORDER BY pos) AS hs FROM up GROUP BY level, tree, pos // 8
          UNION ALL SELECT level, -1, pos // 8, list(hash ORDER BY pos) FROM top GROUP BY level, pos // 8),
        way AS (
          SELECT tree, pos, unnest(range(height)) AS level, tree AS in_tree, pos AS place, 0 AS upper FROM d JOIN sub USING (tree)
          UNION ALL SELECT tree, pos, unnest(range(height)), -1, tree, 1 FROM d, root),
        step AS (
          SELECT w.tree, w.pos, w.upper, w.level,
                 array_to_string(list_concat(hs[:i], ['*'], hs[i + 2:]), '') AS s
          FROM (SELECT *, (place // (8 ** level)::BIGINT) % 8 AS i, place // (8 ** (level + 1))::BIGINT AS up FROM way) w
          JOIN run ON run.tree = w.in_tree AND run.level = w.level AND run.up = w.up),
        steps AS (SELECT tree, pos, list(s ORDER BY upper, level) AS ss FROM step GROUP BY tree, pos),
        made AS (
          SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(coalesce(ss, []), ''), '*', '')) AS proof_sha256,
                 list_reduce(list_prepend(coalesce(other, leaf), coalesce(ss, [])), lambda cur, s: sha256(replace(s, '*', cur))) AS folded_root
          FROM d JOIN sub USING (tree) LEFT JOIN steps USING (tree, pos), root)
        SELECT *, folded_root = root AS verified FROM made""",
}
