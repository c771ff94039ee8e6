"""The expected results of the queries that SQL can express, for DuckDB."""

WORD = r"[^\x20\x09-\x0D]+"

OP1 = rf"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size FROM documents
), by_source AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           CASE (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
    FROM sized GROUP BY source
), capped AS (
    SELECT *, 2 * source_size AS cap, sum(source_size) OVER () * 1.5::DOUBLE AS total, sum(weight) OVER () AS weights FROM by_source
), ranked AS (
    SELECT *, (total - coalesce(sum(cap) OVER w, 0)::DOUBLE) / (weights - coalesce(sum(weight) OVER w, 0))::DOUBLE AS per_weight,
           cap / weight AS pitch
    FROM capped
    WINDOW w AS (ORDER BY cap / weight, source IS NULL, encode(source) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
    SELECT source, source_size,
           coalesce(least(cap::DOUBLE, (SELECT arg_min(per_weight, pitch) FROM ranked WHERE cap > per_weight * weight) * weight), cap::DOUBLE) AS target
    FROM ranked
), budgets AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM targets
), placed AS (
    SELECT s.doc_id, s.size, b.source_size, b.target, b.epochs, floor(b.target - b.epochs * b.source_size)::BIGINT AS rest,
           coalesce(sum(s.size) OVER (
               PARTITION BY s.source ORDER BY md5(coalesce(s.doc_id::VARCHAR, '') || ':1'), s.doc_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, rest - before)))::BIGINT AS taken FROM placed
"""

OP3 = r"""
WITH turns AS (
    SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), written AS (
    SELECT *, role IS NOT DISTINCT FROM lag(role) OVER w AND row_number() OVER w > 1 AS joined, row_number() OVER w AS place
    FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), sized AS (
    SELECT *, length(text) + length(regexp_replace(text, '[^\\]', '', 'g'))
              + length(array_to_string(regexp_extract_all(text, '##+'), '')) - len(regexp_extract_all(text, '##+'))
              + len(regexp_extract_all(text, '</')) AS escaped,
           CASE WHEN joined THEN length('</part>') ELSE length('### : </turn>') + 1 + length(role) END AS marks
    FROM written
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(escaped + marks)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

OP7 = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(len(words), 10) AS size, array_to_string(words[i : i + least(len(words), 10) - 1], ' ') AS said
    FROM items, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS r(i) WHERE len(words) > 0
), spots AS (
    SELECT row, size, i, array_to_string(words[i : i + size - 1], ' ') AS said
    FROM docs, (SELECT DISTINCT size FROM windows), unnest(range(1, len(words) - size + 2)) AS r(i)
), found AS (SELECT row, size, i, item_id FROM spots JOIN windows USING (size, said)),
hits AS (
    SELECT row, count(DISTINCT i + k) AS n_hit FROM (SELECT DISTINCT row, size, i FROM found), unnest(range(size)) AS r(k) GROUP BY row
), named AS (
    SELECT row, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
    FROM (SELECT DISTINCT row, item_id::VARCHAR AS item FROM found) GROUP BY row
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (row) LEFT JOIN named USING (row)
"""

OP4 = """
WITH rows AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS vec FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
    SELECT q.vec_id AS query_id, r.vec_id, max(list_inner_product(q.vec, r.vec))::BIGINT AS score
    FROM rows q JOIN rows r ON q.vec_id <> r.vec_id AND len(q.vec) = len(r.vec)
    WHERE q.vec_id % 50 = 0 GROUP BY ALL
), ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

OP6 = r"""
WITH split AS (
    SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
), rules(rule_host, rule_path, verdict) AS (
    VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
)
SELECT page_id, host, path,
       (SELECT arg_max(rule_host || rule_path, length(rule_host || rule_path)) FROM rules
        WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS rule,
       coalesce((SELECT arg_max(verdict, length(rule_host || rule_path)) FROM rules
        WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)), 'allow') AS verdict
FROM split
"""

#: The checksum's table-free form: each byte of the digits, then its eight steps.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
        string_split(doc_id::VARCHAR, ''), lambda c: list_prepend(ascii(c)::BIGINT, [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))),
        lambda acc, x: CASE WHEN x >= 0 THEN xor(acc, x) ELSE xor(acc >> 1, (acc & 1) * 3988292384) END), 4294967295)"""


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::VARCHAR)) || ':' || {value}::VARCHAR, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(v) for v in ("doc_id", "source", "lang", n_chars, "text")) + ")"


_HALVED = """list_transform(range((len(nodes) + 1) // 2),
        lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))"""

OP11 = f"""
WITH RECURSIVE leaves AS MATERIALIZED (
    SELECT coalesce('=' || lang, '') AS key, doc_id, {_leaf("n_chars")} AS leaf,
           CASE WHEN {_CRC} % 7 = 0 THEN {_leaf("(n_chars::HUGEINT + 1)")} ELSE {_leaf("n_chars")} END AS claim
    FROM documents
), placed AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY encode(key) ORDER BY doc_id NULLS FIRST, leaf, claim) - 1 AS pos FROM leaves
), levels AS (
    SELECT key, 0 AS level, list(leaf ORDER BY pos) AS nodes FROM placed GROUP BY key
    UNION ALL
    SELECT key, level + 1, {_HALVED} FROM levels WHERE len(nodes) > 1
), subroots AS MATERIALIZED (
    SELECT key, nodes[1] AS subroot, level AS height, row_number() OVER (ORDER BY encode(key)) - 1 AS place
    FROM levels WHERE len(nodes) = 1
), tops AS (
    SELECT 0 AS level, list(subroot ORDER BY place) AS nodes FROM subroots
    UNION ALL
    SELECT level + 1, {_HALVED} FROM tops WHERE len(nodes) > 1
), steps AS (
    SELECT key, level, nodes, NULL::BIGINT AS place FROM levels WHERE len(nodes) > 1
    UNION ALL
    SELECT key, height + level, nodes, place >> level FROM subroots, tops WHERE len(nodes) > 1
), folded AS (
    SELECT key, doc_id, leaf, pos, 0 AS level, claim AS node, '' AS beside FROM placed
    UNION ALL
    SELECT f.key, doc_id, leaf, pos, f.level + 1,
           CASE WHEN coalesce(s.place, pos >> f.level) % 2 = 1 THEN sha256(nodes[coalesce(s.place, pos >> f.level)] || node)
                ELSE sha256(node || coalesce(nodes[coalesce(s.place, pos >> f.level) + 2], '')) END,
           beside || CASE WHEN coalesce(s.place, pos >> f.level) % 2 = 1 THEN nodes[coalesce(s.place, pos >> f.level)]
                ELSE coalesce(nodes[coalesce(s.place, pos >> f.level) + 2], '') END
    FROM folded f JOIN steps s ON s.key = f.key AND s.level = f.level
), root AS (SELECT nodes[1] AS root FROM tops WHERE len(nodes) = 1)
SELECT doc_id, leaf, subroot, root, sha256(beside) AS proof_sha256, node AS folded_root, node = root AS verified
FROM folded JOIN subroots USING (key), root
WHERE folded.level = height + (SELECT max(level) FROM tops)
"""

ORACLE = {"op11_merkle_manifest": OP11, "op1_mix_sources": OP1, "op3_chat_format": OP3, "op4_top_k": OP4, "op6_url_filter": OP6, "op7_decontaminate": OP7}
