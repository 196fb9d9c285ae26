"""DuckDB SQL of the queries that SQL can express, written from their
contracts alone."""

#: crc32(decimal x) by the bitwise definition (polynomial 0xEDB88320).
CRC32 = """
xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [1::BIGINT, 1, 1, 1, 1, 1, 1, 1]),
        lambda x, one: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""

OP11 = r"""
WITH d AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
tf AS (SELECT doc_id, term, count(*) AS tf FROM d WHERE term IN (SELECT term FROM q) GROUP BY ALL),
stats AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM n),
w AS (SELECT term, floor(1000 * ln((2 * (SELECT docs FROM stats) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf GROUP BY term),
m AS (SELECT doc_id, 10 + (90 * n * docs) // total AS m FROM n, stats),
scored AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
           FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

OP12 = r"""
WITH own AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p,
                    coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, """ + CRC32.format("conv_id") + r""" % 4 AS h FROM (SELECT DISTINCT conv_id FROM own)),
parts AS (SELECT c.conv_id, 0 AS part, p, role, text FROM c JOIN own ON own.conv_id = c.conv_id - c.conv_id % 20 AND p <= h
          UNION ALL SELECT c.conv_id, 1, p, role, text FROM c JOIN own USING (conv_id) WHERE p > h),
turns AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, p) AS p,
                 md5(length(role) || ':' || role || text) AS turn,
                 len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM parts),
prefixes AS (SELECT conv_id, p AS depth, words, list(turn) OVER (PARTITION BY conv_id ORDER BY p) AS path FROM turns
             UNION ALL SELECT conv_id, 0, 0, []::VARCHAR[] FROM c),
ends AS (SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends
         FROM (SELECT conv_id, arg_max(path, depth) AS path FROM prefixes GROUP BY conv_id) GROUP BY path),
nodes AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n, max(words) AS words FROM prefixes GROUP BY path, depth),
children AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
full_nodes AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (path)),
below AS (SELECT unnest(list_transform(range(depth + 1), lambda k: path[1:k])) AS path,
                 CASE WHEN n_children = 0 THEN 1 ELSE 0 END AS leaf, (n - 1) * words AS saved FROM full_nodes),
sums AS (SELECT path, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens FROM below GROUP BY path)
SELECT x.conv_id, x.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, x.n AS n_convs, x.n_children::BIGINT AS n_children,
       n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM full_nodes x JOIN sums USING (path) LEFT JOIN ends USING (path)
LEFT JOIN nodes up ON x.depth > 0 AND up.path = x.path[1:x.depth - 1]
"""

LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: smallest reachable node of ``nodes(id)`` over ``links(a, b)`` (both directions)
COMPONENTS = """
reach(id, node) AS (SELECT id, id FROM nodes UNION SELECT reach.id, links.b FROM reach JOIN links ON links.a = reach.node),
component AS (SELECT id, min(node) AS component_id FROM reach GROUP BY id)"""

OP3 = """
WITH RECURSIVE v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS e, coalesce(len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false) AS ok
    FROM embeddings),
nodes AS (SELECT id FROM v),
links AS (SELECT x.id AS a, y.id AS b FROM v x JOIN v y ON x.ok AND y.ok AND x.id <> y.id AND len(x.e) = len(y.e)
          WHERE list_cosine_similarity(x.e, y.e) >= 0.95),""" + COMPONENTS + """
SELECT id AS vec_id, (SELECT count(*) FROM links WHERE a = id) AS n_links, component_id, component_id = id AS kept
FROM component
"""

OP4 = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(""" + LOWER.format("text") + r""", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(""" + LOWER.format("text") + r""", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
items AS (SELECT item_id, w, least(len(w), 10) AS n FROM i WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS win FROM items, unnest(range(1, len(w) - n + 2)) r(p)),
grams AS (SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS win
          FROM d, (SELECT DISTINCT n FROM windows), unnest(range(1, len(w) - n + 2)) r(p)),
found AS (SELECT doc_id, p, n, item_id FROM grams JOIN windows USING (n, win)),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM found, unnest(range(p, p + n)) r(k) GROUP BY doc_id),
holds AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS items_sha256
          FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN holds USING (doc_id)
"""

OP7 = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, n, role, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) x(n, role)),
c AS (SELECT conv_id, count(*) AS n_turns,
             string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
             coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS learned,
             string_agg('<|im_start|>' || replace(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'), chr(10), '<|nl|>') || chr(10)
                        || regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') || '<|im_end|>' || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS formatted,
             string_agg(role || ',', '' ORDER BY turn NULLS FIRST, role, text) AS roles
      FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256,
       length(formatted) AS formatted_chars, regexp_full_match(roles, '(system,)?(user,assistant,)+') AS valid
FROM c
"""

OP8 = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all(""" + LOWER.format("text") + r""", '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 3], ' ') AS shingle FROM d, unnest(range(1, greatest(len(w) - 2, 2))) r(p) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
k AS (SELECT shingle, row_number() OVER () AS k FROM s GROUP BY shingle HAVING count(*) > 1),
ks AS (SELECT doc_id, k FROM s JOIN k USING (shingle)),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM ks x JOIN ks y USING (k) WHERE x.doc_id < y.doc_id GROUP BY ALL),
close AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
links AS (SELECT a, b FROM close UNION ALL SELECT b, a FROM close),
nodes AS (SELECT doc_id AS id FROM documents),""" + COMPONENTS + """
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM documents JOIN component ON id = doc_id LEFT JOIN n USING (doc_id)
"""

#: for pages without canonical or refresh tags, as the given ones are: without links only rules decide
OP10 = r"""
WITH p AS (SELECT page_id, coalesce(""" + LOWER.format(r"regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)") + r""", '') AS host,
                  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r(h, start, act) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                     ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fits AS (SELECT page_id, arg_max(h || start, length(h || start)) AS rule, arg_max(act, length(h || start)) AS act
         FROM p JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, start) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(act, 'allow') AS verdict FROM p LEFT JOIN fits USING (page_id)
"""

ORACLE = {"op3_embedding_dedup": OP3, "op4_decontamination": OP4, "op7_chat": OP7, "op8_ngram_join": OP8, "op10_url_filter": OP10,
          "op11_lexical_search": OP11, "op12_prefix_trie": OP12}
