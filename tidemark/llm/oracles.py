"""DuckDB SQL for the operators that SQL can express, over the same tables."""

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"

LINE_DEDUP = f"""
WITH lines AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), placed AS (
    SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos FROM lines
), keyed AS (
    SELECT *, {_LOWER.format(f"trim(line, {_BLANKS})")} AS key FROM placed
), common AS (
    SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10
    GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), judged AS (
    SELECT k.doc_id, line, pos, c.key IS NOT NULL AND k.doc_id <> c.keeper AS dropped
    FROM keyed k LEFT JOIN common c ON k.key = c.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

SOURCE_MIX = f"""
WITH rows AS (
    SELECT doc_id, source, len({_WORDS.format("text")}) AS size,
           1 - CAST(0.9 AS DOUBLE) * (length(coalesce(text, '')) - length(translate(coalesce(text, ''), '#*$%&|<>', ''))) / greatest(length(coalesce(text, '')), 1) AS weight,
           md5('mix:' || coalesce(CAST(doc_id AS VARCHAR) || ':', '') || md5(coalesce(text, ''))) AS digest
    FROM documents
), keyed AS (
    SELECT *, -ln((CAST(CAST('0x' || substr(digest, 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0) / weight AS key FROM rows
), sizes AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS w
    FROM keyed GROUP BY source
), levels AS (
    SELECT *, 3 * source_size / w AS ratio, sum(source_size) OVER () AS total,
           coalesce(sum(3 * source_size) OVER before, 0) AS stopped, sum(w) OVER onward AS weights
    FROM sizes
    WINDOW before AS (ORDER BY 3 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
           onward AS (ORDER BY 3 * source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), free AS (
    SELECT *, CAST(total - stopped AS DOUBLE) / weights AS level, ratio > CAST(total - stopped AS DOUBLE) / weights AS is_free FROM levels
), targets AS (
    SELECT source, source_size,
           CASE WHEN is_free THEN w * (SELECT arg_min(level, ratio) FROM free WHERE is_free) ELSE CAST(3 * source_size AS DOUBLE) END AS target
    FROM free
), budgets AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM targets
), running AS (
    SELECT k.doc_id, k.size, b.source_size, b.target, b.epochs, CAST(round(b.target - b.epochs * b.source_size) AS BIGINT) AS budget,
           coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM keyed k JOIN budgets b ON k.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, budget - before)) AS BIGINT) AS taken
FROM running
"""

_ITEM_WORDS = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(_LOWER.format("coalesce(text, '')"))

DECONTAMINATION = f"""
WITH docs AS (SELECT doc_id, {_ITEM_WORDS} AS words FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ITEM_WORDS} AS words FROM benchmark),
windows AS (
    SELECT DISTINCT item, least(10, len(words)) AS size, unnest(list_transform(range(len(words) - least(10, len(words)) + 1),
           lambda i: array_to_string(words[i + 1:i + least(10, len(words))], ' '))) AS phrase
    FROM items WHERE len(words) > 0
), sizes AS (SELECT DISTINCT size FROM windows),
grams AS (
    SELECT doc_id, size, unnest(range(len(words) - size + 1)) AS pos,
           unnest(list_transform(range(len(words) - size + 1), lambda i: array_to_string(words[i + 1:i + size], ' '))) AS phrase
    FROM docs, sizes WHERE len(words) >= size
), found AS (SELECT doc_id, pos, size, item FROM grams JOIN windows USING (size, phrase)),
hit AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS word FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM found GROUP BY doc_id)
SELECT d.doc_id, len(d.words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

SHARDING = """
WITH RECURSIVE bits(n, c, step) AS (
    SELECT range, CAST(range AS BIGINT), 0 FROM range(256)
    UNION ALL
    SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1 FROM bits WHERE step < 8
), lookup AS (SELECT list(c ORDER BY n) AS tab FROM bits WHERE step = 8),
summed AS (
    SELECT doc_id, strlen(coalesce(text, '')) + 16 AS size,
           xor(list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda p: CAST('0x' || p AS BIGINT)),
                           lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) AS text_crc32
    FROM documents, lookup
), rows AS (
    SELECT *, CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || text_crc32 || ':' || size), 1, 12) AS BIGINT) % 4096 AS INTEGER) AS virtual_slot
    FROM summed
), slots AS (
    SELECT virtual_slot, CAST(sum(size) AS BIGINT) AS bytes, row_number() OVER (ORDER BY sum(size) DESC, virtual_slot) AS turn FROM rows GROUP BY virtual_slot
), dealt(turn, virtual_slot, shard, loads) AS (
    SELECT CAST(0 AS BIGINT), -1, -1, list_transform(range(40), lambda i: CAST(0 AS BIGINT))
    UNION ALL
    SELECT s.turn, s.virtual_slot, list_position(d.loads, list_min(d.loads)) - 1,
           list_transform(d.loads, lambda x, i: CASE WHEN i = list_position(d.loads, list_min(d.loads)) THEN x + s.bytes ELSE x END)
    FROM dealt d JOIN slots s ON s.turn = d.turn + 1
)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY r.virtual_slot, doc_id, text_crc32, size) - 1 AS slot,
       CAST(NULL AS INTEGER) AS grown_shard, r.virtual_slot, 0 AS map_version,
       CAST(CASE WHEN given * 41 <= held THEN 40 ELSE shard END AS INTEGER) AS next_shard, 1 AS next_version
FROM rows r JOIN (
    SELECT d.virtual_slot, shard, sum(bytes) OVER (PARTITION BY shard ORDER BY bytes, d.virtual_slot ROWS UNBOUNDED PRECEDING) AS given, sum(bytes) OVER (PARTITION BY shard) AS held
    FROM dealt d JOIN slots s ON d.virtual_slot = s.virtual_slot WHERE d.turn > 0
) m ON r.virtual_slot = m.virtual_slot
"""

QUALITY_RULES = f"""
WITH docs AS (
    SELECT doc_id, coalesce(text, '') AS text, {_WORDS.format("text")} AS words, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), line_counts AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM (SELECT doc_id, unnest(lines) AS line FROM docs) WHERE trim(line, {_BLANKS}) <> '' GROUP BY doc_id
), windows AS (
    SELECT doc_id, unnest(range(len(words) - 7)) AS pos, unnest(list_transform(range(len(words) - 7), lambda i: array_to_string(words[i + 1:i + 8], ' '))) AS phrase
    FROM docs WHERE len(words) >= 8
), twice AS (SELECT doc_id, pos FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, phrase) > 1),
repeats AS (SELECT doc_id, count(DISTINCT word) AS n_repeat_words FROM (SELECT doc_id, unnest(range(pos, pos + 8)) AS word FROM twice) GROUP BY doc_id),
measured AS (
    SELECT d.doc_id, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS word_chars,
           length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words, len(lines) AS n_lines, len(list_filter(words, lambda w: ends_with(w, '!'))) AS shouted,
           len(list_filter(range(1, len(words)), lambda i: words[i] = words[i + 1])) AS stuttered
    FROM docs d LEFT JOIN line_counts USING (doc_id) LEFT JOIN repeats USING (doc_id)
), judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 3 * n_symbols > n_words OR 2 * n_dup_lines > n_lines OR 2 * shouted > n_words
            OR 2 * stuttered > n_words OR word_chars > 25 * greatest(n_words, 1)) AS kept
FROM judged
"""

_ESCAPED = r"regexp_replace({0}, '<(\\*)\|', '<\1\\|', 'g')"

CHAT_FORMAT = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(24 + length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")})) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

HARD_NEGATIVES = """
WITH known AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same, a.vec_id = r.vec_id AS itself, CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
    FROM known a, known r WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same AND NOT itself
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), ranked AS (
    SELECT p.*, id AS negative_id, score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS rank
    FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""

_FIELD = "coalesce(CAST(strlen(CAST({0} AS VARCHAR)) AS VARCHAR) || ':' || CAST({0} AS VARCHAR), '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{0}")) + ")"

# Trees of sources and then the tree of their roots, the latter's levels behind all of the former.
MERKLE = f"""
WITH RECURSIVE bits(n, c, step) AS (
    SELECT range, CAST(range AS BIGINT), 0 FROM range(256)
    UNION ALL
    SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1 FROM bits WHERE step < 8
), crc AS (SELECT list(c ORDER BY n) AS tab FROM bits WHERE step = 8),
docs AS (
    SELECT *, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(CAST(doc_id AS VARCHAR))), '..'), lambda p: CAST('0x' || p AS BIGINT)),
                  lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % 2 = 0 AS hit
    FROM documents, crc
), leaves AS (
    SELECT doc_id, {_LEAF.format("text")} AS leaf, {_LEAF.format("(CASE WHEN hit THEN replace(text, chr(10), '') ELSE text END)")} AS present,
           dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS src
    FROM docs
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY src ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY src) AS n FROM leaves
), tree(src, level, pos, n, h) AS (
    SELECT src, 0, pos, n, leaf FROM placed
    UNION ALL
    SELECT src, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM tree WHERE n > 1 GROUP BY src, level, pos // 3, (n + 2) // 3
), subroots AS (SELECT src, h, max(src) OVER () + 1 AS n FROM tree WHERE n = 1),
top(level, pos, n, h) AS (
    SELECT 0, src, n, h FROM subroots
    UNION ALL
    SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY level, pos // 3, (n + 2) // 3
), runs AS (
    SELECT src, level, pos // 3 AS run, list(h ORDER BY pos) AS hs FROM tree WHERE n > 1 GROUP BY ALL
    UNION ALL
    SELECT -1, level, pos // 3, list(h ORDER BY pos) FROM top WHERE n > 1 GROUP BY ALL
), steps AS (
    SELECT p.src, p.pos, r.level AS step, r.hs, CAST(p.pos // CAST(pow(3, r.level) AS BIGINT) % 3 AS INTEGER) AS slot
    FROM placed p JOIN runs r ON r.src = p.src AND r.run = p.pos // CAST(pow(3, r.level + 1) AS BIGINT)
    UNION ALL
    SELECT p.src, p.pos, 1000 + r.level, r.hs, CAST(p.src // CAST(pow(3, r.level) AS BIGINT) % 3 AS INTEGER)
    FROM placed p JOIN runs r ON r.src = -1 AND r.run = p.src // CAST(pow(3, r.level + 1) AS BIGINT)
), sides AS (
    SELECT src, pos, list([array_to_string(hs[1:slot], ''), array_to_string(hs[slot + 2:], '')] ORDER BY step) AS path FROM steps GROUP BY src, pos
), folds(src, pos, k, own) AS (
    SELECT src, pos, 0, present FROM placed
    UNION ALL
    SELECT f.src, f.pos, k + 1, sha256(path[k + 1][1] || own || path[k + 1][2]) FROM folds f JOIN sides s ON f.src = s.src AND f.pos = s.pos WHERE k < len(path)
)
SELECT doc_id, leaf, r.h AS subroot, t.h AS root, sha256(coalesce(array_to_string(list_transform(path, lambda x: x[1] || x[2]), ''), '')) AS proof_sha256,
       own AS folded_root, own = t.h AS verified
FROM placed p JOIN subroots r USING (src) JOIN top t ON t.n = 1 LEFT JOIN sides s ON p.src = s.src AND p.pos = s.pos
JOIN folds f ON f.src = p.src AND f.pos = p.pos AND f.k = coalesce(len(path), 0)
"""

_ASSIGN = """([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
# Matches with their places: what lies between them and they themselves take turns.
_FOUND = r"""
    SELECT doc_id, whole, 1 + coalesce(list_sum(list_transform(parts[1:nth], lambda p: length(p))), 0) + coalesce(list_sum(list_transform(found[1:nth - 1], lambda m: length(m))), 0) AS begin
    FROM (SELECT doc_id, found, parts, unnest(found) AS whole, unnest(range(1, len(found) + 1)) AS nth
          FROM (SELECT doc_id, regexp_extract_all(text, '{0}') AS found, string_split_regex(text, '{0}') AS parts FROM docs))
"""

SECRET_SCAN = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
assigned AS ({_FOUND.format(_ASSIGN)}), keyed AS ({_FOUND.format("AKIA[A-Z0-9]+")}), hexed AS ({_FOUND.format("[0-9a-f]+")}),
base AS (
    SELECT doc_id, 0 AS kind, begin - 1 AS s, begin - 1 + length(whole) AS e FROM assigned WHERE length(regexp_extract(whole, '{_ASSIGN}', 2)) >= 6
    UNION ALL SELECT doc_id, 1, begin - 1, begin - 1 + length(whole) FROM keyed WHERE length(whole) >= 20
    UNION ALL SELECT doc_id, 2, begin - 1, begin - 1 + length(whole) FROM hexed WHERE length(whole) >= 24
), candidates AS (
    SELECT doc_id, whole, begin FROM ({_FOUND.format("[A-Za-z0-9+/_=-]+")}) WHERE length(whole) >= 20
    AND NOT regexp_full_match(whole, '[+/_=-]*(?:[A-Za-z]+|[0-9]+)(?:[+/_=-]+(?:[A-Za-z]+|[0-9]+))*[+/_=-]*')
    AND NOT regexp_full_match(whole, '[0-9A-Fa-f]{{8}}(?:-[0-9A-Fa-f]{{4}}){{3}}-[0-9A-Fa-f]{{12}}')
    AND NOT regexp_full_match(whole, '(?:sha1|sha256|sha384|sha512|md5)[-_=].*')
), windows AS (
    SELECT doc_id, begin, k, substr(whole, CAST(k + 1 AS BIGINT), 20) AS win FROM (SELECT doc_id, begin, whole, unnest(range(length(whole) - 19)) AS k FROM candidates)
), costs AS (
    SELECT doc_id, begin, k, win, list_sum(list_transform(map_values(list_histogram), lambda c: CAST(round(c * log2(c) * 1048576) AS BIGINT))) AS cost
    FROM (SELECT *, list_aggregate(string_split(win, ''), 'histogram') AS list_histogram FROM windows)
), classed AS (
    SELECT *, CASE WHEN regexp_full_match(win, '[0-9]+') THEN 3 WHEN regexp_full_match(win, '[0-9a-f]+') THEN 4 WHEN regexp_full_match(win, '[0-9A-F]+') THEN 5
                   WHEN regexp_full_match(win, '[A-Za-z]+') THEN 6 ELSE 7 END AS kind
    FROM costs
), passing AS (
    SELECT doc_id, begin, kind, k FROM classed WHERE kind IN (4, 5) AND cost <= floor((log2(20) - 3.2) * 20 * 1048576) OR kind = 7 AND cost <= floor((log2(20) - 3.9) * 20 * 1048576)
), parted AS (
    SELECT *, CASE WHEN k <= lag(k) OVER (PARTITION BY doc_id, begin, kind ORDER BY k) + 20 THEN 0 ELSE 1 END AS fresh FROM passing
), numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, begin, kind ORDER BY k) AS span FROM parted),
random AS (SELECT doc_id, kind, begin - 1 + min(k) AS s, begin - 1 + max(k) + 20 AS e FROM numbered GROUP BY doc_id, begin, kind, span),
named AS (
    SELECT doc_id, kind, s, ['assign', 'access', 'hex', 'entropy_digits', 'entropy_lower_hex', 'entropy_upper_hex', 'entropy_letters', 'entropy_base64'][kind + 1] || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT) AS told
    FROM (SELECT * FROM base UNION ALL SELECT * FROM random)
), summed AS (
    SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
           string_agg(told, ',' ORDER BY s, kind) FILTER (kind < 3) AS base, string_agg(told, ',' ORDER BY s, kind) AS spans
    FROM named GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs d LEFT JOIN summed USING (doc_id)
"""

ORACLES = {
    "op1_line_dedup": LINE_DEDUP,
    "op2_source_mix": SOURCE_MIX,
    "op6_decontamination": DECONTAMINATION,
    "op7_sharding": SHARDING,
    "op9_quality_rules": QUALITY_RULES,
    "op10_chat_format": CHAT_FORMAT,
    "op11_hard_negatives": HARD_NEGATIVES,
    "op12_merkle_manifest": MERKLE,
    "op13_secret_scan": SECRET_SCAN,
}
