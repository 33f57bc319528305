"""DuckDB SQL for the training-text queries that SQL can express, over whole tables."""

from __future__ import annotations

#: A Merkle tree a language and one over their roots, level by level; crc32 bit by bit.
MERKLE = """
WITH RECURSIVE
docs AS (
  SELECT *, row_number() OVER () AS row_no,
         CASE WHEN doc_id IS NOT NULL AND xor(list_reduce(
                list_prepend(4294967295::BIGINT, [ascii(c)::BIGINT for c in string_split(doc_id::VARCHAR, '')]),
                lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                                           lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) % 7 = 0
              THEN 1 ELSE 0 END AS more
  FROM documents
),
parts AS (
  SELECT row_no, doc_id, lang,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-')
           || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
         coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') AS chars,
         coalesce(strlen((n_chars::HUGEINT + more)::VARCHAR) || ':' || (n_chars::HUGEINT + more)::VARCHAR, '-') AS claimed_chars,
         coalesce(strlen(text) || ':' || text, '-') AS body
  FROM docs
),
leaves AS (
  SELECT row_no, doc_id, lang, sha256(head || chars || body) AS leaf, sha256(head || claimed_chars || body) AS claimed FROM parts
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS size
  FROM leaves
),
up(lang, lvl, pos, h, size) AS (
  SELECT lang, 0, pos, leaf, size FROM placed
  UNION ALL
  SELECT lang, lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (size + 1) // 2
  FROM up WHERE size > 1 GROUP BY lang, lvl, pos // 2, size
),
subroots AS (
  SELECT lang, h AS subroot, lvl AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS size
  FROM up WHERE size = 1
),
top(lvl, pos, h, size) AS (
  SELECT 0, pos, subroot, size FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (size + 1) // 2
  FROM top WHERE size > 1 GROUP BY lvl, pos // 2, size
),
root AS (SELECT h AS root FROM top WHERE size = 1),
steps AS (
  SELECT p.row_no, u.lvl AS lvl, (p.pos >> u.lvl) & 1 AS odd, s.h AS sibling
  FROM placed p
  JOIN up u ON u.lang IS NOT DISTINCT FROM p.lang AND u.size > 1 AND u.pos = p.pos >> u.lvl
  LEFT JOIN up s ON s.lang IS NOT DISTINCT FROM p.lang AND s.lvl = u.lvl AND s.pos = xor(u.pos, 1)
  UNION ALL
  SELECT p.row_no, r.height + t.lvl, (r.pos >> t.lvl) & 1, s.h
  FROM placed p
  JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang
  JOIN top t ON t.size > 1 AND t.pos = r.pos >> t.lvl
  LEFT JOIN top s ON s.lvl = t.lvl AND s.pos = xor(t.pos, 1)
),
paths AS (
  SELECT row_no, list(struct_pack(odd := odd, sibling := sibling) ORDER BY lvl) AS path,
         string_agg(sibling, '' ORDER BY lvl) AS siblings
  FROM steps GROUP BY row_no
),
folded(row_no, step, h, path) AS (
  SELECT p.row_no, 1, p.claimed, coalesce(q.path, []) FROM placed p LEFT JOIN paths q USING (row_no)
  UNION ALL
  SELECT row_no, step + 1,
         sha256(CASE WHEN path[step].sibling IS NULL THEN h WHEN path[step].odd = 1 THEN path[step].sibling || h
                     ELSE h || path[step].sibling END), path
  FROM folded WHERE step <= len(path)
)
SELECT p.doc_id, p.leaf, r.subroot, root.root, sha256(coalesce(q.siblings, '')) AS proof_sha256,
       f.h AS folded_root, f.h = root.root AS verified
FROM placed p
JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang
CROSS JOIN root
LEFT JOIN paths q USING (row_no)
JOIN folded f ON f.row_no = p.row_no AND f.step = len(f.path) + 1
"""

#: Masks of five filters, counted by part and summed along each of the 120 orders.
FILTER_AUDIT = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
),
failed AS (
  SELECT doc_id, part,
         CASE WHEN len(words) < 100 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask
  FROM words
),
marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
),
counts AS (
  SELECT f.part, f.mask, count(*) AS n, sum(coalesce(m.good, 0)) AS good, sum(coalesce(m.toxic, 0)) AS toxic
  FROM failed f LEFT JOIN marks m USING (doc_id) GROUP BY f.part, f.mask
),
letters(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
),
steps AS (
  SELECT o.filter_order, s.step, l.bit,
         coalesce((SELECT sum(x.bit) FROM letters x WHERE contains(left(o.filter_order, s.step - 1), x.letter)), 0)::BIGINT AS earlier
  FROM orders o, (SELECT unnest([1, 2, 3, 4, 5]) AS step) s, letters l
  WHERE l.letter = substring(o.filter_order, s.step, 1)
),
found AS (
  SELECT c.part, s.filter_order, s.step, s.bit,
         sum(CASE WHEN c.mask & (s.earlier | s.bit) = 0 THEN c.n ELSE 0 END) AS kept,
         sum(CASE WHEN c.mask & s.earlier = 0 AND c.mask & s.bit > 0 THEN c.n ELSE 0 END) AS removed,
         sum(CASE WHEN c.mask & s.earlier > 0 AND c.mask & s.bit > 0 THEN c.n ELSE 0 END) AS redundant,
         sum(CASE WHEN c.mask = s.bit THEN c.n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN c.mask & s.earlier = 0 AND c.mask & s.bit > 0 THEN c.good ELSE 0 END) AS good_lost,
         sum(CASE WHEN c.mask & s.earlier = 0 AND c.mask & s.bit > 0 THEN c.toxic ELSE 0 END) AS toxic_lost
  FROM counts c, steps s GROUP BY c.part, s.filter_order, s.step, s.bit
)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM found
"""


#: Windows of benchmark items against the windows of the same length of every text, word by word.
DECONTAMINATION = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_no, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
),
items AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
),
places AS (
  SELECT item_id, words, least(10, len(words)) AS n, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS begins
  FROM items WHERE len(words) > 0
),
patterns AS (SELECT DISTINCT item_id, n, array_to_string(words[begins:begins + n - 1], ' ') AS win FROM places),
sizes AS (SELECT DISTINCT n FROM patterns),
starts AS (
  SELECT d.row_no, d.words, s.n, unnest(range(1, len(d.words) - s.n + 2)) AS begins FROM docs d, sizes s WHERE len(d.words) >= s.n
),
windows AS (SELECT row_no, n, begins, array_to_string(words[begins:begins + n - 1], ' ') AS win FROM starts),
found AS (SELECT w.row_no, w.n, w.begins, p.item_id FROM windows w JOIN patterns p USING (n, win)),
hits AS (
  SELECT row_no, count(DISTINCT word) AS n_hit
  FROM (SELECT DISTINCT row_no, unnest(range(begins, begins + n)) AS word FROM found) GROUP BY row_no
),
names AS (
  SELECT row_no, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT row_no, item_id FROM found) GROUP BY row_no
)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(n.n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(n.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hits h USING (row_no) LEFT JOIN names n USING (row_no)
"""


#: Host, path and the longest rule that fits.
URL_RULES = r"""
WITH rules(rule_host, rule_path, rule_verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
),
cut AS (
  SELECT row_number() OVER () AS row_no, page_id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
),
hosts AS (SELECT row_no, page_id, rest, regexp_extract(rest, '^[^/?#]*') AS own FROM cut),
parts AS (
  SELECT row_no, page_id, translate(own, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(own) + 1), '^[^?#]*') AS path
  FROM hosts
),
fits AS (
  SELECT row_no, rule_host || rule_path AS rule, rule_verdict,
         row_number() OVER (PARTITION BY row_no ORDER BY length(rule_host || rule_path) DESC, rule_host || rule_path) AS place
  FROM parts JOIN rules ON (host = rule_host OR suffix(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT p.page_id, p.host, p.path, f.rule, f.rule_verdict
FROM parts p LEFT JOIN fits f ON f.row_no = p.row_no AND f.place = 1
"""

#: Strict spans: where each match begins follows from the lengths of the matches and of the texts between them.
PII_BASE = r"""
WITH patterns(kind_no, kind, pattern) AS (
  VALUES (0, 'email', '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+'), (1, 'ip', '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'),
         (2, 'card', '[0-9]([\x20-]?[0-9])+'), (3, 'phone', '\+[0-9][\x20().0-9-]+[0-9]')
),
docs AS (SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS t FROM documents),
found AS (
  SELECT row_no, kind_no, kind, regexp_extract_all(t, pattern) AS matches, string_split_regex(t, pattern) AS between
  FROM docs, patterns WHERE regexp_matches(t, pattern)
),
each AS (
  SELECT row_no, kind_no, kind, matches[i] AS m,
         list_sum([length(x) for x in between[1:i]]) + coalesce(list_sum([length(x) for x in matches[1:i - 1]]), 0) AS begins
  FROM (SELECT *, unnest(range(1, len(matches) + 1)) AS i FROM found)
),
digits AS (SELECT *, regexp_replace(m, '[^0-9]', '', 'g') AS d FROM each),
kept AS (
  SELECT row_no, kind_no, kind, begins::BIGINT AS begins, (begins + length(m))::BIGINT AS ends
  FROM digits
  WHERE CASE kind
    WHEN 'email' THEN true
    WHEN 'ip' THEN len(list_filter(string_split(m, '.'), lambda p: length(ltrim(p, '0')) > 3
                                   OR coalesce(try_cast(right(p, 3) AS INTEGER), 0) > 255 AND length(ltrim(p, '0')) = 3)) = 0
    WHEN 'card' THEN length(d) BETWEEN 14 AND 19 AND list_sum([
      CASE WHEN (length(d) - i) % 2 = 0 THEN substr(d, i, 1)::INTEGER
           WHEN substr(d, i, 1)::INTEGER > 4 THEN 2 * substr(d, i, 1)::INTEGER - 9 ELSE 2 * substr(d, i, 1)::INTEGER END
      for i in range(1, length(d) + 1)]) % 10 = 0
    ELSE length(d) BETWEEN 10 AND 15 END
),
joined AS (
  SELECT row_no, string_agg(kind || ':' || begins || ':' || ends, ',' ORDER BY begins, kind_no) AS spans,
         count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
         count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone
  FROM kept GROUP BY row_no
)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
       coalesce(n_phone, 0) AS n_phone, sha256(coalesce(spans, '')) AS base_sha256
FROM docs LEFT JOIN joined USING (row_no)
"""

#: Places of the base phrases among the words.
LICENSE_BASE = r"""
WITH phrases(phrase, label) AS (VALUES ('mit license', 'mit'), ('apache license', 'apache'), ('general public license', 'gpl')),
docs AS (
  SELECT row_number() OVER () AS row_no, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
),
each AS (SELECT row_no, unnest(words) AS a, generate_subscripts(words, 1) - 1 AS place FROM docs),
runs AS (
  SELECT row_no, place, a, lead(a, 1) OVER w AS b, lead(a, 2) OVER w AS c FROM each WINDOW w AS (PARTITION BY row_no ORDER BY place)
),
found AS (SELECT row_no, place, label FROM runs JOIN phrases ON phrase = a || ' ' || b OR phrase = a || ' ' || b || ' ' || c),
joined AS (
  SELECT row_no, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
         array_to_string(list_sort(list_distinct(list(label))), ',') AS base_labels
  FROM found GROUP BY row_no
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels
FROM docs LEFT JOIN joined USING (row_no)
"""

#: Targets: sources in the order in which they reach their limit; the level is the first that no later one reaches.
MIX_TARGETS = r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM docs GROUP BY source
),
ordered AS (
  SELECT *, sum(source_size) OVER () AS whole, sum(weight) OVER () AS weights,
         coalesce(sum(3 * source_size) OVER before, 0) AS given, coalesce(sum(weight) OVER before, 0) AS stopped
  FROM sources
  WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
level AS (
  SELECT min_by((whole - given)::DOUBLE / (weights - stopped), stopped)
         FILTER ((whole - given) * weight <= 3 * source_size * (weights - stopped)) AS unit
  FROM ordered
)
SELECT doc_id, size, source_size,
       round(CASE WHEN unit IS NULL OR unit * weight > 3 * source_size THEN 3.0 * source_size ELSE unit * weight END, 6)::DOUBLE AS target
FROM docs JOIN sources ON docs.source IS NOT DISTINCT FROM sources.source, level
"""

#: All pairs of a label by exact cosine, then what the links reach.
EMBEDDING_DEDUP = r"""
WITH RECURSIVE
vectors AS (
  SELECT row_number() OVER () AS row_no, vec_id, label, embedding::DOUBLE[] AS v,
         label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
           AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS valid
  FROM embeddings
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM vectors a JOIN vectors b ON a.label = b.label AND a.row_no <> b.row_no AND len(a.v) = len(b.v)
  WHERE a.valid AND b.valid AND list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v)) >= 0.98
),
reached(a, b) AS (SELECT DISTINCT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reached GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(l.b, vec_id)) AS component_id,
       vec_id <= coalesce(l.b, vec_id) AS kept
FROM vectors LEFT JOIN least l ON vec_id = l.a LEFT JOIN counts c ON vec_id = c.a
"""

#: Measures of the base rules; a window that stands twice covers its words once.
QUALITY_BASE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
),
each AS (SELECT row_no, unnest(words) AS a, generate_subscripts(words, 1) AS place FROM docs),
runs AS (
  SELECT row_no, place, a || ' ' || lead(a, 1) OVER w || ' ' || lead(a, 2) OVER w AS run FROM each WINDOW w AS (PARTITION BY row_no ORDER BY place)
),
twice AS (
  SELECT row_no, place FROM (SELECT *, count(*) OVER (PARTITION BY row_no, run) AS n FROM runs WHERE run IS NOT NULL) WHERE n > 1
),
covered AS (
  SELECT row_no, count(DISTINCT word) AS n FROM (SELECT row_no, unnest(range(place, place + 3)) AS word FROM twice) GROUP BY row_no
),
measured AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM docs LEFT JOIN covered USING (row_no)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
"""
