"""DuckDB SQL for the operators that SQL can express.

Written from the methods' definitions: full scans and joins without index,
hashing or block structure.  The other operators (trained models, XXH64
fingerprints and shards, the Pfair schedule) are tested against brute force.
"""

CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, nullif(role, '') AS who,
         replace(replace(coalesce(text, ''), '<|im_start|>', '<| im_start|>'), '<|im_end|>', '<| im_end|>') AS body
  FROM conversations),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, who NULLS FIRST, body) - 1 AS i FROM t),
people AS (SELECT DISTINCT conv_id, who AS perspective FROM t WHERE who IS NOT NULL AND who <> 'system'),
shown AS (
  SELECT n.conv_id, p.perspective, n.i // 512 AS part, n.i, n.body,
         coalesce(n.who = p.perspective, FALSE) AS mine,
         '<|im_start|>' || CASE WHEN n.who IS NULL THEN 'user' WHEN n.who = 'system' THEN 'system'
           WHEN n.who = p.perspective THEN 'assistant'
           ELSE 'user name=' || replace(replace(regexp_replace(n.who, '\s+', '_', 'g'),
                '<|im_start|>', '<| im_start|>'), '<|im_end|>', '<| im_end|>') END || chr(10) AS head
  FROM numbered n JOIN people p ON n.conv_id IS NOT DISTINCT FROM p.conv_id),
placed AS (
  SELECT *, coalesce(sum(length(head) + length(body) + 11) OVER (
    PARTITION BY conv_id, perspective, part ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS pos
  FROM shown)
SELECT conv_id, perspective, CAST(part AS INTEGER) AS part, CAST(count(*) AS INTEGER) AS n_turns,
       CAST(count(*) FILTER (WHERE mine) AS INTEGER) AS n_masked,
       string_agg(head || body || '<|im_end|>' || chr(10), '' ORDER BY i) AS rendered,
       coalesce(string_agg(CAST(pos AS VARCHAR) || '-' || CAST(pos + length(body) + 10 AS VARCHAR), ',' ORDER BY i)
                FILTER (WHERE mine), '') AS spans
FROM placed GROUP BY conv_id, perspective, part
"""

LEAKS = r"""
WITH d AS (
  SELECT row_number() OVER () AS rn, doc_id,
         [w for w in regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+') if w <> ''] AS dt
  FROM documents),
b AS (
  SELECT row_number() OVER () AS item_row, min(item_id) AS item, it, len(it) AS n,
         CASE WHEN len(it) >= 10 THEN 0.5 * len(it) WHEN len(it) >= 5 THEN len(it) - 1 ELSE len(it) END AS enough
  FROM (SELECT item_id, [w for w in regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+') if w <> ''] AS it FROM benchmark)
  GROUP BY it HAVING len(it) >= 1),
masks(m, own) AS (
  SELECT unnest([[0, 1, 2, 4, 8, 9], [0, 1, 4, 6, 7, 8], [0, 2, 3, 4, 5, 7], [0, 1, 3, 4, 6, 7]]), 0
  UNION SELECT range(h), h FROM (SELECT CASE WHEN n < 5 THEN n ELSE n // 2 END AS h FROM b WHERE n BETWEEN 3 AND 9)),
item_seeds AS (
  SELECT DISTINCT item_row, m, p, [it[p + o + 1] for o in m] AS seed
  FROM (SELECT item_row, it, n, m, own, unnest(range(CAST(n - m[len(m)] AS BIGINT))) AS p FROM b, masks WHERE n > m[len(m)] AND n >= 3)
  WHERE own = 0 OR n < 10 AND own = CASE WHEN n < 5 THEN n ELSE n // 2 END AND p IN (0, n - own)),
doc_seeds AS (
  SELECT rn, m, p, [dt[p + o + 1] for o in m] AS seed
  FROM (SELECT rn, dt, m, unnest(range(CAST(len(dt) - m[len(m)] AS BIGINT))) AS p FROM d, masks WHERE len(dt) > m[len(m)])),
aligned AS (
  SELECT DISTINCT s.rn, i.item_row, s.p - i.p AS shift FROM doc_seeds s JOIN item_seeds i ON s.m = i.m AND s.seed = i.seed),
agreed AS (
  SELECT rn, item_row, [k + shift >= 0 AND k + shift < len(dt) AND dt[k + shift + 1] = it[k + 1] for k in range(n)] AS a
  FROM aligned JOIN d USING (rn) JOIN b USING (item_row)),
-- The stretch with the highest score: one up for a token that agrees, three down (not below zero) for one that doesn't.
scored AS (
  SELECT rn, item_row, a, len([x for x in a if x]) AS hit,
    list_reduce([{'same': x, 'score': 0, 'start': 0, 'best': 0, 'first': 0, 'last': 0, 'k': 0} for x in a],
      lambda acc, e: {'same': e.same, 'score': CASE WHEN e.same THEN acc.score + 1 ELSE greatest(acc.score - 3, 0) END,
        'start': CASE WHEN acc.score > 0 THEN acc.start ELSE acc.k END,
        'best': CASE WHEN e.same AND acc.score + 1 > acc.best THEN acc.score + 1 ELSE acc.best END,
        'first': CASE WHEN e.same AND acc.score + 1 > acc.best THEN CASE WHEN acc.score > 0 THEN acc.start ELSE acc.k END ELSE acc.first END,
        'last': CASE WHEN e.same AND acc.score + 1 > acc.best THEN acc.k ELSE acc.last END, 'k': acc.k + 1},
      {'same': false, 'score': 0, 'start': 0, 'best': 0, 'first': 0, 'last': 0, 'k': 0}) AS run
  FROM agreed),
pieces AS (
  SELECT rn, item_row, hit, run.best AS best, CASE WHEN run.best >= 6 THEN [k for k in range(run.first, run.last + 1) if a[k + 1]] ELSE [] END AS piece
  FROM scored JOIN b USING (item_row) WHERE hit >= enough OR run.best >= 6),
whole AS (
  SELECT rn, item_row, max(hit) AS hit, max(best) AS best, len(list_distinct(flatten(list(piece)))) AS whole FROM pieces GROUP BY rn, item_row),
found AS (
  SELECT rn, item, n, CASE WHEN hit >= enough THEN hit ELSE greatest(hit, whole) END AS hit
  FROM whole JOIN b USING (item_row) WHERE hit >= enough OR best >= 20 OR whole >= enough
  UNION ALL SELECT rn, item, n, n FROM d JOIN b ON dt = it WHERE n < 3),
best AS (
  SELECT *, row_number() OVER (PARTITION BY rn ORDER BY hit / n DESC, item NULLS LAST) AS place, count(*) OVER (PARTITION BY rn) AS n_items
  FROM found)
SELECT d.doc_id, best.rn IS NOT NULL AS contaminated, coalesce(n_items, 0) AS n_items, item AS best_item,
       CAST(hit AS BIGINT) AS matched, CAST(n AS BIGINT) AS item_tokens
FROM d LEFT JOIN best ON d.rn = best.rn AND place = 1
"""

# The patterns of the method's own list, written out as regular expressions over host + path.
URLS = r"""
WITH u AS (
  SELECT row_number() OVER () AS rn, page_id,
         CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
h AS (
  SELECT rn, page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
prefix(verdict, rule, rhost, rpath) AS (VALUES
  ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
  ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')),
patterns(verdict, rule, regex) AS (VALUES
  ('block', '||casino*', '^([^/]*\.)?casino'), ('block', 'casino-win.', 'casino-win\.'), ('block', '.casino.', '\.casino\.'),
  ('block', '-casino.', '-casino\.'), ('block', '/casino/', '/casino/'), ('block', '||bet365^', '^([^/]*\.)?bet365([^A-Za-z0-9._%-]|$)'),
  ('block', '/poker/', '/poker/'), ('block', '-poker.', '-poker\.'), ('block', 'xxx.', 'xxx\.'), ('block', '/porn/', '/porn/'),
  ('block', '||porn*', '^([^/]*\.)?porn'), ('block', '-sex.', '-sex\.'), ('block', '/warez/', '/warez/'),
  ('block', '/viagra/', '/viagra/'), ('block', '-pills.', '-pills\.'), ('block', '/ads/*.js', '/ads/.*\.js'),
  ('block', '/wp-login.php^', '/wp-login\.php([^A-Za-z0-9._%-]|$)'), ('block', '||tracker.', '^([^/]*\.)?tracker\.'),
  ('block', '||adserver.', '^([^/]*\.)?adserver\.'), ('block', '/cgi-bin/*.exe^', '/cgi-bin/.*\.exe([^A-Za-z0-9._%-]|$)'),
  ('allow', '/privacy/', '/privacy/'), ('allow', '||docs.', '^([^/]*\.)?docs\.')),
fixed AS (
  SELECT rn, arg_max(prefix.rule, length(prefix.rule)) AS rule, arg_max(prefix.verdict, length(prefix.rule)) AS verdict
  FROM h, prefix WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY rn),
own AS (
  SELECT rn, rule, verdict, row_number() OVER (PARTITION BY rn ORDER BY length(rule) DESC, rule DESC) AS place
  FROM h, patterns WHERE regexp_matches(host || path, regex))
SELECT h.page_id, h.host, h.path, fixed.rule, coalesce(fixed.verdict, own.verdict, 'allow') AS verdict,
       CASE WHEN fixed.rule IS NULL THEN own.rule END AS pattern
FROM h LEFT JOIN fixed USING (rn) LEFT JOIN own ON h.rn = own.rn AND own.place = 1
"""

LANGUAGE_MODELS = r"""
WITH d AS (
  SELECT row_number() OVER () AS rn, doc_id, doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) AS good,
         [w for w in regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+') if w <> ''] AS ws
  FROM documents),
tokens AS (SELECT rn, good, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM d),
counts AS (SELECT w, count(*) AS raw, count(*) FILTER (WHERE good) AS good FROM tokens GROUP BY w),
total AS (SELECT sum(raw) AS raw, sum(good) AS good, sum(raw) / greatest(1, sum(good)) AS scale FROM counts),
known AS (SELECT * FROM counts WHERE raw >= 5),
-- '' is the unknown word, ' ' the start of a text.
words AS (
  SELECT * FROM known UNION ALL
  SELECT '', (SELECT raw FROM total) - sum(raw), (SELECT good FROM total) - sum(good) FROM known),
p1 AS (
  SELECT w, (words.good + 0.5) / (total.good + 0.5 * (SELECT count(*) FROM words)) AS good,
         (words.raw + 0.5 * scale) / (total.raw + 0.5 * scale * (SELECT count(*) FROM words)) AS raw
  FROM words, total),
pairs AS (
  SELECT rn, t.good, coalesce(known.w, '') AS w, lag(coalesce(known.w, ''), 1, ' ') OVER (PARTITION BY rn ORDER BY i) AS v
  FROM tokens t LEFT JOIN known ON t.w = known.w),
bigrams AS (
  SELECT v, w, count(*) AS raw, count(*) FILTER (WHERE good) AS good FROM pairs GROUP BY v, w HAVING count(*) >= 5),
contexts AS (SELECT v, sum(raw) AS raw, sum(good) AS good FROM bigrams GROUP BY v),
losses AS (
  SELECT rn, count(*) AS n,
    sum(-ln((coalesce(b.good, 0) + 50 * p1.good) / (coalesce(c.good, 0) + 50))) AS target,
    sum(-ln((coalesce(b.raw, 0) + 50 * scale * p1.raw) / (coalesce(c.raw, 0) + 50 * scale))) AS background
  FROM pairs JOIN p1 ON pairs.w = p1.w LEFT JOIN bigrams b ON b.v = pairs.v AND b.w = pairs.w
       LEFT JOIN contexts c ON c.v = pairs.v, total GROUP BY rn)
SELECT doc_id, coalesce(n, 0) AS n_tokens, coalesce(round(target / n, 6), 0) AS loss_target,
       coalesce(round(background / n, 6), 0) AS loss_background, coalesce(round((target - background) / n, 6), 0) AS score
FROM d LEFT JOIN losses USING (rn)
"""

SPELLINGS = r"""
WITH RECURSIVE
-- The CRC-32 table from its polynomial.
poly AS (
  SELECT [list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)
          FOR i IN range(256)] AS crc),
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  GROUP BY doc_id, run),
-- UTF-8 bytes: one below 128, else 195 and the code point less 64 (À to ÿ).
bytes AS (
  SELECT *, flatten([CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [195, unicode(c) - 64] END
                     FOR c IN string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, '')]) AS b FROM runs),
hashed AS (
  SELECT run, n, xor(list_reduce([CAST(x AS BIGINT) FOR x IN b],
           lambda c, x: xor(crc[CAST((xor(c, x) & 255) + 1 AS BIGINT)], c >> 8), 4294967295), 4294967295) AS h
  FROM bytes, poly),
spelt AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
  FROM hashed),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelt WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
-- A word without one of its code points, and where.
holes AS (
  SELECT DISTINCT word, length(word) AS l, p, substr(word, 1, p) || substr(word, p + 2) AS rest
  FROM (SELECT word, unnest(range(length(word))) AS p FROM v)),
edits AS (
  SELECT a.word AS x, b.word AS y FROM holes a JOIN holes b ON a.l = b.l AND a.p = b.p AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT holes.word, v.word FROM holes JOIN v ON rest = v.word
  UNION SELECT v.word, holes.word FROM holes JOIN v ON rest = v.word),
near AS (
  SELECT x, count(*) AS n_near, max(n) AS best_n FROM edits JOIN v ON y = word GROUP BY x),
best AS (
  SELECT near.x, min(y) AS best FROM near JOIN edits ON near.x = edits.x JOIN v ON y = word AND n = best_n GROUP BY near.x),
formed AS (
  SELECT v.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * n THEN best END AS form,
         CASE WHEN best_n >= 2 * n THEN best_n END AS form_n
  FROM v LEFT JOIN near ON v.word = near.x LEFT JOIN best ON v.word = best.x),
chain AS (
  SELECT word, word AS here, 0 AS step FROM formed
  UNION ALL SELECT chain.word, form, step + 1 FROM chain JOIN formed ON here = formed.word WHERE form IS NOT NULL),
roots AS (SELECT word, arg_max(here, step) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)
"""

PAGES = r"""
-- The pages declare their article; its blocks are what stands between block tags.  Unit separators mark their ends.
WITH inner_html AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article[^>]*>(.*?)(</article>|$)', 1) AS body FROM pages),
cut AS (
  SELECT page_id, url, string_split(regexp_replace(regexp_replace(body, '</?(p|h1|ul|li|div)( [^>]*)?>', chr(31), 'g'),
         '</?(b|br|a)( [^>]*)?>', ' ', 'g'), chr(31)) AS parts FROM inner_html),
-- Character references of the pages (the ampersand last, so that none is decoded twice).
plain AS (
  SELECT page_id, url, [trim(regexp_replace(regexp_replace(replace(replace(replace(p, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'),
                             '&amp;?', '&', 'g'), '\s+', ' ', 'g')) FOR p IN parts] AS parts FROM cut)
SELECT page_id, url, array_to_string([p FOR p IN parts IF p <> ''], chr(10) || chr(10)) AS text,
       CAST(length(array_to_string([p FOR p IN parts IF p <> ''], chr(10) || chr(10))) AS BIGINT) AS n_chars FROM plain
"""

ORACLE_SQL: dict[str, str] = {
    "op3_chat_perspectives": CHAT,
    "op8_spaced_seed": LEAKS,
    "op9_url_rules": URLS,
    "op10_cross_entropy": LANGUAGE_MODELS,
    "op12_page_text": PAGES,
    "op13_spelling_variants": SPELLINGS,
}
