"""DuckDB SQL for the queries that SQL expresses; the same columns under the same names."""

OBSERVATIONS = """
WITH obs AS (
  SELECT CAST(l_linenumber % 4 AS INTEGER) AS level, p_name || ' ' || p_brand || ' ' || p_size AS label, lower(p_name || ' ' || p_brand || ' ' || p_size) AS key,
         CASE WHEN l_linenumber % 4 = 0 THEN '' ELSE lower(p_type) END AS parents, n_name AS institution, l_orderkey
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
g AS (SELECT level, key, parents, min(label) AS label, count(DISTINCT institution) AS institutions, count(DISTINCT l_orderkey) AS records, count(*) AS n,
             string_agg(DISTINCT 'Nation_' || institution[8:], ', ' ORDER BY 'Nation_' || institution[8:]) AS places
      FROM obs GROUP BY ALL),
decided AS (SELECT *, institutions + 0.3 * ln(1 + n) AS weight, institutions >= CASE WHEN level >= 2 THEN 2 ELSE 1 END AND records >= CASE WHEN level = 3 THEN 3 ELSE 1 END AS passed FROM g)
"""
DECISION = "level, key, parents, label, institutions, records, n, round(weight, 6) AS weight, passed"

# DuckDB compares bytes: accented letters stand as capitals, which lower-case labels leave free.
CONCEPTS = r"""
WITH RECURSIVE c AS (
  SELECT 'd' || lpad(CAST(doc_id AS VARCHAR), 9, '0') AS id, t, n_chars, doc_id, lang FROM (
    SELECT doc_id, lang, n_chars, array_to_string(regexp_split_to_array(trim(text, ' ' || chr(10) || chr(9)), '\s+')[1:6], ' ') AS t FROM documents)),
p AS (SELECT *, trim(regexp_replace(regexp_replace(lower(t), '[^\w\s\p{L}\p{M}\p{N}]+', ' ', 'g'), '\s+', ' ', 'g')) AS pre FROM c),
k AS (SELECT *, pre[1:6] AS key, row_number() OVER (PARTITION BY pre[1:6] ORDER BY id) AS n, count(*) OVER (PARTITION BY pre[1:6]) AS size FROM p WHERE pre <> ''),
m AS (SELECT *, 'prefix:' || key || CASE WHEN size > 1000 THEN '|' || lpad(CAST((n - 1) // 1000 AS VARCHAR), 4, '0') ELSE '' END AS block, n - (n - 1) // 1000 * 1000 AS place FROM k WHERE size > 1),
s AS (SELECT block, max(place) AS members FROM m GROUP BY block),
pairs AS (SELECT a.block, a.id AS a, b.id AS b, a.pre AS x, b.pre AS y FROM m a JOIN m b ON a.block = b.block AND a.place < b.place AND a.lang = b.lang JOIN s ON s.block = a.block
          WHERE (a.place - 1) * s.members - a.place * (a.place - 1) / 2 + b.place - a.place <= 10000),
scored AS (SELECT *, jaro_winkler_similarity(translate(x, 'àâäçèéêëíîïñóôöùúûüß', 'ABCDEFGHIJKLMNOPQRST'), translate(y, 'àâäçèéêëíîïñóôöùúûüß', 'ABCDEFGHIJKLMNOPQRST')) AS jw, len(list_intersect(list_distinct(string_split(x, ' ')), list_distinct(string_split(y, ' ')))) / len(list_distinct(list_concat(string_split(x, ' '), string_split(y, ' ')))) AS tok FROM pairs),
passed AS (SELECT block, a, b, CASE WHEN jw >= 0.9 THEN jw ELSE greatest(jw, tok) END AS score FROM scored WHERE jw >= 0.9 OR tok >= 0.9),
e AS (SELECT DISTINCT a, b FROM passed UNION SELECT DISTINCT b, a FROM passed),
reach AS (SELECT a AS id, a AS other FROM e UNION SELECT r.id, e.b FROM reach r JOIN e ON r.other = e.a),
comp AS (SELECT id, min(other) AS component FROM reach GROUP BY id)
"""

NEAR_PARTS = """
WITH p AS (SELECT p_partkey, p_name || ' ' || p_type || ' ' || p_brand AS t FROM part),
near AS (SELECT a.p_partkey, a.t, b.t AS u, trim(regexp_replace(regexp_replace(lower(a.t), '[^\\w\\s]+', ' ', 'g'), '\\s+', ' ', 'g')) AS x,
         trim(regexp_replace(regexp_replace(lower(b.t), '[^\\w\\s]+', ' ', 'g'), '\\s+', ' ', 'g')) AS y FROM p a JOIN p b ON a.p_partkey + 1 = b.p_partkey)
"""

LINES = r"""
WITH l AS (SELECT doc_id AS page, generate_subscripts(parts, 1) AS pos, trim(unnest(parts), ' ' || chr(9)) AS line, unnest(parts) AS raw
           FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)),
f AS (SELECT *, line = '' AS blank,
        regexp_matches(line, '(?i)^[A-Z][A-Z\s]{2,50}:?$') OR regexp_matches(line, '^#{1,6}\s+.+$') OR regexp_matches(line, '(?i)^\d+\.\s+[A-Z].+$')
        OR (ends_with(line, ':') AND len(regexp_split_to_array(line, '\s+')) <= 12)
        OR (upper(line) = line AND lower(line) <> line AND len(regexp_split_to_array(line, '\s+')) BETWEEN 2 AND 12) AS header,
        CASE WHEN regexp_matches(line, '(?i)^(?:[-+*•‣◦]|\d+[.)]|[a-z][.)])\s+') THEN 'list' WHEN line <> '' AND len(line) - len(replace(line, '|', '')) >= 2 THEN 'table' ELSE 'paragraph' END AS kind FROM l)
"""
BLOCKS = (
    LINES
    + r"""
, b AS (SELECT *, lag(blank OR header) OVER w AS broken, lag(kind) OVER w AS before, last_value(CASE WHEN header AND NOT blank THEN line END IGNORE NULLS) OVER (PARTITION BY page ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section FROM f WINDOW w AS (PARTITION BY page ORDER BY pos)),
i AS (SELECT *, sum(CASE WHEN blank OR header OR broken IS NULL OR broken OR before <> kind THEN 1 ELSE 0 END) OVER (PARTITION BY page ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM b),
made AS (SELECT page, island, any_value(section) AS section, any_value(CASE WHEN header THEN 'header' ELSE kind END) AS block_type, string_agg(line, chr(10) ORDER BY pos) AS said FROM i WHERE NOT blank GROUP BY page, island),
t AS (SELECT page, island, section, block_type, CASE WHEN block_type = 'list' THEN trim(said, ' ' || chr(10) || chr(9)) ELSE trim(regexp_replace(said, '\s+', ' ', 'g')) END AS text FROM made),
j AS (SELECT *, regexp_matches(text, '(?i)(?:© \d{4})|(?:all rights reserved)|(?:privacy policy)|(?:terms of use)|(?:contact us)|(?:home \| about \| contact)') AS boilerplate FROM t WHERE text <> ''),
o AS (SELECT *, CASE WHEN NOT boilerplate THEN sum(CASE WHEN boilerplate THEN 0 ELSE 1 END) OVER (PARTITION BY page ORDER BY island ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 END AS ord FROM j)
"""
)

PART_LABELS = """
WITH q AS (SELECT p_partkey, CAST(p_partkey % 4 AS INTEGER) AS level, p_type,
  CASE WHEN p_partkey % 11 = 0 THEN 'KDD ' || p_size WHEN p_partkey % 13 = 0 THEN 'Machine Learning' WHEN p_partkey % 17 = 0 THEN string_split(p_name, ' ')[2] || '_workshop'
       WHEN p_partkey % 3 = 0 THEN regexp_replace(p_name, ' ', '-', 'g') WHEN p_partkey % 3 = 1 THEN string_split(p_name, ' ')[1] ELSE p_name || ' ' || p_type END AS label FROM part),
r AS (SELECT *, lower(label) IN ('machine learning', 'computer vision', 'natural language processing', 'artificial intelligence', 'data science') AS allowlisted,
   len(list_filter(string_split(replace(label, '-', ' '), ' '), lambda t: t <> '')) AS tokens,
   list_filter(['-', '.', '/', ':', '_'], lambda m: contains(label, m)) AS marks,
   CASE WHEN level = 3 THEN CASE WHEN regexp_full_match(lower(label), 'kdd ?[0-9]*') THEN 'kdd' WHEN contains(lower(label), 'workshop') THEN 'workshop' END END AS venue FROM q),
v AS (SELECT *, tokens <= 5 AND len(marks) = 0 AND len(label) BETWEEN 2 AND 64 AND venue IS NULL AS right_ FROM r)
"""

MENTIONS = r"""
WITH c AS (SELECT 'b' || item_id AS id, CAST(item_id % 4 AS INTEGER) AS level, array_to_string(regexp_split_to_array(trim(text, ' ' || chr(10) || chr(9)), '\s+')[1:4], ' ') AS label FROM benchmark),
s AS (SELECT doc_id AS snap, text, lower(text) AS low, source AS institution, CASE WHEN doc_id % 3 = 0 THEN 0.8 WHEN doc_id % 3 = 1 THEN 1.0 ELSE 0.3 END AS authority FROM documents),
m AS (SELECT id, snap, label, low, text, institution, authority FROM c JOIN s ON contains(low, lower(label)) WHERE label <> ''),
pieces AS (SELECT *, string_split(low, lower(label)) AS parts FROM m),
n AS (SELECT *, unnest(range(1, len(parts))) AS k FROM pieces),
placed AS (SELECT id, snap, label, text, institution, authority, CAST(list_sum(list_transform(parts[1:k], lambda x: len(x))) + (k - 1) * len(label) AS BIGINT) AS pos FROM n),
sn AS (SELECT *, trim(text[greatest(0, pos - 100) + 1 : pos + len(label) + 100], ' ' || chr(10) || chr(9)) AS snippet FROM placed),
sc AS (SELECT id, snap, pos, snippet, least(1.5, CASE WHEN contains(lower(snippet), lower(label)) THEN 1.0 ELSE 0.5 END + CASE WHEN contains(lower(snippet), lower(institution)) THEN 0.2 ELSE 0.0 END + 0.3 * authority) AS score FROM sn),
rk AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, snap, pos) AS rank FROM sc)
"""

TREE = """
WITH n AS (SELECT count(*) AS n FROM supplier),
all_ AS (
  SELECT 'r' || r_regionkey AS id, 0 AS level, CAST([] AS VARCHAR[]) AS parents FROM region
  UNION ALL SELECT 'n' || n_nationkey, 1, ['r' || n_regionkey] FROM nation
  UNION ALL SELECT 's' || s_suppkey, 2, ['n' || s_nationkey] FROM supplier
  UNION ALL SELECT 'c' || c_custkey, 3, CASE WHEN c_custkey % 29 = 0 THEN ['s' || (c_custkey % (n + 10)), 's' || ((c_custkey + 1) % n)] ELSE ['s' || (c_custkey % (n + 10))] END FROM customer, n),
flat AS (SELECT a.id, a.level, u.p FROM all_ a, unnest(a.parents) AS u(p)),
lost AS (SELECT f.id, f.level, string_agg(DISTINCT f.p, '|' ORDER BY f.p) AS parents FROM flat f WHERE f.p NOT IN (SELECT id FROM all_) GROUP BY f.id, f.level),
several AS (SELECT id, level, parents FROM all_ WHERE len(list_distinct(parents)) > 1 AND id NOT IN (SELECT id FROM lost)),
nodes AS (SELECT * FROM all_ WHERE id NOT IN (SELECT id FROM lost) AND id NOT IN (SELECT id FROM several)),
edges AS (SELECT DISTINCT f.p AS parent, f.id AS child FROM flat f JOIN nodes USING (id))
"""

TALK = r"""
WITH t AS (SELECT * FROM conversations),
c AS (SELECT conv_id, lower(regexp_split_to_array(trim(text, ' ' || chr(10)), '\s+')[1]) AS label FROM t WHERE turn = 0),
r AS (SELECT c.conv_id, turn, role, label, list_filter(regexp_split_to_array(trim(text, ' ' || chr(10)), '\s+'), lambda x: x <> '') AS raw FROM t JOIN c USING (conv_id)),
h AS (SELECT *, list_filter(range(1, len(raw) + 1), lambda i: lower(raw[i]) = label) AS hits FROM r WHERE len(raw) > 0),
w AS (SELECT DISTINCT 'c' || conv_id AS concept_id, turn AS n, role AS institution, unnest(CASE WHEN len(hits) > 0 THEN list_transform(hits, lambda i: array_to_string(raw[greatest(1, i - 4) : i + 4], ' ')) ELSE [array_to_string(raw[1:8], ' ')] END) AS text FROM h)
"""

SENSES = """
WITH p AS (SELECT p_name, p_type, list_sort(list_distinct(list(p_brand))) AS brands FROM part GROUP BY ALL),
g AS (SELECT p_name, count(*) AS size FROM p GROUP BY p_name HAVING count(*) > 1),
pr AS (SELECT a.p_name, 2.0 / 3 AS far, 1 - len(list_intersect(list_transform(a.brands, lambda x: lower(x)), list_transform(b.brands, lambda x: lower(x)))) / len(list_distinct(list_concat(list_transform(a.brands, lambda x: lower(x)), list_transform(b.brands, lambda x: lower(x))))) AS places
       FROM p a JOIN p b ON a.p_name = b.p_name AND a.p_type < b.p_type),
s AS (SELECT lower(p_name) AS label, any_value(size) AS size, avg(far) AS pd, avg(places) AS id_ FROM pr JOIN g USING (p_name) GROUP BY p_name)
"""

ORACLES = {
    "s2_frequency": OBSERVATIONS + f"SELECT {DECISION} FROM decided",
    "s2_kept": OBSERVATIONS + f"SELECT {DECISION} FROM decided WHERE passed",
    "s2_histogram": OBSERVATIONS + "SELECT level, institutions, count(*) AS groups FROM decided GROUP BY ALL",
    "s2_statistics": OBSERVATIONS + "SELECT (SELECT count(*) FROM obs) AS candidates_in, count(*) AS aggregated_groups, count(*) FILTER (passed) AS kept, count(*) FILTER (NOT passed) AS dropped, CAST(sum(institutions) AS BIGINT) AS institutions_unique FROM decided",
    "s2_rationale": OBSERVATIONS + "SELECT level, key, parents, printf('institutions=%d (min 2), records=%d (min %d), count=%d, weight=%.2f', institutions, records, CASE WHEN level = 3 THEN 3 ELSE 1 END, n, weight) AS reason, 'institutions_list=' || places AS places FROM decided WHERE level >= 2",
    "s2_near_duplicate": """
WITH o AS (SELECT o_orderpriority, lower(o_orderpriority) AS key, lower(c_mktsegment) AS parents, n_name, o_custkey, o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
f AS (SELECT key, parents, n_name, o_custkey, min('record' || o_custkey || 'x#v' || o_orderkey) AS print FROM o GROUP BY ALL),
t AS (SELECT key, parents, count(DISTINCT n_name) AS institutions, count(DISTINCT print) AS records FROM f GROUP BY ALL),
h AS (SELECT key, parents, min(o_orderpriority) AS label, count(*) AS n FROM o GROUP BY ALL)
SELECT 3 AS level, key, parents, label, institutions, records, n, round(institutions + 0.3 * ln(1 + n), 6) AS weight, institutions >= 2 AND records >= 3 AS passed FROM h JOIN t USING (key, parents)""",
    "institution_resolve": """
WITH r AS (SELECT n_nationkey, upper(n_name[1]) || lower(n_name[2:]) AS nation, array_to_string(list_transform(string_split(r_name, ' '), lambda w: CASE WHEN len(w) <= 4 THEN w ELSE upper(w[1]) || lower(w[2:]) END), ' ') AS kept,
 array_to_string(list_transform(string_split(r_name || ',', ' '), lambda w: CASE WHEN len(w) <= 4 THEN w ELSE upper(w[1]) || lower(w[2:]) END), ' ') AS said FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT n_nationkey, 'University OF ' || nation || ' at ' || said || ' MIT Campus' AS campus, 'University OF ' || nation || ' at ' || kept AS system,
 'placeholder::' || sha1('unknown|empty')[1:8] AS empty, 'placeholder::' || sha1('unknown|explicit')[1:8] AS unknown FROM r""",
    "top_institutions": """
WITH r AS (SELECT n_name AS institution, p_brand AS college, l_returnflag AS sheet FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
e AS (SELECT institution, college, count(*) AS n, min(sheet) AS sheet FROM r GROUP BY ALL)
SELECT institution, count(*) AS college_count, CAST(sum(n) AS BIGINT) AS total_occurrences, string_agg(college, '|' ORDER BY college) AS colleges, string_agg(DISTINCT sheet, '|' ORDER BY sheet) AS sheets, min(sheet) AS primary_sheet
FROM e GROUP BY institution ORDER BY college_count DESC, total_occurrences DESC, institution LIMIT 10""",
    "normalize_labels": r"""
WITH l AS (SELECT p_partkey, p_brand || ' / ' || p_name || ' / ' || '(' || p_type || ')' AS x FROM part)
SELECT p_partkey, trim(regexp_replace(regexp_replace(lower(x), '[\-.,;:/\\]+', ' ', 'g'), '\s+', ' ', 'g')) AS label, trim(regexp_replace(regexp_replace(lower(x), '[^0-9a-z\s]+', ' ', 'g'), '\s+', ' ', 'g')) AS minimal,
 trim(regexp_replace(regexp_replace(lower(x), '[^\w\s]+', ' ', 'g'), '\s+', ' ', 'g')) AS comparable FROM l""",
    "level_prefix_strip": """
WITH i AS (SELECT p_partkey, p_partkey % 3 AS m, p_name, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS name, CASE WHEN p_size > 25 THEN ' (' || upper(p_type[1:3]) || ')' ELSE '' END AS tail, upper(p_type[1:3]) AS mark FROM part),
s AS (SELECT *, CASE m WHEN 0 THEN 'Department of ' WHEN 1 THEN 'Dept. of ' ELSE 'Centre for ' END AS head FROM i)
SELECT p_partkey, CASE WHEN m = 2 THEN 'centre for ' || p_name ELSE p_name END AS canonical,
 array_to_string(list_filter([head || name || tail, CASE WHEN m = 2 THEN 'centre for ' || p_name ELSE p_name END, CASE WHEN m < 2 AND tail <> '' THEN name || tail END, CASE WHEN tail <> '' THEN mark END], lambda x: x IS NOT NULL), '|') AS aliases FROM s""",
    "acronym_detect": r"""
SELECT c_custkey, array_to_string(list_filter([c_mktsegment[1:4], 'AI', 'EECS'], lambda a: a NOT IN ('OF')), '|') AS acronyms FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "acronym_match": "SELECT p_partkey, upper(p_name[1] || string_split(p_name, ' ')[2][1]) AS initials, CASE WHEN upper(p_name[1]) || 'B' = upper(p_name[1] || string_split(p_name, ' ')[2][1]) THEN 1.0 ELSE 0.0 END::DOUBLE AS score, 1.0::DOUBLE AS known FROM part",
    "record_fingerprints": r"SELECT doc_id, 'record:' || sha1(trim(regexp_replace(text, '[\s\v]+', ' ', 'g'), ' ') || '|' || source || '|') AS fingerprint, source || '::split::' || sha256(source || ':' || (doc_id % 7))[1:12] AS split_id FROM documents",
    "token_jaccard": NEAR_PARTS + "SELECT p_partkey, round(len(list_intersect(list_distinct(string_split(x, ' ')), list_distinct(string_split(y, ' ')))) / len(list_distinct(list_concat(string_split(x, ' '), string_split(y, ' ')))), 6) AS score FROM near",
    "shingle_jaccard": NEAR_PARTS + ", g AS (SELECT p_partkey, list_distinct(list_transform(range(1, len(string_split(x, ' '))), lambda i: array_to_string(string_split(x, ' ')[i : i + 1], ' '))) AS a, list_distinct(list_transform(range(1, len(string_split(y, ' '))), lambda i: array_to_string(string_split(y, ' ')[i : i + 1], ' '))) AS b FROM near) SELECT p_partkey, round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 6) AS score FROM g",
    "jaro_winkler_pairs": NEAR_PARTS + "SELECT p_partkey, round(jaro_winkler_similarity(x, y), 6) AS score FROM near",
    "combined_similarity": NEAR_PARTS + "SELECT p_partkey, round(len(list_intersect(list_distinct(string_split(x, ' ')), list_distinct(string_split(y, ' ')))) / len(list_distinct(list_concat(string_split(x, ' '), string_split(y, ' ')))), 6) AS score FROM near",
    "affix_hints": "SELECT p_partkey, CASE WHEN string_split(p_name, ' ')[2] IN ('bolt', 'ring', 'systems') AND len(string_split(p_name, ' ')) = 2 THEN 1.0 ELSE 0.0 END::DOUBLE AS hint FROM part",
    "s0_lines": LINES + "SELECT page, count(*) AS lines, count(*) FILTER (blank) AS blanks, count(*) FILTER (header AND NOT blank) AS headers, count(*) FILTER (kind = 'list') AS listed, count(*) FILTER (kind = 'table') AS tabled FROM f GROUP BY page",
    "s0_segments": BLOCKS + "SELECT page, CAST(ord AS BIGINT) AS ord, md5(section) AS section, block_type, md5(text) AS text, boilerplate FROM o",
    "s0_block_gates": BLOCKS + "SELECT page, count(*) AS blocks, count(*) FILTER (len(text) BETWEEN 12 AND 2000) AS kept FROM o WHERE NOT boilerplate AND page % 4 >= 2 AND page IN (SELECT doc_id FROM documents WHERE lang = 'en') GROUP BY page",
    "s0_language_gate": "SELECT lang, count(*) AS pages_seen, count(*) FILTER (NOT (lang = 'en' AND doc_id % 4 >= 2)) AS pages_skipped FROM documents GROUP BY lang",
    "page_canonical_urls": r"SELECT page_id, lower(regexp_extract(url, '(?i)^(https?)://', 1)) || '://' || lower(regexp_extract(url, '://([^/?#]*)', 1)) || CASE WHEN regexp_replace(regexp_replace(url, '#.*$', ''), '^[^:]+://[^/?]*', '') LIKE '/%' THEN '' ELSE '/' END || regexp_replace(regexp_replace(url, '#.*$', ''), '^[^:]+://[^/?]*', '') AS url, lower(regexp_extract(url, '://([^/?#]*)', 1)) AS host FROM pages",
    "domain_filter": "WITH h AS (SELECT page_id, lower(regexp_extract(url, '://([^/?#]*)', 1)) AS host, regexp_extract(url, '^[^:]+://[^/?#]*([^?#]*)', 1) AS path FROM pages) SELECT page_id, (host = 'example.com' OR ends_with(host, '.example.com')) AND NOT (starts_with(path, '/en/1') OR starts_with(path, '/fr')) AS follows FROM h",
    "page_links": r"""WITH h AS (SELECT url, unnest(list_distinct(regexp_extract_all(html, '(?is)<a\s[^>]*?href\s*=\s*["'']([^"''>]+)["'']', 1))) AS href FROM pages) SELECT url, count(DISTINCT regexp_replace(href, '#.*$', '')) AS links FROM h WHERE NOT regexp_matches(href, '(?i)^(mailto|javascript|tel|ftp):') GROUP BY url""",
    "snapshot_cache": """
WITH f AS (SELECT sha1(text) AS checksum, 'u' || lpad(CAST(doc_id AS VARCHAR), 9, '0') AS url, 1735689600 + doc_id * 60 AS stored_at, CAST(strlen(text) AS BIGINT) AS size FROM documents)
SELECT checksum, min_by(url, (stored_at, url)) AS url, CAST(count(DISTINCT url) AS INTEGER) AS urls, max(stored_at) AS stored_at, max(size) AS size FROM f GROUP BY checksum HAVING max(stored_at) > 1735689600 + 3600""",
    "dedup_prefix_blocks": CONCEPTS + "SELECT block, count(*) AS members, min(id) AS first, max(id) AS last FROM m GROUP BY block",
    "dedup_pairs": CONCEPTS + "SELECT block, a, b, round(score, 6) AS score, 0.9::DOUBLE AS threshold FROM passed",
    "dedup_components": CONCEPTS + "SELECT id, component FROM comp",
    "dedup_merge": CONCEPTS + """
, mem AS (SELECT c.*, doc_id % 5 + 1 AS inst, component FROM c JOIN comp USING (id)),
w AS (SELECT component, arg_min(id, (-inst, len(t), lower(t), id)) AS id, arg_min(t, (-inst, len(t), lower(t), id)) AS label, count(*) AS records, CAST(sum(inst) AS BIGINT) AS institutions, CAST(sum(n_chars) AS BIGINT) AS n, list_distinct(list(t)) AS names FROM mem GROUP BY component)
SELECT id, records, institutions, n, CAST(len(list_filter(names, lambda x: x <> label)) AS INTEGER) AS aliases FROM w
UNION ALL SELECT id, 1, doc_id % 5 + 1, n_chars, 0 FROM c WHERE id NOT IN (SELECT id FROM comp)""",
    "s3_rules": PART_LABELS + r"""
SELECT p_partkey, allowlisted OR right_ AS passed, allowlisted, CAST(tokens AS INTEGER) AS tokens,
 CASE WHEN allowlisted THEN 'label matched allowlist' ELSE array_to_string(list_filter([CASE WHEN len(marks) > 0 THEN 'forbidden punctuation: ' || array_to_string(marks, ', ') END, CASE WHEN NOT len(label) BETWEEN 2 AND 64 THEN 'length outside range 2-64' END, CASE WHEN venue IS NOT NULL THEN 'contains venue keyword ''' || venue || '''' END], lambda x: x IS NOT NULL), '|') END AS reasons,
 CASE WHEN allowlisted OR right_ THEN '' ELSE array_to_string(list_filter([CASE WHEN len(marks) > 0 THEN regexp_replace(label, '[-_]', ' ', 'g') END, CASE WHEN contains(label, '-') THEN replace(label, '-', ' ') END, CASE WHEN len(marks) > 0 THEN regexp_replace(label, '[-_]', '', 'g') END], lambda x: x IS NOT NULL), '|') END AS suggestions FROM v""",
    "s3_decisions": PART_LABELS + r"""
, z AS (SELECT *, tokens > 1 OR allowlisted OR right_ AS ok, CASE WHEN tokens = 1 AND NOT allowlisted THEN true END AS model_passed, len(list_filter([CASE WHEN len(marks) > 0 THEN 1 END, CASE WHEN venue IS NOT NULL THEN 1 END], lambda x: x IS NOT NULL)) AS broken, CASE WHEN allowlisted OR right_ THEN [] ELSE list_filter([CASE WHEN len(marks) > 0 THEN regexp_replace(label, '[-_]', ' ', 'g') END, CASE WHEN contains(label, '-') THEN replace(label, '-', ' ') END, CASE WHEN len(marks) > 0 THEN regexp_replace(label, '[-_]', '', 'g') END], lambda x: x IS NOT NULL) END AS said FROM v)
SELECT p_partkey, ok AS passed, model_passed, CASE WHEN ok AND len(said) > 0 THEN array_to_string(list_sort(list_distinct(list_concat([label], said))), '|') ELSE '' END AS aliases, CAST(CASE WHEN tokens > 1 THEN 1 WHEN allowlisted THEN 1 ELSE broken + len(said) + 1 END AS INTEGER) AS reasons FROM z""",
    "s3_statistics": PART_LABELS + """
, z AS (SELECT *, tokens = 1 AND NOT allowlisted AS asked, starts_with(label, 's') AS yes FROM v)
SELECT count(*) AS checked, count(*) FILTER (tokens > 1 OR allowlisted OR (right_ AND yes)) AS passed, count(*) FILTER (NOT (tokens > 1 OR allowlisted OR (right_ AND yes))) AS failed, count(*) FILTER (allowlisted) AS allowlisted, count(*) FILTER (tokens > 1) AS multi_token, count(*) FILTER (asked) AS model_called, count(*) FILTER (asked AND yes) AS model_passed, 0::BIGINT AS model_errors FROM z""",
    "promote_concepts": OBSERVATIONS + """
, b AS (SELECT *, 'L' || level || ':' || key AS base, count(*) OVER (PARTITION BY level, key) AS many FROM decided WHERE passed AND level < 2)
SELECT CASE WHEN many > 1 THEN base || '@' || sha1(parents)[1:8] ELSE base END AS id, level, key AS label, parents FROM b""",
    "validate_rules": PART_LABELS + r"""
, w AS (SELECT p_partkey AS id, level, label, regexp_matches(label, '(?i)workshop$') AS fw, regexp_matches(label, '(?i)kdd$') AS fk, level = 3 AND regexp_matches(label, '(?i)kdd') AS vk, level = 3 AND regexp_matches(label, '(?i)workshop$') AS vw, level = 2 AND NOT contains(lower(label), 'r') AS voc FROM q),
x AS (SELECT id, list_filter([CASE WHEN fw THEN 'forbidden_pattern:workshop$' END, CASE WHEN fk THEN 'forbidden_pattern:kdd$' END, CASE WHEN vw AND fw THEN 'venue_name_detected:workshop$' END, CASE WHEN voc THEN 'missing_required_vocab:2' END], lambda v: v IS NOT NULL) AS hard, list_filter([CASE WHEN vk THEN 'venue_name_detected:kdd' END, CASE WHEN vw AND NOT fw THEN 'venue_name_detected:workshop$' END], lambda v: v IS NOT NULL) AS soft FROM w)
SELECT id, len(hard) = 0 AS passed, len(hard) > 0 AS hard_fail, array_to_string(hard, '|') AS hard, array_to_string(soft, '|') AS soft,
 CASE WHEN len(hard) + len(soft) = 0 THEN 'Rule checks succeeded' ELSE array_to_string(list_filter([CASE WHEN len(hard) > 0 THEN len(hard) || ' hard' END, CASE WHEN len(soft) > 0 THEN len(soft) || ' soft' END], lambda v: v IS NOT NULL), ', ') || ' violations; most significant: ' || coalesce(hard[1], soft[1]) END AS summary FROM x""",
    "rule_findings": PART_LABELS + """
, w AS (SELECT unnest(CASE WHEN level = 3 AND contains(lower(label), 'kdd') THEN ['Rule warning: venue_name_detected:kdd'] ELSE ['All deterministic rule checks passed.'] END) AS detail FROM q)
SELECT 'rule' AS mode, detail LIKE 'All%' AS passed, detail, count(*) AS findings FROM w GROUP BY ALL""",
    "evidence_mentions": MENTIONS + "SELECT id, snap FROM m",
    "evidence_snippets": MENTIONS + "SELECT id, snap, pos, round(score, 6)::DOUBLE AS score FROM sc",
    "evidence_topk": MENTIONS + "SELECT id, snap, pos, round(score, 6)::DOUBLE AS score, CAST(rank AS INTEGER) AS rank FROM rk WHERE rank <= 3",
    "evidence_pack": MENTIONS + """
, u AS (SELECT *, sum(len(snippet)) OVER (PARTITION BY id ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total FROM rk WHERE rank <= 5 AND snippet <> '')
SELECT id, count(*) AS snippets, CAST(max(rank) AS INTEGER) AS last FROM u WHERE rank = 1 OR total <= 400 GROUP BY id""",
    "validate_vote": MENTIONS + """
, top AS (SELECT id, count(*) AS n, avg(score) AS mean FROM rk WHERE rank <= 3 GROUP BY id),
v AS (SELECT c.id, level, label, coalesce(n, 0) AS n, coalesce(mean, 0) AS mean, CAST(c.id[2:] AS INTEGER) % 3 = 0 AS model FROM c LEFT JOIN top USING (id)),
sums AS (SELECT *, 1.0 AS rule_, CASE WHEN n >= 1 THEN 0.7 ELSE 0.0 END AS web_, CASE WHEN model THEN 0.4 ELSE 0.0 END AS model_ FROM v)
SELECT id, rule_ + web_ + model_ > 1.05 + 1e-9 AS passed, round((rule_ + web_ + model_) / 2.1, 6)::DOUBLE AS confidence, rule_::DOUBLE AS rule, web_::DOUBLE AS web, model_::DOUBLE AS model FROM sums""",
    "validate_model": MENTIONS + """
, top AS (SELECT id, count(*) FILTER (snippet <> '') AS n, avg(score) AS mean FROM rk WHERE rank <= 3 GROUP BY id HAVING count(*) FILTER (snippet <> '') > 0)
SELECT c.id, coalesce(n > 1, false) AS passed, (CASE WHEN n IS NULL THEN 0.0 ELSE round(0.45 + 0.5 * least(1.0, mean), 6) END)::DOUBLE AS confidence,
       CASE WHEN n IS NULL THEN 'No evidence' WHEN n > 1 THEN 'Entailment passed' ELSE 'Entailment failed' END AS summary FROM c LEFT JOIN top USING (id)""",
    "context_windows": TALK + "SELECT concept_id, n, text, institution FROM w",
    "context_limited": TALK + """
, k AS (SELECT *, row_number() OVER (PARTITION BY concept_id ORDER BY institution, n, text) AS r FROM w),
once AS (SELECT DISTINCT concept_id, text FROM k WHERE r <= 5)
SELECT concept_id, count(*) AS contexts FROM once GROUP BY concept_id""",
    "token_cooccurrence": "SELECT token, count(*) AS count FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z0-9'']+')) AS token FROM conversations) GROUP BY token HAVING count(*) >= 3",
    "ambiguity_scores": SENSES + "SELECT label, size, round(pd, 6) AS parent_divergence, round(id_, 6) AS institution_divergence, round(least(1.0, 0.4 * pd + 0.35 + 0.25 * id_), 6) AS score, 'flagged' AS status FROM s",
    "split_shares": """
WITH w AS (SELECT p_partkey, p_partkey + 1 AS total, [p_size::DOUBLE, 3.0, 5.0] AS w FROM part),
b AS (SELECT p_partkey, total, list_transform(w, lambda x: CAST(round_even(total * (x / list_sum(w)), 0) AS BIGINT)) AS s FROM w),
d AS (SELECT p_partkey, s, CAST(total - list_sum(s) AS BIGINT) AS d FROM b),
f AS (SELECT p_partkey, s, d, list_position(list_transform(s, lambda x: x > 0), true) AS first FROM d)
SELECT p_partkey, s[1] + CASE WHEN d = 1 OR (d = -1 AND first = 1) THEN d ELSE 0 END AS s0, s[2] + CASE WHEN d = -1 AND first = 2 THEN d ELSE 0 END AS s1, s[3] + CASE WHEN d = -1 AND first = 3 THEN d ELSE 0 END AS s2 FROM f""",
    "parent_exact": """
WITH a AS (SELECT DISTINCT CASE p_partkey % 4 WHEN 0 THEN 'Department of ' || array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), ' ') WHEN 1 THEN upper(p_type) WHEN 2 THEN 'school of ' || lower(p_type) ELSE 'zzz ' || p_brand END AS anchor FROM part)
SELECT anchor, CASE WHEN anchor LIKE 'Department of %' THEN 'L1:' || lower(anchor[15:]) WHEN anchor LIKE 'school of %' THEN 'L0:' || anchor[11:] ELSE 'L0:' || lower(anchor) END AS parent_ids FROM a WHERE anchor NOT LIKE 'zzz %'""",
    "parent_unresolved": "SELECT DISTINCT 'zzz ' || p_brand AS anchor, 'UNRESOLVED:zzz ' || p_brand AS parent_ids FROM part WHERE p_partkey % 4 = 3",
    "consolidate_levels": OBSERVATIONS + "SELECT level, count(*) AS candidates FROM decided WHERE passed GROUP BY level",
    "hierarchy_edges": TREE + "SELECT parent, child FROM edges",
    "hierarchy_orphans": TREE + "SELECT id AS concept_id, level, parents, 'quarantine' AS strategy FROM lost UNION ALL SELECT id, level, array_to_string(parents, '|'), 'error' FROM several",
    "hierarchy_stats": TREE + """
SELECT (SELECT count(*) FROM nodes) AS node_count, (SELECT count(*) FROM nodes WHERE level = 0) AS level_0, (SELECT count(*) FROM nodes WHERE level = 1) AS level_1, (SELECT count(*) FROM nodes WHERE level = 2) AS level_2, (SELECT count(*) FROM nodes WHERE level = 3) AS level_3,
 (SELECT max(k) FROM (SELECT count(*) AS k FROM edges GROUP BY parent)) AS max_out_degree, (SELECT max(k) FROM (SELECT count(*) AS k FROM edges GROUP BY child)) AS max_in_degree, (SELECT count(*) FROM edges) AS edge_count""",
    "hierarchy_paths": TREE.replace("WITH n AS", "WITH RECURSIVE n AS") + ", path AS (SELECT id, level, id AS path FROM nodes WHERE level = 0 UNION ALL SELECT n.id, n.level, p.path || ' > ' || n.id FROM path p JOIN edges e ON e.parent = p.id JOIN nodes n ON n.id = e.child) SELECT id, level, path FROM path",
    "hierarchy_violations": TREE + "SELECT 'non-unique-path' AS code, id AS concept_id FROM all_ WHERE len(parents) > 1",
    "hierarchy_placeholders": TREE + """
, held AS (SELECT a.id, a.level FROM all_ a JOIN lost USING (id) WHERE len(list_filter(list_distinct(a.parents), lambda x: NOT list_contains(string_split(lost.parents, '|'), x))) = 0),
every AS (SELECT level FROM nodes UNION ALL SELECT level FROM held UNION ALL SELECT k FROM range(3) AS r(k) WHERE k < (SELECT max(level) FROM lost))
SELECT CAST(level AS INTEGER) AS level, count(*) AS nodes FROM every GROUP BY level""",
    "hierarchy_adjacency": TREE + "SELECT id, count(child) AS children FROM nodes LEFT JOIN edges ON parent = id GROUP BY id",
    "eval_f1": """
WITH r AS (SELECT p_type, list_distinct(list_transform(string_split(p_name || ' ' || p_type, ' '), lambda x: lower(x))) AS e, CASE WHEN p_partkey % 5 = 0 THEN [] ELSE list_distinct(list_transform(string_split(p_name || ' ' || p_brand, ' '), lambda x: lower(x))) END AS f FROM part),
m AS (SELECT p_type, CASE WHEN len(f) = 0 THEN 0.0 ELSE len(list_intersect(e, f)) / len(f) END AS p, len(list_intersect(e, f)) / len(e) AS r FROM r)
SELECT p_type, round(avg(p), 6) AS precision, round(avg(r), 6) AS recall, round(avg(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END), 6) AS f1, count(*) AS examples FROM m GROUP BY p_type""",
    "stage_quality": "SELECT issue, count(*) AS rows FROM (SELECT unnest(list_filter([CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'status' END, CASE WHEN NOT o_totalprice < 300000 THEN 'price' END, CASE WHEN NOT regexp_matches(o_orderpriority, '^[12]-') THEN 'priority' END, '<rows>'], lambda x: x IS NOT NULL)) AS issue FROM orders) GROUP BY issue",
    "stage_timing": """
WITH e AS (SELECT event_type AS stage, round(sum(value), 2) AS seconds, count(*) AS items FROM events GROUP BY event_type)
SELECT stage, round(seconds / sum(seconds) OVER (), 6) AS share, round(items / seconds, 6) AS per_second, seconds = max(seconds) OVER () AS bottleneck, round(seconds * 1000000 / items, 2) AS projected FROM e""",
    "baseline_deltas": """
WITH a AS (SELECT event_type, count(*) AS now FROM events WHERE day(ts) > 15 GROUP BY 1), b AS (SELECT event_type, count(*) AS before FROM events WHERE day(ts) <= 15 AND event_type <> 'error' GROUP BY 1)
SELECT event_type, now, before, now - before AS delta, round(now / before, 6) AS ratio FROM a FULL JOIN b USING (event_type)""",
    "call_metrics": """
WITH t AS (SELECT value, user_id + 1 AS tokens FROM events ORDER BY event_id DESC LIMIT 200)
SELECT count(*) AS calls, count(*) FILTER (event_type <> 'error') AS succeeded, count(*) FILTER (event_type = 'error') AS failed, (SELECT round(median(value), 6) FROM t) AS p50_ms, (SELECT round(list_sort(list(value))[CAST(floor(0.95 * (count(*) - 1)) AS INTEGER) + 1], 6) FROM t) AS p95_ms, (SELECT CAST(sum(tokens) AS BIGINT) FROM t) AS tokens FROM events""",
    "quarantine_counts": "SELECT event_type AS reason, count(*) AS items FROM events WHERE event_type = 'error' OR value > 20 GROUP BY event_type",
}
