"""The same queries as plain SQL over the given tables, for comparison on another engine."""

from ..sources import default_dictionaries as defaults
from ..schemas import CATEGORY_LEAVES, LOWERED_FIELDS, POST_FIELDS, SERVICE_LEAVES
from ..sources.dictionaries import Dictionaries
from .inputs import MENTIONS, TITLES

FIELDS = ", ".join(POST_FIELDS)


def q(s):
    return "'" + s.replace("'", "''") + "'"


def values(rows):
    return "VALUES " + ", ".join("(" + ", ".join(q(v) for v in row) + ")" for row in rows)


def items(xs):
    return "[" + ", ".join(q(x) for x in xs) + "]"


def _pairs(taxonomy):
    return [(g, t) for g, terms in taxonomy.items() for t in dict.fromkeys(terms)]


POSTS = f"""posts AS (
  SELECT doc_id * 2 + i AS arrival, doc_id, i AS scrape,
    'J' || CAST(doc_id - doc_id % 3 AS VARCHAR) AS Job_ID,
    ({items(TITLES)})[CAST(doc_id % {len(TITLES)} + 1 AS INTEGER)] AS Title,
    'Company ' || CAST(doc_id % 23 AS VARCHAR) AS Company_name,
    upper(lang) AS Location,
    CASE WHEN doc_id % 17 = 0 THEN NULL WHEN doc_id % 13 = 0 THEN '15/03/2024'
         WHEN doc_id % 19 = 0 THEN '2024-02-30'
         ELSE '2024-0' || CAST(1 + doc_id % 9 AS VARCHAR) || '-15' END AS Pubblication_date,
    CASE WHEN i = 1 THEN ({items(MENTIONS)})[CAST(doc_id % {len(MENTIONS)} + 1 AS INTEGER)] || '. ' || text
         WHEN doc_id % 7 = 0 THEN ' ' || chr(9) || ' ' WHEN doc_id % 2 = 0 THEN '' END AS Description,
    CASE WHEN doc_id % 4 = 0 THEN 'Entry level' ELSE 'Mid-Senior level' END AS Seniority_level,
    CASE WHEN doc_id % 5 = 0 THEN 'Contract' ELSE 'Full-time' END AS Employment_type,
    'Engineering' AS Job_Function, 'Industry ' || source AS Industry_type
  FROM documents CROSS JOIN (VALUES (0), (1)) v(i))"""

DICTIONARIES = f"""title_alias(alias, canonical) AS ({values(defaults.TITLE_ALIASES.items())}),
skill_alias(alias, canonical) AS ({values(defaults.SKILL_ALIASES.items())}),
topics(grp, term) AS ({values(_pairs(defaults.TOPICS))}),
services(grp, term) AS ({values(_pairs(defaults.CLOUD_SERVICES))}),
lexicon(term) AS ({values([(t,) for t in Dictionaries().lexicon()])})"""

TOKENS = r"""word_lists AS (
  SELECT arrival, list_filter(list_transform(
      string_split_regex(lower(Description), '[\s\x0b\x{85}\x{a0},;:()!?"\x{2000}-\x{206f}\x{3000}]+'),
      lambda t: rtrim(t, '.')), lambda t: t <> '') AS l
  FROM posts WHERE Description IS NOT NULL),
words AS (SELECT arrival, unnest(l) AS token, generate_subscripts(l, 1) - 1 AS pos FROM word_lists)"""

# Mentions: all lexicon hits, then leftmost-longest without overlap by following pointers.
HITS = """nexts AS (
  SELECT arrival, pos, token AS t1, lead(token, 1) OVER w AS t2, lead(token, 2) OVER w AS t3,
    lead(token, 3) OVER w AS t4
  FROM words WINDOW w AS (PARTITION BY arrival ORDER BY pos)),
grams AS (
  SELECT arrival, pos, 1 AS n, t1 AS term FROM nexts
  UNION ALL SELECT arrival, pos, 2, t1 || ' ' || t2 FROM nexts WHERE t2 IS NOT NULL
  UNION ALL SELECT arrival, pos, 3, t1 || ' ' || t2 || ' ' || t3 FROM nexts WHERE t3 IS NOT NULL
  UNION ALL SELECT arrival, pos, 4, t1 || ' ' || t2 || ' ' || t3 || ' ' || t4 FROM nexts WHERE t4 IS NOT NULL),
hits AS (SELECT g.* FROM grams g JOIN lexicon USING (term)),
longest AS (SELECT arrival, pos, max(n) AS n FROM hits GROUP BY arrival, pos),
following AS (
  SELECT a.arrival, a.pos, min(b.pos) AS next_pos
  FROM longest a JOIN longest b ON a.arrival = b.arrival AND a.pos + a.n <= b.pos GROUP BY a.arrival, a.pos),
picked AS (
  SELECT arrival, min(pos) AS pos FROM longest GROUP BY arrival
  UNION ALL
  SELECT p.arrival, f.next_pos FROM picked p JOIN following f USING (arrival, pos)),
found AS (
  SELECT h.arrival, h.pos, h.n, h.term
  FROM picked JOIN longest USING (arrival, pos) JOIN hits h USING (arrival, pos, n)),
mentioned AS (SELECT DISTINCT arrival, term FROM found)"""

SKILLS = """skills AS (
  SELECT DISTINCT m.arrival, coalesce(a.canonical, m.term) AS skill
  FROM mentioned m LEFT JOIN skill_alias a ON a.alias = m.term),
leaves AS (
  SELECT arrival, 'category' AS kind, grp, skill AS term FROM skills JOIN topics t ON skill = t.term
  UNION SELECT arrival, 'service', grp, skill FROM skills JOIN services s ON skill = s.term
  UNION SELECT arrival, 'category', 'cloud_providers', grp FROM skills JOIN services s ON skill = s.term)"""

LOWERED = """normal AS (
  SELECT arrival, Job_ID, coalesce(a.canonical, lower(Title)) AS Title, lower(Company_name) AS Company_name,
    lower(Location) AS Location, Pubblication_date, lower(Seniority_level) AS Seniority_level,
    lower(Employment_type) AS Employment_type, lower(Job_Function) AS Job_Function,
    lower(Industry_type) AS Industry_type
  FROM posts LEFT JOIN title_alias a ON a.alias = lower(Title))"""

BASE = f"WITH RECURSIVE {POSTS}, {DICTIONARIES}"
TEXTS = f"{BASE}, {TOKENS}, {HITS}"
FULL = f"{TEXTS}, {SKILLS}, {LOWERED}"


def _leaf_columns():
    out = []
    for kind, prefix, groups in (("category", "cat", CATEGORY_LEAVES), ("service", "svc", SERVICE_LEAVES)):
        for g in groups:
            out.append(
                f"coalesce(string_agg(term, '|' ORDER BY term) FILTER (kind = '{kind}' AND grp = '{g}'), '')"
                f" AS {prefix}_{g}"
            )
    return ", ".join(out)


def _leaf_names():
    return [f"cat_{c}" for c in CATEGORY_LEAVES] + [f"svc_{c}" for c in SERVICE_LEAVES]


def _leaves_of(posts, extra):
    names = ", ".join(f"coalesce(l.{c}, '') AS {c}" for c in _leaf_names())
    return f"""SELECT {extra}, coalesce(r.raw_skills, '') AS raw_skills, {names}
FROM {posts} p
LEFT JOIN (SELECT arrival, string_agg(skill, '|' ORDER BY skill) AS raw_skills FROM skills GROUP BY arrival) r
  USING (arrival)
LEFT JOIN (SELECT arrival, {_leaf_columns()} FROM leaves GROUP BY arrival) l USING (arrival)"""


_NORMAL_COLUMNS = (
    "p.arrival, p.Job_ID, p.Title, p.Company_name, p.Location, p.Pubblication_date, p.Seniority_level, "
    "p.Employment_type, p.Job_Function, p.Industry_type"
)
_SKILL_LISTS = "(SELECT arrival, string_agg(term, '|' ORDER BY term) AS skills FROM mentioned GROUP BY arrival)"

# The payloads that do not decode, and the fields that come back changed.
_BAD = "arrival % 50 IN (7, 11, 13)"
_DECODED = ", ".join(
    f"CASE WHEN {_BAD} THEN NULL "
    + (
        "WHEN arrival % 50 = 17 THEN NULL WHEN arrival % 50 = 19 THEN substr(Job_ID, 2) ELSE Job_ID"
        if c == "Job_ID"
        else "WHEN arrival % 50 = 23 THEN '{\"a\":1}' ELSE Job_Function"
        if c == "Job_Function"
        else f"ELSE {c}"
    )
    + f" END AS {c}"
    for c in POST_FIELDS
)

BIO = """bio AS (
  SELECT doc, pos, CASE WHEN pos % 11 = 5 THEN '[SEP]' WHEN pos % 4 = 3 THEN '##' || t ELSE t END AS token,
    CASE (doc * 31 + pos * 17) % 5 WHEN 0 THEN 'B-SKILL' WHEN 1 THEN 'I-SKILL' WHEN 2 THEN 'I-SKILL' ELSE 'O' END AS label
  FROM (SELECT doc_id AS doc, unnest(string_split(text, ' ')) AS t,
          generate_subscripts(string_split(text, ' '), 1) - 1 AS pos FROM documents)),
kept AS (SELECT * FROM bio WHERE token NOT IN ('[CLS]', '[SEP]', '[PAD]'))"""


def strict_spans(rows, key, label, token="token"):
    return f"""(SELECT {key}, min(pos) AS first_pos, max(pos) AS last_pos, string_agg({token}, ' ' ORDER BY pos) AS tokens
  FROM (SELECT *, sum(CASE WHEN {label} = 'I-SKILL' THEN 0 ELSE 1 END) OVER (PARTITION BY {key} ORDER BY pos) AS g FROM {rows})
  GROUP BY {key}, g HAVING arg_min({label}, pos) = 'B-SKILL')"""


def conll_spans(rows, key, label, token="token"):
    return f"""(SELECT {key}, min(pos) AS first_pos, max(pos) AS last_pos, string_agg({token}, ' ' ORDER BY pos) AS tokens
  FROM (SELECT *, sum(opens) OVER (PARTITION BY {key} ORDER BY pos) AS g
        FROM (SELECT *, CASE WHEN {label} = 'B-SKILL' OR ({label} = 'I-SKILL' AND
                coalesce(lag({label}) OVER (PARTITION BY {key} ORDER BY pos), 'O') = 'O') THEN 1 ELSE 0 END AS opens
              FROM {rows}))
  WHERE {label} <> 'O' GROUP BY {key}, g)"""


_GLUED = r"regexp_replace(replace(tokens, ' ##', ''), '^\s+|\s+$', '', 'g')"

OLD_NEW = f"""{POSTS},
keyed AS (SELECT * REPLACE (CASE WHEN arrival % 10 = 0 THEN 'old-' WHEN arrival % 14 = 1 THEN 'new-' ELSE '' END
  || CAST(doc_id AS VARCHAR) AS Job_ID, CASE WHEN arrival % 6 <> 5 THEN Location END AS Location) FROM posts),
o AS (SELECT * FROM keyed WHERE scrape = 0),
n AS (SELECT * FROM keyed WHERE scrape = 1)"""

_UPSERTED = f"""WITH {OLD_NEW}
SELECT coalesce(n.Job_ID, o.Job_ID) AS Job_ID, coalesce(n.arrival, o.arrival) AS arrival,
  coalesce(n.Title, o.Title) AS Title, coalesce(n.Location, o.Location) AS Location,
  coalesce(n.Pubblication_date, o.Pubblication_date) AS Pubblication_date,
  coalesce(n.Description, o.Description) AS Description
FROM o FULL JOIN n ON o.Job_ID = n.Job_ID"""

STORED = f"""{POSTS},
stored AS (SELECT * FROM posts WHERE Company_name <> 'Company 7'
  QUALIFY row_number() OVER (PARTITION BY Job_ID ORDER BY arrival) = 1)"""

# Text of the page fields: tags out, the entities that occur decoded.
_PAGE_TEXT = (
    "regexp_replace(replace(replace(replace(replace(regexp_replace({0}, '<[^>]+>', '', 'g'), "
    "'&quot;', '\"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), '^\\s+|\\s+$', '', 'g')"
)

DETAILS = f"""details AS (
  SELECT doc_id, doc_id * 2 + i AS job, i,
    CASE WHEN i = 0 THEN regexp_replace(({items(MENTIONS)})[CAST(doc_id % {len(MENTIONS)} + 1 AS INTEGER)] || text,
      '^\\s+|\\s+$', '', 'g') ELSE '' END AS Description,
    CASE WHEN i = 0 THEN 'Entry level' ELSE '' END AS item_1,
    CASE WHEN i = 0 THEN CASE WHEN doc_id % 5 = 0 THEN 'Contract' ELSE 'Full-time' END ELSE '' END AS item_2,
    CASE WHEN i = 0 THEN NULL ELSE '' END AS item_3,
    CASE WHEN i = 0 THEN source || ' <x>' ELSE '' END AS item_4,
    '' AS item_5, lang, source
  FROM documents CROSS JOIN (VALUES (0), (1)) v(i))"""

SEQUENCES = """labelled AS (
  SELECT doc, pos, token, CASE (doc * 31 + pos * 17) % 5 WHEN 0 THEN 'B-SKILL' WHEN 1 THEN 'I-SKILL' WHEN 2 THEN 'I-SKILL' ELSE 'O' END AS label
  FROM (SELECT doc_id AS doc, unnest(string_split(text, ' ')) AS token,
          generate_subscripts(string_split(text, ' '), 1) - 1 AS pos FROM documents)),
split AS (
  SELECT doc_id AS doc, CASE WHEN row_number() OVER (ORDER BY md5('2:' || CAST(doc_id AS VARCHAR)), CAST(doc_id AS VARCHAR))
    <= ceil(CAST(0.2 AS DOUBLE) * count(*) OVER ()) THEN 'val' ELSE 'train' END AS split FROM documents),
vocab AS (
  SELECT token, CAST('0x' || substr(md5(token), 1, 6) AS INTEGER) + 200 AS id
  FROM (SELECT DISTINCT unnest(string_split(text, ' ')) AS token FROM benchmark)),
encoded AS (
  SELECT l.doc, s.split, count(*) + 2 AS n,
    '101|' || string_agg(CAST(coalesce(v.id, 100) AS VARCHAR), '|' ORDER BY pos) || '|102' AS input_ids,
    repeat('1|', count(*) + 1) || '1' AS attention_mask,
    '-100|' || string_agg(CASE label WHEN 'O' THEN '0' WHEN 'B-SKILL' THEN '1' ELSE '2' END, '|' ORDER BY pos) || '|-100' AS labels
  FROM labelled l JOIN split s USING (doc) LEFT JOIN vocab v USING (token) GROUP BY l.doc, s.split)"""

SCORED = """scored AS (
  SELECT doc, pos, CASE WHEN pos = 0 OR pos = n - 1 THEN -100 ELSE ((doc * 31 + pos * 17) % 5) % 3 END AS gold_id,
    CASE WHEN s0 >= s1 AND s0 >= s2 THEN 0 WHEN s1 >= s2 THEN 1 ELSE 2 END AS pred_id
  FROM (SELECT doc, pos, n, (length(t) * 7 + pos * 3) % 11 AS s0, (length(t) * 8 + pos * 4) % 11 AS s1,
          (length(t) * 9 + pos * 5) % 11 AS s2
        FROM (SELECT doc_id AS doc, unnest(string_split(text, ' ')) AS t, len(string_split(text, ' ')) AS n,
                generate_subscripts(string_split(text, ' '), 1) - 1 AS pos FROM documents))),
aligned AS (
  SELECT doc, pos, ['O', 'B-SKILL', 'I-SKILL'][gold_id + 1] AS gold, ['O', 'B-SKILL', 'I-SKILL'][pred_id + 1] AS pred, '' AS token
  FROM scored WHERE gold_id <> -100)"""


def _prf(spans):
    return f"""WITH {SCORED},
g AS {spans('aligned', 'doc', 'gold')},
p AS {spans('aligned', 'doc', 'pred')},
totals AS (SELECT
  (SELECT count(*) FROM g JOIN p USING (doc, first_pos, last_pos)) AS tp,
  (SELECT count(*) FROM g) AS gold_spans, (SELECT count(*) FROM p) AS pred_spans)
SELECT tp, gold_spans, pred_spans,
  CASE WHEN pred_spans > 0 THEN CAST(tp AS DOUBLE) / pred_spans ELSE 0.0 END AS precision,
  CASE WHEN gold_spans > 0 THEN CAST(tp AS DOUBLE) / gold_spans ELSE 0.0 END AS recall,
  CASE WHEN gold_spans + pred_spans > 0 THEN CAST(2 * tp AS DOUBLE) / (gold_spans + pred_spans) ELSE 0.0 END AS f1
FROM totals"""


def _by(column):
    return f"""{FULL}, counts AS (
  SELECT {column}, skill, count(*) AS posts FROM skills JOIN normal USING (arrival) GROUP BY {column}, skill)
SELECT {column}, skill, posts, CAST(row_number() OVER (PARTITION BY {column} ORDER BY posts DESC, skill) AS INTEGER) AS rank
FROM counts QUALIFY rank <= 5"""


_E1 = f"{FULL} " + _leaves_of("normal", _NORMAL_COLUMNS)
_STREAMED = f"{FULL} " + _leaves_of(
    "(SELECT * REPLACE ('P' || CAST(arrival AS VARCHAR) AS Job_ID) FROM normal WHERE arrival % 50 <> 7)",
    _NORMAL_COLUMNS.replace("p.arrival, ", ""),
)

ORACLE = {
    "s1_payload_stream": f"WITH {POSTS} SELECT {_DECODED} FROM posts",
    "s2_decode_payload": f"WITH {POSTS} SELECT arrival, {_DECODED} FROM posts",
    "s2_quarantine": f"""WITH {POSTS} SELECT CASE WHEN {_BAD} OR arrival % 50 = 17 THEN 'rejected' ELSE 'good' END AS status,
count(*) AS n FROM posts GROUP BY 1""",
    "s3_landing_stream": f"WITH {POSTS} SELECT {FIELDS} FROM posts WHERE Description <> ''",
    "s4_posts_json": f"WITH {POSTS} SELECT {FIELDS} FROM posts",
    "s4_json_lines": f"WITH {POSTS} SELECT {FIELDS} FROM posts",
    "s4_malformed_documents": f"""WITH {POSTS} SELECT CASE WHEN arrival % 10 <> 0 THEN Job_ID END AS Job_ID,
CASE WHEN arrival % 10 <> 0 THEN Title END AS Title, CASE WHEN arrival % 10 = 0 THEN 'broken ' || arrival END AS raw FROM posts""",
    "s5_labelled_files": """SELECT doc_id AS doc, CASE WHEN doc_id % 25 = 1 THEN 'invalid JSON'
  WHEN doc_id % 40 = 3 THEN 'no tokens' ELSE 'good' END AS status,
CASE WHEN doc_id % 25 = 1 OR doc_id % 40 = 3 THEN 0 ELSE CAST(len(string_split(text, ' ')) AS INTEGER) END AS n_tokens FROM documents""",
    "s6_alias_map_usage": f"""{BASE} SELECT alias, canonical, count(arrival) AS posts
FROM title_alias LEFT JOIN posts ON lower(Title) = alias GROUP BY alias, canonical""",
    "s7_taxonomy_usage": f"""{TEXTS} SELECT grp AS "group", t.term, count(arrival) AS posts
FROM topics t LEFT JOIN mentioned m ON m.term = t.term GROUP BY grp, t.term""",
    "s8_upsert_merge": _UPSERTED,
    "s8_upsert_stream": _UPSERTED,
    "s9_overwrite_by_key": f"""WITH {OLD_NEW}
SELECT Job_ID, arrival, Title, Location, Description FROM n
UNION ALL SELECT Job_ID, arrival, Title, Location, Description FROM o WHERE Job_ID NOT IN (SELECT Job_ID FROM n)""",
    "s9_overwrite_last_wins": f"""WITH {STORED}, n AS (SELECT * FROM posts WHERE Company_name <> 'Company 3'
  QUALIFY row_number() OVER (PARTITION BY Job_ID ORDER BY arrival DESC) = 1)
SELECT Job_ID, arrival, Title, Description FROM n
UNION ALL SELECT Job_ID, arrival, Title, Description FROM stored WHERE Job_ID NOT IN (SELECT Job_ID FROM n)""",
    "s10_payload_round_trip": f"WITH {POSTS} SELECT {FIELDS} FROM posts",
    "s10_topic_folder": f"WITH {POSTS} SELECT {FIELDS} FROM posts",
    "s11_fan_out": f"""WITH {POSTS} SELECT sink, arrival, Description
FROM posts CROSS JOIN (VALUES ('table'), ('topic')) v(sink) WHERE Description <> ''""",
    "s12_posts_json_sink": f"""{TEXTS} SELECT arrival, Job_ID, Title, coalesce(skills, '') AS skills
FROM posts LEFT JOIN {_SKILL_LISTS} USING (arrival)""",
    "s13_ensure_table": f"""WITH {POSTS}, firsts AS (SELECT * FROM posts WHERE Description <> ''
  QUALIFY row_number() OVER (PARTITION BY Job_ID ORDER BY arrival) = 1)
SELECT Job_ID, Title, Pubblication_date FROM firsts
WHERE Pubblication_date IS NULL OR TRY_CAST(CASE WHEN Pubblication_date LIKE '____-__-__' THEN Pubblication_date END AS DATE) IS NOT NULL""",
    "s14_validate_dates": f"""WITH {POSTS} SELECT arrival, Pubblication_date, CASE WHEN Pubblication_date IS NULL
  OR TRY_CAST(CASE WHEN Pubblication_date LIKE '____-__-__' THEN Pubblication_date END AS DATE) IS NOT NULL
  THEN 'good' ELSE 'quarantine' END AS status FROM posts""",
    "s15_resume": f"""WITH {POSTS} SELECT CAST(0 AS BIGINT) AS run, CAST(scrape AS BIGINT) AS batch, count(*) AS posts
FROM posts GROUP BY scrape""",
    "h1_explode_cards": """SELECT page_id, unnest(l) AS card, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS card_no
FROM (SELECT page_id, regexp_extract_all(html, '(?s)<li>(<a href="[^"]*">.*?</a>)</li>', 1) AS l FROM pages)""",
    "h2_html_text": f"""SELECT page_id, CASE WHEN h1 = '' THEN NULL ELSE h1 END AS h1, '' AS h2, CAST(NULL AS VARCHAR) AS blank
FROM (SELECT page_id, {_PAGE_TEXT.format("regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1)")} AS h1 FROM pages)""",
    "h3_html_attr": """SELECT page_id, regexp_extract(html, '<a href="([^"]*)"', 1) AS href, '' AS datetime,
CAST(NULL AS VARCHAR) AS title FROM pages""",
    "h4_urn_part": """SELECT doc_id AS page_id, i AS card_no, CAST(doc_id * 2 + i AS VARCHAR) AS Job_ID, '' AS missing
FROM documents CROSS JOIN (VALUES (0), (1)) v(i)""",
    "h5_html_block_text": f"""SELECT page_id,
{_PAGE_TEXT.format("regexp_extract(html, '(?s)<article>(.*?)</article>', 1)")} AS body FROM pages""",
    "h5_nested_block_text": f"WITH {DETAILS} SELECT CAST(job AS VARCHAR) AS Job_ID, Description FROM details",
    "h6_html_nth_item": f"""WITH {DETAILS} SELECT CAST(job AS VARCHAR) AS Job_ID, item_1, item_2, item_3, item_4, item_5
FROM details""",
    "h7_build_posts": f"""WITH {DETAILS} SELECT CAST(job AS VARCHAR) AS Job_ID,
CASE WHEN i = 0 THEN ({items(TITLES)})[CAST(doc_id % {len(TITLES)} + 1 AS INTEGER)] || ' & Co' ELSE 'Café é €' END AS Title,
CASE WHEN i = 0 THEN 'Company ' || source END AS Company_name,
CASE WHEN i = 0 THEN upper(lang) ELSE '' END AS Location,
CASE WHEN i = 0 THEN '2024-03-' || lpad(CAST(1 + doc_id % 28 AS VARCHAR), 2, '0') END AS Pubblication_date,
Description, item_1 AS Seniority_level, item_2 AS Employment_type, item_3 AS Job_Function, item_4 AS Industry_type
FROM details""",
    "h8_set_query_param": r"""SELECT page_id,
regexp_extract(url, '^[^?#]*') || '?' || CASE WHEN query = '' THEN '' ELSE query || '&' END || 'start=' || CAST(page_id * 10 AS VARCHAR) || frag AS added,
regexp_extract(url, '^[^?#]*') || '?' || CASE WHEN query = '' THEN 'page=7' WHEN query LIKE '%page=%'
  THEN regexp_replace(query, 'page=[^&]*', 'page=7') ELSE query || '&page=7' END || frag AS replaced
FROM (SELECT page_id, url, regexp_extract(url, '\?([^#]*)', 1) AS query, regexp_extract(url, '#.*$') AS frag FROM pages)""",
    "p1_drop_fields": f"WITH {POSTS} SELECT arrival, {FIELDS.replace('Description, ', '')} FROM posts",
    "p2_require_non_empty": f"WITH {POSTS} SELECT arrival, Job_ID, Description FROM posts WHERE Description <> ''",
    "p3_lower_columns": f"""WITH {POSTS} SELECT arrival, Job_ID, lower(Title) AS Title, lower(Company_name) AS Company_name,
lower(Location) AS Location, Pubblication_date, lower(Seniority_level) AS Seniority_level,
lower(Employment_type) AS Employment_type, lower(Job_Function) AS Job_Function, lower(Industry_type) AS Industry_type FROM posts""",
    "p4_blank_guard": f"""WITH {POSTS} SELECT arrival, coalesce(Description = '', TRUE) AS is_empty,
NOT coalesce(regexp_matches(Description, '\\S'), FALSE) AS is_blank FROM posts""",
    "p5_drop_description": f"""{TEXTS} SELECT arrival, {FIELDS.replace('Description, ', '')}, coalesce(skills, '') AS Skills,
CAST(CASE WHEN coalesce(skills, '') = '' THEN 0 ELSE len(string_split(skills, '|')) END AS INTEGER) AS n_skills
FROM posts LEFT JOIN {_SKILL_LISTS} USING (arrival)""",
    "p6_expand_struct": f"WITH {POSTS} SELECT arrival, Job_ID, Title FROM posts",
    "p7_non_empty_tokens": "SELECT doc_id AS doc, CAST(len(string_split(text, ' ')) AS INTEGER) AS n FROM documents WHERE text IS NOT NULL",
    "p8_skip_special_tokens": f"""WITH {BIO}, spans AS {strict_spans('kept', 'doc', 'label')}
SELECT d.doc_id AS doc, CAST(count(s.doc) AS INTEGER) AS n_spans,
  coalesce(string_agg({_GLUED}, '|' ORDER BY first_pos), '') AS spans
FROM documents d LEFT JOIN spans s ON s.doc = d.doc_id GROUP BY d.doc_id""",
    "j1_lookup_enrich": f"""WITH {STORED} SELECT p.arrival, p.Job_ID, CAST(s.arrival AS VARCHAR) AS old_arrival, s.Description AS old_description
FROM posts p LEFT JOIN stored s USING (Job_ID)""",
    "j2_reject_known": f"""WITH {STORED} SELECT arrival, Job_ID, Description FROM posts p
WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.Job_ID = p.Job_ID AND s.Description <> '')""",
    "j2_known_keys_indexed": f"""WITH {STORED} SELECT arrival, Job_ID, Description FROM posts p
WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.Job_ID = p.Job_ID AND s.Description <> '')""",
    "j3_normalize_title": f"{BASE}, {LOWERED} SELECT arrival, Title FROM normal",
    "j4_normalize_skills": f"""{FULL} SELECT arrival, coalesce(string_agg(skill, '|' ORDER BY skill), '') AS skills
FROM posts LEFT JOIN skills USING (arrival) GROUP BY arrival""",
    "j5_match_taxonomy": f"""{TEXTS} SELECT arrival, m.term AS skill, grp AS "group"
FROM mentioned m JOIN topics t ON t.term = m.term""",
    "x0_tokenize": f"""WITH {POSTS}, {TOKENS} SELECT arrival, array_to_string(l, ' ') AS tokens
FROM posts LEFT JOIN word_lists USING (arrival)""",
    "x1_label_tokens": f"""{TEXTS}, labelled AS (
  SELECT w.arrival, w.pos, w.token, CASE WHEN f.pos IS NULL THEN 'O' WHEN f.pos = w.pos THEN 'B-SKILL' ELSE 'I-SKILL' END AS label
  FROM words w LEFT JOIN (SELECT arrival, pos, unnest(range(pos, pos + n)) AS at FROM found) f
    ON f.arrival = w.arrival AND f.at = w.pos)
SELECT arrival, label, count(*) AS n, CAST(sum(pos) AS BIGINT) AS pos_sum, max(token) AS last_token FROM labelled GROUP BY arrival, label""",
    "x1_labelled_mentions": f"""{TEXTS}
SELECT w.arrival, CAST(w.pos AS INTEGER) AS pos, w.token, CASE WHEN f.pos = w.pos THEN 'B-SKILL' ELSE 'I-SKILL' END AS label
FROM words w JOIN (SELECT arrival, pos, unnest(range(pos, pos + n)) AS at FROM found) f
  ON f.arrival = w.arrival AND f.at = w.pos""",
    "x1_lexicon_hits": f"""{TEXTS} SELECT arrival, CAST(pos AS INTEGER) AS pos, n, term FROM hits h WHERE NOT EXISTS (
  SELECT 1 FROM hits b WHERE b.arrival = h.arrival AND b.n > h.n AND b.pos <= h.pos AND b.pos + b.n >= h.pos + h.n)""",
    "x1_lexicon_mentions": f"{TEXTS} SELECT arrival, pos, CAST(n AS INTEGER) AS n, term FROM found",
    "x1_spelled_lexicon": f"""WITH {POSTS}, {TOKENS}, spelled(form, term) AS (VALUES ('amazon web services', 'amazon (web) services'),
  ('node js', 'node. js'), ('oracle cloud', 'oracle, cloud!'), ('java', 'java'), ('c or cpp', 'c (or) cpp')),
lines AS (SELECT arrival, ' ' || array_to_string(l, ' ') || ' ' AS t FROM word_lists),
named AS (SELECT DISTINCT arrival, term FROM lines JOIN spelled ON contains(t, ' ' || form || ' '))
SELECT arrival, coalesce(string_agg(term, '|' ORDER BY term), '') AS skills FROM posts LEFT JOIN named USING (arrival) GROUP BY arrival""",
    "x2_custom_labeler": f"""WITH {POSTS}, w AS (
  SELECT arrival, unnest(l) AS token, generate_subscripts(l, 1) AS pos
  FROM (SELECT arrival, list_filter(string_split_regex(Description, '\\s+'), lambda t: t <> '') AS l FROM posts)),
lab AS (SELECT *, CASE WHEN length(token) >= 15 THEN 'B-SKILL' WHEN length(token) >= 12 THEN 'I-SKILL' ELSE 'O' END AS label FROM w),
spans AS {strict_spans('lab', 'arrival', 'label')},
texts AS (SELECT DISTINCT arrival, {_GLUED} AS span FROM spans)
SELECT arrival, coalesce(string_agg(span, '|' ORDER BY span), '') AS skills FROM posts LEFT JOIN texts USING (arrival) GROUP BY arrival""",
    "x3_truncate_tokens": f"""WITH {POSTS}, {TOKENS} SELECT arrival, count(*) AS n, arg_max(token, pos) AS last_token
FROM words WHERE pos < 512 GROUP BY arrival""",
    "w1_decode_bio": f"WITH {BIO} SELECT doc, first_pos, last_pos, tokens FROM {strict_spans('kept', 'doc', 'label')}",
    "w1_decode_bio_conll": f"WITH {BIO} SELECT doc, first_pos, last_pos, tokens FROM {conll_spans('kept', 'doc', 'label')}",
    "w1_decode_arrays": f"""{TEXTS} SELECT arrival, CASE WHEN any_value(Description) IS NULL THEN NULL
  ELSE coalesce(string_agg(term, '|' ORDER BY pos), '') END AS spans
FROM posts LEFT JOIN found USING (arrival) GROUP BY arrival""",
    "w2_span_text": f"""WITH {BIO} SELECT doc, first_pos, {_GLUED} AS span
FROM {strict_spans('kept', 'doc', 'label')} WHERE {_GLUED} <> ''""",
    "e1_enrich_posts": _E1,
    "e1_enrich_lexicon_table": _E1,
    "e2_extract_flat": f"""{TEXTS} SELECT arrival, {FIELDS.replace('Description, ', '')}, coalesce(skills, '') AS Skills
FROM posts LEFT JOIN {_SKILL_LISTS} USING (arrival)""",
    "a1_dedupe_first": f"""WITH {POSTS} SELECT arrival, {FIELDS} FROM posts WHERE Description <> ''
QUALIFY row_number() OVER (PARTITION BY Job_ID ORDER BY arrival) = 1""",
    "a2_distinct_skills": f"{TEXTS} SELECT arrival, skills FROM {_SKILL_LISTS}",
    "a3_categorize_skills": "",
    "a3_categorize_relational": f"""{TEXTS}, both_groups AS (
  SELECT arrival, grp, m.term FROM mentioned m JOIN topics t ON t.term = m.term
  UNION SELECT arrival, 'service:' || grp, m.term FROM mentioned m JOIN services s ON s.term = m.term
  UNION SELECT arrival, 'cloud_providers', grp FROM mentioned m JOIN services s ON s.term = m.term)
SELECT arrival, grp AS "group", string_agg(term, '|' ORDER BY term) AS skills FROM both_groups GROUP BY arrival, grp""",
    "a4_sorted_arrays": "SELECT doc_id, array_to_string(list_sort(list_distinct(string_split(text, ' '))), ' ') AS words FROM documents",
    "a5_order_tokens": f"""WITH {SEQUENCES} SELECT doc, string_agg(token, ' ' ORDER BY pos) AS tokens,
string_agg(label, ' ' ORDER BY pos) AS labels FROM labelled GROUP BY doc""",
    "a6_load_report": f"""WITH {POSTS} SELECT CASE WHEN Pubblication_date IS NULL
  OR TRY_CAST(CASE WHEN Pubblication_date LIKE '____-__-__' THEN Pubblication_date END AS DATE) IS NOT NULL
  THEN 'good' ELSE 'rejected' END AS status, count(*) AS n FROM posts GROUP BY 1""",
    "a7_longest_per_split": f"WITH {SEQUENCES} SELECT split, CAST(max(n) AS INTEGER) AS longest FROM encoded GROUP BY split",
    "a8_top_skills": f"{FULL} SELECT skill, count(*) AS posts FROM skills GROUP BY skill ORDER BY posts DESC, skill LIMIT 10",
    "a9_skills_by_title": _by("Title"),
    "a10_skills_by_industry": _by("Industry_type"),
    "a11_category_counts": f"""{FULL} SELECT kind, grp AS "group", term, count(*) AS posts FROM leaves GROUP BY kind, grp, term""",
    "a12_posts_over_time": f"""WITH {POSTS} SELECT CAST(CAST(date_trunc('month', TRY_CAST(
  CASE WHEN Pubblication_date LIKE '____-__-__' THEN Pubblication_date END AS DATE)) AS DATE) AS VARCHAR) AS period, count(*) AS posts
FROM posts GROUP BY 1""",
    "a13_facet": f"""{FULL} SELECT skill, count(*) AS posts FROM skills JOIN normal USING (arrival)
WHERE Seniority_level = 'entry level' AND arrival IN
  (SELECT arrival FROM leaves WHERE kind = 'category' AND grp = 'cloud_providers' AND term = 'aws')
GROUP BY skill ORDER BY posts DESC, skill LIMIT 10""",
    "a8_counts_kept_up": f"""{FULL}, kept AS (
  SELECT max(arrival) AS arrival, arg_max(Pubblication_date, arrival) FILTER (Pubblication_date IS NOT NULL) AS day
  FROM posts WHERE scrape = 1 GROUP BY Job_ID),
now AS (SELECT * FROM kept JOIN normal USING (arrival)),
facts AS (
  SELECT 'skill' AS view, NULL AS "group", skill AS term FROM skills SEMI JOIN kept USING (arrival)
  UNION ALL SELECT 'title', Title, skill FROM skills JOIN now USING (arrival)
  UNION ALL SELECT 'industry', Industry_type, skill FROM skills JOIN now USING (arrival)
  UNION ALL SELECT kind, grp, term FROM leaves SEMI JOIN kept USING (arrival)
  UNION ALL SELECT 'period', 'month', CAST(CAST(date_trunc('month', TRY_CAST(CASE WHEN day LIKE '____-__-__' THEN day END AS DATE)) AS DATE) AS VARCHAR) FROM kept
  {" ".join(f"UNION ALL SELECT 'facet', '{c}', {c} FROM now WHERE {c} IS NOT NULL" for c in LOWERED_FIELDS)})
SELECT view, "group", term, count(*) AS posts FROM facts GROUP BY view, "group", term""",
    "c6_dictionary_audit": f"""{TEXTS}, taxonomy AS (SELECT * FROM topics UNION ALL SELECT * FROM services),
audit AS (
  SELECT DISTINCT 'unreachable' AS issue, t.term, a.canonical AS detail FROM taxonomy t JOIN skill_alias a ON a.alias = t.term WHERE a.alias <> a.canonical
  UNION ALL SELECT 'alias_chain', a.alias, b.canonical FROM skill_alias a JOIN skill_alias b ON a.canonical = b.alias WHERE b.alias <> b.canonical
  UNION ALL SELECT 'multi_group', term, string_agg(DISTINCT grp, ',' ORDER BY grp) FROM taxonomy GROUP BY term HAVING count(DISTINCT grp) > 1
  UNION ALL SELECT DISTINCT 'uncategorised', lower(canonical), '' FROM skill_alias WHERE lower(canonical) NOT IN (SELECT term FROM taxonomy))
SELECT issue, a.term, detail, count(m.arrival) AS posts FROM audit a LEFT JOIN mentioned m ON m.term = a.term GROUP BY issue, a.term, detail""",
    "c6_alias_chains": """WITH RECURSIVE a AS (SELECT 'name-' || doc_id AS alias, 'name-' || CASE WHEN doc_id % 97 <> 0 THEN doc_id - 1
    WHEN doc_id % 2 = 0 THEN doc_id + 96 END AS canonical FROM documents WHERE doc_id % 97 <> 0 OR doc_id % 2 = 0),
walk AS (SELECT alias, canonical AS here, 1 AS hops FROM a
  UNION ALL SELECT w.alias, a.canonical, hops + 1 FROM walk w JOIN a ON a.alias = w.here WHERE hops < 97),
ends AS (SELECT * FROM walk WHERE here NOT IN (SELECT alias FROM a))
SELECT alias, here AS canonical, CAST(hops AS BIGINT) AS hops, false AS cyclic FROM ends
UNION ALL SELECT alias, min(here), CAST(NULL AS BIGINT), true FROM walk WHERE alias NOT IN (SELECT alias FROM ends) GROUP BY alias""",
    "f_text_functions": f"""WITH {POSTS} SELECT arrival, regexp_replace(Description, '^\\s+|\\s+$', '', 'g') AS stripped,
'##' || Title AS bare, lower(Company_name) AS lowered, split_part(Company_name, ' ', 2) AS part, Title AS decoded FROM posts""",
    "f_array_functions": """SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS argmax,
array_to_string(list_sort(list_distinct(ints)), '|') AS levels,
array_to_string(ints, '|') || '|-100|-100|-100' AS padded, list_contains(ints, 0) AS has_zero
FROM (SELECT vec_id, embedding, list_transform(embedding, lambda x: CAST(floor(x * 10) AS INTEGER)) AS ints FROM embeddings)""",
    "r1_enrich_stream": _STREAMED,
    "r2_dedupe_stream": f"WITH {POSTS} SELECT Job_ID, CAST(1 AS BIGINT) AS posts FROM posts WHERE Description <> '' GROUP BY Job_ID",
    "r2_first_arrivals": f"""WITH {POSTS}, timed AS (
  SELECT Job_ID, arrival, Description, doc_id % 2 AS part, doc_id * 37 % 1000 + doc_id % 2 * 240 AS m
  FROM posts WHERE Description <> ''),
one AS (SELECT * FROM timed WHERE part = 0 QUALIFY row_number() OVER (PARTITION BY Job_ID ORDER BY arrival) = 1),
mark AS (SELECT max(m) - 660 AS w FROM timed WHERE part = 0),
two AS (SELECT t.* FROM timed t LEFT JOIN one o ON o.Job_ID = t.Job_ID CROSS JOIN mark
  WHERE t.part = 1 AND (o.Job_ID IS NULL OR o.m + 120 <= w)
  QUALIFY row_number() OVER (PARTITION BY t.Job_ID ORDER BY t.arrival) = 1)
SELECT Job_ID, arrival, Description FROM one UNION ALL SELECT Job_ID, arrival, Description FROM two""",
    "r3_dedupe_with_table": f"""WITH {POSTS}, seeds AS (
  SELECT Job_ID, arrival, CASE WHEN Title = 'Plumber' THEN '' ELSE 'known' END AS Description FROM posts
  WHERE Company_name = 'Company 5' QUALIFY row_number() OVER (PARTITION BY Job_ID ORDER BY arrival DESC) = 1),
fresh AS (
  SELECT Job_ID, arrival, Description FROM posts
  WHERE Description <> '' AND Job_ID NOT IN (SELECT Job_ID FROM seeds WHERE Description <> '')
  QUALIFY row_number() OVER (PARTITION BY Job_ID ORDER BY scrape, arrival) = 1)
SELECT * FROM fresh UNION ALL SELECT * FROM seeds WHERE Job_ID NOT IN (SELECT Job_ID FROM fresh)""",
    "r4_replay": _STREAMED,
    "t1_to_sequences": f"""WITH {SEQUENCES} SELECT doc, CAST(count(*) AS INTEGER) AS n, string_agg(label, ' ' ORDER BY pos) AS labels
FROM labelled GROUP BY doc""",
    "t2_split_train_val": f"WITH {SEQUENCES} SELECT doc, split FROM split",
    "t3_encode_sequences": f"WITH {SEQUENCES} SELECT doc, split, input_ids, attention_mask, labels FROM encoded",
    "t4_pad_sequences": f"""WITH {SEQUENCES}, m AS (SELECT split, max(n) AS longest FROM encoded GROUP BY split)
SELECT doc, split, CAST(longest AS INTEGER) AS n_input_ids, CAST(longest AS INTEGER) AS n_attention_mask,
CAST(longest AS INTEGER) AS n_labels, CAST(longest - n AS INTEGER) AS masked,
CAST(longest - n + 2 AS INTEGER) AS ignored, CAST(longest - n AS INTEGER) AS padding FROM encoded JOIN m USING (split)""",
    "t5_argmax_labels": f"""WITH {SCORED} SELECT doc, string_agg(CAST(pred_id AS VARCHAR), '|' ORDER BY pos) AS pred_ids
FROM scored GROUP BY doc""",
    "t6_aligned_labels": f"""WITH {SCORED} SELECT doc, gold, pred, count(*) AS n, CAST(sum(pos) AS BIGINT) AS pos_sum
FROM aligned GROUP BY doc, gold, pred""",
    "t7_span_prf": _prf(conll_spans),
    "t7_span_prf_rows": _prf(conll_spans),
    "t7_span_prf_strict": _prf(strict_spans),
    "t8_split_report": f"WITH {SEQUENCES} SELECT split, count(*) AS n FROM split GROUP BY split",
    "p9_ignored_positions": f"""WITH {SCORED} SELECT doc, count(*) AS n, CAST(min(pos) AS INTEGER) AS first_pos, CAST(max(pos) AS INTEGER) AS last_pos
FROM aligned GROUP BY doc""",
}
ORACLE["j4_normalize_skills_join"] = ORACLE["j4_normalize_skills"]
# Capitalised mentions in, so raw skills keep that case while the leaves are lower-cased.
_CAPS = f"""{TEXTS}, skills AS (
  SELECT arrival, array_to_string(list_transform(string_split(term, ' '),
    lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ') AS skill FROM mentioned),
leaves AS (
  SELECT arrival, 'category' AS kind, grp, m.term FROM mentioned m JOIN topics t ON m.term = t.term
  UNION SELECT arrival, 'service', grp, m.term FROM mentioned m JOIN services s ON m.term = s.term
  UNION SELECT arrival, 'category', 'cloud_providers', grp FROM mentioned m JOIN services s ON m.term = s.term) """
ORACLE["a3_categorize_skills"] = _CAPS + _leaves_of("posts", "p.arrival")
