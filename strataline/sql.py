"""The SQL that says what the core queries say, for DuckDB over the same tables."""

from __future__ import annotations

from urllib.parse import quote

from strataline import lexicons as L

_TEXT_BLANKS = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Letters, marks and joiners beyond ASCII are word characters; RE2's word border knows ASCII only.
_SEARCH = (
    f"regexp_replace(regexp_replace(coalesce(title,'')||' '||coalesce(abstract,''), '{_TEXT_BLANKS}', ' ', 'g'), "
    r"'[^\x00-\x7F\pP\pS\pZ\pC]|[\x{200c}\x{200d}]', '_', 'g')"
)


def _words(patterns: tuple[str, ...]) -> str:
    return "\\b(" + "|".join(patterns).replace("'", "''") + ")\\b"


def _found(pattern: str) -> str:
    return f"regexp_matches(t, '(?i){pattern}')"


_AGRI_RE2 = tuple(p.split("(?!")[0] for p in L.AGRI)
#: Records made of the documents by rule.
_VIEW = f"""(SELECT doc_id, CASE WHEN doc_id % 17 <> 0 THEN substr(text, 1, 60) END AS title,
 CASE WHEN doc_id % 11 = 0 THEN '{L.NO_ABSTRACT}' WHEN doc_id % 19 = 0 THEN '' ELSE '<p>' || CASE WHEN doc_id & 1 THEN 'siRNA ' ELSE '' END || CASE WHEN doc_id & 4 THEN 'CRISPR ' ELSE '' END
 || CASE WHEN doc_id & 8 THEN 'maize ' ELSE '' END || CASE WHEN doc_id & 16 THEN 'biomarker ' ELSE '' END
 || CASE doc_id % 5 WHEN 0 THEN 'siRNAs ' WHEN 1 THEN 'mRNA vaccine ' WHEN 2 THEN 'treatment ' WHEN 3 THEN 'tomato cell ' ELSE '' END || ' [0001] ' || coalesce(text, '') || '</p>' END AS abstract,
 CASE WHEN doc_id & 2 THEN 'A61K31/713, C12N15/1135' ELSE 'A61K31/713' END AS cpcs, 'A61K31/713' AS ipcs FROM documents)"""


def _tier(source: str) -> str:
    return f"""WITH s AS (SELECT *, {_SEARCH} AS t FROM {source} r),
c AS (SELECT *, {_found('|'.join(L.SIGNAL))} AS has_text,
 (coalesce(cpcs,'') LIKE '%{L.ANCHOR}%' OR coalesce(ipcs,'') LIKE '%{L.ANCHOR}%') AS has_anchor,
 {_found(_words(L.FORBIDDEN))} AS has_forbidden,
 regexp_matches(regexp_replace(t, '(?i)tomato\\s+cell|sheep\\s+cell|insect\\s+cells?\\s+line', ' ', 'g'), '(?i){_words(_AGRI_RE2)}') AS has_agri,
 ({_found(_words(L.DIAGNOSTIC))} AND NOT {_found(_words(L.TREATMENT))}) AS has_diag FROM s),
tiers AS (SELECT *, CASE
 WHEN has_text AND has_anchor AND NOT has_forbidden AND NOT has_agri AND NOT has_diag THEN '{L.TIERS[0]}'
 WHEN has_text AND NOT has_anchor AND NOT has_forbidden AND NOT has_agri AND NOT has_diag THEN '{L.TIERS[1]}'
 WHEN NOT has_text AND has_anchor AND NOT has_forbidden AND NOT has_agri AND NOT has_diag THEN '{L.TIERS[2]}'
 WHEN has_text AND has_forbidden AND NOT has_diag THEN '{L.TIERS[3]}'
 WHEN has_diag THEN '{L.TIERS[4]}'
 WHEN has_agri AND has_anchor THEN '{L.TIERS[5]}'
 WHEN NOT has_text AND NOT has_anchor AND NOT has_agri THEN '{L.TIERS[6]}'
 WHEN has_agri AND NOT has_anchor THEN '{L.TIERS[7]}' ELSE '{L.UNCLASSIFIED}' END AS tier FROM c)"""


_TIER = _tier("patents_raw")

_UPPER = "upper(replace(replace(replace(replace({0}, 'ß', 'SS'), 'ﬁ', 'FI'), 'ﬂ', 'FL'), 'ﬀ', 'FF'))"


def _normalised(part: str) -> str:
    x = _UPPER.format(rf"regexp_replace(regexp_replace({part}, '^{_TEXT_BLANKS}+', ''), '{_TEXT_BLANKS}+$', '')")
    x = rf"regexp_replace({x}, '\[.*?\]', '', 'g')"
    x = rf"regexp_replace(strip_accents({x}), '[^\x00-\x7F]', '', 'g')"
    x = rf"replace(replace(replace(regexp_replace({x}, '[,.()]', '', 'g'), '-', ' '), '''', ''), '&', 'AND')"
    x = rf"regexp_replace({x}, '^THE\s+', '')"
    x = rf"regexp_replace({x}, '\bUNIV\b', 'UNIVERSITY', 'g')"
    x = rf"regexp_replace({x}, '\b({L.LEGAL_WORDS})\b', '', 'g')"
    return rf"trim(regexp_replace({x}, '[\s\x1c-\x1f]+', ' ', 'g'))"


def _unified(name: str) -> str:
    return "CASE " + " ".join(f"WHEN contains({name}, '{k}') THEN '{v}'" for k, v in L.ORGANISATIONS) + f" ELSE {name} END"


_FACTS = f"""WITH parts AS (SELECT DISTINCT seq, family_id, priority_date, unnest(string_split(applicant, '|')) AS part FROM patents_raw WHERE applicant IS NOT NULL),
named AS (SELECT *, {_normalised('part')} AS name FROM parts),
facts AS (SELECT DISTINCT seq, family_id, {_unified('name')} AS company, priority_date FROM named
 WHERE regexp_matches(name, '[A-Z]') AND NOT regexp_matches(name, '{'|'.join(L.PERSONS)}'))"""

_RANK = "CASE country " + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate("US EP WO GB AU CA NZ IE".split())) + " ELSE 8 END"
_NO_ABSTRACT = rf"(contains(lower(coalesce(abstract,'')), 'no abstract available') OR regexp_replace(coalesce(abstract,''), '{_TEXT_BLANKS}', '', 'g') = '')"
_REPAIRED = """repaired AS (SELECT seq, patent_id, coalesce(nullif(family_id,''), nullif(patent_id,''),
 'UNKNOWN_FAM_' || (row_number() OVER (PARTITION BY nullif(family_id,'') IS NULL AND nullif(patent_id,'') IS NULL, coalesce(nullif(substr(publication_date,1,4),''),'0000') ORDER BY seq) - 1) || '_' || coalesce(nullif(substr(publication_date,1,4),''),'0000')) AS family_id,
 priority_date, publication_date, title, abstract FROM patents_raw)"""


def _slices(source: str, when: str, cap: int) -> str:
    return f"""days AS (SELECT CAST({when} AS DATE) AS d, count(*) AS n FROM {source} WHERE {when} IS NOT NULL GROUP BY 1),
months AS (SELECT CAST(date_trunc('month', d) AS DATE) AS m, CAST(date_trunc('year', min(d)) AS DATE) AS y, CAST(sum(n) AS BIGINT) AS n FROM days GROUP BY 1),
years AS (SELECT y, CAST(sum(n) AS BIGINT) AS n FROM months GROUP BY 1),
slices AS (SELECT 'year' AS level, y AS first_day, last_day(CAST(y + INTERVAL 11 MONTH AS DATE)) AS last_day, n FROM years WHERE n <= {cap}
 UNION ALL SELECT 'month', m, last_day(m), months.n FROM months JOIN years USING (y) WHERE years.n > {cap} AND months.n <= {cap}
 UNION ALL SELECT 'day', d, d, days.n FROM days JOIN months ON CAST(date_trunc('month', d) AS DATE) = m JOIN years USING (y) WHERE years.n > {cap} AND months.n > {cap})"""


def _nodes() -> str:
    """Nodes of the record bodies by the path that a walk over the JSON gives each value."""
    doc = r"\$\.world-patent-data\.exchange-documents\.exchange-document(?:\[\d+\])?"
    biblio = doc + r"\.bibliographic-data"
    applicant = biblio + r"\.parties\.applicants\.applicant(?:\[\d+\])?"
    return rf"""WITH b AS (SELECT rec_id, CAST(body AS JSON) AS body FROM exchange_documents WHERE json_valid(body)),
t AS (SELECT rec_id, j.id AS id, replace(replace(j.fullkey, '"', ''), 'ops:', '') AS path FROM b, json_tree(b.body) j WHERE j.type NOT IN ('NULL', 'ARRAY')),
k AS (SELECT *, CASE WHEN regexp_full_match(path, '{doc}') THEN 'document' WHEN regexp_full_match(path, '{biblio}\.invention-title(?:\[\d+\])?') THEN 'title'
 WHEN regexp_full_match(path, '{applicant}') THEN 'applicant' WHEN regexp_full_match(path, '{applicant}\.applicant-name\.name(?:\[\d+\])?') THEN 'name' END AS node,
 regexp_extract(path, '^{doc}') AS doc, regexp_extract(path, '^{applicant}') AS app FROM t),
n AS (SELECT *, row_number() OVER (PARTITION BY rec_id, node, CASE WHEN node = 'document' THEN '' WHEN node = 'name' THEN app ELSE doc END ORDER BY id) AS no FROM k WHERE node IS NOT NULL)
SELECT n.rec_id AS rec_id, CAST(d.no AS INTEGER) AS doc_no, n.node AS node, CAST(CASE WHEN n.node = 'name' THEN a.no ELSE 0 END AS INTEGER) AS parent_no, CAST(n.no AS INTEGER) AS node_no
FROM n JOIN n d ON d.node = 'document' AND d.rec_id = n.rec_id AND d.path = n.doc LEFT JOIN n a ON n.node = 'name' AND a.node = 'applicant' AND a.rec_id = n.rec_id AND a.path = n.app"""


def _flat(first_form: bool) -> str:
    """One row per exchange document, by JSON paths; keys lose their prefix first."""
    many = lambda x: f"CASE json_type({x}) WHEN 'ARRAY' THEN list_filter(CAST({x} AS JSON[]), lambda e: json_type(e) <> 'NULL') WHEN 'NULL' THEN [] ELSE CASE WHEN {x} IS NULL THEN [] ELSE [{x}] END END"
    value = lambda x: f"coalesce(json_extract_string({x}, '$.\"$\"'), CASE WHEN json_type({x}) IN ('OBJECT', 'ARRAY', 'NULL') THEN NULL ELSE json_extract_string({x}, '$') END, '')"
    field = lambda x, n: f"coalesce(json_extract_string({x}, '$.\"{n}\".\"$\"'), CASE WHEN json_type(json_extract({x}, '$.\"{n}\"')) IN ('OBJECT', 'NULL') THEN NULL ELSE json_extract_string({x}, '$.\"{n}\"') END, '')"
    english = lambda xs, f: f"coalesce(nullif(list_transform(list_filter({xs}, lambda e: lower(json_extract_string(e, '$.\"@lang\"')) = 'en'), lambda e: {f('e')})[1], ''), list_transform({xs}, lambda e: {f('e')})[1])"
    docdb = lambda xs: f"list_filter({xs}, lambda e: json_extract_string(e, '$.\"@document-id-type\"') = 'docdb')"
    paragraphs = lambda a: f"CASE WHEN json_extract({a}, '$.p') IS NULL THEN {value(a)} ELSE array_to_string(list_filter(list_transform({many(f"json_extract({a}, '$.p')")}, lambda q: {value('q')}), lambda t: t <> ''), ' ') END"
    names = lambda a: many(f"(json_extract({a}, '$.\"applicant-name\".name'))")
    ids = "json_extract(c, '$.\"document-id\"')"
    code = "concat(" + ", ".join([*[field("e", n) for n in ("section", "class", "subclass", "main-group")], "'/'", field("e", "subgroup")]) + ")"
    trimmed = code if first_form else f"trim({code}, '/')"
    scheme = "upper(coalesce(json_extract_string(e, '$.\"classification-scheme\".\"@scheme\"'), json_extract_string(e, '$.\"classification-scheme\"'), ''))"
    kept = {
        "cpcs": "true" if first_form else f"{scheme} LIKE '%CPC%' OR {scheme} NOT LIKE '%IPC%'",
        "ipcs": "false" if first_form else f"{scheme} NOT LIKE '%CPC%'",
    }
    codes = ", ".join(f"coalesce(array_to_string(list_sort(list_distinct(list_filter(list_transform(list_filter(classes, lambda e: {own}), lambda e: {trimmed}), lambda c: length(c) > 2))), ', '), '') AS {name}" for name, own in kept.items())
    clean = rf"regexp_replace(regexp_replace(regexp_replace(regexp_replace(abstract, '<[^>]+>', '', 'g'), '[\n\r\t]', ' ', 'g'), '\[[0-9]{{4}}\]', '', 'g'), '{_TEXT_BLANKS}+', ' ', 'g')"
    return f"""b AS (SELECT rec_id, CAST(replace(body, '"ops:', '"') AS JSON) AS body FROM exchange_documents WHERE json_valid(body)),
ds AS (SELECT rec_id, {many("(json_extract(body, '$.\"world-patent-data\".\"exchange-documents\".\"exchange-document\"'))")} AS docs FROM b),
dd AS (SELECT rec_id, unnest(docs) AS d, generate_subscripts(docs, 1) AS doc_no FROM ds),
l AS (SELECT rec_id, CAST(doc_no AS INTEGER) AS doc_no, coalesce(json_extract_string(d, '$.\"@family-id\"'), '') AS family_id,
 {many("(json_extract(d, '$.\"bibliographic-data\".\"invention-title\"'))")} AS titles, {many("(json_extract(d, '$.abstract'))")} AS abstracts,
 {many("(json_extract(d, '$.\"bibliographic-data\".parties.applicants.applicant'))")} AS applicants,
 {many("(json_extract(d, '$.\"bibliographic-data\".\"publication-reference\".\"document-id\"'))")} AS ids,
 {many("(json_extract(d, '$.\"bibliographic-data\".\"priority-claims\".\"priority-claim\"'))")} AS claims,
 {many("(json_extract(d, '$.\"bibliographic-data\".\"patent-classifications\".\"patent-classification\"'))")} AS classes FROM dd),
p AS (SELECT *, coalesce(nullif({english('titles', value)}, ''), '{L.NO_TITLE}') AS title, {english('abstracts', paragraphs)} AS abstract,
 coalesce(array_to_string(list_filter(list_transform(applicants, lambda a: coalesce({english(names('a'), value)}, '')), lambda t: t <> ''), ' | '), '') AS applicant,
 {docdb('ids')}[-1] AS id,
 list_min(list_filter(list_transform({docdb(f"flatten(list_transform(claims, lambda c: {many(ids)}))")}, lambda e: {field('e', 'date')}), lambda t: t <> '')) AS priority,
 {codes} FROM l),
q AS (SELECT *, CASE WHEN id IS NULL THEN '' ELSE {field('id', 'country')} END AS country, replace(CASE WHEN id IS NULL THEN '' ELSE {field('id', 'doc-number')} END, '.', '') AS number,
 CASE WHEN id IS NULL THEN '' ELSE {field('id', 'kind')} END AS kind, CASE WHEN id IS NULL THEN '' ELSE {field('id', 'date')} END AS publication_date FROM p),
flat AS (SELECT rec_id, doc_no, country || number || kind AS patent_id, country, number, kind, family_id, coalesce(priority, publication_date) AS priority_date, publication_date, applicant, title,
 coalesce(nullif(trim({clean}), ''), '{L.NO_ABSTRACT}') AS abstract, ipcs, cpcs FROM q)"""


def _text_values(rows: list[tuple]) -> str:
    q = lambda v: "NULL" if v is None else str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"
    return ", ".join("(" + ", ".join(map(q, r)) + ")" for r in rows)


def _formatted_term(t: str) -> str:
    return f"ta={t}" if (len(t) > 1 and t[0] == t[-1] == '"') or " " not in t else f"ta=({' AND '.join(t.split())})"


def oracle_sql() -> dict[str, str]:
    from strataline.queries import QUOTA_HEADERS

    tier_rows = _text_values([(i, t) for i, t in enumerate([*L.TIERS, L.UNCLASSIFIED])])
    order = "CASE tier " + " ".join(f"WHEN '{t}' THEN {i}" for i, t in enumerate(L.TIERS)) + " END"
    sample = [*dict.fromkeys([*L.BLOCK_TERMS, *L.SINGLE_TERMS]), "gene silencing therapy", "two  words"]
    excluded = " NOT (" + " OR ".join(f'cpc="{c}"' for c in L.EXCLUDED_CODES) + ")"
    heads = [f'cpc=/low "{c}"' for c in L.SINGLE_LOW_CODES] + [f'ipc="{c}"' for c in L.SINGLE_IPC_CODES] + [f"ta={t}" for t in L.SINGLE_TERMS]
    codes = " OR ".join(f"cpc={c}" for c in L.BLOCK_CODES)
    pairs = [L.BLOCK_TERMS[i : i + 2] for i in range(0, len(L.BLOCK_TERMS), 2)]
    blocks = [(y, b, f"({' OR '.join(map(_formatted_term, ts))}) AND ({codes}) AND pd={y}") for y in (2000, 2001, 2002) for b, ts in enumerate(pairs)]
    return {
        "top_applicants": f"""{_FACTS} SELECT company, count(DISTINCT coalesce(family_id,'nan')) AS n_families, min(nullif(priority_date,'')) AS earliest
 FROM facts GROUP BY company ORDER BY n_families DESC, company LIMIT 100""",
        "entity_normalise": f"SELECT DISTINCT part, {_normalised('part')} AS name FROM (SELECT unnest(string_split(applicant,'|')) AS part FROM patents_raw WHERE applicant IS NOT NULL)",
        "canonical_map": f"""WITH n AS (SELECT DISTINCT {_normalised('part')} AS name FROM (SELECT DISTINCT unnest(string_split(applicant, '|')) AS part FROM patents_raw WHERE applicant IS NOT NULL)
 UNION ALL SELECT * FROM (VALUES {_text_values([(f'THE {k} X',) for k, _ in L.ORGANISATIONS])}) v(name)) SELECT name, {_unified('name')} AS company FROM n""",
        "explode_applicants": f"{_FACTS} SELECT seq, family_id, company, priority_date FROM facts",
        "timeline": """WITH f AS (SELECT *, row_number() OVER (PARTITION BY family_id ORDER BY seq) AS rn FROM patents_raw),
y AS (SELECT coalesce(nullif(substr(priority_date,1,4),''), substr(publication_date,1,4)) AS y FROM f WHERE rn = 1)
SELECT CAST(y AS INTEGER) AS year, count(*) AS n FROM y WHERE regexp_full_match(y, '[0-9]{4}') AND CAST(y AS INTEGER) BETWEEN 2000 AND 2026 GROUP BY 1""",
        "timeline_orders": """WITH f AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM f WHERE rn = 1 AND year(o_orderdate) BETWEEN 1995 AND 2001 GROUP BY 1""",
        "tier_classify": f"{_TIER} SELECT seq, has_text, has_anchor, has_forbidden, has_agri, has_diag, tier FROM tiers",
        "tier_summary": f"""{_TIER}, n AS (SELECT tier, count(*) AS n FROM tiers GROUP BY tier), dim(tier_ord, tier) AS (VALUES {tier_rows})
SELECT tier_ord, dim.tier AS tier, coalesce(n, 0) AS n_patents, repeat('█', CAST(floor(coalesce(n,0) / 100) AS INTEGER)) AS bar FROM dim LEFT JOIN n ON dim.tier = n.tier""",
        "tier_compat_drop": f"{_TIER} SELECT tier, count(*) AS n FROM tiers WHERE tier <> '{L.UNCLASSIFIED}' GROUP BY tier",
        "sectioned_output": f"""{_TIER}, r AS (SELECT *, {order} AS tier_ord FROM tiers WHERE tier <> '{L.UNCLASSIFIED}')
SELECT tier_ord, 1 AS is_row, seq, patent_id, title, family_id FROM r
UNION ALL SELECT tier_ord, 0, 0, '--- ' || upper(tier) || ' (' || count(*) || ' patents) ---', '', '' FROM r GROUP BY tier_ord, tier""",
        "tier_view": f"""{_tier(_VIEW)} SELECT doc_id, has_text, has_anchor, has_forbidden, has_agri, has_diag, tier FROM tiers""",
        "run_counts": rf"""SELECT count(*) AS n_records, count(*) FILTER ({_NO_ABSTRACT} AND regexp_matches(coalesce(title,''), '[^\x00-\x7F]')) AS n_review FROM patents_raw""",
        "needs_review": rf"""WITH f AS (SELECT seq, {_NO_ABSTRACT} AS lacks_abstract, regexp_matches(coalesce(title,''), '[^\x00-\x7F]') AS non_ascii,
 contains(lower(coalesce(abstract,'')), 'no abstract available') AS says FROM patents_raw)
SELECT seq, lacks_abstract, non_ascii, NOT (says OR non_ascii) AS good, (lacks_abstract AND non_ascii) AS review FROM f""",
        "non_ascii_documents": r"SELECT lang, regexp_matches(coalesce(text,''), '[^\x00-\x7F]') AS non_ascii, count(*) AS n FROM documents GROUP BY 1, 2",
        "good_text_dedup": rf"""WITH {_REPAIRED}, g AS (SELECT *, NOT (contains(lower(coalesce(abstract,'')), 'no abstract available') OR regexp_matches(coalesce(title,''), '[^\x00-\x7F]')) AS good FROM repaired),
k AS (SELECT *, row_number() OVER (PARTITION BY family_id ORDER BY good DESC, nullif(priority_date,'') ASC NULLS LAST, seq) AS rn FROM g)
SELECT family_id, seq, good, priority_date FROM k WHERE rn = 1""",
        "family_by_country": rf"""WITH f AS (SELECT id, nullif(regexp_replace(regexp_replace(coalesce(family_id,''), '^{_TEXT_BLANKS}+', ''), '{_TEXT_BLANKS}+$', ''), '') AS family_id, country, seq FROM id_records),
k AS (SELECT *, row_number() OVER (PARTITION BY family_id IS NULL, coalesce(family_id, id) ORDER BY CASE WHEN family_id IS NULL THEN 0 ELSE {_RANK} END, seq) AS rn FROM f)
SELECT id, family_id, country, seq, family_id IS NOT NULL AS has_family FROM k WHERE rn = 1""",
        "orders_by_priority": """SELECT o_custkey, o_orderkey, o_orderpriority, o_orderdate FROM
(SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
        "blank_family_repair": f"WITH {_REPAIRED} SELECT seq, patent_id, family_id, publication_date FROM repaired",
        "earliest_publication": f"""WITH k AS (SELECT *, row_number() OVER (PARTITION BY coalesce(family_id,'') ORDER BY coalesce(publication_date,'~'), seq) AS rn
 FROM patents_raw WHERE NOT coalesce(regexp_matches(title, '(?i){L.AGRI_TITLE}'), false))
SELECT seq, family_id, publication_date, CASE WHEN regexp_matches(coalesce(title,''), '(?i){L.COMPETITOR}') THEN 'Check Tech' ELSE '' END AS warning,
 'https://worldwide.espacenet.com/publicationDetails/biblio?CC=' || coalesce(country,'') || '&NR=' || coalesce(number,'') || '&KC=' || coalesce(kind,'') || '&FT=D' AS link FROM k WHERE rn = 1""",
        "clean_text": rf"""SELECT seq, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(abstract, '<[^>]+>', '', 'g'), '[\n\r\t]', ' ', 'g'), '\[[0-9]{{4}}\]', '', 'g'), '{_TEXT_BLANKS}+', ' ', 'g')) AS abstract FROM patents_raw""",
        "accent_fold": r"SELECT doc_id, regexp_replace(strip_accents(coalesce(text,'')), '[^\x00-\x7F]', '', 'g') AS folded FROM documents",
        "json_extract": "SELECT event_type, CAST(sum(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER)) AS BIGINT) AS total, count(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER)) AS n FROM events GROUP BY 1",
        "biblio_flatten": f"WITH {_flat(False)} SELECT * FROM flat",
        "first_flatten": f"WITH {_flat(True)} SELECT rec_id, doc_no, patent_id, title, applicant, cpcs FROM flat",
        "abstract_fallback": f"""WITH {_flat(False)}, o AS (SELECT patent_id, min(abstract) AS other FROM patents_raw WHERE abstract <> '{L.NO_ABSTRACT}' GROUP BY patent_id)
SELECT flat.* REPLACE (coalesce(nullif(nullif(abstract, '{L.NO_ABSTRACT}'), ''), other, '{L.NO_ABSTRACT}') AS abstract) FROM flat LEFT JOIN o USING (patent_id)""",
        "detail_fetch": r"""WITH i AS (SELECT DISTINCT CASE WHEN seq % 7 = 0 THEN regexp_replace(id, '\.[^.]*$', '') ELSE id END AS id FROM id_records WHERE id IS NOT NULL), p AS (SELECT string_split(id, '.') AS p FROM i)
SELECT p[1] AS country, p[2] AS number, p[3] AS kind, p[1] || p[2] || p[3] AS patent_id FROM p WHERE len(p) = 3 AND p[1] <> '' AND p[2] <> '' AND p[3] <> ''""",
        "query_urls": f"SELECT * FROM (VALUES {_text_values([(i, quote(f'({h}{excluded}) AND pa=' + chr(34) + 'Foo & Bar' + chr(34), safe='*-._')) for i, h in enumerate(heads)])}) v(ord, encoded)",
        "term_format": f"SELECT * FROM (VALUES {_text_values([(t, _formatted_term(t)) for t in sample])}) v(term, query)",
        "query_blocks": f"SELECT * FROM (VALUES {_text_values(blocks)}) v(year, block, query)",
        "query_compile": f"SELECT * FROM (VALUES {_text_values([(i, f'({h}{excluded})') for i, h in enumerate(heads)])}) v(ord, query)",
        "time_slices": f"WITH {_slices('events', 'ts', 200)} SELECT level, first_day, last_day, n, n > 200 AS truncated FROM slices",
        "time_slices_orders": f"WITH {_slices('orders', 'o_orderdate', 2000)} SELECT level, first_day, last_day, n, n > 2000 AS truncated FROM slices",
        "page_plan": f"""WITH {_slices('orders', 'o_orderdate', 2000)}, p AS (SELECT level, first_day, least(n, 2000) AS n, unnest(range(CAST(ceil(least(n, 2000) / 100.0) AS BIGINT))) AS page_no FROM slices WHERE n > 0)
SELECT level, first_day, CAST(page_no AS INTEGER) AS page_no, page_no * 100 + 1 AS range_begin, least((page_no + 1) * 100, n) AS range_end FROM p""",
        "id_dedup": "SELECT id, min(seq) AS first_seq FROM id_records GROUP BY id",
        "dedup_savings": "SELECT count(*) AS n_raw, count(DISTINCT id) AS n_ids, count(*) - count(DISTINCT id) AS saved FROM id_records",
        "events_distinct": "SELECT DISTINCT user_id, event_type FROM events",
        "topn_generic": "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 20",
        "group_distinct": "SELECT l_suppkey, count(DISTINCT l_partkey) AS n_parts, min(l_shipdate) AS first_ship FROM lineitem GROUP BY 1",
        "quota_status": f"""WITH h(n, traffic, week_used, hour_used) AS (VALUES {_text_values(QUOTA_HEADERS)}),
u AS (SELECT *, coalesce(TRY_CAST(coalesce(nullif(trim(week_used),''), nullif(trim(hour_used),''), '0') AS BIGINT), 0) / 1048576.0::DOUBLE AS mb FROM h)
SELECT n, round(mb, 6) AS used_mb, round(mb / 4000.0::DOUBLE * 100, 6) AS used_pct, round(greatest(0.0::DOUBLE, 100 - mb / 4000.0::DOUBLE * 100), 6) AS left_pct,
 TRY_CAST(nullif(regexp_extract(traffic, 'search=\\w+:(\\d+)', 1), '') AS INTEGER) AS search_rpm,
 CASE WHEN mb / 4000.0 * 100 >= 100 THEN 'EXHAUSTED' WHEN contains(coalesce(traffic,''), 'overloaded') THEN 'OVERLOADED' ELSE 'OK' END AS status FROM u""",
        "p4_found": _nodes(),
        "office_order": f"SELECT {_RANK} AS office, count(*) AS n FROM patents_raw GROUP BY 1",
    }
