"""The SQL that says what those training-data queries say that SQL can express."""

from __future__ import annotations

_RANK = "CASE country " + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate("US EP WO GB AU CA NZ IE".split())) + " ELSE 8 END"
_FAMILY = r"regexp_replace(regexp_replace(family_id, '^\s+|\s+$', '', 'g'), '^0+|\.0*$', '', 'g')"


def _missing(c: str) -> str:
    return rf"({c} IS NULL OR regexp_full_match({c}, '[\s.\p{{Pd}}]*') OR regexp_full_match(trim(lower({c})), '(n/?a|none|null|nan|no title|no abstract( available[^.]*)?)[\s.]*'))"


def _blank(c: str) -> str:
    return f"coalesce(trim({c}), '') = ''"


def _best(trust: str, by: str, name: str) -> str:
    """The row of greatest trust, then best office, latest arrival and smallest seq, of each group that has any."""
    return f"""{name} AS (SELECT * FROM (SELECT {by}, seq, {trust} AS trust, row_number() OVER (PARTITION BY {by} ORDER BY {trust} DESC, office, loaded_at DESC NULLS LAST, seq) AS rn FROM t WHERE {trust} IS NOT NULL) WHERE rn = 1)"""


def oracle_sql() -> dict[str, str]:
    fields = {
        "o": ["patent_id", "country", "number", "kind", "publication_date", "priority_date"],
        "a": ["abstract", "abstract_lang"],
        "ti": ["title", "title_lang"],
        "c": ["ipcs", "cpcs"],
        "ap": ["applicant"],
    }
    picked = ", ".join(f"r_{k}.{f} AS {f}" for k, fs in fields.items() for f in fs)
    return {
        "p6_found": rf"""WITH t AS (SELECT seq, {_FAMILY} AS family_id,
 CASE WHEN {_missing('abstract')} THEN 0 ELSE length(abstract) END AS chars, {_RANK} AS office, loaded_at FROM patents_raw),
m AS (SELECT family_id, max(chars) AS chars, min(office) AS office, max(loaded_at) AS loaded_at FROM t WHERE family_id <> '' GROUP BY family_id HAVING count(*) > 1)
SELECT family_id, min(seq) AS seq FROM t JOIN m USING (family_id, chars, office, loaded_at) GROUP BY family_id""",
        "p6_survivors": rf"""WITH t AS (SELECT seq, {_FAMILY} AS fam, lower(trim(coalesce(title_lang, abstract_lang, ''))) AS lang, {_RANK} AS office, loaded_at,
 CASE WHEN NOT ({_blank('patent_id')}) THEN CAST(1000 - 100 * {_RANK} AS DOUBLE) END AS o,
 CASE WHEN NOT {_missing('abstract')} THEN CAST(length(abstract) AS DOUBLE) END AS a, CASE WHEN NOT {_missing('title')} THEN CAST(length(title) AS DOUBLE) END AS ti,
 CASE WHEN NOT ({_blank('ipcs')}) OR NOT ({_blank('cpcs')}) THEN CAST(length(coalesce(ipcs, '')) + length(coalesce(cpcs, '')) AS DOUBLE) END AS c,
 CASE WHEN NOT ({_blank('applicant')}) THEN CAST(length(applicant) AS DOUBLE) END AS ap FROM patents_raw WHERE {_FAMILY} <> ''),
f AS (SELECT fam, count(*) AS n_rows, max(a) AS top_a, max(ti) AS top_ti FROM t GROUP BY fam),
{_best('o', 'fam', 'bo')}, {_best('c', 'fam', 'bc')}, {_best('ap', 'fam', 'bap')}, {_best('a', 'fam, lang', 'ba')}, {_best('ti', 'fam, lang', 'bti')},
v AS (SELECT d.fam, d.lang, ba.seq AS a_seq, ba.trust AS a, bti.seq AS ti_seq, bti.trust AS ti,
 row_number() OVER (PARTITION BY d.fam ORDER BY coalesce(ba.trust, 0) + coalesce(bti.trust, 0) DESC, coalesce(ba.trust, 0) DESC, d.lang) AS rn
 FROM (SELECT DISTINCT fam, lang FROM t) d LEFT JOIN ba ON ba.fam = d.fam AND ba.lang = d.lang LEFT JOIN bti ON bti.fam = d.fam AND bti.lang = d.lang)
SELECT f.fam AS family_id, f.n_rows AS n_rows, CASE WHEN v.a_seq IS NOT NULL OR v.ti_seq IS NOT NULL THEN v.lang END AS text_lang,
 coalesce(bo.trust, 0) + coalesce(bc.trust, 0) + coalesce(bap.trust, 0) + coalesce(v.a, 0) + coalesce(v.ti, 0) AS trust,
 coalesce(bo.trust, 0) + coalesce(bc.trust, 0) + coalesce(bap.trust, 0) + coalesce(f.top_a, 0) + coalesce(f.top_ti, 0) AS root_bound, {picked}
FROM f JOIN v ON v.fam = f.fam AND v.rn = 1 LEFT JOIN bo ON bo.fam = f.fam LEFT JOIN bc ON bc.fam = f.fam LEFT JOIN bap ON bap.fam = f.fam
LEFT JOIN patents_raw r_o ON r_o.seq = bo.seq LEFT JOIN patents_raw r_a ON r_a.seq = v.a_seq LEFT JOIN patents_raw r_ti ON r_ti.seq = v.ti_seq
LEFT JOIN patents_raw r_c ON r_c.seq = bc.seq LEFT JOIN patents_raw r_ap ON r_ap.seq = bap.seq""",
    }
