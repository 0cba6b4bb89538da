"""The same answers in SQL for DuckDB. Patterns are the shared ones, read by RE2."""

from __future__ import annotations

from lettermill import rx
from lettermill.functions.stopwords import STOP_WORDS


def q(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def m(x: str, pattern: str, cased: bool = False) -> str:
    return f"regexp_matches({x}, {q(pattern if cased else rx.ci2(pattern))})"


def strip(x: str, chars: str = rx.WS) -> str:
    return f"regexp_replace({x}, {q(f'^[{chars}]+|[{chars}]+$')}, '', 'g')"


def checked(x: str) -> str:
    return strip(f"regexp_replace({x}, {q(f'^[{rx.WS}>]*')}, '')", r">*_ \t\n\r")


def contact(x: str) -> str:
    s = f"regexp_replace({strip(x)}, {q(r'^\*{1,2}|\*{1,2}$')}, '', 'g')"
    s = strip(f"regexp_replace({s}, '^_{{1,2}}|_{{1,2}}$', '', 'g')")
    return f"(({s}) <> '' AND ({m(s, rx.CONTACT_CASED, True)} OR {m(s, rx.CONTACT)}))"


LAST = "(SELECT * FROM armis_raw_email QUALIFY row_number() OVER (PARTITION BY eid ORDER BY row_idx DESC) = 1)"
FIRST = "(SELECT * FROM armis_raw_email QUALIFY row_number() OVER (PARTITION BY eid ORDER BY row_idx) = 1)"
MAILS = "(SELECT * FROM thread_grouper QUALIFY row_number() OVER (PARTITION BY eid ORDER BY row_idx) = 1)"
LINES = """l AS (SELECT row_idx, pos - 1 AS pos, ls[pos] AS line FROM (SELECT row_idx, ls, unnest(range(1, len(ls) + 1)) AS pos
  FROM (SELECT row_idx, string_split(raw_body, chr(10)) AS ls FROM armis_raw_email WHERE raw_body IS NOT NULL)))"""
SQL: dict[str, str] = {
    "dedup_keep_first": f"SELECT eid, row_idx FROM {FIRST}",
    "dedup_keep_last": f"SELECT eid, row_idx FROM {LAST}",
    "dedup_stats": "SELECT count(*) AS before, count(DISTINCT coalesce(eid, chr(1))) AS after, count(*) - count(DISTINCT coalesce(eid, chr(1))) AS dupes FROM armis_raw_email",
    "first_sample": "SELECT row_idx, CASE WHEN length(eid) > 55 THEN left(eid, 55) || '...' ELSE eid END AS short_id, length(raw_body) AS n FROM armis_raw_email ORDER BY row_idx LIMIT 5",
    "clean_length_stats": "SELECT count(*) AS non_empty, CAST(floor(avg(length(cleaned_body))) AS BIGINT) AS mean_n, min(length(cleaned_body)) AS min_n, max(length(cleaned_body)) AS max_n FROM thread_grouper WHERE length(cleaned_body) > 0",
    "body_length_counts": """SELECT count(*) FILTER (WHERE length(body_text) > 10) AS full_over_10, count(*) FILTER (WHERE length(cleaned_body) > 10) AS clean_over_10,
  round(avg(length(body_text)) FILTER (WHERE length(body_text) > 10), 6) AS mean_full, count(*) FILTER (WHERE from_addr <> '') AS with_sender, count(*) FILTER (WHERE subject <> '') AS with_subject FROM thread_grouper""",
}


def _text(flags: str, keep: str, line: str = "line") -> str:
    return f"WITH {LINES}{flags} SELECT row_idx, coalesce(string_agg({line}, chr(10) ORDER BY pos) FILTER (WHERE {keep}), '') AS text FROM d GROUP BY row_idx"


def _cut(pattern: str) -> str:
    return f", d AS (SELECT *, coalesce(min(CASE WHEN {m(strip('line'), pattern)} THEN pos END) OVER (PARTITION BY row_idx), 1000000000) AS cut FROM l)"


def _run(seed: str, go: str, source: str = "l") -> str:
    """``gone``: seed, or go-on after a gone line."""
    return f""", f AS (SELECT *, {seed} AS seed, {go} AS go FROM {source}),
 g AS (SELECT *, count(*) FILTER (WHERE NOT (seed OR go)) OVER (PARTITION BY row_idx ORDER BY pos) AS island FROM f),
 r AS (SELECT *, (seed OR go) AND coalesce(bool_or(seed) OVER (PARTITION BY row_idx, island ORDER BY pos), false) AS gone FROM g),
 d AS (SELECT *, coalesce(lag(gone) OVER (PARTITION BY row_idx ORDER BY pos), false) AS after_gone FROM r)"""


SQL["reply_chain_cut"] = _text(_cut(rx.REPLY_TRIGGERS), "pos < cut")
_C = checked("line")
SQL["disclaimer_removal"] = _text(
    _run(m("s", rx.DISCLAIMER_TRIGGERS), f"s <> '' AND ({m('s', rx.DISCLAIMER_TRIGGERS)} OR {m('s', rx.DISCLAIMER_VOCABULARY)})", f"(SELECT *, {_C} AS s FROM l)"),
    "NOT gone",
    "CASE WHEN after_gone AND s = '' THEN '' ELSE line END",
)
_SIG = _run(f"({m('s', rx.SALUTATIONS)} OR {m('s', rx.FOOTERS)})", f"(s = '' OR {contact('line')})", f"(SELECT *, {strip('line')} AS s FROM {{src}})")
SQL["signature_removal"] = _text(_SIG.replace("{src}", "l"), "NOT gone")
SQL["signature_removal_truncate"] = _text(
    _cut(rx.INLINE_SIGNATURE).replace(", d AS", ", c AS") + _SIG.replace("{src}", "c WHERE pos < cut"), "NOT gone"
).replace("FROM d GROUP BY row_idx", "FROM (SELECT DISTINCT row_idx FROM l) LEFT JOIN d USING (row_idx) GROUP BY row_idx")
_TIDY = f"regexp_replace(line, {q(rf'^{rx.S}*\|+{rx.S}*')}, '')"
_TIDY = f"regexp_replace({_TIDY}, {q(rf'{rx.S}*\|+{rx.S}*$')}, '')"
_TIDY = f"regexp_replace({_TIDY}, '<[a-zA-Z/!][^>@]*>', '', 'g')"
_TIDY = f"regexp_replace({_TIDY}, '&[a-zA-Z]+;|&#\\d+;|&#x[0-9a-fA-F]+;', ' ', 'g')"
SQL["line_noise"] = _text(f", d AS (SELECT row_idx, pos, {_TIDY} AS line FROM l)", f"NOT regexp_matches(line, {q(rf'^[|{rx.WS}\-:=]+$')})")
SQL["quote_strip"] = _text(f", d AS (SELECT row_idx, pos, regexp_replace(line, {q(f'^{rx.S}*>[{rx.WS}>]*')}, '') AS line FROM l)", "true")
_TAILS = r"\t\x{0b}-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SQL["blank_collapse"] = (
    f"SELECT row_idx, {strip(f'''regexp_replace(regexp_replace(raw_body, '[{_TAILS}]+(\\n|$)', '\\1', 'g'), '\\n{{4,}}', chr(10) || chr(10) || chr(10), 'g')''')} AS text FROM armis_raw_email WHERE raw_body IS NOT NULL"
)
_LINK = "raw_body"
for _p, _r in ((r"\[([^\]]+)\]\(mailto:[^)]+\)", r"\1"), ("<mailto:[^>]+>", ""), ("mailto:" + rx.ADDRESS, ""), (r"""\[([^\]]+)\]\(["'\\ ]*\)""", r"\1")):
    _LINK = f"regexp_replace({_LINK}, {q(_p)}, {q(_r)}, 'g')"
SQL["link_cleanup"] = f"SELECT row_idx, {_LINK} AS text FROM armis_raw_email WHERE raw_body IS NOT NULL"
SQL["html_sniff"] = f"SELECT row_idx, coalesce({m('raw_body', rx.HTML)}, false) AS is_html FROM armis_raw_email"
SQL["header_lines"] = f"WITH {LINES} SELECT row_idx, CAST(pos AS INT) AS pos FROM l WHERE {m(strip('line'), rx.HEADER_LINE)}"
_CLASS = f"""CASE WHEN s = '' THEN 'EMPTY' WHEN s LIKE '-%' AND length(s) < 30 THEN 'SIGN_OFF' WHEN {m('s', rx.SALUTATIONS)} THEN 'SALUTATION' WHEN {contact('line')} THEN 'CONTACT'
  WHEN length(s) >= 80 THEN 'OTHER' WHEN regexp_matches(s, '^\\p{{Ll}}') THEN 'OTHER' WHEN right(s, 1) IN ('!', '?') OR (right(s, 1) = '.' AND length(s) >= 15) THEN 'OTHER' ELSE 'NAME_TITLE' END"""
_CLASSED = f"{LINES}, cl AS (SELECT row_idx, pos, line, {_CLASS} AS class FROM (SELECT *, {_C} AS s FROM l))"
SQL["line_classes"] = f"WITH {_CLASSED} SELECT row_idx, CAST(pos AS INT) AS pos, class FROM cl"
_U, _D = "('NAME_TITLE', 'SALUTATION', 'CONTACT', 'SIGN_OFF')", "('CONTACT', 'NAME_TITLE', 'SIGN_OFF')"
SQL["inline_signatures"] = f"""WITH {_CLASSED}, w AS (SELECT *, lead(class, 1) OVER o AS n1, lead(class, 2) OVER o AS n2, lead(class, 3) OVER o AS n3, lag(class, 1) OVER o AS b1, lag(class, 2) OVER o AS b2
  FROM cl WHERE class <> 'EMPTY' WINDOW o AS (PARTITION BY row_idx ORDER BY pos)),
 p1 AS (SELECT *, coalesce(class = 'CONTACT' OR (class IN {_U} AND coalesce(n1 = 'CONTACT' OR (n1 IN {_U} AND coalesce(n2 = 'CONTACT' OR (n2 IN {_U} AND n3 = 'CONTACT'), false)), false))
  OR (class IN {_D} AND coalesce(b1 = 'CONTACT' OR (b1 IN {_D} AND b2 = 'CONTACT'), false)), false) AS r1 FROM w),
 p2 AS (SELECT *, coalesce(lag(r1, 1) OVER o, false) AS rb1, coalesce(lag(r1, 2) OVER o, false) AS rb2 FROM p1 WINDOW o AS (PARTITION BY row_idx ORDER BY pos)),
 x AS (SELECT row_idx, pos FROM p2 WHERE r1 OR class = 'SIGN_OFF' OR (class = 'SALUTATION' AND n1 = 'NAME_TITLE')
  OR (class = 'NAME_TITLE' AND ((b1 = 'SALUTATION' AND NOT rb1) OR (b1 = 'NAME_TITLE' AND b2 = 'SALUTATION' AND NOT rb2))))
 SELECT row_idx, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text
 FROM (SELECT cl.*, x.pos IS NOT NULL AS gone FROM cl LEFT JOIN x ON cl.row_idx = x.row_idx AND cl.pos = x.pos) GROUP BY row_idx"""

# ---------------------------------------------------------------- metadata
_R = "coalesce(raw_body, '')"


def _addresses(x: str) -> str:
    return f"array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all({x}, {q(rx.ADDRESS)}), lambda a: lower(a)))), '; ')"


def _field(f: str) -> str:
    return f"regexp_extract({_R}, {q(rf'(?i){f}:{rx.S}*([^\n]+?)(?:\r?\n|<br|$)')}, 1)"


def _meta(value: str, out: str) -> str:
    return f"SELECT row_idx, {value} AS {out} FROM armis_raw_email"


SQL["extract_addresses"] = _meta(f"coalesce({_addresses(_R)}, '')", "addresses")
SQL["extract_recipients"] = _meta(f"coalesce({_addresses(_field('To'))}, '')", "to_addr")
SQL["extract_cc"] = _meta(f"coalesce({_addresses(_field('Cc'))}, '')", "cc_addr")
_SUBJECT = f"left({strip(f'''regexp_replace({_field('Subject')}, '<[^>]+>', '', 'g')''')}, 200)"
SQL["extract_subject"] = _meta(_SUBJECT, "subject")
_BARE = lambda x: f"lower(regexp_replace({x}, '^[<>]+|[<>]+$', '', 'g'))"
SQL["extract_sender"] = _meta(
    "coalesce(" + ", ".join(f"nullif({x}, '')" for x in (
        _BARE(f"regexp_extract({_R}, {q(rf'On{rx.S}+[^\n]{{10,60}}?{rx.S}+({rx.NS}+@{rx.NS}+\.\w+){rx.S}*>?{rx.S}*wrote:')}, 1)"),
        _BARE(f"regexp_extract({_R}, {q(rf'(?i)From:{rx.S}*(?:<[^>]*>)?{rx.S}*({rx.NS}+@{rx.NS}+\.\w+)')}, 1)"),
        f"lower(regexp_extract({_R}, {q(f'mailto:({rx.ADDRESS})')}, 1))",
    )) + ", '')",
    "from_addr",
)
_SHORT = f"regexp_extract({_R}, {q(rf'On{rx.S}+{rx.W}{{3}},{rx.S}+({rx.W}{{3}}{rx.S}+\d{{1,2}},{rx.S}+\d{{4}}){rx.S}+at{rx.S}+[\d:]+{rx.S}*[APap][Mm]')}, 1)"
_LOOSE = f"regexp_extract({_R}, {q(rf'({rx.W}+{rx.S}+\d{{1,2}},{rx.S}+\d{{4}})')}, 1)"
SQL["extract_date"] = _meta(
    f"CASE WHEN {_SHORT} <> '' THEN {_SHORT} WHEN regexp_matches({_R}, {q(rf'(?i)Date:{rx.S}*[^\n]+?(?:\r?\n|<br|$)')}) THEN left({strip(_field('Date'))}, 50) ELSE {_LOOSE} END", "date"
)
SQL["reply_depth"] = _meta(f"CAST(greatest(len(regexp_extract_all({_R}, '(?i)wrote:')), len(regexp_extract_all({_R}, '(?i)<blockquote'))) AS INT)", "reply_depth")

# ---------------------------------------------------------------- similarity
_TOK = "list_distinct(list_filter(regexp_extract_all(lower(coalesce(body_text, '')), '[\\p{L}\\p{N}_]+'), lambda w: regexp_full_match(w, '[a-z]{3,}')))"
SQL["token_sets"] = f"SELECT row_idx, CAST(len(t) AS BIGINT) AS n, array_to_string(list_sort(t), ' ') AS tokens FROM (SELECT row_idx, {_TOK} AS t FROM thread_grouper)"
SQL["token_doc_freq"] = f"SELECT w, count(*) AS df FROM (SELECT unnest({_TOK}) AS w FROM thread_grouper) GROUP BY w"
_JACCARD = f"""s AS (SELECT row_idx AS k, {_TOK} AS t FROM {MAILS}), tok AS (SELECT k, len(t) AS n, unnest(t) AS w FROM s),
 j AS (SELECT a.k AS i, b.k AS j, count(*) / (any_value(a.n) + any_value(b.n) - count(*)) AS sim FROM tok a JOIN tok b ON a.w = b.w AND a.k < b.k GROUP BY a.k, b.k)"""
SQL["jaccard_pairs"] = f"WITH {_JACCARD} SELECT i, j, round(sim, 6) AS sim FROM j WHERE sim >= 0.35 AND sim < 0.99"
SQL["jaccard_near_identical"] = f"WITH {_JACCARD} SELECT i, j, round(sim, 6) AS sim FROM j WHERE sim >= 0.99"


def _tfidf(text: str, vocabulary: int, min_df: int, tf: str) -> str:
    stop = "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"
    return f"""docs AS (SELECT row_idx AS k, list_filter(regexp_extract_all(lower(coalesce({text}, '')), '[\\p{{L}}\\p{{N}}_]{{2,}}'), lambda w: NOT list_contains({stop}, w)) AS t FROM {MAILS}),
 terms AS (SELECT k, unnest(list_concat(t, list_transform(range(1, greatest(len(t), 1)), lambda i: t[i] || ' ' || t[i + 1]))) AS term FROM docs),
 tf AS (SELECT k, term, count(*) AS tf FROM terms GROUP BY k, term), n AS (SELECT count(*) AS n FROM docs),
 vocab AS (SELECT term, count(*) AS df FROM tf GROUP BY term HAVING count(*) <= 0.95 * (SELECT n FROM n) AND count(*) >= {min_df} ORDER BY sum(tf) DESC, term LIMIT {vocabulary}),
 raw AS (SELECT k, term, {tf} * (ln((1.0 + (SELECT n FROM n)) / (1 + df)) + 1) AS w FROM tf JOIN vocab USING (term)),
 wt AS (SELECT k, term, w / sqrt(sum(w * w) OVER (PARTITION BY k)) AS w FROM raw)"""


SQL["tfidf_weights"] = f"WITH {_tfidf('body_text', 5000, 1, 'tf')} SELECT k, term, round(w, 6) AS w FROM wt"
SQL["tfidf_bulk_terms"] = f"WITH {_tfidf('cleaned_body', 15000, 2, '(1 + ln(tf))')} SELECT term, count(*) AS df, round(sum(w), 4) AS w FROM wt GROUP BY term"
SQL["cosine_pairs"] = f"""WITH {_tfidf('body_text', 5000, 1, 'tf')}, c AS (SELECT a.k AS i, b.k AS j, sum(a.w * b.w) AS sim FROM wt a JOIN wt b ON a.term = b.term AND a.k < b.k GROUP BY a.k, b.k)
 SELECT i, j, round(sim, 6) AS sim FROM c WHERE sim >= 0.59"""
SQL["message_id_links"] = f"""WITH f AS (SELECT * FROM {FIRST}) SELECT DISTINCT least(a.row_idx, b.row_idx) AS i, greatest(a.row_idx, b.row_idx) AS j
 FROM f a JOIN f b ON a.row_idx <> b.row_idx AND b.eid <> '' AND contains(a.raw_body, b.eid)"""

# ---------------------------------------------------------------- threads
_COMP = """e AS (SELECT DISTINCT least(i, j) AS i, greatest(i, j) AS j FROM edges WHERE i <> j AND (match_method = 'message_id' OR (sim >= 0.35 AND sim < 0.99 AND NOT isnan(sim)))
  AND i IN (SELECT row_idx FROM thread_grouper) AND j IN (SELECT row_idx FROM thread_grouper)),
 und AS (SELECT i AS v, j AS w FROM e UNION SELECT j, i FROM e),
 reach AS (SELECT v, v AS c FROM und UNION SELECT und.w, reach.c FROM reach JOIN und ON und.v = reach.v),
 comp AS (SELECT v, min(c) AS comp FROM reach GROUP BY v)"""
_SPLIT = """x AS (SELECT t.row_idx, coalesce(comp.comp, t.row_idx) AS comp, md5(coalesce(body_text, '')) AS h FROM thread_grouper t LEFT JOIN comp ON comp.v = t.row_idx),
 cl AS (SELECT row_idx, CASE WHEN row_idx = min(row_idx) OVER (PARTITION BY comp, h) THEN comp ELSE -1 - row_idx END AS comp FROM x)"""
_IDS = """ids AS (SELECT comp, 'thread_' || left(sha256(string_agg(coalesce(eid, ''), '|' ORDER BY coalesce(eid, ''))), 12) AS thread_id FROM cl JOIN thread_grouper USING (row_idx) GROUP BY comp),
 th AS (SELECT t.* EXCLUDE (thread_id, grouping_method), ids.thread_id FROM thread_grouper t JOIN cl USING (row_idx) JOIN ids USING (comp))"""
_ALL = f"WITH RECURSIVE {_COMP}, {_SPLIT}, {_IDS}"
SQL["thread_components"] = f"WITH RECURSIVE {_COMP} SELECT v, comp FROM comp"
SQL["thread_duplicate_split"] = f"WITH RECURSIVE {_COMP}, {_SPLIT} SELECT row_idx, comp FROM cl"
SQL["thread_ids"] = f"{_ALL} SELECT row_idx, thread_id FROM th"
_SIZED = "SELECT thread_id, count(*) AS n FROM th GROUP BY thread_id"
SQL["grouping_method"] = f"{_ALL} SELECT CASE WHEN n > 1 THEN 'body_jaccard' ELSE 'singleton' END AS grouping_method, CAST(sum(n) AS BIGINT) AS n FROM ({_SIZED}) GROUP BY 1"
SQL["thread_top10"] = f"{_ALL} {_SIZED} ORDER BY n DESC, thread_id LIMIT 10"
SQL["thread_summary"] = f"""{_ALL}, pp AS (SELECT DISTINCT thread_id, unnest(string_split(coalesce(participants_str, ''), '; ')) AS p FROM th),
 ppl AS (SELECT thread_id, string_agg(p, '|' ORDER BY p) AS people FROM pp WHERE p <> '' GROUP BY thread_id)
 SELECT thread_id, string_agg(eid, '|' ORDER BY eid) AS eids, coalesce(any_value(people), '') AS people, min(timestamp) AS earliest, max(timestamp) AS latest, count(*) AS email_count,
 CASE WHEN count(*) > 1 THEN 'body_jaccard' ELSE 'singleton' END AS grouping_method FROM th LEFT JOIN ppl USING (thread_id) GROUP BY thread_id"""
SQL["thread_metrics"] = f"""WITH RECURSIVE {_COMP}, {_SPLIT}, tk AS (SELECT row_idx, comp, {_TOK} AS t FROM thread_grouper JOIN cl USING (row_idx)),
 pr AS (SELECT a.comp, CASE WHEN len(a.t) = 0 OR len(b.t) = 0 THEN 0.0 ELSE len(list_intersect(a.t, b.t)) / (len(a.t) + len(b.t) - len(list_intersect(a.t, b.t))) END AS sim FROM tk a JOIN tk b ON a.comp = b.comp AND a.row_idx < b.row_idx),
 co AS (SELECT avg(c) AS c FROM (SELECT comp, avg(sim) AS c FROM pr GROUP BY comp)), sz AS (SELECT comp, count(*) AS n FROM cl GROUP BY comp)
 SELECT 'Jaccard' AS method, CAST(0.35 AS DOUBLE) AS threshold, count(*) AS total_threads, count(*) FILTER (WHERE n > 1) AS multi_email_threads, count(*) FILTER (WHERE n = 1) AS singletons,
 round_even(count(*) FILTER (WHERE n = 1) * 100 / sum(n), 1) AS singleton_pct, round_even(sum(n) / count(*), 2) AS avg_thread_size, max(n) AS max_thread_size,
 (SELECT round_even(coalesce(c, 0), 4) FROM co) AS avg_cohesion, CAST(sum(n) FILTER (WHERE n > 1) AS BIGINT) AS emails_in_threads, round_even(sum(n) FILTER (WHERE n > 1) * 100 / sum(n), 1) AS emails_in_threads_pct FROM sz"""

# ---------------------------------------------------------------- bulk filter


def _category(x: str) -> str:
    low = f"lower(coalesce({x}, ''))"
    return "CASE " + " ".join(f"WHEN {' OR '.join(f'contains({low}, {q(p)})' for p in ps)} THEN '{c}'" for c, ps in rx.WEAK_LABELS.items()) + " ELSE 'genuine' END"


SQL["weak_label_rows"] = f"SELECT row_idx, CASE WHEN c = 'genuine' THEN 0 ELSE 1 END AS label, c AS category FROM (SELECT row_idx, {_category('raw_body')} AS c FROM armis_raw_email)"
SQL["weak_label_counts"] = f"SELECT {_category('raw_body')} AS category, count(*) AS n FROM armis_raw_email GROUP BY 1"
SQL["label_confusion"] = f"SELECT label, CASE WHEN {_category('text')} = 'genuine' THEN 0 ELSE 1 END AS predicted, count(*) AS n FROM labeled WHERE label IS NOT NULL GROUP BY 1, 2"
_T = "lower(coalesce(raw_body, ''))"
_FLAG = lambda p, c: f"CAST(contains({_T}, '{p}') AS INT) AS {c}"
_COUNT = lambda p, c: f"CAST(len(regexp_extract_all({_T}, '{p}')) AS INT) AS {c}"
SQL["bulk_features"] = (
    f"SELECT row_idx, {_FLAG('unsubscribe', 'contains_unsubscribe')}, {_FLAG('out of office', 'contains_ooo')}, {_FLAG('do not reply', 'contains_do_not_reply')}, {_FLAG('generated by ai', 'contains_generated_by_ai')}, "
    f"{_FLAG('meeting notes', 'contains_meeting_notes')}, CAST(length({_T}) AS INT) AS text_length, {_COUNT('url', 'num_urls')}, {_COUNT('reply', 'num_reply_markers')} FROM armis_raw_email"
)
_N = "lower(raw_body)"
for _p, _r in ((f"http{rx.NS}+", " url "), (f"{rx.NS}+@{rx.NS}+", " email "), ("_+", " "), (f"{rx.S}+", " ")):
    _N = f"regexp_replace({_N}, {q(_p)}, {q(_r)}, 'g')"
SQL["ml_text_normalize"] = f"SELECT row_idx, {strip(_N)} AS text FROM armis_raw_email WHERE raw_body IS NOT NULL"

# ---------------------------------------------------------------- layers after rendering
_HEADS = f"""{LINES}, h0 AS (SELECT row_idx, pos, line, {m(strip('line'), rx.HEADER_LINE)} AS head, {strip('line')} = '' AS blank FROM l)"""


def _fill(src: str, out: str, have: str) -> str:
    near = " OR ".join(f"coalesce(lag({have}, {k}) OVER o, false)" for k in (1, 2, 3))
    after = " OR ".join(f"coalesce(lead(head, {k}) OVER o, false)" for k in (1, 2, 3))
    return f", {out} AS (SELECT *, {have} OR (blank AND ({near}) AND ({after})) AS f{out} FROM {src} WINDOW o AS (PARTITION BY row_idx ORDER BY pos))"


_FILLED = f"{_HEADS}{_fill('h0', 'h1', 'head')}{_fill('h1', 'h2', 'fh1')}{_fill('h2', 'h3', 'fh2')}"
SQL["header_blocks"] = f"""WITH {_FILLED} SELECT row_idx, CAST(pos AS INT) AS pos FROM (SELECT row_idx, pos, fh3, coalesce(lag(fh3) OVER (PARTITION BY row_idx ORDER BY pos), false) AS b FROM h3) WHERE fh3 AND NOT b"""
SQL["header_lines_dropped"] = _text(f", d AS (SELECT *, {m(strip('line'), rx.HEADER_LINE)} AS head FROM l)", "NOT head")


def _first_mail(x: str) -> str:
    found = f"regexp_extract(coalesce({x}, ''), {q(r'[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+')}, 0)"
    return f"lower({strip(found, r'<>(): \t_')})"


SQL["first_address"] = f"SELECT row_idx, {_first_mail('raw_body')} AS address FROM armis_raw_email"
_WORDED = lambda ws: f"regexp_matches(line, {q(rx.ci2(rx.LB + '(?:' + ws + ')' + rx.RB))})"
SQL["header_block_metadata"] = f"""WITH {_FILLED}, b AS (SELECT *, pos - row_number() OVER (PARTITION BY row_idx ORDER BY pos) AS block FROM h3 WHERE fh3),
 c AS (SELECT *, {_first_mail('line')} AS mail, {_WORDED('from|von|de|envoyé|enviado')} AS sends, {_WORDED('to|an|à|para')} AS gets,
  length(regexp_replace(regexp_extract(line, {q(f'^[{rx.WS}>]*')}, 0), '[^>]', '', 'g')) AS marks FROM b),
 n AS (SELECT *, coalesce(nullif(mail, ''), nullif(lead(mail) OVER (PARTITION BY row_idx, block ORDER BY pos), '')) AS near FROM c)
 SELECT row_idx, CAST(min(pos) AS INT) AS pos, count(*) AS n_lines, coalesce(max_by(near, pos) FILTER (WHERE sends AND near IS NOT NULL), min_by(mail, pos) FILTER (WHERE mail <> ''), '') AS sender,
 coalesce(max_by(near, pos) FILTER (WHERE gets AND NOT sends AND near IS NOT NULL), '') AS recipient, CAST(max(marks) AS INT) AS depth FROM n GROUP BY row_idx, block"""


def _stitch(x: str) -> str:
    return f"regexp_replace({x}, {q(rf'(?im)(^[{rx.WS}>]*On{rx.S}+[^\n]{{5,180}})\n([{rx.WS}>]*wrote{rx.S}*:)')}, '\\1 \\2', 'g')"


SQL["stitched_headers"] = f"SELECT row_idx, {_stitch('raw_body')} AS text FROM armis_raw_email WHERE raw_body IS NOT NULL"


def _finish(x: str) -> str:
    tails = f"regexp_replace({x}, '[{_TAILS}]+(\\n|$)', '\\1', 'g')"
    blanks = f"regexp_replace({tails}, '\\n{{4,}}', chr(10) || chr(10) || chr(10), 'g')"
    quotes = f"regexp_replace({strip(blanks)}, '^\"+|\"+$', '', 'g')"
    return strip(quotes)


SQL["finished_text"] = f"SELECT row_idx, CASE WHEN length(t) >= 10 THEN t ELSE '' END AS text FROM (SELECT row_idx, {_finish('raw_body')} AS t FROM armis_raw_email WHERE raw_body IS NOT NULL)"
_DIS = _run(m("s", rx.DISCLAIMER_TRIGGERS), f"s <> '' AND ({m('s', rx.DISCLAIMER_TRIGGERS)} OR {m('s', rx.DISCLAIMER_VOCABULARY)})", f"(SELECT row_idx, pos, line, {_C} AS s FROM l1)").lstrip(", ")
_SGN = _run(f"({m('s', rx.SALUTATIONS)} OR {m('s', rx.FOOTERS)})", f"(s = '' OR {contact('line')})", f"(SELECT row_idx, pos, line, {strip('line')} AS s FROM l3)").lstrip(", ")
for _a in ("f", "g", "r", "d"):
    _SGN = _SGN.replace(f"{_a} AS (", f"{_a}2 AS (").replace(f"FROM {_a})", f"FROM {_a}2)")
_NOISE = f"regexp_matches(line, {q(rf'^[|{rx.WS}\-:=]+$')})"
SQL["layers_truncate"] = f"""WITH l AS (SELECT row_idx, pos - 1 AS pos, ls[pos] AS line FROM (SELECT row_idx, ls, unnest(range(1, len(ls) + 1)) AS pos
  FROM (SELECT row_idx, string_split({_stitch(_LINK.replace('raw_body', 'body_text'))}, chr(10)) AS ls FROM thread_grouper WHERE body_text IS NOT NULL))),
 c AS (SELECT *, coalesce(min(CASE WHEN {m(strip('line'), rx.REPLY_TRIGGERS)} THEN pos END) OVER (PARTITION BY row_idx), 1000000000) AS cut FROM l),
 l1 AS (SELECT row_idx, pos, line FROM c WHERE pos < cut), {_DIS},
 l2 AS (SELECT row_idx, pos, CASE WHEN after_gone AND s = '' THEN '' ELSE line END AS line FROM d WHERE NOT gone),
 c2 AS (SELECT *, coalesce(min(CASE WHEN {m(strip('line'), rx.INLINE_SIGNATURE)} THEN pos END) OVER (PARTITION BY row_idx), 1000000000) AS cut FROM l2),
 l3 AS (SELECT row_idx, pos, line FROM c2 WHERE pos < cut), {_SGN},
 l4 AS (SELECT row_idx, pos, {_TIDY} AS line FROM d2 WHERE NOT gone),
 l5 AS (SELECT row_idx, pos, regexp_replace(line, {q(f'^{rx.S}*>[{rx.WS}>]*')}, '') AS line FROM l4 WHERE NOT {_NOISE}),
 j AS (SELECT row_idx, string_agg(line, chr(10) ORDER BY pos) AS text FROM l5 GROUP BY row_idx)
 SELECT row_idx, CASE WHEN length(t) >= 10 THEN t ELSE '' END AS text FROM (SELECT row_idx, coalesce({_finish('text')}, '') AS t FROM (SELECT row_idx FROM thread_grouper WHERE body_text IS NOT NULL) LEFT JOIN j USING (row_idx))"""

# ---------------------------------------------------------------- programs
SQL["field_counts"] = "SELECT count(*) AS mails, count(*) FILTER (WHERE from_addr <> '') AS with_from, count(*) FILTER (WHERE date <> '') AS with_date, count(*) FILTER (WHERE subject <> '') AS with_subject FROM thread_grouper"
SQL["filtered_split"] = f"""WITH x AS (SELECT raw_body, {_category('raw_body')} <> 'genuine' AS f FROM armis_raw_email)
 SELECT 'genuine' AS part, count(*) AS n, CAST(coalesce(sum(length(raw_body)), 0) AS BIGINT) AS chars FROM x WHERE NOT f UNION ALL SELECT 'filtered', count(*), CAST(coalesce(sum(length(raw_body)), 0) AS BIGINT) FROM x WHERE f"""
SQL["message_id_links"] = """WITH e AS (SELECT DISTINCT i, j FROM edges WHERE match_method = 'message_id' AND i <> j),
 s AS (SELECT a.eid, string_agg(DISTINCT chr(10) || 'In-Reply-To: ' || b.eid, '') AS fields FROM e JOIN thread_grouper a ON a.row_idx = e.i JOIN thread_grouper b ON b.row_idx = e.j WHERE a.eid <> b.eid GROUP BY a.eid),
 f AS (SELECT * FROM armis_raw_email WHERE eid IS NOT NULL AND raw_body IS NOT NULL QUALIFY row_number() OVER (PARTITION BY eid ORDER BY row_idx) = 1),
 t AS (SELECT f.row_idx, f.eid, f.raw_body || coalesce(s.fields, '') AS body FROM f LEFT JOIN s USING (eid))
 SELECT DISTINCT least(a.row_idx, b.row_idx) AS i, greatest(a.row_idx, b.row_idx) AS j FROM t a JOIN t b ON a.row_idx <> b.row_idx AND b.eid <> '' AND contains(a.body, b.eid)"""
SQL["thread_size_stats"] = f"{_ALL} SELECT count(*) AS threads, count(*) FILTER (WHERE n > 1) AS multi, max(n) AS largest, min(n) AS smallest, round_even(avg(n), 2) AS mean_size FROM ({_SIZED})"


def _squeeze(c: str) -> str:
    return f"regexp_replace({c}, '[\\r\\n]+', ' ', 'g') AS {c}"


SQL["thread_export"] = f"""{_ALL}, z AS ({_SIZED}) SELECT row_idx, eid, thread_id, CASE WHEN n > 1 THEN 'body_jaccard' ELSE 'singleton' END AS grouping_method, from_addr, to_addr, cc_addr, subject, date, timestamp, reply_depth, participant_count,
 participants_str, {_squeeze('cleaned_body')}, {_squeeze('body_text')} FROM th JOIN z USING (thread_id)"""


def _clustered(name: str, edges: str) -> str:
    """Components of one method's edges and the links, equal bodies split off."""
    both = f"{edges} UNION SELECT i, j FROM ml"
    return f"""{name}_u AS (SELECT i AS v, j AS w FROM ({both}) UNION SELECT j, i FROM ({both})),
 {name}_r AS (SELECT v, v AS c FROM {name}_u UNION SELECT {name}_u.w, {name}_r.c FROM {name}_r JOIN {name}_u ON {name}_u.v = {name}_r.v),
 {name}_x AS (SELECT f.row_idx, coalesce(c, f.row_idx) AS comp, md5(coalesce(body_text, '')) AS h FROM mails f LEFT JOIN (SELECT v, min(c) AS c FROM {name}_r GROUP BY v) ON v = f.row_idx),
 {name} AS (SELECT row_idx, CASE WHEN row_idx = min(row_idx) OVER (PARTITION BY comp, h) THEN comp ELSE -1 - row_idx END AS comp FROM {name}_x)"""


_BOTH = f"""WITH RECURSIVE mails AS (SELECT * FROM {MAILS}), ml AS (SELECT DISTINCT least(i, j) AS i, greatest(i, j) AS j FROM edges WHERE match_method = 'message_id' AND i <> j AND i IN (SELECT row_idx FROM mails) AND j IN (SELECT row_idx FROM mails)),
 {_JACCARD}, {_tfidf('body_text', 5000, 1, 'tf')}, co AS (SELECT a.k AS i, b.k AS j, sum(a.w * b.w) AS sim FROM wt a JOIN wt b ON a.term = b.term AND a.k < b.k GROUP BY a.k, b.k),
 {_clustered('cj', 'SELECT i, j FROM j WHERE sim >= 0.35 AND sim < 0.99')}, {_clustered('ct', 'SELECT i, j FROM co WHERE sim >= 0.59 AND sim < 0.99')}"""


def _metrics_of(c: str, pairs: str, method: str, t: float) -> str:
    return f"""SELECT '{method}' AS method, CAST({t} AS DOUBLE) AS threshold, count(*) AS total_threads, count(*) FILTER (WHERE n > 1) AS multi_email_threads, count(*) FILTER (WHERE n = 1) AS singletons,
 round_even(count(*) FILTER (WHERE n = 1) * 100 / sum(n), 1) AS singleton_pct, round_even(sum(n) / count(*), 2) AS avg_thread_size, max(n) AS max_thread_size,
 round_even(coalesce(avg(coalesce(s, 0) / (n * (n - 1) / 2)) FILTER (WHERE n > 1), 0), 4) AS avg_cohesion, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS emails_in_threads, round_even(coalesce(sum(n) FILTER (WHERE n > 1), 0) * 100 / sum(n), 1) AS emails_in_threads_pct
 FROM (SELECT comp, count(*) AS n FROM {c} GROUP BY comp) LEFT JOIN (SELECT a.comp, sum(p.sim) AS s FROM {pairs} p JOIN {c} a ON a.row_idx = p.i JOIN {c} b ON b.row_idx = p.j WHERE a.comp = b.comp GROUP BY a.comp) USING (comp)"""


_MT, _MJ = _metrics_of("ct", "co", "TF-IDF", 0.59), _metrics_of("cj", "j", "Jaccard", 0.35)
SQL["thread_method_metrics"] = f"{_BOTH} {_MT} UNION ALL {_MJ}"
SQL["thread_flagship"] = f"""{_BOTH}, mt AS ({_MT}), mj AS ({_MJ}), pick AS (SELECT (SELECT avg_cohesion FROM mt) < 0.8 * (SELECT avg_cohesion FROM mj) AS jac),
 cc AS (SELECT row_idx, comp FROM cj WHERE (SELECT jac FROM pick) UNION ALL SELECT row_idx, comp FROM ct WHERE NOT (SELECT jac FROM pick))
 SELECT thread_id, CAST(sum(n) AS BIGINT) AS n, CASE WHEN sum(n) = 1 THEN 'singleton' WHEN (SELECT jac FROM pick) THEN 'body_jaccard' ELSE 'body_tfidf' END AS grouping_method
 FROM (SELECT 'thread_' || left(sha256(string_agg(coalesce(eid, ''), '|' ORDER BY coalesce(eid, ''))), 12) AS thread_id, count(*) AS n FROM cc JOIN mails USING (row_idx) GROUP BY comp) GROUP BY thread_id"""

_NB = "lower(coalesce(cleaned_body, ''))"
for _p, _r in ((f"http{rx.NS}+", " url "), (f"{rx.NS}+@{rx.NS}+", " email "), ("_+", " "), (f"{rx.S}+", " ")):
    _NB = f"regexp_replace({_NB}, {q(_p)}, {q(_r)}, 'g')"
_FIXED_TF = _tfidf("clean_text", 15000, 2, "(1 + ln(tf))").replace(f"FROM {MAILS}", "FROM texts")
_FLAGS = [f"CAST(contains(clean_text, '{p}') AS INT)" for p in ("unsubscribe", "out of office", "do not reply", "generated by ai", "meeting notes")]
_SCORED = zip((0.9, 0.8, 0.7, 0.6, 0.5, -0.001, 0.05, -0.02), [*_FLAGS, "length(clean_text)", "len(regexp_extract_all(clean_text, 'url'))", "len(regexp_extract_all(clean_text, 'reply'))"])
SQL["bulk_fixed_scores"] = f"""WITH texts AS (SELECT row_idx, {strip(_NB)} AS clean_text FROM {MAILS}), {_FIXED_TF},
 dots AS (SELECT k, sum(w * (length(term) % 7 - 3)) AS dot FROM wt GROUP BY k),
 z AS (SELECT row_idx, clean_text, -0.25 + coalesce(dot, 0) + {' + '.join(f'{w} * {x}' for w, x in _SCORED)} AS z FROM texts LEFT JOIN dots ON k = row_idx)
 SELECT row_idx, round(1 / (1 + exp(-z)), 6) AS p, CASE WHEN {_category('clean_text')} <> 'genuine' OR 1 / (1 + exp(-z)) >= 0.95 THEN 1 ELSE 0 END AS is_filtered FROM z"""
_S0 = strip("line")
_NAME = r"^\p{Lu}[\p{L}'.\-]*(?: \p{Lu}[\p{L}'.\-]*){0,3}$"
SQL["signature_parts"] = f"""WITH {LINES} SELECT row_idx, CAST(pos AS INT) AS pos FROM (SELECT *, {_S0} AS s FROM l) WHERE s <> '' AND ({contact('s')} OR regexp_matches(s, {q(_NAME)})
 OR {m('s', rf'^{rx.W}{rx.A}{{0,40}}{rx.S}team$')} OR regexp_matches(s, '^[-_=*~|]{{2,}}$') OR regexp_matches(s, {q(r'^\*\*[^*]+\*\*$')}) OR regexp_matches(s, {q(r'^\p{Lu}[^|\n]*\|[^|\n]+$')}))"""
SQL["corpus_titles"] = "SELECT DISTINCT source, array_to_string(list_transform(string_split(replace(source, '_', ' '), ' '), lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ') AS title FROM documents WHERE source IS NOT NULL"
SQL["label_report"] = f"""WITH c AS ({SQL['label_confusion']}), r AS (SELECT label AS class, sum(n) AS support FROM c GROUP BY 1), p AS (SELECT predicted AS class, sum(n) AS said FROM c GROUP BY 1), h AS (SELECT label AS class, n AS hit FROM c WHERE label = predicted),
 x AS (SELECT coalesce(r.class, p.class) AS class, coalesce(support, 0) AS support, coalesce(said, 0) AS said, coalesce(hit, 0) AS hit FROM r FULL JOIN p ON r.class = p.class LEFT JOIN h ON h.class = coalesce(r.class, p.class)),
 y AS (SELECT *, CASE WHEN said > 0 THEN hit / said ELSE 0.0 END AS pr, CASE WHEN support > 0 THEN hit / support ELSE 0.0 END AS re FROM x)
 SELECT CAST(class AS INT) AS class, round(pr, 6) AS precision, round(re, 6) AS recall, round(CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0.0 END, 6) AS f1, CAST(support AS BIGINT) AS support FROM y"""
