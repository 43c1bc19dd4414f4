"""SQL of queries whose rule runs over lists and patterns; the same rows as the DataFrame side, over whole tables."""

from __future__ import annotations

from ..functions import similarity
from ..operators import search
from . import aggregates, exchange, joins, projections, recipes  # noqa: F401  (their queries come first)
from .joins import _BM, _SCORE
from .registry import ORACLES, QUERIES, VISIBLE, WORKS

NL = "chr(10)"


def fold(c: str) -> str:
    return f"strip_accents(lower({c}))"


def words(c: str) -> str:
    return f"list_filter(string_split(regexp_replace({fold(c)}, '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '')"


def once(c: str) -> str:
    """Distinct elements in the order of their first place."""
    return f"list_filter({c}, lambda x, i: list_position({c}, x) = i)"


def squeeze(c: str) -> str:
    return f"trim(regexp_replace({c}, '\\s+', ' ', 'g'), ' ')"


_STOP = "(" + ", ".join(f"'{w}'" for w in similarity.STOP) + ")"


def phrases(w: str, width: int) -> str:
    """Phrases of the list column ``w``, elisions cut off."""
    bare = f"list_filter(list_transform({w}, lambda x: regexp_replace(x, '{similarity.ELIDED.replace(chr(39), chr(39) * 2)}', '')), lambda x: length(x) > 1)"
    edge = lambda k: f"length(b[k + {k}]) >= 4 AND b[k + {k}] NOT IN {_STOP}"
    run = " || ' ' || ".join(f"b[k + {j}]" for j in range(width))
    return f"list_transform(list_filter(range(1, len(b) - {width - 2}), lambda k: {edge(0)} AND {edge(width - 1)}), lambda k: {run})", bare


def _phrases_of(source: str, w: str, width: int) -> str:
    run, bare = phrases("w", width)
    return f"SELECT md_id, {run} AS p FROM (SELECT md_id, {bare} AS b FROM (SELECT md_id, {w} AS w FROM {source}))"


def unmark(c: str) -> str:
    t = f"regexp_replace({c}, '!?\\[([^\\]]*)\\]\\([^)]*\\)', '\\1', 'g')"
    t = f"regexp_replace({t}, '(?m)^\\s*(?:>\\s?|#{{1,6}}\\s+|\\d+\\.\\s+|[-*]\\s+)+', '', 'g')"
    t = f"regexp_replace({t}, '(^|[^\\\\*_]|\\\\[*_])[*_]+', '\\1', 'g')"
    return f"regexp_replace({t}, '\\\\([*_\\[\\]()#.!-])', '\\1', 'g')"


def printed_form(c: str) -> str:
    return f"trim(regexp_replace({fold(c)}, '[ \t]+', ' ', 'g'), ' ')"


_MONTHS = "'" + "', '".join("janvier février mars avril mai juin juillet août septembre octobre novembre décembre".split()) + "'"
_DAY = f"(?i)\\b(\\d{{1,2}})(?:er)? ({_MONTHS.replace(chr(39), '').replace(', ', '|')}) (\\d{{4}})\\b"


def day(top: str) -> str:
    m = f"lower(regexp_extract({top}, '{_DAY}', 2))"
    return f"CASE WHEN regexp_extract({top}, '{_DAY}', 3) <> '' THEN regexp_extract({top}, '{_DAY}', 3) || '-' || lpad(coalesce(list_position([{_MONTHS}], {m}), 0)::VARCHAR, 2, '0') || '-' || lpad(regexp_extract({top}, '{_DAY}', 1), 2, '0') END"


def title_page(c: str, key: str, table: str) -> str:
    top = f"array_to_string(string_split({c}, {NL})[1:25], {NL})"
    return f"""SELECT {key}, {day('top')} AS day, nullif(lower(regexp_extract(top, '(?i)\\b(matin|après-midi|soir)\\b', 1)), '') AS time,
        nullif(regexp_extract(top, '\\(([A-Z][A-Za-z'' ,]{{3,60}})\\)', 1), '') AS original_title FROM (SELECT {key}, {top} AS top FROM {table})"""


def label(p: str) -> str:
    return f"nullif(trim(regexp_extract(top, '(?im)^(?:{p})\\s*:\\s*(.+)$', 1)), '')"


_ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&rsquo;", "’"), ("&amp;", "&")]


def html_to_text(c: str) -> str:
    t = f"regexp_replace({c}, '(?is)<(?:script|style)\\b.*?</(?:script|style)>', ' ', 'g')"
    t = f"regexp_replace({t}, '(?i)</?(?:p|div|br|li|ul|ol|h[1-6]|tr|td|th|table|blockquote|section|article)\\b[^>]*>', ' ', 'g')"
    t = f"regexp_replace({t}, '<[^>]+>', '', 'g')"
    for a, b in _ENTITIES:
        t = f"replace({t}, '{a}', '{b}')"
    return squeeze(t)


_LINKS = "list_concat(regexp_extract_all(text, '\\]\\(([^)\\s]+)\\)', 1), regexp_extract_all(text, 'href=\"([^\"]+)\"', 1))"
_SAID = ["première", "deuxième", "troisième", "quatrième", "cinquième", "sixième"]
_PARTS = " ".join(f"WHEN contains(lower(title), '{w} partie') THEN {k}" for k, w in enumerate(_SAID, 1))
_LOWER = "('" + "', '".join([m.capitalize() for m in "janvier février mars avril mai juin juillet août septembre octobre novembre décembre matin soir après-midi partie".split()]) + "')"
_LONG = "list_filter(regexp_split_to_array(regexp_replace(lower(body), '[^a-zà-ÿ ]+', ' ', 'g'), ' +'), lambda x: length(x) >= 4)"
_EDGE = f"list_concat(l[1:40], list_concat(l[greatest(len(l) - 39, 1):], list_filter(l, lambda x: length(x) <= 45)))"
_STATE = f"CASE WHEN list_bool_or(list_transform(e, lambda x: contains(x, own))) THEN 'confirmed' WHEN list_bool_or(list_transform(e, lambda x: regexp_matches(x, '^(?:fr\\.?|frere|pasteur|signe|par) [a-z''-]+ [a-z''-]+$'))) THEN 'contradicted' ELSE 'not printed' END"
_SIGNED = f"SELECT md_id, {_STATE} AS state FROM (SELECT md_id, own, {_EDGE} AS e FROM (SELECT md_id, {printed_form('preacher')} AS own, string_split({printed_form('body')}, {NL}) AS l FROM markdown WHERE body IS NOT NULL AND preacher IS NOT NULL))"
_STEM = "|".join(sorted(search.ENDINGS["fr"], key=len, reverse=True))
_TWO = "array_to_string(string_split({0}, ' ')[1:2], ' ')"


def _bare_title(c: str) -> str:
    return f"trim(regexp_replace(strip_accents(lower(regexp_replace(lower({c}), '\\(?\\b(?:partie|part|chapitre)?\\s*\\d+\\)?\\s*$', ''))), '[^a-z0-9]+', ' ', 'g'))"


_FP = f"SELECT md_id, unnest(list_distinct(({_LONG})[1:200])) AS item FROM markdown WHERE body IS NOT NULL AND source = "

ORACLES.update({
    "tok_ngrams": f"SELECT md_id, array_to_string(p, '|') AS phrases FROM ({_phrases_of('markdown WHERE body IS NOT NULL', words('body'), 2)})",
    "tok_stems": f"WITH s AS (SELECT md_id, list_transform(list_filter({words('title')}, lambda x: length(x) > 2 AND x NOT IN {_STOP}), lambda x: left(regexp_replace(x, '(?:ing|ed|es|s)$', ''), 6)) AS l FROM markdown WHERE title IS NOT NULL) SELECT md_id, array_to_string({once('l')}, ' ') AS stems FROM s",
    "tok_ocr_noise": "SELECT md_id, len(list_filter(regexp_split_to_array(body, '\\s+'), lambda x: regexp_matches(x, '\\p{Ll}\\p{Lu}|[�ﬁﬂ]|\\p{L}-$')))::INTEGER AS n FROM markdown WHERE body IS NOT NULL",
    "extract_links": f"WITH l AS (SELECT doc_id, {_LINKS} AS l FROM documents WHERE text IS NOT NULL), d AS (SELECT doc_id, {once('l')} AS l FROM l) SELECT doc_id, (generate_subscripts(l, 1) - 1)::INTEGER AS k, unnest(l) AS href FROM d",
    "extract_part_number": f"SELECT md_id, coalesce(nullif(regexp_extract(title, '\\((\\d{{1,2}})\\)\\s*$', 1), '')::INTEGER, nullif(regexp_extract(title, '(?i)\\bpart(?:ie)?\\s+(\\d{{1,2}})\\b', 1), '')::INTEGER, CASE {_PARTS} END, nullif(regexp_extract(title, '-(\\d{{1,2}})$', 1), '')::INTEGER) AS part FROM markdown WHERE title IS NOT NULL",
    "txt_sentence_case": f"WITH f AS (SELECT md_id, regexp_extract(subtitle, '^(\\s*\\S+)', 1) AS f, subtitle AS s FROM markdown WHERE subtitle IS NOT NULL) SELECT md_id, f || coalesce(array_to_string(list_transform(regexp_extract_all(substring(s, length(f) + 1), '\\s|\\S+'), lambda x: CASE WHEN x IN {_LOWER} THEN lower(x) ELSE x END), ''), '') AS subtitle FROM f",
    "txt_heading_guard": f"SELECT md_id, regexp_replace(replace({fold('upper(t)')}, 'œ', 'oe'), '[^a-z0-9]', '', 'g') = regexp_replace(replace({fold('t')}, 'œ', 'oe'), '[^a-z0-9]', '', 'g') AS same FROM (SELECT md_id, translate(title, 'ı', 'i') AS t FROM markdown WHERE title IS NOT NULL)",
    "txt_heading_candidates": f"WITH p AS (SELECT md_id, list_filter(list_transform(regexp_split_to_array(body, '\\n\\s*\\n'), lambda x: trim(x, ' ')), lambda x: NOT contains(x, {NL}) AND len(regexp_split_to_array(x, '\\s+')) <= 15 AND ((regexp_matches(x, '\\p{{Lu}}.*\\p{{Lu}}.*\\p{{Lu}}.*\\p{{Lu}}') AND NOT regexp_matches(x, '\\p{{Ll}}')) OR regexp_full_match(x, '\\*\\*[^*]*\\p{{L}}{{2}}[^*]*\\p{{L}}{{2}}[^*]*\\*\\*'))) AS l FROM markdown WHERE body IS NOT NULL) SELECT md_id, (generate_subscripts(l, 1) - 1)::INTEGER AS k, unnest(l) AS heading FROM p",
    "txt_clean_lines": f"SELECT md_id, trim(regexp_replace(array_to_string(list_filter(list_transform(string_split(body, {NL}), lambda x: trim(x, ' ')), lambda x: NOT regexp_full_match(x, '(?:(?:page )?\\d{{1,4}}(?: ?(?:/|sur) ?\\d{{1,4}})?|[-–—•\\[] ?\\d{{1,4}} ?[-–—•\\]])')), {NL}), '\\n{{3,}}', {NL} || {NL}, 'g')) AS text FROM markdown WHERE body IS NOT NULL",
    "txt_file_cards": "SELECT md_id, regexp_replace(regexp_replace(body, '\\[\\s*\\n+\\s*([^\\]\\n]+?)\\s*(?:\\n[^\\]]*)?\\]\\(([^)\\s]+)\\)', '[\\1](\\2)', 'g'), 'https?://(?:www\\.)?mevar\\.example(/[^\\s)\"'']*)', '\\1', 'g') AS text FROM markdown WHERE body IS NOT NULL",
    "txt_excerpt_200": f"WITH p AS (SELECT md_id, list_filter(regexp_split_to_array(body, '\\n\\s*\\n'), lambda x: NOT regexp_matches(x, '^\\s*(?:#|!\\[|---|\\|)') AND length(trim(x, ' ')) > 0)[1] AS x FROM markdown WHERE body IS NOT NULL), u AS (SELECT md_id, {squeeze(unmark('x'))} AS p FROM p) SELECT md_id, CASE WHEN length(p) <= 200 THEN p WHEN p IS NOT NULL THEN regexp_replace(left(p, 200), '\\s+\\S*$', '') || '…' END AS excerpt FROM u",
    "norm_unmark": f"SELECT md_id, {unmark('body')} AS value FROM markdown WHERE body IS NOT NULL",
    "extract_title_page": title_page("body", "md_id", "markdown WHERE body IS NOT NULL"),
    "extract_header_html": title_page(html_to_text("text"), "doc_id", "documents WHERE text IS NOT NULL"),
    "txt_html_to_text": f"SELECT doc_id, {html_to_text('text')} AS text FROM documents WHERE text IS NOT NULL",
    "extract_metadata": f"""WITH l AS (SELECT md_id, array_to_string(string_split(body, {NL})[1:25], {NL}) AS page, list_filter(list_transform(string_split(body, {NL}), lambda x: trim(x, ' ')), lambda x: x <> '')[1:20] AS l FROM markdown WHERE body IS NOT NULL), t AS (SELECT md_id, page, l, array_to_string(l, {NL}) AS top FROM l)
        SELECT md_id, coalesce({label('titre|sujet|title')}, nullif(regexp_extract(top, '(?m)^#+\\s+(.+)$', 1), ''), list_filter(l, lambda x: regexp_matches(x, '\\p{{Lu}}{{2}}') AND NOT regexp_matches(x, '\\p{{Ll}}') AND length(x) > 5)[1]) AS title,
        coalesce({label('date')}, {day('page')}) AS date, {label('lieu|place|location')} AS location, regexp_replace({label('pr[ée]dicateur|orateur|par|preacher')}, '(?i)\\s+(?:le|du|de la|à)$', '') AS preacher FROM t""",
    "extract_printed": f"SELECT md_id, list_bool_or(list_transform(string_split({printed_form('body')}, {NL}), lambda x: length(x) <= 45 AND contains(x, {printed_form('location')}))) AS printed FROM markdown WHERE body IS NOT NULL AND location IS NOT NULL",
    "extract_signature": _SIGNED,
    "dq_attribution": f"SELECT state, count(*) AS n FROM ({_SIGNED}) GROUP BY 1",
    "sim_shares_stem": f"WITH {WORKS}, p AS (SELECT a.md_id, {_bare_title('a.title')} AS x, {_bare_title('b.title')} AS y FROM works a JOIN works b ON a.duplicate_of = b.path WHERE a.title IS NOT NULL AND b.title IS NOT NULL) SELECT md_id, len(string_split(x, ' ')) >= 2 AND {_TWO.format('x')} = {_TWO.format('y')} AND length({_TWO.format('x')}) >= 8 AS same FROM p",
    "agg_doc_freq": " ".join(["WITH w AS (SELECT md_id, string_split(trim(regexp_replace(lower(body), '[^a-zà-ÿ'']+', ' ', 'g'), ' '), ' ') AS w FROM markdown WHERE body IS NOT NULL),", "i AS (", " UNION ALL ".join(f"SELECT md_id, unnest(p) AS phrase FROM (SELECT md_id, {phrases('w', k)[0]} AS p FROM (SELECT md_id, {phrases('w', k)[1]} AS b FROM w))" for k in (2, 3)), ") SELECT phrase, count(DISTINCT md_id) AS df FROM i GROUP BY 1 HAVING count(DISTINCT md_id) >= 8"]),
    "norm_words_accented": f"SELECT md_id, len({_LONG})::INTEGER AS n FROM markdown",
    "norm_spelling_key": f"SELECT DISTINCT preacher, regexp_replace({squeeze(fold('replace(preacher, ' + chr(39) + '’' + chr(39) + ', ' + chr(39) * 4 + ')'))}, '^(?:fr|frere|soeur|pasteur|past|rev|dr|evangeliste)\\.? ', '') AS value FROM markdown WHERE preacher IS NOT NULL",
    "win_ascending_run": "WITH c AS (SELECT md_id, list_transform(bible_refs, lambda r: coalesce(try_cast(nullif(regexp_extract(r, ' (\\d+)', 1), '') AS INTEGER), 0)) AS c FROM markdown WHERE len(bible_refs) > 0) SELECT md_id, array_to_string(c[1:coalesce(list_min(list_filter(range(1, len(c)), lambda i: c[i + 1] <= c[i])), len(c))], ',') AS run FROM c",
    "filt_opening": f"""WITH l AS (SELECT md_id, list_filter(list_transform(string_split(body, {NL}), lambda x: trim(x, ' ')), lambda x: x <> '') AS l FROM markdown), a AS (SELECT md_id, l, list_min(list_filter(range(1, len(l) + 1), lambda i: len(regexp_split_to_array(l[i], '\\s+')) >= 20)) AS a FROM l),
        h AS (SELECT md_id, l[a:] AS rest, l[1:a - 1] AS head FROM a WHERE a > 1), d AS (SELECT md_id, list_filter({once('head')}, lambda x: NOT list_contains(rest, x)) AS d FROM h) SELECT md_id, (generate_subscripts(d, 1) - 1)::INTEGER AS k, unnest(d) AS line FROM d""",
    "fts_analyzer": f"SELECT regexp_replace(term, '^(.{{3,}}?)(?:{_STEM})$', '\\1') AS stem, count(*) AS n FROM (SELECT unnest({words('text')}) AS term FROM documents WHERE text IS NOT NULL) GROUP BY 1",
    "fts_highlight": "SELECT doc_id, regexp_replace(regexp_replace(text, '(?i)(^|[^\\p{L}\\p{M}\\p{N}_])(lumi|berger)([^\\p{L}\\p{M}\\p{N}_]|$)', '\\1**\\2**\\3', 'g'), '(?i)(^|[^\\p{L}\\p{M}\\p{N}_*])(lumi|berger)([^\\p{L}\\p{M}\\p{N}_*]|$)', '\\1**\\2**\\3', 'g') AS text FROM documents WHERE regexp_matches(text, '(?i)(^|[^\\p{L}\\p{M}\\p{N}_])berger([^\\p{L}\\p{M}\\p{N}_]|$)')",
    "fts_site_search": f"{_BM.replace('FROM documents WHERE text IS NOT NULL', 'FROM documents WHERE text IS NOT NULL AND lang = ' + chr(39) + 'fr' + chr(39) + ' AND source = ' + chr(39) + 'mevar' + chr(39))}, r AS (SELECT id, {' + '.join(_SCORE.split(' + ln(')[0:1] + ['ln(' + x for x in _SCORE.split(' + ln(')[1:2]])} AS score FROM d, s WHERE tf0 > 0 AND tf1 > 0) SELECT id, round(score, 6) AS score, row_number() OVER (ORDER BY score DESC, id)::INTEGER AS rank FROM r QUALIFY rank <= 10",
    "vec_hybrid": ORACLES["q13_hybrid"].replace("0.7 * coalesce(c, 0), 5)", "0.7 * coalesce(c, 0), 6)"),
    "vec_embed": "SELECT DISTINCT sha256(text) AS content_hash, 10 AS dim FROM documents WHERE text IS NOT NULL",
    "join_jaccard_best": f"WITH l AS ({_FP} 'mevar-pdfs'), r AS ({_FP} 'mevar'), nl AS (SELECT md_id, count(*) AS n FROM l GROUP BY 1), nr AS (SELECT md_id, count(*) AS n FROM r GROUP BY 1), b AS (SELECT l.md_id AS id, r.md_id AS o, count(*) AS c FROM l JOIN r USING (item) GROUP BY 1, 2) SELECT id, o AS best, c / (nl.n + nr.n - c) AS similarity FROM b JOIN nl ON nl.md_id = id JOIN nr ON nr.md_id = o WHERE c / (nl.n + nr.n - c) >= 0.5 QUALIFY row_number() OVER (PARTITION BY id ORDER BY c / (nl.n + nr.n - c) DESC, o) = 1",
    "db_introspect": "SELECT column_name AS \"column\", CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'VARCHAR[]' THEN 'array<string>' WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END AS type FROM information_schema.columns WHERE table_name = 'markdown'",
    "q23_introspection": "SELECT table_name AS name, count(*)::INTEGER AS columns FROM information_schema.columns WHERE table_name IN ('markdown', 'manifest', 'cites', 'documents') GROUP BY 1",
})
assert set(ORACLES) <= set(QUERIES) and VISIBLE
