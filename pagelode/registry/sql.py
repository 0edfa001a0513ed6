"""SQL texts shared by the queries, in the dialect of the checking engine."""

from __future__ import annotations

from pagelode import options as O

DOMAINS = ("example.com", "example.org")
SCHEME = "(?:[A-Za-z][A-Za-z0-9+.-]*:)?"


def clean(u: str) -> str:
    return f"rtrim(split_part({u}, '#', 1), '/')"


def norm(u: str) -> str:
    bare = (f"regexp_replace(split_part(ltrim(regexp_replace(coalesce({u}, ''), '[\\t\\r\\n]', '', 'g'), ' '), '#', 1),"
            f" '^([^?]*)\\?$', '\\1')")
    scheme = f"regexp_extract({bare}, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)"
    return f"rtrim(lower({scheme}) || substr({bare}, length({scheme}) + 1), '/')"


def netloc(u: str) -> str:
    return f"lower(regexp_extract({u}, '^{SCHEME}//([^/?#]*)', 1))"


def path(u: str) -> str:
    return f"regexp_replace(regexp_extract({u}, '^{SCHEME}(?://[^/?#]*)?([^?#]*)', 1), ';[^/]*$', '')"


def last_segment(u: str) -> str:
    return f"regexp_extract({path(u)}, '([^/]*)/*$', 1)"


def any_of(text: str, parts) -> str:
    return "(" + " OR ".join(f"contains({text}, '{p}')" for p in parts) + ")"


def valid(u: str, domains=DOMAINS) -> str:
    return f"(regexp_matches(lower({u}), '^https?://') AND {any_of(netloc(u), domains)})"


def junk(u: str) -> str:
    return any_of(f"lower({u})", O.JUNK_PATTERNS)


def trusted(u: str, domains=O.TRUSTED_DOMAINS) -> str:
    return any_of(f"lower({u})", domains)


def verdict(u: str) -> str:
    low = f"lower({u})"
    ext = "|".join(O.BLOCKED_EXTENSIONS)
    return f"""CASE
      WHEN {u} IS NULL OR {u} = '' THEN 'empty'
      WHEN length({u}) > {O.MAX_URL_LENGTH} THEN 'url_length'
      WHEN contains({u}, '?') THEN 'query_params'
      WHEN regexp_matches({low}, '\\.({ext})$') THEN 'extension'
      WHEN {any_of(low, O.BLOCKED_NAMESPACES)} THEN 'namespace'
      WHEN contains({low}, '.wikipedia.org') AND NOT regexp_matches({low}, '^https?://en\\.') THEN 'non_en_wikipedia'
      WHEN regexp_matches({path(u)}, '^/wiki/[0-9]+$') THEN 'numeric_page'
      WHEN contains({low}, 'list_of') OR contains({low}, 'list%5fof') THEN 'list_page'
      WHEN contains({low}, '(disambiguation)') OR (contains({low}, 'disambiguation') AND contains({u}, '(')) THEN 'disambiguation'
      WHEN contains({low}, 'timeline') THEN 'timeline'
      WHEN length({last_segment(u)}) IN (1, 2) THEN 'low_quality'
      WHEN length({u}) - length(replace({u}, '%', '')) > 5 THEN 'low_quality'
      ELSE 'ok' END"""


def unescape(s: str) -> str:
    # The texts are cut at tags, so an entity without its semicolon stands at the end.
    for entity, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("amp", "&")):
        s = f"regexp_replace({s}, '&{entity}(;|$)', '{char}', 'g')"
    return s


def strip(s: str) -> str:
    return f"regexp_replace({s}, '^\\s+|\\s+$', '', 'g')"


def tokens(t: str) -> str:
    return f"regexp_extract_all(lower({t}), '[\\p{{L}}\\p{{N}}]+')"


def json_ascii(u: str) -> str:
    """Escapes what lies outside ASCII; the inputs here have no quotes or controls."""
    return (f"list_aggregate(list_transform(string_split({u}, ''), lambda c: "
            f"CASE WHEN unicode(c) > 126 THEN printf('\\u%04x', unicode(c)) ELSE c END), 'string_agg', '')")


def payload_key(u: str, d: str) -> str:
    return f"""'{{"url": "' || {json_ascii(u)} || '", "depth": ' || {d} || '}}'"""


# Pages as documents and link rows. The statements below are CTE lists for a WITH clause.
_VISIBLE = "regexp_replace(html, '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->|<!doctype[^>]*>', '<x>', 'g')"

DOCS = f"""docs AS (
  SELECT page_id, url,
    CASE WHEN regexp_matches(html, '(?is)<title[^>]*>.+?</title>')
      THEN {strip(unescape("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)"))} ELSE 'No Title' END AS title,
    coalesce(list_aggregate(list_filter(list_transform(string_split_regex({_VISIBLE}, '<[^>]*>'),
      lambda s: {strip(unescape('s'))}), lambda s: s <> ''), 'string_agg', ' '), '') AS content
  FROM pages)"""

HREFS = f"""hrefs AS (
  SELECT page_id, url, unnest(hs) AS href, unnest(range(1, len(hs) + 1)) AS hpos
  FROM (SELECT page_id, url, list_transform(regexp_extract_all({_VISIBLE}, '<a href="([^"]*)"', 1),
    lambda h: {unescape('h')}) AS hs FROM pages))"""

RESOLVED = "CASE WHEN href LIKE 'http%' THEN href ELSE regexp_extract(url, '^https?://[^/?#]*') || href END"


def links(domains=DOMAINS) -> str:
    return f"""{HREFS}, targets AS (
  SELECT page_id, url, hpos, {clean(RESOLVED)} AS link FROM hrefs),
links AS (
  SELECT page_id, url, link, row_number() OVER (PARTITION BY page_id ORDER BY min(hpos)) AS pos
  FROM targets WHERE {valid('link', domains)} AND NOT {junk('link')} GROUP BY page_id, url, link)"""


LINKS = links()

# A page store whose links lead to pages: one page per part, linked to the part on the next line
# of the same order.
WIKI = """edges AS (
  SELECT DISTINCT a.l_partkey AS s, b.l_partkey AS d FROM lineitem a JOIN lineitem b
    ON a.l_orderkey = b.l_orderkey AND a.l_linenumber + 1 = b.l_linenumber WHERE a.l_partkey <> b.l_partkey),
wiki_links AS (
  SELECT s, 'https://en.wikipedia.org/wiki/Part_' || s AS url, 'https://en.wikipedia.org/wiki/Part_' || d AS link, pos
  FROM (SELECT s, d, row_number() OVER (PARTITION BY s ORDER BY d) AS pos FROM edges)),
wiki_seeds AS (
  SELECT DISTINCT url, s FROM wiki_links ORDER BY s LIMIT 7)"""

# Documents as an index: pairs of documents share a URL up to the fragment, some hosts are not
# trusted.
DOC_URL = """'https://' || CASE WHEN lang IN ('en', 'fr') THEN lang || '.wikipedia.org' ELSE 'example.org' END
    || '/wiki/Doc_' || (doc_id // 2) || '#' || (doc_id % 2)"""
SEARCH_DOCS = f"""sdocs AS (
  SELECT doc_id, {DOC_URL} AS url,
    split_part(text, chr(10), 1) AS title, text AS content FROM documents)"""

POSTINGS = f"""{SEARCH_DOCS}, toks AS (
  SELECT url, 'title' AS field, {tokens('title')} AS ts FROM sdocs UNION ALL
  SELECT url, 'content', {tokens('content')} FROM sdocs),
post AS (
  SELECT url, field, term, count(*) AS tf, any_value(dl) AS dl
  FROM (SELECT url, field, len(ts) AS dl, unnest(ts) AS term FROM toks) GROUP BY url, field, term),
stats AS (
  SELECT field, count(*) AS n_docs, sum(len(ts))::BIGINT AS n_tokens FROM toks WHERE len(ts) > 0 GROUP BY field),
vocab AS (
  SELECT field, term, count(*) AS df, sum(tf)::BIGINT AS total_tf FROM post GROUP BY field, term)"""

# Queries from the vocabulary by rank: as they are, with a swap, a loss, a change, and in pairs.
QUERIES = f"""{POSTINGS}, picked AS (
  SELECT term, row_number() OVER (ORDER BY df DESC, term) AS r FROM vocab
  WHERE field = 'content' AND length(term) BETWEEN 4 AND 12 ORDER BY df DESC, term LIMIT 11),
sq AS (
  SELECT r * 10 AS query_id, term AS q FROM picked WHERE r <= 10 UNION ALL
  SELECT r * 10 + 1, substr(term, 2, 1) || substr(term, 1, 1) || substr(term, 3) FROM picked WHERE r <= 10 UNION ALL
  SELECT r * 10 + 2, substr(term, 1, 2) || substr(term, 4) FROM picked WHERE r <= 10 UNION ALL
  SELECT r * 10 + 3, substr(term, 1, 1) || 'q' || substr(term, 3) FROM picked WHERE r <= 10 UNION ALL
  SELECT a.r * 10 + 4, a.term || ' ' || b.term FROM picked a JOIN picked b ON b.r = a.r + 1 UNION ALL
  SELECT 1, '  ' UNION ALL SELECT 2, 'of' UNION ALL SELECT 3, 'zzzzqqqqxxxx'),
qt AS (
  SELECT query_id, qterm, count(*) AS qtf FROM (SELECT query_id, unnest({tokens('q')}) AS qterm FROM sq)
  GROUP BY query_id, qterm)"""


def one_byte(s: str) -> str:
    """The edit distance used for checking counts bytes, so letters outside ASCII are mapped to
    capitals, which no token has."""
    return f"translate({s}, 'ñêçíäèéßöüóáúàâîôûïëìòùãõåæøœ', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ[]^')"


def letters(s: str) -> str:
    """A bit per letter that occurs. An edit takes one letter away and brings one in at most."""
    return f"list_aggregate(list_transform(string_split({s}, ''), lambda c: 1::BIGINT << (unicode(c) % 60)), 'bit_or')"


def swapped_apart(s: str, l: str) -> str:
    """Whether `l` is `s` with two neighbours swapped and a new letter between them. The distance used
    for checking calls that two edits, but it edits a text twice; without that it is three."""
    def at(text, k):
        return f"substr({text}, p + {k}, 1)"
    return (f"list_bool_or(list_transform(range(0, length({s}) - 1), lambda p: substr({s}, 1, p) = substr({l}, 1, p) "
            f"AND {at(s, 1)} = {at(l, 3)} AND {at(s, 2)} = {at(l, 1)} AND {at(s, 1)} <> {at(s, 2)} "
            f"AND {at(l, 2)} <> {at(s, 1)} AND {at(l, 2)} <> {at(s, 2)} AND substr({s}, p + 3) = substr({l}, p + 4)))")


EXPANDED = f"""{QUERIES}, words AS (
  SELECT term, length(term) AS n, {one_byte('term')} AS t, {letters('term')} AS m FROM (SELECT DISTINCT term FROM vocab)),
asked AS (
  SELECT qterm, length(qterm) AS qn, CASE WHEN length(qterm) <= 2 THEN 0 WHEN length(qterm) <= 5 THEN 1 ELSE 2 END AS most,
    {one_byte('qterm')} AS q, {letters('qterm')} AS qm FROM (SELECT DISTINCT qterm FROM qt)),
near AS (
  SELECT qterm, term, n, qn, most, t, q, damerau_levenshtein(t, q) AS plain
  FROM asked JOIN words ON abs(n - qn) <= most AND bit_count(xor(m, qm)) <= 2 * most WHERE term <> qterm),
measured AS (
  SELECT qterm, term, most, CASE WHEN plain <> 2 OR n = qn THEN plain
    WHEN n > qn AND {swapped_apart('q', 't')} THEN 3 WHEN n < qn AND {swapped_apart('t', 'q')} THEN 3 ELSE plain END AS edits
  FROM near WHERE plain <= most),
cand AS (
  SELECT field, qterm, v.term, df, edits FROM measured JOIN vocab v USING (term) WHERE edits <= most UNION ALL
  SELECT field, qterm, term, df, 0 FROM asked JOIN vocab ON term = qterm),
fuzzy AS (SELECT * FROM cand),
expanded AS (
  SELECT field, qterm, term, df, edits, weight, max(df) OVER (PARTITION BY field, qterm) AS shared_df FROM (
    SELECT *, row_number() OVER (PARTITION BY field, qterm ORDER BY edits, weight DESC, term) AS place FROM (
      SELECT *, 1.0::DOUBLE - edits / least(length(term), length(qterm))::DOUBLE AS weight FROM fuzzy)
    WHERE weight > 0)
  WHERE place <= 50)"""

HITS = f"""{EXPANDED}, hits AS (
  SELECT query_id, qterm, qtf, e.field, e.term, weight, shared_df, url, tf, dl
  FROM expanded e JOIN qt USING (qterm) JOIN post p ON p.field = e.field AND p.term = e.term)"""

SCORES = f"""{HITS}, scores AS (
  SELECT query_id, url, round(greatest(2.0::DOUBLE * sum(CASE WHEN field = 'title' THEN part ELSE 0 END),
    sum(CASE WHEN field = 'content' THEN part ELSE 0 END)), 6) AS score
  FROM (SELECT h.*, 2.2::DOUBLE * qtf * weight * ln(1.0::DOUBLE + (n_docs - shared_df + 0.5::DOUBLE) / (shared_df + 0.5::DOUBLE))
      * tf / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / (n_tokens::DOUBLE / n_docs))) AS part
    FROM hits h JOIN stats USING (field)) GROUP BY query_id, url),
ranked AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, url) AS rank FROM scores)
  WHERE rank <= 50)"""

DEDUPED = f"""{SCORES}, trusted AS (
  SELECT query_id, split_part(url, '#', 1) AS url, url AS doc_url, score, rank FROM ranked
  WHERE {trusted("split_part(url, '#', 1)")}),
deduped AS (
  SELECT query_id, url, arg_min(doc_url, rank) AS doc_url, arg_min(score, rank) AS score, min(rank) AS rank
  FROM trusted GROUP BY query_id, url),
top AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS position FROM deduped)
  WHERE position <= 10)"""
