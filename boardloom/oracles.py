"""DuckDB SQL that computes the core queries independently, from the same tables."""

from __future__ import annotations

from boardloom.functions.dates import ANNOUNCED, MONTHS, SPAN
from boardloom.functions.rules import EXPERTS
from boardloom.functions.text import LISTING_NOISE, LISTING_PATH, LISTING_WORDS, NOISE_PAGE, SNIPPET_WORDS
from boardloom.functions.urls import NOISE_PARAMETERS
from boardloom.operators.enrichment import READ_FIRST, READ_LAST
from boardloom.operators.listing import LABELS

#: Day and times (microseconds) that the queries take as today, now and the start of a batch.
AS_OF, NOW, CUT = "2026-04-20", 1780272000000000, 1769904000000000


def q(s: str) -> str:
    """A string as an SQL literal."""
    return "'" + s.replace("'", "''") + "'"


def _strip(c: str) -> str:
    return rf"regexp_replace(coalesce({c}, ''), '^[\s\x{{00A0}}\x{{2000}}-\x{{200A}}\x{{202F}}\x{{3000}}]+|[\s\x{{00A0}}\x{{2000}}-\x{{200A}}\x{{202F}}\x{{3000}}]+$', '', 'g')"


def _collapse(c: str) -> str:
    return _strip(rf"regexp_replace(coalesce({c}, ''), '[\s\x{{00A0}}\x{{2000}}-\x{{200A}}\x{{202F}}\x{{3000}}]+', ' ', 'g')")


def _scheme(u: str) -> str:
    return f"lower(regexp_extract({u}, '^([A-Za-z][A-Za-z0-9+.-]*):', 1))"


def _netloc(u: str) -> str:
    return f"regexp_extract({u}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1)"


def _path(u: str) -> str:
    return f"regexp_extract({u}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"


def _no_www(h: str) -> str:
    return f"regexp_replace({h}, '^www[.]', '')"


def _open_path(u: str) -> str:
    return f"regexp_replace({_path(u)}, '/+$', '')"


def _compare_key(u: str) -> str:
    low = f"lower({_strip(u)})"
    return f"({_no_www(_netloc(low))} || {_open_path(low)})"


def _site_key(u: str) -> str:
    full = f"(CASE WHEN contains({u}, '://') THEN {u} ELSE 'http://' || {u} END)"
    host = f"regexp_replace(regexp_replace(lower({_netloc(full)}), '^.*@', ''), ':.*$', '')"
    return f"({_no_www(host)} || lower({_open_path(full)}))"


def _normal(u: str) -> str:
    t = _strip(u)
    noise = ", ".join(map(q, NOISE_PARAMETERS))
    pairs = f"list_transform(string_split(regexp_extract({t}, '^[^?#]*[?]([^#]*)', 1), '&'), lambda p: {{'k': url_decode(replace(split_part(p, '=', 1), '+', ' ')), 'v': url_decode(replace(regexp_extract(p, '^[^=]*=(.*)$', 1), '+', ' '))}})"
    kept = f"list_sort(list_filter({pairs}, lambda p: p.v <> '' AND lower(p.k) NOT IN ({noise})))"
    query = f"array_to_string(list_transform({kept}, lambda p: replace(url_encode(p.k), '%20', '+') || '=' || replace(url_encode(p.v), '%20', '+')), '&')"
    return f"(CASE WHEN {_scheme(t)} <> '' THEN {_scheme(t)} || ':' ELSE '' END || CASE WHEN {_netloc(t)} <> '' THEN '//' || lower({_netloc(t)}) ELSE '' END || {_open_path(t)} || CASE WHEN {query} <> '' THEN '?' || {query} ELSE '' END)"


#: Compatibility forms that strip_accents leaves; enough for the characters of the tables.
_COMPAT = (("…", "..."), (" ", " "), (" ", " "), ("ª", "a"), ("º", "o"), ("™", "TM"), ("½", "1⁄2"), ("¼", "1⁄4"), ("¾", "3⁄4"), ("²", "2"), ("³", "3"), ("¹", "1"), ("´", " "), ("¨", " "), ("˜", " "), ("¯", " "), ("¸", " "), ("ﬁ", "fi"), ("ﬂ", "fl"), (" ", " "), ("　", " "), (" ", " "), (" ", " "), ("µ", "μ"))


def _plain(c: str) -> str:
    t = f"coalesce({c}, '')"
    for a, b in _COMPAT:
        t = f"replace({t}, {q(a)}, {q(b)})"
    t = f"lower(strip_accents({t}))"
    return rf"trim(regexp_replace(regexp_replace({t}, '-\s*\n\s*', '', 'g'), '\s+', ' ', 'g'))"


def _scored(head: str, hay: str, pack=EXPERTS) -> tuple[str, str, str, str, str, str]:
    """score, strong, title_hit, category, veto and trace as SQL over the columns head and hay."""
    m = lambda t, p: f"regexp_matches({t}, {q(p)})"
    total, trace, title = [], [], []
    for patterns, (a, b) in ((pack.strong, pack.strong_weight), (pack.medium, pack.medium_weight)):
        for p in patterns:
            total += [f"CASE WHEN {m(hay, p)} THEN {a} ELSE 0.0 END", f"CASE WHEN {m(hay, p)} AND {m(head, p)} THEN {b} ELSE 0.0 END"]
            trace.append(f"CASE WHEN {m(hay, p)} THEN {q(p)} END")
            title.append(f"({m(hay, p)} AND {m(head, p)})")
    weak = " + ".join(f"{m(hay, p)}::INT" for p in pack.weak)
    guards = [f"CASE WHEN {m(hay, p)} THEN {pack.guard_weight} ELSE 0.0 END" for p in pack.guards]
    trace += [f"CASE WHEN {m(hay, p)} THEN {q('-' + p)} END" for p in pack.guards]
    score = "0.0::DOUBLE" + "".join(f" + ({t})::DOUBLE" for t in total) + f" + least({weak}, {pack.weak_weight[1]}) * {pack.weak_weight[0]}::DOUBLE" + "".join(f" - ({g})::DOUBLE" for g in guards)
    category = "CASE " + " ".join(f"WHEN {' OR '.join(m(hay, p) for p in ps)} THEN {q(n)}" for n, ps in pack.categories) + f" ELSE {q(pack.otherwise)} END"
    veto = "CASE " + " ".join(f"WHEN {m(hay, p)} THEN {q(p)}" for p in pack.vetoes) + " END"
    strong = "(" + " OR ".join(m(hay, p) for p in pack.strong) + ")"
    return f"greatest(0.0, least({score}, 1.0))", strong, "(" + " OR ".join(title) + ")", category, veto, f"list_filter([{', '.join(trace)}], lambda x: x IS NOT NULL)"


def _classify(table: str, key: str, text: str, title: str, rest: str) -> str:
    score, strong, hit, category, veto, trace = _scored("head", "hay")
    return f"""
    WITH n AS (SELECT {key}, {_plain(title)} AS head, {_plain(text)} AS body FROM {table}),
    h AS (SELECT {key}, head, head || ' ' || body AS hay FROM n),
    t AS (SELECT {key}, {score} AS raw, {strong} AS strong, {hit} AS title_hit, {category} AS category, {veto} AS veto, {trace} AS trace FROM h)
    {rest}"""


def _deadline() -> str:
    """Windows by position: the pieces between announcements give where each ends."""
    kw = q("(?i)" + ANNOUNCED)
    month = "CASE lower(n) " + " ".join(f"WHEN '{m}' THEN {i + 1}" for i, m in enumerate(MONTHS)) + " END"
    date = rf"(?i)\b(\d{{1,2}})(?:[/.\-](\d{{1,2}})[/.\-]|\s+({'|'.join(MONTHS)})\s+)(\d{{4}})\b"
    return f"""
    WITH k AS (SELECT doc_id, text, regexp_extract_all(text, {kw}) AS kws, string_split_regex(text, {kw}) AS parts FROM documents),
    w AS (SELECT doc_id, unnest(range(1, len(kws) + 1)) AS i, text, kws, parts FROM k WHERE len(kws) > 0),
    p AS (SELECT doc_id, i, substr(text, (list_sum(list_transform(parts[1:i], lambda x: length(x))) + list_sum(list_transform(kws[1:i], lambda x: length(x))) + 1)::BIGINT, {SPAN}) AS win FROM w),
    d AS (SELECT doc_id, i, unnest(range(1, len(regexp_extract_all(win, {q(date)})) + 1)) AS j, win FROM p),
    e AS (SELECT doc_id, i, j, regexp_extract_all(win, {q(date)}, 1)[j] AS dd, regexp_extract_all(win, {q(date)}, 2)[j] AS m, regexp_extract_all(win, {q(date)}, 3)[j] AS n, regexp_extract_all(win, {q(date)}, 4)[j] AS y FROM d),
    v AS (SELECT doc_id, i, j, try_strptime(y || '-' || CASE WHEN m <> '' THEN m ELSE ({month})::VARCHAR END || '-' || dd, '%Y-%m-%d')::DATE AS day FROM e),
    f AS (SELECT doc_id, i, arg_min(day, j) AS day FROM v WHERE day IS NOT NULL GROUP BY ALL),
    best AS (SELECT doc_id, max(day) AS scadenza FROM f GROUP BY doc_id)
    SELECT t.doc_id, scadenza FROM documents t LEFT JOIN best USING (doc_id)"""


def _changes() -> str:
    def one(tab: str, key: str, version: str, compared: str) -> str:
        return f"""
        SELECT '{tab}' AS tab, strftime(day, '%Y-%m-%d') AS snapshot_date, rec_key, change FROM (
            WITH r AS (SELECT snapshot_date AS day, {key} AS k, {version} AS v, {compared} AS c FROM {tab}),
            l AS (SELECT day, k, arg_max(c, (v, c)) AS c FROM (SELECT day, k, coalesce(v, TIMESTAMPTZ '1900-01-01 00:00:00+00') AS v, c FROM r) GROUP BY day, k),
            days AS (SELECT day, lead(day) OVER (ORDER BY day) AS next FROM (SELECT DISTINCT day FROM r)),
            a AS (SELECT next AS day, k, c FROM l JOIN days USING (day) WHERE next IS NOT NULL),
            b AS (SELECT day, k, c FROM l WHERE day > (SELECT min(day) FROM days))
            SELECT coalesce(a.day, b.day) AS day, coalesce(a.k, b.k) AS rec_key,
                CASE WHEN a.k IS NULL THEN 'added' WHEN b.k IS NULL THEN 'removed' WHEN a.c IS DISTINCT FROM b.c THEN 'changed' END AS change
            FROM a FULL JOIN b ON a.day = b.day AND a.k = b.k) WHERE change IS NOT NULL"""

    return one("finding_snapshots", "lower(trim(fingerprint))", "last_seen", "last_seen") + " UNION ALL " + one("school_snapshots", "upper(trim(code))", "last_discovery", f"{_strip('trasparenza_url')}")


_PCT = "CASE WHEN count(*) = 0 THEN 0.0 ELSE round(100.0::DOUBLE * {} / count(*), 1) END"
_REACH, _FOUND = "count(*) FILTER (WHERE reachable)", "count(*) FILTER (WHERE coalesce(trasparenza_url, '') <> '')"
_COUNTS = f"count(*) AS totale, {_REACH} AS raggiungibili, {_FOUND} AS trasparenza"
_PCTS = f"{_PCT.format(_REACH)} AS raggiungibili_pct, {_PCT.format(_FOUND)} AS trasparenza_pct"
_REJECTED, _UNREADABLE = "(ai_bando IS NOT NULL AND NOT ai_bando)", "(ai_checked IS NOT NULL AND ai_bando IS NULL)"
_STATUS = f"CASE WHEN scadenza IS NULL THEN 'ignota' WHEN scadenza >= DATE '{AS_OF}' THEN 'aperto' ELSE 'scaduto' END"
_SHOWN = f"(SELECT *, {_STATUS} AS stato FROM findings WHERE NOT {_REJECTED} AND NOT {_UNREADABLE})"
_LABEL = "CASE category " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in LABELS.items()) + " ELSE category END"
_FIELD = f"coalesce(nullif(profilo, ''), nullif({_LABEL}, ''), '—')"
_TITLE = f"coalesce(nullif(titolo_pulito, ''), nullif({_collapse('title')}, ''), '(senza titolo)')"


def _escape(c: str) -> str:
    t = f"coalesce({c}, '')"
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        t = f"replace({t}, {q(a)}, {q(b)})"
    return t


def _title_case(c: str) -> str:
    return f"array_to_string(list_transform(regexp_extract_all(lower(coalesce({c}, '')), '[A-Za-z0-9_]+|[^A-Za-z0-9_]+'), lambda p: upper(p[1]) || p[2:]), '')"


def _side(origin: str) -> str:
    return f"(SELECT DISTINCT {_compare_key('url')} AS key FROM findings WHERE origin = '{origin}' AND coalesce(url, '') <> '')"


def _one(table: str, key: str, order: str, columns: str, where: str = "TRUE") -> str:
    return f"(SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {table} WHERE {where}) WHERE rn = 1)"


def _snippet(c: str) -> str:
    arms = " ".join(f"WHEN instr(lower({c}), {q(w)}) > 0 THEN {_strip(f'substr({c}, greatest(instr(lower({c}), {q(w)}) - 90, 1), instr(lower({c}), {q(w)}) + 170 - greatest(instr(lower({c}), {q(w)}) - 90, 1))')}" for w in SNIPPET_WORDS)
    return f"CASE {arms} ELSE substr({c}, 1, 300) END"


def _visible(c: str) -> str:
    bare = rf"regexp_replace(coalesce({c}, ''), '(?is)<script\b.*?</script>|<style\b.*?</style>', ' ', 'g')"
    return _collapse(f"regexp_replace({bare}, '<[^>]+>', ' ', 'g')")


_HTML = f"""('<html><head><script>var a = ''<a href="/no">no</a>'';</script></head><body>' || chr(10) || '<A class="x" HREF="' || {_strip("url")} || '">' || title || '</a> <a href=''/albo/' || row_id || '#top''>Albo  <b>online</b></a></body></html>')"""


def oracle_sql() -> dict[str, str]:
    """SQL by query name."""
    sql: dict[str, str] = {}
    sql["p5_found"] = _changes()
    typed = "[site_url, upper(site_url), replace(site_url, '://', '//'), replace(site_url, '://', ':/'), 'https://' || replace(site_url, '://', '//'), ' ' || replace(site_url, 'https://www.', 'www. ') || '.,', site_url || '/A B', 'Non Disponibile', '-', '//']"
    sql["url_clean"] = rf"""
    WITH v AS (SELECT code, unnest(range(1, 11)) AS i, {typed} AS ts FROM schools),
    t AS (SELECT code, (i - 1)::INT AS n, {_strip("ts[i]")} AS typed FROM v),
    a AS (SELECT *, regexp_replace(replace(typed, ' ', ''), '(?i)^https?://(https?[:/])', '\1') AS u FROM t),
    b AS (SELECT code, n, typed, regexp_replace(u, '(?i)^(https?)//', '\1://') AS u FROM a),
    c AS (SELECT code, n, typed, regexp_replace(u, '(?i)^(https?):/([^/]|$)', '\1://\2') AS u FROM b),
    d AS (SELECT code, n, typed, CASE WHEN regexp_matches(u, '(?i)^https?://') THEN u ELSE 'https://' || u END AS u FROM c)
    SELECT code, n, CASE WHEN typed = '' OR upper(typed) IN ('NON DISPONIBILE', 'N.D.', 'ND', '-', '//') THEN ''
      WHEN regexp_matches(u, '(?i)^https?://[^/]+') THEN lower(regexp_extract(u, '(?i)^(https?://)', 1)) || regexp_replace(lower(regexp_extract(u, '(?i)^https?://([^/]+)', 1)), '[.,;]+$', '') || regexp_extract(u, '(?i)^https?://[^/]+(.*)$', 1)
      ELSE u END AS clean FROM d"""
    sql["url_forms"] = rf"""
    SELECT row_id, {_normal("url")} AS normal, {_compare_key("url")} AS compared, {_site_key("url")} AS site,
      regexp_replace(regexp_replace(url, '(?s)#.*$', ''), '/+$', '') AS page,
      CASE WHEN {_scheme(_strip("url"))} = '' THEN 'https' ELSE {_scheme(_strip("url"))} END || '://' || {_netloc(_strip("url"))} AS root,
      lower(regexp_replace(url, '(?s)[?#].*$', '')) LIKE '%.pdf' AS pdf,
      CASE WHEN regexp_matches(coalesce(doc_url, ''), '(?i)^https?://') THEN doc_url ELSE '#' END AS safe FROM findings"""
    sql["url_fingerprints"] = f"SELECT row_id, substr(sha256({_normal('url')} || '|' || coalesce(title, '')), 1, 32) AS fingerprint FROM findings"
    toggled = lambda n: f"(CASE WHEN starts_with(lower({n}), 'www.') THEN substr({n}, 5) ELSE 'www.' || {n} END)"
    sql["url_fallbacks"] = f"""
    WITH a AS (SELECT code, unnest([site_url, replace(site_url, '.edu.example', '.gov.it')]) AS asked FROM schools WHERE site_url IS NOT NULL),
    p AS (SELECT code, asked, {_scheme("asked")} AS s, {_netloc("asked")} AS n, CASE WHEN {_path("asked")} = '' THEN '/' ELSE {_path("asked")} END AS path FROM a),
    o AS (SELECT *, CASE WHEN s = 'https' THEN 'http' ELSE 'https' END AS o, substr(n, 1, length(n) - 7) || '.edu.it' AS moved, lower(n) LIKE '%.gov.it' AS gov FROM p),
    c AS (SELECT code, asked, unnest(range(1, 7)) AS i, [CASE WHEN gov THEN s || '://' || moved || path END, CASE WHEN gov THEN o || '://' || moved || path END, CASE WHEN gov THEN s || '://' || {toggled("moved")} || path END,
      o || '://' || n || path, s || '://' || {toggled("n")} || path, o || '://' || {toggled("n")} || path] AS us FROM o),
    f AS (SELECT code, asked, us[i] AS url, min(i) AS i FROM c WHERE us[i] IS NOT NULL AND us[i] <> asked GROUP BY ALL)
    SELECT code, asked, (row_number() OVER (PARTITION BY code, asked ORDER BY i) - 1)::INT AS place, url FROM f"""
    base = "{'r': regexp_extract(trasparenza_url, '^([a-z]+://[^/]+)', 1), 'p': regexp_extract(trasparenza_url, '^[a-z]+://[^/]+([^?#]*)', 1)}"
    folder = "regexp_replace(b.p, '[^/]*$', '')"
    up = f"regexp_replace({folder}, '[^/]*/$', '')"
    sql["url_joined"] = f"""
    WITH t AS (SELECT code, trasparenza_url AS u, {base} AS b FROM schools WHERE trasparenza_url <> ''),
    j AS (SELECT code, unnest(range(0, 8))::INT AS n, [b.r || '/albo/x?a=1#b', b.r || CASE WHEN {up} = '' THEN '/' ELSE {up} END || 'y', b.r || {folder} || 'z.html', b.r || b.p || '?q=2', regexp_replace(u, '#.*$', '') || '#top', 'https://other.example/p', 'https://else.example/', b.r || {folder} || 'v'] AS us FROM t)
    SELECT code, n, us[n + 1] AS url FROM j"""
    sql["text_forms"] = rf"SELECT row_id, {_plain('title')} AS normal, trim(regexp_replace(lower(coalesce(title, '')), '[^\p{{L}}\p{{M}}\p{{Nd}}\p{{Pc}}]+', ' ', 'g')) AS words, {_title_case('province')} AS place, {_escape('title')} AS safe FROM findings"
    sql["text_documents"] = f"""
    WITH v AS (SELECT doc_id, {_visible("text")} AS body FROM documents)
    SELECT doc_id, length(body) < 120 OR regexp_matches(substr(body, 1, 1500), {q(NOISE_PAGE)}) AS noise, {_snippet("body")} AS snippet FROM v"""
    sql["page_links"] = f"""
    SELECT row_id, 0 AS pos, {_strip("url")} AS href, {_collapse("regexp_replace(title, '<[^>]+>', ' ', 'g')")} AS text FROM findings
    UNION ALL SELECT row_id, 1 AS pos, 'https://www.base.example/albo/' || row_id || '#top' AS href, 'Albo online' AS text FROM findings"""
    marks = "lower(url || coalesce(source_page, ''))"
    sql["page_texts"] = f"""
    SELECT row_id, {_visible(_HTML)} AS text, CASE WHEN regexp_matches({marks}, 'wp-content|wp-includes') THEN CASE WHEN regexp_matches({marks}, 'amministrazione-trasparente|trasparenza') THEN 'agid_wordpress' ELSE 'wordpress_generic' END
      WHEN regexp_matches({marks}, 'argosoft|scuolanext') THEN 'argo_software' WHEN regexp_matches({marks}, 'madisoft|nuvola') THEN 'madisoft'
      WHEN regexp_matches({marks}, 'spaggiari|scuola&territorio|scuola e territorio') THEN 'spaggiari' WHEN contains({marks}, 'axios') THEN 'axios' ELSE 'generic' END AS platform FROM findings"""
    sql["link_ranks"] = f"""
    WITH r AS (SELECT school_code, row_id, CASE WHEN regexp_matches({_path("url")}, {q(LISTING_PATH)}) THEN 2 ELSE 0 END - CASE WHEN regexp_matches(title, {q(LISTING_NOISE)}) THEN 2 ELSE 0 END AS rank,
      CASE WHEN regexp_matches(title, {q(READ_FIRST)}) THEN 1 ELSE 0 END - CASE WHEN regexp_matches(title, {q(READ_LAST)}) THEN 1 ELSE 0 END AS doc_rank
      FROM findings WHERE regexp_matches(lower(title || ' ' || url), {q("|".join(LISTING_WORDS))}))
    SELECT school_code, row_id, rank::INT AS rank, doc_rank::INT AS doc_rank, place::INT AS place FROM (SELECT *, row_number() OVER (PARTITION BY school_code ORDER BY rank DESC, row_id) AS place FROM r) WHERE place <= 3"""
    sql["classify_titles"] = _classify("findings", "row_id", "title", "title", "SELECT row_id, round(raw, 3) AS score, category, raw >= 0.45 AND veto IS NULL AS is_match, title_hit, array_to_string(CASE WHEN veto IS NULL THEN trace ELSE list_append(trace, 'VETO:' || veto) END, ' ;; ') AS signals FROM t")
    sql["classify_bodies"] = _classify("documents", "doc_id", "text", "''", "SELECT doc_id, round(raw, 3) AS score, category, raw >= 0.70 AND strong AS is_match FROM t")
    sql["category_counts"] = _classify("findings", "row_id", "title", "title", "SELECT category, count(*) AS n, count(*) FILTER (WHERE raw >= 0.45 AND veto IS NULL) AS matches FROM t GROUP BY category")
    sql["deadlines"] = _deadline()
    sql["deadline_status"] = f"SELECT {_STATUS} AS stato, count(*) AS n FROM findings GROUP BY 1"
    sql["notice_pages"] = "SELECT code, name, region, province, trasparenza_url FROM schools WHERE trasparenza_url <> ''"
    sql["sites_to_visit"] = "SELECT code, site_url FROM schools WHERE site_url <> ''"
    sql["schools_sorted"] = "SELECT region, province, code, name FROM schools ORDER BY region NULLS FIRST, province NULLS FIRST, code"
    sql["findings_newest"] = "SELECT row_id, fingerprint, epoch_us(first_seen)::VARCHAR AS first_seen FROM findings"
    for name, marker, most in (("pending_deadlines", "scadenza_checked", "LIMIT 500"), ("pending_reviews", "ai_checked", "")):
        sql[name] = f"SELECT fingerprint, epoch_us(first_seen)::VARCHAR AS first_seen FROM {_one('findings', 'fingerprint', 'row_id', '*')} WHERE {marker} IS NULL ORDER BY findings_first DESC, fingerprint {most}".replace("findings_first", "first_seen")
    for name, marker, most in (("pending_deadlines_all", "scadenza_checked", ""), ("pending_reviews_run", "ai_checked", "LIMIT 400")):
        sql[name] = f"SELECT fingerprint, epoch_us(first_seen)::VARCHAR AS first_seen FROM {_one('findings', 'fingerprint', 'row_id', '*')} WHERE {marker} IS NULL ORDER BY first_seen DESC, fingerprint {most}"
    sql["registry_prefer_site"] = f"""
    SELECT school_code, row_id AS chosen, doc_url, pos FROM {_one("findings", "school_code", "(coalesce(doc_url, '') = ''), row_id", "*")} JOIN (SELECT school_code, min(row_id) AS pos FROM findings GROUP BY school_code) USING (school_code)"""
    sql["registry_regions"] = f"SELECT code, name, region, {_strip('province')} AS province, {_strip('city')} AS city, coalesce(site_url, '') AS website FROM (SELECT code, {_strip('name')} AS name, upper(region) AS region, province, city, site_url FROM schools) WHERE region IN ('LOMBARDIA', 'VENETO')"
    sites = f"(SELECT *, {_site_key('site_url')} AS site FROM schools WHERE site_url IS NOT NULL)"
    sql["sites_first"] = f"SELECT site, code, site_url FROM {_one(sites, 'site', 'code', '*', 'site <> ' + q(''))}"
    sql["pages_lowest_code"] = f"SELECT trasparenza_url AS page, code, region FROM {_one('schools', 'trasparenza_url', 'code', '*', 'trasparenza_url <> ' + q(''))}"
    sql["siblings"] = f"SELECT a.code, site, b.code AS first_code, b.platform AS found_platform FROM {sites} a JOIN {_one(sites, 'site', 'code', 'site, code, platform')} b USING (site)"
    sql["top_scores"] = "SELECT school_code, row_id, score, place::INT AS place FROM (SELECT school_code, row_id, score, row_number() OVER (PARTITION BY school_code ORDER BY score DESC, row_id) AS place FROM findings) WHERE place <= 3"
    sql["best_hits"] = f"""
    WITH e AS (SELECT school_code AS code, {_compare_key("url")} AS url, row_id, CASE WHEN row_id % 3 = 0 THEN 'page' ELSE 'anchor' END AS kind, round(score, 1) AS score FROM findings),
    a AS (SELECT *, row_number() OVER (PARTITION BY code, url ORDER BY row_id) AS n FROM e),
    b AS (SELECT *, row_number() OVER (PARTITION BY code, url ORDER BY score DESC, row_id) AS m FROM a WHERE kind = 'anchor' OR n = 1)
    SELECT code, url, row_id::VARCHAR AS title, score, kind FROM b WHERE m = 1"""
    old = _one("findings", "fingerprint", "row_id", "*", f"epoch_us(first_seen) < {CUT}")
    new = _one("findings", "fingerprint", "row_id", "*", f"epoch_us(first_seen) >= {CUT}")
    sql["upsert_findings"] = f"""
    SELECT coalesce(o.fingerprint, n.fingerprint) AS fingerprint, coalesce(o.row_id, n.row_id) AS row_id, CASE WHEN o.fingerprint IS NULL THEN n.score ELSE o.score END AS score,
      (CASE WHEN o.fingerprint IS NULL THEN {NOW} ELSE epoch_us(o.first_seen) END)::VARCHAR AS first_seen, (CASE WHEN n.fingerprint IS NULL THEN epoch_us(o.last_seen) ELSE {NOW} END)::VARCHAR AS last_seen,
      CASE WHEN o.fingerprint IS NULL THEN coalesce(n.origin, 'nuovo') ELSE o.origin END AS origin, o.fingerprint IS NULL AS is_new FROM {old} o FULL JOIN {new} n ON o.fingerprint = n.fingerprint"""
    sql["insert_only"] = f"SELECT DISTINCT fingerprint FROM findings WHERE epoch_us(first_seen) >= {CUT} AND fingerprint NOT IN (SELECT fingerprint FROM findings WHERE epoch_us(first_seen) < {CUT})"
    sql["touch_only"] = f"SELECT DISTINCT fingerprint FROM findings WHERE epoch_us(first_seen) < {CUT} AND fingerprint IN (SELECT fingerprint FROM findings WHERE epoch_us(first_seen) >= {CUT})"
    sql["upsert_schools"] = """
    SELECT code, CASE WHEN region = 'LOMBARDIA' THEN upper(name) ELSE name END AS name, region, CASE WHEN region = 'LOMBARDIA' THEN 'https://new.example' ELSE site_url END AS site_url, platform, coalesce(reachable, FALSE) AS reachable FROM schools
    UNION ALL SELECT 'N' || code, name, region, site_url, NULL, FALSE FROM schools WHERE region = 'VENETO'"""
    sql["record_discovery"] = f"""
    WITH f AS (SELECT upper(trim(code, ' ')) AS k, max(trasparenza_url) AS t, max(platform) AS p, bool_or(reachable) AS r FROM school_snapshots WHERE snapshot_date = (SELECT max(snapshot_date) FROM school_snapshots) GROUP BY 1)
    SELECT code, CASE WHEN k IS NULL THEN platform ELSE p END AS platform, CASE WHEN k IS NULL THEN trasparenza_url ELSE t END AS trasparenza_url, CASE WHEN k IS NULL THEN reachable ELSE r END AS reachable,
      CASE WHEN k IS NULL THEN resolved_url END AS resolved_url, CASE WHEN k IS NULL THEN discovery_note ELSE 'ok' END AS discovery_note, (CASE WHEN k IS NULL THEN epoch_us(last_discovery) ELSE {NOW} END)::VARCHAR AS last_discovery FROM schools LEFT JOIN f ON code = k"""
    sql["mark_crawled"] = f"SELECT code, coalesce(epoch_us(first_crawled), CASE WHEN code IN (SELECT school_code FROM findings) THEN {NOW} END)::VARCHAR AS first_crawled FROM schools"
    verdicts = "(SELECT lower(trim(fingerprint, ' ')) AS k, bool_and(ai_bando) AS b, max(CASE WHEN stato <> 'scaduto' THEN scadenza END) AS s, min(category) AS c FROM finding_snapshots GROUP BY 1)"
    sql["set_reviews"] = f"""
    SELECT row_id, CASE WHEN k IS NULL THEN ai_bando ELSE b END AS ai_bando, CASE WHEN k IS NULL THEN scadenza ELSE s END AS scadenza, (CASE WHEN k IS NULL THEN epoch_us(ai_checked) ELSE {NOW} END)::VARCHAR AS ai_checked,
      CASE WHEN k IS NULL THEN titolo_pulito END AS titolo_pulito, CASE WHEN k IS NULL THEN profilo ELSE nullif(c, '') END AS profilo, CASE WHEN k IS NULL THEN doc_url ELSE 'https://doc.example' END AS doc_url FROM findings LEFT JOIN {verdicts} ON fingerprint = k"""
    sql["set_deadlines"] = f"SELECT row_id, CASE WHEN k IS NULL THEN scadenza ELSE s END AS scadenza, (CASE WHEN k IS NULL THEN epoch_us(scadenza_checked) ELSE {NOW} END)::VARCHAR AS scadenza_checked FROM findings LEFT JOIN {verdicts} ON fingerprint = k"
    sql["reset_reviews"] = "SELECT count(*) FILTER (WHERE ai_checked IS NOT NULL AND NOT coalesce(ai_bando, TRUE)) AS checked, count(*) FILTER (WHERE NOT ai_bando) AS verdicts, count(*) FILTER (WHERE coalesce(ai_bando, TRUE)) AS reset FROM findings"
    sql["school_origin"] = "SELECT code, CASE WHEN first_crawled IS NULL THEN 'archivio' ELSE 'nuovo' END AS origin FROM schools"
    sql["next_run"] = f"SELECT coalesce(max(id), 0) + 1 AS id, '{NOW}' AS started_at, 'crawl' AS phase, 10::BIGINT AS processed, 3::BIGINT AS hits FROM runs"
    hidden = f"({_REJECTED} OR {_UNREADABLE})"
    sql["snapshot_meta"] = f"""
    SELECT count(*) FILTER (WHERE NOT {hidden} AND {_STATUS} = 'aperto') AS aperti, count(*) FILTER (WHERE NOT {hidden} AND {_STATUS} = 'scaduto') AS scaduti, count(*) FILTER (WHERE NOT {hidden} AND {_STATUS} = 'ignota') AS scadenza_ignota,
      count(*) FILTER (WHERE {_REJECTED}) AS esclusi_ai, count(*) FILTER (WHERE NOT {_REJECTED} AND {_UNREADABLE}) AS doc_vuoti, count(*) FILTER (WHERE coalesce(origin, 'nuovo') = 'archivio') AS da_archivio FROM findings"""
    sql["snapshot_rows"] = f"SELECT row_id, stato, nullif(titolo_pulito, '') AS titolo FROM {_SHOWN}"
    sql["listing_status"] = f"SELECT stato, count(*) AS n FROM {_SHOWN} GROUP BY stato"
    sql["listing_facets"] = f"SELECT DISTINCT 'category' AS facet, category AS value FROM {_SHOWN} WHERE category IS NOT NULL UNION ALL SELECT DISTINCT 'region', region FROM {_SHOWN} WHERE region IS NOT NULL"
    sql["listing_filtered"] = f"SELECT row_id, score FROM {_SHOWN} WHERE stato = 'ignota' AND category = 'madrelingua' AND contains(lower(concat_ws(' ', school_name, {_TITLE}, {_FIELD}, region)), 'liceo')"
    sql["listing_count"] = f"SELECT count(*) AS n, count(*)::VARCHAR || CASE count(*) WHEN 1 THEN ' bando' ELSE ' bandi' END || ' · stato: ignota' AS label FROM ({sql['listing_filtered']})"
    sql["listing_by_deadline"] = f"SELECT row_id, scadenza FROM {_SHOWN} WHERE region = 'VENETO'"
    months = "[" + ", ".join(q(m[:3]) for m in MONTHS) + "]"
    ago = f"floor(({NOW} // 1000000 - epoch_us(first_seen) // 1000000) / 86400)::BIGINT"
    sql["listing_cards"] = f"""
    SELECT row_id::VARCHAR AS row_key, stato, coalesce(origin, 'nuovo') = 'nuovo' AS is_new, {_escape(_TITLE)} AS titolo, {_escape("school_name")} AS scuola, {_escape(_title_case("province"))} AS provincia, {_escape(_FIELD)} AS ambito,
      CASE WHEN scadenza IS NULL THEN '—' ELSE strftime(scadenza, '%d') || ' ' || {months}[month(scadenza)] || ' ' || strftime(scadenza, '%Y') END AS scade, floor(coalesce(score, 0.0) * 100 + 0.5)::BIGINT AS pct,
      CASE WHEN regexp_matches(coalesce(nullif(doc_url, ''), url), '(?i)^https?://') THEN coalesce(nullif(doc_url, ''), url) ELSE '#' END AS href,
      CASE WHEN first_seen IS NULL THEN '' WHEN {ago} <= 0 THEN 'oggi' WHEN {ago} = 1 THEN 'ieri' ELSE {ago} || ' giorni fa' END AS scoperto FROM {_SHOWN}"""
    a, b = _side("nuovo"), _side("archivio")
    sql["compare_sides"] = f"SELECT key, 'both' AS side FROM ({a} INTERSECT {b}) UNION ALL SELECT key, 'left' FROM ({a} EXCEPT {b}) UNION ALL SELECT key, 'right' FROM ({b} EXCEPT {a})"
    sql["compare_summary"] = f"""
    WITH c AS (SELECT (SELECT count(*) FROM {a}) AS n_left, (SELECT count(*) FROM {b}) AS n_right, (SELECT count(*) FROM ({a} INTERSECT {b})) AS common)
    SELECT n_left, n_right, common, n_left - common AS only_left, n_right - common AS only_right, CASE WHEN n_right > 0 THEN round(100.0::DOUBLE * (n_left - common) / n_right, 0) END AS uplift_pct FROM c"""
    sql["compare_examples"] = f"SELECT key FROM ({a} EXCEPT {b}) ORDER BY key LIMIT 15"
    sql["review_replies"] = """
    SELECT row_id, coalesce(ai_bando, FALSE) AS ai_bando, scadenza, substr(trim(coalesce(titolo_pulito, ''), ' '), 1, 160) AS titolo_pulito, substr(trim(coalesce(profilo, ''), ' '), 1, 60) AS profilo FROM findings"""
    sql["report_totals"] = f"SELECT {_COUNTS}, {_PCTS} FROM schools"
    sql["report_regions"] = f"SELECT coalesce(nullif(region, ''), '?') AS region, {_COUNTS}, {_PCTS} FROM schools GROUP BY 1"
    sql["report_platforms"] = "SELECT coalesce(nullif(platform, ''), 'unknown') AS platform, count(*) AS n FROM schools WHERE reachable GROUP BY 1"
    sql["report_notes"] = "SELECT coalesce(nullif(discovery_note, ''), '?') AS note, count(*) AS n FROM schools GROUP BY 1"
    sql["report_common_notes"] = "SELECT coalesce(nullif(discovery_note, ''), '?') AS value, count(*) AS n FROM schools GROUP BY 1"
    sql["report_groupings"] = f"""
    SELECT region, platform, note, GROUPING(region, platform, note)::INT AS gid, count(*) AS totale, count(*) FILTER (WHERE reachable) AS raggiungibili, count(*) FILTER (WHERE found) AS trasparenza FROM (
      SELECT coalesce(nullif(region, ''), '?') AS region, CASE WHEN reachable THEN coalesce(nullif(platform, ''), 'unknown') ELSE '-' END AS platform, coalesce(nullif(discovery_note, ''), '?') AS note, reachable, coalesce(trasparenza_url, '') <> '' AS found FROM schools)
    GROUP BY GROUPING SETS ((), (region), (platform), (note))"""
    return sql
