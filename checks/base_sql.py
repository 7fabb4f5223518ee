"""The derived inputs as SQL: corpus, site list, features, split and scorecards, written independently of the
Spark expressions. ``with_inputs(select)`` puts them in front of a query; unused parts are not run."""

from urlsieve.functions.vocab import (BUILTIN_BRANDS, COMMON_TLDS, PARAM_SCHEMES, PHISH_HINT_WORDS,
                                      SHORTENERS, SUSPICIOUS_TLDS)
from checks.corpus import SCORECARDS, SEED_SITES


def _in(words):
    return ", ".join(f"'{w}'" for w in words)


_CORPUS = r"""
corpus_base AS (
  SELECT p.page_id, n.n_nationkey AS nk, p.url AS src,
         regexp_replace(regexp_replace(p.url, '^[a-z]+://', ''), '[/?#].*$', '') AS host,
         regexp_replace(p.url, '^[a-z]+://[^/?#]*', '') AS tail
  FROM pages p CROSS JOIN nation n),
corpus_mut AS (
  SELECT page_id, nk, CAST((page_id * 7 + nk * 3) % 12 AS INT) AS m, src, host, tail FROM corpus_base),
corpus AS (
  SELECT page_id * 100 + nk AS row_id,
    CASE m
      WHEN 0 THEN concat('http://paypa1-secure.', host, '.tk/login', tail)
      WHEN 1 THEN concat('http://g00gle.com.verify-', CAST(nk AS VARCHAR), '.xyz/account/update', tail)
      WHEN 2 THEN concat('http://10.', CAST(nk AS VARCHAR), '.', CAST(page_id % 256 AS VARCHAR), '.7:8080/a;v=1/bin.exe')
      WHEN 3 THEN concat(host, '/index.php?option=com_content&id=', CAST(page_id * 31 + nk AS VARCHAR))
      WHEN 4 THEN concat('bit.ly/', substr(md5(CAST(page_id * 100 + nk AS VARCHAR)), 1, 7))
      WHEN 5 THEN concat('https://user@', host, '//x', tail)
      WHEN 6 THEN concat('https://www.paypal.com', tail)
      WHEN 7 THEN concat('https://', host, '/')
      WHEN 8 THEN concat('www.', host, tail)
      ELSE concat(src, '&n=', CAST(nk % 20 AS VARCHAR)) END AS url,
    CASE WHEN m IN (0, 1, 4) THEN 'phishing' WHEN m = 2 THEN 'malware'
         WHEN m = 3 THEN 'defacement' WHEN m = 5 AND nk % 2 = 0 THEN 'phishing' ELSE 'benign' END AS type
  FROM corpus_mut),
uniq AS (
  SELECT row_id, url, type, CAST(CASE WHEN type <> 'benign' THEN 1 ELSE 0 END AS INT) AS label
  FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY row_id) AS rn FROM corpus) WHERE rn = 1)
"""

_LISTS = f"""
hosts AS (
  SELECT domain, count(*) AS n FROM (
    SELECT regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[/?#].*$', '') AS domain FROM pages)
  GROUP BY domain),
lines AS (
  SELECT CAST(rk AS BIGINT) AS rank, domain
  FROM (VALUES {", ".join(f"({i}, '{d}')" for i, d in enumerate(SEED_SITES, 1))}) AS t(rk, domain)
  UNION ALL SELECT {len(SEED_SITES)} + rank() OVER (ORDER BY n DESC), domain FROM hosts),
ranks AS (SELECT domain, max(rank) AS rank FROM lines GROUP BY domain),
brands AS (
  SELECT brand, row_number() OVER (ORDER BY rank, domain, brand) AS ord FROM (
    SELECT split_part(domain, '.', 1) AS brand, rank, domain,
           row_number() OVER (PARTITION BY split_part(domain, '.', 1) ORDER BY rank, domain) AS rn
    FROM lines WHERE contains(domain, '.') AND length(split_part(domain, '.', 1)) >= 5)
  WHERE rn = 1 ORDER BY rank, domain, brand LIMIT 500),
tlds AS (
  SELECT string_split(domain, '.')[-1] AS tld, count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM ranks) AS share
  FROM lines WHERE contains(domain, '.') GROUP BY 1)
"""

_BLANK = (r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]+")
_SCHEME = r"[a-zA-Z][a-zA-Z0-9+.\-]*"
_PARTS = rf"^({_SCHEME})://([^/?#]*)([^?#]*)(?:\?([^#]*))?"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_IPV4 = rf"{_OCTET}(?:\.{_OCTET}){{3}}"
_HEX = "[0-9a-fA-F]{1,4}"


def _ipv6(x):
    p = f"regexp_replace(regexp_replace({x}, '%[^%]+\\z', ''), '(^|:){_IPV4}\\z', '\\1' || '0:0')"
    side = f"(?:{_HEX}(?::{_HEX})*)?"
    return (f"(regexp_matches({p}, '^(?:{_HEX}:){{7}}{_HEX}\\z') OR (regexp_matches({p}, '^{side}::{side}\\z') "
            f"AND len(regexp_extract_all({p}, '{_HEX}')) <= 7))")


_PARSE = rf"""
raws AS (SELECT *, regexp_replace(coalesce(url, ''), '^{_BLANK}|{_BLANK}\z', '', 'g') AS raw FROM uniq),
fulls AS (
  SELECT *, regexp_replace(CASE WHEN regexp_matches(raw, '^{_SCHEME}://') THEN raw ELSE concat('http://', raw) END,
                           '[\t\r\n]', '', 'g') AS f FROM raws),
cut AS (
  SELECT *, lower(regexp_extract(f, '{_PARTS}', 1, 's')) AS scheme0, regexp_extract(f, '{_PARTS}', 2, 's') AS netloc,
         regexp_extract(f, '{_PARTS}', 3, 's') AS path0, regexp_extract(f, '{_PARTS}', 4, 's') AS query0 FROM fulls),
cut2 AS (
  SELECT *, string_split(netloc, '@')[-1] AS hp FROM cut),
cut3 AS (
  SELECT *,
    (contains(netloc, '[') <> contains(netloc, ']'))
      OR (contains(netloc, '[') AND contains(netloc, ']') AND NOT (
            regexp_matches(regexp_extract(hp, '^\[([^\]\[]*)\](?::.*)?\z', 1, 's'), '^v[0-9a-fA-F]+[.].+\z', 's')
            OR {_ipv6(r"regexp_extract(hp, '^\[([^\]\[]*)\](?::.*)?\z', 1, 's')")}))
      OR regexp_matches(netloc, '[\x{{2047}}-\x{{2049}}\x{{2100}}\x{{2101}}\x{{2105}}\x{{2106}}\x{{2A74}}\x{{FE13}}\x{{FE16}}\x{{FE55}}\x{{FE56}}\x{{FE5F}}\x{{FE6B}}\x{{FF03}}\x{{FF0F}}\x{{FF1A}}\x{{FF1F}}\x{{FF20}}]')
      AS bad,
    lower(CASE WHEN contains(hp, '[') THEN regexp_extract(hp, '\[([^\]]*)', 1, 's') ELSE split_part(hp, ':', 1) END) AS host0,
    CASE WHEN contains(hp, '[') THEN regexp_extract(hp, '\][^:]*:(.*)\z', 1, 's')
         ELSE regexp_extract(hp, '^[^:]*:(.*)\z', 1, 's') END AS port0
  FROM cut2),
parsed AS (
  SELECT row_id, url, type, label, raw, lower(raw) AS low,
    CASE WHEN bad THEN '' ELSE scheme0 END AS scheme,
    CASE WHEN bad THEN '' ELSE host0 END AS host,
    CASE WHEN bad THEN '' WHEN scheme0 IN ({_in(PARAM_SCHEMES)}) THEN regexp_replace(path0, ';[^/]*\z', '', 's') ELSE path0 END AS path,
    CASE WHEN bad THEN '' ELSE query0 END AS query,
    CASE WHEN NOT bad AND regexp_matches(port0, '^[0-9]+\z') AND TRY_CAST(port0 AS BIGINT) <= 65535
         THEN CAST(TRY_CAST(port0 AS BIGINT) AS INT) END AS port,
    CAST(bad AS INT) AS malformed
  FROM cut3),
laid AS (
  SELECT *, string_split(host, '.') AS labels,
    array_to_string(string_split(host, '.')[-2:], '.') AS rd,
    string_split(host, '.')[1:greatest(len(string_split(host, '.')) - 2, 0)] AS sub FROM parsed),
laid2 AS (
  SELECT *, CASE WHEN contains(rd, '.') THEN string_split(rd, '.')[-1] ELSE '' END AS tld,
    split_part(rd, '.', 1) AS rd_name FROM laid)
"""


def _entropy(column):
    return f"""
  SELECT row_id, -sum((c / n) * log2(c / n)) AS e FROM (
    SELECT row_id, ch, CAST(count(*) AS DOUBLE) AS c, sum(CAST(count(*) AS DOUBLE)) OVER (PARTITION BY row_id) AS n
    FROM (SELECT row_id, unnest(string_split({column}, '')) AS ch FROM laid2 WHERE {column} <> '')
    GROUP BY row_id, ch) GROUP BY row_id"""


_CHARS = f"""
chars AS (
  SELECT row_id, unnest(string_split(raw, '')) AS ch, generate_subscripts(string_split(raw, ''), 1) AS i
  FROM laid2 WHERE raw <> ''),
classed AS (
  SELECT row_id, i, ch, CASE WHEN regexp_matches(ch, '\\p{{L}}') THEN 'a' WHEN regexp_matches(ch, '\\p{{Nd}}') THEN 'd' ELSE 's' END AS k
  FROM chars),
neighbours AS (
  SELECT row_id, i, ch, k, lag(ch) OVER w AS pch, lag(k) OVER w AS pk FROM classed
  WINDOW w AS (PARTITION BY row_id ORDER BY i)),
islands AS (
  SELECT row_id, k = pk AS same, sum(CASE WHEN ch = pch THEN 0 ELSE 1 END) OVER (PARTITION BY row_id ORDER BY i) AS g
  FROM neighbours),
run_max AS (
  SELECT row_id, max(c) AS longest FROM (SELECT row_id, g, count(*) AS c FROM islands GROUP BY row_id, g) GROUP BY row_id),
same_share AS (
  SELECT row_id, CASE WHEN count(*) > 1 THEN sum(CASE WHEN same THEN 1 ELSE 0 END) / CAST(count(*) - 1 AS DOUBLE) ELSE 0 END AS r
  FROM islands GROUP BY row_id),
ent_url AS ({_entropy("raw")}),
ent_dom AS ({_entropy("rd")})
"""

_BRANDS = f"""
words AS (
  SELECT row_id, w FROM (SELECT row_id, unnest(regexp_split_to_array(host, '[.-]')) AS w FROM laid2) WHERE length(w) >= 4),
near AS (
  SELECT w, min(levenshtein(w, brand)) AS d FROM (SELECT DISTINCT w FROM words WHERE length(w) >= 5), brands
  WHERE levenshtein(w, brand) <= 2 GROUP BY w),
list_distance_of AS (SELECT row_id, min(d) AS d FROM words JOIN near USING (w) GROUP BY row_id),
builtin AS (SELECT unnest([{_in(BUILTIN_BRANDS)}]) AS brand),
builtin_distance AS (
  SELECT row_id, least(min(d), 99) AS d FROM words JOIN (
    SELECT w, min(levenshtein(w, brand)) AS d FROM (SELECT DISTINCT w FROM words), builtin GROUP BY w) USING (w)
  GROUP BY row_id)
"""


def _count(text, literal):
    return f"CAST((length({text}) - length(replace({text}, '{literal}', ''))) / {len(literal)} AS INT)"


def _share(text, pattern):
    return (f"CASE WHEN {text} = '' THEN CAST(0 AS DOUBLE) ELSE len(regexp_extract_all({text}, '{pattern}')) "
            f"/ CAST(length({text}) AS DOUBLE) END")


def _any_contains(text, words):
    return "CAST(" + " OR ".join(f"contains({text}, '{w}')" for w in words) + " AS INT)"


_PLAIN = f"""
plain AS (
  SELECT l.row_id, l.url, l.type, l.label, l.host, l.rd, l.rd_name, l.tld,
    malformed AS is_malformed, CAST(length(raw) AS INT) AS url_length, CAST(length(host) AS INT) AS hostname_length,
    CAST(length(path) AS INT) AS path_length, CAST(length(query) AS INT) AS query_length,
    CAST(len(sub) AS INT) AS nb_subdomains,
    CASE WHEN len(sub) = 0 THEN CAST(0 AS DOUBLE) ELSE length(array_to_string(sub, '')) / CAST(len(sub) AS DOUBLE) END AS avg_subdomain_length,
    {_count("raw", ".")} AS nb_dots,
    CAST(len([s for s in string_split(path, '/') if s <> '']) AS INT) AS path_depth,
    {_share("raw", chr(92) + "p{Nd}")} AS ratio_digits_url, {_share("host", chr(92) + "p{Nd}")} AS ratio_digits_host,
    {_count("raw", "-")} AS nb_hyphens, {_count("raw", "@")} AS nb_at, {_count("raw", "%")} AS nb_percent,
    {_count("raw", "_")} AS nb_underscore,
    CASE WHEN contains(raw, '://') THEN {_count("substr(raw, instr(raw, '://') + 3)", "//")} ELSE {_count("raw", "//")} END AS nb_double_slash,
    CAST(coalesce(longest, 0) AS INT) AS char_repeat,
    greatest(0, {_count("low", "www")} - CAST(starts_with(host, 'www.') AS INT)) AS nb_www,
    greatest(0, {_count("low", "com")} - CAST(ends_with(host, '.com') AS INT)) AS nb_com,
    CAST(regexp_matches(host, '^{_IPV4}\\z') OR (contains(host, ':') AND {_ipv6("host")}) AS INT) AS has_ip_host,
    CAST(scheme = 'https' AS INT) AS is_https, CAST(contains(host, 'https') AS INT) AS https_token_in_host,
    CAST(coalesce(port NOT IN (80, 443), false) AS INT) AS has_port, CAST(contains(host, 'xn--') AS INT) AS has_punycode,
    CAST(length(tld) AS INT) AS tld_length, CAST(tld IN ({_in(SUSPICIOUS_TLDS)}) AS INT) AS suspicious_tld,
    CAST(list_has_any(sub, [{_in(COMMON_TLDS)}]) AS INT) AS tld_in_subdomain,
    CAST(regexp_matches(lower(path), '\\.({"|".join(COMMON_TLDS)})(/|\\z)') AS INT) AS tld_in_path,
    {" + ".join(f"CAST(contains(low, '{w}') AS INT)" for w in PHISH_HINT_WORDS)} AS phish_hints,
    {_any_contains("array_to_string(sub, '.')", BUILTIN_BRANDS)} AS brand_in_subdomain,
    {_any_contains("lower(path)", BUILTIN_BRANDS)} AS brand_in_path,
    CAST({" OR ".join(f"host = '{s}' OR ends_with(host, '.{s}')" for s in SHORTENERS)} AS INT) AS is_shortening_service,
    coalesce(eu.e, CAST(0 AS DOUBLE)) AS entropy_url, coalesce(ed.e, CAST(0 AS DOUBLE)) AS entropy_domain,
    {_share("replace(rd, '.', '')", "[aeiou]")} AS vowel_ratio, coalesce(ss.r, CAST(0 AS DOUBLE)) AS char_continuation_rate
  FROM laid2 l LEFT JOIN run_max USING (row_id) LEFT JOIN same_share ss USING (row_id)
  LEFT JOIN ent_url eu USING (row_id) LEFT JOIN ent_dom ed USING (row_id))
"""

_FEATS = f"""
feats AS (
  SELECT p.*, CAST(coalesce(ld.d, 99) AS INT) AS min_brand_edit_distance,
    CAST(coalesce(ld.d, 99) BETWEEN 1 AND 2 AS INT) AS brand_lookalike,
    CAST(b.brand IS NOT NULL AS INT) AS brand_is_registered_domain,
    CAST(r.domain IS NOT NULL AS INT) AS in_top_sites,
    coalesce(log10((SELECT CAST(count(*) AS DOUBLE) FROM ranks) / r.rank), CAST(0 AS DOUBLE)) AS domain_rank_score,
    coalesce(t.share, CAST(0 AS DOUBLE)) AS tld_popularity
  FROM plain p LEFT JOIN list_distance_of ld USING (row_id) LEFT JOIN brands b ON b.brand = p.rd_name
  LEFT JOIN ranks r ON r.domain = p.rd LEFT JOIN tlds t ON t.tld = p.tld)
"""

_SPLIT = """
ranked AS (
  SELECT row_id, url, label, row_number() OVER (PARTITION BY label ORDER BY md5('42|' || url), url) AS rn,
         count(*) OVER (PARTITION BY label) AS n FROM uniq),
split AS (SELECT row_id, url, label, rn <= CAST(round(n * CAST(0.2 AS DOUBLE)) AS BIGINT) AS is_test FROM ranked),
folds AS (
  SELECT row_id, url, label, CAST(CAST(rn > n * 1 // 5 AS INT) + CAST(rn > n * 2 // 5 AS INT)
         + CAST(rn > n * 3 // 5 AS INT) + CAST(rn > n * 4 // 5 AS INT) AS INT) AS fold FROM ranked)
"""


def _card(which):
    b, w = SCORECARDS[which]
    z = f"CAST({b} AS DOUBLE)" + "".join(f" + CAST({v} AS DOUBLE) * {n}" for n, v in w.items())
    return f"round(1 / (1 + exp(-({z}))), 6)"


_SCORED = "".join(f"""
scored_{w} AS (
  SELECT '{w}' AS model, row_id, url, type, label, score, CAST(score > 0.5 AS INT) AS prediction
  FROM (SELECT *, {_card(w)} AS score FROM feats)),""" for w in SCORECARDS) + """
scored_all AS (SELECT * FROM scored_a UNION ALL SELECT * FROM scored_b)
"""

CARD = {w: _card(w) for w in SCORECARDS}
INPUTS = ",".join(s.strip() for s in (_CORPUS, _LISTS, _PARSE, _CHARS, _BRANDS, _PLAIN, _FEATS, _SPLIT, _SCORED))


def with_inputs(select: str, *ctes: str) -> str:
    return "WITH RECURSIVE " + ", ".join([INPUTS, *ctes]) + "\n" + select
