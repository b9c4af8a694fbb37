"""Pieces of the checking SQL, written for DuckDB and independently of the Spark columns."""

from __future__ import annotations

from feedloom import vocab

W = r"\p{L}\p{N}_"


def quote(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(quote(v) for v in values) + ")"


def array(values) -> str:
    return "[" + ", ".join(quote(v) for v in values) + "]"


def canon(u: str) -> str:
    """Canonical URL of a URL column without percent escapes."""
    return rf"""(CASE WHEN regexp_matches({u}, '^https?://') THEN
      'https://' || regexp_extract({u}, '^https?://([^/?#]*)', 1)
      || regexp_replace('/' || regexp_extract({u}, '^https?://[^/?#]*([^?#]*)', 1), '/{{2,}}', '/', 'g')
      || coalesce(nullif('?' || array_to_string(list_filter(
           string_split(regexp_extract({u}, '^[^?#]*[?]([^#]*)', 1), '&'),
           lambda p: regexp_matches(p, '^[^=]+=.')
             AND NOT list_contains({array(vocab.TRACKING_PARAMS)}, lower(split_part(p, '=', 1)))), '&'), '?'), '')
    ELSE '' END)"""


def signature(c: str) -> str:
    """Signature of a canonical URL whose outlet has no apex rule."""
    return rf"""('https://'
      || regexp_replace(regexp_extract(lower({c}), '^https://([^/?#]*)', 1), '^www[.]', '')
      || rtrim(regexp_extract(lower({c}), '^https://[^/?#]*([^?#]*)', 1), '/')
      || coalesce(nullif('?' || array_to_string(list_sort(string_split(
           regexp_extract(lower({c}), '[?](.*)$', 1), '&')), '&'), '?'), ''))"""


def page_ok(c: str) -> str:
    """Content-page rule of canonical URLs on hosts without a rule of their own."""
    path = rf"lower(regexp_extract({c}, '^https://[^/?#]*([^?#]*)', 1))"
    seg = f"list_filter(string_split({path}, '/'), lambda s: s <> '')"
    return rf"""(CASE WHEN {c} NOT LIKE 'https://%' THEN false
      WHEN len({seg}) = 0 THEN false
      WHEN regexp_matches({path}, '/(19|20)[0-9][0-9]/') THEN true
      WHEN len({seg}) >= 3 THEN true
      WHEN len({seg}) = 2 THEN NOT (
        ({seg}[1] = 'v' AND {seg}[2] IN ('film', 'tv', 'music', 'awards'))
        OR ({seg}[1] IN ('tv', 'film', 'movies') AND {seg}[2] IN ('film', 'tv', 'news', 'boxes', 'reviews')))
      WHEN {seg}[1] IN {in_list(vocab.HUB_SEGMENTS)} THEN false
      ELSE length({seg}[1]) >= 24 END)"""


def squeeze(t: str) -> str:
    return rf"trim(regexp_replace({t}, '[\s\p{{Z}}]+', ' ', 'g'))"


def text_of(fragment: str) -> str:
    out = f"regexp_replace({fragment}, '<[^>]+>', ' ', 'g')"
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        out = f"replace({out}, {quote(a)}, {quote(b)})"
    return squeeze(out)


def tag(html: str, name: str) -> str:
    return text_of(rf"nullif(regexp_extract({html}, '(?is)<{name}\b[^>]*>(.*?)</{name}>', 1), '')")


TITLE = tag("html", "title")
HEADING = tag("html", "h1")
LANG = r"""nullif(regexp_extract(html, '(?is)<html\b[^>]*?\blang=["'']([^"'']*)["'']', 1), '')"""


def title_norm(t: str) -> str:
    x = f"coalesce(nullif({squeeze(t)}, ''), '{vocab.UNKNOWN_TITLE}')"
    x = rf"regexp_replace({x}, '\s+[-|–—]\s+(?:[A-Za-z][{W} .&+:''/-]{{1,60}}|[{W}.-]+\.[a-z]{{2,}})\s*$', '')"
    x = rf"regexp_replace({x}, '(?i)\s+[-|–—]\s+[{W}.-]+\.[a-z]{{2,}}\s*$', '')"
    x = rf"regexp_replace({x}, '(?i)\s*\((?:[0-9]{{4}}|TV Series|TV Mini Series)\)\s*$', '')"
    x = rf"regexp_replace({squeeze(x)}, '^[ \-|]+|[ \-|]+$', '', 'g')"
    return f"coalesce(nullif({x}, ''), '{vocab.UNKNOWN_TITLE}')"


def title_sig(normalized: str) -> str:
    """Signature from a normalised title: words and single other characters, filtered."""
    tokens = rf"regexp_extract_all(lower({normalized}), '[{W}]+|[^{W}]')"
    kept = rf"list_filter({tokens}, lambda w: w NOT IN ('the', 'a', 'an') AND regexp_matches(w, '^[{W}]+$|^\s$'))"
    return squeeze(f"array_to_string({kept}, '')")


def has_word(text: str, words) -> str:
    alt = "|".join(words)
    return rf"regexp_matches({text}, '(^|[^{W}])(?:{alt})($|[^{W}])')"


def contains_any(text: str, words) -> str:
    return "(" + " OR ".join(f"contains({text}, {quote(w)})" for w in words) + ")"


def clamp(t: str, fallback: str = "") -> str:
    """Summary of a text column; two steps keep the expression readable."""
    text = squeeze(f"coalesce({t}, '')")
    text = f"coalesce(nullif({text}, ''), {quote(fallback)})"
    head = rf"regexp_replace(regexp_replace(rtrim(left({text}, 500)), ' [^ ]*$', ''), '[ ,;:–—-]+$', '')"
    return rf"""(CASE WHEN length({text}) <= 500 THEN {text}
      WHEN right({head}, 1) IN ('.', '!', '?') THEN {head} ELSE {head} || '...' END)"""
