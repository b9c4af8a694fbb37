"""URL columns: canonical form, redirect unwrapping, content-page test, signatures.

`canonical_url` and `unwrap_redirect` take any column. The functions that look at an
already canonical URL (`host_of`, `is_page`, `url_signature`) refer to it many times:
hand them a column that exists, not an expression. `with_page` does this in stages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom import vocab
from feedloom.functions.core import any_of, col, first_group, pin
from feedloom.functions.text import strip

# Scheme and authority, path, query of a URL without fragment (RFC 3986, appendix B).
_HTTP = r"^https?://"
_NETLOC = r"^https?://([^/?#]*)"
_PATH = r"^https?://[^/?#]*([^?#]*)"
_QUERY = r"^https?://[^?#]*\?([^#]*)"

_DROPPED_PARAM = (
    r"(?i)&(?:(?:" + any_of(vocab.TRACKING_PARAMS) + r")=[^&]*|[^&=]*=?)(?=&|$)"
)


def _decode(c: Column) -> Column:
    """Percent and plus decoding that leaves stray percent signs alone."""
    return F.try_url_decode(F.regexp_replace(c, "%(?![0-9A-Fa-f]{2})", "%25"))


# Two characters that no text holds, percent-encoded.
_ASIDE = ("%EF%B7%90", "%EF%B7%91")


def _clean_query(query: Column) -> Column:
    """Drop tracking and blank parameters, re-encode the rest; `?a=1&b=2` or an empty string.

    Separators are swapped for control characters so that the whole string can be
    decoded and encoded in one call instead of parameter by parameter.
    """
    # Control characters that the query itself holds step aside meanwhile.
    own = F.replace(F.replace(query, F.lit("%01"), F.lit(_ASIDE[0])), F.lit("%02"), F.lit(_ASIDE[1]))
    own = F.translate(own, "\u0001\u0002", "\ufdd0\ufdd1")
    marked = F.regexp_replace(own, "(^|&)([^=&]*)=", "$1$2\u0002")
    marked = F.replace(marked, F.lit("&"), F.lit("\u0001"))
    coded = F.url_encode(_decode(marked))
    # The encoder differs from form encoding in two characters only.
    coded = F.replace(F.replace(coded, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))
    coded = F.replace(F.replace(coded, F.lit("%01"), F.lit("&")), F.lit("%02"), F.lit("="))
    kept = F.regexp_replace(F.concat(F.lit("&"), coded), _DROPPED_PARAM, "")
    kept = F.replace(F.replace(kept, F.lit(_ASIDE[0]), F.lit("%01")), F.lit(_ASIDE[1]), F.lit("%02"))
    return F.regexp_replace(kept, "^&", "?")


def url_head(c: Column | str) -> Column:
    """Trimmed URL with a scheme and without fragment."""
    u = F.regexp_replace(strip(F.coalesce(col(c), F.lit(""))), "^//", "https://")
    return strip(F.regexp_replace(F.translate(u, "\t\r\n", ""), "(?s)#.*$", ""))


def canonical_of(head: Column | str) -> Column:
    """Canonical form of an existing `url_head` column."""
    u = col(head)
    path = F.regexp_replace(F.translate(F.regexp_extract(u, _PATH, 1), "\\", "/"), "/{2,}", "/")
    query = F.when(u.contains("?"), _clean_query(F.regexp_extract(u, _QUERY, 1))).otherwise("")
    return F.when(
        u.rlike(_HTTP),
        F.concat(
            F.lit("https://"),
            F.regexp_extract(u, _NETLOC, 1),
            F.regexp_replace(path, "^/*", "/"),
            query,
        ),
    ).otherwise("")


def canonical_url(c: Column | str) -> Column:
    """https form without fragment and tracking; empty string if it is not an http(s) URL."""
    return canonical_of(url_head(c))


def unwrap_redirect(c: Column | str) -> Column:
    """Inner URL of a search or social redirect link (decoded twice), else the URL itself."""
    return unwrapped(strip(F.coalesce(col(c), F.lit(""))))


def unwrapped(trimmed: Column | str) -> Column:
    """`unwrap_redirect` of an existing trimmed column."""
    u = col(trimmed)
    netloc = F.lower(F.regexp_extract(u, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))
    path = F.lower(F.regexp_extract(u, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*([^?#]*)", 1))
    query = F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1)

    def param(name: str) -> Column:
        return first_group(query, rf"(?:^|&){name}=([^&]+)")

    def inner(*names: str) -> Column:
        once = strip(_decode(F.coalesce(*[param(n) for n in names])))
        return _decode(F.replace(once, F.lit("+"), F.lit("%2B")))

    search = F.when(
        netloc.endswith("google.com") & path.contains("/url"), inner("url", "q", "u")
    )
    social = F.when(netloc.contains("facebook.com"), inner("u", "url"))
    return F.when(u.rlike(r"(?i)google\.com|facebook\.com"), F.coalesce(search, social, u)).otherwise(u)


def host_of(canon: Column | str) -> Column:
    """Lower-case host without userinfo and port."""
    return F.lower(F.regexp_extract(col(canon), r"^https?://(?:[^/?#]*@)?([^/?#:@]*)", 1))


def page_path(canon: Column | str) -> Column:
    """Path without parameters of the last segment."""
    return F.regexp_replace(F.regexp_extract(col(canon), _PATH, 1), ";[^/]*$", "")


def path_parts(path: Column | str) -> Column:
    """Non-empty segments of a canonical path in lower case; an empty array for the root."""
    inner = F.regexp_replace(F.lower(col(path)), "^/+|/+$", "")
    return F.when(inner != "", F.split(inner, "/")).otherwise(F.array().cast("array<string>"))


def is_page(canon: Column | str, host: Column | str, path: Column | str, parts: Column | str) -> Column:
    """Whether a canonical URL points at a concrete content page rather than a hub."""
    canon, host, path, parts = col(canon), col(host), F.lower(col(path)), col(parts)
    n, first, second = F.size(parts), F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    cdn = host.endswith(vocab.IMAGE_CDN_SUFFIXES[0])
    for suffix in vocab.IMAGE_CDN_SUFFIXES[1:]:
        cdn = cdn | host.endswith(suffix)

    service_root = first.isin(*vocab.SERVICE_ROOTS)
    netflix = (
        F.when(host.startswith("tudum.") | host.contains(".tudum."), (n >= 2) & ~service_root)
        .when(path.contains("/title/"), path.rlike("/title/[a-z0-9-]+"))
        .when(path.contains("/nq/"), True)
        .when(service_root, n >= 3)
        .otherwise(n >= 2)
    )
    two_part_hub = (first == "v") & second.isin("film", "tv", "music", "awards") | first.isin(
        "tv", "film", "movies"
    ) & second.isin("film", "tv", "news", "boxes", "reviews")
    by_host = (
        F.when(host.contains("nflxext.com"), n >= 2)
        .when(host.contains("netflix.com"), netflix)
        .when(
            host.contains("disneyplus.com"),
            (n >= 2) & ~(first.isin("browse", "home", "shop", "espn") & (n < 3)),
        )
        .when(
            host.contains("primevideo.com"),
            path.rlike("/detail/|/video/|/storefront/|/dp/|/gp/video/"),
        )
        .when(
            host.contains("amazon.") & path.rlike("/gp/video|primevideo"),
            path.rlike("/detail/|/video/|/dp/"),
        )
        .when(
            host.contains("max.com") | host.contains("hbo.com"),
            ~first.isin("sign-in", "login", "404") & (n >= 2),
        )
        .when(
            host.contains("imdb.com"),
            path.rlike(r"/title/tt\d+|/chart/|/name/nm\d+|/news/ni\d+"),
        )
    )
    by_shape = (
        F.when(path.rlike(r"/(?:19|20)\d{2}/"), True)
        .when(n >= 3, True)
        .when(n == 2, ~two_part_hub)
        .otherwise(~first.isin(*vocab.HUB_SEGMENTS) & (F.length(first) >= 24))
    )
    nowhere = ~canon.startswith("https://") | host.contains(vocab.AGGREGATOR_HOST) | cdn | (n == 0)
    return F.when(nowhere, False).otherwise(F.coalesce(by_host, by_shape))


def with_page(df: DataFrame, **urls: tuple[str, str]) -> DataFrame:
    """Add canonical form and content-page flag for URL columns.

    `with_page(df, article_url=("article_canon", "article_ok"))`. Every stage refers to the
    one before it several times, so Catalyst keeps them apart and nothing is computed twice.
    """
    canons = {canon: source for source, (canon, _) in urls.items()}
    df = pin(df, **{n: strip(F.coalesce(source, F.lit(""))) for n, source in canons.items()})
    for step in (unwrapped, url_head, canonical_of):
        df = pin(df, **{n: step(n) for n in canons})
    heads, parts = {}, {}
    for source, (canon, _) in urls.items():
        heads |= {f"_h_{source}": host_of(canon), f"_p_{source}": page_path(canon)}
        parts[f"_s_{source}"] = path_parts(f"_p_{source}")
    df = df.withColumns(heads).withColumns(parts)
    flags = {
        flag: is_page(canon, f"_h_{source}", f"_p_{source}", f"_s_{source}")
        for source, (canon, flag) in urls.items()
    }
    return pin(df, **flags).drop(*heads, *parts)


def simplify_domain(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(strip(c)), r"\.+$", ""), r"^www\.", "")


def publication_domain(c: Column | str) -> Column:
    """Known outlets collapse to their apex domain; others keep the simplified host."""
    d = simplify_domain(col(c))
    apex = first_group(d, r"^(?:.*\.)?(" + any_of(vocab.APEX_DOMAINS) + ")$")
    return F.coalesce(apex, d)


def _signature_of(lowered: Column) -> Column:
    u = lowered
    query = F.regexp_extract(u, _QUERY, 1)
    marked = F.replace(query, F.lit("&"), F.lit("\u0001"))
    pairs = F.sort_array(F.split(_decode(marked), "\u0001"))
    return F.when(
        u != "",
        F.concat(
            F.lit("https://"),
            publication_domain(F.regexp_extract(u, _NETLOC, 1)),
            F.regexp_replace(F.regexp_extract(u, _PATH, 1), "/+$", ""),
            F.when(u.contains("?"), F.concat(F.lit("?"), F.array_join(pairs, "&"))).otherwise(""),
        ),
    )


def url_signature(canon: Column | str) -> Column:
    """Comparable form of a canonical URL: lower case, apex domain, sorted decoded query."""
    lowered = F.regexp_replace(F.lower(col(canon)), "/+$", "")
    return F.coalesce(_signature_of(lowered), F.lit(""))


def with_signature(df: DataFrame, **canon: Column) -> DataFrame:
    """Add signatures of canonical URLs, in stages; NULL for NULL and empty ones."""
    df = pin(df, **{out: F.regexp_replace(F.lower(c), "/+$", "") for out, c in canon.items()})
    return pin(df, **{out: _signature_of(F.col(out)) for out in canon})


def absolute_href(href: Column | str, base: Column | str) -> Column:
    """Link target against its page: scheme-relative, root-relative or relative to the folder."""
    h, b = strip(col(href)), col(base)
    root = F.regexp_extract(b, r"^(https?://[^/?#]*)", 1)
    folder = F.regexp_replace(F.regexp_extract(b, _PATH, 1), "[^/]*$", "")
    folder = F.when(folder == "", "/").otherwise(folder)
    return (
        F.when(h.startswith("//"), F.concat(F.lit("https:"), h))
        .when(h.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), h)
        .when(h.startswith("/"), F.concat(root, h))
        .when(h.startswith("?"), F.concat(F.regexp_replace(b, r"[?#].*$", ""), h))
        .when(h.startswith("#"), F.concat(F.regexp_replace(b, "#.*$", ""), h))
        .when(h == "", b)
        .otherwise(F.concat(root, folder, h))
    )


def is_aggregator(url: Column | str) -> Column:
    """Host is the news aggregator or one of its subdomains."""
    return F.lower(F.regexp_extract(col(url), r"^[A-Za-z]+://([^/?#]*)", 1)).rlike(
        r"(?:^|\.)" + any_of([vocab.AGGREGATOR_HOST]) + "$"
    )


def is_image_cdn(url: Column | str) -> Column:
    """Host serves bare images, so the URL is no content page."""
    return F.lower(F.regexp_extract(strip(col(url)), r"^[A-Za-z]*:?//([^/?#]*)", 1)).rlike(
        "(?:" + any_of(vocab.IMAGE_CDN_SUFFIXES) + ")$"
    )


def has_path(url: Column | str) -> Column:
    return F.regexp_extract(col(url), _PATH, 1).rlike("[^/]")
