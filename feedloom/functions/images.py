"""Image URL columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom import vocab
from feedloom.functions.core import any_of, blank_to_null, col, has_any
from feedloom.functions.text import strip
from feedloom.functions.urls import is_image_cdn


def is_logo(url: Column | str) -> Column:
    return F.coalesce(has_any(col(url), vocab.LOGO_ASSET_IDS), F.lit(False))


def looks_like_image(url: Column | str) -> Column:
    return F.lower(col(url)).rlike(any_of(vocab.IMAGE_EXTENSIONS + vocab.IMAGE_FORMAT_HINTS))


def is_known_image_host(url: Column | str) -> Column:
    host = F.lower(F.regexp_extract(col(url), r"^[A-Za-z]*:?//([^/?#]*)", 1))
    return host.rlike(any_of(vocab.IMAGE_HOST_PARTS))


def is_placeholder(url: Column | str) -> Column:
    return F.lower(col(url)).rlike(any_of(vocab.PLACEHOLDER_PARTS))


def upsize_thumbnail(url: Column | str) -> Column:
    """The first width hint of an image-host URL becomes 1280 where it is below 400."""
    u = strip(col(url))
    small = r"^(.*?)=w0*(?:[0-9]{1,2}|[123][0-9]{2})\b"
    first = r"^(?:(?!=w\d+\b).)*"
    grown = F.regexp_replace(u, "(?sU)" + rf"({first})=w0*(?:[0-9]{{1,2}}|[123][0-9]{{2}})\b", "$1=w1280")
    return F.when(is_image_cdn(u) & u.rlike("(?sU)" + small), grown).otherwise(u)


def clean_image(url: Column | str) -> Column:
    """Known logos become NULL, small thumbnails of https URLs are enlarged."""
    u = col(url)
    return F.when(is_logo(u), F.lit(None)).when(
        u.startswith("https://"), F.coalesce(blank_to_null(upsize_thumbnail(u)), u)
    ).otherwise(u)


def secure_image(url: Column | str) -> Column:
    """https form of an image URL; NULL for other schemes, placeholders and logos."""
    u = F.regexp_replace(col(url), "^http://", "https://")
    return F.when(u.startswith("https://") & ~is_placeholder(u) & ~is_logo(u), u)


def listing_poster(path: Column | str) -> Column:
    """Poster URL of a chart listing from its template path."""
    raw = blank_to_null(col(path))
    full = F.concat(F.lit(vocab.LISTING_IMAGE_HOST), raw)
    full = F.replace(full, F.lit("{profile}"), F.lit(vocab.LISTING_IMAGE_PROFILE))
    return F.replace(full, F.lit("{format}"), F.lit(vocab.LISTING_IMAGE_FORMAT))


def card_poster(image_id: Column | str) -> Column:
    """Image URL of a card from its asset id (UUID with or without dashes, or a long hash)."""
    key = strip(col(image_id))
    dashed = F.regexp_replace(
        F.lower(key), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"
    )
    segment = (
        F.when(key.rlike("^[0-9A-Fa-f]{64}$"), F.upper(key))
        .when(key.rlike("^[0-9A-Fa-f]{32}$"), dashed)
        .otherwise(F.lower(key))
    )
    return F.when(
        key != "",
        F.concat(F.lit(vocab.CARD_IMAGE_URL), segment, F.lit(vocab.CARD_IMAGE_ARGS)),
    )


def detail_poster(url: Column | str) -> Column:
    """Full-size rendition of a detail-page thumbnail."""
    return F.regexp_replace(col(url), r"\._V1_.*$", F.lit(vocab.DETAIL_POSTER_RENDITION.replace("$", r"\$")))
