"""Extraction from HTML with built-in regular expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import full_trim, none_if_empty

#: Fixed patterns of the pages that are read.
TITLE = '<meta[^>]+property="og:title"[^>]+content="([^"]+)"'
TRANSCRIPT = r'<section id="transcript-content">([\s\S]*?)</section>'
SEGMENT = 'data-start="[0-9.]+"[^>]*>([^<]*)'


def first_match(html: Column, pattern: str) -> Column:
    return none_if_empty(F.regexp_extract(html, pattern, 1))


def discover_links(html: Column, path: str, origin: str) -> Column:
    """Distinct absolute addresses of links below ``path``, without one trailing slash; query strings stay."""
    found = F.regexp_extract_all(html, F.lit(f'href="({path}[^"]+)"'), F.lit(1))
    return F.array_distinct(F.transform(found, lambda u: F.concat(F.lit(origin), F.regexp_replace(u, "/$", ""))))


def page_title(html: Column, pattern: str = TITLE) -> Column:
    """Not decoded; NULL where there is none."""
    return first_match(html, pattern)


def has_section(html: Column, pattern: str = TRANSCRIPT) -> Column:
    return F.coalesce(html.rlike(pattern), F.lit(False))


def transcript(html: Column, section: str = TRANSCRIPT, segment: str = SEGMENT) -> Column:
    """The trimmed, non-blank segments of the first section, joined by spaces."""
    pieces = F.regexp_extract_all(F.regexp_extract(html, section, 1), F.lit(segment), F.lit(1))
    return F.array_join(F.filter(F.transform(pieces, full_trim), lambda x: x != ""), " ")


def transcript_error(html: Column, section: str = TRANSCRIPT, segment: str = SEGMENT) -> Column:
    """``NO_TRANSCRIPT`` without a section, ``EMPTY_TRANSCRIPT`` without text in it, else NULL."""
    return F.when(~has_section(html, section), "NO_TRANSCRIPT").when(transcript(html, section, segment) == "", "EMPTY_TRANSCRIPT")
