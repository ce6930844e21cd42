"""Addresses: scope, routing, cleaning and extraction, all as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.config import PipelineConfig

#: Fixed value: the longest address that is kept.
MAX_LENGTH = 200


def in_scope(url: Column, config: PipelineConfig) -> Column:
    return url.startswith(config.scope_prefix)


def is_video(url: Column, config: PipelineConfig) -> Column:
    return url.startswith(config.video_prefix)


def _occurs(url: Column, literal: str) -> Column:
    """How often a literal occurs, without overlaps."""
    return F.size(F.split(url, re.escape(literal), -1)) - 1


def malformed_reason(url: Column, config: PipelineConfig) -> Column:
    """The first rule that an address breaks, NULL for a sound one."""
    host = config.origin.split("//", 1)[1]
    rules = (
        ("scheme_twice", (_occurs(url, "https://") >= 2) | (_occurs(url, "http://") >= 2)),
        ("byte_order_mark", url.contains("%ef%bb%bf") | url.contains("\ufeff")),
        ("documentation_twice", _occurs(url, "/documentation/") >= 2),
        ("broken_scheme", url.contains("https:/") & ~url.startswith("https://")),
        ("too_long", F.length(url) > MAX_LENGTH),
        ("host_twice", _occurs(url, host) >= 2),
    )
    reason = F.lit(None).cast("string")
    for name, broken in reversed(rules):
        reason = F.when(broken, F.lit(name)).otherwise(reason)
    return reason


def normalize_url(url: Column) -> Column:
    """Lower-case scheme and host; no credentials, port, query, fragment or trailing slashes; the path keeps its case.

    What does not parse as scheme, host and path stays as it is. Dot segments are not resolved.
    """
    pattern = r"^([A-Za-z][A-Za-z0-9+.-]*)://(?:[^/?#@]*@)?([^/?#:@]+)(?::[0-9]*)?(/[^?#]*)?(?:[?#].*)?$"
    scheme, host, path = (F.regexp_extract(url, pattern, k) for k in (1, 2, 3))
    return F.when(url.rlike(pattern), F.concat(F.lower(scheme), F.lit("://"), F.lower(host), F.regexp_replace(path, "/+$", ""))).otherwise(url)


def document_urls(references: Column, config: PipelineConfig) -> Column:
    """Addresses of documents among the ``url`` values of references: absolute, in scope, sound, normalised, each once."""
    absolute = F.transform(
        F.filter(references, lambda u: u.isNotNull() & (u != "")),
        lambda u: F.when(u.startswith("http"), u).otherwise(F.concat(F.lit(config.origin), u)),
    )
    wanted = lambda u: F.exists(F.array(*[F.lit(config.origin + p) for p in config.document_paths]), lambda p: F.startswith(u, p))
    sound = F.filter(absolute, lambda u: wanted(u) & malformed_reason(u, config).isNull())
    return F.array_distinct(F.transform(sound, normalize_url))


def reference_urls(raw_json: Column) -> Column:
    """The ``url`` values of a document's references; an empty array where there are none."""
    table = F.try_variant_get(F.try_parse_json(raw_json), "$.references", "map<string,variant>")
    return F.coalesce(F.transform(F.map_values(table), lambda v: F.try_variant_get(v, "$.url", "string")), F.array().cast("array<string>"))


def api_url(url: Column, config: PipelineConfig) -> Column:
    """Where a page's data is fetched. An address without a scheme is ``Invalid URL: ...``."""
    path = F.regexp_replace(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+([^?#]*)", 1), "/$", "")
    special = F.replace(path, F.lit(config.alternate_page_from), F.lit(config.alternate_page_to))
    alternate, default = F.lit(config.api_alternate), F.lit(config.api_default)
    routed = (
        F.when(url == config.alternate_page, F.concat(alternate, special, F.lit(".json")))
        .when(url.contains(config.alternate_marker), F.concat(alternate, path, F.lit(".json")))
        .otherwise(F.concat(default, path, F.lit(".json")))
    )
    return F.when(url.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+"), routed).otherwise(F.concat(F.lit("Invalid URL: "), url))
