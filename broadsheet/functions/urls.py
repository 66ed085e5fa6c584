"""URL expressions: parts of an article url and reference resolution."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The generic URI pattern of RFC 3986, appendix B: scheme, authority, path, query, fragment.
_URI = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#([\s\S]*))?$"


def url_domain(url: Column) -> Column:
    """``https://host`` of ``https://host/...``."""
    slash = F.lit("/")
    return F.concat(
        F.split_part(url, slash, F.lit(1)), F.lit("//"), F.split_part(url, slash, F.lit(3))
    )


def url_category(url: Column) -> Column:
    """First path segment, or an empty string."""
    return F.split_part(url, F.lit("/"), F.lit(4))


def url_title(url: Column) -> Column:
    """Second part from the right, which is the slug when the url ends with a slash."""
    return F.split_part(url, F.lit("/"), F.lit(-2))


def _part(text: Column, group: int) -> Column:
    return F.regexp_extract(text, _URI, group)


def _without_dots(segments: Column) -> Column:
    """Apply ``.`` and ``..`` to an array of path segments whose first one is empty."""
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == ".", acc)
        .when(
            s == "..",
            F.when(F.size(acc) > 0, F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(acc),
        )
        .otherwise(F.concat(acc, F.array(s))),
    )
    ends_in_dots = F.element_at(segments, -1).isin(".", "..")
    return F.when(ends_in_dots, F.concat(kept, F.array(F.lit("")))).otherwise(kept)


def _path_text(segments: Column) -> Column:
    joined = F.array_join(segments, "/")
    # A path of a hierarchical url keeps its leading slash even when ".." ate the root.
    return F.when(joined.startswith("/"), joined).otherwise(F.concat(F.lit("/"), joined))


def resolve_url(base: Column, link: Column) -> Column:
    """Absolute form of ``link`` seen from the page ``base``, by RFC 3986 section 5.

    A narrow expression: no Python and no shuffle. Bases are http or https urls. Empty
    segments inside a merged relative path are dropped, an empty query or fragment too.
    """
    scheme, authority, path, query, fragment = (_part(link, i) for i in range(1, 6))
    b_scheme, b_authority, b_path, b_query = (_part(base, i) for i in range(1, 5))
    same_scheme = F.lower(scheme) == F.lower(b_scheme)

    base_segments = F.split(b_path, "/")
    base_dir = F.slice(base_segments, F.lit(1), F.greatest(F.size(base_segments) - 1, F.lit(0)))
    # A base without a path still has the root as its folder.
    base_dir = F.when(F.size(base_dir) == 0, F.array(F.lit(""))).otherwise(base_dir)
    own = F.split(path, "/")
    merged = F.concat(base_dir, own)
    last = F.size(merged) - 1
    inner = F.filter(merged, lambda s, i: (i == 0) | (i == last) | (s != ""))
    segments = F.when(path.startswith("/"), own).otherwise(inner)

    own_authority = authority != ""
    no_path = (path == "") & ~own_authority
    new_path = F.when(no_path, b_path).otherwise(_path_text(_without_dots(segments)))
    new_query = F.when(no_path & (query == ""), b_query).otherwise(query)
    tail = F.concat(
        F.when(new_query != "", F.concat(F.lit("?"), new_query)).otherwise(""),
        F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(""),
    )
    relative = F.concat(
        b_scheme,
        F.lit("://"),
        F.when(own_authority, authority).otherwise(b_authority),
        F.when(own_authority, path).otherwise(new_path),
        tail,
    )
    return (
        F.when(base.isNull() | (base == ""), link)
        .when(link.isNull() | (link == ""), base)
        .when((scheme != "") & ~same_scheme, link)
        .otherwise(relative)
    )
