"""URL, identifier and hash columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.binding import computed_once

# fixed values
TRACKING_PREFIX = "utm_"
TRACKING_KEYS = ("fbclid", "gclid", "mc_cid", "mc_eid", "ref")
DEFAULT_PORTS = {"http": "80", "https": "443"}
ARXIV_ABS = "https://arxiv.org/abs/"
URL_HASH_CHARS = 10

_HEAD = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/]*))?(.*)$"


_USUAL = r"^[A-Za-z][A-Za-z0-9+.\-]*://"


def _head(url: Column) -> Column:
    """What stands before the query and the fragment."""
    return F.substring_index(F.substring_index(url, "#", 1), "?", 1)


def _split(url: Column) -> tuple[Column, Column, Column]:
    """(scheme, authority, path) as they stand.

    The usual `scheme://...` form is taken apart with plain string functions; the pattern only serves the others.
    """
    head = _head(url)
    usual = head.rlike(_USUAL)
    scheme = F.substring_index(head, "://", 1)
    rest = F.substring(head, F.length(scheme) + 4, F.length(head))
    authority = F.substring_index(rest, "/", 1)
    path = F.substring(rest, F.length(authority) + 1, F.length(rest))
    cheap = (scheme, authority, path)
    return tuple(F.when(usual, c).otherwise(F.regexp_extract(head, _HEAD, i + 1)) for i, c in enumerate(cheap))


def _authority(url: Column) -> Column:
    return _split(url)[1]


def url_scheme(url: Column) -> Column:
    return F.lower(_split(url)[0])


def _host_of(authority: Column) -> Column:
    place = F.substring_index(authority, "@", -1)
    return F.lower(
        F.when(place.startswith("["), F.regexp_extract(place, r"^\[([^\]]*)\]", 1))
        .otherwise(F.substring_index(place, ":", 1))
    )


def _port_of(authority: Column) -> Column:
    return F.when(authority.contains(":"), F.regexp_extract(authority, r":0*([0-9]+)$", 1)).otherwise("")


def url_host(url: Column) -> Column:
    """Lower-case host without userinfo, port or IPv6 brackets; empty when there is none."""
    return _host_of(_authority(url))


def url_port(url: Column) -> Column:
    """Explicit port as text without leading zeros, empty when there is none."""
    return _port_of(_authority(url))


def url_query(url: Column) -> Column:
    whole = F.substring_index(url, "#", 1)
    return F.when(whole.contains("?"), F.substring(whole, F.length(_head(url)) + 2, F.length(whole))).otherwise("")


def url_tail(url: Column) -> Column:
    """The fragment with its sign; an empty fragment is none."""
    start = F.length(F.substring_index(url, "#", 1))
    return F.when(F.length(url) > start + 1, F.substring(url, start + 1, F.length(url))).otherwise("")


_TRACKED = rf"&(?:{TRACKING_PREFIX}[^&=]*|{'|'.join(TRACKING_KEYS)})(?:=[^&]*)?(?=&|$)"
_SUSPECT = rf"(?:^|&)(?:{TRACKING_PREFIX}|{'|'.join(TRACKING_KEYS)}|&|$)"


def _kept_query(query: Column) -> Column:
    """The query without tracking and empty segments; all others verbatim and in order."""
    kept = F.regexp_replace(F.regexp_replace(F.concat(F.lit("&"), query), _TRACKED, ""), "&+", "&")
    # most queries have nothing to drop
    return F.when(query.rlike(_SUSPECT), F.btrim(kept, F.lit("&"))).otherwise(query)


def _clean_path(path: Column) -> Column:
    bare = F.when(path.contains(";"), F.regexp_replace(path, r";[^/]*$", "")).otherwise(path)
    return F.rtrim(bare, F.lit("/"))


def _joined(scheme: Column, placed: Column, host: Column, port: Column, path: Column, query: Column, tail: Column) -> Column:
    is_default = F.lit(False)
    for name, number in DEFAULT_PORTS.items():
        is_default = is_default | ((scheme == name) & (port == number))
    return F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""),
        F.when(placed, F.lit("//")).otherwise(""),
        host,
        F.when((port != "") & ~is_default, F.concat(F.lit(":"), port)).otherwise(""),
        path,
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""),
        tail,
    )


def normalise_url(url: Column) -> Column:
    """Canonical form: lower-case scheme and host, no default port, no tracking keys, no trailing slash.

    Userinfo and `;params` of the last path segment are dropped; the fragment and every other query segment stay
    as they are.  For whole tables use `with_normalised_url`.
    """
    return _joined(
        url_scheme(url), _authority(url) != "", url_host(url), url_port(url), _clean_path(_split(url)[2]),
        _kept_query(url_query(url)), url_tail(url))


def with_normalised_url(df: DataFrame, url: str, out: str, host: str | None = None) -> DataFrame:
    """Add `normalise_url` (and the host) in steps.

    Each step names the pieces of the one before, so no piece is computed twice and the generated code stays small
    enough to be compiled to machine code; as one expression it does not.
    """
    u, piece = F.col(url), lambda n: F.col(f"_u_{n}")
    whole = F.substring_index(u, "#", 1)
    steps = (
        {"head": _head(u), "query": url_query(u), "tail": url_tail(u), "usual": _head(u).rlike(_USUAL)},
        {"scheme": F.when(piece("usual"), F.substring_index(piece("head"), "://", 1))
            .otherwise(F.regexp_extract(piece("head"), _HEAD, 1))},
        {"rest": F.when(piece("usual"), F.substring(piece("head"), F.length(piece("scheme")) + 4, F.length(whole)))},
        {"authority": F.when(piece("usual"), F.substring_index(piece("rest"), "/", 1))
            .otherwise(F.regexp_extract(piece("head"), _HEAD, 2))},
        {"path": F.when(piece("usual"), F.substring(piece("rest"), F.length(piece("authority")) + 1, F.length(whole)))
            .otherwise(F.regexp_extract(piece("head"), _HEAD, 3)),
         "host": _host_of(piece("authority")), "port": _port_of(piece("authority"))},
        {"path": _clean_path(piece("path")), "query": _kept_query(piece("query")), "scheme": F.lower(piece("scheme"))},
    )
    staged = df
    for step in steps:
        staged = staged.withColumns({f"_u_{n}": c for n, c in step.items()})
    result = _joined(piece("scheme"), piece("authority") != "", *[piece(n) for n in ("host", "port", "path", "query", "tail")])
    new = {out: result} if host is None else {out: result, host: piece("host")}
    return computed_once(staged, [c for c in df.columns if c not in new], **new)


def url_hash(url: Column) -> Column:
    """First ten hex digits of SHA-256 over the normalised url."""
    return F.substring(F.sha2(normalise_url(url), 256), 1, URL_HASH_CHARS)


def arxiv_canonical_url(arxiv_id: Column) -> Column:
    return F.concat(F.lit(ARXIV_ABS), arxiv_id)


def arxiv_id(raw: Column) -> Column:
    """Bare id of an entry: the abs prefix and a trailing version are cut."""
    return F.regexp_replace(F.regexp_replace(F.trim(raw), r"^https?://arxiv\.org/abs/", ""), r"v[0-9]+$", "")


def arxiv_id_from_url(url: Column) -> Column:
    """Id as it stands in an abs url, version kept; null when the url is not one."""
    return F.nullif(F.regexp_extract(url, r"arxiv\.org/abs/([^\s?#]+)", 1), F.lit(""))


def arxiv_ref(item: Column) -> Column:
    """(prior_title, arxiv_id) of a reference such as `Tidal Graphs (arXiv:2507.00321)`; null without an id."""
    pattern = r"(?s)^(.*?)arXiv:([0-9]{4}\.[0-9]{4,5}(?:v[0-9]+)?)"
    ref = F.regexp_extract(item, pattern, 2)
    before = F.regexp_replace(F.regexp_extract(item, pattern, 1), r"(?U)\s+$", "")
    before = F.regexp_replace(before, r"(?U)\s*\($", "")
    title = F.when(before == "", ref).otherwise(before)
    return F.when(ref != "", F.struct(title.alias("prior_title"), ref.alias("arxiv_id")))


def slug_suffix(url: Column) -> Column:
    """What is appended to a title whose slug is taken: the arXiv id, else the host."""
    found = arxiv_id_from_url(url)
    return F.when(found.isNotNull(), F.concat(F.lit(" [arXiv "), found, F.lit("]"))).otherwise(
        F.concat(F.lit(" ["), url_host(url), F.lit("]"))
    )


def url_block_reason(url: Column) -> Column:
    """Why a url may not be fetched, judged from its text alone; null when it may.

    Name resolution is not done here: only literal addresses and local names are recognised.
    """
    scheme, host = url_scheme(url), url_host(url)
    v4 = host.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$")
    second = F.regexp_extract(host, r"^[0-9]+\.([0-9]+)\.", 1).try_cast("int")
    first = F.regexp_extract(host, r"^([0-9]+)\.", 1).try_cast("int")
    private4 = (
        (first == 10) | ((first == 172) & second.between(16, 31)) | ((first == 192) & (second == 168))
    )
    return (
        F.when(~scheme.isin("http", "https"), "scheme")
        .when(host == "", "no_host")
        .when((host == "localhost") | host.endswith(".localhost") | (v4 & (first == 127)) | (host == "::1"), "loopback")
        .when((v4 & (first == 169) & (second == 254)) | host.rlike(r"^fe[89ab][0-9a-f]:"), "link_local")
        .when((v4 & private4) | host.rlike(r"^f[cd][0-9a-f]{2}:"), "private")
        .when((v4 & first.between(224, 239)) | host.rlike(r"^ff[0-9a-f]{2}:"), "multicast")
        .when((v4 & ((first == 0) | (first >= 240))) | (host == "::"), "reserved")
    )
