"""Repository URL expressions (all JVM-side)."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters left as they are when quoting a repository URL
# (unreserved characters plus this extra set).
QUOTE_EXTRA_SAFE = "/:!$&'()*+,=@"
UNRESERVED = string.ascii_letters + string.digits + "_.-~"
SAFE_HEX = sorted({format(ord(c), "02X") for c in UNRESERVED + QUOTE_EXTRA_SAFE})
# Dump loading errors after which a partial load is kept.
PARTIAL_LOAD_CODES = ("E000002", "E160013", "E200014")


#: Urls that quoting leaves as they are.
QUOTED = r"\A[A-Za-z0-9_.~/:!$&'()*+,=@-]*\z"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def url_quote(url: Column) -> Column:
    """Percent-encode every byte outside the safe set (``%`` included)."""
    safe = F.array(*[F.lit(x) for x in SAFE_HEX])

    def quoted(h: Column) -> Column:
        pieces = F.transform(F.sequence(F.lit(0), (F.length(h) / 2).cast("int") - 1), lambda i: F.substring(h, i * 2 + 1, 2))
        return F.array_join(F.transform(pieces, lambda p: F.when(
            F.array_contains(safe, p), F.decode(F.unhex(p), "UTF-8")).otherwise(F.concat(F.lit("%"), p))), "")

    return let(url, lambda u: F.when(u.isNull(), F.lit(None)).when(u.rlike(QUOTED), u).otherwise(
        let(F.hex(F.encode(u, "UTF-8")), quoted)))


def url_unquote(url: Column) -> Column:
    """Percent-decoding that leaves ``+`` as it is."""
    return F.try_url_decode(F.replace(url, F.lit("+"), F.lit("%2B")))


def url_netloc(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def url_scheme(url: Column) -> Column:
    return F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def normalize_path(path: Column) -> Column:
    """Absolute POSIX normalisation: drop empty and ``.`` segments, let ``..``
    remove the previous one (never above the root), no trailing slash."""
    segs = F.split(path, "/")
    stack = F.aggregate(
        segs, F.array().cast("array<string>"),
        lambda acc, s: F.when((s == "") | (s == "."), acc)
        .when(s == "..", F.when(F.size(acc) > 0, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc))
        .otherwise(F.concat(acc, F.array(s))))
    return F.concat(F.lit("/"), F.array_join(stack, "/"))


def url_join(base: Column, *parts: Column) -> Column:
    """Join path parts (each stripped of ``/``) onto a URL and normalise;
    scheme and host are kept, query and fragment of the base are not."""
    joined = let(url_path(base), lambda path: F.when(path == "", F.lit("/")).otherwise(path))
    for p in parts:
        stripped = F.regexp_replace(p, r"^/+|/+$", "")
        joined = F.concat(let(joined, lambda j: F.concat(j, F.when(j.endswith("/"), "").otherwise("/"))), stripped)
    return F.concat(url_scheme(base), F.lit("://"), url_netloc(base), normalize_path(joined))


def root_url_candidates(url: Column) -> Column:
    """The url and each shorter ``/``-prefix, longest first."""
    parts = F.split(url, "/")
    n = F.size(parts)
    return F.transform(F.sequence(F.lit(0), n - 1),
                       lambda i: F.array_join(F.slice(parts, 1, n - i), "/"))


def strip_credentials(url: Column) -> Column:
    """struct(username, url) with the user part removed from the url."""
    userinfo = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#@]*)@", 1)
    user = F.nullif(F.regexp_extract(userinfo, r"^([^:]*)", 1), F.lit(""))
    clean = F.regexp_replace(url, r"^([A-Za-z][A-Za-z0-9+.-]*://)[^/?#@]*@", "$1")
    return F.struct(F.try_url_decode(user).alias("username"), clean.alias("url"))


def dump_name(url: Column) -> Column:
    return F.regexp_replace(url, r"[^\p{L}\p{N}]", "")


def is_recursive_external(origin_url: Column, dir_path: Column, ext_path: Column,
                          ext_url: Column) -> Column:
    """Host path strictly below the external url, scheme taken from the origin."""
    ext = url_quote(F.concat(url_scheme(origin_url), F.regexp_replace(ext_url, r"^[A-Za-z][A-Za-z0-9+.-]*:", ":")))
    ext = F.regexp_replace(ext, "/+$", "")
    host = url_join(origin_url, url_quote(dir_path), url_quote(ext_path))
    both = F.struct(host.alias("host"), ext.alias("ext"))
    return let(both, lambda b: (F.regexp_replace(b["host"], "/+$", "") != b["ext"])
               & b["host"].startswith(F.concat(b["ext"], F.lit("/"))))


def alternate_urls(url: Column, fast_host: str, fast_scheme: str = "svn") -> Column:
    """Candidate URLs in the order to try: for ``fast_host`` reached over
    http(s), the same URL over ``fast_scheme`` first."""
    swapped = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*:", fast_scheme + ":")
    eligible = (url_netloc(url) == fast_host) & url_scheme(url).startswith("http")
    return F.when(eligible, F.array(swapped, url)).otherwise(F.array(url))


# Error message patterns carrying a redirection target.
REDIRECT_PATTERNS = (r"^URL '(.+)' non-existent in revision.*$",
                     r"^Repository moved temporarily to '(.+)'.*$")


def redirect_target(message: Column) -> Column:
    a, b = (F.nullif(F.regexp_extract(message, p, 1), F.lit("")) for p in REDIRECT_PATTERNS)
    return F.coalesce(a, b)


def root_directory(origin_url: Column, root_url: Column) -> Column:
    """Origin url minus the repository root url (schemes aligned), without
    surrounding slashes."""
    o = F.regexp_replace(origin_url, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    r = F.regexp_replace(root_url, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    rest = F.when(o.startswith(r), F.substring(o, F.length(r) + 1, 1 << 30)).otherwise(o)
    return F.regexp_replace(rest, "^/+|/+$", "")
