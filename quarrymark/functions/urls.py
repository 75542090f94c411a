"""URLs and hosts, as Column expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import reference_data as R


def authority(url: Column) -> Column:
    """What stands between :// and the path, with port and user."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^:/?#]+://([^/?#]*)", 1)


def domain(url: Column, compat: bool = False) -> Column:
    """The authority without a leading www.; compat strips every leading w and dot, so web.ie loses its w."""
    own = authority(url)
    return F.regexp_replace(own, r"^[w.]+", "") if compat else F.regexp_replace(own, r"^www\.", "")


def third_piece(url: Column) -> Column:
    """The third of the pieces between slashes, or the empty string."""
    return F.coalesce(F.try_element_at(F.split(url, "/"), F.lit(3)), F.lit(""))


def tld(host: Column) -> Column:
    """The last label, or the last two where the second last is co, com, org or net."""
    parts = F.split(host, r"\.")
    two = (F.size(parts) >= 3) & F.element_at(parts, -2).isin(*R.SECOND_LEVEL)
    return F.when(two, F.array_join(F.slice(parts, -2, 2), ".")).otherwise(F.element_at(parts, -1))


def tld_bucket(host: Column) -> Column:
    """co.uk, com.au and co.nz by the host's end, else the last label."""
    out = F.when(F.lit(False), "")
    for end in ("co.uk", "com.au", "co.nz"):
        out = out.when(F.endswith(host, F.lit("." + end)), end)
    return out.otherwise(F.substring_index(host, ".", -1))


def under(host: Column, names: tuple[str, ...]) -> Column:
    """Is the host one of the names, or below one?"""
    return reduce(or_, [(host == n) | F.endswith(host, F.lit("." + n)) for n in names])


def ends_in(host: Column, suffixes: tuple[str, ...]) -> Column:
    return reduce(or_, [F.endswith(host, F.lit(s)) for s in suffixes])


def english_tld(url: Column, strict: bool = False) -> Column:
    return ends_in(F.lower(authority(url)), R.STRICT_SUFFIXES if strict else R.ENGLISH_SUFFIXES)


def known_english(url: Column) -> Column:
    return under(F.lower(authority(url)), R.KNOWN_ENGLISH)


def tld_filter(url: Column, name: str) -> Column:
    return under(F.lower(authority(url)), (name,))


def anywhere_filter(url: Column, name: str) -> Column:
    """Ends in .name, or has .name/ anywhere, in its path too."""
    return F.endswith(url, F.lit("." + name)) | F.contains(url, F.lit(f".{name}/"))


def uk_filter(url: Column) -> Column:
    return F.contains(url, F.lit(".co.uk")) | F.endswith(url, F.lit(".uk"))


def file_name(url: Column, style: str = "word") -> Column:
    """A name for files: "word" keeps word characters, "plain" replaces :// and /, "query" also ? and &."""
    if style == "word":
        return F.substring(F.regexp_replace(url, r"[^0-9A-Za-z_]", "_"), 1, 120)
    out = F.replace(F.replace(url, F.lit("://"), F.lit("_")), F.lit("/"), F.lit("_"))
    return F.substring(out, 1, 100) if style == "plain" else F.substring(F.translate(out, "?&", "__"), 1, 120)


def probable_type(url: Column) -> Column:
    """The first path pattern's type, else LocalBusiness."""
    out = F.when(F.lit(False), "")
    for pieces, kind, _ in R.PATH_TYPES:
        out = out.when(reduce(or_, [F.contains(url, F.lit(p)) for p in pieces]), kind)
    return out.otherwise("LocalBusiness")


def matching_types(url: Column) -> Column:
    """All types whose patterns fit, as an array."""
    kinds = [F.when(reduce(or_, [F.contains(url, F.lit(p)) for p in pieces]), F.lit(kind)) for pieces, kind, _ in R.PATH_TYPES]
    path = F.regexp_extract(url, r"^[^:/?#]+://[^/?#]*([^?#]*)", 1)
    kinds.append(F.when((path == "/") | F.contains(url, F.lit("/about")) | F.contains(url, F.lit("/services")), F.lit("LocalBusiness")))
    return F.array_compact(F.array(*kinds))


def wildcard(pattern: str) -> str:
    """A regular expression for a crawl pattern: * is anything, and a leading *. any host below."""
    body = "".join(".*" if c == "*" else "\\" + c if c in r".?+()[]{}^$|\\" else c for c in pattern.removeprefix("*."))
    lead = r"^[a-z]+://([^/]*\.)?" if pattern.startswith("*.") else r"^[a-z]+://"
    return lead + body + ("" if "/" in pattern else "(/.*)?") + "$"


def iri(token: Column) -> Column:
    return F.regexp_replace(token, "^[<>]+|[<>]+$", "")


def local_name(token: Column) -> Column:
    return F.substring_index(F.substring_index(iri(token), "/", -1), "#", -1)


def resolved_links(html: Column, base: Column) -> Column:
    """Double-quoted hrefs that are or become http URLs, in order."""
    scheme, host = F.regexp_extract(base, "^([^:/?#]+):", 1), authority(base)

    def resolve(x: Column) -> Column:
        return F.when(F.startswith(x, F.lit("//")), F.concat(scheme, F.lit(":"), x)).when(F.startswith(x, F.lit("/")), F.concat(scheme, F.lit("://"), host, x)).otherwise(x)

    return F.filter(F.transform(F.regexp_extract_all(html, F.lit('href="([^"]+)"'), F.lit(1)), resolve), lambda x: F.startswith(x, F.lit("http")))


#: Links to keep on known sites: a Column function of the URL each.
SITE_LINKS = {
    "biz": lambda u: F.contains(u, F.lit("/biz/")),
    "deep": lambda u: F.length(u) - F.length(F.replace(u, F.lit("/"), F.lit(""))) > 4,
    "listing": lambda u: F.contains(u, F.lit("/listing/")),
    "product": lambda u: F.contains(u, F.lit("/dp/")) | F.contains(u, F.lit("/gp/product/")) | F.contains(u, F.lit("/product/")),
    "item": lambda u: F.contains(u, F.lit("/itm/")),
    "event": lambda u: F.contains(u, F.lit("/e/")) | F.contains(u, F.lit("/events/")),
}


def _any(text: Column, words: tuple[str, ...]) -> Column:
    return reduce(or_, [F.contains(text, F.lit(w)) for w in words])


def on_site(url: Column, base: Column) -> Column:
    """Does the URL hold the base page's authority, anywhere?"""
    return F.contains(url, authority(base))


#: Links to keep by site: a Column function of the link and the page it stands on.
LINK_TESTS = {
    "yelp": lambda u, base: F.contains(u, F.lit("/biz/")) & F.contains(authority(u), authority(base)),
    "yell": lambda u, base: F.contains(u, F.lit("yell.com/biz/")),
    "goldenpages": lambda u, base: F.contains(u, F.lit("goldenpages.ie/")) & SITE_LINKS["deep"](u),
    "etsy": lambda u, base: F.contains(u, F.lit("etsy.com/listing/")),
    "amazon": lambda u, base: _any(u, ("/dp/", "/gp/product/")),
    "ebay": lambda u, base: F.contains(u, F.lit("/itm/")),
    "notonthehighstreet": lambda u, base: F.contains(u, F.lit("notonthehighstreet.com/")) & F.contains(u, F.lit("/product/")),
    "eventbrite": lambda u, base: F.contains(u, F.lit("/e/")) & F.contains(u, F.lit("eventbrite")),
    "meetup": lambda u, base: F.contains(u, F.lit("meetup.com/")) & F.contains(u, F.lit("/events/")),
    "wikihow": lambda u, base: F.contains(u, F.lit("wikihow.com/")) & ~F.contains(u, F.lit("/Category:")) & ~F.endswith(u, F.lit("wikihow.com/")) & ~F.endswith(u, F.lit("wikihow.com")),
    "checkatrade": lambda u, base: F.contains(u, F.lit("checkatrade.com/")) & F.contains(u, F.lit("/trades/")) & (u != base),
    "job": lambda u, base: on_site(u, base) & _any(F.lower(u), R.JOB_WORDS),
    "course": lambda u, base: on_site(u, base) & _any(F.lower(u), R.COURSE_WORDS),
}


def capped_links(links: Column, keep: Column, most: int) -> Column:
    """The first `most` distinct links of an array that are to be kept; keep: an array of booleans beside it."""
    both = F.filter(F.zip_with(links, keep, lambda x, k: F.when(k, x)), lambda x: x.isNotNull())
    return F.slice(F.array_distinct(both), 1, most)
