"""URL functions: parts, canonical forms, platforms and identities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import let, low_key, strip

_URL = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"

# Platforms by host suffix, in the order they are tried.
PLATFORM_HOSTS = {
    "greenhouse": ("greenhouse.io",),
    "lever": ("lever.co",),
    "workday": ("myworkdayjobs.com", "myworkdaysite.com"),
    "ashby": ("ashbyhq.com",),
    "smartrecruiters": ("smartrecruiters.com",),
    "bamboohr": ("bamboohr.com",),
    "icims": ("icims.com", "jibeapply.com"),
    "jobvite": ("jobvite.com",),
    "phenom": ("phenompeople.com",),
    "jazzhr": ("jazzhr.com", "applytojob.com"),
    "recruitee": ("recruitee.com",),
    "comeet": ("comeet.com",),
    "breezyhr": ("breezy.hr",),
    "workable": ("workable.com",),
    "oracle_hcm": ("oraclecloud.com",),
    "rippling": ("ats.rippling.com",),
}
SLUG_SOURCES = ("ashby", "greenhouse", "lever", "rippling", "smartrecruiters", "workable")


def _part(url: Column, n: int) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, n)


def scheme(url: Column) -> Column:
    return F.lower(_part(url, 1))


def netloc(url: Column) -> Column:
    return F.lower(_part(url, 2))


def host(url: Column) -> Column:
    """Host in lower case, without user and port."""
    return F.regexp_replace(F.regexp_replace(netloc(url), "^.*@", ""), r":\d*$", "")


def bare_host(url: Column) -> Column:
    return F.regexp_replace(host(url), r"^www\.", "")


def path(url: Column) -> Column:
    return _part(url, 3)


def query(url: Column) -> Column:
    return _part(url, 4)


def segments(url: Column) -> Column:
    """Parts of the path that aren't empty."""
    return F.filter(F.split(path(url), "/"), lambda s: s != "")


def quote(c: Column) -> Column:
    """Percent-encoding of all but letters, digits and _.-~ ."""
    t = F.url_encode(c)
    for given, wanted in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        t = F.replace(t, F.lit(given), F.lit(wanted))
    return t


def unquote(c: Column) -> Column:
    """Percent-decoding; a plus stays, a text that can't be decoded stays."""
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def _assembled(url: Column, shown_path: Column) -> Column:
    asked = F.when(query(url) != "", F.concat(F.lit("?"), query(url))).otherwise("")
    return F.concat(F.when(scheme(url) != "", F.concat(scheme(url), F.lit(":"))).otherwise(""), F.when(netloc(url) != "", F.concat(F.lit("//"), netloc(url))).otherwise(""), shown_path, asked)


def normal_url(url: Column) -> Column:
    """Lower-case scheme and host, no slash at the path's end, query kept, fragment dropped."""
    return let(strip(url), lambda u: _assembled(u, F.regexp_replace(path(u), "/+$", "")))


def is_http(url: Column) -> Column:
    return scheme(url).isin("http", "https") & (netloc(url) != "")


def page_url(url: Column) -> Column:
    """As :func:`normal_url`, with runs of slashes as one and "/" for an empty path; '' unless http."""

    def shown(u: Column) -> Column:
        tidy = F.regexp_replace(F.regexp_replace(path(u), "/{2,}", "/"), "(?<=.)/+$", "")
        return F.when(is_http(u), _assembled(u, F.when(tidy == "", "/").otherwise(tidy))).otherwise("")

    return let(strip(url), shown)


def under(h: Column, *suffixes: str) -> Column:
    """The host is one of the suffixes or lies under one."""
    return h.isin(*suffixes) | F.exists(F.array(*map(F.lit, suffixes)), lambda s: F.endswith(h, F.concat(F.lit("."), s)))


def platform_of(url: Column) -> Column:
    """Platform by host suffix, or null."""
    return let(bare_host(url), lambda h: F.coalesce(*(F.when(under(h, *hosts), F.lit(name)) for name, hosts in PLATFORM_HOSTS.items())))


def _source(x: Column) -> Column:
    """Source of struct(host, query, low): host, query and path segments in lower case."""
    h, low = x["host"], x["low"]
    at = lambda n: F.coalesce(F.try_element_at(low, F.lit(n)), F.lit(""))
    has = lambda word: F.array_contains(low, word)
    n = F.size(low)
    return (
        F.when(F.contains(h, F.lit("myworkdayjobs.com")), "workday")
        .when(h.isin("jobs.lever.co", "jobs.eu.lever.co"), "lever")
        .when(h.isin("boards.greenhouse.io", "boards-api.greenhouse.io", "job-boards.greenhouse.io"), "greenhouse")
        .when((h == "jobs.ashbyhq.com") | ((h == "api.ashbyhq.com") & (n >= 3) & (at(1) == "posting-api") & (at(2) == "job-board")), "ashby")
        .when(F.endswith(h, F.lit(".icims.com")) | F.endswith(h, F.lit(".jibeapply.com")) | F.contains(x["query"], F.lit("icims=1")), "icims")
        .when(F.endswith(h, F.lit(".oraclecloud.com")) & has("candidateexperience") & has("sites"), "oracle_hcm")
        .when(h.isin("jobs.smartrecruiters.com", "careers.smartrecruiters.com") | ((h == "api.smartrecruiters.com") & has("companies")), "smartrecruiters")
        .when((h == "ats.rippling.com") & ((at(2) == "jobs") | (at(3) == "jobs")), "rippling")
        .when((h == "apply.workable.com") & (n > 0) & ((at(1) != "api") | ((n >= 4) & (at(2) == "v3") & (at(3) == "accounts"))), "workable")
    )


def _located(url: Column) -> Column:
    segs = segments(url)
    return F.struct(host(url).alias("host"), F.lower(query(url)).alias("query"), F.concat(scheme(url), F.lit("://"), netloc(url)).alias("root"), segs.alias("segs"), F.transform(segs, F.lower).alias("low"))


def source_of(url: Column) -> Column:
    """The supported source that a URL belongs to by host and path, or null."""
    return let(strip(url), lambda u: let(_located(u), _source))


def source_parts(url: Column) -> Column:
    """struct(source, tenant, site, slug, host, mode, language, canonical, error) of a catalog URL.

    Unsupported URLs have a null source; malformed ones an error and no canonical URL.
    """

    def found(x: Column) -> Column:
        return F.struct(_source(x).alias("source"), x["host"].alias("host"), x["root"].alias("root"), x["segs"].alias("segs"), x["low"].alias("low"), F.transform(x["segs"], lambda s: strip(unquote(s))).alias("plain"))

    def parts(x: Column) -> Column:
        src, h, low, plain, segs = (x[k] for k in ("source", "host", "low", "plain", "segs"))
        one = lambda a, n: F.nullif(strip(F.try_element_at(a, n if isinstance(n, Column) else F.lit(n))), F.lit(""))
        after = lambda word: F.when(F.array_contains(low, word), one(plain, (F.array_position(low, word) + 1).cast("int")))
        cut = F.array_min(F.filter(F.array(F.array_position(low, "job"), F.array_position(low, "details")), lambda i: i > 0))
        board = F.slice(segs, F.lit(1), F.coalesce((cut - 1).cast("int"), F.size(segs)))
        slug = (
            F.when(src == "lever", F.lower(one(segs, 1)))
            .when(src == "greenhouse", F.lower(F.when(h != "boards-api.greenhouse.io", one(segs, 1)).when((one(low, 1) == "v1") & (one(low, 2) == "boards"), one(segs, 3))))
            .when(src == "ashby", F.when(h == "jobs.ashbyhq.com", one(plain, 1)).otherwise(one(plain, 3)))
            .when(src == "smartrecruiters", F.when(h == "api.smartrecruiters.com", after("companies")).when((one(low, 1) == "oneclick-ui") & F.array_contains(low, "company"), after("company")).otherwise(one(plain, 1)))
            .when(src == "rippling", F.when(one(low, 2) == "jobs", one(plain, 1)).otherwise(one(plain, 2)))
            .when(src == "workable", F.when((F.size(segs) >= 4) & (one(low, 1) == "api"), one(plain, 4)).otherwise(one(plain, 1)))
        )
        return F.struct(
            src.alias("source"),
            x["root"].alias("root"),
            F.when(src == "workday", F.nullif(F.substring_index(h, ".", 1), F.lit(""))).alias("tenant"),
            F.when(src == "workday", one(board, -1)).when(src == "oracle_hcm", after("sites")).alias("site"),
            slug.alias("slug"),
            F.when(src.isin("icims", "oracle_hcm"), h).alias("host"),
            F.when(src == "icims", F.when(F.endswith(h, F.lit(".icims.com")), "classic").otherwise("jibe")).alias("mode"),
            F.when(src == "oracle_hcm", after("candidateexperience")).alias("language"),
            F.array_join(board, "/").alias("board"),
        )

    def whole(p: Column) -> Column:
        src, slug = p["source"], p["slug"]
        canonical = (
            F.when(src == "workday", F.when(p["tenant"].isNotNull() & p["site"].isNotNull(), F.concat(p["root"], F.lit("/"), p["board"])))
            .when(src == "lever", F.concat(p["root"], F.lit("/"), slug))
            .when(src == "greenhouse", F.concat(F.lit("https://boards.greenhouse.io/"), slug))
            .when(src == "ashby", F.concat(F.lit("https://jobs.ashbyhq.com/"), quote(slug)))
            .when(src == "icims", F.concat(F.lit("https://"), p["host"], F.when(p["mode"] == "classic", "/jobs/search").otherwise("?icims=1")))
            .when(src == "oracle_hcm", F.concat(F.lit("https://"), p["host"], F.lit("/hcmUI/CandidateExperience/"), quote(p["language"]), F.lit("/sites/"), quote(p["site"])))
            .when(src == "smartrecruiters", F.concat(F.lit("https://jobs.smartrecruiters.com/"), quote(slug)))
            .when(src == "rippling", F.concat(F.lit("https://ats.rippling.com/"), quote(slug), F.lit("/jobs")))
            .when(src == "workable", F.concat(F.lit("https://apply.workable.com/"), quote(slug)))
        )
        names = ("source", "tenant", "site", "slug", "host", "mode", "language")
        return let(F.struct(*(p[k].alias(k) for k in names), canonical.alias("canonical")), lambda y: F.struct(*(y[k].alias(k) for k in (*names, "canonical")), F.when(y["source"].isNotNull() & y["canonical"].isNull(), F.concat(F.lit("missing part of the "), y["source"], F.lit(" URL"))).alias("error")))

    return let(strip(url), lambda u: let(let(let(_located(u), found), parts), whole))


def identity(parts: Column, *, with_language: bool = True) -> Column:
    """Key of a source (an array of texts) from :func:`source_parts`, or null where a part is missing.

    Without ``with_language`` a missing language is ''.
    """
    return let(parts, lambda p: _key(p, with_language))


def _key(parts: Column, with_language: bool) -> Column:
    src = parts["source"]
    key = (
        F.when(src == "workday", F.array(src, F.lower(parts["tenant"]), low_key(parts["site"])))
        .when(src.isin(*SLUG_SOURCES), F.array(src, F.lower(parts["slug"])))
        .when(src == "icims", F.array(src, parts["mode"], parts["host"]))
        .when(src == "oracle_hcm", F.array(src, parts["host"], F.lower(parts["language"]) if with_language else F.coalesce(F.lower(parts["language"]), F.lit("")), F.lower(parts["site"])))
    )
    return let(key, lambda k: F.when(~F.exists(k, lambda x: x.isNull()), k))


def identity_text(key: Column) -> Column:
    return F.array_join(key, " :: ")


def identity_key(text: Column) -> Column:
    return F.transform(F.split(text, "::"), strip)
