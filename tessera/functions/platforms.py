"""Hiring platforms behind a URL: by what key they know a company, and how sure a URL is as evidence.

Rules read the parts of a URL as plain columns, which :func:`with_parts` adds once per row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import let, low_key, strip
from tessera.functions.urls import PLATFORM_HOSTS, bare_host, netloc, path, quote, query, scheme, under, unquote

# Platforms with a connector, platforms without a route, and marks in URLs.
ROUTED = ("greenhouse", "lever", "ashby", "smartrecruiters", "workable", "workday", "icims", "oracle_hcm", "rippling")
UNROUTED = ("recruitee", "breezyhr", "bamboohr", "comeet")
LISTED = ("greenhouse", "lever", "ashby", "smartrecruiters", "workday", "icims", "jobvite", "bamboohr", "workable", "recruitee", "comeet", "oracle_hcm", "rippling")
UNSUPPORTED = ("breezyhr", "phenom", "jazzhr")
ASSETS = (".pdf", ".jpg", ".jpeg", ".png", ".gif", ".webp", ".svg", ".ico", ".zip", ".css", ".js", ".map", ".woff", ".woff2", ".ttf", ".eot", ".mp4", ".webm")
GREENHOUSE_NOISE = ("/plans/", "/approvals/", "/admin/", "/internal/", "/users/sign_in", "/dashboard/")
PHENOM_MARKS = ("/api/", "/search", "/jobs", "/job/", "jobsearch", "requisition")
PHENOM_API_MARKS = ("/api/", "jobsearch", "/search", "requisition")
WORKDAY_NOISE = ("/assets/", "/login", "/introduceyourself", "/userhome", "/wday/asset/")
CAREER_MARKERS = ("careers", "career", "jobs", "job", "positions", "position", "openings", "opening")
CAREER_NEXT = ("search", "all", "open", "openings", "positions")
CAREER_HINTS = ("career", "careers", "job", "jobs", "position", "positions", "opening")
ROLES = r"\b(intern|graduate|developer|engineer|scientist|analyst|architect|designer|administrator|specialist|coordinator|researcher|manager|consultant|technician|programmer|product owner)\b"
TEMPLATE_MARKS = ("{{", "}}", "${", "<%", "%3c", "%7b")
INTERNAL_HOSTS = ("employee", "employees", "internal", "globalemployee", "globalemployees")
TRIAL_HOSTS = ("dev", "stage", "staging", "test")

Parts = Callable[[str], Column]


def has_any(text: Column, marks: tuple[str, ...]) -> Column:
    """The text holds one of the marks, each taken literally."""
    found = F.lit(False)
    for mark in marks:
        found = found | F.contains(text, F.lit(mark))
    return found


def with_parts(rows: DataFrame, url: str, prefix: str = "u_") -> tuple[DataFrame, Parts]:
    """``rows`` with the parts of a URL column, and how to name them: url, low_url, scheme, netloc, host, path, low_path, query, segs, low.

    ``segs`` are the path's segments, decoded; ``low`` the same in lower case.
    """
    u = F.col(url)
    shown, low = F.col(f"{prefix}path"), F.col(f"{prefix}segs")
    # Generators of one row, as in tessera.functions.text.once, of several columns each.
    added = lambda rows, **columns: rows.select("*", F.inline(F.array(F.struct(*(c.alias(f"{prefix}{k}") for k, c in columns.items())))))
    rows = added(rows, scheme=scheme(u), netloc=netloc(u), host=bare_host(u), path=path(u), query=query(u), url=u, low_url=F.lower(u))
    segments = F.filter(F.split(shown, "/"), lambda s: s != "")
    rows = added(rows, segs=F.transform(F.when(F.contains(shown, F.lit("%")), F.transform(segments, unquote)).otherwise(segments), strip), low_path=F.lower(shown))
    rows = added(rows, low=F.transform(low, F.lower))
    return rows, lambda name: F.col(f"{prefix}{name}")


def without_parts(rows: DataFrame, prefix: str = "u_") -> DataFrame:
    return rows.drop(*(c for c in rows.columns if c.startswith(prefix)))


def platform(x: Parts, names: tuple[str, ...] = tuple(PLATFORM_HOSTS)) -> Column:
    """The platform by host suffix among ``names``, or ''."""
    return F.coalesce(*(F.when(under(x("host"), *PLATFORM_HOSTS[name]), F.lit(name)) for name in names), F.lit(""))


def has_job_id(x: Parts) -> Column:
    """The query names a posting by a filled gh_jid."""
    return x("query").rlike("(?i)(?:^|&)gh_jid=[^&]+")


def is_asset(x: Parts) -> Column:
    return x("low_path").rlike("(?:" + "|".join(e.replace(".", r"\.") for e in ASSETS) + ")$")


def is_noisy(x: Parts) -> Column:
    """An internal page of one platform's own tools."""
    return F.endswith(x("host"), F.lit(".greenhouse.io")) & (F.endswith(x("low_path"), F.lit("/jobapp")) | has_any(x("low_path"), GREENHOUSE_NOISE))


def is_evidence(source: Column, x: Parts) -> Column:
    """The URL really speaks for the platform ``source``."""
    return (
        F.when(is_asset(x), False)
        .when(has_job_id(x), True)
        .when(F.contains(x("low_url"), F.lit("gh_jid=")), False)
        .when(source == "phenom", has_any(x("low_url"), PHENOM_MARKS))
        .when(source == "bamboohr", F.contains(x("low_path"), F.lit("/careers")))
        .when((source == "workday") & has_any(x("low_path"), WORKDAY_NOISE), False)
        .otherwise(source != "")
    )


def source_key(source: Column, x: Parts) -> Column:
    """What the platform knows the company by, or ''."""
    h, q, low, segs = x("host"), x("query"), x("low"), x("segs")
    at = lambda n: F.try_element_at(low, F.lit(n))
    after = lambda word, values=low: F.when(F.array_contains(low, word), F.try_element_at(values, (F.array_position(low, word) + 1).cast("int")))
    prefix = lambda suffix: F.when(F.endswith(h, F.lit(suffix)), F.regexp_replace(h, suffix.replace(".", r"\.") + "$", ""))
    asked = lambda pattern: F.lower(strip(unquote(F.nullif(F.regexp_extract(q, pattern, 1), F.lit("")))))
    cut = F.array_min(F.filter(F.transform(low, lambda s, i: F.when(s.isin("job", "details"), i)), lambda i: i.isNotNull()))
    site = F.try_element_at(F.slice(low, F.lit(1), F.coalesce(cut, F.size(low))), F.lit(-1))
    tenant = F.substring_index(h, ".", 1)
    given = (
        F.when(source == "greenhouse", F.coalesce(F.nullif(asked("(?i)(?:^|&)for=([^&]+)"), F.lit("")), after("boards"), F.when(h.isin("boards.greenhouse.io", "job-boards.greenhouse.io") & (at(1) != "embed"), at(1))))
        .when(source == "lever", F.when(h.isin("jobs.lever.co", "jobs.eu.lever.co"), at(1)).when((h == "api.lever.co") & (at(1) == "v0") & (at(2) == "postings"), at(3)))
        .when(source == "ashby", F.when(h == "jobs.ashbyhq.com", at(1)).when(h == "api.ashbyhq.com", after("job-board")))
        .when(source == "smartrecruiters", F.when(h.isin("jobs.smartrecruiters.com", "careers.smartrecruiters.com") & (F.size(low) > 0), F.coalesce(F.when(at(1) == "oneclick-ui", after("company")), at(1))).otherwise(after("companies")))
        .when(source == "workable", F.when(h == "apply.workable.com", F.when((at(1) == "api") & (at(2) == "v3") & (at(3) == "accounts"), at(4)).when(at(1) != "api", at(1))))
        .when(source == "recruitee", F.when(~prefix(".recruitee.com").isin("www", "careers"), prefix(".recruitee.com")))
        .when(source == "breezyhr", prefix(".breezy.hr"))
        .when(source == "bamboohr", prefix(".bamboohr.com"))
        .when(source == "comeet", F.coalesce(F.nullif(asked("(?i)(?:company|company_uid)=([^&]+)"), F.lit("")), after("jobs")))
        .when(source == "icims", F.when(F.endswith(h, F.lit(".icims.com")) | F.endswith(h, F.lit(".jibeapply.com")), h))
        .when(source == "workday", F.when(F.endswith(h, F.lit(".myworkdayjobs.com")) | F.endswith(h, F.lit(".myworkdaysite.com")), F.concat_ws(":", tenant, F.nullif(site, F.lit("")))))
        .when(source == "oracle_hcm", F.when(F.endswith(h, F.lit(".oraclecloud.com")) & after("candidateexperience").isNotNull() & after("sites").isNotNull(), F.concat_ws(":", h, after("candidateexperience", segs), after("sites", segs))))
        .when(source == "rippling", F.when(h == "ats.rippling.com", F.when(at(2) == "jobs", F.try_element_at(segs, F.lit(1))).when(at(3) == "jobs", F.try_element_at(segs, F.lit(2)))))
    )
    return F.coalesce(given, F.lit(""))


def canonical_url(source: Column, key: Column, host: Column, url: Column) -> Column:
    """Where the platform lists the company's postings; the evidence's own URL where no pattern is known."""
    part = lambda n: F.nullif(F.get(F.split(key, ":"), F.lit(n)), F.lit(""))
    rest = F.nullif(F.regexp_extract(key, "^[^:]*:[^:]*:(.*)$", 1), F.lit(""))
    made = (
        F.when(source == "greenhouse", F.concat(F.lit("https://boards-api.greenhouse.io/v1/boards/"), key, F.lit("/jobs")))
        .when(source == "lever", F.concat(F.lit("https://api.lever.co/v0/postings/"), key, F.lit("?mode=json")))
        .when(source == "ashby", F.concat(F.lit("https://api.ashbyhq.com/posting-api/job-board/"), quote(key), F.lit("?includeCompensation=false")))
        .when(source == "smartrecruiters", F.concat(F.lit("https://api.smartrecruiters.com/v1/companies/"), key, F.lit("/postings")))
        .when(source == "workable", F.concat(F.lit("https://apply.workable.com/api/v3/accounts/"), key, F.lit("/jobs")))
        .when(source == "recruitee", F.concat(F.lit("https://"), key, F.lit(".recruitee.com")))
        .when(source == "breezyhr", F.concat(F.lit("https://"), key, F.lit(".breezy.hr")))
        .when(source == "bamboohr", F.concat(F.lit("https://"), key, F.lit(".bamboohr.com/careers")))
        .when(source == "workday", F.concat(F.lit("https://"), host, F.lit("/wday/cxs/"), part(0), F.lit("/"), part(1), F.lit("/jobs")))
        .when((source == "icims") & F.endswith(key, F.lit(".icims.com")), F.concat(F.lit("https://"), key, F.lit("/jobs/search")))
        .when((source == "icims") & F.endswith(key, F.lit(".jibeapply.com")), F.concat(F.lit("https://"), key, F.lit("?icims=1")))
        .when(source == "oracle_hcm", F.concat(F.lit("https://"), part(0), F.lit("/hcmUI/CandidateExperience/"), quote(part(1)), F.lit("/sites/"), quote(rest)))
        .when(source == "rippling", F.concat(F.lit("https://ats.rippling.com/"), quote(key), F.lit("/jobs")))
    )
    return F.coalesce(made, url)


def route_block(source: Column, key: Column) -> Column:
    """Why no connector can be run for the candidate, '' if one can."""
    # The texts.
    return (
        F.when(key == "", "No reliable ATS source key was extracted")
        .when(source.isin(*ROUTED), "")
        .when(source == "phenom", "No supported public Phenom job-search endpoint was identified")
        .when(source.isin(*UNROUTED), F.concat(F.lit("No existing extraction route for "), source))
        .otherwise(F.concat(F.lit("No known extraction route for "), source))
    )


def quality(source: Column, x: Parts) -> Column:
    """How good a URL is as the one to keep of a candidate's, 0 to 5."""
    low = x("low_url")
    general = F.when(F.contains(low, F.lit("/api/")), 4).otherwise(2)
    return (
        F.when(source == "greenhouse", F.when(is_noisy(x), 0).when(has_any(low, ("boards-api.greenhouse.io/", "api.greenhouse.io/")), 5).when(F.contains(low, F.lit("embed/job_board/js")), 4).when(has_any(low, ("job-boards.greenhouse.io/", "boards.greenhouse.io/")), 3).when(has_job_id(x), 1).otherwise(general))
        .when((source == "lever") & F.contains(low, F.lit("api.lever.co/v0/postings/")), 5)
        .when((source == "lever") & has_any(low, ("jobs.lever.co/", "jobs.eu.lever.co/")), 4)
        .otherwise(general)
    )


def action(source: Column, ready: Column) -> Column:
    """What to do with a candidate."""
    return (
        F.when(source == "phenom", "future_phenom_adapter")
        .when(source == "breezyhr", F.when(ready, "custom_ats_adapter_needed").otherwise("manual_review"))
        .when(source.isin(*LISTED), F.when(ready, "validate_with_existing_ats_scraper").otherwise("add_to_existing_ats_csv_later"))
        .otherwise("unsupported_for_now")
    )


def is_posting(x: Parts) -> Column:
    """The URL is one posting's: an id in the query, a number or UUID at the end, or a long slug with a role."""
    last = F.lower(F.try_element_at(F.filter(F.split(x("path"), "/"), lambda s: s != ""), F.lit(-1)))
    before = F.slice(x("low"), F.lit(1), F.greatest(F.size(x("low")) - 1, F.lit(0)))
    under_jobs = F.arrays_overlap(before, F.array(*map(F.lit, ("job", "jobs", "position", "positions"))))
    slug = under_jobs & (F.length(last) - F.length(F.replace(last, F.lit("-"), F.lit(""))) >= 4) & F.replace(last, F.lit("-"), F.lit(" ")).rlike(f"(?i){ROLES}")
    return F.coalesce(F.lower(x("query")).rlike("(gh_jid|job[_-]?id|requisition|reqid)=") | last.rlike(r"^\d{4,}$|^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$") | slug, F.lit(False))


def looks_like_careers(x: Parts) -> Column:
    return has_any(F.lower(F.concat_ws(" ", F.regexp_replace(F.regexp_replace(x("netloc"), "^.*@", ""), r":\d*$", ""), x("path"), x("query"))), CAREER_HINTS)


def career_page(x: Parts) -> Column:
    """The page of openings that a URL lies under: its path up to the first marker, or the URL itself."""
    raw = F.filter(F.split(x("path"), "/"), lambda s: s != "")
    low = F.transform(raw, F.lower)
    root = F.concat(x("scheme"), F.lit("://"), x("netloc"))

    def upto(marker: str) -> Column:
        i = F.array_position(low, marker).cast("int")
        longer = F.coalesce(F.try_element_at(low, i + 1).isin(*CAREER_NEXT), F.lit(False))
        return F.when(i > 0, F.concat(root, F.lit("/"), F.array_join(F.slice(raw, F.lit(1), i + longer.cast("int")), "/")))

    bare = F.when(has_any(F.lower(x("query")), ("gh_jid=", "job_id=", "jobid=", "reqid=")), F.concat(root, x("path")))
    return F.coalesce(*(F.when(F.array_contains(low, m), upto(m)) for m in CAREER_MARKERS), bare, x("url"))


def source_type(x: Parts) -> Column:
    return F.when(platform(x, UNSUPPORTED) != "", "unsupported_url").when(F.contains(x("low_url"), F.lit("gh_jid=")), "branded_ats_page").when(looks_like_careers(x), "custom_career_page").otherwise("unknown_career_page")


def has_template(url: Column) -> Column:
    return has_any(F.lower(url), TEMPLATE_MARKS)


def is_public(source: Column, x: Parts) -> Column:
    """The host is a public one; only two platforms have others."""
    h = F.regexp_replace(F.regexp_replace(x("netloc"), "^.*@", ""), r":\d*$", "")
    first = F.substring_index(h, ".", 1)
    inside = F.lit(False)
    for name in INTERNAL_HOSTS:
        inside = inside | F.startswith(first, F.lit(name))
    icims = (h != "") & ~h.isin("icims.com", "www.icims.com", "login.icims.com") & ~F.contains(h, F.lit(".staging.")) & ~inside
    return F.when(source == "icims", icims).when(source == "oracle_hcm", (h != "") & ~has_any(first, TRIAL_HOSTS)).otherwise(True)


def brand_of(host: Column) -> Column:
    """The host's first label as a key to compare with a company's name."""
    return F.regexp_replace(low_key(F.coalesce(F.substring_index(host, ".", 1), F.lit(""))), "[^a-z0-9]", "")


def group_key(x: Parts) -> Column:
    """What career pages of one company are one place by: the host, and on four platforms their board."""
    h, low = x("host"), x("low")
    after = lambda word: F.coalesce(F.try_element_at(low, (F.array_position(low, word) + 1).cast("int")), F.lit(""))
    return (
        F.when(F.endswith(h, F.lit(".taleo.net")) & F.array_contains(low, "careersection"), F.array(h, F.lit("taleo"), after("careersection")))
        .when(F.contains(h, F.lit("ultipro.")) & F.array_contains(low, "jobboard"), F.array(h, F.lit("ultipro"), low[0], after("jobboard")))
        .when(F.endswith(h, F.lit(".applytojob.com")), F.array(h, F.lit("jazzhr")))
        .when((h == "app.careerpuck.com") & F.array_contains(low, "job-board"), F.array(h, F.lit("careerpuck"), after("job-board")))
        .otherwise(F.array(h, F.lit("company_host")))
    )


def group_url(x: Parts) -> Column:
    """The URL that stands for a group of :func:`group_key`."""
    h, low = x("host"), x("low")
    raw = F.filter(F.split(x("path"), "/"), lambda s: s != "")
    root = F.concat(x("scheme"), F.lit("://"), x("netloc"), F.lit("/"))
    board = lambda word: F.when((F.array_position(low, word) > 0) & (F.array_position(low, word) < F.size(low)), F.concat(root, F.array_join(F.slice(raw, F.lit(1), (F.array_position(low, word) + 1).cast("int")), "/")))
    return F.coalesce(
        F.when(F.endswith(h, F.lit(".taleo.net")), F.concat(board("careersection"), F.lit("/jobsearch.ftl"))),
        F.when(F.contains(h, F.lit("ultipro.")), board("jobboard")),
        F.when(F.endswith(h, F.lit(".applytojob.com")), F.concat(root, F.lit("apply"))),
        F.when(h == "app.careerpuck.com", board("job-board")),
        x("url"),
    )


def workday_board(key: Column, x: Parts) -> Column:
    """The board's URL of a workday candidate with source key "tenant:site", or '' where it is none."""
    # Segments that no board's path has.
    bad = ("asset", "assets", "candidate-experience-jobs", "client-analytics", "introduceyourself", "login", "logo", "jobs", "uic-shared-vendors", "userhome")
    raw = F.filter(F.split(x("path"), "/"), lambda s: s != "")
    low = F.transform(raw, lambda s: F.rtrim(F.lower(s), F.lit("&")))
    site = low_key(F.regexp_extract(key, "^[^:]*:(.*)$", 1))

    def cut(both: Column) -> Column:
        low = both["low"]
        end = F.coalesce(*(F.when(F.array_contains(low, m), F.array_position(low, m) - 1) for m in ("job", "details")), F.size(low).cast("long")).cast("int")
        kept = F.slice(low, F.lit(1), end)
        last = F.size(kept) - F.coalesce(F.nullif(F.array_position(F.reverse(kept), site), F.lit(0)).cast("int"), F.size(kept) + 1) + 1
        good = (F.size(kept) > 0) & ~F.exists(F.slice(both["raw"], F.lit(1), end), lambda s: F.contains(s, F.lit("&"))) & F.contains(key, F.lit(":")) & ~site.isin(*bad) & (last > 0)
        return F.when(good, F.array_join(F.slice(both["raw"], F.lit(1), F.greatest(last, F.lit(0))), "/"))

    board = let(F.struct(raw.alias("raw"), low.alias("low")), cut)
    fits = F.contains(x("host"), F.lit("myworkdayjobs.com")) & ~F.arrays_overlap(low, F.array(*map(F.lit, bad)))
    return F.coalesce(F.when(fits, F.concat(x("scheme"), F.lit("://"), x("netloc"), F.lit("/"), board)), F.lit(""))
