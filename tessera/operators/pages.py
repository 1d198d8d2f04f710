"""Links in pages, evidence of platforms, candidates of sources, and pages worth reading next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import platforms as p
from tessera.functions.text import alphanumeric, let, once, slug, strip
from tessera.functions.urls import bare_host, is_http, netloc, page_url, path, platform_of, scheme, under
from tessera.sources.markup import LINKED, read_links

# Words in links that lead to openings, and links to pass over.
HINTS = ("career", "careers", "job", "jobs", "opening", "openings", "position", "positions", "engineering", "technology", "software", "security", "intern", "student", "graduate", "new-grad")
STRONG_HINTS = ("job", "jobs", "opening", "openings", "position", "positions")
SKIP_HINTS = ("login", "log-in", "signin", "sign-in", "privacy", "legal", "terms", "cookie", "blog", "news", "press")
SOFT_SKIP_HINTS = ("benefit", "culture", "team", "life-at", "life at")
SOCIAL_HOSTS = ("facebook.com", "instagram.com", "linkedin.com", "tiktok.com", "twitter.com", "x.com", "youtube.com")
SKIP_EXTENSIONS = (".pdf", ".jpg", ".jpeg", ".png", ".gif", ".webp", ".svg", ".ico", ".zip")
#: Kinds of links by the name of the method, in the order in which equal evidence counts.
_METHODS = {"a": "link", "script": "script_src", "iframe": "iframe", "form": "form_action", "inline": "inline_script", "written": "embedded_url"}
_RANKS = {"low": 1, "medium": 2, "high": 3}


def _without_dots(c: Column) -> Column:
    """A rooted path without "." and ".." segments; ".." at the top is dropped."""
    last = F.element_at(F.split(c, "/"), -1)
    kept = F.aggregate(
        F.slice(F.split(c, "/"), 2, F.size(F.split(c, "/"))),
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == ".", acc).when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(s))),
    )
    folder = F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.when(c.rlike(r"(?:^|/)\.\.?(?:/|$)"), F.concat(F.lit("/"), F.array_join(folder, "/"))).otherwise(c)


def resolved(base: Column, link: Column) -> Column:
    """A link against its page's URL: absolute, scheme-relative, rooted, or relative to the folder."""

    def against(x: Column) -> Column:
        t, root = x["link"], F.concat(x["scheme"], F.lit("://"), x["netloc"])
        folder = F.regexp_replace(F.when(x["path"] == "", "/").otherwise(x["path"]), "[^/]*$", "")
        shown, rest = F.regexp_extract(t, "^([^?#]*)", 1), F.regexp_extract(t, "^[^?#]*(.*)$", 1)
        return (
            F.when(t.rlike(r"(?i)^[a-z][a-z0-9+.-]*:"), t)
            .when(F.startswith(t, F.lit("//")), F.concat(x["scheme"], F.lit(":"), t))
            .when(F.startswith(t, F.lit("/")), F.concat(root, _without_dots(shown), rest))
            .when(t.rlike(r"^(?:[?#]|$)"), F.concat(root, x["path"], t))
            .otherwise(F.concat(root, _without_dots(F.concat(folder, shown)), rest))
        )

    return let(F.struct(scheme(base).alias("scheme"), netloc(base).alias("netloc"), path(base).alias("path"), strip(link).alias("link")), against)


def _carried(links: DataFrame) -> list[str]:
    """What :func:`read_links` passes on of its pages, but for the page itself."""
    return [c for c in links.columns if c not in ("page", "kind", "link", "url", "text", "pos")]


def tag_links(pages: DataFrame) -> DataFrame:
    """(..., page, tag, link, url) of a@href, script@src, iframe@src and form@action of pages (url, html, ...)."""
    rows = read_links(pages).filter(F.col("kind").isin(*LINKED) & (F.col("link") != ""))
    return once(rows, "url", page_url(F.col("url"))).select(*_carried(rows), "page", F.col("kind").alias("tag"), "link", "url")


def evidence(links: DataFrame) -> DataFrame:
    """(..., page, source, url, method, confidence): URLs of known platforms among links of :func:`read_links`, each once per page.

    Tags are of high confidence, URLs in scripts and anywhere else medium, and so is a posting's id
    on a host of no platform; of equal ones the first method stays.
    """
    keep = _carried(links)
    nth = F.array_position(F.array(*map(F.lit, _METHODS)), F.col("kind"))
    rows = links.filter("link <> ''").select(*keep, "page", "url", nth.alias("nth")).groupBy(*keep, "page", "url").agg(F.min("nth").alias("nth"))
    rows, x = p.with_parts(once(rows, "url", page_url(F.col("url"))).filter("url <> ''"), "url")
    rows = once(rows, "source", p.platform(x))
    branded = (F.col("source") == "") & F.contains(x("low_url"), F.lit("gh_jid="))
    rows = rows.withColumn("rank", F.when(branded | (F.col("nth") > len(LINKED)), 2).otherwise(3)).withColumn("source", F.when(branded, "greenhouse").otherwise(F.col("source")))
    rows = p.without_parts(rows.filter((F.col("source") != "") & p.is_evidence(F.col("source"), x)))
    best = rows.groupBy(*keep, "page", "source", "url").agg(F.min(F.struct((-F.col("rank")).alias("r"), "nth")).alias("b"))
    method = F.element_at(F.array(*map(F.lit, _METHODS.values())), F.col("b.nth").cast("int"))
    return best.select(*keep, "page", "source", "url", method.alias("method"), F.when(F.col("b.r") == -3, "high").otherwise("medium").alias("confidence"))


def url_evidence(rows: DataFrame, method: Column) -> DataFrame:
    """As :func:`evidence`, of URLs themselves: rows (page, url, ...)."""
    rows, x = p.with_parts(once(rows, "url", page_url(F.col("url"))), "url")
    rows = once(rows, "source", p.platform(x))
    branded = (F.col("source") == "") & F.contains(x("low_url"), F.lit("gh_jid="))
    rows = rows.withColumns({"method": method, "confidence": F.when(branded, "medium").otherwise("high"), "source": F.when(branded, "greenhouse").otherwise(F.col("source"))})
    return p.without_parts(rows.filter((F.col("source") != "") & p.is_evidence(F.col("source"), x)))


def source_candidates(found: DataFrame) -> DataFrame:
    """Candidates of evidence (company, original_url, source, url, confidence, nth): one per platform and key.

    Evidence without a key takes the platform's key if the company has just one; a company whose own
    host, named like it, carries posting ids is taken for that platform's key of the same name.  Of a
    candidate's URLs the best one stays: by quality, confidence, shortness, and ``nth``.
    """
    rows, x = p.with_parts(found, "url")
    source, who = F.col("source"), ["company", "original_url"]
    rows = once(rows.filter(p.is_evidence(source, x)), "_key", F.nullif(p.source_key(source, x), F.lit(""))).withColumns({"_quality": p.quality(source, x), "_job_id": p.has_job_id(x)})
    own = Window.partitionBy(*who, "source")
    marked = p.has_any(x("low_path"), ("/job", "/career", "/apply"))
    rows = rows.withColumns({
        "_least": F.min("_key").over(own),
        "_most": F.max("_key").over(own),
        "_host": F.min(F.when(F.col("_job_id"), x("host"))).over(own),
        "_hosts": F.max(F.when(F.col("_job_id"), x("host"))).over(own),
        "_marked": F.min(F.when(F.col("_job_id"), marked)).over(own),
    })
    brand = alphanumeric(F.col("company"))
    branded = (source == "greenhouse") & F.col("_least").isNull() & (F.col("_host") == F.col("_hosts")) & (F.col("_host") == bare_host(F.col("original_url"))) & F.col("_marked") & (brand != "") & (p.brand_of(F.col("_host")) == brand)
    key = F.coalesce("_key", F.when(F.col("_least") == F.col("_most"), F.col("_least")), F.when(branded, brand), F.when(source == "phenom", F.nullif(slug(F.col("company")), F.lit("unknown"))))
    rows = rows.withColumn("source_key", key).filter("source_key IS NOT NULL")
    rank = F.coalesce(*(F.when(F.col("confidence") == k, v) for k, v in _RANKS.items()), F.lit(0))
    order = F.struct((-F.col("_quality")).alias("q"), (-rank).alias("r"), F.length("url").alias("l"), "nth", "url")
    kept = rows.groupBy(*who, "source", "source_key").agg(F.count(F.lit(1)).alias("evidence_count"), F.min_by(F.struct("url", "confidence", x("host").alias("host")), order).alias("b"), F.max(p.has_any(x("low_url"), p.PHENOM_API_MARKS)).alias("_api"))
    block = p.route_block(source, F.col("source_key"))
    silent = (source == "phenom") & ~F.col("_api")
    ready = (block == "") & ~silent
    return kept.select(
        *who,
        source.alias("detected_source"),
        "source_key",
        p.canonical_url(source, F.col("source_key"), F.col("b.host"), F.col("b.url")).alias("canonical_ats_url"),
        "evidence_count",
        F.col("b.url").alias("best_evidence_url"),
        F.when(silent, "medium").otherwise(F.col("b.confidence")).alias("confidence"),
        ready.alias("route_ready"),
        block.alias("route_block_reason"),
        F.when(ready, "Compatible source candidate; extraction not run").otherwise("Normalized passive ATS source candidate").alias("notes"),
    )


def _hits(text: Column, hints: tuple[str, ...]) -> Column:
    total = F.lit(0)
    for hint in hints:
        total = total + F.contains(text, F.lit(hint)).cast("int")
    return total


def anchors(links: DataFrame) -> DataFrame:
    """(..., page, target, text, pos) of the ``a`` links of :func:`read_links`; targets are http."""
    rows = links.filter((F.col("kind") == "a") & (F.col("link") != "") & ~F.col("link").rlike("^(?:#|mailto:|tel:|javascript:)"))
    target = F.when(F.col("link").rlike(r"(?i)^/?www\."), F.concat(F.lit("https://"), F.regexp_replace("link", "^/+", ""))).otherwise(F.col("url"))
    rows = once(rows, "target", target).select(*_carried(links), "page", "target", "text", "pos")
    return rows.filter(is_http(F.col("target")) & ~path(F.col("target")).rlike(r"(?i)/www\.[^/]+/"))


def ranked_links(links: DataFrame, most: int) -> DataFrame:
    """(..., page, original_url, fetch_url, link_text, score): the ``most`` best links of each page to its own host.

    A link's score is the number of hints in its text, path and fragment, three more for each strong
    one, and two for a strong one in the fragment.  Passed over: other hosts, files, social hosts,
    links with a word to skip, postings, links without a hint, and the page itself.
    """
    keep = [c for c in links.columns if c not in ("page", "target", "text", "pos")]
    rows, x = p.with_parts(links, "target")
    fragment = F.regexp_extract("target", "#(.*)$", 1)
    rows = rows.filter(x("host") == bare_host(F.col("page"))).withColumn("_fragment", F.lower(fragment))
    rows = once(rows, "_words", F.lower(F.concat_ws(" ", "text", x("path"), fragment)))
    words = F.col("_words")
    strong = _hits(words, STRONG_HINTS)
    ends = x("low_path").rlike("(?:" + "|".join(e.replace(".", r"\.") for e in SKIP_EXTENSIONS) + ")$")
    skipped = ends | under(x("host"), *SOCIAL_HOSTS) | p.has_any(words, SKIP_HINTS) | (p.has_any(words, SOFT_SKIP_HINTS) & (strong == 0))
    rows = rows.filter(~skipped & ~p.is_posting(x)).withColumn("score", _hits(words, HINTS) + 3 * strong + F.when(p.has_any(F.col("_fragment"), STRONG_HINTS), 2).otherwise(0)).filter("score > 0")
    rows = once(rows, "fetch_url", page_url(F.col("target"))).filter(F.col("fetch_url") != page_url(F.col("page")))
    best = rows.groupBy(*keep, "page", "fetch_url").agg(F.max(F.struct("score", F.col("target").alias("original_url"), (-F.col("pos")).alias("first"), F.col("text").alias("link_text"))).alias("b"))
    rank = F.row_number().over(Window.partitionBy(*keep, "page").orderBy(F.desc("b.score"), "fetch_url"))
    return best.withColumn("_n", rank).filter(F.col("_n") <= most).select(*keep, "page", "b.original_url", "fetch_url", "b.link_text", "b.score")


def platform_links(links: DataFrame) -> DataFrame:
    """(..., page, url): the distinct links of :func:`anchors` that lead to a platform on another host."""
    keep = [c for c in links.columns if c not in ("page", "target", "text", "pos")]
    rows = links.filter(bare_host(F.col("target")) != bare_host(F.col("page"))).filter(platform_of(F.col("target")).isNotNull())
    return rows.select(*keep, "page", page_url(F.col("target")).alias("url")).distinct()


def top_pages(pages: DataFrame, most: int) -> DataFrame:
    """(..., url, score): the ``most`` best links of each page to its own host."""
    return ranked_links(anchors(read_links(pages)), most).withColumnRenamed("fetch_url", "url").drop("page", "original_url", "link_text")
