"""Queries that put a text made of every row of a table through functions of texts.

Each row takes one of a list of cases in turn.  A case's inputs and results are templates: what stands in
braces is filled in from the row's own columns, on one side in Spark, before the functions read it, and on
the other in SQL, which so computes every row's result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import dates, locations, text, urls
from tessera.functions import platforms as p
from tessera.functions.text import once
from tessera.operators.pages import resolved
from tessera.sources import workday

NONE = "Not specified"
_NO_KEY = "No reliable ATS source key was extracted"


_LETTERS = "translate(CAST(o_orderkey AS {0}), '0123456789', 'abcdefghij')"
#: What a name in braces stands for, in Spark's SQL and in DuckDB's.
FILLED = {
    "k": ("CAST(o_orderkey AS string)", "CAST(o_orderkey AS VARCHAR)"),
    "a": (f"concat('Town', {_LETTERS.format('string')})", f"concat('Town', {_LETTERS.format('VARCHAR')})"),
    "l": (f"concat('town', {_LETTERS.format('string')})", f"concat('town', {_LETTERS.format('VARCHAR')})"),
    "d": ("date_format(o_orderdate, 'yyyy-MM-dd')", "strftime(o_orderdate, '%Y-%m-%d')"),
    "m": ("date_format(o_orderdate, 'M/d/yyyy')", "strftime(o_orderdate, '%-m/%-d/%Y')"),
    "b": ("date_format(o_orderdate, 'yyyyMMdd')", "strftime(o_orderdate, '%Y%m%d')"),
    "w": ("concat(extract(YEAROFWEEK FROM o_orderdate), '-W', lpad(CAST(weekofyear(o_orderdate) AS string), 2, '0'), '-', CAST(weekday(o_orderdate) + 1 AS string))", "strftime(o_orderdate, '%G-W%V-%u')"),
    "s": ("CAST(unix_timestamp(CAST(o_orderdate AS timestamp)) AS string)", "CAST(CAST(epoch(o_orderdate) AS BIGINT) AS VARCHAR)"),
}


@dataclass(frozen=True)
class Cases:
    table: str
    key: str
    inputs: tuple[str, ...]
    outputs: tuple[str, ...]
    #: (inputs..., outputs...)
    rows: tuple[tuple, ...]
    apply: Callable[[DataFrame], DataFrame]

    def query(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = spark.read.parquet(f"{sf_dir}/{self.table}.parquet")
        nth = (F.col(self.key) % len(self.rows) + 1).cast("int")

        def filled(i: int) -> Column:
            text = F.element_at(F.array(*(F.lit(r[i]) for r in self.rows)), nth).cast("string")
            for name, (made, _) in FILLED.items():
                if any(f"{{{name}}}" in r[i] for r in self.rows):
                    text = F.replace(text, F.lit(f"{{{name}}}"), F.expr(made))
            return text

        given = rows.select(self.key, *(filled(i).alias(c) for i, c in enumerate(self.inputs)))
        for name in self.inputs:
            given = once(given, name, F.col(name))
        return self.apply(given).select(self.key, *self.outputs)

    def sql(self) -> str:
        def lit(x) -> str:
            return "NULL" if x is None else str(x).lower() if isinstance(x, bool) else str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'"

        def filled(i: int) -> str:
            text = f"[{', '.join(lit(r[i]) for r in self.rows)}][{self.key} % {len(self.rows)} + 1]"
            for name, (_, made) in FILLED.items():
                if any(isinstance(r[i], str) and f"{{{name}}}" in r[i] for r in self.rows):
                    text = f"replace({text}, '{{{name}}}', {made})"
            return text

        return f"SELECT {self.key}, {', '.join(f'{filled(len(self.inputs) + i)} AS {c}' for i, c in enumerate(self.outputs))} FROM {self.table}"


def _with(columns: Callable[[], dict[str, Column]]) -> Callable[[DataFrame], DataFrame]:
    return lambda rows: rows.withColumns(columns())


def _sources(rows: DataFrame) -> DataFrame:
    parts = rows.withColumn("p", urls.source_parts(F.col("url")))
    return parts.select("*", F.col("p.source").alias("source"), F.col("p.canonical").alias("canonical"), urls.identity_text(urls.identity(F.col("p"))).alias("identity"), urls.identity_text(urls.identity(F.col("p"), with_language=False)).alias("loose"), F.col("p.error").isNotNull().alias("malformed"))


def _platforms(rows: DataFrame) -> DataFrame:
    rows, x = p.with_parts(rows, "url")
    rows = rows.withColumn("platform", p.platform(x))
    rows = rows.withColumn("source_key", p.source_key(F.col("platform"), x))
    return rows.withColumns({"canonical": p.canonical_url(F.col("platform"), F.col("source_key"), x("host"), x("url")), "block": p.route_block(F.col("platform"), F.col("source_key")), "quality": p.quality(F.col("platform"), x), "evidence": p.is_evidence(F.col("platform"), x), "act": p.action(F.col("platform"), p.route_block(F.col("platform"), F.col("source_key")) == "")})


def _careers(rows: DataFrame) -> DataFrame:
    rows, x = p.with_parts(rows.withColumn("url", urls.page_url(F.col("url"))), "url")
    return rows.withColumns({"career": p.career_page(x), "kind": p.source_type(x), "careers": p.looks_like_careers(x), "grouped": F.array_join(p.group_key(x), " "), "stands": p.group_url(x), "posting": p.is_posting(x)})


def _hosts(rows: DataFrame) -> DataFrame:
    rows, x = p.with_parts(rows, "url")
    return rows.withColumns({"public": p.is_public(F.col("source"), x), "template": p.has_template(F.col("url")), "board": p.workday_board(F.col("source"), x)})


def _forms(rows: DataFrame) -> DataFrame:
    t = F.col("t")
    return rows.withColumns({"cleaned": text.clean(t), "plain": text.alphanumeric(t), "term": text.search_term(t), "shown": text.strip_tags(t), "flag": text.enabled_flag(t), "cell": text.escape_cell(t), "slugged": text.slug(t)})


def _endpoints(rows: DataFrame) -> DataFrame:
    u, a, b = F.col("url"), F.col("tenant"), F.col("site")
    return rows.withColumns({"listing": workday.jobs_url(u, a, b), "detail": workday.detail_url(u, a, b, F.col("path")), "page_size": workday.config_int(F.col("size"), 20, 1, 50)})


CASES = {
    "source_identities": Cases(
        "orders", "o_orderkey", ("url",), ("source", "canonical", "identity", "loose", "malformed"),
        (
            ("https://acme{k}.wd5.myworkdayjobs.com/en-US/Careers/job/x/y", "workday", "https://acme{k}.wd5.myworkdayjobs.com/en-US/Careers", "workday :: acme{k} :: careers", "workday :: acme{k} :: careers", False),
            ("https://jobs.lever.co/Acme{k}/123", "lever", "https://jobs.lever.co/acme{k}", "lever :: acme{k}", "lever :: acme{k}", False),
            ("https://boards-api.greenhouse.io/v1/boards/acme{k}/jobs", "greenhouse", "https://boards.greenhouse.io/acme{k}", "greenhouse :: acme{k}", "greenhouse :: acme{k}", False),
            ("https://jobs.ashbyhq.com/Ac%20me{k}/1", "ashby", "https://jobs.ashbyhq.com/Ac%20me{k}", "ashby :: ac me{k}", "ashby :: ac me{k}", False),
            ("https://x{k}.icims.com/jobs/1", "icims", "https://x{k}.icims.com/jobs/search", "icims :: classic :: x{k}.icims.com", "icims :: classic :: x{k}.icims.com", False),
            ("https://careers{k}.example.com/x?icims=1", "icims", "https://careers{k}.example.com?icims=1", "icims :: jibe :: careers{k}.example.com", "icims :: jibe :: careers{k}.example.com", False),
            ("https://a{k}.fa.oraclecloud.com/hcmUI/CandidateExperience/en/sites/CX_1/job/2", "oracle_hcm", "https://a{k}.fa.oraclecloud.com/hcmUI/CandidateExperience/en/sites/CX_1", "oracle_hcm :: a{k}.fa.oraclecloud.com :: en :: cx_1", "oracle_hcm :: a{k}.fa.oraclecloud.com :: en :: cx_1", False),
            ("https://api.smartrecruiters.com/v1/companies/Acme{k}/postings", "smartrecruiters", "https://jobs.smartrecruiters.com/Acme{k}", "smartrecruiters :: acme{k}", "smartrecruiters :: acme{k}", False),
            ("https://ats.rippling.com/en-US/acme{k}/jobs/1", "rippling", "https://ats.rippling.com/acme{k}/jobs", "rippling :: acme{k}", "rippling :: acme{k}", False),
            ("https://apply.workable.com/api/v3/accounts/acme{k}/jobs", "workable", "https://apply.workable.com/acme{k}", "workable :: acme{k}", "workable :: acme{k}", False),
            ("https://example{k}.com/x", None, None, None, None, False),
            ("https://jobs.lever.co/", "lever", None, None, None, True),
        ),
        _sources,
    ),
    "platform_keys": Cases(
        "orders", "o_orderkey", ("url",), ("platform", "source_key", "canonical", "block", "quality", "evidence", "act"),
        (
            ("https://boards.greenhouse.io/Acme{k}/jobs/123", "greenhouse", "acme{k}", "https://boards-api.greenhouse.io/v1/boards/acme{k}/jobs", "", 3, True, "validate_with_existing_ats_scraper"),
            ("https://boards.greenhouse.io/embed/job_board/js?for=Acme{k}", "greenhouse", "acme{k}", "https://boards-api.greenhouse.io/v1/boards/acme{k}/jobs", "", 4, True, "validate_with_existing_ats_scraper"),
            ("https://jobs.eu.lever.co/Globex{k}/1", "lever", "globex{k}", "https://api.lever.co/v0/postings/globex{k}?mode=json", "", 4, True, "validate_with_existing_ats_scraper"),
            ("https://api.ashbyhq.com/posting-api/job-board/Init%20ech{k}", "ashby", "init ech{k}", "https://api.ashbyhq.com/posting-api/job-board/init%20ech{k}?includeCompensation=false", "", 2, True, "validate_with_existing_ats_scraper"),
            ("https://acme{k}.wd5.myworkdayjobs.com/en-US/Careers/job/x", "workday", "acme{k}:careers", "https://acme{k}.wd5.myworkdayjobs.com/wday/cxs/acme{k}/careers/jobs", "", 2, True, "validate_with_existing_ats_scraper"),
            ("https://acme{k}.wd5.myworkdayjobs.com/assets/x", "workday", "acme{k}:x", "https://acme{k}.wd5.myworkdayjobs.com/wday/cxs/acme{k}/x/jobs", "", 2, False, "validate_with_existing_ats_scraper"),
            ("https://careers.acme{k}.bamboohr.com/jobs", "bamboohr", "careers.acme{k}", "https://careers.acme{k}.bamboohr.com/careers", "No existing extraction route for bamboohr", 2, False, "add_to_existing_ats_csv_later"),
            ("https://x{k}.phenompeople.com/api/jobs", "phenom", "", "https://x{k}.phenompeople.com/api/jobs", _NO_KEY, 4, True, "future_phenom_adapter"),
            ("https://a{k}.fa.oraclecloud.com/hcmUI/CandidateExperience/en/sites/CX_1/job/2", "oracle_hcm", "a{k}.fa.oraclecloud.com:en:CX_1", "https://a{k}.fa.oraclecloud.com/hcmUI/CandidateExperience/en/sites/CX_1", "", 2, True, "validate_with_existing_ats_scraper"),
            ("https://app.greenhouse.io/plans/{k}", "greenhouse", "", "https://boards-api.greenhouse.io/v1/boards//jobs", _NO_KEY, 0, True, "add_to_existing_ats_csv_later"),
            ("https://www.example{k}.com/jobs?gh_jid=", "", "", "https://www.example{k}.com/jobs?gh_jid=", _NO_KEY, 2, False, "unsupported_for_now"),
            ("https://acme{k}.applytojob.com/apply", "jazzhr", "", "https://acme{k}.applytojob.com/apply", _NO_KEY, 2, True, "unsupported_for_now"),
            ("https://cdn.lever.co/logo{k}.PNG", "lever", "", "https://api.lever.co/v0/postings/?mode=json", _NO_KEY, 2, False, "add_to_existing_ats_csv_later"),
            ("https://ats.rippling.com/en-US/Acme{k}/jobs/1", "rippling", "Acme{k}", "https://ats.rippling.com/Acme{k}/jobs", "", 2, True, "validate_with_existing_ats_scraper"),
            ("https://apply.workable.com/api/v3/accounts/acme{k}/jobs", "workable", "acme{k}", "https://apply.workable.com/api/v3/accounts/acme{k}/jobs", "", 4, True, "validate_with_existing_ats_scraper"),
            ("https://jobs.smartrecruiters.com/oneclick-ui/company/Acme{k}/job/1", "smartrecruiters", "acme{k}", "https://api.smartrecruiters.com/v1/companies/acme{k}/postings", "", 2, True, "validate_with_existing_ats_scraper"),
            ("https://acme{k}.breezy.hr/json", "breezyhr", "acme{k}", "https://acme{k}.breezy.hr", "No existing extraction route for breezyhr", 2, True, "manual_review"),
            ("https://www.comeet.com/jobs/acme{k}/A1", "comeet", "acme{k}", "https://www.comeet.com/jobs/acme{k}/A1", "No existing extraction route for comeet", 2, True, "add_to_existing_ats_csv_later"),
            ("https://careers.recruitee.com/o/x{k}", "recruitee", "", "https://.recruitee.com", _NO_KEY, 2, True, "add_to_existing_ats_csv_later"),
            ("https://acme{k}.jibeapply.com/jobs", "icims", "acme{k}.jibeapply.com", "https://acme{k}.jibeapply.com?icims=1", "", 2, True, "validate_with_existing_ats_scraper"),
        ),
        _platforms,
    ),
    "career_pages": Cases(
        "orders", "o_orderkey", ("url",), ("career", "kind", "careers", "grouped", "stands", "posting"),
        (
            ("https://Example{k}.com/en/Careers/search/1?x=2", "https://example{k}.com/en/Careers/search", "custom_career_page", True, "example{k}.com company_host", "https://example{k}.com/en/Careers/search/1?x=2", False),
            ("https://example{k}.com/about?gh_jid=5", "https://example{k}.com/about", "branded_ats_page", False, "example{k}.com company_host", "https://example{k}.com/about?gh_jid=5", True),
            ("https://x{k}.breezy.hr/p/1", "https://x{k}.breezy.hr/p/1", "unsupported_url", False, "x{k}.breezy.hr company_host", "https://x{k}.breezy.hr/p/1", False),
            ("https://example{k}.com/", "https://example{k}.com/", "unknown_career_page", False, "example{k}.com company_host", "https://example{k}.com/", False),
            ("https://jobs.example{k}.com/openings/all", "https://jobs.example{k}.com/openings/all", "custom_career_page", True, "jobs.example{k}.com company_host", "https://jobs.example{k}.com/openings/all", False),
            ("https://example{k}.com/jobs/12{k}45", "https://example{k}.com/jobs", "custom_career_page", True, "example{k}.com company_host", "https://example{k}.com/jobs/12{k}45", True),
            ("https://example{k}.com/jobs/senior-software-engineer-remote-us", "https://example{k}.com/jobs", "custom_career_page", True, "example{k}.com company_host", "https://example{k}.com/jobs/senior-software-engineer-remote-us", True),
            ("https://example{k}.com/about/senior-software-engineer-remote-us", "https://example{k}.com/about/senior-software-engineer-remote-us", "unknown_career_page", False, "example{k}.com company_host", "https://example{k}.com/about/senior-software-engineer-remote-us", False),
            ("https://a{k}.taleo.net/careersection/Ex/jobdetail.ftl?job=1", "https://a{k}.taleo.net/careersection/Ex/jobdetail.ftl?job=1", "custom_career_page", True, "a{k}.taleo.net taleo ex", "https://a{k}.taleo.net/careersection/Ex/jobsearch.ftl", False),
            ("https://b{k}.applytojob.com/apply/x1", "https://b{k}.applytojob.com/apply/x1", "unsupported_url", True, "b{k}.applytojob.com jazzhr", "https://b{k}.applytojob.com/apply", False),
            ("https://example{k}.com/p/123e4567-e89b-12d3-a456-426614174000", "https://example{k}.com/p/123e4567-e89b-12d3-a456-426614174000", "unknown_career_page", False, "example{k}.com company_host", "https://example{k}.com/p/123e4567-e89b-12d3-a456-426614174000", True),
        ),
        _careers,
    ),
    "joined_links": Cases(
        "orders", "o_orderkey", ("base", "link"), ("joined",),
        (
            ("http://a{k}.com/a/b/c/d.html", "../../x", "http://a{k}.com/a/x"),
            ("http://a{k}.com/a/b", "./c/.", "http://a{k}.com/a/c/"),
            ("http://a{k}.com", "x", "http://a{k}.com/x"),
            ("http://a{k}.com/a", "//b{k}.com/q", "http://b{k}.com/q"),
            ("http://a{k}.com/a?x=1", "?y=2", "http://a{k}.com/a?y=2"),
            ("http://a{k}.com/a/b", "/c/../d#f", "http://a{k}.com/d#f"),
            ("http://a{k}.com/a", "../../../z", "http://a{k}.com/z"),
            ("http://a{k}.com/a", "https://c{k}.com/../k", "https://c{k}.com/../k"),
            ("http://a{k}.com/a/b/", "..", "http://a{k}.com/a/"),
            ("http://a{k}.com/a/b?q", "c?d/../e", "http://a{k}.com/a/c?d/../e"),
        ),
        _with(lambda: dict(joined=resolved(F.col("base"), F.col("link")))),
    ),
    "place_forms": Cases(
        "orders", "o_orderkey", ("t", "more"), ("place", "coded", "verbatim", "tier", "generic"),
        (
            ("{a}, CA", "", "{a}, Canada", "{a}, Canada", "{a}, CA", "{a}, Canada", False),
            ("{a}, Michigan, United States", "x", "Michigan, United States", "Michigan, United States", "Michigan, United States", "Michigan, United States", False),
            ("3 Locations", "{a}, ON", "3 Locations", "3 Locations", "3 Locations", "{a}, ON", True),
            ("", "2 Locations", NONE, NONE, NONE, "2 Locations", True),
            ("HQ: {a}, Ontario, Canada", "", "{a}, ON, Canada", "{a}, ON, Canada", "{a}, ON, Canada", "{a}, ON, Canada", False),
            ("usa", "", "United States", "United States", "United States", "United States", False),
            ("Remote - United States", "", "United States Remote", "United States Remote", "United States Remote", "United States Remote", False),
            ("{l}, on", "", "{a}, ON", "{a}, ON", "{a}, ON", "{a}, ON", False),
            ("12 Main St, {a}, ON", "", "{a}, ON", "{a}, ON", "{a}, ON", "{a}, ON", False),
        ),
        _with(lambda: dict(place=locations.places(F.col("t")), coded=locations.coded_places(F.col("t")), verbatim=locations.verbatim_places(F.array("t")), tier=locations.best_tier(F.array("t"), F.array("more")), generic=locations.is_generic(F.col("t")))),
    ),
    "coded_places": Cases(
        "orders", "o_orderkey", ("t",), ("coded",),
        (("US-NY-New-York | CA-ON-{a}", "New York, NY, United States / {a}, ON, Canada"), ("CA-QC", "QC, Canada"), ("us", "United States"), ("US-TN-{a}", "{a}, TN, United States")),
        _with(lambda: dict(coded=locations.coded_places(F.col("t")))),
    ),
    "date_forms": Cases(
        "orders", "o_orderkey", ("t",), ("posted", "iso", "epoch"),
        (
            ("{s}000", None, None, "{d}"),
            ("{s}", None, None, "{d}"),
            ("{d}T23:30:00-05:00", "{d}", "{d}", None),
            ("{m} 3:04 PM", "{d}", None, None),
            ("{m}", "{d}", None, None),
            ("{w}", "{d}", "{d}", None),
            ("{b}T0930Z", "{d}", "{d}", None),
            ("{d} 24:00", None, None, None),
            ("{d}T99:99", None, None, None),
            ("soon {k}", None, None, None),
        ),
        _with(lambda: dict(posted=dates.posted_date(F.col("t")), iso=dates.iso_date(F.col("t")), epoch=dates.epoch_date(F.col("t")))),
    ),
    "text_forms": Cases(
        "orders", "o_orderkey", ("t",), ("cleaned", "plain", "term", "shown", "flag", "cell", "slugged"),
        (
            (" Co-Op{k}  Term ", "Co-Op{k} Term", "coop{k}term", "co op{k} term", "Co-Op{k} Term", None, "Co-Op{k}  Term", "co-op{k}-term"),
            ("<b>A&amp;B&#233;&nbsp;{k}</b> yes", "<b>A&amp;B&#233;&nbsp;{k}</b> yes", "baampb233nbsp{k}byes", "<b>a&amp;b&#233;&nbsp;{k}</b> yes", "A&Bé {k} yes", None, "<b>A&amp;B&#233;&nbsp;{k}</b> yes", "b-a-amp-b-233-nbsp-{k}-b-yes"),
            ("Yes", "Yes", "yes", "yes", "Yes", True, "Yes", "yes"),
            ("no ", "no", "no", "no", "no", False, "no", "no"),
            ("a|b{k}", "a|b{k}", "ab{k}", "a|b{k}", "a|b{k}", None, "a\\|b{k}", "a-b{k}"),
            ("", "", "", "", "", None, "", "unknown"),
        ),
        _forms,
    ),
    "public_hosts": Cases(
        "orders", "o_orderkey", ("source", "url"), ("public", "template"),
        (
            ("icims", "https://employees-acme{k}.icims.com/jobs", False, False),
            ("icims", "https://careers-acme{k}.icims.com/x", True, False),
            ("icims", "https://login.icims.com/", False, False),
            ("oracle_hcm", "https://fa{k}-test.oraclecloud.com/x", False, False),
            ("oracle_hcm", "https://fa{k}.oraclecloud.com/{{x}}", True, True),
            ("lever", "https://jobs.lever.co/a%7Bb", True, True),
        ),
        _hosts,
    ),
    "workday_boards": Cases(
        "orders", "o_orderkey", ("source", "url"), ("board",),
        (
            ("acme{k}:careers", "https://acme{k}.wd5.myworkdayjobs.com/en-US/Careers/job/1", "https://acme{k}.wd5.myworkdayjobs.com/en-US/Careers"),
            ("acme{k}:login", "https://acme{k}.wd5.myworkdayjobs.com/x", ""),
            ("acme{k}:careers", "https://acme{k}.wd5.myworkdayjobs.com/login", ""),
            ("acme{k}:careers", "https://x{k}.com/careers", ""),
            ("acme{k}:careers", "https://acme{k}.wd5.myworkdayjobs.com/Careers/extra", "https://acme{k}.wd5.myworkdayjobs.com/Careers"),
            ("acme{k}", "https://acme{k}.wd5.myworkdayjobs.com/Careers", ""),
        ),
        _hosts,
    ),
    "workday_endpoints": Cases(
        "orders", "o_orderkey", ("url", "tenant", "site", "path", "size"), ("listing", "detail", "page_size"),
        (
            ("https://acme{k}.wd5.myworkdayjobs.com/en-US/Careers/job/1", "", "", "/job/7", "10", "https://acme{k}.wd5.myworkdayjobs.com/wday/cxs/acme{k}/Careers/jobs", "https://acme{k}.wd5.myworkdayjobs.com/wday/cxs/acme{k}/Careers/job/7", 10),
            ("https://acme{k}.wd5.myworkdayjobs.com", "t", "s", "", "x", "https://acme{k}.wd5.myworkdayjobs.com/wday/cxs/t/s/jobs", None, 20),
            ("https://acme{k}.wd5.myworkdayjobs.com", "t", "", "/p", "0", None, None, 1),
            ("", "t", "s", "/p", "99", None, None, 50),
        ),
        _endpoints,
    ),
    "detail_places": Cases(
        "orders", "o_orderkey", ("payload",), ("found",),
        (
            ('{"jobPostingInfo":{"location":"{a}, ON","additionalLocations":["{l}, on",{"descriptor":"Paris"}]}}', "{a}, ON | Paris"),
            ('{"jobPostingInfo":{"jobRequisitionLocation":{"city":"{a}","country":"Italy"}},"hiringOrganization":"Org"}', "{a}, Italy | Org"),
            ('{"jobPostingInfo":{"primaryLocation":{"city":"{a}","state":"ARA"}},"hiringOrganization":"Org"}', "{a}, ARA"),
            ("{}", ""),
        ),
        _with(lambda: dict(found=F.array_join(workday.detail_locations(F.col("payload")), " | "))),
    ),
}

QUERIES = {name: case.query for name, case in CASES.items()}
ORACLE_SQL = {name: case.sql() for name, case in CASES.items()}
