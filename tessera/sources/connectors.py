"""Connectors: landed payloads of nine sources to one record schema.

A landing table has ``payload`` (JSON text of one response, or a classic iCIMS page) and the lineage ``company``,
``career_url``, ``term``, ``page`` and ``ord``.  A connector is an envelope, which explodes the
payload, guards and dedupes the rows, and a normaliser, which projects them to RECORD.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.dates import epoch_date, iso_date, posted_date
from tessera.functions.locations import best_tier, coded_places, distinct_text, is_vague, joined, places, places_list, verbatim_places
from tessera.functions.urls import host, netloc
from tessera.functions.text import MISSING, blank_to, clean, first_text, job_id, job_type, let, once, season, strip
from tessera.operators.dedupe import first_wins, last_wins
from tessera.sources.markup import page_cards

RECORD = ("id", "company", "title", "location", "type", "season", "source", "url", "date_posted", "date_added", "active")
#: Fixed value: words that make a posting relevant in searches that match loosely.
RELEVANT = r"(?i)\b(intern|internship|co-?op|student|new grad|new graduate|early career|entry[- ]level|graduate)\b"
#: Fixed value: words that make a facet of a careers site worth asking for.
FACETS = r"(?i)\b(intern|internship|campus|student|new grad|new graduate|early career|entry level)\b"
_PLACE = "struct<name:string,city:string,stateCode:string,state:string,region:string,country:string,workplaceType:string,hidden:boolean>"
_POSTAL = "struct<postalAddress:struct<addressLocality:string,addressRegion:string,addressCountry:string>>"

SCHEMAS = {
    "ashby": f"struct<jobs:array<struct<id:string,title:string,employmentType:string,jobUrl:string,applyUrl:string,publishedAt:string,workplaceType:string,location:string,isListed:boolean,isRemote:boolean,address:{_POSTAL},secondaryLocations:array<struct<location:string,address:{_POSTAL}>>>>>",
    "greenhouse": "struct<jobs:array<struct<id:string,title:string,absolute_url:string,first_published:string,updated_at:string,location:string>>>",
    "lever": "array<struct<id:string,text:string,hostedUrl:string,applyUrl:string,workplaceType:string,country:string,createdAt:string,categories:struct<location:string,allLocations:array<string>>>>",
    "icims": "struct<jobs:array<struct<data:struct<slug:string,req_id:string,title:string,posted_date:string,create_date:string,employment_type:string,full_location:string,location_name:string,short_location:string,city:string,state:string,country:string,multipleLocations:array<struct<city:string,state:string,country:string>>>>>>",
    "oracle_hcm": "struct<items:array<struct<requisitionList:array<struct<Id:string,Title:string,PrimaryLocation:string,PostedDate:string>>>>>",
    "smartrecruiters": "struct<content:array<struct<id:string,name:string,refNumber:string,releasedDate:string,typeOfEmployment:struct<id:string,label:string>,experienceLevel:struct<id:string,label:string>,location:struct<fullLocation:string,city:string,region:string,country:string,remote:boolean>>>>",
    "rippling": f"struct<items:array<struct<id:string,name:string,url:string,department:struct<name:string>,locations:array<{_PLACE}>>>>",
    "workable": f"struct<results:array<struct<id:string,shortcode:string,title:string,code:string,type:string,workplace:string,published:string,department:string,remote:boolean,locations:array<{_PLACE}>,location:{_PLACE}>>>",
    "workday": "struct<jobPostings:array<struct<title:string,externalPath:string,id:string,postedOn:string,locationsText:string,locations:array<string>,primaryLocation:string,primaryLocationDescriptor:string>>>",
}
_ROWS = {"ashby": "x.jobs", "greenhouse": "x.jobs", "lever": "x", "icims": "transform(x.jobs, j -> j.data)", "oracle_hcm": "x.items[0].requisitionList", "smartrecruiters": "x.content", "rippling": "x.items", "workable": "x.results", "workday": "x.jobPostings"}


def _rows(landed: DataFrame, source: str) -> DataFrame:
    keep = [c for c in ("company", "career_url", "term", "page", "ord") if c in landed.columns]
    items = landed.select(*keep, F.from_json("payload", SCHEMAS[source]).alias("x"))
    return items.select(*keep, F.posexplode(F.expr(_ROWS[source])).alias("pos", "raw")).filter("raw IS NOT NULL")


def _icims_rows(landed: DataFrame) -> DataFrame:
    """Rows of both iCIMS forms: jibe's JSON, and the cards of classic pages in its fields, with their ``classic_url``."""
    page = F.col("payload").rlike(r"(?U)^\s*<")
    keep = [c for c in ("company", "career_url", "term", "page", "ord") if c in landed.columns]
    # Payloads are computed and read once, whatever their form.
    both = landed.select(*keep, F.from_json(F.when(~page, F.col("payload")), SCHEMAS["icims"]).alias("x"), page_cards(F.when(page, F.col("payload"))).alias("cards"))
    data = both.schema["x"].dataType["jobs"].dataType.elementType["data"].dataType
    card = both.schema["cards"].dataType.elementType
    given = lambda x, i: F.struct(i.alias("pos"), x["data"].alias("data"), F.lit(None).cast(card).alias("card"))
    carded = lambda x: F.struct(x["pos"].alias("pos"), F.lit(None).cast(data).alias("data"), x.alias("card"))
    rows = both.select(*keep, F.inline(F.coalesce(F.transform("cards", carded), F.transform("x.jobs", given)))).filter("data IS NOT NULL OR card IS NOT NULL")
    names = [*data.names, "classic_url"]
    fields = [F.coalesce(*(F.col(f"{part}.{k}") for part, t in (("data", data), ("card", card)) if k in t.names)).alias(k) for k in names]
    return rows.select(*keep, "pos", F.struct(*fields).alias("raw"))


def facet_terms(landed: DataFrame) -> DataFrame:
    """(company, facet, term) worth asking a careers site for: the "tags" facets of its probe (company, payload).

    Where none is found, "Intern" in the first four.
    """
    lists = landed.select("company", F.explode_outer(F.from_json(F.get_json_object("payload", "$.filter.facetList"), "map<string,string>")).alias("facet", "items"))
    terms = lists.filter(F.startswith("facet", F.lit("tags"))).select("company", "facet", F.explode(F.from_json("items", "array<struct<term:string>>")).alias("x"))
    found = terms.select("company", "facet", strip(F.col("x.term")).alias("term")).filter((F.col("term") != "") & F.col("term").rlike(FACETS)).distinct()
    bare = landed.select("company").distinct().join(found.select("company").distinct(), "company", "left_anti")
    return found.unionByName(bare.select("company", F.explode(F.array(*(F.lit(f"tags{i}") for i in (1, 2, 3, 4)))).alias("facet"), F.lit("Intern").alias("term")))


def raw_key(r: Column) -> Column:
    """What a raw workday row is known by: path, else id, else title and location."""
    where = first_text(r["locationsText"], F.try_element_at(r["locations"], F.lit(1)), default="")
    return F.lower(F.coalesce(F.concat(F.lit("path::"), F.nullif(strip(r["externalPath"]), F.lit(""))), F.concat(F.lit("id::"), F.nullif(strip(r["id"]), F.lit(""))), F.concat_ws("::", strip(r["title"]), where)))


def envelope(landed: DataFrame, source: str) -> DataFrame:
    """Raw rows of a source: payload rows that pass its guard, deduplicated the way it needs."""
    rows = _icims_rows(landed) if source == "icims" else _rows(landed, source)
    order = ["ord", "pos"]
    words = lambda *c: F.concat_ws(" ", *c).rlike(RELEVANT)
    if source == "ashby":
        return rows.filter("NOT (raw.isListed <=> false)")
    if source == "icims":
        return last_wins(rows.withColumn("key", first_text(F.col("raw.slug"), F.col("raw.req_id"))).filter("key IS NOT NULL"), ["company", "key"], order)
    if source == "oracle_hcm":
        return last_wins(rows.filter(strip(F.col("raw.Id")) != "").withColumn("key", F.col("raw.Id")), ["company", "key"], order)
    if source == "smartrecruiters":
        kept = rows.filter(words("raw.name", "raw.refNumber", "raw.typeOfEmployment.id", "raw.typeOfEmployment.label", "raw.experienceLevel.id", "raw.experienceLevel.label"))
        return last_wins(kept.withColumn("key", F.col("raw.id")), ["company", "key"], order)
    if source == "workable":
        department = F.when(F.startswith(strip(F.col("raw.department")), F.lit("[")), F.array_join(F.from_json("raw.department", "array<string>"), " ")).otherwise(F.col("raw.department"))
        kept = rows.filter(words("raw.title", "raw.code", "raw.type", department)).withColumn("key", first_text(F.col("raw.id"), F.col("raw.shortcode")))
        return last_wins(kept.filter("key IS NOT NULL"), ["company", "key"], order)
    if source == "rippling":
        kept = rows.filter(words("raw.name", "raw.department.name")).withColumn("key", F.col("raw.id"))
        merged = kept.groupBy("company", "key").agg(F.min_by(F.struct(*kept.columns), F.struct(*order)).alias("first"), F.array_sort(F.collect_list(F.struct(*order, F.col("raw.locations").alias("l")))).alias("all"))
        flat = lambda parts: F.flatten(F.transform(F.filter(parts, lambda s: s["l"].isNotNull()), lambda s: s["l"]))
        name = lambda p: F.lower(strip(p["name"]))
        # The first row's places stay as they are; of the others' those with a name not seen before.
        own, more = flat(F.slice("all", 1, 1)), flat(F.slice("all", 2, F.greatest(F.size("all") - 1, F.lit(0))))
        union = let(F.struct(own.alias("own"), more.alias("more")), lambda x: F.concat(x["own"], F.filter(x["more"], lambda p, i: (name(p) != "") & ~F.array_contains(F.transform(x["own"], name), name(p)) & (F.array_position(F.transform(x["more"], name), name(p)) == i + 1))))
        return merged.select("first.*", union.alias("places")).withColumn("raw", F.col("raw").withField("locations", F.col("places"))).drop("places")
    if source == "workday":
        return first_wins(rows.withColumn("key", raw_key(F.col("raw"))).filter(job_type(F.col("raw.title")).isNotNull()), ["company", "key"], order)
    return rows


def with_details(rows: DataFrame, details: DataFrame, *, order: list[str], most: int = 50) -> DataFrame:
    """Workday rows with ``detail_locations`` looked up by company and path where their own location is vague.

    ``details``: (company, path, detail_locations array).  The first ``most`` such rows of a company in ``order``
    are looked up, the others keep what they have; a path that stands there twice counts once.
    """
    blank = lambda c: strip(F.col(c)) == ""
    needy = is_vague(F.col("raw.locationsText")) & (F.size(F.coalesce("raw.locations", F.array())) == 0) & blank("raw.primaryLocation") & blank("raw.primaryLocationDescriptor") & ~blank("raw.externalPath")
    rank = F.row_number().over(Window.partitionBy("company", "_needy").orderBy(*order))
    ranked = rows.withColumn("_needy", F.coalesce(needy, F.lit(False))).withColumn("_rank", rank)
    path = F.when(F.col("_needy") & (F.col("_rank") <= most), F.col("raw.externalPath"))
    found = details.groupBy("company", F.col("path").alias("_path")).agg(F.min("detail_locations").alias("detail_locations"))
    return ranked.withColumn("_path", path).join(found, ["company", "_path"], "left").drop("_needy", "_rank", "_path")


#: What of a raw row its location is read from.
_PLACED = {
    "ashby": ("address", "location", "secondaryLocations", "isRemote", "workplaceType"),
    "greenhouse": ("location",),
    "lever": ("workplaceType", "country", "categories"),
    "icims": ("multipleLocations", "full_location", "location_name", "short_location", "city", "state", "country"),
    "oracle_hcm": ("PrimaryLocation",),
    "smartrecruiters": ("location",),
    "rippling": ("locations",),
    "workable": ("remote", "workplace", "locations", "location"),
    "workday": ("locations", "primaryLocation", "primaryLocationDescriptor", "locationsText"),
}


def _located(rows: DataFrame, source: str, location: Column) -> DataFrame:
    """``rows`` with ``_location``, read once for all rows that tell the same; it is joined back by what they tell."""
    told = [F.struct(*(F.col("raw")[c].alias(c) for c in _PLACED[source])).alias("raw"), *(["detail_locations"] if "detail_locations" in rows.columns else [])]
    found = rows.select(*told).distinct().select(F.struct("*").alias("_told"), location.alias("_location"))
    return rows.withColumn("_tells", F.struct(*told)).join(found, F.col("_tells") == F.col("_told"), "left").drop("_tells", "_told")


def _record(rows: DataFrame, source: str, title: Column, kind: Column, location: Column, url: Column, posted: Column, path: Column, raw_id: Column, as_of: str, stored: bool = False) -> DataFrame:
    rows = _located(rows, source, location) if stored else rows
    rows = once(rows.withColumns({"_title": title, "_url": url}), "type", kind).filter("type IS NOT NULL")
    rows = rows if stored else once(rows, "_location", location)
    company = blank_to(F.col("company"), "Unknown")
    at = [F.struct("ord", "pos").alias("at")] if {"ord", "pos"} <= set(rows.columns) else []
    return rows.select(
        job_id(F.lit(source), company, path, raw_id, F.col("_title"), F.col("_location"), F.col("_url")).alias("id"),
        company.alias("company"),
        F.col("_title").alias("title"),
        F.col("_location").alias("location"),
        "type",
        season(F.col("_title")).alias("season"),
        F.lit(source).alias("source"),
        F.col("_url").alias("url"),
        posted.alias("date_posted"),
        F.lit(as_of).alias("date_added"),
        F.lit(True).alias("active"),
        *at,
    )


def _texts(*columns: Column) -> Column:
    return F.filter(F.array(*(F.nullif(strip(c), F.lit("")) for c in columns)), lambda x: x.isNotNull())


def _postal(address: Column) -> Column:
    """array(struct(text, hint)) of a postal address, empty without parts."""
    a = address["postalAddress"]
    text = F.array_join(_texts(a["addressLocality"], a["addressRegion"], a["addressCountry"]), ", ")
    return F.when(text != "", F.array(F.struct(text.alias("text"), strip(a["addressCountry"]).alias("hint")))).otherwise(F.array().cast("array<struct<text:string,hint:string>>"))


def _plain(text: Column) -> Column:
    return F.when(strip(text) != "", F.array(F.struct(strip(text).alias("text"), F.lit("").alias("hint")))).otherwise(F.array().cast("array<struct<text:string,hint:string>>"))


def _address_or(address: Column, text: Column) -> Column:
    return let(_postal(address), lambda p: F.when(F.size(p) > 0, p).otherwise(_plain(text)))


def _ashby(r: Column) -> Column:
    own = _address_or(r["address"], r["location"])
    more = F.flatten(F.transform(F.coalesce(r["secondaryLocations"], F.array()), lambda s: _address_or(s["address"], s["location"])))
    away = F.coalesce(r["isRemote"], F.lit(False)) | (F.lower(strip(r["workplaceType"])) == "remote")
    remote = F.when(away, _plain(F.array_join(F.concat(F.array(F.lit("Remote")), _texts(r["address"]["postalAddress"]["addressCountry"])), ", "))).otherwise(_plain(F.lit("")))
    return joined(let(F.flatten(F.transform(F.concat(own, more, remote), lambda v: places_list(v["text"], v["hint"]))), distinct_text))


def _lever(r: Column) -> Column:
    listed = F.concat(F.filter(F.transform(F.coalesce(r["categories"]["allLocations"], F.array()), strip), lambda x: x != ""), _texts(r["categories"]["location"]))
    other = F.when(F.lower(strip(r["workplaceType"])) == "remote", F.array(F.array_join(F.concat(F.array(F.lit("Remote")), _texts(r["country"])), ", "))).otherwise(_texts(r["country"]))
    return verbatim_places(F.when(F.size(listed) > 0, listed).otherwise(other))


def _smart(r: Column) -> Column:
    p = r["location"]
    text = F.coalesce(F.nullif(strip(p["fullLocation"]), F.lit("")), F.array_join(_texts(p["city"], p["region"], p["country"]), ", "))
    return places(F.concat_ws(", ", F.when(F.coalesce(p["remote"], F.lit(False)), "Remote"), F.nullif(text, F.lit(""))))


def _raw_places(all_: Column, part: Callable[[Column], Column]) -> Column:
    return joined(let(F.filter(F.transform(F.coalesce(all_, F.array()), part), lambda x: x != ""), distinct_text))


def normalise(rows: DataFrame, source: str, as_of: str, *, stored: bool = False) -> DataFrame:
    """RECORD rows of an envelope's rows, with ``at``, their place; rows that are neither internship nor new grad go.

    JSON nulls count as missing.  ``as_of`` (ISO date) becomes ``date_added``.  Rows that are ``stored``, and so cheap to
    read twice, have their different locations read once each.
    """
    r, career = F.col("raw"), F.col("career_url")
    t = F.col("_title")
    none = F.lit("")
    link = lambda *c: first_text(*c, career, default=MISSING)
    title = lambda c: blank_to(c, "Unknown")
    if source == "ashby":
        kind = F.coalesce(job_type(t), F.when(F.lower(strip(r["employmentType"])) == "intern", "internship"))
        return _record(rows, source, title(r["title"]), kind, _ashby(r), link(r["jobUrl"], r["applyUrl"]), iso_date(r["publishedAt"]), none, r["id"], as_of, stored)
    if source == "greenhouse":
        named = F.coalesce(F.get_json_object(r["location"], "$.name"), F.when(~F.startswith(r["location"], F.lit("{")), r["location"]))
        return _record(rows, source, title(r["title"]), job_type(t), places(named), link(r["absolute_url"]), F.coalesce(iso_date(r["first_published"]), iso_date(r["updated_at"])), none, r["id"], as_of, stored)
    if source == "lever":
        return _record(rows, source, title(r["text"]), job_type(t), _lever(r), link(r["hostedUrl"], r["applyUrl"]), epoch_date(r["createdAt"]), none, r["id"], as_of, stored)
    if source == "icims":
        kind = F.coalesce(job_type(t), F.when(F.lower(strip(r["employment_type"])) == "intern", "internship"))
        several = F.array_join(F.filter(F.transform(F.coalesce(r["multipleLocations"], F.array()), lambda m: F.array_join(_texts(m["city"], m["state"], m["country"]), ", ")), lambda t: t != ""), " / ")
        where = first_text(several, r["full_location"], r["location_name"], r["short_location"], F.array_join(_texts(r["city"], r["state"], r["country"]), ", "), default="")
        own = F.when(netloc(career) != "", F.concat(F.lit("https://"), host(career), F.lit("/jobs/"), first_text(r["slug"], r["req_id"], default=""), F.lit("?lang=en-us&icims=1")))
        return _record(rows, source, title(r["title"]), kind, coded_places(where), link(r["classic_url"], own), posted_date(first_text(r["posted_date"], r["create_date"])), none, first_text(r["slug"], r["req_id"], default=""), as_of, stored)
    if source == "oracle_hcm":
        url = F.when(strip(r["Id"]) != "", F.concat(F.regexp_replace(career, "/+$", ""), F.lit("/job/"), strip(r["Id"])))
        return _record(rows, source, title(r["Title"]), job_type(t), places(r["PrimaryLocation"]), link(url), iso_date(r["PostedDate"]), none, r["Id"], as_of, stored)
    if source == "smartrecruiters":
        label = lambda s: F.lower(first_text(s["label"], s["id"], default=""))
        kind = F.coalesce(job_type(t), F.when(F.contains(label(r["typeOfEmployment"]), F.lit("intern")) | F.contains(label(r["experienceLevel"]), F.lit("internship")), "internship"))
        url = F.concat(F.regexp_replace(career, "/+$", ""), F.lit("/"), r["id"])
        return _record(rows, source, title(r["name"]), kind, _smart(r), link(url), iso_date(r["releasedDate"]), none, r["id"], as_of, stored)
    if source == "rippling":
        part = lambda p: first_text(p["name"], F.array_join(_texts(p["city"], first_text(p["stateCode"], p["state"]), p["country"]), ", "), default="")
        return _record(rows, source, title(r["name"]), job_type(t), _raw_places(r["locations"], part), link(r["url"]), F.lit(None).cast("string"), none, r["id"], as_of, stored)
    if source == "workable":
        part = lambda p: F.array_join(_texts(p["city"], p["region"], p["country"]), ", ")
        shown = F.filter(F.coalesce(r["locations"], F.array()), lambda p: ~F.coalesce(p["hidden"], F.lit(False)))
        listed = F.when(F.size(shown) > 0, shown).otherwise(F.filter(F.array(r["location"]), lambda p: p.isNotNull()))
        away = F.coalesce(r["remote"], F.lit(False)) | (F.lower(strip(r["workplace"])) == "remote")
        where = _raw_places(listed, part)
        where = F.when(away, F.when(where == MISSING, "Remote").otherwise(F.concat(F.lit("Remote, "), where))).otherwise(where)
        url = F.concat(F.regexp_replace(career, "/+$", ""), F.lit("/j/"), first_text(r["shortcode"], r["id"]), F.lit("/"))
        return _record(rows, source, title(r["title"]), job_type(t), where, link(url), iso_date(r["published"]), none, first_text(r["id"], r["shortcode"], default=""), as_of, stored)
    if source == "workday":
        text = lambda c: F.coalesce(F.get_json_object(c, "$.descriptor"), F.get_json_object(c, "$.displayName"), F.when(~F.startswith(c, F.lit("{")), c))
        detail = F.coalesce(F.col("detail_locations"), F.array()) if "detail_locations" in rows.columns else F.array().cast("array<string>")
        listed = F.filter(F.transform(F.coalesce(r["locations"], F.array()), text), lambda x: strip(x) != "")
        where = best_tier(detail, listed, _texts(text(r["primaryLocation"])), _texts(text(r["primaryLocationDescriptor"])), _texts(r["locationsText"]))
        path = strip(r["externalPath"])
        url = F.when((path != "") & (strip(career) != ""), F.concat(strip(career), F.when(F.startswith(path, F.lit("/")), "").otherwise("/"), path))
        return _record(rows, source, title(r["title"]), job_type(t), where, F.coalesce(url, blank_to(career, MISSING)), F.when(strip(r["postedOn"]) != "", r["postedOn"]), r["externalPath"], r["id"], as_of, stored)
    raise ValueError(f"unknown source {source}")


@dataclass(frozen=True)
class Handler:
    """A connector: landed payloads to raw rows, raw rows to records."""

    envelope: Callable[[DataFrame], DataFrame]
    normalise: Callable[[DataFrame, str], DataFrame]
    #: The same of raw rows that were written before, if there is a cheaper way.
    normalise_stored: Callable[[DataFrame, str], DataFrame] | None = None


REGISTRY: dict[str, Handler] = {k: Handler(lambda d, k=k: envelope(d, k), lambda d, as_of, k=k: normalise(d, k, as_of), lambda d, as_of, k=k: normalise(d, k, as_of, stored=True)) for k in SCHEMAS}


def register(source: str, handler: Handler) -> None:
    REGISTRY[source] = handler


def records(landed: DataFrame, source: str, as_of: str) -> DataFrame:
    handler = REGISTRY[source]
    return handler.normalise(handler.envelope(landed), as_of)
