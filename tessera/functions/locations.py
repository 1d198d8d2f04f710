"""Location functions: one place, several places, and the sources' own forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import MISSING, clean, let, strip

# Tokens in capitals, provinces and countries.
CAPITALS = ("ON", "QC", "BC", "AB", "MB", "SK", "NS", "NB", "NL", "PE", "NT", "NU", "YT", "CA", "US", "USA", "UK")
PROVINCES = {
    "ontario": "ON",
    "quebec": "QC",
    "québec": "QC",
    "british columbia": "BC",
    "alberta": "AB",
    "manitoba": "MB",
    "saskatchewan": "SK",
    "nova scotia": "NS",
    "new brunswick": "NB",
    "newfoundland and labrador": "NL",
    "prince edward island": "PE",
    "northwest territories": "NT",
    "nunavut": "NU",
    "yukon": "YT",
}
COUNTRIES = {
    "canada": "Canada",
    "ca": "Canada",
    "united states": "United States",
    "united states of america": "United States",
    "usa": "United States",
    "us": "United States",
    "france": "France",
    "united kingdom": "United Kingdom",
    "uk": "United Kingdom",
}


def _table(pairs: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in pairs.items() for x in pair))


def _undotted(c: Column) -> Column:
    return F.btrim(strip(c), F.lit("."))


def country_of(c: Column) -> Column:
    """Country of a token, or null."""
    return _table(COUNTRIES)[F.lower(_undotted(c))]


def _capital(word: Column) -> Column:
    return F.when(F.upper(word).isin(*CAPITALS), F.upper(word)).otherwise(F.concat(F.upper(F.substring(word, 1, 1)), F.lower(F.substr(word, F.lit(2)))))


def word_case(c: Column) -> Column:
    """Title case, known tokens in capitals, each part between hyphens on its own."""
    parts = F.filter(F.split(strip(c), "-"), lambda p: p != "")
    return F.when(F.instr(c, "-") > 0, F.array_join(F.transform(parts, _capital), "-")).otherwise(_capital(strip(c)))


def city_case(c: Column) -> Column:
    return F.array_join(F.transform(F.filter(F.split(c, " "), lambda w: w != ""), word_case), " ")


def region_of(c: Column) -> Column:
    """Province code, or any two letters in capitals, or ''."""
    return _region(_undotted(c))


def _region(t: Column) -> Column:
    return F.coalesce(_table(PROVINCES)[F.lower(t)], F.when(t.rlike("^[A-Za-z]{2}$"), F.upper(t)), F.lit(""))


def tokens_of(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, ","), strip), lambda t: t != "")


def _named_country(c: Column) -> Column:
    keys = sorted(COUNTRIES, key=lambda k: -len(k))
    return F.coalesce(*(F.when(F.lower(c).rlike(rf"(?U)\b{k}\b"), F.lit(COUNTRIES[k])) for k in keys))


def _hinted(hint: Column | None) -> Column:
    return F.lit(None).cast("string") if hint is None else F.when(strip(hint) != "", F.coalesce(country_of(hint), city_case(strip(hint))))


def _place(tokens: Column, hint: Column | None) -> Column:
    # What is asked of a token is told once, before tokens are compared.
    told = lambda t: let(F.btrim(t, F.lit(".")), lambda u: F.struct(t.alias("text"), _table(COUNTRIES)[F.lower(u)].alias("country"), _region(u).alias("region"), F.lower(t).isin(*COUNTRIES).alias("named")))

    def read(parts: Column) -> Column:
        country = F.coalesce(F.try_element_at(F.filter(parts, lambda x: x["country"].isNotNull()), F.lit(-1))["country"], _hinted(hint))
        plain, other = F.filter(parts, lambda x: ~x["named"]), F.filter(parts, lambda x: x["country"].isNull())
        kept = let(plain, lambda p: F.when(F.size(p) > 0, p).otherwise(let(other, lambda o: F.when(F.size(o) > 0, o).otherwise(parts))))

        def composed(back: Column, at: Column) -> Column:
            region = F.when(at > 0, F.try_element_at(back, at)["region"])
            good = F.filter(F.slice(back, at + 1, F.greatest(F.size(back), F.lit(1))), lambda x: (x["region"] == "") & ~x["named"] & ~x["text"].rlike(r"\d"))
            named = F.array(city_case(F.try_element_at(good, F.lit(1))["text"]), region, country)
            whole = F.array_join(F.filter(named, lambda t: t != ""), ", ")
            return let(whole, lambda t: F.when(t != "", t).otherwise(city_case(back[0]["text"])))

        return let(F.reverse(kept), lambda back: let(F.coalesce(F.array_min(F.transform(back, lambda x, i: F.when(x["region"] != "", i + 1))), F.lit(0)), lambda at: composed(back, at)))

    return let(F.transform(tokens, told), read)


def place(c: Column, hint: Column | None = None) -> Column:
    """One place as "City, RR, Country" with what is known, "Country Remote", or ''.

    A two-letter "CA" is read as Canada, and a spelled-out state is taken for a city.
    """

    def read(t: Column) -> Column:
        low = F.lower(t)
        named = F.try_element_at(F.filter(F.transform(tokens_of(t), country_of), lambda x: x.isNotNull()), F.lit(1))
        count = F.regexp_extract(low, r"^(\d+)\s+locations?$", 1)
        return (
            F.when(t == "", "")
            .when(F.instr(low, "remote") > 0, F.concat_ws(" ", F.coalesce(named, _named_country(t), _hinted(hint)), F.lit("Remote")))
            .when(low == "multiple locations", "Multiple Locations")
            .when(count != "", F.concat(count, F.lit(" Locations")))
            .otherwise(let(tokens_of(t), lambda parts: F.when(F.size(parts) > 0, _place(parts, hint)).otherwise("")))
        )

    return let(strip(F.element_at(F.split(clean(c), ":"), -1)), read)


def distinct_text(values: Column) -> Column:
    """The array without later values that differ from an earlier one in case only."""
    return F.when(F.size(values) < 2, F.filter(values, lambda x: x.isNotNull())).otherwise(let(F.transform(values, F.lower), lambda low: F.filter(values, lambda x, i: ~F.array_contains(F.slice(low, F.lit(1), i), F.get(low, i)))))


def places_list(c: Column, hint: Column | None = None) -> Column:
    """The places of a text in which ; or / stands between them."""
    parts = F.filter(F.transform(F.split(clean(c), "[;/]"), strip), lambda s: s != "")
    return let(F.filter(F.transform(parts, lambda s: place(s, hint)), lambda s: s != ""), distinct_text)


def joined(values: Column) -> Column:
    # Not nullif, which Spark writes out twice inside a lambda.
    return let(F.array_join(values, " / "), lambda t: F.when(t == "", MISSING).otherwise(t))


def places(c: Column, hint: Column | None = None) -> Column:
    """Places joined by " / ", or "Not specified"."""
    return joined(places_list(c, hint))


def is_generic(c: Column) -> Column:
    t = F.lower(strip(c))
    return (t == "") | (t == "multiple locations") | t.rlike(r"^\d+\s+locations?$")


def is_vague(c: Column) -> Column:
    t = F.lower(strip(c))
    return t.isin("multiple locations", "several locations") | t.rlike(r"^\d+\s+locations?$")


def best_tier(*tiers: Column) -> Column:
    """Places of the first tier (an array of texts) that names a specific one; else the first generic ones."""
    # Places are read once: the tiers are laid in one array before they are looked at.
    listed = F.transform(F.array(*tiers), lambda t: let(F.flatten(F.transform(t, lambda x: F.filter(F.split(places(x), " / "), lambda p: p != MISSING))), distinct_text))

    def best(found: Column) -> Column:
        specific = F.filter(F.transform(found, lambda x: F.filter(x, lambda p: ~is_generic(p))), lambda x: F.size(x) > 0)
        generic = F.filter(found, lambda x: F.size(x) > 0)
        return joined(F.coalesce(F.try_element_at(specific, F.lit(1)), F.try_element_at(generic, F.lit(1)), F.array().cast("array<string>")))

    return let(listed, best)


def verbatim_places(values: Column) -> Column:
    """"City, XX" as it is but for its case; other texts by :func:`places`."""
    pair = r"^([^,]+),\s*([A-Za-z]{2})$"

    def one(x: Column) -> Column:
        t = clean(x)
        return F.when(t.rlike(pair), F.array(F.concat(city_case(F.regexp_extract(t, pair, 1)), F.lit(", "), F.upper(F.regexp_extract(t, pair, 2))))).otherwise(places_list(t))

    return joined(let(F.flatten(F.transform(values, one)), distinct_text))


def coded_places(c: Column) -> Column:
    """Places given as CC-RR-City, CC-RR or CC codes between | or /."""

    def one(s: Column) -> Column:
        full, short = r"^([A-Za-z]{2})-([A-Za-z]{2})-(.+)$", r"^([A-Za-z]{2})-([A-Za-z]{2})$"
        nation = lambda p: F.coalesce(country_of(F.regexp_extract(s, p, 1)), F.upper(F.regexp_extract(s, p, 1)))
        text = (
            F.when(s.rlike(full), F.concat_ws(", ", F.replace(F.regexp_extract(s, full, 3), F.lit("-"), F.lit(" ")), F.upper(F.regexp_extract(s, full, 2)), nation(full)))
            .when(s.rlike(short), F.concat_ws(", ", F.upper(F.regexp_extract(s, short, 2)), nation(short)))
            .when(s.rlike("^[A-Za-z]{2}$"), F.coalesce(country_of(s), s))
            .otherwise(s)
        )
        return places_list(text)

    parts = F.filter(F.transform(F.split(strip(c), "[|/]"), strip), lambda s: s != "")
    return joined(let(F.flatten(F.transform(parts, one)), distinct_text))


def with_places(rows: DataFrame, column: str, name: str) -> DataFrame:
    """``rows`` with :func:`places` of a column as ``name``; every different text is read once.

    The texts are joined back, which Spark broadcasts or shuffles by their measured size.
    """
    found = rows.select(F.col(column).alias("_text")).distinct().withColumn(name, places(F.col("_text")))
    return rows.join(found, rows[column].eqNullSafe(found["_text"]), "left").drop("_text")
