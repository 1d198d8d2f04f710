"""String functions: clean-up, titles, seasons, ids and cells."""

from __future__ import annotations

import html
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MISSING = "Not specified"

# Title patterns by kind, tried in the order internship, experienced, new grad.
INTERNSHIP = (r"\bintern(ship)?s?\b", r"\bco[\s-]?op\b", r"\bstudent\b", r"\bsummer student\b", r"\bfall student\b", r"\bwinter student\b", r"\bstagiaire\b", r"\bstage\b")
EXPERIENCED = (r"\bsenior\b", r"\bsr\.?\b", r"\bmanager\b", r"\bdirector\b", r"\bprincipal\b", r"\bstaff\b", r"\blead\b", r"\bhead of\b", r"\bexperienced\b")
NEW_GRAD = (r"\bnew grad(uate)?s?\b", r"\bgraduate program\b", r"\bearly career\b", r"\bentry[\s-]?level\b", r"\buniversity graduate\b", r"\brecent graduate\b")
SEASONS = ("Summer", "Fall", "Winter", "Spring")
#: Unicode's white space.
SPACES = "\t\n\x0b\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    # Not [0], which works out the type and nullability of all of ``body`` again for every row.
    return F.element_at(F.transform(F.array(value), body), 1)


def once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """``rows`` with a column that is computed once per row.

    A generator of one row: filters on it are not pushed below it with the value spelled out again,
    and what reads it several times does not copy it.
    """
    return rows.select(*(c for c in rows.columns if c != name), F.explode(F.array(value)).alias(name))


def strip(c: Column) -> Column:
    """Without white space (Unicode's) at both ends; null becomes ''."""
    return F.btrim(F.coalesce(c, F.lit("")), F.lit(SPACES))


def clean(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return strip(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))


def blank_to(c: Column, default: str | Column | None) -> Column:
    """Stripped text, or ``default`` where it is missing or blank."""
    return F.coalesce(F.nullif(strip(c), F.lit("")), default if isinstance(default, Column) else F.lit(default))


def first_text(*columns: Column, default: str | None = None) -> Column:
    """The first of the columns that isn't blank."""
    return F.coalesce(*(F.nullif(strip(c), F.lit("")) for c in columns), F.lit(default))


@F.arrow_udf(T.StringType())
def fold(texts: pa.Array) -> pa.Array:
    """Unicode's full case folding, for keys and orders, in Arrow batches."""
    return pa.array([None if x is None else x.casefold() for x in texts.to_pylist()], pa.string())


def low_key(c: Column) -> Column:
    """As :func:`fold` for parts of URLs, in columns alone: lower case, sharp s spelled out."""
    return F.replace(F.lower(c), F.lit("ß"), F.lit("ss"))


def slug(c: Column) -> Column:
    parts = F.regexp_replace(F.lower(strip(c)), "[^a-z0-9]+", "-")
    return F.coalesce(F.nullif(F.regexp_replace(parts, "^-|-$", ""), F.lit("")), F.lit("unknown"))


def alphanumeric(c: Column) -> Column:
    return F.regexp_replace(fold(F.coalesce(c, F.lit(""))), "[^a-z0-9]", "")


def search_term(c: Column) -> Column:
    return clean(F.replace(F.lower(F.coalesce(c, F.lit(""))), F.lit("-"), F.lit(" ")))


def escape_cell(c: Column) -> Column:
    return strip(F.replace(F.coalesce(c, F.lit("")), F.lit("|"), F.lit("\\|")))


def _any(c: Column, patterns: tuple[str, ...]) -> Column:
    return c.rlike(f"(?iU)(?:{'|'.join(patterns)})")


def job_type(title: Column) -> Column:
    """internship, new_grad or null; internship words come before the experienced ones."""
    return let(clean(F.replace(F.lower(F.coalesce(title, F.lit(""))), F.lit("–"), F.lit("-"))), lambda t: F.when(_any(t, INTERNSHIP), "internship").when(_any(t, EXPERIENCED), F.lit(None)).when(_any(t, NEW_GRAD), "new_grad"))


def season(title: Column) -> Column:
    """Season and year in either order, or the season, or a year from 2000 to 2099."""
    t = strip(title)
    dated, plain = [], []
    for s in SEASONS:
        after, before = (F.nullif(F.regexp_extract(t, p, 1), F.lit("")) for p in (rf"(?iU)\b{s}\b\s+(20\d{{2}})", rf"(?iU)\b(20\d{{2}})\s+\b{s}\b"))
        dated.append(F.when(F.coalesce(after, before).isNotNull(), F.concat_ws(" ", F.lit(s), F.coalesce(after, before))))
        plain.append(F.when(t.rlike(rf"(?iU)\b{s}\b"), F.lit(s)))
    told = F.coalesce(*dated, *plain, F.nullif(F.regexp_extract(t, r"(?U)\b(20\d{2})\b", 1), F.lit("")), F.lit(MISSING))
    # Most titles name neither: one pattern tells so before each is looked for.
    return F.when(t.rlike(rf"(?iU)\b(?:{'|'.join(SEASONS)}|20\d{{2}})\b"), told).otherwise(F.lit(MISSING))


def job_id(source: Column, company: Column, path: Column, raw_id: Column, title: Column, location: Column, url: Column) -> Column:
    """source-company-token; the token comes from the path, the id, or a digest of title, location and URL."""
    digest = F.substring(F.sha1(F.concat_ws("::", title, location, url)), 1, 12)
    token = F.when(strip(path) != "", slug(path)).when(strip(raw_id) != "", slug(raw_id)).otherwise(digest)
    return F.concat_ws("-", source, slug(company), token)


def enabled_flag(c: Column) -> Column:
    """true, yes, 1 / false, no, 0 / null for anything else."""
    t = F.lower(strip(c))
    return F.when(t.isin("true", "yes", "1"), True).when(t.isin("false", "no", "0"), False)


@F.arrow_udf(T.StringType())
def decoded(texts: pa.Array) -> pa.Array:
    """Texts with every character reference decoded, in Arrow batches."""
    return pa.array([None if x is None else html.unescape(x) for x in texts.to_pylist()], pa.string())


def strip_tags(c: Column) -> Column:
    """Tags to spaces, character references decoded."""
    return clean(decoded(F.regexp_replace(F.coalesce(c, F.lit("")), "<[^>]+>", " ")))
