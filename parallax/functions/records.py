"""Bibliographic records, registry items, raw answers and endpoint settings as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parallax.functions.pages import normalize_page
from parallax.functions.text import array_span, first_page, without_fence, without_glued_page

# fixed values: three-letter language codes and the two-letter ones that stand for them; the windows of rate limits, the
# longest first; attempts, the first wait and the pause of a rate limit, in seconds
LANGUAGES = {"ger": "de", "eng": "en", "fre": "fr", "fra": "fr", "spa": "es", "ita": "it", "dut": "nl", "nld": "nl", "lat": "la", "rus": "ru"}
WINDOWS = ("day", "hour", "minute")
ATTEMPTS, FIRST_WAIT, PAUSE = 6, 2.0, 20.0


def matches(types: Column, contents: Column) -> Column:
    """Whether a record is of an edited volume that has a table of contents."""
    return F.coalesce(F.array_contains(types, "EditedVolume") & (F.size(contents) > 0), F.lit(False))


def toc_url(contents: Column) -> Column:
    """The first absolute web address among the entries."""
    return F.try_element_at(F.filter(F.transform(contents, lambda c: c["id"]), lambda u: u.rlike("(?i)^https?:")), F.lit(1))


def language(codes: Column) -> Column:
    """The last part of the first code's address, in two letters where they are known."""
    code = F.regexp_extract(F.try_element_at(codes, F.lit(1))["id"], r"([^/]*)$", 1)
    known = F.create_map(*(F.lit(x) for pair in LANGUAGES.items() for x in pair))
    return F.when(code != "", F.coalesce(F.try_element_at(known, code), code))


def api_url(identifier: Column) -> Column:
    bare = F.regexp_replace(identifier, "[#!]+$", "")
    return F.when(bare != "", F.concat(bare, F.lit("?format=json")))


def chapter(item: Column) -> Column:
    """(title, authors, page) of a registry item; null if it isn't a chapter with a title."""
    page = first_page(item["page"])
    title = F.try_element_at(item["title"], F.lit(1))
    title = F.coalesce(without_glued_page(title, page), title)
    subtitle = F.try_element_at(item["subtitle"], F.lit(1))
    full = F.when(subtitle.isNotNull(), F.concat(title, F.lit(" "), subtitle)).otherwise(title)
    named = F.filter(F.coalesce(item["author"], F.array()), lambda a: a["family"] != "")
    authors = F.transform(named, lambda a: F.trim(F.concat(F.coalesce(a["given"], F.lit("")), F.lit(" "), a["family"])))
    return F.when((item["type"] == "book-chapter") & title.isNotNull(), F.struct(full.alias("title"), authors.alias("authors"), page.alias("page")))


def answer_items(answer: Column) -> Column:
    """The array in a raw answer, fenced or not, as variants; null if there is none or it isn't JSON."""
    return F.try_parse_json(array_span(without_fence(F.trim(answer)))).try_cast("array<variant>")


def answer_entries(answer: Column) -> Column:
    """Entries of a raw answer: items that are objects with a title of three characters at least.

    Authors count only if they are a list, blank ones don't; a page is normalised; skip is true for whatever isn't
    empty, null, zero or false.
    """
    get = lambda v, path, kind="string": F.try_variant_get(v, path, kind)
    given = F.filter(answer_items(answer), lambda v: F.schema_of_variant(v).startswith("OBJECT"))

    def entry(v: Column) -> Column:
        names = F.filter(F.transform(F.coalesce(get(v, "$.authors", "array<string>"), F.array().cast("array<string>")), lambda a: F.trim(a)), lambda a: a != "")
        said, kind = get(v, "$.skip"), F.schema_of_variant(get(v, "$.skip", "variant"))
        skip = F.when(kind == "BOOLEAN", said == "true").when(kind == "STRING", said != "").when(kind.startswith("ARRAY"), said != "[]").when(kind.startswith("OBJECT"), said != "{}").when(kind != "VOID", get(v, "$.skip", "double") != 0)
        return F.struct(F.trim(F.coalesce(get(v, "$.title"), F.lit(""))).alias("title"), names.alias("authors"), normalize_page(get(v, "$.printed_page_number", "variant")).alias("page"), F.coalesce(skip, F.lit(False)).alias("skip"))

    return F.filter(F.transform(given, entry), lambda e: F.length(e["title"]) >= 3)


def model_of(arguments: Column) -> Column:
    found = F.regexp_extract(arguments, r"--model[= ](\S+)", 1)
    return F.when(found != "", found)


def file_part(model: Column) -> Column:
    """A model's name as it stands in file names."""
    return F.replace(model, F.lit("/"), F.lit("__"))


def model_from_file_part(part: Column) -> Column:
    """A model's name from how it stands in file names; one that had two underscores of its own doesn't come back."""
    return F.replace(part, F.lit("__"), F.lit("/"))


def binding_window(headers: Column) -> Column:
    """The longest window of which nothing remains; null if no header says so."""
    spent = F.transform(F.filter(F.map_entries(headers), lambda e: F.lower(e["key"]).startswith("x-ratelimit-remaining-") & (F.trim(e["value"]) == "0")), lambda e: F.regexp_extract(F.lower(e["key"]), r"([^-]*)$", 1))
    return F.coalesce(*(F.when(F.array_contains(spent, w), w) for w in WINDOWS))


def retry_delay(attempt: Column, limited: Column, headers: Column, attempts: int = ATTEMPTS, base: float = FIRST_WAIT, pause: float = PAUSE) -> Column:
    """Seconds to wait after a failed attempt (from 0); null where no further one follows.

    A rate limit waits as long as it says, else pause times the attempts made; one for a whole day ends the tries. Any
    other failure waits twice as long each time.
    """
    told = F.try_element_at(headers, F.lit("retry-after")).try_cast("double")
    wait = F.when(limited, F.coalesce(told, pause * (attempt + 1))).otherwise(base * F.pow(F.lit(2.0), attempt))
    over = (attempt >= attempts - 1) | (limited & F.coalesce(binding_window(headers) == "day", F.lit(False)))
    return F.when(~over, wait)
