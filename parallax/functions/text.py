"""Titles, bibliographic fields and raw answers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: quotes and dashes and what they become; the words for chapter
CURLY, PLAIN = "“”„‘’‚–—", "\"\"\"'''--"
CHAPTER = "chapter|kapitel|chapitre|capítulo"


def normalize_title(title: Column, authors: Column) -> Column:
    """A title for strict comparison.

    In this order: plain quotes and dashes; no leading chapter number, with or without the word; no author before (with . : or -), after (with
    the same, or in parentheses); no parenthesis at the end; trimmed. Authors are taken as they are.
    """
    t = F.replace(F.translate(title, CURLY, PLAIN), F.lit("…"), F.lit("..."))
    t = F.regexp_replace(t, rf"(?iuU)^\s*(?:(?:{CHAPTER})\s+)?\d+(?:\.\d+)*\s*[.:]?\s+", "")

    def without(t: Column, author: Column) -> Column:
        name = F.concat(F.lit(r"\Q"), F.trim(author), F.lit(r"\E"))
        t = F.regexp_replace(t, F.concat(F.lit(r"(?iuU)^\s*"), name, F.lit(r"\s*[.:\-]\s*")), F.lit(""))
        t = F.regexp_replace(t, F.concat(F.lit(r"(?iuU)\s*[.:\-]\s*"), name, F.lit(r"\s*$")), F.lit(""))
        return F.regexp_replace(t, F.concat(F.lit(r"(?iuU)\s*\(\s*"), name, F.lit(r"\s*\)\s*$")), F.lit(""))

    t = F.aggregate(F.filter(F.coalesce(authors, F.array().cast("array<string>")), lambda a: F.trim(a) != ""), t, without)
    return F.trim(F.regexp_replace(t, r"(?U)\s*\([^()]*\)\.?\s*$", ""))


def without_fence(answer: Column) -> Column:
    """A fenced answer without its fence lines."""
    lines = F.array_join(F.filter(F.split(answer, "\n"), lambda x: ~x.startswith("```")), "\n")
    return F.when(answer.startswith("```"), lines).otherwise(answer)


def array_span(answer: Column) -> Column:
    """From the first [ to the last ]; null if there is no such span."""
    first, back = F.instr(answer, "["), F.instr(F.reverse(answer), "]")
    return F.when((first > 0) & (back > 0) & (F.length(answer) - back + 1 > first), F.substr(answer, first, F.length(answer) - back + 2 - first))


def first_page(pages: Column) -> Column:
    head = F.trim(F.split_part(pages, F.lit("-"), F.lit(1)))
    return F.when(head != "", head)


def without_glued_page(title: Column, page: Column) -> Column:
    return F.when(F.startswith(title, page), F.ltrim(F.substr(title, F.length(page) + 1))).otherwise(title)


def normalize_isbn(raw: Column) -> Column:
    """The first number of 13 digits, else the first of ten, hyphens dropped and X in upper case."""
    parts = F.transform(F.split(raw, r"[;\s]+"), lambda p: F.upper(F.regexp_replace(p, "-", "")))
    long = F.try_element_at(F.filter(parts, lambda p: p.rlike(r"^\d{13}$")), F.lit(1))
    return F.coalesce(long, F.try_element_at(F.filter(parts, lambda p: p.rlike(r"^\d{9}[\dX]$")), F.lit(1)))


def book_doi(items: Column) -> Column:
    """The DOI of the first item that is a book; null if that one has none."""
    return F.try_element_at(F.filter(items, lambda i: i["type"].isin("book", "monograph", "edited-book", "reference-book")), F.lit(1))["DOI"]


def decade(publication: Column) -> Column:
    """Decade of the first event with a year, as 1990s; unknown if there is none."""
    years = F.transform(publication, lambda p: F.substring(F.coalesce(p["startDate"], p["dateStatement"]), 1, 4))
    first = F.try_element_at(F.filter(years, lambda y: y.rlike(r"^\d{4}$")), F.lit(1))
    return F.coalesce(F.concat(F.substring(first, 1, 3), F.lit("0s")), F.lit("unknown"))


def record_key(isbn: Column, identifier: Column) -> Column:
    last = F.regexp_extract(F.regexp_replace(identifier, "[#!]+$", ""), r"([^/]*)$", 1)
    return F.coalesce(F.try_element_at(isbn, F.lit(1)), F.when(last != "", last), F.lit("unknown"))
