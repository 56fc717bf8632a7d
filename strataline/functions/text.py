"""Scalar text and date expressions; all of them stay inside the JVM."""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataline.lexicons import NO_ABSTRACT

BLANK = r"[\s\x1c-\x1f]"


def trim(c: Column) -> Column:
    """Without outer blanks of any kind."""
    return F.regexp_replace(c, rf"(?U)^{BLANK}+|{BLANK}+$", "")


def clean(c: Column) -> Column:
    """Text without tags and bracketed paragraph numbers, blanks merged, trimmed; null stays null."""
    text = F.regexp_replace(c, r"<[^>]+>", "")
    text = F.regexp_replace(F.regexp_replace(text, r"[\n\r\t]", " "), r"\[[0-9]{4}\]", "")
    return trim(F.regexp_replace(text, rf"(?U){BLANK}+", " "))


@functools.cache
def fold_map() -> tuple[str, str]:
    """Characters whose decomposition holds one ASCII character, and that character, by rule."""
    source, target = [], []
    for point in range(0x80, 0x20000):
        if 0xD800 <= point < 0xE000:
            continue
        plain = [c for c in unicodedata.normalize("NFD", chr(point)) if ord(c) < 128]
        if len(plain) == 1:
            source.append(chr(point))
            target.append(plain[0])
    return "".join(source), "".join(target)


def fold(c: Column) -> Column:
    """ASCII letters without accents; other characters vanish; null becomes empty."""
    source, target = fold_map()
    return F.regexp_replace(F.translate(F.coalesce(c, F.lit("")), source, target), r"[^\x00-\x7F]", "")


def year(priority: Column, publication: Column) -> Column:
    """First four characters of the priority date, else of the publication date."""
    return F.coalesce(F.nullif(F.substring(priority, 1, 4), F.lit("")), F.substring(publication, 1, 4))


def valid_year(c: Column) -> Column:
    """A four-digit year as an integer, else null."""
    return F.when(c.rlike(r"^[0-9]{4}$"), c.try_cast("int"))


def record_link(country: Column, number: Column, kind: Column, base: str = "https://worldwide.espacenet.com/publicationDetails/biblio") -> Column:
    """A link built of the three parts of a publication id, null parts empty."""
    part = lambda c: F.coalesce(c, F.lit(""))
    return F.concat(F.lit(f"{base}?CC="), part(country), F.lit("&NR="), part(number), F.lit("&KC="), part(kind), F.lit("&FT=D"))


def search_text(title: Column, abstract: Column) -> Column:
    """Title, a blank, abstract; the blank stays where one is null."""
    return F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(abstract, F.lit("")))


def non_ascii(c: Column) -> Column:
    return F.coalesce(c, F.lit("")).rlike(r"[^\x00-\x7F]")


def says_no_abstract(c: Column) -> Column:
    """Whether the sentinel of a missing abstract is in the text, in any case."""
    return F.lower(F.coalesce(c, F.lit(""))).contains(NO_ABSTRACT[:21].lower())


def no_abstract(c: Column) -> Column:
    """Sentinel, null or blank."""
    return says_no_abstract(c) | (trim(F.coalesce(c, F.lit(""))) == "")


def good_text(title: Column, abstract: Column) -> Column:
    """A stated abstract and an ASCII title."""
    return ~(says_no_abstract(abstract) | non_ascii(title))


def needs_review(title: Column, abstract: Column) -> Column:
    """No abstract and a title that isn't ASCII."""
    return no_abstract(abstract) & non_ascii(title)


def url_quote(c: Column) -> Column:
    """Percent-encoding with blanks as %20."""
    return F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))


def elapsed(seconds: Column) -> Column:
    """Whole minutes and seconds as ``3m 7s``; null stays null."""
    return F.concat(F.floor(seconds / 60).cast("string"), F.lit("m "), F.floor(F.pmod(seconds, F.lit(60))).cast("string"), F.lit("s"))
