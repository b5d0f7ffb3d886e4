"""Text expressions for survey headings and dated encyclopedia entries."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MAX_LINKS = 20


def metric_key(year: Column, metric: Column) -> Column:
    """``2015`` and ``pov_adult`` to ``2015_pov_adult``."""
    return F.concat_ws("_", year.cast("string"), metric)


def split_metric_key(key: Column) -> tuple[Column, Column]:
    """``2015_pov_adult`` to (2015, ``pov_adult``)."""
    pattern = r"(\d{4})_(.+)"
    return F.regexp_extract(key, pattern, 1).cast("int"), F.regexp_extract(key, pattern, 2)


def county_name(area: Column) -> Column:
    """``Anderson County, Tennessee`` to ``Anderson``; names of several words stay whole."""
    named = F.regexp_extract(area, r"^(.*?) County", 1)
    return F.when(named != "", named).otherwise(F.trim(F.split_part(area, F.lit(","), F.lit(1))))


def strip(text: Column) -> Column:
    """Without white space (blanks, tabs, line ends) at both ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def strip_citations(text: Column) -> Column:
    """Remove citation marks such as ``[12]`` and trim."""
    return strip(F.regexp_replace(text, r"\[\d+\]", ""))


def is_link_text(text: Column) -> Column:
    """Links whose text is a bare number are left out; an empty text is kept."""
    return ~F.coalesce(text, F.lit("")).rlike(r"^\d+$")


def url_tag(url: Column) -> Column:
    """Last path part of a URL with ``_`` as blank, percent-decoded and trimmed.

    A part with a broken escape stays as it is.
    """
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    spaced = F.translate(F.regexp_extract(path, r"([^/;]*)(?:;[^/]*)?$", 1), "_", " ")
    # url_decode reads "+" as a blank; in a path it is a plain plus.
    decoded = F.try_url_decode(F.replace(spaced, F.lit("+"), F.lit("%2B")))
    return strip(F.coalesce(decoded, spaced))


def blank_own_date(links: Column, date: Column) -> Column:
    """Null out links that point back to the page's own date.

    The slot stays in place; a tag with ``BC`` in it is always kept.
    """

    def keep(link: Column) -> Column:
        own = link["tag"].eqNullSafe(date) & ~link["tag"].contains("BC")
        empty = F.lit(None).cast("string")
        return F.struct(
            F.when(own, empty).otherwise(link["tag"]).alias("tag"),
            F.when(own, empty).otherwise(link["link"]).alias("link"),
        )

    return F.transform(links, keep)


def link_slots(links: Column, slots: int = MAX_LINKS) -> list[Column]:
    """The first ``slots`` links as flat columns ``tag_1 .. link_n``, null padded."""
    tags = [F.get(links, F.lit(i))["tag"].alias(f"tag_{i + 1}") for i in range(slots)]
    urls = [F.get(links, F.lit(i))["link"].alias(f"link_{i + 1}") for i in range(slots)]
    return tags + urls


def filled_links(links: Column) -> Column:
    """Only the links with both tag and URL."""
    return F.filter(links, lambda x: x["tag"].isNotNull() & x["link"].isNotNull())


def _tokens(text: Column) -> Column:
    return F.split(text, " ")


def year_text(text: Column) -> Column:
    """The digits of an entry's year, null where the entry has no digit at all.

    The first word counts, after ``AD`` the second, otherwise the first run of digits.
    """
    words = _tokens(text)
    word = F.when(F.get(words, F.lit(0)) == "AD", F.get(words, F.lit(1))).otherwise(F.get(words, F.lit(0)))
    run = F.regexp_extract(text, r"[0-9]+", 0)
    return F.when(word.rlike(r"^[0-9]+$"), word).when(run != "", run)


def signed_year(text: Column) -> Column:
    """Year of an entry, negative for years BC.

    BC is read from what stands before the dash (``44 BC - text``).  Rows such as
    ``AD 69 - text`` stay positive although the dash follows the second word there too.
    Numbers too long for a bigint give null.
    """
    before_dash = F.split_part(text, F.lit("–"), F.lit(1))
    year = year_text(text).try_cast("bigint")
    return F.when(before_dash.rlike(r"\bBC\b"), -year).otherwise(year)


def entry_body(text: Column) -> Column:
    """Words from the third on, without a leading dash."""
    rest = F.regexp_replace(text, r"^[^ ]* ?[^ ]* ?", "")
    return F.when(rest.startswith("–"), strip(F.substring(rest, 2, 2147483647))).otherwise(rest)
