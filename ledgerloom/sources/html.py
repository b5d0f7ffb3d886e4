"""List entries of landed web pages.

Reading HTML needs a parser, so this step runs in Python, in batches on the executors.  The
parser only finds list items and their links; everything after that is Spark expressions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from urllib.parse import urljoin

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import is_link_text, strip_citations, url_tag

ENTRY_SCHEMA = (
    "page_id bigint, url string, list_no int, item_no int, raw_text string, "
    "anchors array<struct<text: string, url: string>>"
)
_ITEMS = pa.schema(
    {
        "page_id": pa.int64(), "url": pa.string(), "list_no": pa.int32(), "item_no": pa.int32(), "raw_text": pa.string(),
        "anchors": pa.list_(pa.struct({"text": pa.string(), "url": pa.string()})),
    }
)
# Fixed layout of a date page: the first nine lists hold three lists each of events, births, deaths.
LISTS_PER_PAGE = 9
FIRST_BIRTH_LIST = 3
FIRST_DEATH_LIST = 6
# Items are handed on as soon as their texts and links hold this many characters.
OUTPUT_CHARS = 4 << 20

# So many pages of a batch are Python objects at a time; the others stay as they came.
PAGES_AT_ONCE = 200

# What is never shown is one token, list and link tags are the others; all else is left to the text in between.
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)"""
    r"""|<(?P<silent>script|style|template|textarea|title)\b.*?(?:</(?P=silent)\s*>|\Z)"""
    r"""|<(?P<end>/?)(?P<tag>ul|li|a)(?=[\s/>])(?P<attributes>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""",
    re.DOTALL | re.IGNORECASE,
)
_HREF = re.compile(r"""(?:^|\s)href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
_OTHER_TAG = re.compile(r"</?[a-zA-Z!?](?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
_SPACE = re.compile(r"\s+")


def _tidy(parts: list[str]) -> str:
    return _SPACE.sub(" ", unescape(_OTHER_TAG.sub("", "".join(parts)))).strip()


def list_items(html: str, base: str | None = None) -> list[tuple[int, int, str, list[dict]]]:
    """(list number, item number in the list, text, links) in page order, links made absolute.

    An item of a nested list belongs to its own list and to every list around it.  Items and
    links left open end where the next one of the same list begins, as in a browser.
    """
    html = html or ""
    items: list[tuple[list[int], list[str], list[dict]]] = []
    opened: list[tuple[str, object]] = []  # ("ul", list number) or ("li", item)
    anchor: tuple[str, list[str]] | None = None
    n_lists = 0
    place = 0

    def inside(kind: str) -> list:
        return [thing for tag, thing in opened if tag == kind]

    def end_anchor() -> None:
        nonlocal anchor
        if anchor:
            href, parts = anchor
            anchor = None
            link = {"text": _tidy(parts), "url": urljoin(base, href) if base else href}
            for _, _, links in inside("li"):
                links.append(link)

    for token in _TOKEN.finditer(html):
        if opened or anchor:
            shown = html[place : token.start()]
            for _, parts, _ in inside("li"):
                parts.append(shown)
            if anchor:
                anchor[1].append(shown)
        place = token.end()
        tag = (token["tag"] or "").lower()
        if not tag:
            continue
        if tag == "a":
            end_anchor()
            href = None if token["end"] else _HREF.search(token["attributes"])
            if href:
                anchor = (unescape(next(g for g in href.groups() if g is not None)), [])
        elif not token["end"]:
            if tag == "ul":
                opened.append(("ul", n_lists))
                n_lists += 1
                continue
            if opened and opened[-1][0] == "li":
                end_anchor()
                opened.pop()
            lists = inside("ul")
            if lists:
                items.append((lists, [], []))
                opened.append(("li", items[-1]))
        elif inside(tag) and not (tag == "li" and opened[-1][0] == "ul"):
            # An item cannot end while a list inside it is open.
            end_anchor()
            while opened.pop()[0] != tag:
                pass
    for _, parts, _ in inside("li"):
        parts.append(html[place:])

    counts: dict[int, int] = {}
    found = []
    for lists, parts, links in items:
        text = _tidy(parts)
        for number in lists:
            found.append((number, counts.get(number, 0), text, links))
            counts[number] = counts.get(number, 0) + 1
    return found


def item_batches(pages: pd.DataFrame, chars: int = OUTPUT_CHARS) -> Iterator[pd.DataFrame]:
    """The items of some pages in page order; no batch goes over ``chars`` by more than its last item."""
    names = ["page_id", "url", "list_no", "item_no", "raw_text", "anchors"]
    rows, held = [], 0
    for page_id, url, html in zip(pages["page_id"], pages["url"], pages["html"]):
        for list_no, item_no, text, links in list_items(html, url):
            rows.append((page_id, url, list_no, item_no, text, links))
            held += len(url or "") + len(text) + sum(len(link["text"]) + len(link["url"]) for link in links)
            if held >= chars:
                yield pd.DataFrame(rows, columns=names)
                rows, held = [], 0
    if rows:
        yield pd.DataFrame(rows, columns=names)


def page_items(pages: DataFrame) -> DataFrame:
    """Raw list items of ``pages(page_id, url, html)``."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PAGES_AT_ONCE):
                for items in item_batches(batch.slice(at, PAGES_AT_ONCE).to_pandas(integer_object_nulls=True)):
                    yield pa.RecordBatch.from_pandas(items, schema=_ITEMS, preserve_index=False)

    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html").mapInArrow(parse, ENTRY_SCHEMA)


def entry_type(list_no: Column, first_birth: int = FIRST_BIRTH_LIST, first_death: int = FIRST_DEATH_LIST) -> Column:
    return F.when(list_no < first_birth, "event").when(list_no < first_death, "birth").otherwise("death")


def entries(items: DataFrame, lists: int = LISTS_PER_PAGE) -> DataFrame:
    """Entries of the first lists of each page: type, clean text, links as (tag, link).

    ``items`` comes from :func:`page_items`; the number of lists is the page layout.
    """
    kept = F.filter("anchors", lambda a: is_link_text(a["text"]))
    links = F.transform(kept, lambda a: F.struct(url_tag(a["url"]).alias("tag"), a["url"].alias("link")))
    return items.filter(F.col("list_no") < lists).select(
        "page_id",
        "url",
        "list_no",
        "item_no",
        entry_type(F.col("list_no")).alias("event_type"),
        strip_citations(F.col("raw_text")).alias("text"),
        links.alias("links"),
    )
