"""Anchors of pages: one pass cuts markup into events, then running counts over the events pair them.

A stretch of events ends at each closing anchor tag. Its link is the first opening tag with an address in it; the text
between that tag and the end of the stretch is the link's text. Later opening tags of the stretch are nested, a last
stretch without a closing tag holds no link.
"""

from __future__ import annotations

from collections.abc import Iterable
from html.parser import HTMLParser

import pandas as pd

TITLES = ("title", "aria-label", "data-title")
EVENT = ["page", "kind", "href", "titles", "data"]


class _Events(HTMLParser):
    """Appends (page, kind, href, titles, data) rows; keeps no state between events."""

    def __init__(self, page: int, rows: list[tuple]):
        super().__init__(convert_charrefs=True)
        self.page, self.rows = page, rows

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            named = dict(attrs)
            href = (named.get("href") or "").strip()
            if href:
                self.rows.append((self.page, "open", href, " ".join(v for t in TITLES if (v := named.get(t))), None))

    def handle_endtag(self, tag):
        if tag == "a":
            self.rows.append((self.page, "close", None, None, None))

    def handle_data(self, data):
        self.rows.append((self.page, "data", None, None, data))


def link_table(pages: Iterable[str | None]) -> pd.DataFrame:
    """(page, pos, href, text, searchable) of the links of several pages; ``page`` is the place in ``pages``."""
    rows: list[tuple] = []
    for page, markup in enumerate(pages):
        _Events(page, rows).feed(markup or "")
    events = pd.DataFrame(rows, columns=EVENT)
    closing, opening = events["kind"].eq("close"), events["kind"].eq("open")
    events["stretch"] = closing.cumsum() - closing
    stretch = events.groupby(["page", "stretch"], sort=False)
    opened = opening.groupby([events["page"], events["stretch"]]).cumsum()
    inside = events[stretch["kind"].transform("last").eq("close") & opened.gt(0)]
    links = inside[inside["kind"].eq("open")].drop_duplicates(["page", "stretch"])
    words = inside[inside["kind"].eq("data")].groupby(["page", "stretch"])["data"].agg(lambda s: " ".join(" ".join(s).split()))
    links = links.drop(columns="data").merge(words.rename("text").reset_index(), "left", ["page", "stretch"])
    links["text"] = links["text"].fillna("")
    links["pos"] = links.groupby("page").cumcount()
    links["searchable"] = [" ".join(filter(None, parts)) for parts in zip(links["text"], links["href"], links["titles"], strict=True)]
    return links[["page", "pos", "href", "text", "searchable"]]
