"""HTML as a sequence of events, and questions about where they lie.

A page becomes one list of (kind, tag, attributes, text); links and visible text are then told from positions in it: what
lies between two anchor events, or inside the spans of some elements and outside those of others.
"""

from __future__ import annotations

from collections.abc import Callable
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np


class Event(NamedTuple):
    kind: str  # open, close or text
    tag: str
    attributes: dict
    text: str


def events(html: str | None) -> list[Event]:
    out: list[Event] = []
    reader = HTMLParser()
    reader.handle_starttag = lambda tag, attrs: out.append(Event("open", tag, dict(attrs), ""))
    reader.handle_endtag = lambda tag: out.append(Event("close", tag, {}, ""))
    reader.handle_data = lambda data: out.append(Event("text", "", {}, data))
    reader.feed(html or "")
    return out


def links(page: list[Event]) -> list[tuple[str, str]]:
    """(href, squeezed text) of every anchor with an address that is closed before another one opens."""
    anchors = [k for k, e in enumerate(page) if e.tag == "a"]
    pairs = [(a, b) for a, b in zip(anchors, anchors[1:]) if page[a].attributes.get("href") and page[b].kind == "close"]
    return [(page[a].attributes["href"], " ".join(" ".join(e.text for e in page[a:b]).split())) for a, b in pairs]


def spans(page: list[Event], empty: frozenset[str]) -> dict[int, int]:
    """Where each element ends, by the place where it opens. A closing tag ends the innermost open element of its name and
    all inside it; what is never closed ends with the page; `empty` elements have no span."""
    ends = {k: len(page) for k, e in enumerate(page) if e.kind == "open" and e.tag not in empty}
    standing: list[int] = []
    for k, e in enumerate(page):
        if k in ends:
            standing.append(k)
        elif e.kind == "close" and (same := [n for n, at in enumerate(standing) if page[at].tag == e.tag]):
            ends.update(dict.fromkeys(standing[same[-1]:], k))
            del standing[same[-1]:]
    return ends


def covered(size: int, ranges: list[tuple[int, int]]) -> np.ndarray:
    """Which places lie in any of the ranges."""
    steps = np.zeros(size + 1, int)
    for a, b in ranges:
        steps[a] += 1
        steps[b] -= 1
    return np.cumsum(steps)[:size] > 0


def visible(page: list[Event], wanted: Callable[[Event], bool] | None, unwanted: Callable[[Event], bool], empty: frozenset[str],
            heading: str = "h1") -> tuple[list[str], list[str], bool]:
    """(texts inside wanted elements, texts inside headings, whether any element is wanted), without what lies inside
    unwanted ones. With no `wanted` the whole page is."""
    ends = spans(page, empty)
    n = len(page)
    hidden = covered(n, [(a, b) for a, b in ends.items() if unwanted(page[a])])
    chosen = [k for k, e in enumerate(page) if e.kind == "open" and wanted is not None and wanted(e)]
    inside = covered(n, [(k, ends[k]) for k in chosen if k in ends]) if wanted is not None else np.ones(n, bool)
    stops = [k for k, e in enumerate(page) if e.kind == "close" and e.tag == heading] + [n]
    heads = covered(n, [(k, stops[np.searchsorted(stops, k)]) for k, e in enumerate(page) if e.kind == "open" and e.tag == heading and not hidden[k]])
    texts = [k for k, e in enumerate(page) if e.kind == "text" and not hidden[k]]
    return [page[k].text for k in texts if inside[k]], [page[k].text for k in texts if heads[k]], wanted is None or bool(chosen)
