"""HTML pages to rows: anchors, titles, metadata panels, document links."""

from __future__ import annotations

import re
from html.parser import HTMLParser
from urllib.parse import parse_qs, urlencode, urljoin, urlsplit, urlunsplit

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, MapType, StringType, StructField, StructType

#: What makes a resolved link a document.
ACCEPT = [r"\.pdf($|[?#])", r"/bitstreams?/", r"/article/download/", r"/download/", r"/view/manf/", r"viewer\.html\?file=", r"pdfjs"]
_VOID = set("area base br col embed hr img input link meta source track wbr".split())


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None) -> None:
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent

    @property
    def classes(self) -> set[str]:
        return set((self.attrs.get("class") or "").split())

    def walk(self):  # noqa: ANN201
        for c in self.children:
            if isinstance(c, Node):
                yield c
                yield from c.walk()

    def find(self, tag: str | None = None, *classes: str, attr: str | None = None) -> list[Node]:
        return [n for n in self.walk() if (not tag or n.tag == tag) and set(classes) <= n.classes and (not attr or n.attrs.get(attr) is not None)]

    def text(self) -> str:
        out: list[str] = []
        stack = [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                if n.strip():
                    out.append(" ".join(n.split()))
            elif n.tag not in ("script", "style"):
                stack.extend(reversed(n.children))
        return " ".join(out)


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag, attrs) -> None:  # noqa: ANN001
        n = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(n)
        if tag not in _VOID:
            self.at = n

    def handle_startendtag(self, tag, attrs) -> None:  # noqa: ANN001
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag) -> None:  # noqa: ANN001
        n = self.at
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.at = n.parent

    def handle_data(self, data) -> None:  # noqa: ANN001
        self.at.children.append(data)


def dom(html: str | None) -> Node:
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root


def anchors(html: str | None) -> list[tuple[str, str]]:
    """All (href, text) in document order."""
    return [(n.attrs["href"], n.text()) for n in dom(html).find("a", attr="href")]


def links_with(html: str | None, base: str, pattern: str) -> list[str]:
    """Resolved links whose address contains the pattern, distinct, in order."""
    return list(dict.fromkeys(urljoin(base, h) for h, _ in anchors(html) if pattern in h))


def heading(html: str | None, chain: tuple[tuple[str, tuple[str, ...]], ...]) -> str | None:
    """Text of the first non-empty element of a chain of (tag, classes)."""
    root = dom(html)
    for tag, classes in chain:
        for n in root.find(tag, *classes):
            if n.text():
                return n.text()
    return None


def collection_name(html: str | None) -> str | None:
    """Text of the first heading of a listing page, else null."""
    return next((n.text() for n in dom(html).find("h1")[:1] if n.text()), None)


def institution_name(html: str | None) -> str | None:
    """The first link of a breadcrumb list, else the institution's name in the page's container, else the element that is
    marked as the repository's name; null if none has a text."""
    root = dom(html)
    crumbs = [a for b in root.find(None, "breadcrumb") for li in b.find("li") for a in li.find("a")]
    inside = [n for c in root.find(None, attr="id") if c.attrs["id"] == "containerId" for n in c.find(None, "institution-name")]
    marked = [n for n in root.find(None, attr="data-testid") if n.attrs["data-testid"] == "repository-name"]
    return next((found[0].text() for found in (crumbs, inside, marked) if found and found[0].text()), None)


def named_institution(html: str | None) -> tuple[str | None, str]:
    """(name, where it stood) on an institution's own page: its title link, else the heading, else the title's last part."""
    root = dom(html)
    for where, found in (("link", root.find("a", "organisation_title")), ("heading", root.find("h1"))):
        if found and found[0].text():
            return found[0].text(), where
    title = next((n.text() for n in root.find("title")), "").rpartition("|")[2].strip()
    return (title, "title") if title else (None, "none")


def collection_detail(html: str | None, url: str, pattern: str, unit: str = "τεκμήρια") -> dict | None:
    """A collection's row from its own page: institution link (by ``pattern``), heading, and items counted in the visible text;
    None without an institution."""
    root = dom(html)
    link = next((a for a in root.find("a", attr="href") if pattern in a.attrs["href"]), None)
    if link is None:
        return None
    last = lambda u: urlsplit(u).path.rstrip("/").rpartition("/")[2]
    where = urljoin(url, link.attrs["href"])
    heads, said = root.find("h1"), re.search(rf"([\d.,]+)\s+{unit}", root.text())
    digits = re.sub("[.,]", "", said[1]) if said else ""
    return {"institution_slug": last(where), "institution_name": link.text() or last(where), "institution_url": where, "collection_slug": last(url), "collection_name": heads[0].text() if heads else last(url), "collection_url": url, "item_count": int(digits) if digits else None}


def page_signs(html: str | None, item: str = "/edm/") -> dict:
    """What tells listing pages apart: item links, result cards, pagination, and the script's counts (null if absent)."""
    root, h = dom(html), html or ""
    js = lambda name: next((int(m) for m in re.findall(rf"var\s+{name}\s*=\s*['\"](\d+)['\"]\s*;", h)), None)
    return {"links": sum(item in a.attrs["href"] for a in root.find("a", attr="href")), "cards": len(root.find(None, "edm-entity-result")), "pagination": "page.page=" in h, "items_num": js("itemsNum"), "max_pages": js("maxPages")}


def pdf_titles(html: str | None) -> list[str]:
    """Distinct texts of document links; without any, the page title."""
    found = [t for h, t in anchors(html) if t and (".pdf" in h.lower() or "/bitstreams/" in h.lower())]
    return list(dict.fromkeys(found)) or [t for t in [heading(html, (("title", ()),))] if t]


def named_links(html: str | None, base: str, pattern: str) -> list[tuple[str, str]]:
    """Distinct (url, name); a missing name is the last path segment."""
    out: dict[str, str] = {}
    for h, t in anchors(html):
        if pattern in h:
            u = urljoin(base, h)
            out.setdefault(u, t or urlsplit(u).path.rstrip("/").rpartition("/")[2])
    return list(out.items())


def collections_of(html: str | None, base: str, unit: str = "τεκμήρια") -> list[tuple[str, str, int | None]]:
    """(url, name, stated items) of every collection title, distinct by URL; the count stands in the title's own or one of the
    three elements around it, before the unit."""
    out: dict[str, tuple[str, str, int | None]] = {}
    for a in dom(html).find("a", "collection_title", attr="href"):
        url, count, n = urljoin(base, a.attrs["href"].strip()), None, a
        if not a.attrs["href"].strip() or url in out:
            continue
        for _ in range(4):
            boxes = n.find("div", "collection_type") if n is not None else []
            if boxes:
                last = boxes[0].find(None, "lastText")
                m = re.search(rf"([\d.,]+)\s+{unit}", (last[0] if last else boxes[0]).text())
                count = int(re.sub("[.,]", "", m[1])) if m and re.sub("[.,]", "", m[1]) else None
                if count is not None:
                    break
            n = n.parent if n is not None else None
        out[url] = (url, a.text() or urlsplit(url).path.rstrip("/").rpartition("/")[2], count)
    return list(out.values())


def external_link(html: str | None, base: str) -> str | None:
    for a in dom(html).find("a", "right-column-title-link", attr="href"):
        return urljoin(base, a.attrs["href"])
    return None


def metadata_panel(html: str | None) -> dict[str, str]:
    """Label to value of the first metadata panel; of a repeated label the first non-empty value."""
    panels = dom(html).find("div", "form-horizontal", "fieldset", "container-fluid")
    out: dict[str, str] = {}
    for g in panels[0].find(None, "form-group") if panels else ():
        labels = g.find(None, "item-label") or g.find("label")
        bodies = g.find(None, "item-control-static") or g.find(None, "item-body")
        if labels and labels[0].text():
            key, value = labels[0].text().rstrip(":").strip(), bodies[0].text() if bodies else ""
            if not out.get(key):
                out[key] = value
    return out


_META = re.compile(r"<meta[^>]+name=[\"']citation_pdf_url[\"'][^>]*content=[\"']([^\"']+)", re.I)
_LINK = re.compile(r"<link\b[^>]*>", re.I)
_VIEWER = re.compile(r"(?:pdfjs|viewer)[^\"'\s>]*[?&](?:file|url)=([^&\"'\s>]+)", re.I)
_HREF, _SRC = re.compile(r"\bhref\s*=\s*[\"']([^\"']*)", re.I), re.compile(r"\bsrc\s*=\s*[\"']([^\"']*)", re.I)
_ACCEPT = re.compile("|".join(ACCEPT), re.I)


def document_links(html: str | None, base: str) -> list[str]:
    """Resolved document links, distinct: meta, alternate links, viewers, all href, all src."""
    h = html or ""
    found = _META.findall(h)
    for tag in _LINK.findall(h):
        if re.search(r"rel=[\"']?(?:alternate|enclosure)", tag, re.I) and re.search(r"type=[\"']?application/pdf", tag, re.I):
            found += _HREF.findall(tag)
    found += _VIEWER.findall(h) + _HREF.findall(h) + _SRC.findall(h)
    out: dict[str, None] = {}
    for f in found:
        if f and not f.startswith("#") and not f.lower().startswith(("javascript:", "mailto:")):
            u = urljoin(base, f)
            if _ACCEPT.search(u) and not re.search(r"[?&/](?:format=)?ris\b", u, re.I):
                out[u] = None
    return list(out)


def search_page(url: str, page: int) -> str:
    """The listing page: /search, page number set, default order added; blank parameters dropped."""
    s = urlsplit(url)
    path = s.path.rstrip("/")
    path = path if path.endswith("/search") else path + "/search"
    q = parse_qs(s.query)
    q["page.page"] = [str(page)]
    q.setdefault("sortResults", ["SCORE"])
    return urlunsplit((s.scheme, s.netloc, path, urlencode(q, doseq=True), ""))


def next_page(url: str) -> str:
    s = urlsplit(url)
    now = (parse_qs(s.query).get("page.page") or ["1"])[0]
    return urlunsplit((s.scheme, s.netloc, s.path, urlencode({"page.page": (int(now) if now.isdigit() else 1) + 1}), ""))


def _udf(fn, kind, n: int):  # noqa: ANN001, ANN202
    if isinstance(kind, StructType):
        rows = lambda found: pd.DataFrame([x or {} for x in found], columns=kind.names).astype({f.name: "Int64" for f in kind if isinstance(f.dataType, LongType)})

        def one_row(a: pd.Series) -> pd.DataFrame:
            return rows([fn(x) for x in a])

        def two_rows(a: pd.Series, b: pd.Series) -> pd.DataFrame:
            return rows([fn(x, y) for x, y in zip(a, b, strict=True)])

        return F.pandas_udf(one_row if n == 1 else two_rows, kind)

    def one(a: pd.Series) -> pd.Series:
        return pd.Series([fn(x) for x in a])

    def two(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([fn(x, y) for x, y in zip(a, b, strict=True)])

    return F.pandas_udf(one if n == 1 else two, kind)


_S, _AS = StringType(), ArrayType(StringType())
url_join = _udf(lambda a, b: urljoin(a or "", b or ""), _S, 2)
search_page_url = _udf(lambda u, n: search_page(u or "", int(n)), _S, 2)
next_page_url = _udf(lambda u: next_page(u or ""), _S, 1)
html_anchors = _udf(lambda h: [{"href": a, "text": t} for a, t in anchors(h)], ArrayType(StructType([StructField("href", _S), StructField("text", _S)])), 1)
html_text = _udf(lambda h: dom(h).text(), _S, 1)
html_metadata = _udf(metadata_panel, MapType(_S, _S), 1)
html_documents = _udf(lambda h, b: document_links(h, b or ""), _AS, 2)
html_external_link = _udf(lambda h, b: external_link(h, b or ""), _S, 2)
html_pdf_titles = _udf(pdf_titles, _AS, 1)
html_collection_name = _udf(collection_name, _S, 1)
html_institution_name = _udf(institution_name, _S, 1)
_L = LongType()
_struct = lambda **kinds: StructType([StructField(k, v) for k, v in kinds.items()])
html_links = _udf(lambda h, b: links_with(h, b or "", "/edm/"), _AS, 2)
html_collections = _udf(lambda h, b: [{"url": u, "name": n, "items": c} for u, n, c in collections_of(h, b or "")], ArrayType(_struct(url=_S, name=_S, items=_L)), 2)
html_institutions = _udf(lambda h, b: [{"url": u, "name": n} for u, n in named_links(h, b or "", "/institutions/")], ArrayType(_struct(url=_S, name=_S)), 2)
html_named_institution = _udf(lambda h: dict(zip(("name", "found_in"), named_institution(h), strict=True)), _struct(name=_S, found_in=_S), 1)
html_collection_detail = _udf(lambda h, u: collection_detail(h, u or "", "/institutions/"), _struct(institution_slug=_S, institution_name=_S, institution_url=_S, collection_slug=_S, collection_name=_S, collection_url=_S, item_count=_L), 2)
html_page_signs = _udf(page_signs, _struct(links=_L, cards=_L, pagination=BooleanType(), items_num=_L, max_pages=_L), 1)
html_card_count = _udf(lambda h: len(dom(h).find(None, "edm-entity-result")), LongType(), 1)
