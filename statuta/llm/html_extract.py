"""Main-text extraction with facts counted per host.

Extraction reads a page's article or main element or, where it has neither, the
host's container, drops regions that are no article (menus, headers, footers,
sidebars, notices, adverts, forms, comments, ...) and, outside of articles, the
host's fixed texts.  A region that only its class or id calls noise stays if it
holds the page itself.

The facts of a host are counted over all its distinct pages and their whole
texts.  The pages' element streams are aligned level by level: the k-th child of a
name is the k-th one on all pages, unless pages differ in how many of that name
a parent has; those are a repeat, and all of them are one place.  A place that pages lack
is optional.  A text is fixed if at least ``FIXED_SHARE`` of the pages that have its place
(three or more) have it there, and a place of other texts is a slot; the container is the
deepest path that holds 7 in 10 of the texts that aren't fixed.

``infer`` aligns token streams into a wrapper, a union-free regular expression
over tokens (repeats inside a page fold into groups, a mismatch of two texts
becomes a slot, tokens of one side only become optional).  ``extract_pages`` does not
use it: see README.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from difflib import SequenceMatcher

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Pages of a path that have a text there, as a share of all pages with that path, and least pages, for a fixed text.
FIXED_SHARE, FIXED_PAGES = 0.9, 3

#: Levels of nesting that a path and the regions named like noise tell apart.
DEEPEST = 256

#: Characters of all hosts' facts up to which they are sent to every task.
BROADCAST_CHARS = 4_000_000

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed", "noframes")
BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split())
DROPPED = frozenset("head script style noscript template iframe nav footer aside form button select textarea svg canvas object audio video dialog menu search xmp noembed noframes".split())
CLOSES_P = BLOCK - frozenset("br body html head title option optgroup".split())
#: Words of class and id attributes, and roles, of regions that are no article.
NOISE = frozenset("ad ads advert adverts advertisement advertisements advertising adsense banner breadcrumb breadcrumbs byline captcha comment comments commentlist consent cookie cookies disqus donate footer footnav gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice notices notification notifications pager pagination paywall popup promo promoted promotion recommended related replies reply respond share sharing sidebar signup sitemap social sponsor sponsored subscribe subscription teaser toolbar topbar widget widgets".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</\s*([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|<([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)", re.DOTALL)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_WORD = re.compile(r"[a-z0-9]+")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)", re.IGNORECASE) for t in RAW}


def tokens(page: str):
    """("text", text), ("open", tag, attributes) and ("close", tag) in page order; comments and declarations go."""
    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        m = _TOKEN.match(page, lt) if lt >= 0 else None
        while lt >= 0 and m is None:
            lt = page.find("<", lt + 1)
            m = _TOKEN.match(page, lt) if lt >= 0 else None
        if m is None:
            yield "text", page[at:]
            return
        if lt > at:
            yield "text", page[at:lt]
        at = m.end()
        if m[1]:
            yield "close", m[1].lower()
        elif m[2]:
            tag = m[2].lower()
            yield "open", tag, m[3]
            if tag in _RAW_END:
                end = _RAW_END[tag].search(page, at)
                stop = end.start() if end else n
                if stop > at:
                    yield "text", page[at:stop]
                at = stop


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): (m[2] or "").strip("\"'") for m in _ATTRIBUTE.finditer(raw)} if raw and "=" in raw else {}


def _label(tag: str, attributes: dict[str, str]) -> str:
    """An element's name in a wrapper: its tag with its first class."""
    first = attributes.get("class", "").split()
    return f"{tag}.{first[0]}" if first else tag


def _is_noise(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether an element is no article by its tag, role or state."""
    if tag in DROPPED or tag == "header" and not in_article:
        return True
    if tag in ("html", "body", "article", "main"):
        return any(set(_WORD.findall(attributes.get(a, "").lower())) & {"comment", "comments", "reply"} for a in ("class", "id")) and tag == "article"
    return attributes.get("role", "").lower() in NOISE_ROLES or "hidden" in attributes or attributes.get("aria-hidden") == "true"


def _is_named_noise(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    if tag in ("html", "body", "article", "main"):
        return False
    words = {w for a in ("class", "id") for w in _WORD.findall(attributes.get(a, "").lower())}
    found = words & NOISE
    return bool(found - ({"header", "byline"} if in_article else set()))


def nodes(page: str):
    """(path, text or None for a block boundary, noise, article, named) in page order; path is a tuple of labels, each with its number among its parent's of that name.

    named holds the numbers of the enclosing regions that only their class or id calls noise.
    An element below ``DEEPEST`` others has its parent's path, and a named region inside of
    ``DEEPEST`` others belongs to the innermost of them, so that time and memory grow with the page alone.
    """
    nowhere = "", (), False, False, ()
    stack: list[tuple[str, tuple[str, ...], bool, bool, tuple[int, ...]]] = []  # tag, path, noise, article, named
    children: list[dict[str, int]] = [{}]  # by label, of the page and of each element of the stack
    opened: Counter[str] = Counter()
    regions = 0

    def cut(k: int) -> None:
        for s in stack[k:]:
            opened[s[0]] -= 1
        del stack[k:]
        del children[k + 1 :]

    for token in tokens(page):
        tag, path, noise, article, named = stack[-1] if stack else nowhere
        if token[0] == "text":
            yield path, token[1] if tag in ("script", "style") else html.unescape(token[1]), noise, article, named
            continue
        tag = token[1]
        if token[0] == "open":
            if tag in CLOSES_P and opened["p"]:
                # A paragraph ends where a block begins, unless a newer block or cell encloses the spot.
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == "p":
                        cut(k)
                        break
                    if stack[k][0] in BLOCK:
                        break
            for same, stops in (("li", ("ul", "ol", "menu")), ("dd", ("dl",)), ("dt", ("dl",)), ("tr", ("table",)), ("td", ("tr", "table")), ("th", ("tr", "table")), ("option", ("select",))):
                if opened[same] and (tag == same or (tag, same) in (("dd", "dt"), ("dt", "dd"), ("td", "th"), ("th", "td"))):
                    for k in range(len(stack) - 1, -1, -1):
                        if stack[k][0] in stops:
                            break
                        if stack[k][0] == same:
                            cut(k)
                            break
            _, path, noise, article, named = stack[-1] if stack else nowhere
            if tag in BLOCK:
                yield path, None, noise, article, named
            if tag not in VOID:
                attributes = _attributes(token[2])
                if len(named) < DEEPEST and _is_named_noise(tag, attributes, article):
                    named, regions = (*named, regions), regions + 1
                label = _label(tag, attributes)
                number = children[-1][label] = children[-1].get(label, 0) + 1
                own = (*path, f"{label}.[{number}]") if len(path) < DEEPEST else path
                children.append({})
                stack.append((tag, own, noise or _is_noise(tag, attributes, article), article or tag in ("article", "main"), named))
                opened[tag] += 1
        else:
            if opened[tag]:
                cut(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag))
            if tag in BLOCK:
                _, path, noise, article, named = stack[-1] if stack else nowhere
                yield path, None, noise, article, named


# ---- wrappers -------------------------------------------------------------
# An item is ("tag", label), ("text", value), ("slot",), ("plus", items) or ("maybe", items).


def _stream(page: str) -> list[tuple]:
    out: list[tuple] = []
    skip = None
    for token in tokens(page):
        if skip:
            if token[0] == "close" and token[1] == skip:
                skip = None
            continue
        if token[0] == "text":
            text = " ".join(html.unescape(token[1]).split())
            if text:
                out.append(("text", text))
        elif token[0] == "open":
            if token[1] in ("script", "style"):
                skip = token[1]
                continue
            out.append(("tag", _label(token[1], _attributes(token[2]))))
        else:
            out.append(("tag", "/" + token[1]))
    return out


def _shape(item: tuple):
    """What alignment compares: texts and slots are alike, groups by their content's shape."""
    if item[0] in ("text", "slot"):
        return "#"
    return item if item[0] == "tag" else (item[0], tuple(_shape(x) for x in item[1]))


def _merge_text(a: tuple, b: tuple) -> tuple:
    return a if a == b else ("slot",)


def _merged(a: tuple, b: tuple) -> tuple:
    """One item for two of equal shape."""
    if a[0] in ("text", "slot"):
        return _merge_text(a, b)
    return a if a[0] == "tag" else (a[0], tuple(_merged(x, y) for x, y in zip(a[1], b[1], strict=True)))


def _folded(items: list[tuple], widest: int = 12) -> list[tuple]:
    """Neighbouring runs of tokens of equal shape become one repeated group."""
    items = list(items)
    for width in range(1, widest + 1):
        out: list[tuple] = []
        shapes = [_shape(x) for x in items]
        at = 0
        while at < len(items):
            unit = shapes[at : at + width]
            end = at + width
            # A unit starts and ends with a tag of its own, or a single text would fold into its neighbours.
            if len(unit) == width and (width == 1 or (isinstance(unit[0], tuple) and unit[0][0] == "tag" and not unit[0][1].startswith("/"))) and unit[0] != "#" and shapes[end : end + width] == unit:
                group = tuple(items[at:end])
                while shapes[end : end + width] == unit:
                    group = tuple(_merged(x, y) for x, y in zip(group, items[end : end + width], strict=True))
                    end += width
                out.append(("plus", group))
                at = end
            else:
                out.append(items[at])
                at += 1
        items = out
    return items


def _aligned(wrapper: list[tuple], page: list[tuple]) -> list[tuple]:
    """The wrapper widened so that it also matches ``page``."""
    a, b = [_shape(x) for x in wrapper], [_shape(x) for x in page]
    plain = [s[1] if s[0] == "maybe" and len(s[1]) == 1 else s for s in a]
    out: list[tuple] = []
    for op, i, j, k, m in SequenceMatcher(None, [str(x) for x in plain], [str(x) for x in b], autojunk=False).get_opcodes():
        if op == "equal":
            for x, y in zip(wrapper[i:j], page[k:m], strict=True):
                out.append(("maybe", (_merged(x[1][0], y),)) if x[0] == "maybe" and y[0] != "maybe" else _merged(x, y))
            continue
        for x in wrapper[i:j]:
            # A group met once is a repeat of one: the same items in the page stand for it.
            out.append(x if x[0] == "maybe" else ("maybe", (x,)))
        for y in page[k:m]:
            out.append(("maybe", (y,)))
    return out


def infer(pages: list[str]) -> list[tuple]:
    """The wrapper of the pages, taken in turn; equal pages count once."""
    wrapper: list[tuple] | None = None
    for page in dict.fromkeys(pages):
        items = _folded(_stream(page))
        wrapper = items if wrapper is None else _aligned(wrapper, items)
    return wrapper or []


def _path_key(path: tuple[str, ...]) -> str:
    return " ".join(path)


def _plain(path: tuple[str, ...]) -> tuple[str, ...]:
    return tuple(x.rpartition(".")[0] for x in path)


def _place(path: tuple[str, ...], repeats: frozenset[str]) -> str:
    """Where a path is in the host's alignment: numbers of repeated elements go."""
    plain, key, out = _plain(path), "", []
    for full, name in zip(path, plain, strict=True):
        key = f"{key} {name}" if key else name
        out.append(name if key in repeats else full)
    return " ".join(out)


def child_counts(paths: set[tuple[str, ...]]) -> dict[str, tuple[int, int]]:
    """By path without numbers: the least and the most elements of it in a parent that has any, on one page."""
    most: dict[tuple[tuple[str, ...], str], int] = {}
    seen: set[tuple[str, ...]] = set()
    for path in paths:
        while path and path not in seen:
            seen.add(path)
            name, _, number = path[-1].rpartition(".")
            parent = path[:-1], name
            most[parent] = max(most.get(parent, 0), int(number[1:-1]))
            path = path[:-1]
    out: dict[str, tuple[int, int]] = {}
    for (parent, name), n in most.items():
        key = _path_key((*_plain(parent), name))
        low, high = out.get(key, (n, n))
        out[key] = min(low, n), max(high, n)
    return out


def _text_key(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "replace")) >> 1


def container_of(slots: dict[tuple[str, ...], int]) -> tuple[str, ...]:
    """The deepest path that holds 7 in 10 of the slots, which are counts by path."""
    total, container = sum(slots.values()), ()
    while total:
        below: dict[tuple[str, ...], int] = {}
        for p, n in slots.items():
            if p[: len(container)] == container and len(p) > len(container):
                key = p[: len(container) + 1]
                below[key] = below.get(key, 0) + n
        best = max(below.items(), key=lambda x: (x[1], x[0]), default=None)
        if best is None or best[1] < 0.7 * total or best[0][-1].split(".")[0] not in BLOCK or best[0][-1].split(".")[0] in ("p", "li", "ul", "ol", "table", "tr", "td"):
            break
        container = best[0]
    return container


def _released(found: list[tuple]) -> set[int]:
    """Regions named like noise that hold the page: over half of its text, and its only heading and articles or all of its text."""
    texts = [(len(text.strip()), article or any(x.split(".")[0] == "h1" for x in path), named) for path, text, noise, article, named in found if not noise and text and text.strip()]
    free: set[int] = set()
    total = sum(n for n, _, _ in texts)
    while True:
        held: dict[int, list] = {}
        outside, keys = 0, False
        for n, key, named in texts:
            first = next((x for x in named if x not in free), None)
            if first is None:
                outside, keys = outside + n, keys or key
            else:
                of = held.setdefault(first, [0, False])
                of[0], of[1] = of[0] + n, of[1] or key
        more = {x for x, (n, key) in held.items() if 2 * n > total and (key and not keys or not outside)}
        if not more:
            return free
        free |= more


def text_blocks(page: str) -> tuple[bool, list[tuple[tuple[str, ...], str, bool]]]:
    """Whether the page has articles, and (path, text, article) of its blocks outside of noise, in page order."""
    found = list(nodes(page))
    free = _released(found) if any(n[4] for n in found) else set()
    out: list[tuple[tuple[str, ...], str, bool]] = []
    parts: list[tuple[tuple[str, ...], str, bool]] = []

    def close() -> None:
        text = " ".join("".join(x[1] for x in parts).split())
        if text:
            path, _, article = next(x for x in parts if x[1].strip())
            out.append((path, text, article))
        parts.clear()

    for path, text, noise, article, named in found:
        if text is None:
            close()
        elif not noise and all(x in free for x in named):
            if parts and parts[-1][2] != article:
                close()
            parts.append((path, text, article))
    close()
    return any(x[2] for x in out), out


def extract(page: str | None, known: dict | None = None) -> str:
    """The main text of a page: blocks in page order, one line each."""
    if not page:
        return ""
    articles, blocks = text_blocks(page)
    if articles:
        return "\n".join(text for _, text, article in blocks if article)
    if known:
        fixed, container, repeats = known["fixed"], tuple(known["container"]), known["repeats"]
        inside = [b for b in blocks if _plain(b[0][: len(container)]) == container]
        blocks = [b for b in inside or blocks if (_place(b[0], repeats), _text_key(b[1])) not in fixed]
    return "\n".join(text for _, text, _ in blocks)


def _facts_of(base: DataFrame, known: DataFrame) -> DataFrame:
    """``base`` with the facts of its host; ``known`` is broadcast if its characters have been counted to be few."""
    small = known.agg(F.sum(F.length("facts") + F.length("host"))).first()[0] or 0
    return base.join(F.broadcast(known) if small <= BROADCAST_CHARS else known, "host", "left")


def host_repeats(pages: DataFrame) -> DataFrame:
    """(host, facts): the repeated paths of each host as JSON; ``pages`` has (host, html)."""

    def counts(frames):
        for pdf in frames:
            of: dict[tuple[str, str], tuple[int, int]] = {}
            for host, page in zip(pdf["host"], pdf["html"], strict=True):
                for path, (low, high) in child_counts({n[0] for n in nodes(page)}).items():
                    at = of.get((host, path), (low, high))
                    of[host, path] = min(at[0], low), max(at[1], high)
            yield pd.DataFrame([(*k, *v) for k, v in of.items()], columns=["host", "path", "low", "high"])

    each = pages.where("html is not null").mapInPandas(counts, "host string, path string, low int, high int")
    return each.groupBy("host", "path").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low < high").groupBy("host").agg(F.to_json(F.sort_array(F.collect_list("path"))).alias("facts"))


def host_facts(pages: DataFrame) -> DataFrame:
    """(host, facts): one row a host, its fixed texts, its container and its repeated paths as JSON; ``pages`` has (host, html)."""
    repeated = stored(host_repeats(pages), "repeats")

    def texts(frames):
        seen: dict[str | None, frozenset[str]] = {None: frozenset()}
        for pdf in frames:
            rows: list[tuple] = []
            for host, page, facts in zip(pdf["host"], pdf["html"], pdf["facts"], strict=True):
                facts = facts if isinstance(facts, str) else None
                if facts not in seen:
                    if len(seen) > 1000:
                        seen = {None: frozenset()}
                    seen[facts] = frozenset(json.loads(facts))
                key = _text_key(page)
                at = {(_place(path, seen[facts]), _path_key(_plain(path)), _text_key(text)) for path, text, _ in text_blocks(page)[1]}
                rows += [(host, place, path, text, key) for place, path, text in at] + [(host, place, path, None, key) for place, path in {x[:2] for x in at}]
            yield pd.DataFrame({"host": [r[0] for r in rows], "place": [r[1] for r in rows], "path": [r[2] for r in rows], "text": pd.array([r[3] for r in rows], "Int64"), "page": pd.array([r[4] for r in rows], "Int64")})

    # A page's copies count once.  Rows without a text count the pages of a place.
    each = _facts_of(pages.where("html is not null"), repeated).select("host", "html", "facts").mapInPandas(texts, "host string, place string, path string, text long, page long").distinct()
    counted = stored(each.groupBy("host", "place", "path", "text").agg(F.count("*").alias("n")), "texts")
    of_place = counted.where("text is null").select("host", "place", F.col("n").alias("pages"))
    judged = counted.where("text is not null").join(of_place, ["host", "place"])
    judged = judged.withColumn("fixed", (F.col("pages") >= FIXED_PAGES) & (F.col("n") >= FIXED_SHARE * F.col("pages")))
    by_path = judged.groupBy("host", "path").agg(F.sum(F.when(F.col("fixed"), 0).otherwise(F.col("n"))).alias("slots"), F.collect_list(F.when(F.col("fixed"), F.struct("place", "text"))).alias("texts"))
    by_host = by_path.groupBy("host").agg(F.collect_list(F.struct("path", "slots", "texts")).alias("paths")).join(repeated, "host", "left")

    def one(frames):
        for pdf in frames:
            out = []
            for paths, facts in zip(pdf["paths"], pdf["facts"], strict=True):
                fixed = sorted((t["place"], int(t["text"])) for r in paths for t in r["texts"])
                slots = {tuple(r["path"].split(" ")) if r["path"] else (): int(r["slots"]) for r in paths if r["slots"]}
                out.append(json.dumps({"fixed": fixed, "container": container_of(slots), "repeats": json.loads(facts) if isinstance(facts, str) else []}))
            yield pd.DataFrame({"host": pdf["host"], "facts": out})

    return by_host.mapInPandas(one, "host string, facts string")


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points, long) of every row of ``pages`` (page_id, url, html).

    A null or empty html gives an empty text; a null url belongs to a host of
    its own name, an empty one.  A null page_id stays null.  Repeated rows give
    repeated rows, pages of any length and depth of nesting are read whole, and
    other columns are not read.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#]*)", 1))
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host.alias("host"))
    known = stored(host_facts(base.select("host", "html")), "facts")
    both = _facts_of(base, known).select("page_id", "url", "html", "facts")

    def run(frames):
        seen: dict[str | None, dict | None] = {None: None}
        for pdf in frames:
            texts = []
            for page, facts in zip(pdf["html"], pdf["facts"], strict=True):
                facts = facts if isinstance(facts, str) else None
                if facts not in seen:
                    if len(seen) > 1000:
                        seen = {None: None}
                    of = json.loads(facts)
                    seen[facts] = {"fixed": {tuple(x) for x in of["fixed"]}, "container": of["container"], "repeats": frozenset(of["repeats"])}
                texts.append(extract(page, seen[facts]))
            yield pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    return both.mapInPandas(run, "page_id long, url string, text string, n_chars long")
