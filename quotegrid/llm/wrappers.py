"""Main text of web pages by wrappers: union-free regular expressions inferred per host.

A page is a stream of block tags and text slots (inline markup belongs to the slot). Aligning the streams of one host,
a mismatch becomes an optional group, a square (the same group twice in a row) a repeated one, and texts that differ a
slot. The outcome, without unions, is the host's wrapper: ``article(h1(#)p(#)+)``. Text slots that a wrapper shows to
vary, inside its content element and outside menus, notices, forms and the like, make the main text.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quotegrid.llm.common import slices
from quotegrid.session import stage

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(script|style|noscript|template|textarea|title|iframe|object|svg|math|canvas|select|audio|video|head)\b(?:[^<>\"']|\"[^\"]*\"|'[^']*')*(?:/>|>.*?(?:</\1\s*>|\Z))"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S | re.I)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"\s(?:hidden(?=[\s=/]|\Z)|aria-hidden\s*=\s*[\"']?true)", re.I)
INLINE = set(  # fixed values: elements that do not end a block
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())  # fixed values
CLOSES = {  # fixed values: a start tag ends an open element of these
    "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"},
    "th": {"td", "th", "p"}, "option": {"option"}, "tbody": {"tr", "td", "th", "p"}, "p": {"p"}}
SCOPE = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
NOT_CONTENT_TAGS = set("nav footer aside form menu dialog button fieldset input head".split())  # fixed values
NOT_CONTENT_WORDS = set(  # fixed values: words of class, id and role
    "ad ads adv advert adverts advertisement advertising adsense banner promo promotion sponsor sponsored cookie cookies consent gdpr "
    "notice notices alert warning popup modal overlay subscribe subscription newsletter signup login sidebar rail menu nav "
    "navbar navigation breadcrumb breadcrumbs masthead topbar footer foot copyright legal comment comments disqus reply replies "
    "discussion respond share sharing social related recommended recommendations trending popular widget widgets toolbar pagination "
    "pager search skip contentinfo complementary form".split())
#: Of these, words of readers' comments; and words that name parts of an article as well (a warning, a sidebar).
TALK_WORDS = set("comment comments disqus reply replies respond discussion".split())
MIXED_WORDS = set(
    "notice notices alert warning popular trending legal copyright search skip form rail foot sidebar complementary overlay social "
    "related recommended recommendations promotion sponsored subscription widget widgets discussion".split())
#: Words beside which a word says how the page is laid out: has-sidebar, page-search.
LAYOUT_WORDS = set("has with no without layout page columns grid".split())
WHOLE = set("html body main article".split())  # elements that no word excludes
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
LEAVES = set("li tr td th dt dd p h1 h2 h3 h4 h5 h6".split())  # elements a mixed word doesn't set apart from their like
CONTENT_WORDS = set("content article post entry story main body text".split())  # fixed values
HEADERS = ("header", "banner")
#: Blocks of one path in a row on a page of which more than this share lies in links are a list of links.
LINK_SHARE = 0.6
#: Distinct pages on which a slot's text must be the same to be part of the template.
CONSTANT_PAGES = 3
#: Levels of elements that a path names; what is nested deeper counts as of the last of them, so no text is lost.
MOST_DEPTH = 100


def label(tag: str, attributes: str) -> str:
    """Tag with the words of class, id and role; digits do not count."""
    words = []
    if attributes:
        for m in ATTRIBUTE.finditer(attributes):
            words += re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", m[2] or m[3] or m[4] or "").lower())
    return ".".join([tag, *sorted(set(words))])


def page_slots(page: str) -> list[tuple[str, str, int]]:
    """(path, text, characters in links) of each block of a page, in order; text decoded, white space single."""
    out: list[tuple[str, str, int]] = []
    path: list[str] = []
    tags: list[str] = []
    parts: list[str] = []
    linked: list[str] = []
    depth = 0  # of open links
    hidden: int | None = None

    def flush() -> None:
        text = " ".join(entities.unescape("".join(parts)).split())
        if text and hidden is None:
            inside = len(" ".join(entities.unescape(" ".join(linked)).split()))
            out.append(("/".join([*path[:MOST_DEPTH], "#"]), text, inside))
        parts.clear()
        linked.clear()

    def pop() -> None:
        nonlocal hidden
        tags.pop()
        path.pop()
        if hidden is not None and len(tags) < hidden:
            hidden = None

    def say(text: str) -> None:
        parts.append(text)
        if depth:
            linked.append(text)

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            say(page[at:m.start()])
        at = m.end()
        tag = m[3]
        if tag is None:
            if m[1] is None and m[0].startswith("<![CDATA["):
                say(entities.escape(m[0][9:-3] if m[0].endswith("]]>") else m[0][9:]))
            continue
        tag, closing = tag.lower(), m[2] == "/"
        if tag in INLINE:
            if tag == "a":
                depth = 0 if closing else 1
            elif tag == "br":
                say(" ")
            continue
        flush()
        depth = 0
        if closing:
            if tag in tags:
                while tags[-1] != tag:
                    pop()
                pop()
            continue
        closes, scope = CLOSES.get(tag, {"p"}), SCOPE.get(tag, set())
        for i in range(len(tags) - 1, -1, -1):
            if tags[i] in scope or tags[i] not in closes and tags[i] not in ("p",):
                break
            if tags[i] in closes:
                while len(tags) > i:
                    pop()
        if tag in VOID or m[4].endswith("/"):
            continue
        tags.append(tag)
        path.append(label(tag, m[4]))
        if hidden is None and HIDDEN.search(m[4]):
            hidden = len(tags)
    say(page[at:])
    flush()
    return out


# A wrapper is a sequence of items [key, optional, repeated, items]; a text slot has the key "#".


def tree(paths: list[str]) -> list:
    """Nested items of the slots' paths; a new element begins where a path does not go on from the one before."""
    root: list = []
    open_items: list = []
    for p in paths:
        keys = p.split("/")
        same = 0
        while same < len(open_items) and same < len(keys) - 1 and open_items[same][0] == keys[same]:
            same += 1
        if same == len(keys) - 1 and len(open_items) == same and same and open_items[-1][3] and open_items[-1][3][-1][0] == "#":
            same -= 1  # a second block of text in the same kind of element: the element again
        del open_items[same:]
        for key in keys[same:]:
            item = [key, False, False, []]
            (open_items[-1][3] if open_items else root).append(item)
            open_items.append(item)
        open_items.pop()  # a slot stays open for nothing
    return root


def squares(items: list) -> list:
    """The items with each group that comes twice or more in a row made one repeated group."""
    items = [[k, o, r, squares(kids)] for k, o, r, kids in items]
    for width in range(1, 5):
        i = 0
        while i + 2 * width <= len(items):
            a, b = items[i:i + width], items[i + width:i + 2 * width]
            if [x[0] for x in a] == [x[0] for x in b]:
                if width == 1:
                    joined = [[a[0][0], a[0][1] or b[0][1], True, aligned(a[0][3], b[0][3])]]
                    items[i:i + 2] = joined
                    continue
                if all(x[0] != "()" for x in a):
                    items[i:i + 2 * width] = [["()", False, True, aligned(a, b)]]
                    while [x[0] for x in items[i + 1:i + 1 + width]] == [x[0] for x in a]:
                        items[i] = ["()", False, True, aligned(items[i][3], items[i + 1:i + 1 + width])]
                        del items[i + 1:i + 1 + width]
            i += 1
    return items


def aligned(a: list, b: list) -> list:
    """Both sequences in one: equal keys aligned (longest common subsequence), all else optional."""
    if a == b:
        return a
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i][0] == b[j][0] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and a[i][0] == b[j][0]:
            out.append([a[i][0], a[i][1] or b[j][1], a[i][2] or b[j][2], aligned(a[i][3], b[j][3])])
            i, j = i + 1, j + 1
        elif j == m or i < n and best[i + 1][j] >= best[i][j + 1]:
            out.append([a[i][0], True, *a[i][2:]])
            i += 1
        else:
            out.append([b[j][0], True, *b[j][2:]])
            j += 1
    return out


def expression(items: list) -> str:
    """A wrapper as text: ``#`` a slot, ``?`` optional, ``+`` repeated."""
    def one(item: list) -> str:
        key, optional, repeated, kids = item
        inner = "".join(map(one, kids))
        body = "#" if key == "#" else f"({inner})" if key == "()" else f"{key}({inner})"
        return body + ("*" if optional and repeated else "?" if optional else "+" if repeated else "") + (" " if key != "#" else "")
    return "".join(map(one, items)).strip().replace(" )", ")")


@lru_cache(maxsize=1 << 16)
def marked(path: str) -> tuple[bool, tuple[tuple[str, bool, bool, bool], ...]]:
    """Whether the tags of a path exclude it, and its elements whose words may: (prefix, talk, layout, mixed).

    ``mixed``: inside a content element, by a word that names parts of articles too; the wrapper decides on these.
    """
    within, prefix, found = False, "", []
    inside = container(path)[1]
    for part in path.split("/")[:-1]:
        tag, *names = part.split(".")
        words = set(names)
        prefix = f"{prefix}/{part}" if prefix else part
        if tag in NOT_CONTENT_TAGS or tag in HEADERS and not within:
            return True, ()
        hits = NOT_CONTENT_WORDS & words | ({"header"} & words if not within else set())
        if hits and tag not in WHOLE:
            mixed = bool(inside) and len(prefix) > len(inside) and hits <= MIXED_WORDS
            if not mixed or tag not in LEAVES:
                found.append((prefix, hits <= TALK_WORDS, bool(LAYOUT_WORDS & words), mixed))
        within = within or tag in ("article", "main")
    return False, tuple(found)


def excluded(path: str, layout: frozenset[str] = frozenset()) -> bool:
    """Whether a path leads through a menu, notice, form and so on; headings of an article's own header stay.

    Words don't exclude the elements in ``layout``; on mixed words inside a content element see ``content_paths``.
    """
    by_tag, found = marked(path)
    return by_tag or any(not mixed and prefix not in layout for prefix, _, _, mixed in found)


def layout_elements(weights: dict[str, int]) -> frozenset[str]:
    """Elements of a page that a word would exclude but that hold its content, from the characters outside links by path.

    Outermost first, then by layout word, content element and weight: an element that holds more text than what is left without it and a better
    content element than that. Elements of comments need a layout word beside, or a page with nothing else.
    """
    layout: frozenset[str] = frozenset()
    open_paths = {p: n for p, n in weights.items() if n > 0 and not marked(p)[0]}
    while True:
        held: dict[tuple[str, bool, bool], list[int]] = {}
        out, best = 0, 4  # weight without these elements, rank of its best content element
        for p, n in open_paths.items():
            first = next((m for m in marked(p)[1] if not m[3] and m[0] not in layout), None)
            if first is None:
                out, best = out + n, min(best, container(p)[0])
            else:
                got = held.setdefault(first[:3], [0, 4])
                got[0] += n
                got[1] = min(got[1], container(p)[0])

        def fits(talk: bool, hint: bool, n: int, rank: int, out: int = out, best: int = best) -> bool:
            if n <= out:
                return False
            if hint and rank <= best:
                return True
            return rank <= 1 and not out if talk else not out or rank < best and (best >= 2 or n > 2 * out)

        fit = [(talk, not hint, rank, -n, prefix) for (prefix, talk, hint), (n, rank) in held.items() if fits(talk, hint, n, rank)]
        if not fit:
            return layout
        layout |= {min(fit)[-1]}


@lru_cache(maxsize=1 << 16)
def container(path: str) -> tuple[int, str]:
    """(rank, prefix) of the element that holds content by its name: article, main, or a telling class; rank 3 none."""
    parts = path.split("/")[:-1]
    for rank, found in enumerate((
            [i for i, p in enumerate(parts) if p.split(".")[0] == "article"],
            [i for i, p in enumerate(parts) if p.split(".")[0] == "main" or "main" in p.split(".")[1:]],
            [i for i, p in enumerate(parts) if CONTENT_WORDS & set(p.split(".")[1:])])):
        if found:
            return rank, "/".join(parts[: found[0] + 1])
    return 3, ""


def whole(path: str) -> bool:
    """Whether a block is the content element's, be it the same on all pages: any in article or main, a heading in one by its class."""
    rank = container(path)[0]
    return rank < 2 or rank == 2 and path.split("/")[-2].split(".")[0] in HEADINGS


def left_out(slots: list[tuple[str, str, int]]) -> list[bool]:
    """Of each slot of a page whether it is in a menu, notice, form and so on, given what holds the page's text."""
    weights: dict[str, int] = {}
    for path, text, linked in slots:
        weights[path] = weights.get(path, 0) + len(text) - linked
    layout = layout_elements(weights)
    return [excluded(path, layout) for path, _, _ in slots]


def link_lists(slots: list[tuple[str, str, int]]) -> list[bool]:
    """Of each slot of a page whether it is in a list of links, judged by runs of one path.

    Headings are none, nor is anything in article or main unless a mixed word sets it apart.
    """
    out: list[bool] = []
    for path, run in groupby(slots, key=lambda s: s[0]):
        blocks = list(run)
        apart = any(mixed for _, _, _, mixed in marked(path)[1])
        keep = whole(path) and not apart or path.split("/")[-2:][0].split(".")[0] in HEADINGS
        linked = sum(k for _, _, k in blocks) > LINK_SHARE * sum(len(t) for _, t, _ in blocks)
        out += [linked and not keep] * len(blocks)
    return out


def parsed(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, host, digest of the html, kind, shape, slots of every page; NULL html has no slots, a NULL or odd url the host ''.

    ``kind`` is the best name of a content element on the page (its slots that are not ``out``): pages of a host with and without one have
    different wrappers. ``shape`` is the page's own expression, squares folded, as JSON.
    """
    schema = ("page_id long, url string, host string, digest long, kind int, shape string, "
              "slots array<struct<path: string, text: string, linked: int, out: boolean>>")
    slot = pa.list_(pa.struct([("path", pa.string()), ("text", pa.string()), ("linked", pa.int32()), ("out", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "body"):
            found = [page_slots(h) for h in part.column("body").to_pylist()]
            left = [left_out(s) for s in found]
            kinds = [min((container(p)[0] for (p, _, _), o in zip(s, out, strict=True) if not o), default=3)
                     for s, out in zip(found, left, strict=True)]
            shapes = [json.dumps(squares(tree([p for p, _, _ in s])), separators=(",", ":"), ensure_ascii=False) for s in found]
            rows = [[{"path": p, "text": t, "linked": k, "out": o or a_list} for (p, t, k), o, a_list in zip(s, out, link_lists(s), strict=True)]
                    for s, out in zip(found, left, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), part.column("host"), part.column("digest"), pa.array(kinds, type=pa.int32()),
                 pa.array(shapes, type=pa.string()), pa.array(rows, type=slot)],
                names=["page_id", "url", "host", "digest", "kind", "shape", "slots"])

    host = F.lower(F.coalesce(F.regexp_extract(F.col(url).cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))
    body = F.coalesce(F.col(html).cast("string"), F.lit(""))
    return pages.select(
        F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), host.alias("host"),
        F.xxhash64(body).alias("digest"), body.alias("body")).mapInArrow(run, schema)


def wrappers(pages: DataFrame, strands: int = 32) -> DataFrame:
    """host, kind, wrapper (JSON), pages: the distinct shapes of a host aligned one after the other.

    Distinct shapes are few; they are aligned in two levels, so that a host with many is not one task's.
    """
    shapes = pages.groupBy("host", "kind", "shape").agg(F.count("*").alias("pages"))
    shapes = shapes.withColumn("strand", F.pmod(F.xxhash64("shape"), F.lit(strands)).cast("int"))

    def merged(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["pages", "shape"], ascending=[False, True])
        now = json.loads(frame["shape"].iloc[0])
        for s in frame["shape"].iloc[1:]:
            now = squares(aligned(now, json.loads(s)))
        row = frame.iloc[0]
        return pd.DataFrame([[row["host"], row["kind"], json.dumps(now, separators=(",", ":"), ensure_ascii=False), frame["pages"].sum()]],
                            columns=["host", "kind", "shape", "pages"])

    kind = "host string, kind int, shape string, pages long"
    first = shapes.groupBy("host", "kind", "strand").applyInPandas(merged, kind)
    return first.groupBy("host", "kind").applyInPandas(merged, kind).withColumnRenamed("shape", "wrapper")


def slot_paths(wrapper: list, above: str = "") -> dict[str, bool]:
    """The slots a wrapper has, by path, and whether each is (in) a repeated group."""
    out: dict[str, bool] = {}

    def walk(items: list, prefix: str, repeated: bool) -> None:
        for key, _, rep, kids in items:
            if key == "#":
                out[f"{prefix}#"] = out.get(f"{prefix}#", False) or repeated or rep
            else:
                walk(kids, prefix if key == "()" else f"{prefix}{key}/", repeated or rep)

    walk(wrapper, above, False)
    return out


def content_paths(frame: pd.DataFrame) -> list[str]:
    """Of one wrapper's slots (path, distinct_pages, chars, linked, constant; none that is out) those that are main text.

    Parts of a content element with a mixed word go where they are the same on all pages (lists of links went before).
    """
    has = slot_paths(json.loads(frame["wrapper"].iloc[0]))
    frame = frame[frame["path"].isin(list(has))]
    if frame.empty:
        return []
    where = frame["path"].map(container)
    rank = min(r for r, _ in where)
    if rank < 2:
        frame = frame[[r == rank for r, _ in where]]
    else:
        weight = (frame["chars"] - frame["linked"]).clip(lower=0)
        if rank == 2:
            by = weight.groupby([p if r == 2 else "" for r, p in where]).sum()
            best = by[[k for k in by.index if k]].idxmax()
            frame = frame[[p == best for _, p in where]]
        else:  # the deepest element that holds most of the text outside links
            best, total = "", weight.sum()
            while True:
                step = frame["path"].map(lambda p, b=best: "/".join(p.split("/")[: b.count("/") + 2 if b else 1]))
                inside = frame["path"].str.startswith(best + "/") if best else pd.Series(True, index=frame.index)
                by = weight[inside].groupby(step[inside]).sum()
                by = by[[k for k in by.index if not k.endswith("#")]]
                if by.empty or by.max() < 0.7 * total or total == 0 or by.idxmax().split("/")[-1].split(".")[0] in ("p", "li", "td"):
                    break
                best = by.idxmax()
            frame = frame[frame["path"].str.startswith(best + "/")] if best else frame
    same = frame["constant"] & (frame["distinct_pages"] >= CONSTANT_PAGES)
    set_apart = frame["path"].map(lambda p: any(mixed for _, _, _, mixed in marked(p)[1]))
    frame = frame[~(set_apart & same)]
    constant = same[frame.index] & ~frame["path"].map(has) & ~frame["path"].map(whole)
    if not constant.all():
        frame = frame[~constant]
    return sorted(frame["path"])


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page; pages without html or main text have an empty text.

    Pages are parsed once, into the shared folder; wrappers and slot statistics are aggregates by host, reduced before
    the shuffle; the content slots of a wrapper (as many as a template has) are joined back. Repeated rows are all kept; other
    columns are not read.
    """
    rows = stage(parsed(pages, key, url, html), "page-slots")
    slot = rows.select("host", "kind", "digest", F.explode("slots").alias("s")).select("host", "kind", "digest", "s.*")
    by_page = slot.where("not out").groupBy("host", "kind", "path", "digest").agg(
        F.sum(F.length("text")).alias("chars"), F.sum("linked").alias("linked"),
        F.min(F.xxhash64("text")).alias("least"), F.max(F.xxhash64("text")).alias("most"))
    stats = by_page.groupBy("host", "kind", "path").agg(
        F.count("*").alias("distinct_pages"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked"),
        (F.min("least") == F.max("most")).alias("constant"))

    def choose(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([[frame["host"].iloc[0], frame["kind"].iloc[0], content_paths(frame)]], columns=["host", "kind", "content"])

    chosen = stats.join(wrappers(rows.select("host", "kind", "shape")), ["host", "kind"]).groupBy("host", "kind").applyInPandas(
        choose, "host string, kind int, content array<string>")
    chosen = stage(chosen, "wrappers")
    blocks = F.transform(F.filter("slots", lambda s: ~s["out"] & F.array_contains(F.col("content"), s["path"])), lambda s: s["text"])
    out = rows.drop("shape").join(chosen, ["host", "kind"], "left").select(
        "page_id", "url", F.coalesce(F.array_join(blocks, "\n\n"), F.lit("")).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
