"""Main text of web pages: a tree-structured graphical model over the elements of each page."""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import least_hashed

# The model is trained on at most so many pages, those whose keys have the least hashes.
TRAIN_PAGES = 2000
THRESHOLD = 0.5

# Elements by what they are in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes template xmp".split())
HIDDEN = RAW | frozenset("head select option button svg math canvas audio video object".split())
BOUNDARY = frozenset("nav header footer aside form menu dialog address".split())
# A header or an address may be a part of an article, too.
FENCES = BOUNDARY - {"header", "address"}
MAIN = frozenset("article main".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li pre blockquote dd dt figcaption td th caption".split())
BLOCK = BOUNDARY | MAIN | PROSE | frozenset(
    "html body div section ul ol dl table thead tbody tfoot tr figure fieldset details summary center hgroup search".split()
)
# What may stand in a head; anything else that starts ends it, as do words.
HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title html head".split())
# Elements of another language; in it, and for them, a tag that ends in '/>' is closed at once.
FOREIGN = frozenset("svg math".split())
# An element that starts ends an open one of these, unless one of the others lies between.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
# Words of classes, ids and roles, by what they say.
HINTS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs toolbar",
    "frame": "header masthead banner footer footnote bottom topbar logo branding copyright legal contentinfo",
    "side": "sidebar side aside related recommended recommendations popular trending more widget complementary tags",
    "advert": "ad ads advert advertisement adverts promo promoted promotion sponsor sponsored outbrain taboola",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup paywall disclaimer",
    "social": "share sharing social comment comments commenter disqus reply replies respond discussion discussions feedback"
    " cmt cmnt cmnts kommentar kommentare commentaire commentaires comentario comentarios commenti guestbook reactions",
    "form": "form search login signin register contact",
    "main": "article content main post entry story body text prose blog",
}
_HINT_OF = {word: hint for hint, words in HINTS.items() for word in words.split()}
# Words that are joined to others in a class name and say nothing themselves, and
# beginnings of class names that tell of a page's layout or an article's topics.
_JOINED = frozenset("list item wrap wrapper box area block container inner outer user reader page site unit slot thread left right".split())
_ABOUT = frozenset("has have with no not without is category tag type status format author lang".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_HINT_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Element:
    """A block element: a variable of the model, with the text runs that are directly its own."""

    __slots__ = ("tag", "parent", "hint", "fenced", "words", "links", "marks", "own")

    def __init__(self, tag: str, parent: int, hint: str, fenced: bool):
        self.tag, self.parent, self.hint, self.fenced = tag, parent, hint, fenced
        self.words = self.links = self.marks = self.own = 0


def parse(page: str) -> tuple[list[Element], list[tuple[int, str]]]:
    """Block elements, parents first, and text blocks (element, text) in page order.

    Broken markup is read as browsers do in the main: missing end tags are implied, stray ones
    ignored, an unfinished tag at the end is dropped.
    """
    elements, blocks = [Element("html", -1, "none", False)], []
    stack: list[tuple[str, int]] = [("html", 0)]  # (tag, its block element)
    opened: Counter = Counter(["html"])  # what is on the stack, so that it is seldom searched
    run: list[tuple[str, bool]] = []
    hidden = links = at = 0

    def close_run() -> None:
        text = " ".join(html.unescape("".join(t for t, _ in run)).split())
        if text:
            owner = stack[-1][1]
            e, n = elements[owner], text.count(" ") + 1
            e.own += n
            e.links += sum(len(t.split()) for t, linked in run if linked)
            e.marks += sum(map(text.count, ".!?"))
            blocks.append((owner, text))
        run.clear()

    def pop(to: int) -> None:
        nonlocal hidden, links
        for tag, _ in stack[to:]:
            opened[tag] -= 1
            hidden -= tag in HIDDEN
            links -= tag == "a"
        if any(tag in BLOCK for tag, _ in stack[to:]):
            close_run()
        del stack[to:]

    def innermost(tags: set[str] | frozenset[str], stop: set[str] | frozenset[str] = frozenset()) -> int:
        if not any(opened[tag] for tag in tags):
            return 0
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in tags:
                return i
            if stack[i][0] in stop:
                break
        return 0

    while at < len(page):
        found = _TAG.search(page, at)
        text = page[at : found.start() if found else len(page)]
        if stack[-1][0] == "head" and text.strip():
            pop(len(stack) - 1)
        if text and not hidden:
            run.append((text, links > 0))
        if not found:
            break
        at = found.end()
        ends, tag, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not tag:
            continue
        tag = tag.lower()
        if ends:
            if i := innermost({tag}):
                pop(i)
            continue
        if opened["head"] and tag not in HEAD and (i := innermost({"head"}, {"template"})):
            pop(i)
        if tag == "head" and (opened["head"] or opened["body"]):
            continue
        if attributes.endswith("/") and (tag in FOREIGN or (tag not in BLOCK and any(opened[t] for t in FOREIGN))):
            continue
        if tag in VOID:
            if not hidden:
                run.append((" ", False))
            continue
        if tag in RAW:  # nothing in it is markup
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in ("html", "body") and opened[tag]:
            continue
        if tag in BLOCK:
            if (i := innermost({"p"}, {"table", "td", "th"})) and tag not in ("html", "body"):
                pop(i)
            if tag in ENDS and (i := innermost(*ENDS[tag])):
                pop(i)
            close_run()
            above = stack[-1][1]
            hint = "none" if tag in ("html", "body", "main") else hint_of(attributes)
            elements.append(Element(tag, above, hint, elements[above].fenced or telling(elements[above])))
            stack.append((tag, len(elements) - 1))
            opened[tag] += 1
        else:
            stack.append((tag, stack[-1][1]))
            opened[tag] += 1
            hidden += tag in HIDDEN
            links += tag == "a"
    close_run()
    for i in range(len(elements) - 1, -1, -1):
        e = elements[i]
        e.words += e.own
        if e.parent >= 0:
            up = elements[e.parent]
            up.words, up.links, up.marks = up.words + e.words, up.links + e.links, up.marks + e.marks
    return elements, blocks


@lru_cache(1 << 16)
def parts_of(word: str) -> tuple[str, ...]:
    """The known words that a word is made of, such as comment and list; itself if it is not."""
    if word in _HINT_OF or word in _JOINED:
        return (word,)
    for i in range(len(word) - 2, 2, -1):
        if word[:i] in _HINT_OF or word[:i] in _JOINED:
            rest = parts_of(word[i:])
            if all(w in _HINT_OF or w in _JOINED for w in rest):
                return (word[:i], *rest)
    return (word,)


def hint_of(attributes: str | None) -> str:
    """What the class, id and role of an element say it is.

    All their words count, also those of compounds, and one that tells of no content outweighs one
    that tells of content, so the comments of a post are comments. The header of an article is a
    part of it. Names that begin like 'has' or 'category' say nothing of the element itself.
    """
    content = False
    for _, *values in _ATTRIBUTE.findall(attributes or ""):
        for name in next((v for v in values if v), "").split():
            words = [w.lower() for w in _HINT_WORD.findall(name)]
            if not words or words[0] in _ABOUT:
                continue
            # What is too long for a word is not taken apart, so that the work stays linear.
            hints = [(w, _HINT_OF[w]) for word in words for w in (parts_of(word) if len(word) < 30 else ()) if w in _HINT_OF]
            main = any(hint == "main" for _, hint in hints)
            for word, hint in hints:
                if hint != "main" and not (main and word == "header"):
                    return hint
            content |= main
    return "main" if content else "none"


def telling(e: Element) -> bool:
    """Whether an element's tag or a word says that it is no content."""
    return e.tag in FENCES or e.hint not in ("none", "main")


def kind(e: Element) -> str:
    """Elements whose tie to their parent is alike; those behind a telling one apart."""
    if e.fenced:
        return "fenced"
    if telling(e):
        return "boundary"
    if e.tag in MAIN:
        return "main"
    return "prose" if e.tag in PROSE else "container"


def observations(e: Element) -> list[tuple[str, str]]:
    """The discrete features of an element: [(feature, value)]."""
    share = e.links / e.words if e.words else 0.0
    return [
        ("tag", e.tag),
        ("hint", e.hint),
        ("words", str(min(e.words.bit_length(), 8))),
        ("own", str(min(e.own.bit_length(), 6))),
        ("links", str(math.ceil(share * 4))),
        ("marks", str(min((12 * e.marks) // e.words, 6)) if e.words else "none"),
    ]


def distant_labels(elements: list[Element]) -> list[int] | None:
    """1 for content, 0 for the rest, on pages whose markup says where the content is.

    Content lies in an article or main element, but not in what is marked as a boundary or by a
    telling word inside of it. Other pages have no labels.
    """
    if not any(e.tag in MAIN for e in elements):
        return None
    labels: list[int] = []
    for e in elements:
        inside = e.parent >= 0 and labels[e.parent]
        labels.append(int((inside or e.tag in MAIN) and not e.fenced and not telling(e)))
    return labels


# What is believed before any page was seen, as counts of (boilerplate, content) elements.
PRIOR: dict[tuple[str, str], tuple[float, float]] = {
    **{("tag", t): (400.0, 1.0) for t in FENCES},
    **{("tag", t): (6.0, 2.0) for t in ("header", "address")},
    **{("tag", t): (1.0, 30.0) for t in MAIN},
    **{("hint", h): (400.0, 1.0) for h in HINTS},
    ("hint", "main"): (1.0, 10.0),
    ("links", "4"): (30.0, 1.0),
}
# Chance of content below (boilerplate, content), and how many elements that belief weighs.
EDGE_PRIOR = {"boundary": (0.002, 0.02), "main": (0.9, 0.98), "prose": (0.05, 0.97), "container": (0.2, 0.9), "fenced": (0.002, 0.9)}
EDGE_WEIGHT = 20.0
# Sites share few templates, in which a plain element may only ever occur on one side. What is
# learned of those is held within these bounds, so that other templates stay readable.
EDGE_FLOOR = 0.03
LIMITS = {"tag": 1.5, "hint": 7.0, "links": 2.0, "words": 1.0, "own": 1.0, "marks": 1.0}
TELLING_LIMIT = 7.0


class Model:
    """Potentials: a ratio content to boilerplate for each observation, a 2x2 table for each kind."""

    def __init__(self, counts: dict[tuple[str, str, str], float]):
        """``counts`` of ("node" | "edge", name and value, label or labels) in labelled pages."""
        seen: dict[tuple[str, str], list[float]] = {k: list(v) for k, v in PRIOR.items()}
        edges = {k: [[EDGE_WEIGHT * (1 - p), EDGE_WEIGHT * p] for p in chance] for k, chance in EDGE_PRIOR.items()}
        for (what, name, value), n in sorted(counts.items()):
            if what == "edge":
                edges[name][int(value[0])][int(value[1])] += n
            else:
                feature, _, label = value.rpartition("|")
                seen.setdefault((name, feature), [1.0, 1.0])[int(label)] += n
        total = {f: [sum(v[y] for (g, _), v in seen.items() if g == f) or 1.0 for y in (0, 1)] for f in LIMITS}
        self.ratio = {}
        for (f, v), c in seen.items():
            limit = TELLING_LIMIT if f == "tag" and v in FENCES | MAIN else LIMITS[f]
            ratio = math.log(c[1] / total[f][1]) - math.log(c[0] / total[f][0])
            self.ratio[f, v] = max(-limit, min(limit, ratio))
        self.edges = {}
        for k, table in edges.items():
            floor = EDGE_FLOOR if k in ("prose", "container") else 0.0
            chances = [min(max(row[1] / sum(row), floor), 1 - floor) for row in table]
            self.edges[k] = [[1 - p, p] for p in chances]

    def marginals(self, elements: list[Element]) -> list[float]:
        """The chance that each element is content, given the whole page.

        Sum-product: messages go from the leaves to the root, then back. Elements stand after
        their parents, so two passes over the list do.
        """
        n = len(elements)
        own = []
        for e in elements:
            odds = sum(self.ratio.get(o, 0.0) for o in observations(e))
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
            own.append((1 - p, p))
        tables = [self.edges[kind(e)] for e in elements]
        below = [list(p) for p in own]  # evidence in and under an element
        up = [(1.0, 1.0)] * n  # what it tells its parent
        for i in range(n - 1, 0, -1):
            b0, b1 = below[i]
            t = tables[i]
            m0, m1 = t[0][0] * b0 + t[0][1] * b1, t[1][0] * b0 + t[1][1] * b1
            up[i] = (m0, m1)
            parent = below[elements[i].parent]
            p0, p1 = parent[0] * m0, parent[1] * m1
            parent[0], parent[1] = p0 / (p0 + p1), p1 / (p0 + p1)
        belief = [(0.0, 0.0)] * n
        for i, e in enumerate(elements):
            if e.parent < 0:
                d0, d1 = 0.8, 0.2  # a page's root is no content by itself
            else:
                # The parent's belief without what this element told it.
                q0, q1 = belief[e.parent]
                q0, q1 = q0 / max(up[i][0], 1e-300), q1 / max(up[i][1], 1e-300)
                t = tables[i]
                d0, d1 = q0 * t[0][0] + q1 * t[1][0], q0 * t[0][1] + q1 * t[1][1]
            b0, b1 = below[i][0] * d0, below[i][1] * d1
            belief[i] = (b0 / (b0 + b1), b1 / (b0 + b1))
        return [b[1] for b in belief]

    def extract(self, page: str | None) -> str:
        elements, blocks = parse(page or "")
        content = self.marginals(elements)
        return "\n\n".join(text for owner, text in blocks if content[owner] > THRESHOLD)


def page_counts(page: str | None) -> Counter:
    """What a page adds to the model's counts; nothing if it is not labelled."""
    elements, _ = parse(page or "")
    labels, counts = distant_labels(elements), Counter()
    for i, e in enumerate(elements if labels else []):
        for name, value in observations(e):
            counts["node", name, f"{value}|{labels[i]}"] += 1
        if e.parent >= 0:
            counts["edge", kind(e), f"{labels[e.parent]}{labels[i]}"] += 1
    return counts


def fit(pages: DataFrame, key: str = "page_id", page: str = "html", most: int = TRAIN_PAGES) -> Model:
    """Train on the labelled ones of a bounded, fixed sample of pages. The counts are few hundred."""
    few = least_hashed(pages, most, key).select(F.col(page).alias("page"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for p in batch.column(0):
                total.update(page_counts(p.as_py()))
        rows = [{"what": w, "name": n, "value": v, "n": c} for (w, n, v), c in total.items()]
        if rows:
            yield pa.RecordBatch.from_pylist(rows)

    counted = few.mapInArrow(count, "what string, name string, value string, n long")
    summed = counted.groupBy("what", "name", "value").agg(F.sum("n").alias("n"))
    return Model({(r["what"], r["name"], r["value"]): r["n"] for r in summed.collect()})


def main_text(pages: DataFrame, key: str = "page_id", page: str = "html", url: str = "url") -> DataFrame:
    """(key, url, text) of every row: the text of blocks that are likelier content than not.

    Each page is a tree whose elements are variables; see ``Model``. Character references are
    decoded, white space in a block becomes one space, blocks are joined by an empty line. A NULL
    or empty page, or one without content, gives an empty text; repeated rows and NULL keys keep
    their rows; an empty table gives no row. There is no shuffle but for the training sample.
    """
    model = fit(pages, key, page)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [model.extract(p.as_py()) for p in batch.column(2)]
            yield pa.record_batch({"key": batch.column(0), "url": batch.column(1), "text": pa.array(texts, pa.string())})

    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"), F.col(page).alias("page"))
    return rows.mapInArrow(run, "key long, url string, text string")
