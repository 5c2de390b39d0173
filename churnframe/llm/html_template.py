"""Operator 1, main text by equivalence-class template deduction.

Pages of one host share a template.  Every element of a page gives two tokens,
its opening and its closing tag, told apart by the path of tags and classes
that leads to it; every word of its text gives one, told apart by that path and
by its number among equal words of one run of text.  Per host, a token's
*occurrence vector* is its count on each page; tokens with equal vectors on
enough pages, inside the same element of another vector, form an equivalence
class.  A class is valid as far as its tokens
keep their order and its instances nest with those of the other classes on
every page: elements that break the order, or the nesting with a class of more
pages, are cut out of their class, and so are words that change their place
among the class's tags or lie in no element of it.

The valid classes make up the template, and what lies between template tokens
are its slots.  A block whose words are all template tokens holds no slot and
gives no text.  Slots are labelled for the whole host: boilerplate by the
meaning of their tags and classes or by being mostly links; content if inside
an article, else the slot with most text outside links and template words.  A
page's text is the text of its content slots; a block that holds a slot is
given with the template words around it.

Occurrence vectors are compared by a 128-bit exclusive or of per-page hashes,
so they are aggregated (map side first) and never gathered: a host with a third
of all pages is as cheap as many small ones.  A word can share a class only with
an element around it, so it must be on each of up to four pages fixed by hash
that have the class, as often as that element; every page of the host then
checks the counts of the words that are.
Template rows per host are few and join the pages by host; the planner splits a
hot host's pages.

Defined results: null html gives empty text; null urls form one host of their
own; truncated or badly nested html is closed at its end; equal pages of a
host count once and give equal results; an empty table gives an empty
result; extra columns are passed through.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections import Counter
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnframe.llm.common import fresh, materialize_as, maybe_broadcast

#: a class must be seen on at least this share of the host's pages, and pages
SUPPORT = 0.3
MIN_PAGES = 3
LINK_SHARE = 0.5
LONGEST_PATH = 2000
#: templates of so many hosts may be broadcast
TEMPLATES = 20_000

# fixed values of the HTML language
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section
summary table tbody td tfoot th thead tr ul""".split())
#: an opening tag of the key closes an open element of the value
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",), "thead": ("tr", "td", "th"),
          "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("thead", "tbody", "tr", "td", "th")}
SCOPES = frozenset("table ul ol dl div section article main aside nav header footer form body td th blockquote".split())
BOILERPLATE_TAGS = frozenset("""head nav footer aside form button select option input label menu dialog svg canvas
object audio video script style textarea title noscript iframe template xmp noembed""".split())
CONTENT_TAGS = frozenset(("article", "main"))
_NAMES = re.compile(r"(?:^|[\s_-])(?:nav\w*|menu\w*|header|masthead|topbar|footer|side-?bar|aside|notice|cookie\w*|consent|"
                    r"banner|popup|modal|ad|ads|advert\w*|promo\w*|sponsor\w*|comments?|respond|replies|disqus|related|"
                    r"recommend\w*|share|sharing|social|breadcrumbs?|pagination|pager|newsletter|subscribe|signup|login|"
                    r"search|toolbar|widget|copyright|legal|disclaimer)(?:$|[\s_-])", re.I)
_CONTENT_NAMES = re.compile(r"(?:^|[\s_-])(?:article|post|entry|story|main|content)(?:[\s_-]?(?:body|content|text))?(?:$|[\s_-])", re.I)
_ROLES = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "dialog", "alert"))

_TAG = re.compile(r"""<(?:!--(?:>|->|.*?(?:--!?>|\Z))|[!?][^>]*(?:>|\Z)"""
                  r"""|(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*"|'[^']*'|["'])*?)(?:>|\Z))""", re.S)
_ATTR = re.compile(r"""\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_SPACE = re.compile(r"\s+")
HOST = r"^\s*(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#]*@)?([^/?#]*)"


def label_of(tag: str, attrs: str) -> str:
    """``b`` boilerplate, ``c`` content, ``-`` neither, by meaning alone."""
    if tag in BOILERPLATE_TAGS or tag == "header":
        return "h" if tag == "header" else "b"
    found = {k.lower(): v.strip("\"'") for k, v in _ATTR.findall(attrs)} if attrs else {}
    names = f"{found.get('class', '')} {found.get('id', '')}"
    if found.get("role", "").lower() in _ROLES or "hidden" in found or found.get("aria-hidden", "").lower() == "true":
        return "b"
    if tag in CONTENT_TAGS or found.get("role", "").lower() in CONTENT_TAGS:
        return "c"
    if tag not in ("html", "body") and _NAMES.search(names):
        return "b"
    return "c" if names.strip() and _CONTENT_NAMES.search(names) else "-"


def signature(tag: str, attrs: str) -> str:
    """A tag with its classes, without digits that number single elements."""
    if not attrs:
        return tag
    found = {k.lower(): v.strip("\"'") for k, v in _ATTR.findall(attrs)}
    names = "".join("." + re.sub(r"\d+", "0", n) for n in found.get("class", "").split()[:4])
    return tag + names + ("#" + re.sub(r"\d+", "0", found["id"]) if found.get("id") else "")


def walk(page: str):
    """Events of a page in order: ("open", path, label, tag), ("close", path,
    "", tag) and ("text", path, "", text).  Elements left open are closed."""
    stack: list[tuple[str, str]] = []  # (tag, path)
    at, n = 0, len(page)

    def pop(to: int):
        while len(stack) > to:
            tag, path = stack.pop()
            yield "close", path, "", tag

    while at < n:
        lt = page.find("<", at)
        m = _TAG.match(page, lt) if lt >= 0 else None
        while lt >= 0 and m is None:  # a lone "<" is text
            lt = page.find("<", lt + 1)
            m = _TAG.match(page, lt) if lt >= 0 else None
        if lt < 0:
            lt = n
        if lt > at:
            yield "text", stack[-1][1] if stack else "", "", page[at:lt]
        if m is None:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag, attrs = m[2].lower(), m[3]
        if m[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    yield from pop(k)
                    break
            continue
        if tag in BLOCKS:  # a block ends an open paragraph
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p":
                    yield from pop(k)
                    break
                if stack[k][0] in SCOPES:
                    break
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in CLOSES.get(tag, ()):
                yield from pop(k)
                break
            if stack[k][0] in SCOPES:
                break
        path = (stack[-1][1] if stack else "") + "/" + signature(tag, attrs)
        if len(path) > LONGEST_PATH:  # very deep nesting: the front becomes a digest
            path = "/~" + hashlib.blake2b(path.encode("utf-8", "replace"), digest_size=16).hexdigest()
        if tag in VOID:
            yield "void", path, "", tag
            continue
        yield "open", path, label_of(tag, attrs), tag
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(page, at)
            stop = end.start() if end else n
            yield "raw", path, "", page[at:stop]
            gt = page.find(">", stop) if end else n
            at = n if gt < 0 else gt + 1 if end else n
            yield "close", path, "", tag
            continue
        stack.append((tag, path))
    yield from pop(0)


def run_words(run: str) -> list[str]:
    """Word tokens of a run of text; an equal word's later occurrences in the
    run are numbered."""
    words = html.unescape(run).split()
    if len(set(words)) == len(words):
        return words
    seen: Counter = Counter()
    out = []
    for w in words:
        seen[w] += 1
        out.append(w if seen[w] == 1 else f"{w} {seen[w]}")
    return out


def page_tokens(page: str) -> dict[str, list]:
    """path -> [openings, closings by an own end tag or an implied one, label,
    event of the first opening]."""
    out: dict[str, list] = {}
    for at, (kind, path, label, _) in enumerate(walk(page)):
        if kind == "open":
            out.setdefault(path, [0, 0, label, at])[0] += 1
        elif kind == "close":
            out[path][1] += 1
    return out


def page_words(page: str) -> dict[str, Counter]:
    """path -> word tokens directly inside with their counts."""
    out: dict[str, Counter] = {}
    for kind, path, _, x in walk(page):
        if kind == "text" and path:
            out.setdefault(path, Counter()).update(run_words(x))
    return out


def _around(path: str) -> list[str]:
    """The paths of an element and of all elements around it."""
    ends = [k for k, c in enumerate(path) if c == "/"][1:]
    return [path[:k] for k in ends] + [path]


def _token_udf():
    def run(pages: pd.Series) -> pd.Series:
        return pd.Series([[(p, *row) for p, row in page_tokens(x or "").items()] for x in pages])
    return F.pandas_udf(run, "array<struct<path:string,opens:int,closes:int,label:string,at:long>>")


class Template:
    """A host's tokens, from the slots that ``deduce`` lists."""

    def __init__(self, slots: str | None):
        tokens = json.loads(slots or "[]")
        #: path -> token of the element
        self.elements = {t["path"]: t for t in tokens if not t["word"]}
        #: path -> class: the vector, and the element around that has another one
        self.classes = {p: (t["class"], next((q for q in reversed(_around(p)) if self.elements.get(q, t)["class"]
                                              != t["class"]), "")) for p, t in self.elements.items()}
        #: class -> paths of its elements in order
        self.order: dict[tuple, list] = {}
        for t in sorted(self.elements.values(), key=lambda t: (t["at"], t["path"])):
            self.order.setdefault(self.classes[t["path"]], []).append(t["path"])
        #: path -> word token -> class, if an element of the class is around it
        self.words: dict[str, dict[str, tuple]] = {}
        for t in tokens:
            near = next((self.classes[q] for q in reversed(_around(t["path"])) if t["word"]
                         and q in self.classes and self.classes[q][0] == t["class"]), None)
            if near:
                self.words.setdefault(t["path"], {})[t["word"]] = near

    def candidates(self, page: str, classes: list[str]) -> list[tuple]:
        """(class, path, word) of words that are on the page as often as an
        element around them that is in one of the classes."""
        opens = Counter(path for kind, path, _, _ in walk(page) if kind == "open")
        out = set()
        for path, words in page_words(page).items():
            near = [(self.elements[q]["class"], opens[q]) for q in _around(path) if q in self.elements]
            out.update((c, path, w) for c, n in near if c in classes for w, m in words.items() if m == n)
        return sorted(out)

    def holds(self, path: str, run: str) -> bool:
        """Whether every word of a run of text is a template token."""
        known = self.words.get(path)
        return all(w in known for w in run_words(run)) if known else not run.strip()

    def check(self, page: str) -> list[tuple]:
        """What the page says about the classes, as (path, word, place, chars,
        linked): with an empty word an element out of order or nesting; with a
        word its last tag of the class, which must be one on all pages, or "!"
        if it is not there as often as the class; with no word the characters of
        runs that hold a slot, and those in links."""
        bad: set[str] = set()
        places: set[tuple[str, str, str]] = set()
        sizes: dict[str, list[int]] = {}
        counts: Counter = Counter()
        links = 0
        live: list[tuple] = []  # class instances: (class, open elements, elements begun, tags met)

        def missing(inst: tuple) -> list[str]:
            return [p for p in self.order[inst[0]] if p not in inst[2] and p not in bad]

        def tag(kind: str, path: str) -> None:
            cls = self.classes[path]
            at = next((k for k in range(len(live) - 1, -1, -1) if live[k][0] == cls), len(live))
            if at == len(live):
                if kind == "close":
                    bad.add(path)
                    return
                live.append((cls, set(), set(), [""]))
            # instances begun inside this one must have ended: the class of fewer pages gives way
            late = live[at + 1:]
            if any(self.elements[self.order[i[0]][0]]["pages"] > self.elements[path]["pages"] for i in late):
                bad.add(path)
                return
            for i in late:
                bad.update(i[1], missing(i))
            del live[at + 1:]
            inst = live[at]
            if kind == "open" and path in inst[2]:  # the next instance
                bad.update(inst[1], missing(inst))
                inst = live[at] = (cls, set(), set(), [""])
            if kind == "open" and missing(inst)[:1] != [path]:
                bad.add(path)
                return
            if kind == "open":
                inst[1].add(path)
                inst[2].add(path)
            else:
                inst[1].discard(path)
            inst[3].append(f"{kind} {path}")

        for kind, path, _, x in walk(page):
            if kind in ("open", "close"):
                counts[path] += kind == "open"
                links += (x == "a") * (1 if kind == "open" else -1)
                if path in self.elements and path not in bad:
                    tag(kind, path)
                    while live and not (live[-1][1] - bad) and not missing(live[-1]):
                        live.pop()
            elif kind == "text" and path and x.strip():
                known = self.words.get(path)
                for w in run_words(x) if known else ():
                    if w in known:
                        counts[path, w] += 1
                        places.add((path, w, next((i[3][-1] for i in reversed(live) if i[0] == known[w]), "")))
                if not self.holds(path, x):
                    size = sizes.setdefault(path, [0, 0])
                    size[0] += len(x.strip())
                    size[1] += len(x.strip()) if links > 0 else 0
        for i in live:
            bad.update(i[1], missing(i))
        # elements of a class have one count on the page
        places.update((p, w, "!") for p, known in self.words.items() for w, c in known.items()
                      if counts[p, w] != counts[self.order[c][0]])
        return ([(p, "", "", 0, 0) for p in sorted(bad)] + [(*t, 0, 0) for t in sorted(places)]
                + [(p, None, None, *n) for p, n in sizes.items()])


def _check_udf():
    def run(pages: pd.Series, slots: pd.Series) -> pd.Series:
        known: dict = {}
        out = []
        for page, s in zip(pages, slots):
            if s not in known:
                known[s] = Template(s)
            out.append(known[s].check(page or ""))
        return pd.Series(out, dtype=object)
    return F.pandas_udf(run, "array<struct<path:string,word:string,place:string,chars:long,linked:long>>")


def _candidate_udf():
    def run(pages: pd.Series, slots: pd.Series, classes: pd.Series) -> pd.Series:
        return pd.Series([Template(s).candidates(p or "", list(c)) for p, s, c in zip(pages, slots, classes)], dtype=object)
    return F.pandas_udf(run, "array<struct<class:string,path:string,word:string>>")


def _listed(tokens: DataFrame, *more: str) -> DataFrame:
    token = F.struct("class", "path", "word", "pages", "label", "at", *more)
    slots = tokens.groupBy("host").agg(F.to_json(F.sort_array(F.collect_list(token))).alias("slots"))
    return maybe_broadcast(materialize_as(slots, "html-slots"), TEMPLATES)


def _different(pages: DataFrame) -> DataFrame:
    """``pages`` without repeats; only repeated ones are shuffled."""
    named = ["host", "page"]
    repeated = materialize_as(pages.groupBy(named).agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select(named),
                              "html-repeated")
    repeated = maybe_broadcast(repeated)
    return pages.join(repeated, named, "left_anti").union(
        pages.join(repeated, named, "left_semi").select(pages.columns).distinct()).select(pages.columns)


def deduce(pages: DataFrame, support: float = SUPPORT) -> DataFrame:
    """Template of each host: (host, slots), ``slots`` listing in JSON the
    tokens of its valid classes, and for elements the characters of text in
    slots (``chars``), also those in links (``linked``); ``pages`` has (host,
    html)."""
    pages = _different(pages.select("host", F.xxhash64("html").alias("page"), "html"))
    found = pages.select("host", "page", F.explode(_token_udf()("html")).alias("t")).select("host", "page", "t.*")
    h = lambda seed: F.xxhash64("page", F.lit(seed))
    vector = lambda seed: F.bit_xor(F.xxhash64("page", "opens", F.lit(seed)))
    per = found.groupBy("host", "path").agg(
        vector(1).alias("o1"), vector(2).alias("o2"), F.min((F.col("opens") == F.col("closes"))).alias("even"),
        F.count(F.lit(1)).alias("pages"), F.max(F.ascii("label")).alias("label"), F.sum("at").alias("at"),
        *[f(h(k)).alias(f"{f.__name__}{k}") for k in (3, 4) for f in (F.min, F.max)])
    total = pages.groupBy("host").agg(F.count(F.lit(1)).alias("total"))
    # opening and closing token have one vector
    elements = per.filter(F.col("even") & (F.col("pages") >= MIN_PAGES)).join(total, "host").filter(
        F.col("pages") >= F.col("total") * support)
    elements = materialize_as(elements.select(
        "host", F.concat_ws(":", "o1", "o2").alias("class"), "path", F.lit("").alias("word"), "pages",
        F.char("label").alias("label"), "at", F.array_distinct(F.array("min3", "max3", "min4", "max4")).alias("on")),
        "html-elements")
    # pages fixed by two hashes: words on all of them, as often as the class, are its candidates
    marks = elements.select("host", "class", F.size("on").alias("least"), F.explode("on").alias("mark")).distinct()
    marks = materialize_as(marks, "html-marks")
    by_page = materialize_as(marks.groupBy("host", "mark").agg(F.collect_set("class").alias("classes")), "html-marked")
    marked = pages.select("host", "html", F.explode(F.array(h(3), h(4))).alias("mark")).join(
        maybe_broadcast(by_page), ["host", "mark"])
    words = (marked.join(_listed(elements), "host")
                   .select("host", "mark", F.explode(_candidate_udf()("html", "slots", "classes")).alias("c"))
                   .select("host", "mark", "c.*").groupBy("host", "class", "path", "word").agg(F.count(F.lit(1)).alias("n")))
    least = marks.groupBy("host", "class").agg(F.first("least").alias("least"))
    words = words.join(least, ["host", "class"]).filter("n >= least").select(
        "host", "class", "path", "word", F.lit(None).cast("long").alias("pages"),
        F.lit(None).cast("string").alias("label"), F.lit(None).cast("long").alias("at"))
    tokens = materialize_as(elements.drop("on").unionByName(words), "html-tokens")
    said = (pages.join(_listed(tokens), "host").select("host", F.explode(_check_udf()("html", "slots")).alias("c"))
                 .select("host", "c.*").groupBy("host", "path", "word")
                 .agg(F.min("place").alias("a"), F.max("place").alias("z"), F.sum("chars").alias("chars"),
                      F.sum("linked").alias("linked")))
    said = materialize_as(said, "html-said")
    wrong = (F.col("word") == "") | (F.col("a") != F.col("z")) | (F.col("a") == "!")
    faults = said.filter(wrong).select("host", "path", "word")
    sizes = said.filter("word IS NULL").select("host", "path", F.lit("").alias("word"), "chars", "linked")
    valid = tokens.join(faults, ["host", "path", "word"], "left_anti").join(sizes, ["host", "path", "word"], "left")
    return _listed(valid.fillna(0, ["chars", "linked"]), "chars", "linked")


def content_paths(slots: Iterable[dict]) -> tuple[frozenset, str | None]:
    """From a host's template elements: paths that are boilerplate because their
    text is mostly links, and the path of the densest slot for pages without
    an article."""
    inside: Counter = Counter()
    linked: Counter = Counter()
    for s in slots:
        path = s["path"]
        parts = path.split("/")[1:]
        for k in range(1, len(parts) + 1):
            p = "/" + "/".join(parts[:k])
            inside[p] += s["chars"]
            linked[p] += s["linked"]
    label = {s["path"]: s["label"] for s in slots}
    menus = {p for p, lab in label.items() if lab == "-" and re.search(r"/(?:ul|ol|table|div|section)[^/]*$", p)
             and inside[p] and linked[p] > LINK_SHARE * inside[p]}

    def clean(p: str) -> bool:
        parts = p.split("/")[1:]
        heads = ["/" + "/".join(parts[:k]) for k in range(1, len(parts) + 1)]
        return not any(label.get(x) in ("b", "h") or x in menus for x in heads)

    body = [p for p in label if clean(p) and re.search(r"/(?:div|section|td|body|center)[^/]*$", p)]
    best, p = None, max((p for p in body if p.endswith("/body")), key=len, default=None)
    while p is not None:  # down to the smallest slot that holds most of the text
        best = p
        down = [q for q in body if q.startswith(p + "/") and inside[q] >= 0.7 * max(inside[p] - linked[p], 1)]
        p = min(down, key=lambda q: (q.count("/"), -inside[q], q), default=None)
    return frozenset(menus), best


def page_text(page: str, menus: frozenset = frozenset(), densest: str | None = None,
              template: Template | None = None) -> str:
    """Main text: the blocks inside content slots that are not all template
    words, one per line.  Content elements without text outside boilerplate do
    not count; then it is the densest slot, or all but boilerplate if the page
    lacks that too."""
    events = list(walk(page))
    blocks = _blocks(events, menus, template, lambda path, label: label == "c")
    if not blocks and densest and any(k == "open" and path == densest for k, path, _, _ in events):
        return "\n".join(_blocks(events, menus, template, lambda path, label: path == densest))
    return "\n".join(blocks or _blocks(events, menus, template, None))


def _blocks(events: list, menus: frozenset, template: Template | None, wanted: Callable | None) -> list[str]:
    """Blocks inside the elements that ``wanted`` picks, anywhere if None."""
    blocks: list[str] = []
    buffer: list[str] = []
    slots = 0  # runs in the buffer that hold more than template words
    bad: list[bool] = []
    good: list[bool] = []

    def flush() -> None:
        nonlocal slots
        text = _SPACE.sub(" ", html.unescape("".join(buffer))).strip()
        buffer.clear()
        if text and slots:
            blocks.append(text)
        slots = 0

    inside_bad = inside_good = 0
    for kind, path, label, x in events:
        if kind == "open":
            if x in BLOCKS:
                flush()
            # a header inside an article is the article's own heading
            b = label == "b" or (label == "h" and not inside_good) or path in menus
            g = wanted is not None and wanted(path, label)
            bad.append(b)
            good.append(g)
            inside_bad += b
            inside_good += g
        elif kind == "close":
            if x in BLOCKS:
                flush()
            inside_bad -= bad.pop()
            inside_good -= good.pop()
        elif kind == "void":
            if x in BLOCKS:
                flush()
            elif x == "br" and buffer:
                buffer.append(" ")
        elif kind == "text" and not inside_bad and (inside_good or wanted is None):
            buffer.append(x)
            slots += template is None or not template.holds(path, x)
    flush()
    return blocks


def extract(df: DataFrame, url: str = "url", page_html: str = "html", key: str = "page_id") -> DataFrame:
    """``df`` plus ``main_text``."""
    hname, = fresh(df, ["host"])
    hosts = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), HOST, 1))
    pages = df.select(hosts.alias("host"), F.coalesce(F.col(page_html), F.lit("")).alias("html"))
    template = deduce(pages)

    def run(htmls: pd.Series, slots: pd.Series) -> pd.Series:
        known: dict = {}
        out = []
        for page, s in zip(htmls, slots):
            if s not in known:
                t = Template(s)
                known[s] = (*content_paths(t.elements.values()), t)
            out.append(page_text(page or "", *known[s]))
        return pd.Series(out, dtype=object)

    tname, = fresh(df, ["slots"])
    plan = template.select(F.col("host").alias(hname), F.col("slots").alias(tname))
    joined = df.withColumn(hname, hosts).join(plan, hname, "left")
    text = F.pandas_udf(run, "string")(F.coalesce(F.col(page_html), F.lit("")), F.col(tname))
    return joined.select(*df.columns, text.alias("main_text"))
