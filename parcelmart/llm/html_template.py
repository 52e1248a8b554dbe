"""Main text of web pages by template deduction from equivalence classes.

Structural tokens (an element with its path) and text tokens (a block of text with its path) are counted on every page.
Pages of one host with the same outer containers form a layout; layouts of very few pages are taken together. Tokens of
a layout whose counts agree on every page share an occurrence vector and form an equivalence class; the vectors are
compared by an order-free checksum, so a layout with very many pages is only ever summed up. Classes that enough pages
have, and whose tokens nest, make up the layout's template. A text in the class of an element around it stands wherever
that element does, so it belongs to the template. What lies between template tokens are its slots: the main one holds most
of the prose that varies. Tags and words of classes add evidence: plain evidence (comments, footers, forms) removes an
element whatever its share of the prose, unless it holds the page's article or nothing else is left.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from parcelmart.llm.common import stored, table, text_batches

# Share of a host's pages a class must be on, and of the prose of its surroundings a main slot must hold.
SUPPORT = 0.2
PROSE_SHARE = 0.5
# Share of a page's prose from which weak evidence does not remove an element.
WEAK_SHARE = 0.1
# Layouts of fewer pages are taken together per host, and a text on fewer pages is no template.
LEAST_PAGES = 3
# Levels of containers, html and body included, that tell layouts apart.
LAYOUT_LEVELS = 4
# Templates up to this many bytes are broadcast, more are joined by a shuffle.
BROADCAST_BYTES = 16 << 20
# Levels of a path that are written out; below them a container's whole path is one hashed level.
DEEPEST = 60

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(["script", "style", "textarea", "noscript", "iframe", "template", "title"])
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var wbr".split()
)
# Never text of a page.
CONTROLS = frozenset("head button select option svg canvas object audio video".split())
SKIPPED = frozenset("nav footer aside form menu dialog".split())
ROOTS = frozenset(["html", "body", "article", "main"])
# Those that may head a section; the first level is the page's title.
HEADINGS = frozenset(["h2", "h3", "h4", "h5", "h6"])
# Elements that a new element of the given kind ends.
ENDS = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
# Containers that tell layouts apart, and those that may be a fixed part of a slot.
OUTER = frozenset("body article main section div table nav aside footer header form".split())
PARTS = frozenset("section div table ul ol dl nav aside footer header form menu".split())
FENCES = frozenset("html body article main section div table ul ol dl td th blockquote nav aside footer header form".split())
# Words in class, id or role that tell what an element is.
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar cookie cookies "
    "consent gdpr notice notices notification alert popup modal overlay menu nav navbar navigation breadcrumb breadcrumbs "
    "pagination pager comment comments discussion disqus replies respond footer share sharing social related "
    "recommended newsletter subscribe subscription signup login search toolbar widget skip".split()
)
# Of these the ones that tell it even beside other words, unless one of those says otherwise.
PLAIN_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored cookie cookies consent gdpr nav navbar navigation "
    "breadcrumb breadcrumbs pagination pager comment comments disqus replies respond footer newsletter subscribe".split()
)
OTHERWISE = frozenset("has no not with without wrap wrapper container layout page site content open closed off enabled disabled".split())
# Words that tell it of what follows them too, as in comments-wrap, and words of a class that make an article a comment.
LEADING_WORDS = frozenset(["comment", "comments", "disqus", "footer"])
COMMENT_WORDS = frozenset("comment comments reply replies body item entry text".split())
# And those that also name ordinary sections.
DOUBTFUL_WORDS = frozenset("discussion related notice notices alert search".split())
HEAD_WORDS = frozenset(["header", "masthead", "topbar"])
# What begins a tag, its name, and its attributes up to where the tag or an unclosed quote ends. All possessive: a tag costs
# its own length.
OPENING = re.compile(r"<(?:!--|!\[CDATA\[|[!?]|/?[a-zA-Z])")
NAME = re.compile(r"[^\s/>]*+")
ATTRIBUTES = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+")
TAG = re.compile(rf"<(/?)([a-zA-Z]{NAME.pattern})({ATTRIBUTES.pattern})>")
RAW_ENDS = {tag: re.compile(f"</{tag}\\b", re.IGNORECASE) for tag in RAW}
NAMES = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
WORD = re.compile(r"[a-z]+")
SUMMARY = "host string, layout bigint, token string, pages bigint, total bigint, vector bigint, prose bigint, linked bigint"


class Element:
    __slots__ = ("tag", "path", "above", "block", "control", "evidence", "linked", "article", "main", "chosen", "skipped", "cut", "shaded", "prose", "clean", "links", "varying", "held", "depth")

    def __init__(self, tag: str, path: str, above: Element | None) -> None:
        self.tag, self.path, self.above = tag, path, above
        self.block = self
        self.control = above.control if above else False
        self.evidence = 0
        self.linked = above.linked if above else False
        self.article = above.article if above else 0
        self.main = above.main if above else False
        self.chosen = above.chosen if above else False
        self.skipped = self.held = self.shaded = False
        self.depth = above.depth + 1 if above else 0
        # The highest element above that was removed, itself included.
        self.cut: Element | None = None
        # ``clean`` leaves out the prose of elements below that plain evidence speaks against.
        self.prose = self.clean = self.links = self.varying = 0


def described(tag: str, attributes: str) -> tuple[str, int, bool, bool]:
    """Name of an element in paths, evidence in its class, id and role that it is not main text (2 plain, 1 weak), and
    whether they call it a page's head or a reader's comment. Digits are left out of names."""
    if not attributes or "=" not in attributes:
        return tag, 0, False, False
    words: list[str] = []
    evidence, head, comment = 0, False, False
    for _, value in NAMES.findall(attributes):
        for name in value.lower().strip("\"'").split():
            parts = WORD.findall(name)
            words += parts
            head = head or not HEAD_WORDS.isdisjoint(parts)
            aside = ASIDE_WORDS.intersection(parts)
            if aside:
                plain = aside.issuperset(parts) or (aside & PLAIN_WORDS and OTHERWISE.isdisjoint(parts)) or parts[0] in LEADING_WORDS
                comment = comment or (parts[0] in COMMENT_WORDS and COMMENT_WORDS.issuperset(parts))
                evidence = max(evidence, 2 if plain and not aside <= DOUBTFUL_WORDS else 1)
    return ".".join([tag, *words[:4]]), evidence, head, comment


def path_below(above: Element, name: str) -> str:
    """Path of an element of that name; from ``DEEPEST`` on its last level stands for all levels below."""
    import xxhash

    whole = f"{above.path}>{name}"
    if above.depth < DEEPEST:
        return whole
    base = above.path.rpartition(">")[0] if above.depth > DEEPEST else above.path
    return f"{base}>{name}.~{xxhash.xxh3_64_hexdigest(whole.encode('utf-8', 'surrogatepass'))}"


def text_token(path: str, text: str) -> str:
    """Token of a block of text; no name of an element begins like it."""
    import xxhash

    return f"{path}>#{xxhash.xxh3_64_hexdigest(text.encode('utf-8', 'surrogatepass'))}"


class Page:
    """One pass over a page: collects the elements outside inline markup, and blocks of text with their element and
    whether they are links. Nothing but controls is left out before ``weigh`` has seen the whole page."""

    def __init__(self, chosen: frozenset[str] = frozenset()) -> None:
        self.chosen = chosen
        self.stack: list[Element] = [Element("", "", None)]
        self.blocks: list[tuple[str, Element, bool]] = []
        self.parts: list[str] = []
        self.owner = self.stack[0]
        self.opened: list[Element] = []
        self.articles = 0
        # Open elements by tag, those in line by the block they are in too, so that what ends none is not searched.
        self.ends: dict = defaultdict(int)

    def text(self, raw: str) -> None:
        top = self.stack[-1]
        if raw and not top.control:
            if not self.parts:
                self.owner = top
            self.parts.append(raw)

    def end_block(self) -> None:
        if self.parts:
            text = " ".join(unescape("".join(self.parts)).split())
            if text:
                self.blocks.append((text, self.owner.block, self.owner.linked))
            self.parts = []

    def close_to(self, index: int) -> None:
        ended = False
        for e in self.stack[index:]:
            if e.block is e:
                ended = True
                self.ends[e.tag] -= 1
            else:
                self.ends[e.tag, id(e.block)] -= 1
        if ended:
            self.end_block()
        del self.stack[index:]

    @staticmethod
    def end_key(tag: str, block: Element):
        return (tag, id(block)) if tag in INLINE else tag

    def open(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.text(" ")
            return
        block = tag not in INLINE
        if block:
            self.end_block()
            enders = ENDS.get(tag)
            ending = self.ends["p"] or any(self.ends[e] for e in enders or ())
            for i in range(len(self.stack) - 1, 0, -1) if ending else ():
                name = self.stack[i].tag
                if name == "p" or (enders and name in enders):
                    self.close_to(i)
                    if not enders or name in enders:
                        break
                elif name in FENCES and not (enders and tag in ("tr",) and name in ("td", "th")):
                    break
        if tag in VOID:
            return
        above = self.stack[-1]
        if not block:
            element = Element(tag, above.path, above)
            element.block = above.block
            element.linked = above.linked or tag == "a"
        else:
            name, evidence, head, comment = described(tag, attributes)
            path = path_below(above.block, name)
            element = Element(tag, path, above.block)
            element.linked = above.linked
            element.control = above.control or tag in CONTROLS
            inside = above.article or above.main
            comment = comment and tag == "article"
            if tag not in ROOTS or comment:
                element.evidence = 2 if comment or tag in SKIPPED or (not inside and (tag == "header" or head)) else evidence
            if tag == "article" and not above.article and not comment:
                self.articles += 1
                element.article = self.articles
            element.main = above.main or tag == "main"
            element.chosen = above.chosen or path in self.chosen
            self.opened.append(element)
        self.ends[self.end_key(tag, element.block)] += 1
        self.stack.append(element)

    def close(self, tag: str) -> None:
        if self.ends[self.end_key(tag, self.stack[-1].block)]:
            self.close_to(next(i for i in range(len(self.stack) - 1, 0, -1) if self.stack[i].tag == tag))
        elif tag == "p":
            self.end_block()

    def read(self, html: str | None) -> Page:
        html = html or ""
        at, size, last = 0, len(html), html.rfind(">")
        # Up to here quotes say nothing, since the last one of a kind is never closed.
        unclosed = 0
        while at < size:
            found = OPENING.search(html, at)
            start = found.start() if found else size
            unended = found is not None and start > last
            if unended and html.startswith(("<!--", "<![CDATA["), start):
                self.text(html[at:start])
                if html.startswith("<![", start):
                    self.text(html[start + 9 :].replace("&", "&amp;"))
                break
            if not found or unended:
                # Without a ">" there is no further tag, but a comment may still begin.
                end = min((i for i in (html.find("<!--", start), html.find("<![CDATA[", start)) if i >= 0), default=size)
                self.text(html[at:end])
                at = end
                continue
            self.text(html[at:start])
            opening = found.group()
            if opening == "<!--":
                end = html.find("-->", start + 4)
                at = end + 3 if end >= 0 else size
                continue
            if opening == "<![CDATA[":
                end = html.find("]]>", start)
                self.text(html[start + 9 : end if end >= 0 else size].replace("&", "&amp;"))
                at = end + 3 if end >= 0 else size
                continue
            if opening[1] in "!?":
                at = html.find(">", start) + 1
                continue
            whole = TAG.match(html, start) if start >= unclosed else None
            if whole:
                closing, tag, attributes = whole.groups()
                at = whole.end()
            else:
                closing, tag, attributes, at, unclosed = self.unquoted_tag(html, start, unclosed)
            tag = tag.lower()
            if closing:
                self.close(tag)
            elif tag in RAW:
                if not attributes.endswith("/"):
                    found = RAW_ENDS[tag].search(html, at)
                    at = html.find(">", found.end()) + 1 if found else 0
                    at = at or size
            else:
                self.open(tag, attributes)
        self.close_to(1)
        self.end_block()
        return self

    @staticmethod
    def unquoted_tag(html: str, start: int, unclosed: int) -> tuple[bool, str, str, int, int]:
        """A tag with an unclosed quote: it ends at the first ">", and tags before that quote are read likewise."""
        closing = html[start + 1] == "/"
        name = NAME.match(html, start + 1 + closing)
        if start >= unclosed:
            unclosed = ATTRIBUTES.match(html, name.end()).end()
        end = html.find(">", name.end())
        return closing, name.group(), html[name.end() : end], end + 1, unclosed

    def weigh(self, template: frozenset[str] = frozenset()) -> list[bool]:
        """Decides what evidence removes, and tells which blocks are text of the template."""
        root = self.stack[0]
        fixed = [bool(template) and text_token(e.path, text) in template for text, e, _ in self.blocks]
        for (text, e, linked), known in zip(self.blocks, fixed):
            if not known:
                e.varying += 1
                if linked:
                    e.links += len(text)
                else:
                    e.prose += len(text)
        for e in [*self.opened, root]:
            e.clean = e.prose
            e.shaded = e.above is not None and (e.above.shaded or (e.evidence > 1 and e.tag != "form"))
        for e in reversed(self.opened):
            e.above.prose += e.prose
            e.above.links += e.links
            e.above.varying += e.varying
            if e.evidence < 2:
                e.above.clean += e.clean
        for e in self.held_parts():
            while e is not None and not e.held:
                e.held = True
                e = e.above
        for e in self.opened:
            e.skipped = e.above.skipped or (
                not e.held
                and (
                    e.evidence > 1
                    or e.evidence == 1
                    and e.clean <= PROSE_SHARE * root.clean
                    and (e.clean < WEAK_SHARE * root.clean or e.links > e.prose or not e.prose)
                )
            )
            e.cut = e.above.cut or (e if e.skipped else None)
        self.drop_headings()
        return fixed

    def held_parts(self) -> Iterator[Element]:
        """What no evidence removes: the page's article or main part, a form around the page, and where plain evidence
        speaks against all prose, the part of it with most."""
        root = self.stack[0]
        heads = [e for e in self.opened if e.tag == "article" and e.evidence < 2] or [e for e in self.opened if e.tag == "main"]
        best = max((e for e in heads if not e.shaded), key=lambda e: e.clean, default=None)
        if best is not None and best.clean >= SUPPORT * root.clean:
            yield best
        # One article within an aside or the like is the page's own if it is longer than all the rest.
        if len(heads) == 1 and heads[0].shaded and heads[0].clean > root.clean:
            yield heads[0]
        against = [e for e in self.opened if e.evidence > 1]
        if not root.clean:
            largest = max((e for e in [*heads, *against]), key=lambda e: e.clean, default=None)
            if largest is not None and largest.clean:
                yield largest
        titles = [e for e in self.opened if e.tag == "h1"]
        titled = set()
        for e in titles:
            while e is not None and id(e) not in titled:
                titled.add(id(e))
                e = e.above
        for e in against:
            if e.tag == "form" and id(e) in titled and e.clean > root.clean:
                yield e

    def drop_headings(self) -> None:
        """A heading goes too if plain evidence removed all of its section, as with a heading of comments."""
        owners = [e for _, e, _ in self.blocks]
        seen = False
        for i, e in enumerate(owners):
            if e.skipped:
                continue
            if seen and e.tag in HEADINGS and i + 1 < len(owners):
                cut = owners[i + 1].cut
                if cut is not None and cut.evidence > 1 and cut.above is e.above:
                    after = next((o for o in owners[i + 1 :] if not o.skipped), None)
                    if after is None or after.tag in HEADINGS or not below(after, e.above):
                        e.skipped, e.cut = True, e
                        continue
            seen = True

    def layout(self) -> int:
        """Checksum of the outer containers; 0 stands for layouts taken together and is never one."""
        import xxhash

        outer = {e.path for e in self.opened if e.tag in OUTER and e.path.count(">") <= LAYOUT_LEVELS}
        return (xxhash.xxh3_64_intdigest("\n".join(sorted(outer)).encode("utf-8", "surrogatepass")) >> 1) or 1


def below(element: Element | None, above: Element) -> bool:
    while element is not None and element is not above:
        element = element.above
    return element is above


def main_text(html: str | None, chosen: frozenset[str] = frozenset(), template: frozenset[str] = frozenset()) -> str:
    """Text of the main slots of a page; where it has none of them, of its longest article, main part or body.

    Text of the template goes, but a slot's own headings and paragraphs stay even if every page has them.
    """
    page = Page(chosen).read(html)
    fixed = page.weigh(template)
    blocks = [(text, e, known) for (text, e, _), known in zip(page.blocks, fixed) if not e.skipped]
    for test in (lambda e: e.chosen, None, lambda e: e.main):
        if test is None:
            sizes: dict[int, int] = defaultdict(int)
            for text, e, _ in blocks:
                sizes[e.article] += len(text)
            sizes.pop(0, None)
            best = max(sizes, key=lambda a: (sizes[a], -a), default=0)
            if not best:
                continue
            test = lambda e, best=best: e.article == best
        found = [(text, e, known) for text, e, known in blocks if test(e)]
        if found:
            return "\n".join(text for text, e, known in found if not known or not fixed_part(e, test))
    left = [text for text, _, known in blocks if not known]
    return "\n".join(left or [text for text, _, _ in blocks])


def fixed_part(element: Element, inside) -> bool:
    """Whether an element lies in a container strictly within a slot that has nothing but text of the template."""
    while element.above is not None and inside(element.above) and not element.varying:
        if element.tag in PARTS:
            return True
        element = element.above
    return False


def page_tokens(html: str | None) -> tuple[int, dict[str, list[int]]]:
    """Layout of a page, and occurrences of each structural and text token with the unlinked and linked text below it
    outside skipped parts."""
    page = Page().read(html)
    page.weigh()
    counts: dict[str, list[int]] = {}
    for e in page.opened:
        counts.setdefault(e.path, [0, 0, 0])[0] += 1
    for text, owner, linked in page.blocks:
        token = text_token(owner.path, text)
        counts.setdefault(token, [0, 0, 0])[0] += 1
        if owner.skipped:
            continue
        while token:
            if token in counts:
                counts[token][2 if linked else 1] += len(text)
            token = token.rpartition(">")[0]
    return page.layout(), counts


def host_of(url: Column) -> Column:
    """Lower-case host of an address, empty where there is none."""
    found = F.regexp_extract(F.lower(url.cast("string")), r"^[a-z][a-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)
    return F.coalesce(found, F.lit(""))


def token_summaries(pages: DataFrame) -> DataFrame:
    """Per host, layout and token: pages that have it, occurrences, checksum of its occurrence vector and text below it."""
    schema = to_arrow_schema(_parse_datatype_string(SUMMARY))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in text_batches(batches):
            sums: dict[tuple[str, int, str], list[int]] = {}
            for page_id, host, html in zip(*(c.to_pylist() for c in batch.columns)):
                layout, tokens = page_tokens(html)
                if page_id is None:
                    page_id = xxhash.xxh3_64_intdigest((html or "").encode())
                for token, (count, prose, linked) in [("", (1, 0, 0)), *tokens.items()]:
                    place = xxhash.xxh3_64_intdigest(f"{page_id}:{count}") >> 1
                    row = sums.setdefault((host, layout, token), [0, 0, 0, 0, 0])
                    row[0] += 1
                    row[1] += count
                    row[2] ^= place
                    row[3] += prose
                    row[4] += linked
            columns = [*zip(*sums)] + [*zip(*sums.values())]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    found = pages.select("page_id", "host", "html").mapInArrow(run, SUMMARY)
    return summed(found)


def summed(tokens: DataFrame) -> DataFrame:
    return tokens.groupBy("host", "layout", "token").agg(
        F.sum("pages").alias("pages"),
        F.sum("total").alias("total"),
        F.bit_xor("vector").alias("vector"),
        F.sum("prose").alias("prose"),
        F.sum("linked").alias("linked"),
    )


def nested_template(tokens: pd.DataFrame) -> pd.DataFrame:
    """Classes, nesting and roles of one layout's frequent tokens.

    A class is valid if each two of its tokens nest or stand side by side under a token of the template; paths guarantee
    that as soon as every token's parent is in the template too, so tokens with a missing parent are left out.
    """
    rows = tokens.sort_values("token")
    present = set(rows["token"])
    rows = rows[[t.rpartition(">")[0] in present or t.count(">") == 1 for t in rows["token"]]].copy()
    names = {v: i for i, v in enumerate(dict.fromkeys(zip(rows["pages"], rows["vector"])))}
    rows["class_id"] = [names[v] for v in zip(rows["pages"], rows["vector"])]
    classes = dict(zip(rows["token"], rows["class_id"]))
    # Text of the template: it is in the class of an element around it, so it stands wherever that does.
    fixed = set()
    for token, pages in zip(rows["token"], rows["pages"]):
        above = token.rpartition(">")[0]
        if pages >= LEAST_PAGES and token.startswith("#", len(above) + 1):
            outer = above
            while outer and classes.get(outer) != classes[token]:
                outer = outer.rpartition(">")[0]
            if outer:
                fixed.add(token)
    structure = rows[[not t.rpartition(">")[2].startswith("#") for t in rows["token"]]]
    varying = dict(zip(structure["token"], structure["prose"] - structure["linked"]))
    constant: dict[str, int] = defaultdict(int)
    for token, prose in zip(rows["token"], rows["prose"]):
        if token in fixed:
            above = token.rpartition(">")[0]
            while above:
                constant[above] += prose
                above = above.rpartition(">")[0]
    left = {t: v - constant[t] for t, v in varying.items()}
    whole = sum(v for t, v in left.items() if t.count(">") == 1)
    if whole <= 0:
        # Copies of one page: nothing tells its template from its text.
        fixed, left = set(), varying
        whole = sum(v for t, v in left.items() if t.count(">") == 1)
    once = structure[structure["total"] == structure["pages"]]
    tags = {t: t.rpartition(">")[2].split(".")[0] for t in once["token"]}
    articles = [t for t in once["token"] if tags[t] == "article"] or [t for t in once["token"] if tags[t] == "main"]
    chosen = {t for t in articles if not any(t.startswith(f"{o}>") for o in articles)}
    if sum(left[t] for t in chosen) < SUPPORT * whole:
        chosen = set()
    if not chosen and len(once):
        # The deepest slot on the way to most of the prose that varies.
        prose = {t: left[t] for t in once["token"]}
        token = max((t for t in prose if t.count(">") == 1), key=lambda t: prose[t], default=None)
        below: dict[str, list[str]] = defaultdict(list)
        for t in prose:
            below[t.rpartition(">")[0]].append(t)
        while token is not None:
            best = max(below[token], key=lambda t: prose[t], default=None)
            if best is None or prose[best] <= PROSE_SHARE * prose[token] or tags[best] in ("p", "h1", "h2", "h3", "ul", "ol"):
                break
            token = best
        if token is not None and tags[token] not in ("html", "body"):
            chosen = {token}
    rows["main"] = rows["token"].isin(chosen)
    rows["fixed"] = rows["token"].isin(fixed)
    return rows[["host", "layout", "token", "class_id", "pages", "total", "prose", "linked", "main", "fixed"]]


def deduce_templates(pages: DataFrame, support: float = SUPPORT) -> DataFrame:
    """The template of every layout of every host: its tokens with their class, counts, whether they open a main slot, and
    whether they are text of the template. Layout 0 stands for all of a host's layouts of very few pages.

    ``pages`` has page_id, host and html.
    """
    found = stored(token_summaries(pages), "tokens")
    layouts = found.filter("token = ''").select("host", "layout", F.col("pages").alias("_pages"))
    kept = layouts.filter(F.col("_pages") >= LEAST_PAGES).select("host", "layout", F.lit(True).alias("_kept"))
    merged = found.join(kept, ["host", "layout"], "left").withColumn("layout", F.when(F.col("_kept"), F.col("layout")).otherwise(0))
    found = stored(summed(merged), "layouts")
    layouts = found.filter("token = ''").select("host", "layout", F.col("pages").alias("_pages"))
    # What is left per layout is bounded by the size of a page: each token is on a fifth of the pages at least.
    frequent = found.filter("token <> ''").join(layouts, ["host", "layout"]).filter(F.col("pages") >= support * F.col("_pages"))
    schema = (
        "host string, layout bigint, token string, class_id int, pages bigint, total bigint, prose bigint, linked bigint, "
        "main boolean, fixed boolean"
    )
    return frequent.drop("_pages").groupBy("host", "layout").applyInPandas(nested_template, schema)


def with_layouts(rows: DataFrame) -> DataFrame:
    """Rows of page_id, url, html and host with the layout of their page."""
    result = "page_id bigint, url string, html string, host string, layout bigint"
    schema = to_arrow_schema(_parse_datatype_string(result))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            layouts = pa.array([Page().read(h).layout() for h in batch.column(2).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, layouts], schema=schema)

    return rows.select("page_id", "url", "html", "host").mapInArrow(run, result)


def extract_main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: its main text, blocks in page order joined by line ends, and the text's code points.

    Character references are decoded and white space within a block becomes one space. A NULL or empty page has empty
    text. NULL addresses form one host without a name; ids may be NULL or repeat. Other columns are not read.
    """
    rows = pages.select(
        F.col(page_id).cast("bigint").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.col(html).cast("string").alias("html"),
        host_of(F.col(url)).alias("host"),
    )
    templates = stored(deduce_templates(rows.select("page_id", "host", "html")), "templates")
    used = templates.filter("main or fixed").groupBy("host", "layout")
    slots = used.agg(F.concat_ws("\n", F.sort_array(F.collect_set("token"))).alias("slots"))
    size = slots.agg(F.sum(F.octet_length("slots") + F.octet_length("host") + 64).alias("bytes")).first()["bytes"] or 0
    # A layout of its own pages has a row even if nothing is chosen or fixed in it.
    own = templates.filter("layout <> 0").select("host", "layout").distinct().join(slots, ["host", "layout"], "left")
    own = own.withColumn("slots", F.coalesce("slots", F.lit("")))
    rest = slots.filter("layout = 0").select("host", F.col("slots").alias("_rest"))
    if size <= BROADCAST_BYTES:
        own, rest = F.broadcast(own), F.broadcast(rest)
    placed = with_layouts(rows).join(own, ["host", "layout"], "left").join(rest, "host", "left")
    placed = placed.withColumn("slots", F.coalesce("slots", "_rest"))
    schema = to_arrow_schema(_parse_datatype_string("page_id bigint, url string, text string, n_chars bigint"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = (frozenset(), frozenset())
        known: dict[str | None, tuple[frozenset[str], frozenset[str]]] = {None: nothing}
        for batch in text_batches(batches):
            texts = []
            for html, slots in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if slots not in known:
                    known = {None: nothing} if len(known) > 10_000 else known
                    tokens = slots.split("\n")
                    texts_of = {t for t in tokens if t.rpartition(">")[2].startswith("#")}
                    known[slots] = frozenset(tokens) - texts_of, frozenset(texts_of)
                texts.append(main_text(html, *known[slots]))
            columns = [*batch.columns[:2], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return placed.select("page_id", "url", "html", "slots").mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")


def op10_template_slots(spark, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))
