"""Main-text extraction by wrappers inferred from the pages of a host.

Every page becomes a token stream of block tags and text, well nested however
broken its markup is.  Streams of one host are aligned one after another into
a union-free regular expression: tags that match stay, text becomes a slot,
what only some pages have becomes an optional group, and what follows itself
becomes a repeated group.  The wrapper's slots are then judged once per host
(article or furniture, fixed or changing text), apart for pages with an
article element, with a main element and with neither, and every page is read
through the slots of its host and kind.
"""

from __future__ import annotations

import html as entities
import json
import re
from difflib import SequenceMatcher

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.common import quoted
from fieldbook.session import materialize

RAW = frozenset("script style textarea title iframe noscript".split())
#: a tag without '<' or '>' in its quoted values; any other is found by ``_Scanner.tag_end``
PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^\"'<>]|\"[^\"<>]*+\"|'[^'<>]*+')*+)>")
TAG_NAME = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)")
TAG_STOP = re.compile(r"[>\"']")
RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in RAW}
ATTR = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
SPACE = re.compile(r"\s+")
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data dfn del em font i img input ins kbd label mark meter nobr "
    "output picture progress q rp rt ruby s samp small source span strike strong sub sup time track tt u var wbr "
    "td th link meta base embed param area col colgroup "
    "object canvas audio video svg g defs symbol use path rect circle ellipse line polyline polygon text tspan textpath desc "
    "lineargradient radialgradient stop clippath mask pattern image "
    "math semantics annotation mrow mi mn mo ms mtext mspace msup msub msubsup mfrac msqrt mroot mover munder munderover "
    "mmultiscripts mprescripts mtable mtr mtd mstyle mpadded mphantom menclose merror".split())
SPACED = frozenset("br td th img input text mtd object canvas audio video".split())  # inline, but a word ends there
#: form controls and inert markup: gone with all they hold once their end tag comes; without one they lose nothing
DROPPED = frozenset(["button", "select", "datalist", "template"])
VOID = frozenset(["hr"])
#: what an opening tag closes, besides an open p
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "option": ("option",), "p": ()}
FURNITURE_TAGS = frozenset("nav footer aside form menu dialog fieldset head".split())
FURNITURE = re.compile(
    r"(?:^|[^a-z])(?:ads?|adverts?|advertis\w*|adsense|banners?|cookies?|consent|comments?|commentlist|respond|replies|"
    r"disqus|share|sharing|social|sidebars?|widgets?|menus?|nav|navbar|navigation|breadcrumbs?|footer|notices?|alerts?|"
    r"promos?|promotions?|sponsor\w*|related|recommend\w*|newsletter|subscribe|popup|modal|pager|pagination|login|"
    r"signup|search|disclaimer|copyright|complementary|contentinfo)(?:[^a-z]|$)")
LAYOUT = re.compile(r"(?<![^.\s])(?:has|with|without|no)[-_][^.\s]*")  # says what else is on the page
#: furniture that never is taken for the article, however much text it holds
READERS = re.compile(r"(?:^|[^a-z])(?:comments?|commentlist|respond|replies|disqus)(?:[^a-z]|$)")
NEVER = frozenset("nav footer aside menu dialog head".split())
LIFT = 0.9  # share of a page's text outside furniture that lifts a furniture mark
NESTED = 9  # weight of the furniture elements around an article element
HEADER = re.compile(r"(?:^|[^a-z])(?:header|masthead|topbar|site-title)(?:[^a-z]|$)")
TAGS = frozenset(
    "html head body article section nav aside header footer main address hgroup h1 h2 h3 h4 h5 h6 p pre blockquote ol ul menu "
    "li dl dt dd figure figcaption div table caption tbody thead tfoot tr form fieldset legend details summary dialog center "
    "search optgroup option frameset frame noframes listing xmp plaintext dir marquee applet".split())
SHARE, LEAST = 0.05, 3  # a label is told from its plain form if this share of a host's pages, and so many, have it
WIDE = 64  # siblings in a wrapper before their order is given up
DEPTH = 150  # deeper elements lose their tags, not their text
FAN = 48  # wrappers merged in one call
PERIOD = 4  # longest repeated group of siblings that is looked for


def _label(tag: str, attrs: str) -> str:
    marks = []
    for m in ATTR.finditer(attrs):
        value = (m[2] or m[3] or m[4] or "").lower().replace("/", "-")  # '/' parts the labels of a path
        marks += sorted(re.sub(r"\d+", "0", w) for w in value.split())
    return tag + "".join("." + w for w in dict.fromkeys(marks))


def _plain(label: str) -> str:
    """The label with no more than what the tests for furniture and main elements see in it: one of a few hundred."""
    tag, _, marks = label.partition(".")
    if tag in ("html", "body"):  # never furniture, so no mark of theirs is looked at
        return tag
    words = marks.split(".")
    marks = LAYOUT.sub("", marks)
    return ((tag if tag in TAGS else "custom")
            + (".comments" if READERS.search(marks) else ".ads" if FURNITURE.search(marks) else "")
            + (".header" if HEADER.search(marks) else "") + (".main" if "main" in words or "articlebody" in words else ""))


class _Scanner:
    """Tags and texts of a page, in time linear in its length however broken its quotes are.

    A tag ends at the first '>' outside quoted values; a '<' whose tag never ends is text.  A failed search is
    remembered by the quotes it opened: a later one that comes to open one of them fails as well.
    """

    def __init__(self, html: str):
        self.html = html
        self.last = html.rfind(">")
        self.dead: set[int] = set()  # quotes that lead to no end
        self.lone = {'"': len(html), "'": len(html)}  # from here on no such quote is closed
        self.known = (0, -1)  # from .. to: the next stop after any place in between is at its end

    def _stop(self, at: int) -> int:
        if not self.known[0] <= at <= self.known[1]:
            m = TAG_STOP.search(self.html, at)
            self.known = (at, m.start() if m else len(self.html))
        return self.known[1]

    def tag_end(self, at: int) -> int:
        """Place of the '>' that ends a tag whose name ends at ``at``; -1 if there is none."""
        opened = []
        while at <= self.last:
            at = self._stop(at)
            if at > self.last or at in self.dead:
                break
            quote = self.html[at]
            if quote == ">":
                return at
            opened.append(at)
            end = self.html.find(quote, at + 1) if at < self.lone[quote] else -1
            if end < 0:
                self.lone[quote] = min(self.lone[quote], at)
                break
            at = end + 1
        self.dead.update(opened)
        return -1

    def __iter__(self):
        """(close, tag, attrs) of tags and (None, None, text) of texts; comments and raw elements are left out."""
        html, at, n = self.html, 0, len(self.html)
        while at < n:
            if html[at] != "<":
                end = html.find("<", at)
                end = n if end < 0 else end
                yield None, None, html[at:end]
                at = end
                continue
            m = PLAIN_TAG.match(html, at)
            if m:
                close, tag, attrs, after = m[1], m[2].lower(), m[3], m.end()
            else:
                if html.startswith("<!--", at):
                    end = html.find("-->", at + 4)
                    at = n if end < 0 else end + 3
                    continue
                if html[at:at + 9].upper() == "<![CDATA[":
                    end = html.find("]]>", at + 9)
                    at = n if end < 0 else end + 3
                    continue
                m = TAG_NAME.match(html, at)
                end = self.tag_end(m.end()) if m else -1
                raw = bool(m) and not m[1] and m[2].lower() in RAW
                if end < 0 and at < self.last and (raw or html[at + 1:at + 2] in ("!", "?", "/")):
                    end = html.find(">", at)  # such markup ends at the next '>', whatever its quotes
                    if not raw:
                        at = end + 1
                        continue
                elif end < 0:
                    yield None, None, "<"
                    at += 1
                    continue
                close, tag, attrs, after = m[1], m[2].lower(), html[m.end():end], end + 1
            at = after
            if tag in RAW and not close:
                if not _self_closed(attrs):
                    end = RAW_END[tag].search(html, at, self.last + 1)
                    at = end.end() if end else n
                continue
            yield close, tag, attrs


def page_labels(html: str) -> set[str]:
    """Labels of the page's block tags that say more than their plain form."""
    found = set()
    for close, tag, attrs in _Scanner(html):
        if tag and not close and tag not in INLINE and (tag not in TAGS or ATTR.search(attrs)):
            label = _label(tag, attrs)
            if label != _plain(label):
                found.add(label)
    return found


def _self_closed(attrs: str) -> bool:
    """The attributes end in a '/' that is not part of an unquoted value."""
    if not attrs.endswith("/"):
        return False
    cut = max(attrs.rfind(c) for c in " \t\n\r\f\v\"'") + 1
    return "=" not in attrs[cut:] and not attrs[:cut].rstrip().endswith("=")


def parse(html: str, known: frozenset | None = None) -> list:
    """The page as nested [label, children] with ['#', text] for the text of a block.

    Labels that are not among the ``known`` ones (None: all are) become plain.
    """
    short: dict[str, str] = {}
    root: list = ["", []]
    stack, flat, text = [root], [], []
    dropped: list = []  # open elements of DROPPED: tag, and what stood before it

    def flush():
        if text:
            block = SPACE.sub(" ", entities.unescape("".join(text))).strip()
            text.clear()
            if block:
                stack[-1][1].append(["#", block])

    def pop_to(depth: int):
        flush()
        del stack[depth:]

    def block(nodes: list):
        """The innermost open element that a block inside it does not close, and its depth."""
        return next((d, n) for d, n in zip(range(len(nodes) - 1, -1, -1), reversed(nodes)) if d == 0 or n[2] != "p")

    for closing, tag, attrs in _Scanner(html):
        if tag is None:
            text.append(attrs)
            continue
        if tag in INLINE:
            if tag in SPACED:
                text.append(" ")
            continue
        if tag in DROPPED:
            text.append(" ")
            same = next((k for k in range(len(dropped) - 1, -1, -1) if dropped[k][0] == tag), None)
            if not closing:
                if same is not None and tag != "template":  # they do not nest: the first one has no end tag
                    del dropped[same:]
                if not _self_closed(attrs):
                    dropped.append((tag, list(stack), [len(n[1]) for n in stack], list(text), list(flat)))
            elif same is not None:
                _, nodes, sizes, before, deep = dropped[same]
                del dropped[same:]
                d, home = block(nodes)
                if d < len(stack) and stack[d] is home:  # what held the element is still open
                    for n, size in zip(nodes, sizes):
                        del n[1][size:]
                    stack[:], text[:], flat[:] = nodes, before, deep
            continue
        if closing:
            flush()
            if flat and flat[-1] == tag:
                flat.pop()
                continue
            for d in range(len(stack) - 1, 0, -1):
                if stack[d][2] == tag:
                    pop_to(d)
                    flat.clear()
                    break
            continue
        flush()
        if tag in VOID:
            continue
        if stack[-1][0] and stack[-1][2] == "p":
            pop_to(len(stack) - 1)
        for d in range(len(stack) - 1, 0, -1):
            if stack[d][2] in CLOSES.get(tag, ()):
                pop_to(d)
                break
            if stack[d][2] in ("ul", "ol", "dl", "table", "div", "section", "article"):
                break
        if len(stack) > DEPTH:
            flat.append(tag)
            continue
        label = _label(tag, attrs)
        if known is not None and label not in known:
            if label not in short:
                short[label] = _plain(label)
            label = short[label]
        node = [label, [], tag]
        stack[-1][1].append(node)
        stack.append(node)
    flush()
    return root[1]


# A wrapper node is [label, flags, children]: flags 1 optional, 2 repeated; the
# label '#' is a text slot (flag 4: its text belongs to the article), and '()'
# is a group of siblings.  A repeated group with flag 8 has each of its names
# once, in any order: (a? b? c?)* for siblings too many to keep in order.

def _name(node: list) -> str:
    return node[0] if node[0] != "()" else "(" + " ".join(map(_name, node[2])) + ")"


def _any_order(nodes: list) -> list:
    """Siblings as one repeated group that has each of their names once."""
    once: dict[str, list] = {}

    def add(items: list):
        for n in items:
            if n[0] == "()":
                add(n[2])
            else:
                once[n[0]] = merge(once[n[0]], n) if n[0] in once else n

    add(nodes)
    return [["()", 2 | 8, [[once[k][0], once[k][1] | 1, once[k][2]] for k in sorted(once)]]]


def fold(nodes: list) -> list:
    """Siblings with every run that follows itself (one to four nodes long) as a repeated group.

    More than ``WIDE`` siblings, or such among which some have no order already, become one group without order, so
    siblings never are more than the host has labels.
    """
    nodes = _runs(nodes)
    return _any_order(nodes) if len(nodes) > WIDE or any(n[1] & 8 for n in nodes if n[0] == "()") else nodes


def _runs(nodes: list) -> list:
    for period in range(1, PERIOD + 1):
        names = [_name(n) for n in nodes]
        out, i = [], 0
        while i < len(nodes):
            j = i + period
            while names[i:i + period] == names[j:j + period] and len(names[i:i + period]) == period:
                j += period
            if j == i + period:
                out.append(nodes[i])
                i += 1
                continue
            whole = nodes[i:i + period]
            for a in range(i + period, j, period):
                whole = [merge(x, y) for x, y in zip(whole, nodes[a:a + period])]
            node = whole[0] if period == 1 else ["()", 0, whole]
            out.append([node[0], node[1] | 2, node[2]])
            i = j
        nodes = out
    return nodes


def merge(a: list, b: list) -> list:
    """One wrapper node for two of the same name."""
    return [a[0], a[1] | b[1], align(a[2], b[2])]


def align(a: list, b: list) -> list:
    """Align two sibling lists: matches merge, mismatches become optional groups."""
    if a == b:
        return a
    names_a, names_b = [_name(x) for x in a], [_name(x) for x in b]
    out = []
    for kind, i, j, k, m in SequenceMatcher(None, names_a, names_b, autojunk=False).get_opcodes():
        if kind == "equal":
            out += [merge(x, y) for x, y in zip(a[i:j], b[k:m])]
        else:
            out += [[x[0], x[1] | 1, x[2]] for x in a[i:j] + b[k:m]]
    return fold(out)


def to_wrapper(nodes: list) -> list:
    """The wrapper of one page: text as slots, empty elements left out, repeats folded."""
    out = []
    for n in nodes:
        if n[0] == "#":
            out.append(["#", 0, []])
        else:
            inner = to_wrapper(n[1])
            if inner:
                out.append([n[0], 0, inner])
    return fold(out)


def slot_texts(nodes: list, path: str = "", found: dict | None = None) -> dict:
    """path of each text slot -> its texts, in page order."""
    found = {} if found is None else found
    for n in nodes:
        if n[0] == "#":
            found.setdefault(path, []).append(n[1])
        else:
            slot_texts(n[1], path + "/" + n[0], found)
    return found


_JUDGED: dict = {}  # travels with the function to each task


def _furniture(label: str, inside: bool) -> bool:
    key = (label, inside)
    if key not in _JUDGED:
        if len(_JUDGED) > 1 << 14:
            _JUDGED.clear()
        _JUDGED[key] = _tells_furniture(label, inside)
    return _JUDGED[key]


def _tells_furniture(label: str, inside: bool) -> bool:
    tag, _, marks = label.partition(".")
    marks = LAYOUT.sub("", marks)
    if tag in FURNITURE_TAGS or FURNITURE.search(marks):
        return True
    return not inside and (tag == "header" or bool(HEADER.search(marks)))


def _is_main(label: str) -> bool:
    tag, _, marks = label.partition(".")
    return tag in ("article", "main") or "main" in marks.split(".") or "articlebody" in marks.split(".")


def _is_article(label: str) -> bool:
    return label.partition(".")[0] == "article"


#: what the article may stand in, best first
KINDS = {"article": _is_article, "main": _is_main}


def _inner(node: list) -> list:
    """Children of a node of a page or of a wrapper."""
    return [] if node[0] == "#" else node[1] if isinstance(node[1], list) else node[2]


def _named_so(label: str) -> bool:
    """Furniture by more than a word that may be said of the article's surroundings."""
    tag, _, marks = label.partition(".")
    return tag in NEVER or bool(READERS.search(LAYOUT.sub("", marks)))


def _weight(label: str, inside: bool) -> int:
    return 0 if not _furniture(label, inside) else 4 if _named_so(label) else 1


def _tops(nodes: list, test, depth: int):
    """Top-most elements that pass the test and stand in furniture elements (or are such) that weigh ``depth``, with
    their paths.  A div around an element that passes is layout, whatever it is called."""
    stack = [(n, "", 0) for n in reversed(nodes)]
    while stack:
        n, path, level = stack.pop()
        if n[0] == "()":
            stack += [(c, path, level) for c in reversed(n[2])]
        elif n[0] != "#":
            path += "/" + n[0]
            hit = test(n[0])
            if hit:
                level += _weight(n[0], True)
            elif not n[0].startswith(("html", "body", "div")):
                level += _weight(n[0], False)
            if hit and level == depth:
                yield n, path
            elif level <= depth:
                stack += [(c, path, level) for c in reversed(_inner(n))]


def _skipped(label: str, path: str, lifted: str, inside: bool) -> bool:
    """Furniture, but for html, body and what leads to the lifted path."""
    return (_furniture(label, inside) and not label.startswith(("html", "body"))
            and not (lifted + "/").startswith(path + "/"))


def loose_texts(nodes: list, lifted: str = "", path: str = "", inside: bool = False) -> list[str]:
    """Texts of a page, or of elements of a page, that do not stand in furniture."""
    out = []
    for n in nodes:
        if n[0] == "#":
            out.append(n[1])
        elif not _skipped(n[0], path + "/" + n[0], lifted, inside):
            out += loose_texts(n[1], lifted, path + "/" + n[0], inside)
    return out


def _size(nodes: list, inside: bool) -> int:
    return sum(map(len, loose_texts(nodes, inside=inside)))


def _furniture_texts(nodes: list, path: str = ""):
    """(text outside further furniture, path) of a page's furniture elements that could be misnamed."""
    for n in nodes:
        if n[0] != "#" and not _named_so(n[0]):
            here = path + "/" + n[0]
            if _skipped(n[0], here, "", False):
                yield _size(n[1], True), here
            yield from _furniture_texts(n[1], here)


def kind_of(nodes: list) -> str:
    """What a page's article stands in.

    The first of ``KINDS`` that gives text, with the weight of the furniture
    elements around it; such are looked through only if there is more text
    than outside all furniture.  Where none does, '' or, if nearly all text
    stands in an element that is furniture by its name, the path of that.
    """
    def any_main(nodes: list) -> bool:
        return any(n[0] != "#" and (_is_main(n[0]) or any_main(n[1])) for n in nodes)

    loose = None
    if any_main(nodes):
        for depth in range(NESTED):
            for kind, test in KINDS.items():
                size = sum(_size(n[1], True) for n, _ in _tops(nodes, test, depth))
                if size and depth:
                    loose = _size(nodes, False) if loose is None else loose
                if size and (not depth or size > loose):
                    return f"{kind}{depth}"
    loose = _size(nodes, False) if loose is None else loose
    size, path = max(_furniture_texts(nodes), default=(0, ""), key=lambda x: x[0])
    return path if size and size >= LIFT * (size + loose) else ""


def judge(wrapper: list, stats: dict, kind: str) -> list:
    """Mark the slots of a wrapper that hold article text.

    The wrapper is that of the host's pages of one ``kind`` (see ``kind_of``);
    ``stats``: path -> (pages, fixed, chars) are over these pages, counting
    pages with the same text outside furniture once.  The
    article is what stands in article elements, else in main elements.  For
    pages that have neither (their kind is '' or the path of an element that
    is no furniture despite its name), text that is the same on all of three
    or more pages is furniture too as long as other text does change, and the article is the deepest element
    with blocks of its own that holds all other text outside furniture.  A
    header is furniture outside the article, which is told by its standing
    in the body itself or by its name.
    """
    def is_fixed(path: str) -> bool:
        pages, fixed, _ = stats.get(path, (0, False, 0))
        return fixed and pages >= 3

    def mark(node: list, path: str, fixed_out: bool):
        for c in node[2]:
            if c[0] == "()":
                mark(c, path, fixed_out)
            elif c[0] == "#":
                if not (fixed_out and is_fixed(path)):
                    c[1] |= 4
            elif not _skipped(c[0], path + "/" + c[0], lifted, True):
                mark(c, path + "/" + c[0], fixed_out)

    lifted = kind if kind.startswith("/") else ""
    if kind and not lifted:
        for n, path in _tops(wrapper, KINDS[kind[:-1]], int(kind[-1])):
            mark(n, path, False)
        return wrapper

    def skipped(label: str, path: str) -> bool:
        title = label.startswith("header") and path.count("/") > 1 and "/body" in path and not path.endswith("body/" + label)
        return _skipped(label, path, lifted, title and not HEADER.search(label.partition(".")[2]))

    def changing(node: list, path: str, fixed_out: bool) -> int:
        total = 0
        for c in node[2]:
            if c[0] == "()":
                total += changing(c, path, fixed_out)
            elif c[0] == "#":
                total += 0 if fixed_out and is_fixed(path) else stats.get(path, (0, False, 0))[2]
            elif not skipped(c[0], path + "/" + c[0]):
                total += changing(c, path + "/" + c[0], fixed_out)
        return total

    here, path = ["", 0, wrapper], ""
    varied = changing(here, path, True) > 0
    while True:
        inner = [c for n in here[2] for c in (n[2] if n[0] == "()" else [n]) if c[0] != "#"
                 and not skipped(c[0], path + "/" + c[0])]
        step = next((c for c in inner if not c[1] & 2 and any(x[0] != "#" for x in c[2])
                     and changing(c, path + "/" + c[0], varied) == changing(here, path, varied) > 0), None)
        if step is None:
            break
        here, path = step, path + "/" + step[0]
    mark(here, path, varied)
    return wrapper


def marked_paths(wrapper: list, path: str = "") -> set[str]:
    """Paths of the wrapper's slots that hold article text."""
    out = set()
    for n in wrapper:
        if n[0] == "#":
            if n[1] & 4:
                out.add(path)
        else:
            out |= marked_paths(n[2], path if n[0] == "()" else path + "/" + n[0])
    return out


def extract(nodes: list, paths: frozenset | set, path: str = "") -> list[str]:
    """Texts of the page's article slots, in page order."""
    out = []
    for n in nodes:
        if n[0] != "#":
            out += extract(n[1], paths, path + "/" + n[0])
        elif path in paths:
            out.append(n[1])
    return out


class _Known:
    """Parsed JSON of a column whose values repeat from row to row."""

    def __init__(self, read):
        self.read, self.held = read, {}

    def __call__(self, text: str | None):
        if text not in self.held:
            if len(self.held) > 2000:
                self.held.clear()
            self.held[text] = self.read(json.loads(text) if text else [])
        return self.held[text]


def _label_rows(batches):
    for batch in batches:
        host, label = [], []
        for h, html in zip(batch.column(0).to_pylist(), batch.column(1)):
            for one in page_labels(html.as_py() or ""):
                host.append(h)
                label.append(one)
        yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(label, pa.string())], names=["host", "label"])


def _skeletons(batches):
    known = _Known(frozenset)
    for batch in batches:
        host, kind, page, skel, paths, hashes, chars = [], [], [], [], [], [], []
        for h, html, labels in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
            tree = parse(html.as_py() or "", known(labels))
            found = slot_texts(tree)
            host.append(h)
            kind.append(kind_of(tree))
            page.append(xxhash.xxh3_128_digest("\n".join(loose_texts(tree, kind[-1]))))
            skel.append(json.dumps(to_wrapper(tree), separators=(",", ":"), ensure_ascii=False))
            paths.append(list(found))
            hashes.append([xxhash.xxh3_64_intdigest("\n".join(t)) - (1 << 63) for t in found.values()])
            chars.append([sum(map(len, t)) for t in found.values()])
        yield pa.RecordBatch.from_arrays(
            [pa.array(host, pa.string()), pa.array(kind, pa.string()), pa.array(page, pa.binary()),
             pa.array(skel, pa.string()), pa.array(paths, pa.list_(pa.string())),
             pa.array(hashes, pa.list_(pa.int64())), pa.array(chars, pa.list_(pa.int64()))],
            names=["host", "kind", "page", "wrapper", "paths", "hashes", "chars"])


def _merged(pdf: pd.DataFrame) -> pd.DataFrame:
    out = None
    for text in sorted(pdf["wrapper"], key=lambda t: (len(t), t)):
        one = json.loads(text)
        out = one if out is None else align(out, one)
    return pd.DataFrame({"host": [pdf["host"].iloc[0]], "kind": [pdf["kind"].iloc[0]],
                         "wrapper": [json.dumps(out, separators=(",", ":"), ensure_ascii=False)]})


def _judged(wrappers: pd.DataFrame, stats: pd.DataFrame) -> pd.DataFrame:
    if wrappers.empty:
        return pd.DataFrame({"host": [], "kind": [], "paths": []})
    known = {p: (n, a == b, c) for p, n, a, b, c in zip(
        stats["path"], stats["pages"], stats["low"], stats["high"], stats["chars"])}
    kind = wrappers["kind"].iloc[0]
    out = judge(json.loads(wrappers["wrapper"].iloc[0]), known, kind)
    return pd.DataFrame({"host": [wrappers["host"].iloc[0]], "kind": [kind],
                         "paths": [json.dumps(sorted(marked_paths(out)), separators=(",", ":"), ensure_ascii=False)]})


def host_of(url: Column) -> Column:
    """Lower-case host of a URL without user and port; '' where there is none."""
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))


def common_labels(pages: DataFrame) -> DataFrame:
    """(host, labels) of ``pages(host, html)``: the labels that are on ``SHARE`` of the host's pages, as JSON.

    Whatever differs from page to page (ids of headings, slugs, hashed classes) stays out, so a host has at most
    1 / ``SHARE`` times as many labels as one of its pages has on average.
    """
    counts = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    seen = pages.mapInArrow(_label_rows, "host string, label string").groupBy("host", "label").agg(F.count(F.lit(1)).alias("k"))
    return (seen.filter(F.col("k") >= LEAST).join(counts, "host").filter(F.col("k") >= F.col("pages") * SHARE)
            .groupBy("host").agg(F.to_json(F.array_sort(F.collect_list("label"))).alias("labels")))


def infer_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, labels, paths) inferred from all pages: the labels the host's pages are parsed with, the article's slots.

    Pages of a host that differ in what their article stands in (``kind_of``) have a wrapper each.

    Equal page wrappers are counted once; the distinct ones of a host are
    merged in groups of ``FAN``, and the results merged again until one is
    left, so no call ever gets more than about ``FAN`` wrappers, however
    large the host.  Few labels and siblings without order beyond ``WIDE``
    keep the wrappers themselves, and the paths, from growing with the pages.
    """
    htmls = pages.select(host_of(quoted(url_col).cast("string")).alias("host"),
                         quoted(html_col).cast("string").alias("html"))
    labels = materialize(common_labels(htmls), "html-labels")
    streams = materialize(
        htmls.join(labels, "host", "left").select("host", "html", "labels")
        .mapInArrow(_skeletons, "host string, kind string, page binary, wrapper string, paths array<string>, "
                                "hashes array<long>, chars array<long>"),
        "html-streams")
    ddl = "host string, kind string, wrapper string"
    level = materialize(streams.select("host", "kind", "wrapper").distinct(), "html-wrappers")
    while True:
        per_host = level.groupBy("host", "kind").agg(F.count(F.lit(1)).alias("k"))
        if (per_host.agg(F.max("k")).first()[0] or 0) <= 1:
            break
        parts = level.join(per_host, ["host", "kind"]).withColumn(
            "part", F.pmod(F.xxhash64("wrapper"), F.ceil(F.col("k") / F.lit(FAN))))
        level = materialize(parts.select("host", "kind", "part", "wrapper").groupBy("host", "kind", "part")
                            .applyInPandas(_merged, ddl), "html-wrappers")
    # only pages without article and main elements need them
    stats = (streams.filter((F.col("kind") == "") | F.col("kind").startswith("/")).dropDuplicates(["host", "kind", "page"])
             .select("host", "kind", F.explode(F.arrays_zip("paths", "hashes", "chars")).alias("s"))
             .groupBy("host", "kind", F.col("s.paths").alias("path"))
             .agg(F.count(F.lit(1)).alias("pages"), F.min("s.hashes").alias("low"), F.max("s.hashes").alias("high"),
                  F.sum("s.chars").alias("chars")))
    judged = (level.groupBy("host", "kind").cogroup(stats.groupBy("host", "kind"))
              .applyInPandas(_judged, "host string, kind string, paths string").groupBy("host")
              .agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("kind", "paths"))))).alias("paths")))
    return materialize(judged.join(labels, "host", "left").select("host", "labels", "paths"), "html-judged")


def _extractor(batches):
    known = _Known(frozenset)
    wanted = _Known(lambda kinds: {k: frozenset(json.loads(p)) for k, p in kinds.items()} if kinds else {})
    for batch in batches:
        texts = []
        for html, labels, paths in zip(batch.column(2), batch.column(3).to_pylist(), batch.column(4).to_pylist()):
            tree = parse(html.as_py() or "", known(labels))
            kind = kind_of(tree)
            # a page of nothing but text that is fixed on others keeps it
            texts.append("\n".join(extract(tree, wanted(paths).get(kind, frozenset())) or loose_texts(tree, kind)))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                                         names=["page_id", "url", "text"])


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page: the article's blocks, one per line.

    Character references are decoded, white space inside a block (line
    breaks included) becomes one space, blocks are trimmed and empty ones
    left out.  A null or empty html, or a page without article text, has an
    empty text.  Null urls and urls without a host form one host of their
    own.  Repeated rows are extracted each; an empty table gives no rows;
    extra columns are not looked at.
    """
    wrappers = infer_wrappers(pages, url_col, html_col).withColumnRenamed("host", "_host")
    rows = pages.select(quoted(id_col).cast("long").alias("page_id"), quoted(url_col).cast("string").alias("url"),
                        quoted(html_col).cast("string").alias("html"))
    joined = rows.join(wrappers, host_of(F.col("url")) == F.col("_host"), "left").select(
        "page_id", "url", "html", "labels", "paths")
    out = joined.mapInArrow(_extractor, "page_id long, url string, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))
