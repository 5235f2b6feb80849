"""Main text of web pages by a tree-structured graphical model.

A page becomes a tree of its block elements. Each element has a hidden state, boilerplate or
content (an element that holds main text, itself or below, is content). Parent-child potentials
P(state | parent's state, tag) connect the elements; each element's evidence is a product of
P(feature | state) over its tag, its parent's tag, the words of its class, id and role, the length
of its text, its share of link text, whether it holds and ends in sentences, and
the words of short texts that hold a notice. Sum-product messages go up from the leaves and down from
the root and give each element's exact marginal; text in elements at least half certain is kept.

Both kinds of tables are counted on labelled pages: HTML in which data-main="1" or "0" marks where
main text or boilerplate begins. `labelled_pages` makes such pages of many layouts; other pages
can be given.

Text in scripts, styles and other hidden parts is never kept. Character references are decoded,
white space within a block is one space, blocks are joined by an empty line. A null or empty page
has an empty text. Broken markup (missing or stray ends, unclosed comments) is read as browsers do
in the main. Depth and length are not limited; nothing recurses. Repeated rows are kept, an empty
table gives an empty result, and other columns take no part.
"""

from __future__ import annotations

import html as html_lib
import math
import random
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed names of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
HIDDEN = frozenset("head title script style noscript template svg iframe object canvas audio video map math".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Elements that an opening tag ends, up to the nearest of the second set.
ENDED_BY = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())

_ASIDE = r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
#: Quotes are taken as a whole or not at all, so a tag is read twice at most: with its quotes, and without where one never ends.
TOKEN = re.compile(_ASIDE + r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*+)>""", re.S)
#: After the last ">" of a page no tag ends.
LAST_TOKEN = re.compile(_ASIDE + r"|(?!)()()()", re.S)
MARKS = re.compile(r"""(?:^|\s)(class|id|role|data-main)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
#: Ends of sentences, and what notices say in a few languages.
STOPS = re.compile(r"[.!?…。！？](?=\s|$)")
CUES = re.compile(r"©|\(c\)|copyright|rights reserved|derechos reservados|droits réservés|Rechte vorbehalten|cookies?|subscribe|newsletter|advertisement|sponsored|log ?in|sign up|read more|share this|terms of (?:use|service)|privacy|impressum", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


#: Children alike in tag and names speak to their parent as so many at most: they say the same thing again and again.
ALIKE = 4


class Element:
    __slots__ = ("parent", "tag", "marks", "label", "chars", "linked", "stops", "ended", "cues")

    def __init__(self, parent: int, tag: str, marks: tuple[str, ...], label: int | None):
        self.parent, self.tag, self.marks, self.label = parent, tag, marks, label
        self.chars = self.linked = self.stops = 0
        self.ended: bool | None = None
        self.cues: set[str] = set()


def parse(page: str) -> tuple[list[Element], list[tuple[int, str]]]:
    """Block elements in document order (parents first), and the blocks of text with their elements."""
    nodes = [Element(-1, "#root", (), None)]
    blocks: list[tuple[int, str]] = []
    open_tags: list[tuple[str, int]] = [("#root", 0)]  # tag and its element, or that of the block around it
    places: dict[str, list[int]] = {}  # of each open tag in open_tags
    hidden = links = 0
    pending: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if pending:
            text = " ".join(html_lib.unescape("".join(pending)).split())
            pending.clear()
            if text:
                k = open_tags[-1][1]
                blocks.append((k, text))
                nodes[k].chars += len(text)
                nodes[k].linked += min(linked, len(text))
                nodes[k].stops += len(STOPS.findall(text))
                nodes[k].ended = not linked and text[-1] in ".!?…。！？"
                if len(text) < 200:
                    nodes[k].cues.update(w.lower() for w in CUES.findall(text))
        linked = 0

    def close(upto: int) -> None:
        nonlocal hidden, links
        while len(open_tags) > upto:
            tag, _ = open_tags[-1]
            if tag not in INLINE:
                flush()
            open_tags.pop()
            places[tag].pop()
            hidden -= tag in HIDDEN
            links -= tag == "a"

    def push(tag: str, element: int) -> None:
        places.setdefault(tag, []).append(len(open_tags))
        open_tags.append((tag, element))

    def innermost(tags: Iterable[str]) -> int:
        """The place of the last one open, 0 if there is none."""
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def add(text: str) -> None:
        nonlocal linked
        if text and not hidden:
            pending.append(text)
            if links:
                linked += len(text.strip())

    at, size, last_end = 0, len(page), page.rfind(">")
    while at < size:
        m = (TOKEN if at <= last_end else LAST_TOKEN).search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        tag = m[2] and m[2].lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                add(html_lib.escape(m[0][9:-3]))
            continue
        if m[1]:
            k = innermost((tag,))
            if k:
                close(k)
            continue
        if tag in ENDS_P:
            k = innermost(("p", "td", "th", "button", "table"))
            if k and open_tags[k][0] == "p":
                close(k)
        if tag in ENDED_BY:
            ends, scope = ENDED_BY[tag]
            k = innermost(ends | scope)
            while k and open_tags[k][0] in ends:
                close(k)
                k = innermost(ends | scope)
        if tag in INLINE:
            if tag in ("br", "wbr", "img"):
                add(" " if tag == "br" else "")
            else:
                push(tag, open_tags[-1][1])
                links += tag == "a"
            continue
        flush()
        if tag in VOID:
            continue
        marks, label = [], None
        for name, a, b, c in MARKS.findall(m[3]):
            value = a or b or c
            if name.lower() == "data-main":
                label = int(value == "1")
            else:
                marks += [w.lower() for w in WORDS.findall(value)]
        nodes.append(Element(open_tags[-1][1], tag, tuple(dict.fromkeys(marks)), label))
        push(tag, len(nodes) - 1)
        hidden += tag in HIDDEN
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            add(page[at : end.start() if end else size])
            at = end.start() if end else size
    close(1)
    flush()
    for k in range(len(nodes) - 1, 0, -1):
        nodes[nodes[k].parent].chars += nodes[k].chars
        nodes[nodes[k].parent].linked += nodes[k].linked
        nodes[nodes[k].parent].stops += nodes[k].stops
    return nodes, blocks


#: Elements whose share of link text counts by tag.
LISTS = frozenset("li ul ol dl td".split())


def features(nodes: list[Element], k: int) -> list[str]:
    e = nodes[k]
    out = [f"t:{e.tag}", f"p:{e.tag}<{nodes[e.parent].tag if e.parent >= 0 else '-'}"]
    out += [f"m:{w}" for w in e.marks] or [f"m:-{e.tag}"]
    out.append(f"c:{min(e.chars, 4000).bit_length() // 2}")
    if e.chars:
        out.append(f"l:{e.tag if e.tag in LISTS else ''}{min(4, 5 * e.linked // e.chars)}{'s' if e.stops >= 3 and 20 * e.stops < e.chars else ''}")
    if e.ended is not None:
        out.append(f"e:{'-' if e.marks else e.tag}{int(e.ended)}")
    out += [f"w:{w}" for w in e.cues] or (["w:"] if e.chars else [])
    return out


class TreeModel:
    """Tables of log P(feature | state) and P(state | parent's state, tag)."""

    def __init__(self, pages: Iterable[str], smoothing: float = 0.5):
        seen: dict[str, list[float]] = defaultdict(lambda: [smoothing, smoothing])
        states = [0.0, 0.0]
        moves: dict[tuple[str, int], list[float]] = defaultdict(lambda: [0.0, 0.0])
        every = [[smoothing, smoothing], [smoothing, smoothing]]
        for page in pages:
            nodes, blocks = parse(page)
            inherited: list[int] = []
            for e in nodes:
                inherited.append(e.label if e.label is not None else inherited[e.parent] if e.parent >= 0 else 0)
            main = [0] * len(nodes)
            for k, _ in blocks:
                main[k] |= inherited[k]
            for k in range(len(nodes) - 1, 0, -1):
                main[nodes[k].parent] |= main[k]
            for k in range(len(nodes)):
                y = main[k]
                states[y] += 1
                for f in features(nodes, k):
                    seen[f][y] += 1
                if k:
                    moves[nodes[k].tag, main[nodes[k].parent]][y] += 1
                    every[main[nodes[k].parent]][y] += 1
        total = [s + 2 * smoothing for s in states]
        self.evidence = {f: math.log(n[1] / total[1]) - math.log(n[0] / total[0]) for f, n in seen.items()}
        self.default = [row[1] / (row[0] + row[1]) if sum(row) else 0.5 for row in every]
        self.default[0] = min(self.default[0], 0.002)  # below boilerplate there is no main text
        back = 4.0
        self.moves = {key: (n[1] + back * self.default[key[1]]) / (n[0] + n[1] + back) for key, n in moves.items()}

    def move(self, tag: str, parent: int) -> float:
        """P(content | parent's state, tag)."""
        return self.moves.get((tag, parent), self.default[parent])

    def marginals(self, nodes: list[Element]) -> list[float]:
        """P(content) of each element, by messages up and down the tree."""
        n = len(nodes)
        odds = [0.0] * n
        for k in range(1, n):
            kinds: dict[str, list[float]] = {"t": [], "p": [], "m": [], "c": [], "l": [], "e": [], "w": []}
            for f in features(nodes, k):
                if (v := self.evidence.get(f)) is not None:
                    kinds[f[0]].append(v)
            # A tag and its pair with the parent's tag say much the same: the pair counts where it is known.
            shape = kinds["p"] or kinds["t"]
            # Names that speak for and against weigh as the strongest of each; the rest of a list says little more.
            names = max([0.0, *kinds["m"]]) + min([0.0, *kinds["m"]])
            odds[k] = sum(shape) + names + sum(kinds["c"]) + sum(kinds["l"]) + sum(kinds["e"]) + sum(kinds["w"])
        up0, up1 = [1.0] * n, [1.0] * n  # evidence of the element and all below it
        for k in range(1, n):
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds[k]))))
            up0[k], up1[k] = 1 - p, p
        alike = Counter((e.parent, e.tag, e.marks) for e in nodes)
        message0, message1 = [1.0] * n, [1.0] * n
        for k in range(n - 1, 0, -1):
            a, b = self.move(nodes[k].tag, 0), self.move(nodes[k].tag, 1)
            to0, to1 = (1 - a) * up0[k] + a * up1[k], (1 - b) * up0[k] + b * up1[k]
            weight = min(1.0, ALIKE / alike[nodes[k].parent, nodes[k].tag, nodes[k].marks])
            to0, to1 = to0**weight, to1**weight
            s = to0 + to1
            message0[k], message1[k] = to0 / s, to1 / s
            parent = nodes[k].parent
            x, y = up0[parent] * message0[k], up1[parent] * message1[k]
            s = x + y or 1e-300
            up0[parent], up1[parent] = max(x / s, 1e-300), max(y / s, 1e-300)
        out = [1.0] * n
        s = up0[0] * 0.01 + up1[0] * 0.99  # a page has main text, as a rule
        out[0] = up1[0] * 0.99 / s
        for k in range(1, n):
            p = out[nodes[k].parent]
            rest0, rest1 = (1 - p) / message0[k], p / message1[k]  # the parent's belief without this child
            s = rest0 + rest1
            rest0, rest1 = rest0 / s, rest1 / s
            a, b = self.move(nodes[k].tag, 0), self.move(nodes[k].tag, 1)
            x, y = (rest0 * (1 - a) + rest1 * (1 - b)) * up0[k], (rest0 * a + rest1 * b) * up1[k]
            out[k] = y / (x + y or 1e-300)
        return out

    def extract(self, page: str | None, threshold: float = 0.5) -> str:
        if not page:
            return ""
        nodes, blocks = parse(page)
        belief = self.marginals(nodes)
        return "\n\n".join(text for k, text in blocks if belief[k] >= threshold)


def labelled_pages(n: int = 800, seed: int = 11) -> list[str]:
    """Pages of many layouts with data-main marks: menus, headers, footers, sidebars, notices, adverts,
    forms and comments around an article, with and without telling names.
    """
    rng = random.Random(seed)
    letters = "etaoinshrdlucmfwypvbgkqjxz"

    def words(k: int) -> str:
        return " ".join("".join(rng.choices(letters, weights=range(26, 0, -1), k=rng.randint(1, 9))) for _ in range(k)).capitalize() + rng.choice([".", ".", "!", "?", ""])

    def link() -> str:
        return f'<a href="/{rng.randint(1, 99)}">{words(rng.randint(1, 4))}</a>'

    def mark(names: str) -> str:
        chosen = rng.choice(names.split())
        how = rng.random()
        return f' class="{chosen}"' if how < 0.55 else f' id="{chosen}"' if how < 0.75 else f' class="{chosen}-{rng.choice(["box", "wrap", "inner", "top", "list", "area"])}"' if how < 0.85 else ""

    def some(p: float, f) -> str:
        return f() if rng.random() < p else ""

    def sentences(k: int) -> str:
        return " ".join(words(rng.randint(3, 14)).rstrip(".!?") + rng.choice([".", ".", ".", "!", "?"]) for _ in range(k))

    def paragraph() -> str:
        text = words(rng.choice([1, 2, 2, 3, 6, 15, 40, 80, 160, 400])) if rng.random() < 0.6 else sentences(rng.randint(1, 8))
        if rng.random() < 0.2:
            text += " " + link() + " " + words(rng.randint(5, 30))
        if rng.random() < 0.15:
            text = f"<b>{text}" + rng.choice(["</b>", "<br>", ""])
        name = rng.choice(["lead", "intro", "text", "first", "para", "summary", "noindent", "x" + rng.choice(letters)])
        return (f'<p class="{name}">' if rng.random() < 0.15 else "<p>") + text + rng.choice(["</p>", "</p>", "</p>", ""])

    def body() -> str:
        parts = []
        for _ in range(rng.randint(1, 12)):
            parts.append(rng.choices([paragraph, lambda: f"<h{rng.randint(2, 4)}>{words(rng.randint(2, 8))}</h{rng.randint(2, 4)}>", listed, lambda: f"<blockquote><p>{words(25)}</p></blockquote>", lambda: "<table><tr>" + "".join(f"<td>{words(3)}</td>" for _ in range(3)) + "</tr></table>", lambda: f"<pre>{words(20)}</pre>", lambda: f"<figure><img src=x><figcaption>{words(8)}</figcaption></figure>", lambda: f"<div>{words(30)}</div>"], weights=[16, 2, 4, 1, 1, 1, 1, 1])[0]())
        return "".join(parts)

    def linked_paragraph() -> str:
        return "<p>" + " ".join(f'<a href="/{rng.randint(1, 99)}">{sentences(1)}</a>' for _ in range(rng.randint(1, 4))) + "</p>"

    def listed() -> str:
        tag, short = rng.choice(["ul", "ul", "ol"]), rng.random() < 0.5
        return f"<{tag}>" + "".join(f"<li>{words(rng.randint(1, 6)) if short else sentences(rng.randint(1, 3))}</li>" for _ in range(rng.randint(2, 7))) + f"</{tag}>"

    def short_lines() -> str:
        return "".join(f"<div>{sentences(rng.randint(1, 2))}</div>" for _ in range(rng.randint(2, 6)))

    def notice_text() -> str:
        return rng.choice(["&copy; 2021 {}. All rights reserved.", "Copyright {} 2020", "All rights reserved {}", "(c) {}", "{} Alle Rechte vorbehalten", "Tous droits réservés {}", "Todos los derechos reservados {}", "Privacy {} Terms of use"]).format(words(rng.randint(0, 4)).rstrip(".!?"))

    def bare(tag: str, names: str) -> str:
        return f'<{tag}{mark(names)} data-main="0">'

    def menu() -> str:
        tag = rng.choice(["nav", "nav", "div", "ul"])
        items = "".join(f"<li>{link()}</li>" for _ in range(rng.randint(3, 9)))
        return bare(tag, "nav menu navigation navbar topnav main-menu breadcrumbs breadcrumb") + (items if tag == "ul" else f"<ul>{items}</ul>") + f"</{tag}>"

    def header() -> str:
        tag = rng.choice(["header", "header", "div"])
        return bare(tag, "header site-header masthead banner topbar logo branding") + rng.choice([f"<h1>{words(3)}</h1>", f"<p>{words(4)}</p>", f"<div>{words(3)}</div>"]) + some(0.5, menu) + f"</{tag}>"

    def footer() -> str:
        tag = rng.choice(["footer", "footer", "div"])
        return bare(tag, "footer site-footer bottom copyright colophon legal") + rng.choice([f"&copy; {words(4)}", f"<p>&copy; 2020 {words(6)}</p>", notice_text(), f"<p>{notice_text()}</p>", f"<div>{notice_text()}</div>", "".join(f"<p>{link()}</p>" for _ in range(4))]) + f"</{tag}>"

    def advert() -> str:
        tag = rng.choice(["div", "div", "aside", "section"])
        return bare(tag, "ad ads advert advertisement sponsor sponsored promo promotion banner adsense") + rng.choice([words(rng.randint(3, 14)), f"<p>{words(rng.randint(3, 20))}</p>", sentences(rng.randint(1, 3)), f"<p>{sentences(rng.randint(1, 3))}</p>", link()]) + f"</{tag}>"

    def notice() -> str:
        tag = rng.choice(["div", "div", "section", "p", "dialog"])
        return bare(tag, "cookie cookies notice consent alert message popup modal gdpr warning disclaimer newsletter subscribe overlay") + (words(rng.randint(5, 25)) if tag == "p" else f"<p>{rng.choice(['We use cookies. ', 'This site uses cookies. ', 'Subscribe to the newsletter. ', ''])}{words(rng.randint(5, 30))}</p>" + some(0.5, lambda: f"<button>{words(1)}</button>")) + f"</{tag}>"

    def sidebar() -> str:
        tag = rng.choice(["aside", "aside", "div", "section"])
        lines = "".join(rng.choice([lambda: f"<li>{link()}</li>", lambda: f"<p>{words(rng.randint(3, 25))}</p>", lambda: f"<p>{sentences(rng.randint(1, 3))}</p>"])() for _ in range(rng.randint(2, 7)))
        return bare(tag, "sidebar side related widget widgets recommended popular trending share social author-box tags more-stories") + rng.choice(["<h2>{}</h2>", "<h3>{}</h3>", "<h3>{}</h3>", "<h4>{}</h4>", "<b>{}</b>"]).format(words(2)) + rng.choice([f"<div>{lines}</div>", f"<ul>{lines}</ul>", lines]) + f"</{tag}>"

    def form() -> str:
        return bare("form", "search search-form login signup contact newsletter subscribe") + f"<label>{words(2)}</label><input name=q>" + some(0.5, lambda: f"<p>{words(6)}</p>") + some(0.4, lambda: f"<select><option>{words(1)}<option>{words(1)}</select>") + some(0.3, lambda: f"<textarea>{words(5)}</textarea>") + f"<button>{words(1)}</button></form>"

    def comments() -> str:
        tag = rng.choice(["section", "div", "div", "ol"])
        inner = rng.choice(["div", "article", "li"]) if tag != "ol" else "li"
        each = "".join(f"<{inner}{mark('comment comment reply comment-body response post-comment')}><p>{words(rng.randint(4, 60)) if rng.random() < 0.5 else sentences(rng.randint(1, 5))}</p>" + some(0.4, lambda: f"<span>{words(2)}</span>") + f"</{inner}>" for _ in range(rng.randint(1, 6)))
        return f'<{tag} {rng.choice(["class", "id"])}="{rng.choice(["comments", "comments", "comment-list", "responses", "discussion", "disqus", "user-comments", "reader-comments", "replies"])}" data-main="0">' + some(0.6, lambda: rng.choice(["<h2>{}</h2>", "<h3>{}</h3>", "<h4>{}</h4>"]).format(words(2))) + each + some(0.3, form) + f"</{tag}>"

    pages = []
    for _ in range(n):
        tag = rng.choice(["article", "article", "main", "div", "div", "section"])
        names = "content article post entry main story text body article-body post-content entry-content page"
        title = rng.choice([f"<h1>{words(rng.randint(2, 9))}</h1>", f"<header><h1>{words(5)}</h1></header>", ""])
        form_of = rng.random()
        inner = title + (body() if form_of < 0.8 else "".join(linked_paragraph() for _ in range(rng.randint(2, 6))) if form_of < 0.9 else short_lines())
        inner += some(0.2, lambda: f"<p>{notice_text()}</p>" + some(0.3, paragraph))  # articles quote notices, too
        if rng.random() < 0.3:
            inner += rng.choice([advert, sidebar, notice, form])() + body()
        name = mark(names)
        if rng.random() < 0.06:  # names that mislead, beside one that does not
            beside = ["cookie-recipe", "related-topic", "social-studies", "login-guide", "newsletter-issue"]
            name = f' class="{" ".join(rng.sample([rng.choice(beside), rng.choice(names.split())], 2))}"'
        main = f'<{tag}{name} data-main="1">{inner}' + some(0.15, comments) + f"</{tag}>"
        before = some(0.6, header) + some(0.7, menu) + some(0.4, advert) + some(0.3, notice) + some(0.2, form)
        after = some(0.4, sidebar) + some(0.4, comments) + some(0.3, advert) + some(0.2, form) + some(0.85, footer) + some(0.2, notice)
        middle = some(0.2, sidebar) + main
        if rng.random() < 0.3:
            middle = f'<div{mark("container wrapper wrap layout row page site")}>{middle}' + some(0.4, sidebar) + "</div>"
        layout = rng.random()
        if layout < 0.08:  # a table that lays out the page
            middle = f'<table><tr><td data-main="0">{menu()}</td><td data-main="1">{inner}</td></tr></table>' if rng.random() < 0.5 else f'<table><tr><td data-main="0">{"".join(f"<p>{link()}</p>" for _ in range(rng.randint(3, 8)))}</td><td data-main="1">{inner}</td>' + some(0.5, lambda: f'<td data-main="0">{words(8)}</td>') + "</tr></table>"
        elif layout < 0.2:  # text right below the body, and blocks without names
            inner = inner if rng.random() < 0.5 else title + short_lines()
            middle = f'<div data-main="1">{inner}</div>' if rng.random() < 0.5 else inner.replace("<p", '<p data-main="1"').replace('<p data-main="1"re', "<pre").replace("<div>", '<div data-main="1">').replace("<h1>", '<h1 data-main="1">')
            after = f'<div data-main="0">{notice_text()}</div>' if rng.random() < 0.7 else after
        pages.append(f"<!DOCTYPE html><html><head><title>{words(4)}</title><style>p{{}}</style></head><body>{before}{middle}{after}" + rng.choice(["</body></html>", "</body></html>", ""]))
    return pages


def _extract(batches: Iterator[pa.RecordBatch], model: TreeModel) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [model.extract(page.as_py()) for page in batch.column("html")]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("page_id", "url")), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html", labelled: Iterable[str] | None = None) -> DataFrame:
    """Per page: page_id, url, text, n_chars (code points)."""
    model = TreeModel(labelled if labelled is not None else labelled_pages())
    sent = pages.sparkSession.sparkContext.broadcast(model)  # tables of a few thousand features
    narrow = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).alias("html"))
    return narrow.mapInArrow(lambda it: _extract(it, sent.value), "page_id bigint, url string, text string, n_chars bigint").withColumnsRenamed({"page_id": page_id, "url": url})
