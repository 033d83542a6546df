"""Markup to a tree of block elements with their texts, and labelled pages to learn from."""

from __future__ import annotations

import html
import itertools
import re
from bisect import bisect_left
from collections import Counter

#: Element groups of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
SKIPPED = frozenset("noscript template svg object select button audio video canvas map datalist dialog".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q s samp small span strike "
    "strong sub sup time tt u var wbr picture source ruby rt rp input meta link base area param track embed "
    "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose msub msup msubsup munder mover "
    "munderover mmultiscripts mprescripts none mtable mtr mlabeledtr mtd maction semantics annotation annotation-xml".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TAGS = ("html body main article section div header footer nav aside form p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tbody thead tr td th "
        "blockquote pre figure figcaption address fieldset details summary center").split()
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre figure figcaption tr td th tbody thead address summary".split())
#: Elements whose start ends a skipped element that is never closed.
BLOCKS = frozenset(TAGS)
#: What a start tag closes if it is open, and the elements at which the search for it ends.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "thead": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
}
#: Words of class, id and role that point away from or to the main text.
AWAY = frozenset(
    "ad ads advert advertisement adverts banner bar breadcrumb breadcrumbs byline comment comments commentlist consent cookie cookies "
    "copyright discuss disqus footer form gdpr header hidden login masthead menu meta modal nav navbar navigation newsletter notice pager "
    "pagination popup promo promoted recommended related replies reply respond search share sharing sidebar signup skip social sponsor "
    "sponsored subscribe tags teaser toolbar topbar widget widgets alert contentinfo complementary dialog".split())
TOWARDS = frozenset("article body blog content entry main post story text articlebody postbody page".split())

TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|[\"'][^>]*+>?|$)", re.DOTALL)
NAMED = re.compile(r"(?:^|[\s\"'/])(class|id|role|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.IGNORECASE)
PART = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")
MARK = re.compile(r"data-y=\"([01])\"")
SPACE = re.compile(r"\s+")


def hint_of(attributes: str) -> int:
    """0: nothing, 1: away, 2: towards, 3: both."""
    away = towards = False
    for name, value in NAMED.findall(attributes):
        name = name.lower()
        if name == "hidden" or name == "aria-hidden" and value.strip("\"'").lower() == "true":
            away = True
        for part in PART.findall(value):
            away |= part.lower() in AWAY
            towards |= part.lower() in TOWARDS
    return away + 2 * towards


class Tree:
    """Block elements (parents first) and text blocks in page order."""

    def __init__(self) -> None:
        self.tag: list[str] = ["html"]
        self.parent: list[int] = [-1]
        self.hint: list[int] = [0]
        self.mark: list[int] = [-1]
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters in links

    def add(self, tag: str, parent: int, attributes: str) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.hint.append(hint_of(attributes) if attributes else 0)
        m = MARK.search(attributes) if attributes else None
        self.mark.append(int(m.group(1)) if m else -1)
        return len(self.tag) - 1


def parse(page: str) -> Tree:
    """The page's tree.  Elements of SKIPPED are left out; one that is never closed ends at the first block after it, at
    the latest where an open element around it ends."""
    tree, stack = Tree(), [0]
    pending: list[tuple[str, bool]] = []
    link, at, n = False, 0, len(page)
    inline: Counter[str] = Counter()  # open elements of INLINE
    depths: dict[str, list[int]] = {}  # of open block elements by tag: their places on the stack, ascending
    ends: dict[int, int] = {}  # of skipped elements that are never closed, by where their start tag ends

    def flush() -> None:
        if pending:
            text = SPACE.sub(" ", html.unescape("".join(t for t, _ in pending))).strip()
            if text:
                tree.blocks.append((stack[-1], text, sum(len(t.strip()) for t, of_link in pending if of_link)))
            pending.clear()

    def push(tag: str, attributes: str) -> None:
        stack.append(tree.add(tag, stack[-1], attributes))
        depths.setdefault(tag, []).append(len(stack) - 1)

    def cut(depth: int) -> None:
        """Close the elements from place ``depth`` of the stack on."""
        for element in reversed(stack[depth:]):
            depths[tree.tag[element]].pop()
        del stack[depth:]

    def deepest(tags) -> int:
        """Place of the last open element with one of ``tags``, 0 if there is none."""
        return max((depths[t][-1] for t in tags if depths.get(t)), default=0)

    def after(begin: int, outer: str) -> int:
        """Where the page goes on after a skipped element whose start tag ends at ``begin``."""
        if begin in ends:
            return ends[begin]
        inner, blocks, at, border = [(outer, begin)], [], begin, n

        def unclosed(depth: int, border: int) -> None:
            for tag, lo in inner[depth:]:
                if tag in SKIPPED:
                    k = bisect_left(blocks, lo)
                    ends[lo] = blocks[k] if k < len(blocks) else border

        within = Counter([outer])
        while m := TOKEN.search(page, at):
            at = m.end()
            if m.group(2) is None:
                continue
            tag = m.group(2).lower()
            if m.group(1):
                if within[tag]:
                    depth = next(d for d in range(len(inner) - 1, -1, -1) if inner[d][0] == tag)
                    unclosed(depth + 1, m.start())
                    within.subtract(t for t, _ in inner[depth:])
                    del inner[depth:]
                    if not inner:
                        return at
                elif depths.get(tag) or inline[tag]:
                    border = m.start()
                    break
            elif m.group(3).endswith("/") or tag in VOID:
                continue
            elif tag in RAW:
                close = re.compile(f"</{tag}(?=[\\s/>])[^>]*>?", re.IGNORECASE).search(page, at)
                at = close.end() if close else n
            else:
                if tag in BLOCKS:
                    blocks.append(m.start())
                inner.append((tag, at))
                within[tag] += 1
        unclosed(0, border)
        return ends[begin]

    while at < n:
        m = TOKEN.search(page, at)
        start = m.start() if m else n
        if start > at:
            pending.append((page[at:start], link))
        if not m:
            break
        at = m.end()
        tag = m.group(2)
        if tag is None:
            continue
        tag, ending = tag.lower(), bool(m.group(1))
        if tag in RAW and not ending:
            close = re.compile(f"</{tag}(?=[\\s/>])[^>]*>?", re.IGNORECASE).search(page, at)
            at = close.end() if close else n
            continue
        if tag in SKIPPED:
            if not ending and not m.group(3).endswith("/"):
                at = after(at, tag)
            continue
        if tag in INLINE:
            if tag == "a":
                link = not ending
            elif tag == "br":
                pending.append((" ", link))
            if ending:
                inline[tag] = max(0, inline[tag] - 1)
            elif tag not in VOID and not m.group(3).endswith("/"):
                inline[tag] += 1
            continue
        if tag in VOID:
            flush()
            continue
        if tag in ("html", "head"):
            continue
        flush()
        if ending:
            link = False
            if depth := deepest((tag,)):
                cut(depth)
            continue
        if tag == "body":
            cut(1)
        if len(stack) > 1 and (tree.tag[stack[-1]] == "p" or tag in HEADINGS and tree.tag[stack[-1]] in HEADINGS):
            cut(len(stack) - 1)
        if tag in CLOSES:
            targets, borders = CLOSES[tag]
            depth = deepest(targets)
            if depth > deepest(borders):
                cut(depth)
        push(tag, m.group(3))
    flush()
    return tree


def weak_labels(tree: Tree) -> list[int] | None:
    """1 below the page's only article (or main) outside elements that say they are something else; None without one."""
    for name in ("article", "main"):
        roots = [i for i, t in enumerate(tree.tag) if t == name]
        if len(roots) == 1:
            break
    else:
        return None
    out = [0] * len(tree.tag)
    for i, tag in enumerate(tree.tag):
        inside = i == roots[0] or tree.parent[i] >= 0 and out[tree.parent[i]]
        out[i] = int(bool(inside) and tag not in ("nav", "aside", "footer", "form") and (tree.hint[i] != 1 or i == roots[0]))
    return out


def marked_labels(tree: Tree) -> list[int]:
    """Labels of ``data-y`` marks, handed down."""
    out: list[int] = []
    for i, mark in enumerate(tree.mark):
        out.append(mark if mark >= 0 else out[tree.parent[i]] if tree.parent[i] >= 0 else 0)
    return out


def filler(words: int) -> str:
    return " ".join(("lorem", "ipsum", "dolor", "sit", "amet", "elit")[i % 6] for i in range(words))


def links(n: int) -> str:
    return "".join(f'<li><a href="/x">{filler(1 + i % 2)}</a></li>' for i in range(n))


def labelled_pages() -> list[str]:
    """Pages labelled by hand: ``data-y`` is 1 on what holds the main text, 0 on what does not, and is handed down."""
    mains = (
        "<article data-y='1'>{}</article>", "<main data-y='1'>{}</main>", "<main><article class='post' data-y='1'>{}</article></main>",
        "<div class='content' data-y='1'>{}</div>", "<div id='main-content'><div class='entry-content' data-y='1'>{}</div></div>",
        "<div class='wrapper'><div class='post-body' data-y='1'>{}</div></div>", "<section class='story' data-y='1'>{}</section>",
        "<div data-y='1'>{}</div>", "<div><div data-y='1'><div>{}</div></div></div>", "<div data-y='1'><section>{}</section><section><p>" + filler(40) + "</p></section></div>",
    )
    bodies = (
        f"<h1>{filler(6)}</h1><p>{filler(60)}</p><p>{filler(3)}</p><p>{filler(45)}</p>",
        f"<h2>{filler(4)}</h2><p>{filler(30)} <a href='/y'>{filler(3)}</a> {filler(20)}</p><ul><li>{filler(8)}</li><li>{filler(12)}</li></ul><p>{filler(80)}</p>",
        f"<p>{filler(25)}</p><blockquote><p>{filler(20)}</p></blockquote><pre>{filler(15)}</pre><p>{filler(50)}</p><h3>{filler(3)}</h3><p>{filler(9)}</p>",
        f"<h1>{filler(5)}</h1>{filler(70)}<table><tr><td>{filler(3)}</td><td>{filler(2)}</td></tr></table><p>{filler(35)}</p>",
        f"<header><h1>{filler(5)}</h1></header><p>{filler(4)}</p><p>{filler(7)}</p><figure><figcaption>{filler(9)}</figcaption></figure><p>{filler(33)}</p>",
    )
    inside = (
        "", f"<div class='share' data-y='0'><ul>{links(3)}</ul></div>", f"<div class='ad' data-y='0'>{filler(12)}</div>",
        f"<aside data-y='0'><p>{filler(30)}</p></aside>", f"<form class='newsletter' data-y='0'><p>{filler(10)}</p></form>",
        f"<nav class='pagination' data-y='0'><ul>{links(3)}</ul></nav>", f"<footer data-y='0'><p>{filler(6)}</p></footer>",
    )
    before = (
        f"<nav><ul>{links(6)}</ul></nav>", f"<header class='site-header'><h1><a href='/'>{filler(2)}</a></h1><p>{filler(5)}</p></header>",
        f"<div class='menu'><ul>{links(8)}</ul></div>", f"<div id='cookie-notice'><p>{filler(25)}</p></div>", f"<div class='ad'>{filler(8)}</div>",
        f"<form class='search'><p>{filler(2)}</p></form>", f"<header><div>{filler(4)}</div><ul>{links(5)}</ul></header>",
    )
    after = (
        f"<footer>{filler(8)}</footer>", f"<aside class='sidebar'><h3>{filler(2)}</h3><p>{filler(30)}</p><ul>{links(5)}</ul></aside>",
        f"<section id='comments'><h2>{filler(2)}</h2><ol><li><p>{filler(35)}</p></li><li><p>{filler(50)}</p></li></ol></section>",
        f"<div class='comments'><div class='comment'><p>{filler(40)}</p></div><div><p>{filler(20)}</p></div></div><footer><p>{filler(12)}</p></footer>",
        f"<div class='related'><h3>{filler(2)}</h3><ul>{links(4)}</ul></div><div id='footer'><p>{filler(10)}</p></div>",
        f"<aside><p>{filler(45)}</p></aside><footer><ul>{links(4)}</ul><p>{filler(9)}</p></footer>",
        f"<div class='widget'><p>{filler(22)}</p></div><form><p>{filler(14)}</p></form><footer><div>{filler(7)}</div></footer>",
    )
    pages = []
    for i, (main, body) in enumerate(itertools.product(mains, bodies)):
        text = main.format(body + inside[i % len(inside)] + (f"<p>{filler(28)}</p>" if i % 2 else ""))
        page = before[i % len(before)] + before[(i * 3 + 2) % len(before)] + text + after[(i * 2) % len(after)] + after[(i * 5 + 3) % len(after)]
        pages.append(f"<html><body>{page}</body></html>".replace("'", '"'))
    pages += [f'<body data-y="1">{body}</body>'.replace("'", '"') for body in bodies[:3]]
    return pages
