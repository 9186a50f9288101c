"""Blocks of an HTML page: a tolerant reader that keeps the tree of block elements, their text and their roles."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

#: A comment, a declaration, or a tag with its attributes; possessive, so that reading is linear whatever is left open.
_MARKUP = re.compile(
    r"""<(?:!--(?:.*?)(?:--!?>|\Z)|[!?][^>]*+(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|=?+[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)?+|=)*+)(?:>|\Z))""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s/>=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"'][^\s>]*+))?+)?+""", re.S)
_HINT_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _words(text: str) -> frozenset[str]:
    return frozenset(text.split())


# Elements of HTML by what they do.
VOID = _words("area base br col embed hr img input link meta param source track wbr")
RAW = _words("script style title textarea xmp iframe noembed noframes")
BLOCK = _words(
    "address article aside blockquote body button canvas caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup "
    "hr html legend li main menu nav noscript object ol optgroup option p pre search section select summary svg table tbody td template tfoot th thead tr ul video audio"
)
HEAD = _words("base basefont bgsound head html link meta noscript script style template title")
CLOSES_P = BLOCK - _words("button canvas noscript object option optgroup select svg template video audio caption tbody td tfoot th thead tr html head body")
HEADINGS = _words("h1 h2 h3 h4 h5 h6")
CELLS = _words("table td th caption template")
SAME = {  # an element that begins closes an open one of these, up to the element that holds them
    **{t: (frozenset({t}), frozenset({"ul", "ol", "menu", "dir"})) for t in ("li",)},
    **{t: (frozenset({"dd", "dt"}), frozenset({"dl"})) for t in ("dd", "dt")},
    **{t: (frozenset({"td", "th"}), frozenset({"table"})) for t in ("td", "th")},
    "tr": (frozenset({"tr"}), frozenset({"table"})),
    **{t: (frozenset({"tbody", "thead", "tfoot", "caption"}), frozenset({"table"})) for t in ("tbody", "thead", "tfoot")},
    "option": (frozenset({"option"}), frozenset({"select"})), "optgroup": (frozenset({"option", "optgroup"}), frozenset({"select"})),
}
#: Never main text, wherever they stand; others unless they hold the page's text; headers unless they stand in the article.
TECHNICAL = _words("head noscript template object svg canvas video audio button select option datalist")
GONE = TECHNICAL | _words("nav aside footer menu dialog search")
CONTENT = _words("article main")
ROLES = _words("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form")
COMMENTS = _words("comment comments commentlist commentary disqus respond replies reply discussion")
HINTS = COMMENTS | _words(
    "ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored sponsors promo promos promotion banner banners cookie cookies consent gdpr notice notices alert alerts "
    "popup modal overlay newsletter subscribe subscription signup signin login paywall share sharing sharebar social related recommended recommendations sidebar aside rail widget widgets "
    "nav navbar navigation navigator menu menus submenu topbar footer foot copyright disclaimer breadcrumb breadcrumbs pagination pager paging tagcloud toolbar masthead outbrain taboola feedback form search skip"
)
#: Within a line, names such as those of highlighted code say nothing.
INLINE_HINTS = HINTS - COMMENTS - _words("alert alerts notice notices form search feedback skip legal")
HEADER_HINTS = _words("header head masthead topbar")
PART_OF_ARTICLE = _words("article post entry content story title section")


@dataclass
class Page:
    """Elements in page order (0 is the page itself) and text blocks with the element that holds them."""

    tags: list[str] = field(default_factory=lambda: ["#page"])
    parents: list[int] = field(default_factory=lambda: [-1])
    labels: list[str] = field(default_factory=lambda: ["#page"])
    hints: list[frozenset[str]] = field(default_factory=lambda: [frozenset()])
    hidden: list[bool] = field(default_factory=lambda: [False])
    content: list[bool] = field(default_factory=lambda: [False])
    children: list[list[int]] = field(default_factory=lambda: [[]])  # elements, and ~block for text
    blocks: list[tuple[int, str, int, int]] = field(default_factory=list)  # owner, text, characters in links, links

    def add(self, tag: str, parent: int, attributes: dict[str, str], hidden: bool) -> int:
        named = f"{attributes.get('class', '')} {attributes.get('id', '')}"
        hints = frozenset(w.lower() for w in _HINT_WORD.findall(named)) if named != " " else frozenset()
        role = attributes.get("role", "").strip().lower()
        self.tags.append(tag)
        self.parents.append(parent)
        self.labels.append(f"{tag}.{' '.join(sorted(hints))}" if hints else tag)
        self.hints.append(hints | {"role"} if role in ROLES else hints)
        self.hidden.append(hidden)
        self.content.append(tag in CONTENT or role in CONTENT or "articlebody" in attributes.get("itemprop", "").lower())
        self.children.append([])
        self.children[parent].append(len(self.tags) - 1)
        return len(self.tags) - 1

    def sums(self, keep: list[bool] | None = None, what: int | None = None) -> list[int]:
        """Characters of text (or the given number) of the blocks in each element, of those that ``keep`` names."""
        out = [0] * len(self.tags)
        for i, block in enumerate(self.blocks):
            if keep is None or keep[i]:
                out[block[0]] += len(block[1]) if what is None else block[what]
        for i in range(len(out) - 1, 0, -1):
            out[self.parents[i]] += out[i]
        return out


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        value = m[2] or m[3] or m[4] or ""
        out.setdefault(m[1].lower(), html.unescape(value) if "&" in value else value)
    return out


def _is_hidden(attributes: dict[str, str]) -> bool:
    return "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or bool(_HIDDEN.search(attributes.get("style", "")))


def read(source: str) -> Page:
    """The page's blocks: text between block elements, references decoded, white space made one space; a line break is white space."""
    page, stack, buffer = Page(), [0], []
    link, linked, links, at, end = False, 0, 0, 0, len(source)
    skipped = ("", 0, 0)  # an inline element that isn't shown: its name, open elements of that name, and the stack's height

    def flush() -> None:
        nonlocal linked, links
        if buffer:
            text = "".join(buffer)
            text = " ".join((html.unescape(text) if "&" in text else text).split())
            if text:
                owner = stack[-1]
                page.children[owner].append(~len(page.blocks))
                page.blocks.append((owner, text, min(linked, len(text)), links))
            buffer.clear()
        linked = links = 0

    def close(height: int) -> None:
        nonlocal skipped
        flush()
        del stack[height:]
        if skipped[0] and skipped[2] > height:
            skipped = ("", 0, 0)

    while at < end:
        m = _MARKUP.search(source, at)
        text = source[at : m.start() if m else end]
        if text:
            if len(stack) > 1 and page.tags[stack[-1]] == "head" and text.strip():
                close(len(stack) - 1)
            if not skipped[0]:
                buffer.append(text)
                if link:
                    linked += len(text)
        if not m:
            break
        at = m.end()
        if not (tag := m[2]):
            continue
        tag = tag.lower()
        if m[1]:  # an end tag
            if skipped[0] == tag:
                skipped = (tag, skipped[1] - 1, skipped[2]) if skipped[1] > 1 else ("", 0, 0)
            elif tag == "a":
                link = False
            elif tag == "br":
                buffer.append(" ")
            elif tag in BLOCK and tag not in ("html", "body"):
                for height in range(len(stack) - 1, 0, -1):
                    name = page.tags[stack[height]]
                    if name == tag or (tag in HEADINGS and name in HEADINGS):
                        close(height)
                        break
                    if name in CELLS and tag not in ("table", "tbody", "thead", "tfoot", "tr", "td", "th"):
                        break
            continue
        if tag in RAW:
            found = re.compile(rf"</{tag}(?=[\s/>])[^>]*+>?", re.I).search(source, at)
            at = found.end() if found else end
            if tag in ("textarea", "iframe"):
                buffer.append(" ")
            continue
        if tag == "br" or tag == "img":
            buffer.append(" ")
        if tag == "a":
            link = True
            links += 1
        if tag not in BLOCK:
            if skipped[0] == tag:
                skipped = (tag, skipped[1] + 1, skipped[2])
            elif not skipped[0] and tag not in VOID and m[3].strip(" /"):
                attributes = _attributes(m[3])
                words = _HINT_WORD.findall(f"{attributes.get('class', '')} {attributes.get('id', '')}")
                if _is_hidden(attributes) or any(w.lower() in INLINE_HINTS for w in words):
                    skipped = (tag, 1, len(stack))
            continue
        attributes = _attributes(m[3]) if m[3].strip(" /") else {}
        if tag in ("html", "body") and (tag in (page.tags[i] for i in stack) or (tag == "html" and len(page.tags) > 1)):
            continue
        if page.tags[stack[-1]] == "head" and tag not in HEAD:
            close(len(stack) - 1)
        if page.tags[stack[-1]] == "p" and tag in CLOSES_P or page.tags[stack[-1]] in HEADINGS and tag in HEADINGS:
            close(len(stack) - 1)
        if tag in SAME:
            same, holder = SAME[tag]
            for height in range(len(stack) - 1, 0, -1):
                name = page.tags[stack[height]]
                if name in same:
                    close(height)
                    break
                if name in holder:
                    break
        flush()
        if tag == "hr":
            continue
        stack.append(page.add(tag, stack[-1], attributes, _is_hidden(attributes) or bool(skipped[0])))
    flush()
    return page


def unseen(page: Page) -> list[bool]:
    """For each element whether it or one that holds it is never shown as text."""
    out = [False] * len(page.tags)
    for i in range(1, len(out)):
        out[i] = out[page.parents[i]] or page.hidden[i] or page.tags[i] in TECHNICAL
    return out


def set_aside(page: Page) -> list[bool]:
    """For each element whether it or one that holds it isn't main text by what it is or is called: menus, headers, footers, sidebars, notices,
    adverts, forms, comments, hidden and technical elements. One that is only called so, or a form, stays if it holds the article or most of the page's text."""
    n = len(page.tags)
    size = page.sums()
    most = size[0] / 2
    named = [page.hints[i] & HINTS or "role" in page.hints[i] for i in range(n)]
    article = [False] * n  # holds an article or main element that isn't a comment
    inside = [False] * n
    for i in range(n - 1, 0, -1):
        article[i] |= page.content[i] and not (named[i] and page.hints[i] & COMMENTS)
        article[page.parents[i]] |= article[i]
    out = [False] * n
    for i in range(1, n):
        up, tag, hints = page.parents[i], page.tags[i], page.hints[i]
        inside[i] = inside[up] or page.content[i]
        if out[up] or page.hidden[i] or tag in GONE:
            out[i] = True
        elif tag in ("html", "body"):
            pass
        elif tag == "form":
            out[i] = not article[i] and size[i] <= most
        elif hints & COMMENTS:
            out[i] = not (hints & PART_OF_ARTICLE and size[i] > most) and not (article[i] and size[i] > most)
        elif tag == "header" or (hints & HEADER_HINTS and not hints & PART_OF_ARTICLE):
            out[i] = not inside[up] and not article[i] and (tag == "header" or size[i] <= most)
        elif named[i]:
            out[i] = not article[i] and size[i] <= most
    return out
