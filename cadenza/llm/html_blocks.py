"""A page's visible text as blocks, each with the zone its markup puts it in."""

from __future__ import annotations

import re
from html import unescape

OPEN, MAIN, CHROME = 0, 1, 2  # not marked; inside an article; menu, footer, advert ...
_BODY = 3  # in the main part of a page, around or without an article
DOUBT = 4  # inside an article, under a class that holds a word of chrome among others

# one alternative per kind of markup; possessive, so that broken markup stays linear
_MARKUP = (
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<(?P<raw>script|style|title|textarea|noscript|template|iframe|xmp|noembed)"
    r"(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?:%s>.*?(?:</(?P=raw)(?=[\s/>])[^>]*+>|\Z))"
    r"|<(?P<close>/?)(?P<name>[a-z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[a-z/!?][^>]*+(?:>|\Z)"
    r"|(?P<text>[^<]++|<)")
_TOKEN = re.compile(_MARKUP % "", re.S | re.I)
_FOREIGN_TOKEN = re.compile(_MARKUP % "(?<=/)>|", re.S | re.I)  # in svg and math "/>" ends raw elements too
_ATTR = re.compile(r"(?:^|[\s/\"'])(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))",
                   re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

# fixed values: HTML element groups
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark "
                    "q ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param "
                  "source track wbr".split())
_ENDS_PARAGRAPH = frozenset("address article aside blockquote center details dialog dir div dl "
                            "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr "
                            "main menu nav ol p pre section table ul".split())
# svg and math: what stays inside a line, what holds HTML, what shows that the end tag is missing
_FOREIGN = ("svg", "math")
_LEFT_OUT = ("svg", "object", "annotation", "annotation-xml")
_IN_LINE = _INLINE.union(_FOREIGN, _LEFT_OUT, (
    "mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose "
    "msub msup msubsup munder mover munderover mmultiscripts mprescripts none maction semantics").split())
_HOLDS_HTML = frozenset("foreignobject desc mi mn mo ms mtext annotation-xml".split())
_BREAKS_OUT = _ENDS_PARAGRAPH.union("b big body br code dd dt em embed head i img li listing meta nobr ruby s "
                                    "small span strong strike sub sup tt u var".split())
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
             "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_LISTS = frozenset("ul ol dl table select menu".split())
_IN_HEAD = frozenset("base basefont bgsound link meta noscript script style template title".split())
# what the contract leaves out, by element, by role and by a word of class or id
_CHROME_TAGS = frozenset("nav footer aside form button select datalist dialog menu head label "
                         "legend audio video canvas map applet marquee".split())
_CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert "
                          "alertdialog menu menubar toolbar note status tablist".split())
_CHROME_WORDS = frozenset("nav navbar navigation menu menus submenu breadcrumb breadcrumbs footer "
                          "masthead topbar sidebar sidebars rail widget widgets related recommended "
                          "promo promos promotion ad ads advert adverts advertisement advertising "
                          "advertorial banner banners sponsor sponsored cookie cookies consent gdpr "
                          "notice notices alert alerts popup modal overlay lightbox newsletter "
                          "subscribe subscription signup signin login share sharing social comment "
                          "comments commentlist disqus reply replies respond pagination pager toolbar "
                          "skip copyright disclaimer outbrain taboola adsense".split())
# words beside one of chrome that leave it chrome: the kinds of boxes and their places
_BOX_WORDS = frozenset("area bar block body box btn button buttons col container content form group head "
                       "header heading icons inner inline item items left link links list main panel post "
                       "posts right row section slot space text title top bottom unit wrap wrapper".split())
_MAIN_IDS = frozenset(("articlebody", "article-body", "article-content", "post-content", "post-body",
                       "entry-content", "story-body"))
_BODY_IDS = frozenset(("main-content",))


def _words(value: str):
    for token in value.split():
        words = [w.lower() for w in _WORD.findall(token)]
        if words and words[0] not in ("no", "with", "without", "has", "is", "not"):
            yield token.lower(), words


def _zone(name: str, attrs: str, around: int) -> int:
    """Zone of an element; chrome holds whatever is inside it.

    Inside an article a class or id is chrome if all its words are (or name a box,
    as in ``ad-slot``); one word of chrome among others (``share-price``) is a doubt.
    A label is chrome with its form there, not by itself.
    """
    inside = around in (MAIN, DOUBT)
    if around == CHROME or name in _CHROME_TAGS and not (inside and name == "label"):
        return CHROME
    if name == "header" and around == OPEN:
        return CHROME
    main, body, doubt = name == "article", name == "main", around == DOUBT
    if attrs and "=" in attrs and name not in ("html", "body"):
        for key, *values in _ATTR.findall(attrs):
            value = unescape(next(filter(None, values), ""))
            if key.lower() == "role":
                roles = value.lower().split()
                if _CHROME_ROLES.intersection(roles):
                    return CHROME
                main = main or "article" in roles
                body = body or "main" in roles
            elif key.lower() == "itemprop":
                main = main or value.lower() == "articlebody"
            else:
                for token, words in _words(value):
                    if _CHROME_WORDS.intersection(words):
                        if not inside or all(w in _CHROME_WORDS or w in _BOX_WORDS or w.isdigit()
                                             for w in words):
                            return CHROME
                        doubt = True
                    if words[-1] == "header" and around == OPEN and not main and not body:
                        return CHROME
                    main = main or token in _MAIN_IDS
                    body = body or token in _BODY_IDS
    if doubt:
        return DOUBT
    return MAIN if main else _BODY if body and around == OPEN else around


def blocks(html: str, main: int = MAIN) -> list[tuple[int, str]]:
    """(zone, text) of every non-empty block in page order.

    ``main`` is the zone of what <main> (or role main, class or id main-content)
    holds outside articles.
    Comments, scripts, styles, titles and other raw elements are left out, as are
    drawings (svg), objects and the annotations of formulas; the text of formulas
    (math) stays. A head without an end tag ends where its content does. References are decoded, white space inside a block becomes one space.
    """
    out: list[tuple[int, str]] = []
    parts: list[str] = []
    # open elements that are not void: name, zone, place of the svg or math around or -1, left out
    stack: list[tuple[str, int, int, bool]] = []
    outside = ("", OPEN, -1, False)
    top = outside

    def flush():
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append((main if top[1] == _BODY else top[1], text))
            parts.clear()

    at, size = 0, len(html)
    while at < size:
        token = (_TOKEN if top[2] < 0 else _FOREIGN_TOKEN).match(html, at)
        at = token.end()
        text = token["text"]
        if text is not None:
            if top[0] == "head" and not text.isspace():
                flush()
                stack.pop()
                top = stack[-1] if stack else outside
            if not top[3]:
                parts.append(unescape(text) if "&" in text else text)
            continue
        name = token["name"]
        if name is None:
            continue
        name = name.lower()
        if top[0] == "head" and not token["close"] and name not in _IN_HEAD:
            flush()
            stack.pop()
            top = stack[-1] if stack else outside
        if top[2] >= 0 and (name == "p" if token["close"] else name in _BREAKS_OUT):
            inner = top[1]
            around = stack[top[2] - 1] if top[2] else outside
            if inner != around[1]:
                flush()
            del stack[top[2]:]
            top = around
        inline = name in _INLINE
        if name not in _IN_LINE and not top[3]:
            flush()
        if token["close"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    flush() if stack[k][1] != (stack[k - 1][1] if k else OPEN) else None
                    del stack[k:]
                    break
                if (inline or name == "p") and stack[k][0] not in _INLINE and stack[k][0] != "p" \
                        and stack[k][2] < 0:
                    break  # an inline end does not close the blocks around it
        else:
            if name in _ENDS_PARAGRAPH:
                k = len(stack) - 1
                while k >= 0 and stack[k][0] in _INLINE:
                    k -= 1
                if k >= 0 and stack[k][0] == "p":
                    del stack[k:]
            elif name in _SIBLINGS:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in _SIBLINGS[name]:
                        del stack[k:]
                        break
                    if stack[k][0] in _LISTS or stack[k][0] in ("div", "object"):
                        break
            _, around, foreign, left_out = stack[-1] if stack else outside
            left_out = left_out or name in _LEFT_OUT
            own = around if left_out else _zone(name, token["attrs"], around)
            if own != around:
                flush()
            if name not in _VOID and not token["attrs"].endswith("/"):
                if foreign >= 0:
                    foreign = -1 if name in _HOLDS_HTML else foreign
                elif name in _FOREIGN:
                    foreign = len(stack)
                stack.append((name, own, foreign, left_out))
        top = stack[-1] if stack else outside
    flush()
    return out
