"""Main-text extraction by tree scoring.

Every block's own text is a paragraph. It earns points for its length and commas and passes
them to its ancestors, less with every step up; a container's sum is discounted by its share
of link text. The article or main element around the best container is kept; where there is
none, the best container and all other text of the page but containers mostly of links.
Menus, sidebars, notices, adverts, forms, scripts, styles and reader comments are removed:
by tag, role or the hidden attribute first; by whole class names and ids, and forms, after
scoring, where they lower the score. These stay if they hold an article or main element or
the best container; names that often stand on real text go only if short or full of links.

Character references are decoded, white space inside a block becomes one space, blocks are
joined in page order by one space. Null, empty and text-free pages give an empty string.
Broken markup is read leniently: unclosed and stray tags, unclosed comments and scripts.
Other columns of the input are ignored.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrisk.llm.common import map_slices, table, texts

# HTML element classes.
# No tags are read inside RAW; SKIP elements go from the start tag to their own end tag, nested ones with them.
RAW = "script style noscript textarea title iframe".split()
SKIP = "template svg object select audio video canvas".split()
DROP = set("nav footer aside button input dialog menu".split())
# Blocks that are parts of a container.
PARTS = set("p pre li dt dd td th tr tbody thead tfoot caption h1 h2 h3 h4 h5 h6 br hr summary figcaption".split())
VOID = set("area base br col embed hr img input link meta source track wbr".split())
BLOCKS = set("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul br caption""".split())
# An open paragraph or item ends where one of these begins.
ENDS_P = BLOCKS - {"br", "html", "body"}
SAME_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"ul", "ol", "dl", "table", "article", "section", "div", "body", "main", "td", "th", "blockquote"}
_SURE = (r"ads?|adverts?|advertisements?|sponsored|cookies?|consent|gdpr|popup|navbar|navigation|breadcrumbs?|sidebar|masthead|"
         r"comments?|comment-list|disqus|replies|respond|newsletter|pagination|pager|toolbar")
_OFTEN = (r"sponsor|promo(?:tion)?|banner|notice|modal|overlay|nav|menu|side|widget|footer|foot|related|recommended|share|sharing|"
          r"social|subscribe|signup|login")
# A whole class name or id.
BAD_NAME = re.compile(
    rf"(?:(?:site|page|post|entry|main|top|left|right|social|cookie|user|reader)[_-])??(?:(?P<sure>{_SURE})|{_OFTEN})"
    r"(?:[_-](?:area|bar|box|banner|buttons?|consent|form|icons?|items?|links?|list|notice|posts?|slot|unit|\d+))?", re.I)
NEVER_BAD = {"html", "body", "article", "main", "h1", "h2", "h3", "h4", "h5", "h6"}
SHORT = 200
LITTLE = 80
BAD_ROLE = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "form", "menu", "menubar"}

_ATTRS = r"""(?:[^>"']|"[^"]*"|'[^']*')*+"""
TOKEN = re.compile(
    rf"""<!--(?:.*?-->|.*)|<(?P<close>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>{_ATTRS})>|</?[a-z][^>]*>|<[!?/][^>]*>""", re.I | re.S)
RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in RAW}
SKIPPED = {t: re.compile(rf"""<!--.*?-->|<(?P<close>/?){t}(?=[\s/>])(?P<attrs>{_ATTRS})>""", re.I | re.S) for t in SKIP}
ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "up", "score", "chars", "links", "order", "dropped", "suspect", "holds", "mark", "blocks")

    def __init__(self, tag: str, up: Node | None, order: int, dropped: bool, suspect: int = 0):
        self.tag, self.up, self.order, self.dropped, self.suspect = tag, up, order, dropped, suspect
        self.score, self.chars, self.links = 0.0, 0, 0
        self.holds, self.mark = False, (0, 0, 0)
        self.blocks: list[int] = []


def signs(tag: str, attrs: str, in_article: bool) -> tuple[bool, int]:
    """Whether an element is removed at once, and how suspect it is: 0, 1 (goes if short or full of links), 2 or, by a sure name, 3."""
    if tag in DROP or tag == "header" and not in_article:
        return True, 0
    suspect, seen = 2 if tag == "form" else 0, set()
    for name, *values in ATTR.findall(attrs) if attrs else ():
        name, value = name.lower(), next((v for v in values if v), "")
        if name in seen:
            continue
        seen.add(name)
        if name in ("class", "id") and tag not in NEVER_BAD:
            for word in value.split():
                if m := BAD_NAME.fullmatch(word):
                    suspect = max(suspect, 3 if m["sure"] else 1)
        elif tag in ("html", "body", "article", "main"):
            continue
        elif name == "role" and value.lower() in BAD_ROLE or name == "hidden" and value.lower() != "until-found" or name == "aria-hidden" and value.lower() == "true":
            return True, 0
    return False, suspect


def spans(html: str, tag: str) -> dict[int, int]:
    """End of every element of one kind that has its own end tag, by the end of its start tag."""
    found, opened = {}, []
    for m in SKIPPED[tag].finditer(html):
        if m["close"] is None:
            continue
        if m["close"]:
            if opened:
                found[opened.pop()] = m.end()
        elif not m["attrs"].endswith("/"):
            opened.append(m.end())
    return found


def parse(html: str) -> tuple[list[Node], list[tuple[Node, str, int]]]:
    """All kept elements in page order and all kept blocks: (element, text, characters in links)."""
    root = Node("html", None, 0, False)
    nodes, blocks = [root], []
    stack = [root]
    text: list[str] = []
    linked, in_link, articles, flushes = 0, 0, 0, 0

    def flush():
        nonlocal linked, flushes
        flushes += 1
        if text:
            t = SPACE.sub(" ", unescape("".join(text))).strip()
            if t:
                at = stack[-1]
                while at.tag not in BLOCKS:
                    at = at.up
                blocks.append((at, t, min(linked, len(t))))
            text.clear()
        linked = 0

    def close(k: int):
        """Pop the stack down to (and with) position k."""
        nonlocal in_link, articles
        flush()
        for x in stack[k:]:
            in_link -= x.tag == "a"
            articles -= x.tag in ("article", "main")
        del stack[k:]

    def words(piece: str):
        nonlocal linked
        if piece and not stack[-1].dropped:
            text.append(piece)
            if in_link:
                linked += len(piece.strip())

    def drop_inline(x: Node):
        """Take back the text of a suspect inline element that began in this block, under the rules for blocks."""
        nonlocal linked
        pieces, links, n = x.mark
        if x.suspect and n == flushes:
            size = len("".join(text[pieces:]))
            if x.suspect == 2 or size < SHORT or 2 * (linked - links) > size:
                del text[pieces:]
                linked = links

    at = 0
    ends: dict[str, dict[int, int]] = {}  # of SKIP elements
    open_ended: set[str] = set()  # RAW elements without an end tag in the rest of the page
    while m := TOKEN.search(html, at):
        words(html[at:m.start()])
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag or tag == "head":  # what is shown in a head belongs to the body
            continue
        if tag in RAW_END:
            if not m["close"]:
                end = None if tag in open_ended else RAW_END[tag].search(html, at)
                if end:
                    at = end.end()
                elif tag in ("script", "style"):
                    at = len(html)
                else:  # without an end tag, up to the next tag
                    open_ended.add(tag)
                    after = html.find("<", at)
                    at = after if after >= 0 else len(html)
            continue
        if tag in SKIPPED:
            if not m["close"]:
                if tag not in ends:
                    ends[tag] = spans(html, tag)
                at = ends[tag].get(at, at)
            continue
        if m["close"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    if tag in BLOCKS:
                        close(k)
                    else:  # an inline end tag closes only inline elements above it
                        if all(x.tag not in BLOCKS for x in stack[k:]):
                            drop_inline(stack[k])
                            in_link -= sum(x.tag == "a" for x in stack[k:])
                            del stack[k:]
                    break
                if stack[k].tag in SCOPES and tag not in BLOCKS:
                    break
            else:
                if tag in BLOCKS:
                    flush()
            continue
        if tag in BLOCKS:
            flush()
        if tag in ENDS_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    close(k)
                    break
                if stack[k].tag in SCOPES:
                    break
        if tag in SAME_ENDS:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in SAME_ENDS[tag]:
                    close(k)
                    break
                if stack[k].tag in ("ul", "ol", "dl", "table"):
                    break
        if tag in VOID or (m["attrs"] or "").endswith("/") and tag not in BLOCKS:
            continue
        gone, suspect = signs(tag, m["attrs"], articles > 0)
        node = Node(tag, stack[-1], len(nodes), stack[-1].dropped or gone, suspect)
        node.mark = len(text), linked, flushes
        if node.dropped and not stack[-1].dropped:
            flush()
        if tag in BLOCKS and not node.dropped:
            nodes.append(node)
        stack.append(node)
        in_link += tag == "a"
        articles += tag in ("article", "main")
    words(html[at:])
    close(1)
    flush()
    return nodes, blocks


def hold(n: Node | None) -> None:
    """Mark an element and all around it as not to be removed for their names."""
    while n is not None and not n.holds:
        n.holds = True
        n = n.up


def extract(html: str) -> str:
    """The main text of a page."""
    nodes, blocks = parse(html)
    if not blocks:
        return ""
    for n in nodes:
        if n.tag in ("article", "main"):
            hold(n)

    def is_suspect(n):
        while n is not None:
            if n.suspect and not n.holds and n.tag in BLOCKS:
                return True
            n = n.up
        return False

    def named(n):
        """Inside an element that is surely no main text by its name, such as comments or a cookie notice."""
        while n is not None:
            if n.suspect == 3 and not n.holds and n.tag in BLOCKS:
                return True
            n = n.up
        return False

    clean = 0
    for k, (own, t, linked) in enumerate(blocks):
        own.blocks.append(k)
        clean += 0 if named(own) else len(t)
        points = (1.0 + t.count(",") + min(len(t) / 100.0, 3.0)) * (0.2 if is_suspect(own) else 1.0)
        step, node = 0, own if own.tag not in ("p", "br", "li", "td", "th", "pre") and not own.tag.startswith("h") or own.up is None else own.up
        while node is not None:
            if step < 4:
                node.score += points * (1 - linked / len(t)) / (1, 2, 4, 8)[step]
            node.chars += len(t)
            node.links += linked
            step, node = step + 1, node.up
    worth = lambda n: n.score * (1 - n.links / max(n.chars, 1))
    # However long it is, such an element isn't the best container, unless the page has hardly any other text.
    choice = [n for n in nodes if not named(n)] if clean >= LITTLE else nodes
    best = max(choice, key=lambda n: (worth(n), -n.order))
    hold(best)
    # An article element around the best container is its natural bound.
    top = best
    while top is not None and top.tag not in ("article", "main"):
        top = top.up
    whole = top or best
    around: set[Node] = set()  # without an article element, the rest of the page is judged by its links
    n = best.up if top is None else None
    while n is not None:
        around.add(n)
        n = n.up

    def inside(n):
        found, group = False, None  # the smallest container of this text that the best one is not in
        while n is not None:
            if n.suspect and not n.holds and n.tag in BLOCKS and (n.suspect >= 2 or n.chars < SHORT or 2 * n.links > n.chars):
                return False
            if n is whole:
                found = True
            elif n not in around and (group is None or group.tag in PARTS):
                group = n if n.tag in BLOCKS else group
            n = n.up
        return found or bool(around) and (group is None or 2 * group.links <= group.chars)

    known: dict[Node, bool] = {}
    out = []
    for own, t, linked in blocks:
        if own not in known:
            known[own] = inside(own)
        if known[own] and (own not in around or 2 * linked <= len(t)):
            out.append(t)
    return " ".join(out)


def extract_pages(df: DataFrame, keep: list[str], html_col: str = "html") -> DataFrame:
    """``keep`` columns plus text and n_chars (code points)."""
    src = df.select(*keep, F.col(html_col).cast("string").alias("_html"))
    schema = df.select(*keep, F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema

    def run(b):
        got = [extract(h) if h else "" for h in texts(b, "_html")]
        return pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(got, pa.string()), pa.array([len(t) for t in got], pa.int64())],
                                          names=[*b.schema.names[:-1], "text", "n_chars"])

    return map_slices(src, run, schema, "_html")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_pages(table(spark, sf_dir, "pages"), ["page_id", "url"])
