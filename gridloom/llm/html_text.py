"""Main text of HTML pages by tree scoring.

Every paragraph passes points for its length and commas to its ancestors, less the farther up; a container's points are
discounted by the share of link text in it. The best container and those siblings and cousins that score alike are kept, with headings,
lists and short paragraphs next to them, without menus, forms, adverts and the like inside them. Names judge late: an element goes by its
class or id, or as a form, only if the page's prose is elsewhere. A page is one row: no shuffle, memory bounded by the largest page, time
in proportion to its length however deep its tags are nested.
"""

import heapq
import re
from collections import Counter, defaultdict, deque
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import functions as F

from gridloom.llm.common import read, slices

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rb rp rt s samp small "
    "span strike strong sub sup time tt u var wbr button "
    "math merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext "
    "mtr munder munderover semantics".split())
#: Start tags that end an open paragraph.
CLOSE_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre search section table ul".split())
#: Start tag -> open tags that it ends, up to a tag in the second set.
CLOSE_SAME = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"}),
}

#: Elements that never hold main text.
DROPPED = frozenset(
    "head script style noscript template iframe object embed applet svg canvas audio video map nav footer aside menu "
    "select textarea input label fieldset dialog search annotation annotation-xml".split())
#: What a dropped element leaves: nothing, or a space where it had a place in its line; others end a block.
LEAVES = dict.fromkeys("script style noscript template annotation annotation-xml".split(), "") | dict.fromkeys(
    "iframe object embed applet svg canvas audio video map select textarea input label".split(), " ")
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
#: Words in class and id of what is not main text.
NOT_MAIN = frozenset(
    "ad ads adbox advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments cookie cookies "
    "consent disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices overlay pager pagination "
    "popup promo promoted promotion recommended related replies respond reply share sharing sidebar signup skip social sponsor "
    "sponsored subscribe subscription tagcloud toc toolbar widget widgets".split())
#: Words that turn the meaning of a name around: no-sidebar, has-comments, ad-free.
TURNED = frozenset("no non not without has with free hide hidden disable disabled is".split())
MAIN_WORDS = frozenset("article body content entry hentry main page post story text".split())
BASE = {"article": 25, "main": 25, "section": 5, "div": 5, "pre": 3, "td": 3, "blockquote": 3, "ul": -3, "ol": -3, "dl": -3}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Small blocks that belong to the container they stand next to.
BESIDE = HEADINGS | frozenset("p pre blockquote ul ol dl figure hr table".split()) | INLINE
#: Length in code points from which a block counts as prose.
PROSE = 80
#: Blocks of running text, where a button can be a word of a sentence.
SENTENCES = HEADINGS | frozenset("p li td th dd dt blockquote figcaption caption".split())
NO_CONTAINER = frozenset("p h1 h2 h3 h4 h5 h6 li tr tbody thead tfoot".split()) | INLINE
WORDS = re.compile(r"[a-z]+")
COMMENT_END, COMMENT_CLOSE = re.compile(r"-?>"), re.compile(r"--!?>")


class Node:
    __slots__ = ("tag", "parent", "parts", "names", "mark", "points", "length", "links", "own", "prose", "long", "holds", "depth", "article", "block")

    def __init__(self, tag, parent, names, mark=None):
        self.depth = parent.depth + 1 if parent else 0
        self.article = tag in ("article", "main") or parent is not None and parent.article
        self.block = parent.block if tag in INLINE else self
        self.tag, self.parent, self.names, self.mark, self.parts = tag, parent, names, mark, []
        self.points = self.length = self.links = self.prose = 0
        self.own, self.long, self.holds = (), False, tag in ("article", "main")


def mark_of(tokens):
    """'whole' if a class or id is a word of NOT_MAIN, 'part' if one has such a word among others, else None."""
    if not NOT_MAIN.isdisjoint(tokens):
        return "whole"
    parts = [set(WORDS.findall(t)) for t in tokens]
    return "part" if any(p & NOT_MAIN and not p & TURNED for p in parts) else None


class Tree(HTMLParser):
    """Builds the element tree, without what never holds main text. Unclosed and stray tags are mended as browsers do."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.open = Node("html", None, frozenset())
        self.nodes = [self.root]
        self.path, self.places = [self.root], defaultdict(list, html=[self.root])  # open nodes, also by tag
        self.skipped, self.skipping = [], Counter()  # open elements inside a dropped one

    def _open(self, node):
        self.open = node
        self.path.append(node)
        self.places[node.tag].append(node)

    def _close(self, node):
        """Closes a node and all that is open in it."""
        while len(self.path) > node.depth:
            self.places[self.path.pop().tag].pop()
        self.open = node.parent

    def _skip(self, tag):
        self.skipped.append(tag)
        self.skipping[tag] += 1

    def parse_comment(self, i, report=1):
        """A comment without an end goes to the end of the page, as in browsers."""
        end = COMMENT_END.match(self.rawdata, i + 4) or COMMENT_CLOSE.search(self.rawdata, i + 4)
        return end.end() if end else len(self.rawdata)

    def _names(self, attrs):
        """Words of class and id and their mark; None if the element is dropped because of its other attributes."""
        names, tokens = set(), set()
        for key, value in attrs:
            value = (value or "").lower()
            if key in ("class", "id"):
                names.update(WORDS.findall(value))
                tokens.update(value.split())
            elif key == "role" and value in ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
                return None
            elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return None
        return frozenset(names), mark_of(tokens)

    def _inside(self, tags):
        """The innermost open node with one of the tags."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), key=lambda node: node.depth, default=None)

    def handle_starttag(self, tag, attrs):
        if self.skipped:
            if tag not in VOID and not (tag in CLOSE_SAME and self.skipping[tag]):
                if not (tag in ("p", "li", "option", "td", "tr") and self.skipped[-1] == tag):
                    self._skip(tag)
            return
        if tag in ("html", "body") and self._inside({"body"}):
            return
        self._close_implied(tag)
        names = self._names(attrs)
        dropped = tag in DROPPED or names is None or tag == "header" and not self._inside({"article", "main"})
        if tag in VOID:
            if tag == "br":
                self.open.parts.append(" ")
            return
        if dropped:
            self._skip(tag)
            self.open.parts.append(LEAVES.get(tag, "\n" if tag not in INLINE else ""))
            return
        if tag == "html":
            return
        node = Node(tag, self.open, *names)
        if tag == "form":
            node.mark = "whole"
        self.open.parts.append(node)
        self.nodes.append(node)
        self._open(node)

    def _close_implied(self, tag):
        if tag in CLOSE_P and (p := self._inside(("p", "table", "body"))) is not None and p.tag == "p":
            self._close(p)
        if tag in CLOSE_SAME:
            same, stop = CLOSE_SAME[tag]
            node = self._inside(same | stop)
            while node is not None and node.tag in same:
                self._close(node)
                node = self._inside(same | stop)

    def handle_endtag(self, tag):
        if self.skipped:
            if self.skipping[tag]:
                while True:
                    last = self.skipped.pop()
                    self.skipping[last] -= 1
                    if last == tag:
                        break
            elif tag in ("body", "html"):
                self.skipped.clear()
                self.skipping.clear()
            return
        if tag == "br":
            self.open.parts.append(" ")
        elif tag not in ("html", "body"):
            node = self._inside((tag,))
            if node is not None and node is not self.root:
                self._close(node)

    def handle_data(self, data):
        if not self.skipped:
            self.open.parts.append(data)


def _own_blocks(node):
    """Texts of a node that are not in a block below it, in order; inline elements count as the node's own."""
    out, held = [], []

    def flush():
        text = " ".join("".join(held).split())
        if text:
            out.append(text)
        held.clear()

    stack = [iter(node.parts)]
    while stack:
        for part in stack[-1]:
            if isinstance(part, str):
                if part == "\n":
                    flush()
                held.append(part)
            elif part.tag in INLINE:
                stack.append(iter(part.parts))
                break
            else:
                flush()
        else:
            stack.pop()
    flush()
    return out


def _weigh(tree):
    """Length, link text, points of paragraphs and what else is known of an element and all below it."""
    for node in reversed(tree.nodes):  # children stand behind their parents
        node.length += sum(len(p.strip()) for p in node.parts if isinstance(p, str))
        if node.tag == "a":
            node.links = node.length
        if node.tag not in INLINE or node is tree.root:
            blocks = _own_blocks(node)
            node.own = [1 + text.count(",") + min(len(text) / 100, 3) for text in blocks]
            node.prose += sum(node.own)
            node.long = node.long or 2 * node.links < node.length and any(len(text) > PROSE for text in blocks)
        up = node.parent
        if up is not None:
            up.length += node.length
            up.links += node.links
            up.prose += node.prose
            up.long, up.holds = up.long or node.long, up.holds or node.holds


def _in_sentence(button):
    """Whether a button is a smaller part of a block of running text."""
    return button.block.tag in SENTENCES and 2 * button.length < button.block.length


def _unnamed(tree):
    """Takes out forms, buttons outside sentences and the elements that their class or id calls no main text.

    A form, or one named so by a whole class, stays if it holds an article or main, or prose that outweighs fourfold what is left
    without it; one with such a word among others goes only if it is mostly links and has no prose.
    """
    def judged(node):
        if node.tag == "button" and not _in_sentence(node):
            return True
        if node.mark is None or node.holds or node.tag in ("html", "body"):
            return False
        if node.mark == "part":
            return 2 * node.links > node.length and not node.long
        # as with the element header: inside an article it has its heading
        return not (node.article and "header" in node.names and not node.names & (NOT_MAIN - {"header"}))

    def outermost(node):
        found, stack = [], [node]
        while stack:
            for part in stack.pop().parts:
                if isinstance(part, Node):
                    (found if judged(part) else stack).append(part)
        return found

    rest, out, long = tree.root.prose, {}, []

    def take(nodes):
        nonlocal rest
        for n in nodes:
            rest -= n.prose
            out[n] = True
            if n.long and n.tag != "button":
                heapq.heappush(long, (-n.prose, len(out), n.depth, id(n), n))

    take(outermost(tree.root))
    while long and long[0][-1].prose > 4 * rest:
        best = heapq.heappop(long)[-1]
        del out[best]
        rest += best.prose
        take(outermost(best))
    if not out:
        return
    gone, stack = set(out), list(out)
    for up in {n.parent for n in out}:
        up.parts = [p if isinstance(p, str) or p not in gone else " " if p.tag in INLINE else "\n" for p in up.parts]
    while stack:
        node = stack.pop()
        gone.add(node)
        stack += [p for p in node.parts if isinstance(p, Node)]
    tree.nodes = [n for n in tree.nodes if n not in gone]
    for node in tree.nodes:
        node.length = node.links = node.prose = 0
        node.long, node.holds = False, node.tag in ("article", "main")
    _weigh(tree)


#: What is left of a paragraph's points in its container and those above it; the last holds for all farther ones.
LEVELS = (1, 2, 6, 9, 12)


def _score(tree):
    _weigh(tree)
    if any(n.mark or n.tag == "button" for n in tree.nodes):
        _unnamed(tree)
    below = defaultdict(lambda: [0.0] * len(LEVELS))  # points of paragraphs by their distance
    for node in tree.nodes:
        # a paragraph's container is its parent; bare text counts for the node it stands in
        if node.own:
            below[node.parent if node.tag in HEADINGS or node.tag in ("p", "pre", "blockquote", "li", "td", "dd") else node][0] += sum(node.own)
    for node in reversed(tree.nodes):
        mine = below.pop(node, None)
        if mine is not None:
            node.points = sum(points / share for points, share in zip(mine, LEVELS))
            if node.parent is not None:
                up = below[node.parent]
                for level, points in enumerate(mine):
                    up[min(level + 1, len(LEVELS) - 1)] += points


def _rank(node):
    density = node.links / node.length if node.length else 0.0
    bonus = BASE.get(node.tag, 0) + (25 if node.names & MAIN_WORDS else 0) - (25 if node.mark == "part" else 0)
    return round((node.points + (bonus if node.points else 0)) * (1 - density), 9)


def _blocks(node, parts=None):
    """All blocks at and below a node, or in some of its parts, in page order."""
    out, held, stack = [], [], [(node, iter(node.parts if parts is None else parts))]

    def flush():
        text = " ".join("".join(held).split())
        if text:
            out.append(text)
        held.clear()

    while stack:
        now, parts = stack[-1]
        for part in parts:
            if isinstance(part, str):
                if part == "\n":
                    flush()
                held.append(part)
            else:
                if part.tag not in INLINE:
                    flush()
                stack.append((part, iter(part.parts)))
                break
        else:
            if now.tag not in INLINE:
                flush()
            stack.pop()
    flush()
    return out


def main_text(html):
    """Blocks of the main text joined by line ends; '' for null, empty or text-free pages."""
    if not html:
        return ""
    tree = Tree()
    tree.feed(html)
    tree.close()
    _score(tree)
    containers = [n for n in tree.nodes if n.tag not in NO_CONTAINER]
    best = max(containers, key=_rank)
    if not best.points:
        return ""
    node = best
    while node is not None and node.tag not in ("article", "main"):
        node = node.parent
    whole, best = node is not None, node or best  # parts of one article stay together
    least = max(2.0, 0.2 * _rank(best))
    return "\n".join(_blocks(tree.root, _with_article(best, least) if whole else _with_neighbours(best, least)))


def _link(part):
    return part.links / part.length if part.length else 1.0


def _prose(part):
    return part.tag == "p" and _link(part) < 0.25 and part.length > PROSE


def _with_article(best, least):
    """An article and its siblings of one tag that score alike, with prose between them."""
    if best.parent is None:
        return [best]

    def main(part):
        return part is best or isinstance(part, Node) and (_prose(part) or part.tag == best.tag and _rank(part) >= least)

    return [part if main(part) else "\n" for part in best.parent.parts]


def _beside(part):
    if isinstance(part, str):
        return part != "\n"
    return part.tag in BESIDE and (_link(part) < 0.25 or not part.length or part.tag in HEADINGS)


def _alike(part, least):
    """The containers at and below a part that score enough by themselves, in page order.

    One that holds a better one is left for that, with the small blocks beside it.
    """
    found, stack = [], [(part, False)]
    while stack:
        node, within = stack.pop()
        if isinstance(node, str):
            found += [node] * within
            continue
        enough = node.tag not in NO_CONTAINER and _rank(node) >= least
        if enough and all(isinstance(p, str) or p.tag in NO_CONTAINER or _rank(p) <= _rank(node) for p in node.parts):
            found.append(node)
        elif within and not enough and _beside(node):
            found.append(node)
        else:
            found.append("\n")
            stack.append(("\n", True))
            stack.extend((p, enough) for p in reversed(node.parts))
    return found if any(isinstance(p, Node) for p in found) else []


def _with_neighbours(best, least):
    """A container with those beside and around it that score alike, prose and small blocks beside it and headings around it."""
    def heading(part):
        return isinstance(part, Node) and part.tag in HEADINGS or isinstance(part, str) and not part.strip()

    parts, node, near_by = deque([best]), best, _beside
    while node.parent is not None:
        level = node.parent.parts
        at = next(i for i, part in enumerate(level) if part is node)
        kept = [[part] if near_by is _beside and isinstance(part, Node) and _prose(part) else _alike(part, least) for part in level[:at]]
        kept.append([node])
        kept += [[part] if near_by is _beside and isinstance(part, Node) and _prose(part) else _alike(part, least) for part in level[at + 1:]]
        # small blocks belong to what is kept before or behind them
        for order in (range(len(level)), reversed(range(len(level)))):
            near = False
            for i in order:
                near = bool(kept[i]) or near and near_by(level[i])
                if near and not kept[i]:
                    kept[i] = [level[i]]
        for found in reversed(kept[:at]):
            parts.extendleft(reversed(found or ["\n"]))
        for found in kept[at + 1:]:
            parts.extend(found or ["\n"])
        node, near_by = node.parent, heading
    return parts


def extract(pages, id_col="page_id", html_col="html", keep=("url",)):
    """id_col, the columns in keep, text and n_chars (code points) of every page.

    White space inside a block becomes one space, blocks are joined by one line end. Pages with null or empty html have
    an empty text. Repeated rows are extracted each; other columns are left out.
    """
    source = pages.select(F.col(id_col), *keep, F.col(html_col).cast("string").alias("__html"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])

    def run(batches):
        for part in slices(batches, "__html"):
            found = [main_text(x) for x in part.column("__html").to_pylist()]
            columns = [part.column(i) for i in range(part.num_columns - 1)]
            names = part.schema.names[:-1]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.string())], [*names, "__text"])

    out = source.mapInArrow(run, schema + ", `__text` string")
    return out.select(id_col, *keep, F.col("__text").alias("text"), F.length("__text").cast("long").alias("n_chars"))


def op7(spark, sf_dir):
    """Main text of all pages."""
    return extract(read(spark, sf_dir, "pages"))
