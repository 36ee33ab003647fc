"""Plain versions of the text operators, for small inputs."""

import collections
import hashlib
import re

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SPACE_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
PLAIN_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(data):
    return hashlib.sha256(data).hexdigest()


def contamination(docs, items, length=13):
    windows = collections.defaultdict(set)
    for item, text in items:
        w = PLAIN_WORD.findall((text or "").encode().translate(LOWER))
        for k in range(max(1, len(w) - length + 1) if w else 0):
            windows[tuple(w[k:k + length])].add(item)
    out = []
    for doc, text in docs:
        w = PLAIN_WORD.findall((text or "").encode().translate(LOWER))
        hit, found = [False] * len(w), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if tuple(w[k:k + size]) in windows:
                    found |= windows[tuple(w[k:k + size])]
                    hit[k:k + size] = [True] * size
        n = sum(hit)
        out.append((doc, len(w), n, len(found), sha(",".join(sorted(map(str, found))).encode()), n > 0 and 20 * n >= len(w)))
    return sorted(out)


def near_duplicates(docs, length=5, percent=75):
    sets = {}
    for doc, text in docs:
        w = SPACE_WORD.findall((text or "").encode().translate(LOWER))
        sets[doc] = frozenset(tuple(w[k:k + length]) for k in range(max(1, len(w) - length + 1))) if w else frozenset()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return sorted((d, len(sets[d]), find(d), find(d) == d) for d in ids)


def repeats(docs, length=50):
    words = [(doc, SPACE_WORD.findall((text or "").encode())) for doc, text in docs]
    first = {}
    for doc, w in words:
        for k in range(len(w) - length + 1):
            key = tuple(w[k:k + length])
            first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - length + 1):
            if first[tuple(w[k:k + length])] < doc:
                gone[k:k + length] = [True] * length
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((doc, len(w), len(w) - len(kept), b" ".join(kept).decode()))
    return sorted(out)


def jaccard(a, b):
    """Generalised Jaccard similarity of two texts' pairs of neighbouring words."""
    def terms(text):
        w = text.split()
        return collections.Counter(zip(w, w[1:]) if len(w) > 1 else w)
    a, b = terms(a), terms(b)
    larger = sum((a | b).values())
    return sum((a & b).values()) / larger if larger else 1.0


INLINE_TAGS = ("b", "a")
LEAF_TAGS = ("p", "h2", "li", "ul") + INLINE_TAGS


def markup(node):
    if isinstance(node, str):
        return node
    tag, parts = node
    return f"<{tag}>" + "".join(map(markup, parts)) + f"</{tag}>"


def scored_text(root):
    """Main text of a tree of (tag, parts) without names, articles and forms, by the definitions alone."""
    parent, nodes = {}, []

    def visit(node, up):
        parent[id(node)] = up
        nodes.append(node)
        for part in node[1]:
            if not isinstance(part, str):
                visit(part, node)

    visit(root, None)

    def length(node, links=False, inside=False):
        inside = inside or node[0] == "a"
        return sum((len(p.strip()) if inside or not links else 0) if isinstance(p, str) else length(p, links, inside) for p in node[1])

    def blocks(node, below):
        """Texts of a node in order; those of blocks below it too, or only the breaks that they make."""
        found = [""]

        def walk(now):
            for part in now[1]:
                if isinstance(part, str):
                    found[-1] += part
                elif part[0] in INLINE_TAGS:
                    walk(part)
                else:
                    found.append("")
                    if below:
                        walk(part)
                        found.append("")

        walk(node)
        return [" ".join(x.split()) for x in found if x.split()]

    points = collections.Counter()
    for node in nodes:
        if node[0] in INLINE_TAGS:
            continue
        for text in blocks(node, False):
            up, share = parent[id(node)] if node[0] in ("p", "h2", "li") else node, [1, 2, 6, 9]
            while up is not None:
                points[id(up)] += (1 + text.count(",") + min(len(text) / 100, 3)) / (share.pop(0) if share else 12)
                up = parent[id(up)]

    def density(node):
        return length(node, True) / length(node) if length(node) else 1.0

    def rank(node):
        bonus = {"div": 5, "section": 5, "ul": -3}.get(node[0], 0)
        return round((points[id(node)] + bonus) * (1 - density(node)), 9) if points[id(node)] else 0

    places = [n for n in nodes if n[0] not in ("p", "h2", "li") + INLINE_TAGS]
    best = max(places, key=rank)
    if not points[id(best)]:
        return ""
    least = max(2.0, 0.2 * rank(best))

    def small_block(part):
        return part[0] in LEAF_TAGS and part[0] != "li" and (part[0] == "h2" or not length(part) or density(part) < 0.25)

    def alike(part, within=False):
        if isinstance(part, str):
            return [part] if within else []
        enough = part in places and rank(part) >= least
        if enough and not any(p in places and rank(p) > rank(part) for p in part[1]):
            return [part]
        if within and not enough and small_block(part):
            return [part]
        kept = [alike(p, enough) for p in part[1]]
        if not any(k != [p] or not isinstance(p, str) for k, p in zip(kept, part[1]) if k):
            return []
        return [("div", [x for found in kept for x in found or [("hr", [])]])]

    def around(node, kept, first):
        up = parent[id(node)]
        if up is None:
            return kept
        out = []
        for part in up[1]:
            if part is node:
                out.append(kept)
            elif first and part[0] == "p" and not isinstance(part, str) and density(part) < 0.25 and length(part) > 80:
                out.append([part])
            else:
                out.append(alike(part))

        def small(part):
            if isinstance(part, str):
                return first or not part.strip()
            return part[0] == "h2" or first and small_block(part)

        had = [bool(x) for x in out]
        for i, part in enumerate(up[1]):
            before = any(had[j] and all(small(up[1][k]) for k in range(j + 1, i)) for j in range(i))
            behind = any(had[j] and all(small(up[1][k]) for k in range(i + 1, j)) for j in range(i + 1, len(had)))
            if not had[i]:
                out[i] = [part] if small(part) and (before or behind) else [("hr", [])]
        return around(up, [x for found in out for x in found], False)

    return "\n".join(blocks(("div", around(best, [best], True)), True))
