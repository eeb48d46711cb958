"""Main text of web pages by a tree-structured graphical model.

A page becomes a tree: block elements are inner nodes, runs of text between
block boundaries are leaves.  Every node has a state, content or not, with
evidence from its tag, class and id words, text length, links and punctuation;
every parent-child edge has a potential by the kind of child.  Sum-product
messages upward and downward give exact marginals; text runs with a marginal
of at least one half are the main text, in page order, one per line.

The model is trained by maximum likelihood on labelled pages
(``html_training.labelled_pages`` unless others are given).  With two states a
message is one log-odds number, and all pages of a chunk pass messages
together, one depth at a time.
"""

from __future__ import annotations

import html
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column

from fareflow.llm.common import text_udf
from fareflow.llm.html_training import labelled_pages
from fareflow.llm.quality import sigmoid

KEEP_AT = 0.5
FEATURES = 1 << 13
EPOCHS = 80

#: Fixed values of HTML: elements that start a block, without content, whose
#: content is no text of the page, and what a start tag closes.
BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol
optgroup option p pre section select summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style title textarea noscript iframe template svg math object canvas audio video".split())
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
          "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th blockquote pre figcaption caption".split())

_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<!--|<[!?][^>]*>""")
_ATTR = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+")
_KINDS = ("text", "paragraph", "container")


@dataclass
class Node:
    tag: str
    parent: int
    attrs: str = ""
    at: int = 0               # place in the page (text runs)
    parts: list[str] = field(default_factory=list)
    text: str = ""
    words: int = 0
    linked: int = 0
    kids: int = 0


def parse(page: str) -> list[Node]:
    """Nodes of a page in page order, the first is the root; parents come
    before children.  Text runs are nodes with tag ``#``."""
    nodes = [Node("html", -1)]
    stack: list[tuple[str, int]] = [("html", 0)]  # open blocks
    run, links = -1, 0
    closers: dict[str, re.Pattern] = {}

    def text(piece: str, at: int) -> None:
        nonlocal run
        if run < 0:
            if not piece or piece.isspace():
                return
            run = len(nodes)
            nodes.append(Node("#", stack[-1][1], at=at))
        nodes[run].parts.append(piece)
        if links:
            nodes[run].linked += len(piece)

    def close(depth: int) -> None:
        nonlocal run
        del stack[depth:]
        run = -1

    at, n = 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            text(page[at:], at)
            break
        if m.start() > at:
            text(page[at:m.start()], at)
        at = m.end()
        if m[0] == "<!--":
            end = page.find("-->", at)
            at = n if end < 0 else end + 3
            continue
        if not m[2]:
            continue
        name = m[2].lower()
        if m[1]:
            if name == "a":
                links = max(0, links - 1)
            elif name in BLOCKS:
                depth = next((d for d in range(len(stack) - 1, 0, -1) if stack[d][0] == name), 0)
                close(depth) if depth else None
            continue
        if name in SKIPPED:
            if m[3].rstrip().endswith("/") and name in ("svg", "math"):
                continue
            closer = closers.setdefault(name, re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE))
            end = closer.search(page, at)
            stop = page.find(">", end.end()) if end else -1
            at = n if stop < 0 else stop + 1
            continue
        if name == "br":
            text(" ", at)
        elif name == "a":
            links += 1
        elif name in ("html", "body", "head"):
            run = -1
        elif name in BLOCKS:
            if stack[-1][0] == "p":
                close(len(stack) - 1)
            if name in CLOSES:
                ends, scope = CLOSES[name]
                depth, low = len(stack) - 1, 0
                while depth > 0 and stack[depth][0] not in scope:
                    if stack[depth][0] in ends:
                        low = depth
                    depth -= 1
                close(low) if low else None
            run, links = -1, 0
            if name not in VOID:
                nodes.append(Node(name, stack[-1][1], m[3] if "=" in m[3] else "", at))
                stack.append((name, len(nodes) - 1))
    for node in nodes:
        if node.tag == "#":
            node.text = " ".join(html.unescape("".join(node.parts)).split())
            node.words = node.text.count(" ") + 1 if node.text else 0
    return nodes


_ids: dict[str, int] = {}


def _id(name: str) -> int:
    if name not in _ids:
        if len(_ids) > 200_000:
            _ids.clear()
        _ids[name] = zlib.crc32(name.encode("utf-8", "surrogatepass")) % FEATURES
    return _ids[name]


def _bucket(n: int, top: int) -> int:
    return min(n.bit_length(), top)


def node_features(nodes: list[Node]) -> list[list[int]]:
    """Hashed features of each node."""
    total, linked, below, longest = ([0] * len(nodes) for _ in range(4))
    for i in range(len(nodes) - 1, 0, -1):
        node = nodes[i]
        if node.tag == "#":
            total[i], linked[i] = len(node.text), min(node.linked, len(node.text))
            longest[i] = total[i]
        elif node.tag in PARAGRAPHS:
            below[i] += 1
        p = node.parent
        total[p] += total[i]
        linked[p] += linked[i]
        below[p] += below[i]
        longest[p] = max(longest[p], longest[i])
        nodes[p].kids += 1
    out = []
    for i, node in enumerate(nodes):
        share = 4 * linked[i] // max(1, total[i])
        f = [_id(f"tag {node.tag}"), _id(f"{node.tag == '#'} links {share}")]
        if node.tag == "#":
            text = node.text
            f += [_id(f"# words {_bucket(node.words, 6)}"), _id(f"# end {text[-1:] in '.!?:…»”'}"),
                  _id(f"# in {nodes[node.parent].tag}"), _id(f"# alone {nodes[node.parent].kids == 1}")]
            if "©" in text or "copyright" in text.lower():
                f.append(_id("# copyright"))
        else:
            f += [_id(f"chars {_bucket(total[i], 10)}"), _id(f"paragraphs {_bucket(below[i], 5)}"),
                  _id(f"longest {_bucket(longest[i], 9)}"), _id(f"{node.tag} in {nodes[node.parent].tag}")]
            for m in _ATTR.finditer(node.attrs):
                value = (m[2] or m[3] or m[4] or "").lower()
                for w in set(_WORD.findall(value)):
                    f += [_id(f"name {w}"), _id(f"start {w[:4]}")]
        out.append(f)
    return out


@dataclass
class Forest:
    """The trees of several pages: features as (node, feature) pairs, parents,
    depths, and the kind of each edge to a parent."""
    pages: list[list[Node]]
    row: np.ndarray
    feature: np.ndarray
    parent: np.ndarray
    kind: np.ndarray
    levels: list[np.ndarray]


def forest(pages: list[list[Node]]) -> Forest:
    feats = [f for nodes in pages for f in node_features(nodes)]
    base = np.cumsum([0, *(len(p) for p in pages)])
    parent = np.array([n.parent + b if n.parent >= 0 else -1 for p, b in zip(pages, base) for n in p], dtype=np.int64)
    kind = np.array([0 if n.tag == "#" else 1 if n.tag in PARAGRAPHS else 2 for p in pages for n in p])
    depth = np.zeros(len(parent), dtype=np.int64)
    levels = [np.flatnonzero(parent < 0)]
    if len(parent):
        rest = np.flatnonzero(parent >= 0)
        while len(rest):
            here = depth[parent[rest]] == len(levels) - 1
            here &= np.isin(parent[rest], levels[-1])
            levels.append(rest[here])
            depth[rest[here]] = len(levels) - 1
            rest = rest[~here]
    return Forest(pages, np.repeat(np.arange(len(feats)), [len(f) for f in feats]),
                  np.array([x for f in feats for x in f], dtype=np.int64), parent, kind, levels)


@dataclass
class TreeModel:
    w: np.ndarray     # evidence for content per feature
    edge: np.ndarray  # kind x parent state x child state

    def beliefs(self, f: Forest) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log-odds of each node's marginal, of its subtree's upward evidence,
        and of what the rest of the tree tells its parent."""
        e = np.exp(self.edge)
        up = np.bincount(f.row, self.w[f.feature], len(f.parent))
        message = np.zeros(len(up))
        for nodes in f.levels[:0:-1]:
            k, x = f.kind[nodes], np.exp(np.clip(up[nodes], -30, 30))
            message[nodes] = np.log((e[k, 1, 0] + e[k, 1, 1] * x) / (e[k, 0, 0] + e[k, 0, 1] * x))
            np.add.at(up, f.parent[nodes], message[nodes])
        belief, around = up.copy(), np.zeros(len(up))
        for nodes in f.levels[1:]:
            k = f.kind[nodes]
            around[nodes] = belief[f.parent[nodes]] - message[nodes]
            x = np.exp(np.clip(around[nodes], -30, 30))
            belief[nodes] += np.log((e[k, 0, 1] + e[k, 1, 1] * x) / (e[k, 0, 0] + e[k, 1, 0] * x))
        return belief, up, around

    def marginals(self, f: Forest) -> np.ndarray:
        return sigmoid(self.beliefs(f)[0])


def train(pages: list[tuple[str, list[tuple[int, int]]]] | None = None, epochs: int = EPOCHS,
          rate: float = 0.3, decay: float = 1e-3) -> TreeModel:
    """Fit on labelled pages: (html, ranges of main text in it).  An element
    is content if more than four fifths of its text are."""
    pages = labelled_pages() if pages is None else pages
    trees = [parse(page) for page, _ in pages]
    f = forest(trees)
    good, all_ = np.zeros(len(f.parent)), np.zeros(len(f.parent))
    i = 0
    for nodes, (_, ranges) in zip(trees, pages):
        for node in nodes:
            if node.tag == "#":
                all_[i] = len(node.text)
                good[i] = all_[i] * any(a <= node.at < b for a, b in ranges)
            i += 1
    for nodes in f.levels[:0:-1]:
        np.add.at(good, f.parent[nodes], good[nodes])
        np.add.at(all_, f.parent[nodes], all_[nodes])
    y = (good > 0.8 * all_).astype(float)
    model = TreeModel(np.zeros(FEATURES), np.zeros((len(_KINDS), 2, 2)))
    model.edge[:, [0, 1], [0, 1]] = 1.0
    gw, ge = np.full(FEATURES, 1e-3), np.full(model.edge.shape, 1e-3)
    inner = np.flatnonzero(f.parent >= 0)
    k, scale = f.kind[inner], 1 / max(1, len(pages))
    for _ in range(epochs):
        belief, up, around = model.beliefs(f)
        dw = np.bincount(f.feature, (sigmoid(belief) - y)[f.row], FEATURES) * scale + decay * model.w
        gw += dw ** 2
        model.w -= rate * dw / np.sqrt(gw)
        c, p = sigmoid(up[inner]), sigmoid(around[inner])
        pair = np.stack([np.stack([(1 - p) * (1 - c), (1 - p) * c], 1), np.stack([p * (1 - c), p * c], 1)], 1) \
            * np.exp(model.edge)[k]
        pair /= pair.sum(axis=(1, 2), keepdims=True)
        yp, yc = y[f.parent[inner]], y[inner]
        seen = np.stack([np.stack([(1 - yp) * (1 - yc), (1 - yp) * yc], 1), np.stack([yp * (1 - yc), yp * yc], 1)], 1)
        de = np.stack([(pair - seen)[k == j].sum(axis=0) for j in range(len(_KINDS))]) * scale + decay * model.edge
        ge += de ** 2
        model.edge -= rate * de / np.sqrt(ge)
    return model


def extract(pages: list[str], model: TreeModel) -> list[str]:
    """Main text of each page (empty if none)."""
    f = forest([parse(p) for p in pages])
    p, out, i = model.marginals(f), [], 0
    for nodes in f.pages:
        out.append("\n".join(n.text for j, n in enumerate(nodes, i) if n.text and p[j] >= KEEP_AT))
        i += len(nodes)
    return out


def main_text(model: TreeModel, page: Column) -> Column:
    """Main text of an html column: blocks in page order, one per line, with
    character references decoded and white space as single spaces.  Null and
    empty pages, and pages without main text, give empty text."""
    def kernel(pages: pa.Array) -> pa.Array:
        return pa.array(extract([p or "" for p in pages.to_pylist()], model), pa.string())

    return text_udf(kernel, "string", max_bytes=1_000_000)(page)
