"""Main text of web pages by a tree-structured graphical model over the block elements.

Every block element is a node with two states, content or not. Its tag, names and text give it a unary potential, and a
potential couples it with its parent. Sum-product messages upward and downward give exact marginals; a node's text is
kept if content is likelier than not. All potentials are learnt from labelled pages by the gradient of the likelihood.
"""

from __future__ import annotations

import html
import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tissuegrid.llm import labelled_pages

# Element names by how a page's text flows through them.
BLOCKS = set(
    "html head body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd nav header footer aside form fieldset legend "
    "label button select option table caption thead tbody tfoot tr td th blockquote pre figure figcaption address details summary "
    "dialog menu center hgroup search output iframe".split()
)
RAW = {"script", "style", "textarea", "title", "xmp", "noembed", "noframes", "noscript", "template", "svg", "iframe", "object", "canvas"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
IN_P = {"label", "button", "select", "option", "output"}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Kinds of child that have a coupling of their own with the parent.
KINDS = ("", "p", "h1", "h2", "h3", "li", "ul", "div", "section", "article", "td", "blockquote", "pre", "figure")
#: Parts of names that tell of a block's part in a page; a name counts if a part of it begins with one of these.
CUES = (
    "ad ads advert adsense sponsor promo banner cookie consent gdpr notice alert popup modal overlay nav menu bread crumb header "
    "masthead topbar logo foot copyright legal side aside rail widget related recommend more popular trend share social follow "
    "comment reply disqus respond discuss review form login sign subscribe newsletter search pag tag meta byline author date time "
    "article post entry story content main body text copy lead intro title headline caption quote code hidden skip toolbar button"
).split()

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S
)
_NAMES = re.compile(r"""\b(class|id|role|itemprop|aria-label|data-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_END = {tag: re.compile(rf"</{tag}\b[^>]*>", re.I) for tag in RAW}
_BLOCK = re.compile(rf"</?(?:{'|'.join(sorted(BLOCKS - RAW))})(?![^\s/>])", re.I)


@dataclass
class Tree:
    """Nodes of a page, parents first; blocks of text in page order with their node and the characters inside links."""

    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: ["#page"])
    names: list[str] = field(default_factory=lambda: [""])
    blocks: list[tuple[int, str, int]] = field(default_factory=list)


def parse(page: str) -> Tree:
    """Block tree of a page. Tags that are missing or never closed are taken as browsers do; markup never fails."""
    tree, stack, parts, linked, in_link, at = Tree(), [0], [], 0, False, 0
    gone = set()  # raw elements that are not closed any more: their rest is looked for once

    def flush():
        nonlocal parts, linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                tree.blocks.append((stack[-1], text, linked))
            parts, linked = [], 0

    def put(text):
        nonlocal linked
        if text:
            text = html.unescape(text) if "&" in text else text
            parts.append(text)
            if in_link:
                linked += len(text)

    while True:
        m = _TAG.search(page, at)
        put(page[at: m.start() if m else len(page)])
        if m is None:
            break
        at = m.end()
        closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if tag is None:
            continue
        tag = tag.lower()
        if tag in RAW:
            if closing or attributes.endswith("/"):
                continue
            end = None if tag in gone else _END[tag].search(page, at)
            if end is None:
                gone.add(tag)
            if end is None and tag == "svg":  # drawings that are not closed end where a block begins
                end = _BLOCK.search(page, at)
                at = end.start() if end else len(page)
                continue
            at = end.end() if end else at if tag == "noscript" else len(page)
            continue
        if tag == "br":
            put(" ")
            continue
        if tag == "a":
            in_link = not closing
            continue
        if tag == "hr" or tag in VOID or (tag not in BLOCKS and "-" not in tag):
            if tag == "hr":
                flush()
            continue
        flush()
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if tree.tag[stack[k]] == tag:
                    del stack[k:]
                    break
                if tag in SCOPES and tree.tag[stack[k]] in SCOPES[tag]:
                    break
            in_link = False
            continue
        if tag in ("html", "body") and tag in (tree.tag[k] for k in stack):
            continue
        if len(stack) > 1 and tree.tag[stack[-1]] == "head" and tag != "head":
            stack.pop()
        if tag not in IN_P:
            while tree.tag[stack[-1]] == "p" or (re.fullmatch("h[1-6]", tag) and re.fullmatch("h[1-6]", tree.tag[stack[-1]])):
                stack.pop()
        if tag in SAME:
            for k in range(len(stack) - 1, 0, -1):
                if tree.tag[stack[k]] in SAME[tag]:
                    del stack[k:]
                    break
                if tree.tag[stack[k]] in SCOPES[tag]:
                    break
        tree.parent.append(stack[-1])
        tree.tag.append(tag)
        tree.names.append(" ".join(a or b or c for _, a, b, c in _NAMES.findall(attributes)) if "=" in attributes else "")
        if not attributes.endswith("/"):
            stack.append(len(tree.parent) - 1)
    flush()
    return tree


def _bin(x: float) -> int:
    return min(int(math.log2(x + 1)), 12)


_known: dict[str, list[str]] = {}


def _cues(names: str) -> list[str]:
    """Cues in a node's names, and all of them together as one for names without any."""
    if names not in _known:
        if len(_known) > 50_000:
            _known.clear()
        parts = {p.lower() for p in _PART.findall(names)}
        _known[names] = [f"c:{c}" for c in CUES if any(p == c or (len(c) > 3 and p.startswith(c)) or p == c + "s" for p in parts)]
    return _known[names]


def features(tree: Tree) -> list[list[str]]:
    """Names of the features of each node."""
    n = len(tree.parent)
    own, links, stops, children = [0] * n, [0] * n, [0] * n, [0] * n
    for node, text, linked in tree.blocks:
        own[node] += len(text)
        links[node] += linked
        stops[node] += text.count(".") + text.count("!") + text.count("?") + text.count(",")
    whole, whole_links, depth = own[:], links[:], [0] * n
    for i in range(n - 1, 0, -1):
        p = tree.parent[i]
        whole[p] += whole[i]
        whole_links[p] += whole_links[i]
        children[p] += 1
    page = max(whole[0], 1)
    out = []
    for i in range(n):
        depth[i] = depth[tree.parent[i]] + 1 if i else 0
        density = int(4 * whole_links[i] / whole[i]) if whole[i] else -1
        one = ["one", f"t:{tree.tag[i]}", f"w:{_bin(whole[i])}", f"l:{density}", f"n:{_bin(children[i])}", f"d:{min(depth[i], 6)}"]
        if children[i]:
            one.append(f"s:{int(4 * whole[i] / page)}")
        if own[i]:
            one += [f"o:{_bin(own[i])}", f"p:{_bin(stops[i])}", f"o:{_bin(own[i])}/l:{density}", f"t:{tree.tag[i]}/p:{_bin(stops[i])}"]
        out.append(one + _cues(tree.names[i]) if tree.names[i] else one)
    return out


def messages(unary: np.ndarray, couple: np.ndarray, parent: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum-product over a forest: log beliefs (node, state), and per node log weights (parent's state, state).

    ``unary`` is (node, state), ``couple`` (node, parent's state, state), roots have parent -1 and depth 0.
    """
    inward = unary.copy()
    up = np.zeros_like(unary)
    levels = [np.flatnonzero(depth == d) for d in range(int(depth.max(initial=0)) + 1)]
    for at in reversed(levels[1:]):
        up[at] = np.logaddexp(couple[at, :, 0] + inward[at, None, 0], couple[at, :, 1] + inward[at, None, 1])
        np.add.at(inward, parent[at], up[at])
    down = np.zeros_like(unary)
    pairs = np.zeros_like(couple)
    for at in levels[1:]:
        above = inward[parent[at]] - up[at] + down[parent[at]]
        joint = above[:, :, None] + couple[at]
        down[at] = np.logaddexp(joint[:, 0], joint[:, 1])
        pairs[at] = joint + inward[at][:, None, :]
    return inward + down, pairs


@dataclass(frozen=True)
class Model:
    index: dict[str, int]
    weight: np.ndarray
    couple: np.ndarray  # kind, parent's state, state


class _Forest:
    """Arrays of many trees side by side."""

    def __init__(self, trees: list[Tree], index: dict[str, int], grow: bool = False):
        sizes = [len(t.parent) for t in trees]
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        parent, node, feature, kind, depth = [], [], [], [], []
        for t, base in zip(trees, self.first.tolist()):
            for i, names in enumerate(features(t)):
                p = t.parent[i]
                parent.append(base + p if i else -1)
                depth.append(depth[base + p] + 1 if i else 0)
                kind.append(KINDS.index(t.tag[i]) if t.tag[i] in KINDS else 0)
                for name in names:
                    f = index.setdefault(name, len(index)) if grow else index.get(name)
                    if f is not None:
                        node.append(base + i)
                        feature.append(f)
        self.parent, self.depth, self.kind = np.array(parent, dtype=np.int64), np.array(depth, dtype=np.int64), np.array(kind, dtype=np.int64)
        self.node, self.feature = np.array(node, dtype=np.int64), np.array(feature, dtype=np.int64)

    def beliefs(self, weight: np.ndarray, couple: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        unary = np.zeros((len(self.parent), 2))
        unary[:, 1] = np.bincount(self.node, weight[self.feature], len(self.parent))
        return messages(unary, couple[self.kind], self.parent, self.depth)


def _chances(log_weights: np.ndarray) -> np.ndarray:
    flat = log_weights.reshape(len(log_weights), -1)
    p = np.exp(flat - flat.max(axis=1, keepdims=True))
    return (p / p.sum(axis=1, keepdims=True)).reshape(log_weights.shape)


def train(pages: list[str], steps: int = 250, rate: float = 0.1, decay: float = 0.02) -> Model:
    """Fit the potentials to pages whose content is marked by data-label="main", and what is not content in it by "not"."""
    trees = [parse(p) for p in pages]
    labels = []
    for t in trees:
        mine = []
        for i, names in enumerate(t.names):
            marks = names.split()
            state = 1 if "main" in marks[-1:] else 0 if "not" in marks[-1:] else mine[t.parent[i]] if i else 0
            if marks[-1:] in (["main"], ["not"]):
                t.names[i] = " ".join(marks[:-1])
            mine.append(state)
        labels += mine
    index: dict[str, int] = {}
    forest = _Forest(trees, index, grow=True)
    y = np.array(labels)
    inner = np.flatnonzero(forest.parent >= 0)
    weight, couple = np.zeros(len(index)), np.zeros((len(KINDS), 2, 2))
    seen_w, seen_c = np.full_like(weight, 1e-8), np.full_like(couple, 1e-8)
    for _ in range(steps):
        belief, pairs = forest.beliefs(weight, couple)
        miss = y - _chances(belief)[:, 1]
        dw = np.bincount(forest.feature, miss[forest.node], len(weight)) - decay * weight
        dc = -decay * couple
        np.add.at(dc, (forest.kind[inner], y[forest.parent[inner]], y[inner]), 1.0)
        np.subtract.at(dc, forest.kind[inner], _chances(pairs[inner]))
        seen_w, seen_c = seen_w + dw**2, seen_c + dc**2
        weight, couple = weight + rate * dw / np.sqrt(seen_w) * 5, couple + rate * dc / np.sqrt(seen_c) * 5
    return Model(index, weight, couple)


def main_texts(pages: list[str], model: Model) -> list[str]:
    """Main text of each page: blocks of nodes whose marginal favours content, joined by line breaks."""
    if not pages:
        return []
    trees = [parse(p) for p in pages]
    forest = _Forest(trees, model.index)
    belief, _ = forest.beliefs(model.weight, model.couple)
    content = belief[:, 1] > belief[:, 0]
    return ["\n".join(text for node, text, _ in t.blocks if content[base + node]) for t, base in zip(trees, forest.first.tolist())]


def extract(pages: DataFrame, html_col: str = "html", out_col: str = "text", together: int = 64) -> DataFrame:
    """``pages`` with their main text in ``out_col`` (replaced if there is one).

    A null or empty page gives an empty text, so does one without content; markup that breaks off or nests wrongly is read
    as far as it goes. Pages count whole, whatever their length. Rows are handled on their own, so repeated rows agree; an
    empty table stays empty; other columns pass through, whatever their names.
    """
    model = train(labelled_pages.pages())
    plain = pages.sparkSession.sparkContext.broadcast((model.index, model.weight, model.couple))
    names = [c for c in pages.columns if c != out_col]
    schema = T.StructType([*(pages.schema[c] for c in names), T.StructField(out_col, T.StringType())])

    def find(batches):
        own = Model(*plain.value)
        for batch in batches:
            texts = []
            column = batch.column(len(names))
            for at in range(0, len(column), together):
                texts += main_texts([p or "" for p in column.slice(at, together).to_pylist()], own)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(texts, pa.string())], names=[*names, out_col])

    return pages.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{html_col}`").cast("string").alias("__html")).mapInArrow(find, schema)
