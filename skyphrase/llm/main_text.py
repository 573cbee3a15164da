"""Main text of HTML pages: a linear-chain conditional random field over DOM leaf blocks, decoded by Viterbi.

A block's state says whether it is main text.  Its features are the names and class words of the elements around it
(their first letters as well, so that "sidebar-left" and "sidebarRight" meet), the innermost element, the size, link
share and wording of its text, and how much text and how many links the elements right around it hold.  Two
neighbours share a weight for each pair of states, one set for neighbours in one element, one for neighbouring
elements, and one for others, so that an article's short paragraphs go with its long ones.

The weights are those of greatest likelihood, with a penalty on their squares, over labelled pages: (html, text), whose
blocks are matched to their text in order.  The forward-backward sums run over all pages at once.  The query's labelled
pages are composed (``layouts.py``) from the texts of at most ``SAMPLE`` pages of the table of at most ``SAMPLE_CHARS``
characters each, in seeded layouts; the trained weights go to the tasks, and each page is then worked off by itself.

Edge cases: null or empty html, and pages without text, give an empty text; rows pass through one to one, so repeated
rows and null page_ids stay; html is read whole, whatever its length, with tags unclosed or nested at will; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_slice, col
from .html_blocks import Block, Node, blocks

SAMPLE, SAMPLE_CHARS = 300, 50_000
LAYOUTS = 700
STEPS, PENALTY, RATE, SEEN = 120, 0.01, 0.2, 10
EDGES = 3
#: Words that longer blocks are looked through for; those of up to four words have a feature for each.
CUES = frozenset(
    "cookie cookies consent policy privacy newsletter subscribe javascript sponsored advertisement anzeige publicité publicidad offer buy rights reserved copyright droits réservés imprint impressum reply says posted comments".split()
)


def _bin(n: float) -> int:
    return int(n).bit_length()


def features(block: Block) -> list[str]:
    text, node = block.text, block.node
    words = text.split(" ")
    share = 4 * block.linked // len(text)
    own = [f"own:{node.name}", f"words:{_bin(len(words))}", f"linked:{share}", f"stop:{text[-1] in '.!?:;'}", f"first:{text[0].isupper()}", f"commas:{_bin(text.count(','))}"]
    if "©" in text:
        own.append("copyright")
    if any(c in text for c in "|·»›"):
        own.append("marks")
    if sum(c.isdigit() for c in text[:200]) * 5 > min(len(text), 200):
        own.append("digits")
    low = [w.strip(".,:;!?()").lower() for w in words[:40]]
    own += [f"says:{w}" for w in (dict.fromkeys(low) if len(words) <= 4 else sorted(CUES.intersection(low)))]
    group = node.group
    own += [f"group:{group.name}", f"held:{_bin(group.chars / 32)}", f"density:{4 * group.links // max(group.chars, 1)}", f"size:{_bin(len(words))}/{4 * group.links // max(group.chars, 1)}"]
    if group.parent is not None:
        own.append(f"outer:{_bin(group.parent.chars / 64)}")
    return own


def edge(a: Node, b: Node) -> int:
    """0 for neighbours in one element, 1 for those in neighbouring elements or in one and a part of it, 2 for others."""
    a, b = a.group, b.group
    return 0 if a is b else 1 if a.parent is b.parent or a.parent is b or b.parent is a else 2


def matched(found: list[Block], text: str) -> list[int] | None:
    """Which blocks make up the text, joined by one space; None if no choice of them does."""
    size = len(text) + 1 if text else 0
    ends = [{0}]
    for b in found:
        long = len(b.text)
        ends.append(ends[-1] | {p + long + 1 for p in ends[-1] if text.startswith(b.text, p) and text[p + long : p + long + 1] in ("", " ")})
    if size not in ends[-1]:
        return None
    own, at = [0] * len(found), size
    for k in range(len(found) - 1, -1, -1):
        before = at - len(found[k].text) - 1
        if before in ends[k] and at in ends[k + 1] and text.startswith(found[k].text, before) and before >= 0:
            own[k], at = 1, before
    return own


class Field:
    """Weights by feature, in favour of main text, and by edge for each pair of states; the first block has a weight too."""

    def __init__(self, weight: dict[str, float], edges: np.ndarray, start: np.ndarray):
        self.weight, self.edges, self.start = weight, edges, start

    def scores(self, found: list[Block]) -> list[float]:
        get, paths = self.weight.get, {}
        out = []
        for b in found:
            key = id(b.node.path)  # nodes that add nothing share their parent's
            if key not in paths:
                paths[key] = sum(get(f, 0.0) for f in b.node.path)
            out.append(paths[key] + sum(get(f, 0.0) for f in features(b)))
        return out

    def main(self, found: list[Block]) -> list[bool]:
        """The likeliest states of the whole chain."""
        if not found:
            return []
        score, steps = self.scores(found), self.edges.tolist()
        other, main = self.start[0], self.start[1] + score[0]
        back = []
        for k in range(1, len(found)):
            w = steps[edge(found[k - 1].node, found[k].node)]
            from_other, from_main = (other + w[0][0], main + w[1][0]), (other + w[0][1], main + w[1][1])
            back.append((from_other[1] > from_other[0], from_main[1] >= from_main[0]))
            other, main = max(from_other), max(from_main) + score[k]
        state = bool(main > other)
        out = [state]
        for step in reversed(back):
            state = bool(step[state])
            out.append(state)
        return out[::-1]

    def text(self, html: str | None) -> str:
        found = blocks(html, self.weight)
        return " ".join(b.text for b, own in zip(found, self.main(found), strict=True) if own)


def likelihood(emit: np.ndarray, gold: np.ndarray, kind: np.ndarray, held: np.ndarray, edges: np.ndarray, start: np.ndarray):
    """(log-likelihood, gradients by block, edges and start) of pages padded to the first one's length, which is the greatest, and
    sorted by length: ``emit`` scores main text,
    ``kind`` is the edge that leads to a block, ``held`` tells blocks from padding."""
    pages, size = emit.shape
    many = held.sum(axis=0)  # pages are sorted, the longest first
    node = np.stack([np.zeros_like(emit), emit], axis=2)
    step = edges[kind]
    ahead, behind, pair = np.zeros((pages, size, 2)), np.zeros((pages, size, 2)), np.zeros((pages, size, 2, 2))
    ahead[:, 0] = start + node[:, 0]
    for t in range(1, size):
        n = many[t]
        x = ahead[:n, t - 1, :, None] + step[:n, t]
        ahead[:n, t] = np.logaddexp(x[:, 0], x[:, 1]) + node[:n, t]
    last = ahead[np.arange(pages), held.sum(axis=1) - 1]
    total = np.logaddexp(last[:, 0], last[:, 1])
    for t in range(size - 1, 0, -1):
        n = many[t]
        x = step[:n, t] + (node[:n, t] + behind[:n, t])[:, None, :]
        behind[:n, t - 1] = np.logaddexp(x[:, :, 0], x[:, :, 1])
        pair[:n, t] = np.exp(ahead[:n, t - 1, :, None] + x - total[:n, None, None])
    share = np.exp(ahead + behind - total[:, None, None]) * held[:, :, None]
    states = np.stack([1 - gold, gold], axis=2) * held[:, :, None]
    truth = states[:, :-1, :, None] * states[:, 1:, None, :]
    seen = np.zeros_like(pair)
    seen[:, 1:] = truth
    value = (node * states).sum() + (step * seen).sum() + (states[:, 0] * start).sum() - total.sum()
    gap = (seen - pair).reshape(-1, 4)
    by_edge = np.stack([np.bincount(kind.ravel(), gap[:, j], len(edges)) for j in range(4)], axis=1).reshape(-1, 2, 2)
    return value, (states - share)[:, :, 1], by_edge, (states - share)[:, 0].sum(axis=0)


def fit(labelled: Iterable[tuple[str, str]], steps: int = STEPS, penalty: float = PENALTY) -> Field:
    """A field trained on (html, text); pages whose text isn't made of their blocks, and empty ones, are passed over, and so
    are features of fewer than ``SEEN`` blocks."""
    number: dict[str, int] = {}
    ids, border, rows = [], [0], []
    for html, text in labelled:
        found = blocks(html)
        gold = matched(found, text)
        if not found or gold is None:
            continue
        rows.append((len(border) - 1, gold, [0, *(edge(a.node, b.node) for a, b in zip(found, found[1:], strict=False))]))
        for b in found:
            ids += [number.setdefault(f, len(number)) for f in (*b.node.path, *features(b))]
            border.append(len(ids))
    edges, start = np.zeros((EDGES, 2, 2)), np.zeros(2)
    if not rows:
        return Field({}, edges, start)
    of, block = np.array(ids), np.repeat(np.arange(len(border) - 1), np.diff(border))
    often = np.bincount(of, minlength=len(number)) >= SEEN
    of, block = (np.cumsum(often) - 1)[of[often[of]]], block[often[of]]
    names = [f for f, k in number.items() if often[k]]
    rows.sort(key=lambda row: -len(row[1]))
    size = len(rows[0][1])
    place, gold, kind, held = (np.zeros((len(rows), size), dtype=t) for t in (np.int64, np.float64, np.int64, bool))
    for k, (first, own, kinds) in enumerate(rows):
        n = len(own)
        place[k, :n], gold[k, :n], kind[k, :n], held[k, :n] = first + np.arange(n), own, kinds, True
    weight = np.zeros(len(names))
    parts = [weight, edges, start]
    mean, square = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    for t in range(1, steps + 1):
        emit = np.bincount(block, weight[of], len(border) - 1)[place] * held
        _, by_block, by_edge, by_start = likelihood(emit, gold, kind, held, edges, start)
        flat = np.zeros(len(border) - 1)
        flat[place[held]] = by_block[held]
        slopes = [np.bincount(of, flat[block], len(names)) - penalty * weight, by_edge - penalty * edges, by_start - penalty * start]
        for p, g, m, s in zip(parts, slopes, mean, square, strict=True):  # Adam, upward
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            p += RATE * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
    return Field(dict(zip(names, weight.tolist(), strict=True)), edges, start)


def trained(pages: DataFrame, sample: int = SAMPLE, layouts: int = LAYOUTS) -> Field:
    """A field for pages like these: trained on layouts that hold texts of a bounded sample of them."""
    from .layouts import composed

    near = pages.select(F.col("page_id").cast("string").alias("p"), F.col("html").cast("string").alias("h")).where(F.length("h").between(1, SAMPLE_CHARS))
    near = near.select(F.sha2(F.concat_ws(":", "p", F.xxhash64("h").cast("string")).cast("binary"), 256).alias("k"), "h")
    # keys first, as every task sends its least ones; then the pages of those keys, each once
    keys = [r["k"] for r in near.select("k").distinct().orderBy("k").limit(sample).collect()]
    picked = [r["h"] for r in near.where(F.col("k").isin(keys)).groupBy("k").agg(F.min("h").alias("h")).orderBy("k").collect()]
    return fit(composed(picked, layouts))


def extract(pages: DataFrame, field: Field) -> DataFrame:
    """(page_id, url, text, n_chars) of each page; one pass, nothing is shuffled."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = [field.text(h) for h in col(part, "html").to_pylist()]
        columns = [col(part, "page_id"), col(part, "url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return narrow.mapInArrow(by_slice(work, "html", 1 << 20), "page_id long, url string, text string, n_chars long")


def oracle() -> str:
    """DuckDB SQL of the texts of the given pages, which all keep theirs in one article element: no CRF, but what it must find."""
    text = r"regexp_extract(html, '(?s)<article>(.*?)</article>', 1)"
    text = rf"regexp_replace(regexp_replace({text}, '</?(p|h1|br)>', ' ', 'g'), '<[^>]*>', '', 'g')"
    for name, sign in (("quot;", '"'), ("lt;", "<"), ("gt;", ">"), ("#39;", "''"), ("amp;", "&")):
        text = f"replace({text}, '&{name}', '{sign}')"
    return rf"SELECT page_id, url, t AS text, length(t) AS n_chars FROM (SELECT page_id, url, trim(regexp_replace({text}, '\s+', ' ', 'g')) AS t FROM pages)"
