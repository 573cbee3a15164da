"""Personal data: base patterns, and a skip-chain conditional random field that adds spans.

Words with a digit or an ``@`` are the field's tokens.  Labels are O and the four kinds.  Neighbouring tokens share a
chain potential; tokens of one document that repeat or resemble each other (the same digits, or the same last seven
to ten, or the same address without case and punctuation), however far apart, share a skip potential, each with the
one before it and with the first of them that is in a base span, before or after it; both are linear in tokens.
Loopy sum-product message passing over all documents of a slice at once gives marginals; each document's messages are
passed on until they change by less than ``TOLERANCE``, and damped twice as much every ``PATIENCE`` rounds, so that
they come to rest on any graph.  Tokens of base spans are clamped, so a form that the patterns miss follows its twin
that they catch.  A token with a marginal
of ``SURE`` or more for a kind, alone or with neighbours of that kind, becomes a span, with or without a twin; what is
added to a text depends on that text and the model alone, not on the texts that share its slice.

Weights are trained by pseudo-likelihood, in numpy, on tokens labelled by the base patterns: those of at most ``SAMPLE``
documents (the ones whose ids hash least, in that order, as long as they have ``TOKENS`` tokens together; a document
that goes beyond is left out).  An unlabelled token with a labelled twin is one whose label isn't known, and is left
out of the loss.  The skip potential, one weight for labels that agree, is learned from twins whose labels are known:
from those in the documents, and from one twin of each labelled span, written as the patterns don't catch it (other
separators), which has the span's label.

Base patterns are applied to whole texts in time linear in their length; matches that fail their check are dropped
without a retry.  Offsets count code points.

Edge cases: null text counts as empty (no spans, the digest of an empty string); rows pass one to one, so repeated
rows and null doc_ids stay; very long texts and runs are read whole; other columns are ignored; without any labelled
token the field adds nothing.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, by_slice, col, shielded
from .textops import Words, code_points

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 5000
TOKENS = 200_000
SURE = 0.9
TOLERANCE = 1e-6
PATIENCE = 200
O = 4  # noqa: E741

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match never starts inside a run of digits: what follows the run is the same for each of its digits
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TOKEN = np.zeros(256, dtype=bool)
_TOKEN[[*range(48, 58), 64]] = True


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of local@domain, leftmost; each @ is tried once, with all of the local part before it."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > last and text[begin - 1] in _LOCAL:
            begin -= 1
        found = _DOMAIN.match(text, at + 1) if begin < at else None
        if found:
            last = found.end()
            out.append((begin, last))
        else:
            last = max(last, at + 1)
        at = text.find("@", last)
    return out


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) << (k & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end), by kind, then start."""
    out = [(0, a, b) for a, b in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                out.append((3, *m.span()))
    return out


def render(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


_FEATURES = 22


def token_features(token: str) -> list[int]:
    """Indices of the features that hold."""
    digits = _digits(token)
    n, dots = len(digits), token.count(".")
    out = [0, 1 + min(n, 20) // 3]  # 1 to 7
    letters = any(c.isalpha() for c in token)
    checks = (
        "@" in token, "@" in token and "." in token.rpartition("@")[2], token.startswith("+"), dots == 3, letters, n == len(token),
        n >= 13 and n <= 19 and luhn(digits), "(" in token or ")" in token, "-" in token, "." in token and not letters, len(token) > 30,
        n >= 7 and not letters, n >= 13 and not letters, 2 * n > len(token),
    )
    return out + [8 + k for k, held in enumerate(checks) if held]


def twin_keys(token: str) -> list[str]:
    """Keys under which tokens of one document are taken for repeats of each other."""
    if "@" in token:
        key = "".join(c for c in token.casefold() if c.isalnum() or c == "@")
        return ["@" + key] if len(key) > 4 else []
    digits = _digits(token)
    return ["#" + digits] if len(digits) >= 7 else []


def rewritten(kind: int, span: str) -> str:
    """A span of personal data as the base patterns don't catch it."""
    if KINDS[kind] == "email":
        return span.rpartition("@")[0] + "@" + span.rpartition("@")[2].replace(".", "")
    if KINDS[kind] == "ip":
        return span.replace(".", "-")
    digits = _digits(span)
    if KINDS[kind] == "card":
        return ".".join(digits[k : k + 4] for k in range(0, len(digits), 4))
    return "-".join((digits[-10:-7], digits[-7:-4], digits[-4:])).strip("-")


class Field:
    """The tokens of a slice of texts as one graph: features, labels of base spans, chain and skip edges."""

    def __init__(self, text: pa.Array, rows: int):
        words = Words(text)
        has = np.concatenate([[0], np.cumsum(_TOKEN[words.buf])])
        self.base: dict[int, list] = {}
        self.doc, self.begin, self.end, self.token, self.label = [], [], [], [], []
        self.joins, self.plain = [], []  # whether a token adjoins the one before it, and is without letters and @
        chain, skip, star = [], [], []
        mine = np.flatnonzero(has[words.end] > has[words.start]) if len(words.start) else np.zeros(0, np.int64)
        points = np.concatenate([[0], np.cumsum(code_points(words.buf))])
        doc = np.searchsorted(words.first, mine, side="right") - 1
        last_doc, last_word, seen, spans = -1, -9, {}, []
        held: dict[str, list] = {}  # every occurrence of each key in the document
        for w, d in zip(mine.tolist(), doc.tolist(), strict=True):
            if d != last_doc:
                star += self._stars(held)
                spans = self.base[d] = base_spans(text[d].as_py())
                last_doc, last_word, seen, held = d, -9, {}, {}
                seek = sorted((a, b, k) for k, a, b in spans)
            a, b = (int(points[x] - points[words.off[d]]) for x in (words.start[w], words.end[w]))
            k = len(self.doc)
            label = next((kind for x, y, kind in seek if x < b and a < y), O)
            token = words.buf[words.start[w] : words.end[w]].tobytes().decode(errors="replace")
            self.doc.append(d), self.begin.append(a), self.end.append(b), self.token.append(token), self.label.append(label)
            self.joins.append(last_word == w - 1)
            self.plain.append(not any(c == "@" or c.isalpha() for c in token))
            if last_word == w - 1:
                chain.append((k - 1, k))
            for key, parts in self._keys(k):
                before, longer = seen.get(key, (None, []))
                if before is not None:
                    skip.append((before, k))
                    skip += self._ahead(longer, parts)
                seen[key] = (k, parts if len(parts) > 1 else longer)
                held.setdefault(key, []).append((k, parts))
            last_word = w
        star += self._stars(held)
        self.chain = np.array(chain, dtype=np.int64).reshape(-1, 2)
        self.skip = np.array(sorted(set(skip)), dtype=np.int64).reshape(-1, 2)
        self.star = np.array(sorted(set(star) - set(skip)), dtype=np.int64).reshape(-1, 2)
        self.x = np.zeros((len(self.doc), _FEATURES), dtype=np.float64)
        for k, t in enumerate(self.token):
            self.x[k, token_features(t)] = 1
        self.y = np.array(self.label, dtype=np.int64)

    def _ahead(self, longer: list[int], parts: list[int]) -> list[tuple[int, int]]:
        """Tokens ahead of two twins, that their key takes in, are twins too where their digits agree."""
        return [(a, b) for a, b in zip(longer[1:], parts[1:], strict=False) if _digits(self.token[a]) == _digits(self.token[b])]

    def _stars(self, held: dict[str, list]) -> list[tuple[int, int]]:
        """Links of every unlabelled occurrence of a key to the first labelled one of the document."""
        out = []
        for found in held.values():
            known = [(k, parts) for k, parts in found if self.label[k] != O] if len(found) > 1 else []
            if known:
                longer = next((parts for _, parts in known if len(parts) > 1), [])
                for k, parts in found:
                    if self.label[k] == O:
                        out += [(known[0][0], k), *self._ahead(longer, parts)]
        return [(min(e), max(e)) for e in out]

    def _keys(self, k: int) -> list[tuple[str, list[int]]]:
        """Keys of the token, and those of its digits after those of the tokens that adjoin it, by the last ten and seven
        digits; each with the tokens it takes in, the last first.  Only tokens without letters are joined."""
        out = [(key, [k]) for key in twin_keys(self.token[k])]
        if not self.plain[k]:
            return out
        joined, parts = _digits(self.token[k]), [k]
        while len(joined) < 10 and self.joins[parts[-1]] and self.plain[parts[-1] - 1]:
            parts.append(parts[-1] - 1)
            joined = _digits(self.token[parts[-1]]) + joined
        return out + [(f"{n}:{joined[-n:]}", parts) for n in (10, 7) if len(joined) >= n]

    def examples(self, text: pa.Array) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """By text with tokens: features as bits, labels (-1 where it isn't known), chain edges and twin edges.

        Each labelled span has one more token, without neighbours: its rewritten twin.
        """
        bits = (self.x @ (1 << np.arange(_FEATURES))).astype(np.int64)
        label = self.y.copy()
        twins = np.concatenate([self.skip, self.star])
        for x, y in ((0, 1), (1, 0)):
            at = twins[(self.y[twins[:, x]] != O) & (self.y[twins[:, y]] == O)]
            label[at[:, y]] = -1
        border = np.searchsorted(np.array(self.doc, dtype=np.int64), np.arange(len(text) + 1))
        out = []
        for d, spans in sorted(self.base.items()):
            a, b = int(border[d]), int(border[d + 1])
            cut = lambda edges: edges[slice(*np.searchsorted(edges[:, 0], [a, b]))] - a  # noqa: E731,B023
            more, kinds, edges = [], [], []
            whole = text[d].as_py()
            last = {}  # the last token of each span
            for k in range(a, b):
                for at, (kind, x, y) in enumerate(spans):
                    if x < self.end[k] and self.begin[k] < y and kind == self.y[k]:
                        last[at] = k - a
            for at, k in sorted(last.items()):
                kind, x, y = spans[at]
                edges.append((k, b - a + len(more)))
                more.append(sum(1 << f for f in token_features(rewritten(kind, whole[x:y]))))
                kinds.append(kind)
            skip = np.concatenate([cut(self.skip), np.array(edges, dtype=np.int64).reshape(-1, 2)])
            out.append((d, np.concatenate([bits[a:b], np.array(more, dtype=np.int64)]), np.concatenate([label[a:b], np.array(kinds, dtype=np.int64)]), cut(self.chain), skip))
        return out


class Model:
    def __init__(self):
        self.node = np.zeros((_FEATURES, 5))
        self.chain = np.zeros((5, 5))
        self.skip = np.eye(5) * 0.0
        self.trained = False

    def train(self, x: np.ndarray, y: np.ndarray, chain: np.ndarray, skip: np.ndarray, rounds: int = 300) -> Model:
        """Pseudo-likelihood: each token's label given its features and its neighbours' labels; plain gradient steps.
        A label of -1 isn't known: it is neither learned nor learned from."""
        known = y >= 0
        if not known.any() or (y[known] == O).all():
            return self
        one = np.concatenate([np.eye(5), np.zeros((1, 5))])
        sides = np.zeros((3, len(y), 5))  # labels to the left, to the right, across skip edges
        np.add.at(sides[0], chain[:, 1], one[y[chain[:, 0]]])
        np.add.at(sides[1], chain[:, 0], one[y[chain[:, 1]]])
        np.add.at(sides[2], skip[:, 1], one[y[skip[:, 0]]])
        np.add.at(sides[2], skip[:, 0], one[y[skip[:, 1]]])
        bonus = 0.0  # one for all labels: twins agree, whatever they are, and a crowd of twins favours no kind of its own
        linked = known & (sides[2].sum(axis=1) > 0)
        for _ in range(rounds):
            z = x @ self.node + sides[0] @ self.chain + sides[1] @ self.chain.T + sides[2] * bonus
            z -= z.max(axis=1, keepdims=True)
            p = np.exp(z)
            p /= p.sum(axis=1, keepdims=True)
            e = (p - one[y]) * known[:, None] / known.sum()
            self.node -= 4.0 * (x.T @ e + 1e-4 * self.node)
            self.chain -= 4.0 * (sides[0].T @ e + e.T @ sides[1] + 1e-4 * self.chain)
            if linked.any():
                bonus -= 4.0 * (float((sides[2] * (p - one[y]))[linked].sum()) / linked.sum() + 1e-4 * bonus)
        self.skip = np.eye(5) * bonus
        self.trained = True
        return self

    def marginals(self, field: Field) -> np.ndarray:
        """Loopy sum-product over all edges at once, damped; clamped where the base has spoken."""
        unary = field.x @ self.node
        unary -= unary.max(axis=1, keepdims=True)
        known = field.y != O
        unary[known] = -1e9  # beyond what any crowd of twins sends
        unary[known, field.y[known]] = 0.0
        edges = np.concatenate([field.chain, field.skip, field.star])
        belief = unary.copy()
        if len(edges):
            twins = len(field.skip) + len(field.star)
            factor = np.concatenate([np.broadcast_to(np.exp(self.chain), (len(field.chain), 5, 5)), np.broadcast_to(np.exp(self.skip), (twins, 5, 5))])
            source, target = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
            factor = np.concatenate([factor, factor.transpose(0, 2, 1)])
            back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
            message = np.zeros((len(source), 5))
            doc = np.array(field.doc)
            moving, step, turn = np.ones(doc.max() + 1, dtype=bool), 0.5, 0
            live = None
            while step >= TOLERANCE:
                if live is None:  # only documents that still move take part, so each stops at its own round
                    live, node = np.flatnonzero(moving[doc[source]]), np.flatnonzero(moving[doc])
                    if not len(live):
                        live = None
                        break
                    place, rank = np.zeros(len(source), np.int64), np.zeros(len(doc), np.int64)
                    place[live], rank[node] = np.arange(len(live)), np.arange(len(node))
                    begin, end, other, own, at = rank[source[live]], rank[target[live]], place[back[live]], factor[live], doc[source[live]]
                    now = message[live]
                total = unary[node]
                np.add.at(total, end, now)
                sent = total[begin] - now[other]
                sent = np.exp(sent - sent.max(axis=1, keepdims=True))
                new = np.log(np.einsum("ei,eij->ej", sent, own) + 1e-300)
                new -= new.max(axis=1, keepdims=True)
                change = np.zeros(len(moving))
                np.maximum.at(change, at, np.abs(new - now).max(axis=1))
                now += step * (new - now)
                rest = moving & (change < TOLERANCE)
                if rest.any():
                    message[live] = now
                    moving &= ~rest
                    live = None
                turn += 1
                if turn % PATIENCE == 0:
                    step /= 2
            if live is not None:
                message[live] = now
            np.add.at(belief, target, message)
        p = np.exp(belief - belief.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    def spans(self, text: pa.Array) -> list[tuple[list, list]]:
        """By text: base spans, and those that the field adds."""
        field = Field(text, len(text))
        out: list[tuple[list, list]] = [([], []) for _ in range(len(text))]
        for d, found in field.base.items():
            out[d] = (found, [])
        if not self.trained or not len(field.doc):
            return out
        p = self.marginals(field)
        kind = p.argmax(axis=1)
        add = (kind != O) & (p.max(axis=1) >= SURE) & (field.y == O)
        linked = {(a, b) for a, b in field.chain.tolist()}
        run: list[int] = []

        def close() -> None:
            if run:
                d, text_ = field.doc[run[0]], text[field.doc[run[0]]].as_py()
                a, b = field.begin[run[0]], field.end[run[-1]]
                while b > a and not text_[b - 1].isalnum():
                    b -= 1
                while a < b and not (text_[a].isalnum() or text_[a] in "+("):
                    a += 1
                if a < b and not any(x < b and a < y for _, x, y in out[d][0]):
                    out[d][1].append((int(kind[run[0]]), a, b))
            run.clear()

        for k in np.flatnonzero(add).tolist():
            if run and not ((run[-1], k) in linked and kind[k] == kind[run[-1]]):
                close()
            run.append(k)
        close()
        return out


def fit(docs: DataFrame, sample: int = SAMPLE, tokens: int = TOKENS) -> Model:
    """Trains on the tokens of at most ``sample`` documents and ``tokens`` tokens; only features and edges are collected."""
    chosen = docs.where("doc_id is not null").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    parts = ["x", "y", "chain", "skip"]

    def work(part: pa.RecordBatch) -> pa.RecordBatch | None:
        text = col(part, "text")
        own = Field(text, part.num_rows).examples(text)
        if not own:
            return None
        raw = [[np.ascontiguousarray(r[k + 1], dtype="<i4").tobytes() for r in own] for k in range(4)]
        return pa.RecordBatch.from_arrays(
            [col(part, "doc_id").take(pa.array([r[0] for r in own])), pa.array([len(r[1]) for r in own], pa.int64()), *[pa.array(x, pa.binary()) for x in raw]], names=["doc_id", "n", *parts]
        )

    # the chosen ids are bounded by the sample, and so is their broadcast; equal rows count once
    scratch = Scratch(docs.sparkSession)
    rows = docs.join(F.broadcast(chosen), "doc_id").mapInArrow(by_slice(work), "doc_id long, n long, " + ", ".join(f"{c} binary" for c in parts))
    rows = scratch.write(rows.where(F.col("n") <= tokens).distinct())
    order = [F.xxhash64("doc_id"), "doc_id", "n", F.xxhash64(*parts)]
    near = rows.select("doc_id", "n", F.xxhash64(*parts).alias("key")).orderBy(*order).limit(sample)
    fits = near.withColumn("total", F.sum("n").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id", "n", "key").rowsBetween(Window.unboundedPreceding, 0))).where(F.col("total") <= tokens)
    held = rows.withColumn("key", F.xxhash64(*parts)).join(F.broadcast(fits.select("doc_id", "key")), ["doc_id", "key"])
    got = held.orderBy(F.xxhash64("doc_id"), "doc_id", "n", "key").select(*parts).collect()
    scratch.drop(rows)
    x, y, chain, skip, base = [], [], [], [], 0
    for r in got:
        flat = [np.frombuffer(bytes(r[c]), dtype="<i4").astype(np.int64) for c in parts]
        x.append((flat[0][:, None] >> np.arange(_FEATURES)) & 1)
        y.append(flat[1])
        chain.append(flat[2].reshape(-1, 2) + base)
        skip.append(flat[3].reshape(-1, 2) + base)
        base += len(flat[1])
    if not base:
        return Model()
    return Model().train(np.concatenate(x).astype(float), np.concatenate(y), np.concatenate(chain), np.concatenate(skip))


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def personal_data(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added): counts and digest are of base spans."""
    docs = _narrow(docs)
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, sample))

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        found = model.value.spans(col(part, "text").fill_null(""))
        counts = [[sum(k == kind for k, _, _ in base) for base, _ in found] for kind in range(4)]
        digest = [hashlib.sha256(render(base).encode()).hexdigest() for base, _ in found]
        return pa.RecordBatch.from_arrays(
            [col(part, "doc_id"), *[pa.array(c, pa.int64()) for c in counts], pa.array(digest), pa.array([render(b + more) for b, more in found]), pa.array([len(more) for _, more in found], pa.int64())],
            names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"],
        )

    return docs.mapInArrow(by_slice(work), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Each span gives way to its kind in square brackets; overlapping spans are one, named by the first."""
    out, last = [], 0
    for a, b, k in sorted((a, b, k) for k, a, b in spans):
        if a >= last:
            out += [text[last:a], f"[{KINDS[k].upper()}]"]
        last = max(last, b)
    return "".join([*out, text[last:]])


def masked(docs: DataFrame, sample: int = SAMPLE, length_column: str | None = "n_chars") -> DataFrame:
    """All rows and columns of ``docs`` with personal data masked; ``length_column`` follows the changed texts."""
    model = docs.sparkSession.sparkContext.broadcast(fit(_narrow(docs), sample))
    docs, restore = shielded(docs, "text", *[c for c in docs.columns if c == length_column])

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        text = col(part, "text").fill_null("")
        found = model.value.spans(text)
        at = part.schema.get_field_index("text")
        old = col(part, "text").to_pylist()
        new = [t if not base + more else mask(t, base + more) for t, (base, more) in zip(old, found, strict=True)]
        out = part.set_column(at, part.schema.field(at), pa.array(new, part.schema.field(at).type))
        if length_column in part.schema.names:
            k = part.schema.get_field_index(length_column)
            sizes = [n if a == b else len(b) for n, a, b in zip(part.column(k).to_pylist(), old, new, strict=True)]
            out = out.set_column(k, part.schema.field(k), pa.array(sizes, part.schema.field(k).type))
        return out

    return restore(docs.mapInArrow(by_slice(work), docs.schema))
