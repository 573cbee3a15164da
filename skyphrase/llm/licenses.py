"""Licence scans by a positional rare-token index, in DataFrame expressions only.

Templates are licence texts, or their openings where they are long, and notices (``license_texts.py``).  A word's inverse document frequency is that over
the templates.  The index posts, with template and position, every word of highest IDF: those in at most ``RARE`` templates,
and of a template that has fewer than ``LEAST`` such words its rarest.  A file's own words of the index are looked up,
all of them; a posting at template position p that meets file position i proposes that the template begins at i - p.
Proposals are sorted and counted: an alignment with ``VOTES`` words at their relative positions is intersected with the
whole template.  Words count as in place where they stand as that alignment has them, or one of the same template up to
``DRIFT`` words beside it, so that an insertion doesn't part a text.  The share of template words in place is the
score; it counts if it is ``COVER`` or more and the template's mandatory phrase stands within the aligned words, ``SLACK``
to either side.

All is computed within the row: one scan, no shuffle, nothing broadcast but literals of some 30 kilobytes.  A template
counts only where its mandatory phrase stands, so files with none of the phrases' rarest words (``KEYS``) and no first
word of the base skip the search, after one hash lookup per word.  The work on a file grows with its words and, by a
sort, its proposals; alignments are compared with their neighbours only.

Edge cases: null text counts as empty: no words, no places, null first and last word, empty labels, score 0; rows
pass one to one, so repeated rows and null doc_ids stay; texts are scanned whole; other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .license_texts import TEXTS

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# the same class, stated by what is in it: Java matches that several times as fast
_IN_WORDS = r"[0-9a-z\x{80}-\x{10FFFF}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RARE = 3
LEAST = 4
VOTES = 2
COVER = 0.6
DRIFT = 8
SLACK = 8
# an alignment as one number: the template above, the place where it begins below, moved so that it isn't negative
_SHIFT, _ZERO = 40, 1 << 20

# The base phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: (label, words, words of the mandatory phrase)
TEMPLATES = [(label, re.findall(WORD, text.lower()), phrase.split()) for label, phrase, text in TEXTS]


def index() -> dict[str, list[tuple[int, int]]]:
    """The postings (template, position) of the words of highest IDF."""
    held = Counter(w for _, words, _ in TEMPLATES for w in set(words))
    rare = {w for w, n in held.items() if n <= RARE}
    for _, words, _ in TEMPLATES:
        if len(rare & set(words)) < LEAST:
            rare |= set(sorted(set(words), key=lambda w: (held[w], words.index(w)))[:LEAST])
    out: dict[str, list[tuple[int, int]]] = {w: [] for w in sorted(rare)}
    for t, (_, words, _) in enumerate(TEMPLATES):
        for p, w in enumerate(words):
            if w in out:
                out[w].append((t, p))
    return out


INDEX = index()
_HELD = Counter(w for _, words, _ in TEMPLATES for w in set(words))
#: One word of each mandatory phrase, that of highest IDF: a file without any holds no phrase.
KEYS = sorted({min(phrase, key=lambda w: (_HELD[w], w)) for _, _, phrase in TEMPLATES})


def _phrase_at(words: Column, i: Column, phrase: str) -> Column:
    parts = phrase.split()
    out = F.get(words, i) == parts[0]
    for k, w in enumerate(parts[1:], 1):
        out = out & (F.get(words, i + k) == w)
    return F.coalesce(out, F.lit(False))


def _positions(words: Column, some: list[str]) -> Column:
    """Positions of the given words, ascending."""
    marked = F.transform(words, lambda w, i: F.when(w.isin(some), i))
    return F.filter(marked, lambda i: i.isNotNull())


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, however often it occurs there."""
    return F.get(F.transform(F.array(value), use), 0)


def _alignments(words: Column, spots: Column) -> Column:
    """Alignments, ascending, that VOTES or more words of the index propose: of each run of equal ones in the sorted
    proposals, the place where it comes to so many."""
    posted = json.dumps({w: [(t << _SHIFT) + _ZERO - p for t, p in found] for w, found in INDEX.items()})
    postings = F.from_json(F.lit(posted), "map<string,array<bigint>>")
    proposed = F.flatten(F.transform(spots, lambda i: F.transform(postings[F.get(words, i)], lambda x: x + i)))

    def counted(own: Column) -> Column:
        before = lambda i, k: F.when(i >= k, F.get(own, i - k))  # noqa: E731  a place below 0 has none
        enough = lambda x, i: F.coalesce(before(i, VOTES - 1) == x, F.lit(False)) & ~F.coalesce(before(i, VOTES) == x, F.lit(False))
        return F.filter(own, enough)

    return _bound(F.sort_array(proposed), counted)


def _scores(words: Column, found: Column) -> Column:
    """Structs (t, s) of the alignments that hold: template and share of its words in place.  Arrays are read by place
    only, so an alignment costs the same in a file of any length."""
    lists = lambda rows: F.from_json(F.lit(json.dumps(rows)), "array<array<string>>")
    texts, phrases = lists([own for _, own, _ in TEMPLATES]), lists([phrase for _, _, phrase in TEMPLATES])
    template = lambda x: F.shiftright(x, _SHIFT).cast("int")
    begin = lambda x: (x.bitwiseAND(F.lit((1 << _SHIFT) - 1)) - _ZERO).cast("int")
    word = lambda i: F.when(i >= 0, F.get(words, i))

    def score(x: Column, k: Column) -> Column:
        # alignments differ, so no more than DRIFT on either side are near enough
        places = F.sequence(F.greatest(k - DRIFT, F.lit(0)), F.least(k + DRIFT, F.size(found) - 1))
        near = F.transform(F.filter(F.transform(places, lambda j: F.get(found, j)), lambda y: F.abs(y - x) <= DRIFT), begin)

        def share(own: Column, near: Column) -> Column:
            placed = F.filter(F.transform(own, lambda w, p: F.exists(near, lambda b: F.coalesce(word(b + p) == w, F.lit(False)))), lambda held: held)
            return F.struct(template(x).alias("t"), (F.size(placed) / F.size(own)).alias("s"))

        return _bound(F.struct(F.get(texts, template(x)).alias("own"), near.alias("near")), lambda r: share(r["own"], r["near"]))

    def confirmed(x: Column) -> Column:
        def stands(phrase: Column, size: Column) -> Column:
            starts = F.sequence(F.greatest(begin(x) - SLACK, F.lit(0)), F.greatest(begin(x), F.lit(0)) + size + SLACK - F.size(phrase))
            return F.exists(starts, lambda i: F.forall(F.transform(phrase, lambda w, k: F.coalesce(F.get(words, i + k) == w, F.lit(False))), lambda same: same))

        return _bound(F.struct(F.get(phrases, template(x)).alias("phrase"), F.size(F.get(texts, template(x))).alias("size")), lambda r: stands(r["phrase"], r["size"]))

    # the phrase is looked for only where the share counts
    kept = F.transform(found, lambda x, k: F.struct(x.alias("x"), score(x, k).alias("r")))
    return F.transform(F.filter(kept, lambda r: (r["r"]["s"] >= COVER) & confirmed(r["x"])), lambda r: r["r"])


def license_scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(_IN_WORDS), F.lit(0)).alias("words"))
    words, spots = F.col("words"), F.col("spots")
    leads = sorted({p.split()[0] for p in BASE})
    maybe = F.arrays_overlap(words, F.array(*[F.lit(w) for w in sorted({*KEYS, *leads})]))
    found = found.select("doc_id", F.size(words).cast("long").alias("n_words"), F.when(maybe, words).alias("words"))
    found = found.select("doc_id", "n_words", "words", F.when(words.isNotNull(), _positions(words, list(INDEX))).alias("spots"), F.when(words.isNotNull(), _positions(words, leads)).alias("leads"))

    def holds(phrase: str) -> Column:
        return F.filter(F.col("leads"), lambda i: _phrase_at(words, i, phrase))

    places = [holds(p) for p in BASE]
    found = found.select(
        "doc_id", "n_words", "words", F.when(F.size("leads") > 0, F.array(*places)).alias("places"), F.when(F.size(spots) >= VOTES, _alignments(words, spots)).alias("found")
    )
    found = found.select("doc_id", "n_words", "places", F.when(F.size("found") > 0, _scores(words, F.col("found"))).alias("scores"))
    starts = F.flatten("places")
    base = F.array(*[F.when(F.size(F.get("places", F.lit(k))) > 0, F.lit(label)) for k, label in enumerate(BASE.values())])
    names = F.array(*[F.lit(label) for label, _, _ in TEMPLATES])
    more = F.coalesce(F.transform("scores", lambda r: F.get(names, r["t"])), F.array().cast("array<string>"))
    joined = lambda parts: F.array_join(F.array_sort(F.array_distinct(F.filter(parts, lambda x: x.isNotNull()))), ",")
    return found.select(
        "doc_id", "n_words", F.when(F.col("places").isNull(), F.lit(0)).otherwise(F.size(starts)).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        joined(base).alias("base_labels"), joined(F.concat(base, more)).alias("labels"), F.coalesce(F.array_max(F.transform("scores", lambda r: r["s"])), F.lit(0.0)).alias("score"),
    )


def oracle() -> str:
    """The same scan as joins over words with positions, in DuckDB SQL."""
    rows = lambda items: ", ".join(items)
    tokens = rows(f"({t}, '{label}', {p}, '{w}', {str(w in INDEX).lower()})" for t, (label, own, _) in enumerate(TEMPLATES) for p, w in enumerate(own))
    def phrase(alias: str, parts: list[str]) -> str:
        return " AND ".join(f"{alias}.ws[{alias}.i + {k}] = '{w}'" for k, w in enumerate(parts, 1))
    base = " UNION ALL ".join(f"SELECT d, i, '{label}' AS label FROM w WHERE " + phrase("w", p.split()) for p, label in BASE.items())
    keys = " UNION ALL ".join(f"SELECT d, i, {t} AS t, {len(p)} AS size FROM w WHERE " + phrase("w", p) for t, (_, _, p) in enumerate(TEMPLATES))
    return rf"""
WITH d AS (SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS ws FROM documents),
w AS (SELECT d, ws, unnest(range(0, len(ws))) AS i FROM d),
base AS ({base}),
t(t, label, p, word, rare) AS (VALUES {tokens}),
z AS (SELECT t, count(*) AS size, any_value(label) AS label FROM t GROUP BY t),
begins AS (SELECT w.d, t.t, w.i - t.p AS b FROM w JOIN t ON t.rare AND w.ws[w.i + 1] = t.word GROUP BY ALL HAVING count(*) >= {VOTES}),
placed AS (SELECT DISTINCT x.d, x.t, x.b, t.p FROM begins x JOIN begins y ON y.d = x.d AND y.t = x.t AND abs(y.b - x.b) <= {DRIFT} JOIN t ON t.t = x.t JOIN d ON d.d = x.d
  WHERE y.b + t.p >= 0 AND d.ws[CASE WHEN y.b + t.p >= 0 THEN y.b + t.p + 1 END] = t.word),
shares AS (SELECT d, t, b, count(*) / any_value(z.size)::DOUBLE AS s FROM placed JOIN z USING (t) GROUP BY d, t, b),
keys AS ({keys}),
own AS (SELECT DISTINCT x.d, z.label, x.s FROM shares x JOIN z USING (t) JOIN keys k ON k.d = x.d AND k.t = x.t
  AND k.i BETWEEN greatest(x.b - {SLACK}, 0) AND greatest(x.b, 0) + z.size + {SLACK} - k.size WHERE x.s >= {COVER}),
b AS (SELECT d, count(*) AS n, min(i) AS lo, max(i) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM base GROUP BY d),
a AS (SELECT d, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT d, label FROM base UNION ALL SELECT d, label FROM own) GROUP BY d),
s AS (SELECT d, max(s) AS s FROM own GROUP BY d)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(b.n, 0)::BIGINT AS n_base, b.lo::BIGINT AS first_word, b.hi::BIGINT AS last_word,
  coalesce(b.labels, '') AS base_labels, coalesce(a.labels, '') AS labels, coalesce(s.s, 0)::DOUBLE AS score
FROM d LEFT JOIN b USING (d) LEFT JOIN a USING (d) LEFT JOIN s USING (d)"""
