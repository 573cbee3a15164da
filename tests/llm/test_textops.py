import random
import re

import pyarrow as pa
import pytest

from skyphrase.llm import text_stats, textops
from skyphrase.llm.textops import Words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts(seed=0, n=300):
    rng = random.Random(seed)
    out = ["".join(rng.choice("aA bé\n\t .#*$|é😀\x85 ") for _ in range(rng.randint(0, 60))) for _ in range(n)]
    line = "one two three four five six seven eight nine"
    return [*out, "", None, " ", line + "\n" + line, (line + " ") * 5, "a " * 30, "x\n\nx\n \n x\nx", "word" * 3000 + " tail"]


@pytest.fixture(params=[1 << 20, 64])
def block(request, monkeypatch):
    monkeypatch.setattr(textops, "BLOCK_BYTES", request.param)


def test_words_are_the_patterns(block):
    own = texts()
    w = Words(pa.array(own))
    for d, t in enumerate(own):
        found = [w.buf[a:b].tobytes().decode() for a, b in zip(w.start[w.first[d] : w.first[d + 1]], w.end[w.first[d] : w.first[d + 1]], strict=True)]
        assert found == WORD.findall(t or "")
    by = {}
    for k in range(len(w.hash)):
        by.setdefault(w.buf[w.start[k] : w.end[k]].tobytes(), set()).add(int(w.hash[k]))
    assert all(len(h) == 1 for h in by.values()) and len({next(iter(h)) for h in by.values()}) == len(by)


def test_folding_is_ascii_only():
    w = Words(pa.array(["ABC abc É é"]), fold=True)
    assert w.hash[0] == w.hash[1] and w.hash[2] != w.hash[3]


def test_shingles(block):
    own = texts(1)
    h, border = Words(pa.array(own)).shingles(5)
    seen = {}
    for d, t in enumerate(own):
        ws = WORD.findall(t or "")
        true = {tuple(ws[k : k + 5]) for k in range(len(ws) - 4)} or ({tuple(ws)} if ws else set())
        assert border[d + 1] - border[d] == len(true)
        seen.setdefault(frozenset(true), set()).add(tuple(h[border[d] : border[d + 1]].tolist()))
    assert all(len(v) == 1 for v in seen.values()) and len({next(iter(v)) for v in seen.values()}) == len(seen)


def test_slices_cover_all_rows():
    own = texts(2)
    batch = pa.RecordBatch.from_arrays([pa.array(own)], names=["text"]).slice(7)
    got = [t for part in textops.slices(batch, limit=100) for t in part.column(0).to_pylist()]
    assert got == own[7:]
    w = Words(batch.slice(3, 50).column(0))
    assert [int(c) for c in w.count] == [len(WORD.findall(t or "")) for t in own[10:60]]


def test_counts(block):
    own = texts(3)
    w = Words(pa.array(own))
    chars, marks, (dups, _), reps = text_stats.word_chars(text_stats.byte_counts(w)), text_stats.symbols(text_stats.byte_counts(w)), text_stats.dup_lines(w), text_stats.repeat_words(w)
    for d, t in enumerate(own):
        t = t or ""
        ws = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        assert chars[d] == sum(map(len, ws)) and marks[d] == len(re.findall(r"[#*$%&|<>]", t)) and dups[d] == len(lines) - len(set(lines)), t
        windows = [tuple(ws[k : k + 8]) for k in range(len(ws) - 7)]
        inside = {k + j for k, x in enumerate(windows) if windows.count(x) > 1 for j in range(8)} if len(windows) < 500 else set()
        assert reps[d] == len(inside)


def pairs_that_once_met():
    """Different words of the same bytes: blocks exchanged, a long word reversed, and Thue-Morse words."""
    thue = "a"
    for _ in range(12):
        thue += thue.translate(str.maketrans("ab", "ba"))
    ordinary = "".join(random.Random(5).choices("abcdefgh", k=2048))
    return [
        ("ab" * 512 + "ba" * 512, "ba" * 512 + "ab" * 512), (ordinary, ordinary[::-1]), (thue, thue.translate(str.maketrans("ab", "ba"))),
        ("a" * 1024 + "b" * 1024, "b" * 1024 + "a" * 1024), ("x" * 16, "x" * 17), ("abcdefgh" + "ijklmnop", "ijklmnop" + "abcdefgh"), ("a\0", "a"),
    ]


def test_long_words_and_lines_do_not_collide():
    for a, b in pairs_that_once_met():
        words = textops.Words(pa.array([a, b]))
        assert words.hash[0] != words.hash[1], a[:20]
        assert text_stats.dup_lines(textops.Words(pa.array([f"{a}\n{b}\n{a}"])))[0].tolist() == [1]


def test_words_of_any_length_against_a_pattern(monkeypatch):
    rng = random.Random(6)
    texts = [None, "", " \n\t "] + ["".join(rng.choice("ab \nécd\U0001f600") for _ in range(rng.randint(0, 400))) for _ in range(300)]
    for block, piece in ((1 << 20, 1 << 16), (64, 13), (7, 1)):
        monkeypatch.setattr(textops, "BLOCK_BYTES", block)
        monkeypatch.setattr(textops, "PIECE", piece)
        words, seen = textops.Words(pa.array(texts)), {}
        for d, t in enumerate(texts):
            own = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())
            at = range(words.first[d], words.first[d + 1])
            assert [words.buf[words.start[k] : words.end[k]].tobytes() for k in at] == own
            for k, w in zip(at, own, strict=True):
                assert seen.setdefault(w, words.hash[k]) == words.hash[k]
        assert len(set(seen.values())) == len(seen)


def test_fifty_megabytes_without_white_space():
    """Working memory is a few bytes per byte, whatever the operator does with such a text."""
    import tracemalloc

    from skyphrase.llm import chunk_dedup, near_dup, quality_rules, site_quality, toxicity

    size = 50_000_000
    blob = pa.array([("0123456789abcdefghijklmnop" * (size // 26 + 1))[:size]])
    batch = pa.RecordBatch.from_arrays([pa.array([1]), blob], names=["doc_id", "text"])
    net = toxicity.Network(1)
    for name, work, most in (
        ("words", lambda: textops.Words(blob, fold=True), 4), ("chunks", lambda: chunk_dedup.chunk_rows(batch), 12), ("sketch", lambda: near_dup.sketch_rows(batch), 4),
        ("rules", lambda: quality_rules.base_counts(Words(blob)), 6), ("features", lambda: site_quality.features(blob), 8), ("toxicity", lambda: net.window_scores(textops.Words(blob, fold=True)), 9),
    ):
        tracemalloc.start()
        out = work()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert out is not None and peak < most * size, (name, peak / size)
