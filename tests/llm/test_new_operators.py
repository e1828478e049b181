"""Repeated passages, hard negatives and the prefix trie against brute force."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stormlake.llm import hard_negatives, passage_dedup, prefix_trie
from stormlake.llm.common import Stages, pick
from tests.llm.data import empty, messy, messy_rows, words


def same(got, expected):
    assert collections.Counter(map(tuple, got)) == collections.Counter(expected)


# --- op11: repeated passages ---------------------------------------------------

def passages(rows, length):
    """[(doc_id, n_words, n_removed, kept_sha256)] by counting every window."""
    docs = [(r[0], re.findall(rb"[^\x20\x09-\x0D]+", (r[1] or "").encode())) for r in rows]
    seen = collections.Counter(tuple(w[i:i + length]) for _, w in docs for i in range(len(w) - length + 1))
    out = []
    for doc_id, w in docs:
        gone = {j for i in range(len(w) - length + 1) if seen[tuple(w[i:i + length])] > 1 for j in range(i, i + length)}
        kept = [x for j, x in enumerate(w) if j not in gone]
        out.append((doc_id, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def removed(spark, df, length):
    return passage_dedup.remove_passages(pick(df, doc_id="doc_id", text="text"), length).drop("kept").collect()


@pytest.mark.parametrize("length", [1, 4, 7, 35])
def test_passages_messy(spark, length):
    same(removed(spark, messy(spark), length), passages(messy_rows(), length))


def test_passages_separators_repeats_within_a_text_and_null_ids(spark):
    r = words(60, 8)
    rows = [(1, f"{r} {r}", "en", "a", 1), (None, r.replace(" ", "\t\n "), "en", "a", 1), (None, None, "en", "a", 1),
            (2, "  " + words(30, 9) + " " + words(40, 10), "en", "a", 1), (3, " \t ", "en", "a", 1)]
    same(removed(spark, messy(spark, rows), 35), passages(rows, 35))


def test_passages_of_a_small_vocabulary(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["a", "b"]) for _ in range(rng.randrange(0, 60))), "en", "a", 1) for i in range(60)]
    same(removed(spark, messy(spark, rows), 9), passages(rows, 9))


def test_passages_hot_copies_and_near_copies(spark):
    base, rows = words(150, 1).split(" "), []
    for i in range(200):
        text = list(base)
        if i % 2:
            text[i % 150] = f"edit{i}"
        rows.append((i, " ".join(text), "en", "a", 1))
    rows += [(1000 + i, words(80, 100 + i), "en", "a", 1) for i in range(20)]
    same(removed(spark, messy(spark, rows), 35), passages(rows, 35))


def test_long_texts_in_segments(monkeypatch):
    text = (words(3000, 5) + " " + "y" * 700 + " " + words(300, 6)).encode()
    whole = passage_dedup.word_hashes(text)
    rows = lambda: sorted(
        (int(g), int(p) + before, int(o)) for owner, h, before in passage_dedup._pieces([text], 35)
        for got in [passage_dedup.anchors(owner, h, 35)] if got
        for g, p, lo, hi in zip(got["g"], got["pos"], got["lo"], got["hi"], strict=True) for o in range(lo, hi + 1))
    at_once = rows()
    monkeypatch.setattr(passage_dedup, "SEGMENT", 100)
    monkeypatch.setattr(passage_dedup, "SLICE", 64)
    assert (passage_dedup.word_hashes(text) == whole).all() and len(whole) == 3301
    assert rows() == at_once and len(at_once) == 3301 - 34


def test_windows_are_extended_one_inside_the_next():
    for length in (1, 2, 5, 35, 36):
        o = np.arange(length - passage_dedup.levels(length)[0] + 1)
        begin, end = o, o + passage_dedup.levels(length)[0]
        for size in passage_dedup.levels(length):
            at = passage_dedup.inner(o, size, length)
            assert (at <= begin).all() and (at + size >= end).all() and (at >= 0).all() and (at + size <= length).all()
            begin, end = at, at + size


def test_passages_empty(spark):
    assert removed(spark, empty(spark), 35) == []


# --- op12: hard negatives ------------------------------------------------------

def negatives_by_hand(rows, k=5, low=80, high=100):
    width = max((len(v) for _, _, v, _ in rows), default=0)
    x = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(rows):
        x[i, :len(r[2])] = r[2]
    s, out = (x @ x.T).tolist(), []
    tie = lambda a: lambda j: (-s[a][j], rows[j][0] is None, rows[j][0] or 0)
    for a, (anchor, label, _, asked) in enumerate(rows):
        if anchor is None or not asked:
            continue
        positives = sorted((j for j in range(len(rows)) if j != a and rows[j][1] == label), key=tie(a))[:k]
        for p in positives:
            found = [j for j in range(len(rows)) if rows[j][1] != label and low * s[a][p] <= 100 * s[a][j] <= high * s[a][p]]
            out += [(anchor, rows[p][0], n, rows[j][0], s[a][p], s[a][j]) for n, j in enumerate(sorted(found, key=tie(a))[:k], 1)]
    return out


def mined(spark, rows, **sizes):
    df = spark.createDataFrame(rows, "vec_id long, label long, vector array<long>, asked boolean")
    df = df.withColumns({c: F.lit("clash") for c in ("idx", "block", "a", "run", "norm", "rank", "score", "has_id")})
    return hard_negatives.hard_negatives(Stages(spark, "t"), df, **sizes).collect()


def vectors(n, seed, labels=3, width=12, hot=0.0):
    rng = np.random.default_rng(seed)
    x = np.floor(40 * rng.normal(size=(n, width)) + 15).astype(int)
    return [(i, 1 if rng.random() < hot else int(rng.integers(labels)), x[i].tolist(), i % 10 == 0) for i in range(n)]


@pytest.mark.parametrize("sizes", [{}, {"data_block": 16, "anchor_block": 3}])
def test_negatives_equal_brute_force(spark, sizes):
    rows = vectors(300, 1, hot=0.5)
    same(mined(spark, rows, **sizes), negatives_by_hand(rows))


def test_negatives_messy(spark):
    rows = vectors(60, 2)
    rows += [(None, 1, rows[10][2], True), (None, 2, rows[20][2], False), (7, 0, [], True), (8, 1, [0] * 12, True), (9, 2, [5, 5], True),
             rows[10], rows[10], rows[20], (200, 0, rows[10][2], False), (201, 1, rows[10][2], False), (11, 77, rows[3][2], True)]
    rows += [(300 + i, i % 2, rows[30][2], i == 0) for i in range(30)]  # ties only
    same(mined(spark, rows, data_block=8, anchor_block=4), negatives_by_hand(rows))


def test_negatives_beyond_doubles(spark):
    rows = [(i, l, [v * (1 << 21) for v in x], asked) for i, l, x, asked in vectors(40, 3)]
    same(mined(spark, rows), negatives_by_hand(rows))


def test_negatives_empty(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [1, 2], False)]) == []
    assert mined(spark, [(0, 1, [1, 2], True)]) == []


def _block(x, label):
    references = hard_negatives.reference_directions(x[:200])
    norm, angles = hard_negatives.angles_to(x, references)
    n = np.arange(len(x))
    return references, hard_negatives.Block(idx=n, has_id=n >= 0, vec_id=n, label=label, points=x, norm=norm, angles=angles)


def test_bounds_hold_and_clusters_are_left_out():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 64))
    of = rng.integers(40, size=4000)
    x = np.floor(256 * (centres[of] + 0.1 * rng.normal(size=(4000, 64)))).astype(np.int64)
    x[7] = 0
    _, b = _block(x, of % 4)
    s = x @ x.T
    for upto in (hard_negatives.ROUGH, hard_negatives.REFERENCES):
        lower, upper = hard_negatives.bounds(b, b, slice(None), slice(None), upto)
        assert (lower <= s).all() and (s <= upper).all()
    a = hard_negatives.Block(**{f: getattr(b, f)[::100] for f in b.FIELDS})
    seen = hard_negatives.Counter()
    best = hard_negatives.find_positives(a, [b], 5, seen)
    assert seen.scored < 0.2 * seen.met
    seen = hard_negatives.Counter()
    hard_negatives.find_negatives(a, {"anchor": best.rows[0], "score": best.rows[1]}, [b], 5, 80, 100, seen)
    assert seen.scored < 0.2 * seen.met


# --- op13: prefix trie ---------------------------------------------------------

def trie_by_hand(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, role, hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest(), text))
    own = {c: [(t[2], t[4]) for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - int(np.fmod(c, 100)), [])[:h] + ts[h:])
    members = collections.defaultdict(list)
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    kids = collections.Counter(n[:-1] for n in members if n)
    leaves, saved = collections.Counter(), collections.Counter()
    for n, m in members.items():
        for d in range(len(n) + 1):
            leaves[n[:d]] += not kids[n]
            saved[n[:d]] += (len(m) - 1) * len(n[-1][1]) if n else 0
    ends = collections.defaultdict(list)
    for c in sorted(built):
        ends[built[c]].append(str(c))
    return [(min(m), len(n), min(members[n[:-1]]) if n else None, len(m), kids[n], leaves[n], saved[n],
             hashlib.sha256(",".join(ends[n]).encode()).hexdigest()) for n, m in members.items()]


def trie(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    df = df.withColumns({c: F.lit("clash") for c in ("depth", "d1", "f1", "chars", "part", "ref", "n", "h")})
    narrow = pick(df, conv_id="conv_id", turn="turn", role="role", text="text")
    return prefix_trie.prefix_trie(Stages(spark, "t"), narrow).collect()


def talk(rng, c, n, kinds=3):
    return [(c, t, rng.choice(["user", "assistant"]), f"text {rng.randrange(kinds)} é") for t in range(n)]


def test_trie_equals_brute_force(spark):
    rng = random.Random(1)
    rows = [r for c in [*range(95, 320), 1000, -5, -100, -230, 2 ** 62] for r in talk(rng, c, rng.randrange(1, 9))]
    same(trie(spark, rows), trie_by_hand(rows))


def test_trie_messy(spark):
    rng = random.Random(2)
    rows = talk(rng, 100, 6) + talk(rng, 101, 2) + [(102, None, None, None), (102, None, "user", "x"), (102, 3, "user", None), (102, 3, "user", "y"),
                                                    (102, 3, "user", "y"), (103, 5, "", ""), (None, 0, "user", "lost"), (104, -1, "a", "b" * 50_000)]
    rows += [(c, t, "user", "the same") for c in range(200, 320) for t in range(4)]  # a hot path, all in one node
    rows += [(450, t, "1", "2:x") for t in range(2)] + [(451, t, "12", ":x") for t in range(2)]
    same(trie(spark, rows), trie_by_hand(rows))


def test_trie_of_one_very_long_conversation(spark):
    rng = random.Random(4)
    rows = talk(rng, 500, 700) + [r for c in range(501, 540) for r in talk(rng, c, 12)]
    rows += [(540, t, r, x) for _, t, r, x in rows[:650]]
    same(trie(spark, rows), trie_by_hand(rows))


def test_trie_empty_and_turnless(spark):
    assert trie(spark, []) == []
    turnless = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 1)
    rows = [(turnless, 0, "user", "x")]
    assert len(trie_by_hand(rows)) == 1
    same(trie(spark, rows), trie_by_hand(rows))


def test_equal_values_of_different_texts_are_found(spark):
    cols = "conv_id long, d1 long, d2 long, role string, text string"
    entries = spark.createDataFrame([(1, 1, 5, 6, 1, 1, 7, 8, 3), (2, 2, 5, 6, 1, 1, 7, 8, 3)],
                                    "conv_id long, ref long, d1 long, d2 long, depth long, f1 long, f2 long, u1 long, chars long").withColumn("u2", F.lit(0))
    nodes = prefix_trie.nodes_of(entries)
    for other, right in (("abc", True), ("abd", False)):
        turns = spark.createDataFrame([(1, 5, 6, "user", "abc"), (2, 5, 6, "user", other), (3, 5, 6, "user", "not asked")], cols)
        assert prefix_trie.verified(turns, entries, nodes) is right
    assert not prefix_trie.verified(turns, entries, prefix_trie.nodes_of(entries.withColumn("u1", F.col("ref"))))
