"""Each operator against brute force on small and messy inputs."""

import base64
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stormlake.llm import (decontaminate, jaccard_join, mixing, quality, shards, suffix_dedup, token_counts,
                           token_ids, topk, warc)
from stormlake.llm.common import Stages, pick
from stormlake.llm.components import components
from tests.llm.data import empty, messy, messy_rows, words

public_tokenizers = pytest.importorskip("public_tokenizers")


def narrow(df):
    return pick(df, doc_id="doc_id", text="text")


def by_row(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda t: tuple((x is None, x) for x in t))


# --- op1 ---------------------------------------------------------------------

def _encoded(rows, path):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    key = lambda r: (r[0] is not None, r[0] or 0)
    return sorted(((r[0], t.encode(r[1] or "", add_special_tokens=False).ids + [1]) for r in rows), key=key)


def test_token_ids_round_trip(spark):
    path = public_tokenizers.path(token_ids.VOCABULARY)
    stages = Stages(spark, "t")
    docs = pick(messy(spark), key="doc_id", text="text")
    got = token_ids.documents_in(stages, docs, stages.path("ids"), path, bucket_keys=4)
    exp, start = [], 0
    for doc_id, ids in _encoded(messy_rows(), path):
        exp.append((doc_id, start, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())))
        start += len(ids)
    rows = got.collect()
    strip = lambda t: collections.Counter((a, n, c) for a, _, n, c in t)
    assert strip(map(tuple, rows)) == strip(exp)
    # starts follow the order of ids; rows that share an id may come in either order
    unique = {d for d, k in collections.Counter(e[0] for e in exp).items() if k == 1}
    assert {tuple(r) for r in rows if r.doc_id in unique} == {e for e in exp if e[0] in unique}
    assert sorted((r.start, r.n_tokens) for r in rows)[0][0] == 0


def test_token_ids_empty(spark):
    stages = Stages(spark, "t")
    docs = pick(empty(spark), key="doc_id", text="text")
    assert token_ids.documents_in(stages, docs, stages.path("ids"), public_tokenizers.path(token_ids.VOCABULARY)).count() == 0


def test_index_lookup_and_raw_ids(spark):
    stages = Stages(spark, "t")
    root = stages.path("ids")
    path = public_tokenizers.path(token_ids.VOCABULARY)
    docs = spark.createDataFrame([(i, words(5 + i % 7, i)) for i in range(300)], "key long, text string")
    numbered = stages.save(token_ids.with_ordinal(token_ids.write_ids(stages, docs, root, path)))
    index = stages.save(token_ids.build_index(numbered, 7))
    asked = spark.createDataFrame([(i, 0) for i in (0, 17, 299, 5000, -4)], "key long, ordinal long")
    found = token_ids.read_ids(token_ids.lookup(asked, index, 7), root).collect()
    exp = dict(_encoded([(i, words(5 + i % 7, i)) for i in (0, 17, 299)], path))
    assert {r.key: r.ids for r in found} == exp  # keys that are not there fail the fingerprint


def test_perfect_hash_is_minimal():
    for n in (0, 1, 2, 1000, 50_000):
        h = token_ids.hash_key(np.arange(n), np.zeros(n))
        p = token_ids.PerfectHash.build(h)
        assert sorted(p(h).tolist()) == list(range(n))
    with pytest.raises(ValueError):
        token_ids.PerfectHash.build(np.zeros(2, np.uint64))


def test_encoder_equals_library():
    e = token_ids.Encoder(public_tokenizers.path(token_ids.VOCABULARY), cache_pieces=50)
    assert e.separable
    texts = [r[1] or "" for r in messy_rows()] + [
        "a's b'll it's. don't!! <|endoftext|> x <|endoftext|>.", "ÀÉ'S. İstanbul, ΣΑΣ.  a b ćd 12a3.4!? ﬁ K.\ttab\nnl",
        " ", "́.", "日本。語.", "a‍b.", "éé. Ä", "\x85x\xa0y\x1cz."]
    for t in texts:
        assert e(t) == np.asarray(e.tokenizer.encode(t, add_special_tokens=False).ids, "<u2").tobytes(), t


# --- op2 ---------------------------------------------------------------------

def _top(vectors, k, every):
    dim = max((len(v) for v in vectors.values()), default=0)
    pad = {i: np.asarray(list(v) + [0] * (dim - len(v))) for i, v in vectors.items()}
    out = []
    for q in sorted(pad):
        if q % every == 0:
            scored = sorted(((-int(pad[q] @ pad[c]), c) for c in pad if c != q))[:k]
            out += [(q, r, c, -s) for r, (s, c) in enumerate(scored, 1)]
    return sorted(out)


@pytest.mark.parametrize("clustered", [False, True])
def test_topk_equals_brute_force(spark, monkeypatch, clustered):
    monkeypatch.setattr(topk, "DATA_BLOCK", 40)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 5)
    monkeypatch.setattr(topk, "RUN", 2)
    r = np.random.default_rng(3)
    centres = r.integers(-60, 60, (6, 8))
    v = {i: (centres[i % 6] + r.integers(-2, 3, 8) if clustered else r.integers(-3, 4, 8)).tolist() for i in range(260)}
    v[7] = v[6] = v[5]  # ties
    v[9] = v[9][:5]     # a shorter vector
    rows = spark.createDataFrame([(i, x) for i, x in v.items()], "vec_id long, vector array<long>")
    rows = rows.unionByName(rows.where("vec_id < 3")).unionByName(spark.createDataFrame([(None, [1] * 8)], rows.schema))
    got = topk.search(Stages(spark, "t"), rows, F.col("vec_id") % 20 == 0, 6)
    assert by_row(got, "query_id", "rank", "vec_id", "score") == _top(v, 6, 20)


def test_topk_prunes_clusters():
    r = np.random.default_rng(1)
    x = (r.integers(-200, 200, (20, 16))[r.integers(0, 20, 4000)] + r.integers(-2, 3, (4000, 16))).astype(np.int64)
    data, asked = topk.CoverTree.build(x, np.arange(4000)), topk.CoverTree.build(x[:1000], np.arange(1000))
    s = topk.Search(asked, 5)
    s.run(data)
    assert s.compared < 0.3 * 4000 * 1000
    for i, (_, _, centre, child, n) in enumerate(data.nodes):  # covering
        a, b = data.nodes[i][:2]
        assert np.sqrt(((data.points[a:b] - data.points[centre]) ** 2).sum(1)).max() <= data.radius[i] + 1e-9


def test_topk_unusable_vectors(spark):
    rows = spark.createDataFrame([(0, [1.0, 2.0]), (1, [float("nan"), 1.0]), (2, None), (3, [None, 1.0]), (4, [float("inf"), 0.0]),
                                  (5, [-0.01, 0.5])], "vec_id long, embedding array<float>")
    v = pick(rows.where(topk.usable(F.col("embedding"))), vec_id="vec_id", vector=topk.quantised(rows["embedding"]))
    got = topk.search(Stages(spark, "t"), v, F.col("vec_id") % 5 == 0)
    assert by_row(got, "query_id", "rank", "vec_id", "score") == [(0, 1, 5, 64 * -1 + 128 * 32), (5, 1, 0, 64 * -1 + 128 * 32)]
    assert topk.search(Stages(spark, "t"), v.limit(0), F.col("vec_id") % 5 == 0).count() == 0


# --- op3 ---------------------------------------------------------------------

def _low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def _words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", _low(t))


def _contaminated(rows, items, w=10):
    out = []
    for d, t, *_ in rows:
        ws, hit, names = _words(t), set(), set()
        for i, it in items:
            iw = _words(it)
            for p in ([iw[j:j + w] for j in range(max(1, len(iw) - w + 1))] if iw else []):
                for s in range(len(ws) - len(p) + 1):
                    if ws[s:s + len(p)] == p:
                        hit.update(range(s, s + len(p)))
                        names.add("" if i is None else str(i))
        out.append((d, len(ws), len(hit), sorted(names), bool(hit)))
    return sorted(out, key=str)


def _items():
    base = messy_rows()[0][1].split(" ")
    return [(1, " ".join(base[30:55])), (2, "TWO two"), (10, "a b c d e"), (3, None), (4, ""), (5, "!!"), (2, words(30, 9)),
            (None, "日本語"), (6, " ".join(base[30:45])), (7, "Straße 日本語")]


def test_decontaminate_equals_brute_force(spark):
    items = spark.createDataFrame(_items(), "item_id long, text string")
    for rarest in (1, 2, 3):
        got = decontaminate.contamination(narrow(messy(spark)), items, rarest=rarest)
        rows = sorted((tuple(r) for r in got.select("doc_id", "n_words", "n_hit", "items", "contaminated").collect()), key=str)
        assert rows == _contaminated(messy_rows(), _items())


def test_decontaminate_empty_sides(spark):
    items = spark.createDataFrame(_items(), "item_id long, text string")
    assert decontaminate.contamination(narrow(empty(spark)), items).count() == 0
    got = decontaminate.contamination(narrow(messy(spark)), items.limit(0))
    assert got.where("contaminated").count() == 0 and got.count() == len(messy_rows())


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "one x two y three"), (2, "three one z z two"), (3, "one two q q q q q q three"), (4, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    stages = Stages(spark, "t")
    vocabulary, _, parts = decontaminate.phrases_of(stages, items)
    postings = decontaminate.build_index(stages, docs, vocabulary)
    near = lambda n: {r.doc_id for r in decontaminate.proximity_matches(stages, postings, parts, n).collect()}
    assert near(4) == {1, 2} and near(8) == {1, 2, 3} and near(1) == set()


# --- op4 ---------------------------------------------------------------------

def _classes(rows, similarity=0.8):
    sets = []
    for d, t, *_ in rows:
        w = _words(t)
        sets.append((d, frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])))
    n, root, links = len(sets), list(range(len(sets))), [0] * len(sets)

    def find(x):
        return x if root[x] == x else find(root[x])
    for i in range(n):
        for j in range(i):
            a, b = sets[i][1], sets[j][1]
            if a and b and len(a & b) >= similarity * len(a | b):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    group = collections.defaultdict(list)
    for i in range(n):
        group[find(i)].append(sets[i][0])
    least = lambda ids: min((x for x in ids if x is not None), default=None)
    return sorted(((sets[i][0], least(group[find(i)]) if sets[i][1] else sets[i][0], links[i], len(sets[i][1])) for i in range(n)), key=str)


def _family(seed, n, share):
    r, base = random.Random(seed), words(100, seed).split(" ")
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randrange(share)):
            w[r.randrange(len(w))] = f"new{r.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


def test_jaccard_join_equals_brute_force(spark):
    rows = messy_rows() + [(100 + i, t, "en", "a", 1) for i, t in enumerate(_family(50, 40, 6) + _family(51, 5, 2) + _family(50, 3, 1))]
    for settings in ({}, {"bucket": 4, "block": 8}):
        got = jaccard_join.jaccard_join(narrow(messy(spark, rows)), recall=0.9999, **settings)
        assert sorted((tuple(r) for r in got.select("doc_id", "class_id", "n_links", "n_shingles").collect()), key=str) == _classes(rows)


def test_jaccard_last_level_nodes_are_compared_in_blocks(spark, monkeypatch):
    """Near copies stay together through all levels; no task's group holds more than two blocks of them."""
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(_family(60, 150, 4) + _family(61, 20, 3))]
    real = jaccard_join._pairs_in_nodes

    def bounded(*args):
        solve = real(*args)

        def run(batches):
            def seen():
                for pdf in batches:
                    sizes = pdf.groupby([c for c in ("node", "i", "j") if c in pdf]).size()
                    assert not len(sizes) or sizes.max() <= 48, sizes.max()
                    yield pdf
            yield from solve(seen())
        return run

    monkeypatch.setattr(jaccard_join, "_pairs_in_nodes", bounded)
    got = jaccard_join.jaccard_join(narrow(messy(spark, rows)), recall=0.9999, bucket=12, block=16, node_block=12)
    assert sorted((tuple(r) for r in got.select("doc_id", "class_id", "n_links", "n_shingles").collect()), key=str) == _classes(rows)


def test_jaccard_large_nodes_of_near_copies_are_not_split(spark):
    """Sets near their node's head are tied to it: no level has more rows than the runs' roots; every tie is kept."""
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(_family(62, 120, 4) + _family(63, 40, 30))]

    class Counted(Stages):
        levels = []

        def save(self, df, what="stage"):
            out = super().save(df, what)
            if what.startswith("level"):
                self.levels.append(out.count())
            return out

    docs = narrow(messy(spark, rows))
    got = jaccard_join.jaccard_join(docs, recall=0.9999, bucket=12, block=16, node_block=12, stages=Counted(spark, "jaccard"))
    assert sorted((tuple(r) for r in got.select("doc_id", "class_id", "n_links", "n_shingles").collect()), key=str) == _classes(rows)
    assert Counted.levels == sorted(Counted.levels, reverse=True), Counted.levels


def test_jaccard_moderate_nodes_are_split_in_their_task(spark):
    """Nodes of a few blocks take no shuffle a level, whatever they hold: one level table, and every tie is kept."""
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(_family(64, 60, 4) + _family(65, 60, 40) + _family(66, 30, 9))]
    levels = []

    class Counted(Stages):
        def save(self, df, what="stage"):
            levels.extend([what] if what.startswith("level") else [])
            return super().save(df, what)

    got = jaccard_join.jaccard_join(narrow(messy(spark, rows)), recall=0.9999, bucket=6, stages=Counted(spark, "jaccard"))
    assert sorted((tuple(r) for r in got.select("doc_id", "class_id", "n_links", "n_shingles").collect()), key=str) == _classes(rows)
    assert levels == ["level1"], levels


def test_texts_go_to_workers_in_small_batches(spark):
    """Batches of texts are bounded in rows and bytes before a stage's tasks hold them."""
    names = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")
    for run in (lambda: jaccard_join.jaccard_join(narrow(messy(spark))),
                lambda: quality.keep_good(messy(spark), spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int"))):
        for name in names:
            spark.conf.unset(name)
        run()
        assert [spark.conf.get(name) for name in names] == ["1000", "4m"]


def test_jaccard_keep_one(spark):
    kept = jaccard_join.keep_one(messy(spark))
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == messy(spark).columns
    assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 6, 7, 8, 10, 11, 12, 13]  # 5 and 9 are like 3, 12 came twice
    assert ids.count(None) == 2
    assert jaccard_join.keep_one(empty(spark)).count() == 0


def test_runs_grow_with_recall():
    assert jaccard_join.runs_for(0.9) < jaccard_join.runs_for(0.99) < jaccard_join.runs_for(0.9999)


def test_components(spark):
    r = random.Random(4)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1060)]
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    exp = {x: find(x) for a, b in edges if a != b for x in (a, b)}
    got = components(Stages(spark, "t"), spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.root for r in got.collect()} == exp


# --- op5 ---------------------------------------------------------------------

def _removed(rows, length, hashes=None):
    order = sorted({(r[0], r[1]) for r in rows}, key=lambda r: (r[0] is not None, r[0] or 0, hashes[r[1]] if hashes else 0))
    seen, out = set(), {}
    for d, t in order:
        b = (t or "").encode()
        mark, new = bytearray(len(b)), []
        for p in range(len(b) - length + 1):
            s = b[p:p + length]
            if s in seen:
                mark[p:p + length] = b"\1" * length
            seen.add(s)
        out[(d, t)] = (len(b), sum(mark), sum(1 for i, m in enumerate(mark) if m and (not i or not mark[i - 1])),
                       hashlib.sha256(bytes(x for x, m in zip(b, mark) if not m)).hexdigest())
    return collections.Counter((r[0], *out[(r[0], r[1])]) for r in rows)


@pytest.mark.parametrize("hot", [20_000, 2])
def test_suffix_dedup_equals_brute_force(spark, hot):
    r = random.Random(8)
    rows = [(i, "".join(r.choice("ab") for _ in range(r.randrange(90))), "en", "a", 1) for i in range(40)]
    rows += [(50 + i, "zz" + words(12, 77) + "." * i, "en", "a", 1) for i in range(6)] + [(90, "q" * 200, "en", "a", 1)]
    got = suffix_dedup.remove_repeats(narrow(messy(spark, rows)), length=14, gram=5, hot=hot)
    assert collections.Counter(tuple(x) for x in got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()) == _removed(rows, 14)


def test_suffix_dedup_messy(spark):
    rows = [x for x in messy_rows() if x[0] is not None]
    got = suffix_dedup.remove_repeats(narrow(messy(spark, rows)))
    assert collections.Counter(tuple(x) for x in got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()) == _removed(rows, 100)
    assert suffix_dedup.remove_repeats(narrow(messy(spark))).count() == len(messy_rows())
    assert suffix_dedup.remove_repeats(narrow(empty(spark))).count() == 0


@pytest.mark.parametrize("hot", [20_000, 2])
def test_suffix_dedup_null_ids_first_then_texts_of_one_id_by_hash(spark, hot):
    r = random.Random(18)
    ids, passage = [None, 7, None, 7, 3, None, 7, -2], words(12, 79)
    rows = [(ids[i % 8], "".join(r.choice("ab") for _ in range(r.randrange(40))) + passage[i:i + 40], "en", "a", 1) for i in range(40)]
    rows += [(7, passage, "en", "a", 1), (None, passage, "en", "a", 1), (None, None, "en", "a", 1), (7, None, "en", "a", 1), (None, "", "en", "a", 1)]
    rows += rows[:5]
    docs = narrow(messy(spark, rows))
    hashes = {x.text: x.h for x in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    got = suffix_dedup.remove_repeats(docs, length=14, gram=5, hot=hot)
    assert collections.Counter(tuple(x) for x in got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()) \
        == _removed(rows, 14, hashes)


def test_anchors_over_segments(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 64)
    import pandas as pd
    text = words(60, 5).encode()
    pdf = pd.DataFrame({"doc_id": pd.array([1], "Int64"), "text_hash": [1], "text": [text]})
    rows = pd.concat(list(suffix_dedup._find_anchors(20, 6)([pdf])))
    starts = [p for r in rows.itertuples() for p in range(r.pos - (r.span & 255), r.pos - (r.span >> 8) + 1)]
    assert sorted(starts) == list(range(len(text) - 20 + 1))


def test_suffix_sort_order_and_neighbours():
    r = random.Random(2)
    rows = [bytes(r.choice(b"ab") for _ in range(r.randrange(12))) for _ in range(300)]
    group = np.sort(np.asarray([r.randrange(9) for _ in rows]))
    s = suffix_dedup.Suffixes(rows, 12)
    order = s.sort(group)
    got = [(group[i], rows[i]) for i in order]
    assert got == sorted(got)
    common = s.neighbours(order)
    for k, (i, j) in enumerate(zip(order[:-1], order[1:]), 1):
        a, b = rows[i], rows[j]
        n = next((x for x in range(min(len(a), len(b))) if a[x] != b[x]), min(len(a), len(b)))
        assert common[k] == n


# --- op6 ---------------------------------------------------------------------

def test_shards(spark):
    rows = messy_rows() + [(1000 + i, str(i), "en", "a", 1) for i in range(2000)]
    got = shards.shard_table(messy(spark, rows), "doc_id", "text", shards=7).collect()
    assert len(got) == len(rows)
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.law == "key" and r.grown_shard in (r.shard, 7)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) == set(range(7))
    sizes = collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got)
    assert sizes == collections.Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    assert 150 < sum(r.grown_shard == 7 for r in got) < 350  # about an eighth moves
    assert shards.shard_table(empty(spark), "doc_id", "text").count() == 0


def test_shards_by_weight(spark):
    d = spark.range(4000).select(shards.rendezvous(F.col("id"), [3.0, 1.0]).alias("s")).groupBy("s").count()
    n = {r.s: r["count"] for r in d.collect()}
    assert 2850 < n[0] < 3150


def test_shards_written(spark):
    path = Stages(spark, "t").path("shards")
    shards.write_shards(messy(spark).drop("shard"), "doc_id", path, shards=3)
    assert spark.read.parquet(path).count() == len(messy_rows())


# --- op7 ---------------------------------------------------------------------

def _targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        t = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if t[s] > 3 * sizes[s]]
        if not above:
            return {**fixed, **t}
        fixed |= {s: 3.0 * sizes[s] for s in above}


def test_mix_meets_targets(spark):
    rows = messy_rows() + [(100 + i, words(10 + i % 90, i), "en", "abcde"[i % 5] if i % 3 else "a", 1) for i in range(400)]
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = collections.defaultdict(int)
    for _, t, _, s, _ in rows:
        sizes[s] += size(t)
    df = messy(spark, rows)
    picked = pick(df, doc_id="doc_id", source="source", size=mixing.words_in(df["text"]))
    got = mixing.taken(*mixing.mix(Stages(spark, "t"), picked, shard_blocks=32)).collect()
    again = mixing.taken(*mixing.mix(Stages(spark, "t"), picked.repartition(5), shard_blocks=32)).collect()
    key = lambda rs: collections.Counter((r.doc_id, r.size, r.taken) for r in rs)
    assert key(got) == key(again) and len(got) == len(rows)
    aims, by = _targets(sizes), collections.defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - aims[r.source]) < 1e-6 and r.taken <= 3 * r.size
        by[r.source] += r.taken
    for s, t in aims.items():
        assert abs(by[s] - t) <= 0.5 + 1e-6, (s, by[s], t)


def _mixed(spark, rows, **settings):
    df = spark.createDataFrame(rows, "doc_id long, source string, size long").repartition(3)
    return mixing.taken(*mixing.mix(Stages(spark, "t"), df, **settings)).collect()


@pytest.mark.parametrize("sizes", [[40] * 6, [100] * 3, [1, 1, 1], [64, 128, 63, 65, 1000, 7], [0, 5, 0]])
def test_mix_small_sources_meet_targets_to_the_word(spark, sizes):
    rows = [(i * 100 + k, f"s{i}", n) for i, total in enumerate(sizes) for k, n in enumerate([total // 3, total - total // 3])]
    aims, by = _targets({f"s{i}": n for i, n in enumerate(sizes)}) if sum(sizes) else {}, collections.defaultdict(int)
    for r in _mixed(spark, rows, shard_blocks=2):
        by[r.source] += r.taken
        assert r.taken <= 3 * r.size
    assert all(abs(by[s] - t) <= 0.5 + 1e-6 for s, t in aims.items()), (aims, dict(by))


def test_mix_taken_follows_slots_and_blocks(spark):
    """Every word by hand: a source's run of words, its blocks, and the slots that take them."""
    rows = [(i, "ab"[i % 2], 1 + (i * 37) % 150) for i in range(60)] + [(7, "c", 30)] * 3
    stages, df = Stages(spark, "t"), spark.createDataFrame(rows, "doc_id long, source string, size long").repartition(3)
    docs, slots, pieces = mixing.mix(stages, df, shard_blocks=8)
    got, drawn = mixing.taken(docs, slots, pieces).collect(), slots.collect()
    words = collections.Counter()  # of a source's run
    for s in drawn:
        for w in range(s.block * mixing.BLOCK, s.block * mixing.BLOCK + s.words):
            words[s.no, w] += 1
    for r in got:
        assert r.taken == sum(words[r.no, w] for w in range(r.start, r.start + r.size))
    starts = collections.Counter((r.no, w) for r in got for w in range(r.start, r.start + r.size))
    assert set(starts.values()) == {1} and set(words) <= set(starts)  # places are the source's words, each once
    for no in {s.no for s in drawn}:  # an epoch takes each block once, and only a source's last slot is cut short
        own = sorted((s for s in drawn if s.no == no), key=lambda s: s.slot)
        n = -(-sum(r.size for r in got if r.no == no) // mixing.BLOCK)
        assert [s.slot for s in own] == list(range(len(own)))
        for e in range(0, len(own), n):
            assert len({s.block for s in own[e:e + n]}) == len(own[e:e + n])
        assert all(s.whole for s in own[:-1])


def test_mix_shards_follow_multinomial_draws(spark):
    got = mixing.draw_counts(np.asarray([700, 200, 100]), np.asarray([100] * 10), np.random.default_rng(1))
    assert got.sum(0).tolist() == [700, 200, 100] and (got.sum(1) == 100).all()
    for n in (1, 2, 5, 64, 1000):
        p = mixing.permute(np.arange(n), np.full(n, n), np.full(n, 9))
        assert sorted(p.tolist()) == list(range(n))


def test_mixed_documents(spark):
    df = messy(spark)
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns and out.where("text IS NULL OR text = ''").count() == 0
    assert out.groupBy("doc_id", "text").count().agg(F.max("count")).first()[0] <= 6  # doc 12 is there twice
    assert mixing.mixed_documents(empty(spark)).count() == 0


def test_mixed_documents_meet_targets_with_long_texts(spark):
    """Sources of long texts only: a source whose target is a third of its size keeps about that many words."""
    rows = [(i, words(640 + i % 7, i % 20), "en", "abc"[i % 3], 1) for i in range(600)]
    rows += [(None, words(700, 1), "en", "c", 1)] * 60 + [(None, words(500, i), "en", "b", 1) for i in range(60)]
    size = lambda t: len(t.split(" "))
    sizes, out = collections.defaultdict(int), collections.defaultdict(int)
    for _, t, _, s, _ in rows:
        sizes[s] += size(t)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    kept = mixing.mixed_documents(df).collect()
    for r in kept:
        out[r.source] += size(r.text)
    for s, t in _targets(sizes).items():
        assert abs(out[s] - t) <= 0.15 * t, (s, sizes[s], t, out[s])
    # equal rows share their total: 60 rows of c at a third are neither all left out nor all kept
    assert 5 <= sum(r.doc_id is None and r.source == "c" for r in kept) <= 40
    again = mixing.mixed_documents(df.repartition(5)).collect()
    assert collections.Counter((r.doc_id, r.source) for r in kept) == collections.Counter((r.doc_id, r.source) for r in again)


# --- op8 ---------------------------------------------------------------------

def _pages(spark, rows):
    return spark.createDataFrame(rows, "key long, url string, payload binary").repartition(3)


def test_warc_round_trip(spark):
    big = words(3000, 3).encode()
    rows = [(i, f"http://x/{i}", words(30, i % 40).encode()) for i in range(100)]
    rows += [(200, "u\r\nWARC-Type: fake", b""), (201, None, None), (202, "é", big), (203, "x", b"\r\n\r\nWARC/1.1\r\n"), (None, "n", big), (300, "y", b"once")]
    root = Stages(spark, "t").path("warc")
    manifest = warc.write_warc(_pages(spark, rows), root, volume_bytes=20_000, roll_bytes=4_000)
    files = manifest.collect()
    assert len({f.volume for f in files}) > 1 and max(f.no for f in files) > 0
    got = warc.read_warc(manifest, root).collect()
    assert len(got) == len(rows)
    last = {}
    for k, _, p in rows:
        if k is not None:
            last[p or b""] = max(k, last.get(p or b"", k))
    for r in got:
        k, u, p = next(x for x in rows if x[0] == r.key)
        p = p or b""
        assert r.payload_bytes == len(p) and r.payload_digest == base64.b32encode(hashlib.sha1(p).digest()).decode()
        first = last.get(p, k) == k
        assert (r.record_type, r.refers_to) == (("response", None) if first else ("revisit", last[p]))
        assert (bytes(r.payload) == p) if first else r.payload is None
    again = Stages(spark, "t").path("warc")
    other = warc.write_warc(_pages(spark, rows[::-1]).repartition(5), again, volume_bytes=20_000, roll_bytes=4_000)
    assert {(f.file, f.sha1) for f in other.collect()} == {(f.file, f.sha1) for f in files}  # the same bytes


def test_warc_volumes_are_cut_by_what_is_sent(spark):
    """Equal pages and pages of one key: no volume's task gets much more than volume_bytes."""
    same = bytes(range(256)) * 200
    rows = [(i, "u", same) for i in range(100)] + [(1000, f"v{i}", words(2000, i).encode()) for i in range(40)]
    root = Stages(spark, "t").path("warc")
    manifest = warc.write_warc(_pages(spark, rows), root, volume_bytes=200_000)
    sent = collections.Counter()
    size = {k: len(p) for k, _, p in rows}
    files = manifest.collect()
    for f in files:
        sent[f.volume] += f.records * max(size[f.first_key], size[f.last_key])
    assert max(sent.values()) <= 2 * 200_000 and len({f.volume for f in files if f.first_key == f.last_key == 1000}) > 1
    got = warc.read_warc(manifest, root).collect()
    assert collections.Counter(r.record_type for r in got) == {"revisit": 99, "response": 41}


def test_warc_minimum_and_empty(spark):
    rows = [(1, "a", b"tiny"), (2, "b", b"tiny"), (3, "c", b"not so tiny"), (4, "d", b"not so tiny"), (4, "d", b"not so tiny")]
    root = Stages(spark, "t").path("warc")
    got = warc.read_warc(warc.write_warc(_pages(spark, rows), root, min_revisit=5), root)
    assert by_row(got, "key", "record_type") == [(1, "response"), (2, "response"), (3, "revisit"), (4, "response"), (4, "response")]
    root = Stages(spark, "t").path("warc")
    assert warc.read_warc(warc.write_warc(_pages(spark, []), root), root).count() == 0


# --- op9 ---------------------------------------------------------------------

def _greedy(word, begin, inside):
    n = at = 0
    longest = max(map(len, begin | inside))
    while at < len(word):
        end = next((e for e in range(min(len(word), at + longest), at, -1) if word[at:e] in (begin if at == 0 else inside)), None)
        if end is None:
            return 0
        n, at = n + 1, end
    return n


def test_piece_counts_equal_greedy():
    r = random.Random(6)
    for _ in range(30):
        piece = lambda: "".join(r.choice("abé") for _ in range(r.randrange(1, 5)))
        begin, inside = {piece() for _ in range(6)}, {piece() for _ in range(8)}
        asked = ["".join(r.choice("abéc") for _ in range(r.randrange(1, 14))) for _ in range(80)] + ["ab" * 4000]
        got = token_counts.PieceCounter(sorted(begin), sorted(inside)).counts(asked)
        assert got.tolist() == [_greedy(w, begin, inside) for w in asked]


def test_a_word_of_five_million_letters():
    import time
    r = random.Random(7)
    begin, inside = {"a", "ab", "b", "aab"}, {"a", "b", "abab", "bba", "é"}
    counter = token_counts.PieceCounter(sorted(begin), sorted(inside))
    word = "".join(r.choices("abé", k=300))
    began = time.time()
    got = counter.counts(["a" + word, "a" * 5_000_000, word[:7], "b" + "ab" * 1000, "c"])
    assert time.time() - began < 10
    assert got.tolist() == [_greedy("a" + word, begin, inside), 5_000_000, _greedy(word[:7], begin, inside),
                            _greedy("b" + "ab" * 1000, begin, inside), 0]


def test_token_counts_equal_library(spark):
    from tokenizers import models
    path = public_tokenizers.path(token_counts.VOCABULARY)
    begin, inside = token_counts.pieces_of(path)
    names = {"[UNK]": 0} | {p: i for i, p in enumerate(begin, 1)}
    names |= {"##" + p: len(names) + i for i, p in enumerate(inside)}
    model = models.WordPiece(names, unk_token="[UNK]", max_input_chars_per_word=10 ** 6)
    exp = []
    for d, t, *_ in messy_rows():
        w = token_counts.words_of(t or "")
        got = [[x.value for x in model.tokenize(x)] for x in w]
        exp.append((d, len(w), sum(map(len, got)), sum(g == ["[UNK]"] for g in got)))
    got = token_counts.token_counts(narrow(messy(spark)), path, most_words=50)
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(exp, key=str)
    assert token_counts.token_counts(narrow(empty(spark)), path).count() == 0


# --- op10 --------------------------------------------------------------------

def _labelled(n):
    rows = []
    for i in range(n):
        good = i % 4 > 0
        t = words(40, i)
        rows.append((i, t if good else t.upper().replace(" ", "!! "), int(good)))
    return rows


def test_quality_learns_and_scores_all(spark):
    rows = _labelled(400)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(None, "plain words here"), (900, None), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(None, 1), (3, None), (5, 1), (5, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.quality_scores(docs, labels).collect()}
    assert len(got) == 403 and all(0 <= r.score <= 1 for r in got.values())
    held = [r for r in got.values() if r.held_out]
    assert held and all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in held)
    right = [got[i].predicted == q for i, _, q in rows if got[i].held_out]
    assert np.mean(right) > 0.97 and got[900].score == got[901].score


def test_quality_held_out_labels_are_not_used(spark):
    rows = _labelled(200)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    flip = lambda i, q: 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q
    scores = [quality.quality_scores(docs, spark.createDataFrame([(i, f(i, q)) for i, _, q in rows], "doc_id long, quality int"))
              for f in (lambda i, q: q, flip)]
    a, b = ({r.doc_id: r.score for r in s.collect()} for s in scores)
    assert a == b


def test_quality_degenerate(spark):
    docs, labels = narrow(messy(spark)), spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
    assert all(r.score > 0.99 for r in quality.quality_scores(docs, labels).collect())
    assert all(r.score == 0.5 for r in quality.quality_scores(docs, labels.limit(0)).collect())
    assert quality.quality_scores(narrow(empty(spark)), labels).count() == 0
    kept = quality.keep_good(messy(spark), labels)
    assert kept.columns == messy(spark).columns and kept.count() == len(messy_rows())


def test_additive_model_finds_an_interaction():
    r = np.random.default_rng(0)
    x = r.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    m = quality.AdditiveModel.fit(x, y, n_pairs=1)
    assert {m.pairs[0][0], m.pairs[0][1]} == {0, 1}
    assert ((m.score(x) > 0.5) == y).mean() > 0.9
