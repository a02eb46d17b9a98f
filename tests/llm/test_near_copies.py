"""Embedding, MinHash and suffix dedup against brute force on small tables."""

import collections
import hashlib
import math
import random

import numpy as np
import pytest

from cardmill.llm import embedding_dedup, minhash_dedup, suffix_dedup
from cardmill.llm.components import connected_components
from cardmill.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(rows):
    rnd = random.Random(5)
    links = [(i, i + 1) for i in range(100, 160)] + [(rnd.randrange(400, 700), rnd.randrange(400, 700)) for _ in range(170)]
    links += [(9, 9), (3, 2), (2, 3)] + [(1000, k) for k in range(1001, 1100)]
    got = {r.node: r.root for r in connected_components(rows(links, "a long, b long")).collect()}
    expected = roots({x for ab in links for x in ab}, links)
    assert got == {n: r for n, r in expected.items() if n != r}
    assert connected_components(rows([], "a long, b long")).count() == 0


def brute_vectors(data, threshold):
    good = {}
    for i, v, label in data:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        good[i] = (np.array(v, dtype=float), label)
    links = []
    for a in good:
        for b in good:
            (x, lx), (y, ly) = good[a], good[b]
            if a < b and lx == ly and len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= threshold:
                links.append((a, b))
    count = collections.Counter(x for ab in links for x in ab)
    return links, count, roots([d[0] for d in data if d[0] is not None], links)


@pytest.mark.parametrize("tile", [1024, 16])
def test_vectors(rows, monkeypatch, tile):
    monkeypatch.setattr(embedding_dedup, "TILE_ROWS", tile)
    rng = np.random.default_rng(2)
    base = rng.standard_normal((30, 16))
    noisy = [(base[rng.integers(0, 30)] + rng.standard_normal(16) * s).tolist() for s in rng.choice([0, 0.02, 0.05, 0.09], 220)]
    data = [(i, [float(np.float32(x)) for x in v], int(rng.integers(0, 2))) for i, v in enumerate(noisy)]
    data += [(900, None, 1), (901, [], 1), (902, [0.0] * 16, 1), (903, [float("nan")] * 16, 1), (904, [1.0, None], 1)]
    data += [(905, noisy[0], None), (906, [1.0, 2.0], 1), (907, [2.0, 4.0], 1), (908, [1.0, 2.0], 1), (None, noisy[0], 1)]
    data += [(909, [float("inf"), 1.0], 1), (910, [1e200, 1.0], 0), (911, [1e-200, 0.0], 0)]
    links, count, root = brute_vectors(data, 0.98)
    frame = rows([(i, v, k, 3) for i, v, k in data], "vec_id long, embedding array<double>, label int, kept int")
    got = embedding_dedup.near_vectors(frame)
    assert got.columns == ["vec_id", "embedding", "label", "n_links", "component_id", "kept"]
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got.collect()}
    assert found.pop(None) == (0, None, False)
    links_of_909 = found[909][0]
    assert links_of_909 == 0
    assert len(links) > 100
    for i, _, _ in data:
        if i is not None and i < 910:
            assert found[i] == (count[i], root[i], root[i] == i), i
    assert found[910] == (1, 910, True) and found[911] == (1, 910, False)
    assert embedding_dedup.near_vectors(frame.limit(0)).count() == 0


def test_blocks_lose_no_link():
    rng = np.random.default_rng(1)
    x = embedding_dedup.unit(rng.standard_normal((400, 64)))
    y = embedding_dedup.unit(x + rng.standard_normal(x.shape) * 0.0247)
    close = (x * y).sum(1) >= 0.98
    turned = [v @ embedding_dedup.rotation(64) for v in (x, y)]
    total = embedding_dedup.budget(0.98)
    met = np.zeros(400, dtype=bool)
    for a, b in embedding_dedup.block_bounds(64):
        gap = ((turned[0] - turned[1])[:, a:b] ** 2).sum(1)
        inside = gap <= total * (b - a) / 64 + embedding_dedup.SLACK
        home, _ = embedding_dedup.cells_of(turned[0], a, b, total, 3)
        _, touched = embedding_dedup.cells_of(turned[1], a, b, total, 3)
        met |= inside
        assert all(tuple(home[i]) in touched[i] for i in np.flatnonzero(inside))
    assert 50 < close.sum() < 400 and met[close].all()


def words_of(text):
    return (text or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))).split()


def shingles(text):
    w = words_of(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_documents(data):
    sets = {i: shingles(t) for i, t in data}
    ids = sorted(sets)
    links = []
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                links.append((a, b))
    return sets, roots(ids, links), links


def near_texts(n=160, seed=4):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    bases = [[rnd.choice(vocabulary) for _ in range(rnd.choice([3, 40, 120, 400]))] for _ in range(25)]
    texts = []
    for _ in range(n):
        words = list(rnd.choice(bases))
        for _ in range(rnd.choice([0, 0, 1, 2, 4])):
            words[rnd.randrange(len(words))] = rnd.choice(vocabulary).upper()
        texts.append(rnd.choice([" ", "\n", "\t "]).join(words))
    return texts


@pytest.mark.parametrize("region", [2048, 4])
def test_documents(docs, monkeypatch, region):
    monkeypatch.setattr(minhash_dedup, "REGION_ROWS", region)
    if region < 2048:
        monkeypatch.setattr(minhash_dedup, "TILE_ROWS", 8)
        monkeypatch.setattr(minhash_dedup, "LEAST_DEPTH", 2)
    texts = [*near_texts(), None, "", " \n", "one two", "ONE\ttwo", "one", "same same same same same same same"]
    sets, root, links = brute_documents(list(enumerate(texts)))
    got = {r.doc_id: r for r in minhash_dedup.near_documents(docs(*texts)).collect()}
    assert len(links) > 100
    assert {i: len(s) for i, s in sets.items()} == {i: r.n_shingles for i, r in got.items()}
    assert {i: r.component_id for i, r in got.items()} == root
    assert all(r.kept == (r.component_id == i) for i, r in got.items())


def tail_pairs(n, words, tail, seed):
    """Documents 2 k and 2 k + 1 differ in the last ``tail`` of their words, so in as many shingles each."""
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        head = [f"w{rnd.randrange(10**6)}" for _ in range(words - tail)]
        out += [" ".join(head + [f"w{rnd.randrange(10**6)}" for _ in range(tail)]) for _ in range(2)]
    return out


def test_crowded_regions_lose_no_pair_at_80(docs, monkeypatch):
    # Every region of two counts as crowded, so pairs are compared at the last depth only.
    monkeypatch.setattr(minhash_dedup, "REGION_ROWS", 1)
    texts = tail_pairs(300, 184, 20, 1)
    a, b = (shingles(t) for t in texts[:2])
    assert 100 * len(a & b) == 80 * len(a | b)
    got = {r.doc_id: r.component_id for r in minhash_dedup.near_documents(docs(*texts), percent=80).collect()}
    assert got == {i: i - i % 2 for i in range(600)}


def test_trees_share_one_value_at_most():
    trees = [set(minhash_dedup.tree_values(t)) for t in range(2 * minhash_dedup.TREES)]
    assert all(len(t) == minhash_dedup.MOST_DEPTH and t <= set(range(minhash_dedup.HASHES)) for t in trees)
    assert all(len(a & b) <= 1 for i, a in enumerate(trees) for b in trees[:i])


def test_documents_of_odd_rows(docs):
    text = "a b c d e f g h"
    got = minhash_dedup.near_documents(docs(text, text, text, None, ids=[5, 5, None, 7])).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in got) == [(-1, -1, False), (5, 5, True), (5, 5, True), (7, 7, True)]
    assert minhash_dedup.near_documents(docs(text).limit(0)).count() == 0


def test_intersections_of_common_and_rare_elements():
    rng = np.random.default_rng(8)
    sets = [np.unique(rng.integers(0, 400, rng.integers(1, 90)).astype(np.uint64)) for _ in range(150)]
    sets += [np.union1d(s, np.arange(20, dtype=np.uint64)) for s in sets[:100]]
    got = minhash_dedup.intersections(sets)
    for a in range(0, 250, 7):
        for b in range(0, 250, 11):
            assert got[a, b] == len(np.intersect1d(sets[a], sets[b]))


def brute_repeats(texts, match):
    bodies = [(t or "").encode() for t in texts]
    count = collections.Counter(b[k : k + match] for b in bodies for k in range(len(b) - match + 1))
    out = []
    for b in bodies:
        gone = bytearray(len(b))
        for k in range(len(b) - match + 1):
            if count[b[k : k + match]] > 1:
                gone[k : k + match] = b"\1" * match
        spans = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        out.append((len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone, strict=True) if not g)))
    return out


def passage_texts():
    rnd = random.Random(6)

    def prose(n):
        return "".join(rnd.choice("abcdefgé \n") for _ in range(n))

    passages = [prose(n) for n in (150, 380, 400, 401, 450, 900, 2500)]
    texts = [None, "", "x" * 399, "y" * 400, "z" * 401, "ab" * 700]
    for _ in range(60):
        texts.append("".join(rnd.choice([prose(rnd.randrange(200)), rnd.choice(passages)]) for _ in range(rnd.randrange(1, 6))))
    return texts + texts[10:20]


@pytest.mark.parametrize("per_core", [2048, 3])
def test_repeats(docs, monkeypatch, per_core):
    monkeypatch.setattr(suffix_dedup, "CORE_PIECES", per_core)
    if per_core < 2048:
        monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 4000)
        monkeypatch.setattr(suffix_dedup, "SCAN_BYTES", 700)
    texts = passage_texts()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept_bytes)) for r in suffix_dedup.remove_repeats(docs(*texts)).collect()}
    expected = brute_repeats(texts, suffix_dedup.MATCH)
    assert sum(e[1] for e in expected) > 20_000
    assert [got[i] for i in range(len(texts))] == expected


def test_repeats_of_odd_rows(rows, docs):
    text = "q" * 10 + "".join(chr(97 + k % 23) + str(k) for k in range(200))
    frame = rows([(1, text, 5), (1, text, 6), (None, "short", 7)], "doc_id long, text string, n_bytes int")
    got = suffix_dedup.remove_repeats(frame)
    assert got.columns == ["doc_id", "text", "n_bytes", "n_removed", "n_spans", "kept_bytes"]
    assert sorted((r.n_removed, r.n_spans) for r in got.collect()) == [(0, 0), (len(text), 1), (len(text), 1)]
    assert suffix_dedup.remove_repeats(docs("a").limit(0)).count() == 0


def brute_passages(texts, n):
    words = [(t or "").encode().split() for t in texts]
    owners = collections.defaultdict(set)
    for i, w in enumerate(words):
        for k in range(len(w) - n + 1):
            owners[tuple(w[k : k + n])].add(i)
    out = []
    for w in words:
        gone = set()
        for k in range(len(w) - n + 1):
            if len(owners[tuple(w[k : k + n])]) > 1:
                gone.update(range(k, k + n))
        out.append(len(gone))
    return out


@pytest.mark.parametrize("per_core", [2048, 3])
def test_passages_below_the_match_in_bytes(docs, monkeypatch, per_core):
    monkeypatch.setattr(suffix_dedup, "CORE_PIECES", per_core)
    rnd = random.Random(8)

    def prose(n):
        return [rnd.choice("ab cd éf Gh ij".split()) + str(rnd.randrange(40)) for _ in range(n)]

    passages = [prose(n) for n in (50, 51, 52, 60, 90, 200)]
    texts = [None, "", " ".join(["the"] * 130), " ".join(["the"] * 70), " ".join(["a"] * 110), " ".join(prose(300))]
    for _ in range(60):
        parts = [rnd.choice([prose(rnd.randrange(60)), rnd.choice(passages)]) for _ in range(rnd.randrange(1, 6))]
        texts.append("".join(w + rnd.choice([" ", "\n", "\t "]) for p in parts for w in p))
    own = " ".join(prose(60))  # stands twice in one text only
    texts += [own + " " + own, " ".join(passages[1]), " ".join(passages[1]).upper(), *texts[10:14], "short", "short"]
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs(*texts), passages_col="n").collect()}
    expected = brute_passages(texts, suffix_dedup.PASSAGE)
    assert [got[i].n for i in range(len(texts))] == expected
    assert sum(e > 0 and got[i].n_removed == 0 for i, e in enumerate(expected)) > 5
    assert [got[i].n_removed for i in range(len(texts))] == [e[1] for e in brute_repeats(texts, suffix_dedup.MATCH)]


def test_the_cover_is_a_difference_cover():
    period, cover = suffix_dedup.PERIOD, suffix_dedup.COVER
    for i in range(period):
        for j in range(period):
            assert any((i + d) % period in cover and (j + d) % period in cover for d in range(period))


def test_queries_on_the_given_tables(spark):
    data = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    _, root, _ = brute_documents(list(data.items()))
    got = {r.doc_id: r.component_id for r in QUERIES["op4_minhash_dedup"](spark, SF).collect()}
    assert got == root
    expected = dict(zip(data, brute_repeats(data.values(), suffix_dedup.MATCH), strict=True))
    for r in QUERIES["op8_suffix_dedup"](spark, SF).collect():
        n, removed, spans, kept = expected[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (n, removed, spans, hashlib.sha256(kept).hexdigest())
    vectors = [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    _, count, root = brute_vectors(vectors, 0.98)
    for r in QUERIES["op2_embedding_dedup"](spark, SF).collect():
        assert (r.n_links, r.component_id) == (count[r.vec_id], root[r.vec_id])
