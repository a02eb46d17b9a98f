"""Merkle manifest, URL templates and periodic runs against plain Python."""

import collections
import hashlib
import random
import re
import zlib
from itertools import groupby

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from cardmill.llm import merkle, periodic, url_templates
from cardmill.llm.queries import QUERIES, URL_RULES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(*values):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def lower(text):
    return text if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def tree_of(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha(*below[i : i + 16]) for i in range(0, len(below), 16)])
    return levels


def way_up(levels, at):
    steps = []
    for level in levels[:-1]:
        run = level[at - at % 16 : at - at % 16 + 16]
        steps.append((at % 16, run[: at % 16] + run[at % 16 + 1 :]))
        at //= 16
    return steps


def manifest(rows):
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of tuples (doc_id, text, lang, source, n_chars)."""
    trees = collections.defaultdict(list)
    for doc, text, lang, source, chars in rows:
        tampered = doc is not None and zlib.crc32(str(doc).encode()) % 5 == 0
        leaf = leaf_of(doc, source, lang, chars, text)
        claimed = leaf_of(doc, source, lang, chars, lower(text)) if tampered else leaf
        trees[source].append(((doc is not None, doc), leaf, claimed))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    levels = {name: tree_of([leaf for _, leaf, _ in sorted(trees[name])]) for name in names}
    top = tree_of([levels[name][-1][0] for name in names])
    out = []
    for place, name in enumerate(names):
        for at, ((_, doc), leaf, claimed) in enumerate(sorted(trees[name])):
            steps = way_up(levels[name], at) + way_up(top, place)
            folded = claimed
            for own, others in steps:
                folded = sha(*others[:own], folded, *others[own:])
            root = top[-1][0]
            out.append((doc, leaf, levels[name][-1][0], root, sha(*(x for _, o in steps for x in o)), folded, folded == root))
    return collections.Counter(out)


def own_manifest(df, **more):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = {"text": F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")}
    return merkle.merkle_manifest(df, claimed=lowered, claimed_where=tampered, **more)


def test_manifest_of_the_given_table(spark):
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    rows = pq.read_table(f"{SF}/documents.parquet", columns=names).to_pylist()
    got = QUERIES["op11_merkle_manifest"](spark, SF).collect()
    assert collections.Counter(tuple(r) for r in got) == manifest([tuple(r[n] for n in names) for r in rows])
    assert {r["verified"] for r in got} == {True, False}


ODD_DOCS = [
    *[(i, f"Text {i} É", "en", "big", 9) for i in range(300)],
    (7, "Text 7 É", "en", "big", 9),  # a repeated row
    (7, "Another TEXT", "en", "big", 9),  # and another one with its id
    (None, "No Id", None, "big", None),
    *[(1000 + i, None, "de", None, None) for i in range(17)],
    (2000, "", None, "", 0),
    (3000, "alone", "en", "Ä", 5),
    (9007199254740993, "X" * 300_000, "en", "z", 300_000),
    *[(4000 + i, "A b", "en", f"s{i}", 3) for i in range(20)],
]


@pytest.mark.parametrize("block_levels", [1, 2, 3])
def test_manifest_of_odd_rows_in_any_superblocks(rows, block_levels):
    """Small superblocks make several rounds, for sources and for the tree of the sources."""
    docs = rows(ODD_DOCS, DOCS).withColumns({"digest": F.lit(1), "tree": F.lit(2)})
    got = own_manifest(docs, block_levels=block_levels)
    assert collections.Counter(tuple(r) for r in got.collect()) == manifest(ODD_DOCS)


def test_proofs_fold_to_the_root(rows):
    docs = rows(ODD_DOCS[:40], DOCS)
    for r in merkle.merkle_manifest(docs, proofs=True).collect():
        assert merkle.fold(r["leaf"], [(s["place"], s["others"]) for s in r["proof"]]) == r["root"]
        assert r["verified"]
        assert sha(*(x for s in r["proof"] for x in s["others"])) == r["proof_sha256"]


def test_manifest_of_nothing_and_of_one(rows):
    assert own_manifest(rows([], DOCS)).collect() == []
    (one,) = own_manifest(rows([(5, "a", "en", None, 1)], DOCS)).collect()
    assert one["leaf"] == one["subroot"] == one["root"] == one["folded_root"]
    assert one["proof_sha256"] == sha("")


def test_lengths_keep_fields_apart(rows):
    a, b = (merkle.merkle_manifest(rows([r], DOCS)).first()["leaf"] for r in [(1, "x1:y", "", "s", 1), (1, "", "x1:y", "s", 1)])
    assert a != b


# URLs


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    host = re.match(r"[^/?#]*", rest)[0]
    return lower(host), re.match(r"[^?#]*", rest[len(host) :])[0]


def rule_of(host, path):
    fits = []
    for rule in URL_RULES:
        own, _, below = rule.text.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + below):
            fits.append((len(rule.text), rule.text, rule.verdict))
    return max(fits)[1:] if fits else (None, None)


def wildcard(segment):
    if segment == "":
        return ""
    ending = re.search(rf"\.({'|'.join(url_templates.ENDINGS.split())})$", segment)
    kind = "<number>" if re.search(r"^[0-9]+(\.[a-z]+)?$", segment) else "<hex>" if re.search(r"^[0-9a-f-]{8,}$", segment) else "<any>"
    return kind + (ending[0] if ending else "")


def templates(urls):
    """Template and purity of each (host, path, label)."""
    state = [(h, "", p[1:].split("/", 8) if p.startswith("/") else [], label) for h, p, label in urls]
    for level in range(max((len(s[2]) for s in state), default=0)):
        below, totals = collections.Counter(), collections.Counter()
        for h, prefix, segments, _ in state:
            if level < len(segments):
                below[h, prefix, segments[level]] += 1
                totals[h, prefix] += 1

        def child(h, prefix, segments):
            if level >= len(segments):
                return None
            if level == 8:
                return "<rest>"
            s, n = segments[level], below[h, prefix, segments[level]]
            literal = s and len(s) <= 64 and n >= 5 and n >= 0.02 * totals[h, prefix]
            coded = s.replace("|", "%7C").replace("{", "%7B").replace("}", "%7D").replace("<", "%3C")
            return coded if literal else wildcard(s)

        children = [child(*s[:3]) for s in state]
        counts = collections.defaultdict(lambda: [0, 0])
        for (h, prefix, _, label), c in zip(state, children):
            if c is not None:
                counts[h, prefix, c][0] += label is not None
                counts[h, prefix, c][1] += label == "block"
        names = {}
        busy = sorted((k[:2], b / n, k[2], n, b) for k, (n, b) in counts.items() if n >= 5)
        for key, branches in groupby(busy, key=lambda x: x[0]):
            groups = []
            for _, _, name, n, b in branches:
                if groups:
                    _, n0, b0 = last = groups[-1]
                    p = (b + b0) / (n + n0)
                    if (b / n - b0 / n0) ** 2 <= 1.96**2 * p * (1 - p) * (1 / n + 1 / n0):
                        groups[-1] = (last[0] + [name], n + n0, b + b0)
                        continue
                groups.append(([name], n, b))
            for found, _, _ in groups:
                if len(found) > 1:
                    names.update({(*key, c): "{" + "|".join(sorted(found)) + "}" for c in found})
        state = [
            (h, prefix if c is None else f"{prefix}/{names.get((h, prefix, c), c)}", segments, label)
            for (h, prefix, segments, label), c in zip(state, children)
        ]
    counts = collections.defaultdict(lambda: [0, 0])
    for h, template, _, label in state:
        counts[h, template][0] += label is not None
        counts[h, template][1] += label == "block"
    return [(t, (counts[h, t][1] + 1) / (counts[h, t][0] + 2)) for h, t, _, _ in state]


def judged(urls, labels=None):
    parts = [split_url(u) for u in urls]
    rules = [rule_of(*p) for p in parts]
    known = [given or verdict for given, (_, verdict) in zip(labels or [None] * len(urls), rules)]
    found = templates([(*p, label) for p, label in zip(parts, known)])
    return [
        (*p, text, verdict or ("block" if purity >= 0.9 else "allow"), template, round(purity, 9))
        for p, (text, verdict), (template, purity) in zip(parts, rules, found)
    ]


def own_verdicts(df):
    return [(r["host"], r["path"], r["rule"], r["verdict"], r["template"], round(r["purity"], 9)) for r in df.collect()]


def test_verdicts_of_the_given_table(spark):
    got = QUERIES["op12_url_filter"](spark, SF).orderBy("page_id")
    table = pq.read_table(f"{SF}/pages.parquet", columns=["page_id", "url"]).to_pylist()
    urls = [r["url"] for r in sorted(table, key=lambda r: r["page_id"])]
    assert own_verdicts(got) == judged(urls)


def odd_urls(n=1500, seed=5):
    rnd = random.Random(seed)
    hosts = ["a.example.com", "WWW.Example.com", "shop.net", "org", "com", "notcom", "x.com.evil", "hot.org", "hot.org", "hot.org"]
    firsts = ["en", "es", "fr", "de", "tag", "2024", "a|b", "{x}", "deadbeef01", "item-%d", "%d", "", "EN"]
    urls = []
    for i in range(n):
        path = "".join("/" + rnd.choice(firsts).replace("%d", str(i)) for _ in range(rnd.randrange(5)))
        urls.append(f"http://{rnd.choice(hosts)}{path}{rnd.choice(['', '', '/', '.html', '?q=/en/', '#/x?y'])}")
    urls += [f"http://hot.org/tag/{i}" for i in range(40)]
    return urls + [None, None, "", "no scheme/en/", "://", "://?x", "a://B.com", "http://h.org/" + "/".join(map(str, range(30))),
                   "http://h.org/" + "x" * 100_000, "http://shop.net/es", "http://user@example.com:80/en/", "ab://c.net/es/://d.com/"]


def test_odd_urls_with_labels(rows):
    urls = odd_urls()
    marked = [u is not None and "hot" in u and zlib.crc32(u.encode()) % 4 > 0 for u in urls]
    labels = [("block" if "/tag" in u else "allow") if m else None for u, m in zip(urls, marked)]
    schema = "page long, url string, mark string, host int, Rule int"
    df = rows([(i, u, m, 1, 2) for i, (u, m) in enumerate(zip(urls, labels))], schema)
    got = url_templates.judge_urls(df, URL_RULES, label=F.col("mark"))
    assert got.columns == ["page", "url", "mark", "host", "path", "rule", "verdict", "template", "purity"]
    want = judged(urls, labels)
    assert own_verdicts(got.orderBy("page")) == want
    assert any(w[2] is None and w[3] == "block" and m is None for w, m in zip(want, labels))


def test_no_urls_and_wrong_rules(rows):
    assert url_templates.judge_urls(rows([], "page long, url string"), URL_RULES).collect() == []
    for verdict, text in (("maybe", "com/"), ("allow", "com")):
        with pytest.raises(ValueError):
            url_templates.Rule(verdict, text)
    with pytest.raises(ValueError):
        url_templates.judge_urls(rows([(1, "a")], "page long, url string"), [URL_RULES[0]] * 501)


# Runs


def brute_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(6, 4 * q):
                found.setdefault((start, i + q - start), q)
            i += 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


@settings(deadline=None, max_examples=300)
@given(st.lists(st.lists(st.integers(0, 2), max_size=40), max_size=4))
def test_runs_equal_brute_force(texts):
    assert periodic.periodic_runs([np.array(t, dtype=np.int64) for t in texts]) == [brute_runs(t) for t in texts]


def test_runs_of_periodic_texts():
    rnd = random.Random(2)
    texts = []
    for _ in range(300):
        words = [rnd.randrange(rnd.choice([2, 5, 50])) for _ in range(rnd.randrange(1, 120))]
        first, n = rnd.randrange(len(words)), len(words)
        period = 1 + (n - first) // rnd.randrange(3, 11)
        texts.append([words[i] if i < first else words[first + (i - first) % period] for i in range(n)])
    assert periodic.periodic_runs([np.array(t) for t in texts]) == [brute_runs(t) for t in texts]


def test_a_long_run_costs_no_square():
    (runs,) = periodic.periodic_runs([np.arange(400_000) % 3])
    assert runs == [(0, 400_000, 3)]


def query_rows(docs):
    out = []
    for doc, text in docs:
        words = re.findall("[^\x20\x09-\x0d]+", text or "")
        h, n = zlib.crc32(str(doc).encode()) if doc is not None else 1, len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(words)
        best = max(runs, key=lambda r: (r[1] * 10**12 // r[2], -r[0], -r[2]), default=(None, None, None))
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        out.append((
            doc, len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            sha(*(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
        ))
    return out


def test_query_of_runs(spark):
    docs = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    got = QUERIES["op13_periodic_runs"](spark, SF).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == query_rows([(r["doc_id"], r["text"]) for r in sorted(docs, key=lambda r: r["doc_id"])])
    assert any(r["n_runs"] for r in got)


def test_query_of_odd_texts(spark, folder):
    texts = [None, "", " \t\n", "a", "a " * 9, "b\xa0" * 9, "x y " * 30_000, "ha ha ha ha ha ha. ho ho ho ho ho ho ho"] * 12
    docs = [(i, t) for i, t in enumerate(texts)] + [(None, "na " * 7), (3, "a"), (3, "a")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    got = collections.Counter(tuple(r) for r in QUERIES["op13_periodic_runs"](spark, folder).collect())
    short = [(d, t) for d, t in docs if t is None or len(t) < 1000]
    want = collections.Counter(query_rows(short))
    assert {k: v for k, v in got.items() if k in want} == want
    assert sum(got.values()) == len(docs)


def test_runs_keep_other_columns(rows):
    df = rows([(1, "a a a a a a", 5, "x")], "id long, body string, n_runs int, best string")
    (r,) = periodic.find_runs(df, "body").collect()
    assert r.asDict(recursive=True) == {
        "id": 1, "body": "a a a a a a", "best": "x", "n_runs": 1, "collapsed": "a",
        "periodic_runs": [{"start": 0, "length": 6, "period": 1}],
    }
    assert periodic.find_runs(df.limit(0), "body").collect() == []
