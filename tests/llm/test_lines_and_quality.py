"""Line dedup, quality rules and mixing against plain Python, with the odd cases."""

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cardmill.llm import line_dedup, mixing, quality
from cardmill.llm.common import SPACES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG, OTHER = "this line is long enough", "another line of some length"


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_lines_stay_in_the_smallest_document(docs):
    got = by_id(
        line_dedup.dedup_lines(docs(f"a\n{LONG}\n{LONG}", f" {LONG.upper()}\t\nb\n", f"{LONG}", "short\nshort", "short")),
        "text", "n_lines", "n_dropped",
    )
    assert got == {
        0: (f"a\n{LONG}\n{LONG}", 3, 0),
        1: ("b\n", 3, 1),
        2: ("", 1, 1),
        3: ("short\nshort", 2, 0),
        4: ("short", 1, 0),
    }


def test_lines_of_odd_rows(rows, docs):
    data = [(1, LONG, 7), (1, LONG, 8), (None, LONG, 9), (2, None, 1), (3, "", 2), (1, f"{LONG}\n{OTHER}", 3), (4, OTHER, 4)]
    got = line_dedup.dedup_lines(rows(data, "doc_id long, text string, n_lines int"))
    assert got.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    found = collections.Counter((r.doc_id, r.text, r.n_dropped) for r in got.collect())
    assert found == collections.Counter(
        [(1, LONG, 0), (1, LONG, 0), (None, LONG, 0), (2, "", 0), (3, "", 0), (1, f"{LONG}\n{OTHER}", 0), (4, "", 1)]
    )
    assert line_dedup.dedup_lines(docs("x").limit(0)).count() == 0


def test_line_threshold_counts_documents(docs):
    frame = docs(LONG, LONG, f"{OTHER}", OTHER, OTHER)
    got = by_id(line_dedup.dedup_lines(frame, max_docs=2), "n_dropped")
    assert [got[i][0] for i in range(5)] == [0, 0, 0, 1, 1]


def metrics(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
    )


def random_text(seed):
    rnd = random.Random(seed)
    return "".join(rnd.choice(["a", "bé", "c", "##", "|", "x y", " "]) + rnd.choice([" ", "\n", "\t ", "\n\n"]) for _ in range(rnd.randrange(90)))


TEXTS = [None, "", " \n\t", "a a a", "a a a a", "one two", "a b c a b c", *map(random_text, range(40))]


def test_quality_counts(docs):
    got = by_id(quality.quality_report(docs(*TEXTS)), *quality.METRICS, "base_failed", "kept")
    for i, text in enumerate(TEXTS):
        n, chars, symbols, lines, repeats = expected = metrics(text)
        failed = n < 50 or 100 * repeats > 50 * n
        bad = failed or 2 * symbols > n or chars < 2 * n or chars > 15 * n or 10 * lines > 3 * n
        assert got[i] == (*expected, failed, not bad), text


def test_very_long_texts_are_counted_by_windows(docs, monkeypatch):
    texts = TEXTS[3:]
    monkeypatch.setattr(quality, "PLACE_BITS", 2)  # every text of four words or more is a long one
    got = by_id(quality.with_metrics(docs(*texts)), "n_repeat_words")
    assert [got[i][0] for i in range(len(texts))] == [metrics(t)[4] for t in texts]


def test_the_filter_and_the_report_agree(docs):
    frame = docs(*TEXTS, *(" ".join(f"word{i * k}" for i in range(60)) for k in range(1, 4)))
    kept = {r.doc_id for r in quality.quality_report(frame).where("kept").collect()}
    out = quality.quality_filter(frame)
    assert kept and out.columns == frame.columns
    assert {r.doc_id for r in out.collect()} == kept
    assert quality.quality_filter(frame.limit(0)).count() == 0


def test_rules_are_ordered_by_rejection_per_cost(docs):
    frame = docs(*(["x"] * 20))
    never, always = quality.Rule("never", F.lit(False)), quality.Rule("always", F.lit(True))
    assert [r.name for r in quality.order_rules(frame, [never, always])] == ["always", "never"]


def water_level(sizes, weights, share=1.5, most=2.0):
    """Targets by the iteration that the sums replace."""
    total = sum(sizes.values()) * share
    target, capped = dict.fromkeys(sizes, 0.0), set()
    for _ in range(len(sizes) + 1):
        free = [s for s in sizes if s not in capped]
        rest = total - sum(target[s] for s in capped)
        weight = sum(weights[s] for s in free)
        over = set()
        for s in free:
            target[s] = rest * weights[s] / weight
            if target[s] > most * sizes[s]:
                over.add(s)
        if not over:
            break
        for s in over:
            target[s] = most * sizes[s]
        capped |= over
    return target


def test_mix(docs):
    rnd = random.Random(3)
    texts = ["w " * rnd.randrange(1, 400) for _ in range(900)]
    sources = [rnd.choice(["a"] * 6 + ["b", "c", "é", None]) for _ in texts]
    frame = docs(*texts, sources=sources)
    got = mixing.mix(frame).collect()
    assert len(got) == 900 and {r.doc_id for r in got} == set(range(900))
    sizes, taken = collections.Counter(), collections.Counter()
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert r.taken in (0, r.size, 2 * r.size)
    order = sorted((s for s in sizes if s is not None)) + [None]
    expected = water_level(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(expected[r.source])
    for s in sizes:
        assert abs(taken[s] - expected[s]) <= 200
    again = {r.doc_id: r.taken for r in mixing.mix(frame.repartition(7)).collect()}
    assert again == {r.doc_id: r.taken for r in got}
    copies = collections.Counter(r.doc_id for r in mixing.take_mix(mixing.mix(frame)).collect())
    assert copies == collections.Counter({r.doc_id: r.taken // r.size for r in got if r.taken})


def test_mixed_rows_make_no_words(docs):
    texts = ["w " * (i % 7) for i in range(300)] + [None, "", SPACES, " \U0001f600\x1f\u00a0 b\x0bc "]
    frame = docs(*texts, sources=["a", None] * 152)
    assert mixing.mix(frame).where("doc_id = 303").first().size == 3
    taken = mixing.mixed_rows(frame)
    key = lambda r: (r.doc_id, r.text, r.source)
    expected = collections.Counter(map(key, mixing.take_mix(mixing.mix(frame)).collect()))
    assert taken.columns == frame.columns and expected and collections.Counter(map(key, taken.collect())) == expected
    for plan in (mixing.mix(frame), corpus_pipeline.mix_stage(frame.sparkSession, frame, "")):
        assert "regexp_extract_all" not in plan._jdf.queryExecution().executedPlan().toString()


def test_mix_of_odd_rows(docs, rows):
    assert mixing.mix(docs("a").limit(0)).count() == 0
    got = mixing.mix(rows([(None, None, None, 1), (None, "", "a", 2), (5, SPACES, "a", 3)], "doc_id long, text string, source string, size int"))
    assert {(r.size, r.source_size, r.target, r.taken) for r in got.collect()} == {(0, 0, 0.0, 0)}
    one = mixing.mix(docs("a b c", "a b c", ids=[1, 1])).collect()
    assert [r.taken for r in one] in ([3, 3], [6, 6])
