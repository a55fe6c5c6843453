"""Shingles, Jaccard join, line dedup and decontamination against plain versions."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import brute
from tickloom.llm import bloom, decontaminate, jaccard_join, line_dedup, shingles
from tickloom.llm.components import connected_components
from tickloom.session import scratch_path

ODD = [None, "", "  \n\t ", "one", "One two", "one\x0btwo THREE four", "é à ü ß é à ü", "a" * 5000, "x y z " * 400]
DOCUMENT = "id long, words string, text_length int"


def near_copies(count, seed=1):
    """A group of near copies of one text, each with some of its words changed."""
    draw = random.Random(seed)
    base = [f"w{draw.randrange(400)}" for _ in range(120)]
    out = []
    for _ in range(count):
        own = list(base)
        for _ in range(draw.randrange(4)):
            own[draw.randrange(len(own))] = f"n{draw.randrange(10**6)}"
        out.append(" ".join(own))
    return out


def test_shingle_hashes_stand_for_shingles():
    texts = ODD + near_copies(5)
    for size in (1, 3, 5):
        found = list(shingles.shingle_sets(pa.array(texts), size))
        plain = [brute.shingle_set(t, size) for t in texts]
        assert [len(x) for x in found] == [len(x) for x in plain]
        for i in range(len(texts)):
            for j in range(len(texts)):
                assert len(set(found[i].tolist()) & set(found[j].tolist())) == len(plain[i] & plain[j])


@pytest.mark.parametrize(("size", "threshold"), [(3, 90), (5, 80)])
def test_components_are_those_of_all_pairs(spark, size, threshold):
    texts = ODD + near_copies(90) + near_copies(4, seed=2) + ["one two three four"] * 3
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)] + [(3, "one two three four"), (None, near_copies(1)[0])]
    frame = spark.createDataFrame([(i, t, 0) for i, t in rows], DOCUMENT)
    join = jaccard_join.JaccardJoin(frame, "id", "words", size, threshold)
    sets = {r.number for r in join.members().collect() if r.number is not None}
    names = {}
    for row, (_, text) in zip(rows, rows):
        names.setdefault(brute.shingle_set(text, size), row)
    plain = [s for s in names if s]
    assert len(sets) == len(plain)
    linked = sum(
        100 * len(a & b) >= threshold * len(a | b) for n, a in enumerate(plain) for b in plain[:n]
    )
    assert join.links().count() == linked
    got = sorted(map(tuple, join.components().collect()), key=repr)
    assert got == sorted(brute.components(rows, size, threshold), key=repr)


def test_filter_of_the_sets_to_verify_takes_one_python_step(spark, monkeypatch):
    """Two Python steps in a stage take two workers a task, and the executor keeps them all."""
    plans, build = [], bloom.build

    def seen(gathered, bits):
        plans.append(gathered._jdf.queryExecution().executedPlan().toString())
        return build(gathered, bits)

    monkeypatch.setattr(bloom, "build", seen)
    texts = near_copies(12) + [None, "", "one two"]
    frame = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], DOCUMENT)
    got = sorted(map(tuple, jaccard_join.JaccardJoin(frame, "id", "words").components().collect()))
    assert got == sorted(brute.components(list(enumerate(texts)), 5, 80))
    assert plans and [p.count("MapInArrow") for p in plans] == [1] * len(plans)


def test_frequencies_reach_the_driver_as_columns(spark, monkeypatch):
    """As rows, half a million of them took a few hundred MB of the driver."""
    shared, own = np.arange(1, 60001, dtype=np.uint64), np.uint64(10**6)
    firsts = [np.append(shared, own + np.uint64(1)), shared[:40000], shared[:5], np.zeros(0, np.uint64)]
    frame = spark.createDataFrame([(bytearray(x.tobytes()),) for x in firsts], "first binary")
    folder = scratch_path(spark, "frequencies")
    jaccard_join._frequencies(frame.limit(2), 80, folder)  # what is imported or made once
    tracemalloc.start()
    tokens, counts = jaccard_join._frequencies(frame, 80, folder)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert tokens.dtype == np.uint64 and tokens.tolist() == list(range(1, 40001))
    assert counts.dtype == np.int64 and counts.tolist() == [3] * 5 + [2] * 39995
    assert peak < 64 * len(tokens)
    monkeypatch.setattr(jaccard_join, "FREQUENT_SHINGLES", 39999)
    tokens, counts = jaccard_join._frequencies(frame, 80, folder)
    assert tokens.tolist() == [1, 2, 3, 4, 5] and counts.tolist() == [3] * 5


def test_join_of_an_empty_table(spark):
    frame = spark.createDataFrame([], DOCUMENT)
    assert jaccard_join.JaccardJoin(frame, "id", "words").components().count() == 0


def test_components_of_long_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99), (100, 100)], "a long, b long")
    found = dict(connected_components(edges).collect())
    assert found == {i: 0 for i in range(41)} | {99: 99, 100: 99}


LINES = [
    "Menu\nfirst text\n menu \n",
    "MENU\nsecond text",
    "third text\r\nmenu\t",
    "\n\n",
    "",
    None,
    "only here",
    "Menu\nfirst text\n menu \n",
    "ünïcode\nMenu",
    "x" * 40000 + "\nmenu",
]


@pytest.mark.parametrize("least", [2, 3, 6, 10])
def test_common_lines_go_everywhere(spark, least):
    rows = [(i, t, "kept", i) for i, t in enumerate(LINES)] + [(None, "menu\nx", None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_lines string, other int")
    got = line_dedup.drop_common_lines(frame, min_documents=least, bits=17)
    assert got.columns == ["doc_id", "text", "other", "n_lines", "n_dropped"]
    found = {r.doc_id: r for r in got.collect()}
    texts = [r[1] for r in rows]
    for row, want in zip(rows, brute.without_common_lines(texts, least)):
        assert found[row[0]].text == want
        lines = (row[1] or "").split("\n")
        assert found[row[0]].n_lines == len(lines)
        kept = len(want.split("\n")) if want or "" in lines else 0
        assert found[row[0]].n_dropped >= len(lines) - max(kept, 1)


def test_first_occurrence_of_a_common_line_stays(spark):
    rows = [(5, "a\nmenu\nb"), (2, "c\nMenu\nmenu"), (9, "menu")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = dict((r.doc_id, r.text) for r in line_dedup.drop_common_lines(frame, min_documents=2, keep_first=True, bits=17).collect())
    assert got == {5: "a\nb", 2: "c\nMenu", 9: ""}


def test_line_dedup_of_an_empty_table(spark):
    assert line_dedup.drop_common_lines(spark.createDataFrame([], "doc_id long, text string"), bits=17).count() == 0


@pytest.mark.parametrize("block", [1 << 20, 60])
def test_contained_items(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "ITEM_BLOCK_SHINGLES", block)
    draw = random.Random(4)
    items = [(i, " ".join(f"q{draw.randrange(5000)}" for _ in range(n))) for i, n in enumerate([1, 4, 5, 6, 12, 30, 60])]
    items += [(50, None), (51, " "), (6, items[6][1]), (None, items[4][1])]
    long = " ".join(f"d{draw.randrange(9000)}" for _ in range(3000))
    changed = items[6][1].split()
    changed[10], changed[40] = "other", "words"
    texts = [long + " " + t.upper() + " " + long for _, t in items[:7]] + [items[0][1], items[1][1], " ".join(changed), long, None, ""]
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, items string")
    given = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r["items"] for r in decontaminate.contained_items(frame, given).collect()}
    for i, text, _ in rows:
        want = brute.contained(text, [(-1 if n is None else n, t) for n, t in items], 5, 80)
        assert sorted(-1 if x.item_id is None else x.item_id for x in got[i]) == want
    clean = decontaminate.clean_documents(frame, given)
    assert clean.columns == frame.columns
    assert {r.doc_id for r in clean.collect()} == {i for i in got if not got[i]}
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.clean_documents(frame, none).count() == len(rows)
    assert decontaminate.contained_items(frame.limit(0), given).count() == 0
