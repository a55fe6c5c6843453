"""Neighbours, classifier, pages, pieces, token files, chats and licenses on small inputs."""

import os
import subprocess
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickloom.llm import (
    cross_polytope,
    html_text,
    license_scan,
    preference_chat,
    quality_classifier,
    sentencepiece_nbest,
    token_files,
)
from tickloom.llm.queries import TOKENIZERS

PIECES = os.path.join(TOKENIZERS, "piece_bpe_32k.model")
WORDS = os.path.join(TOKENIZERS, "word_bpe_49k.json")
TEXTS = ["Hello, world!", "", None, "don't  STOP\n7 times <|endoftext|>x", "漢字かな 한국", "x " * 3000, "a▁b  c", "Ünï. cödé?! ½ á"]


@pytest.mark.parametrize("lengths", [False, True])
def test_neighbours_and_recall(spark, sf_dir, lengths):
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    vectors = {r.vec_id: np.array(r.embedding, float) for r in given}
    if lengths:
        vectors = {i: v * (1 + i % 3) for i, v in vectors.items()}
    rows = [(i, v.tolist(), "x") for i, v in vectors.items()]
    copies = {10000 + i: vectors[3] for i in range(40)}
    rows += [(i, v.tolist(), "y") for i, v in copies.items()] + rows[:2]
    rows += [(20000, None, ""), (20020, [0.0] * 64, ""), (20040, [float("nan")] * 64, ""), (20060, [1.0], ""), (None, [1.0] * 64, "")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string")
    got = cross_polytope.nearest(frame, F.col("id") % 20 == 0, probes=64 if lengths else 20).collect()
    vectors |= copies
    ids = np.array(sorted(vectors))
    matrix = np.array([vectors[i] for i in ids.tolist()])
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(found) == {i for i in vectors if i % 20 == 0}
    hits = []
    for query, answer in found.items():
        answer.sort()
        assert [a[0] for a in answer] == list(range(1, len(answer) + 1))
        assert query not in [a[1] for a in answer]
        assert all(abs(s - float(vectors[query] @ vectors[i])) < 1e-12 for _, i, s in answer)
        assert [(-s, i) for _, i, s in answer] == sorted((-s, i) for _, i, s in answer)
        scores = np.round(matrix @ vectors[query], 12)
        scores[ids == query] = -np.inf
        want = set(ids[np.lexsort((ids, -scores))[:20]].tolist())
        hits.append(len(want & {a[1] for a in answer}) / 20)
    assert np.mean(hits) >= 0.9
    assert cross_polytope.nearest(frame.limit(0), F.col("id") % 20 == 0).count() == 0


@pytest.mark.parametrize("kind", ["spread", "outlier", "tiny", "far"])
def test_neighbours_of_unequal_lengths(spark, kind):
    draw = np.random.default_rng(3)
    matrix = draw.normal(size=(15 if kind == "tiny" else 2000, 64))
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    if kind == "spread":
        matrix *= np.exp(0.5 * draw.normal(size=(len(matrix), 1)))
    elif kind == "far":
        # Queries that point away from the others, which are all in few buckets.
        matrix[np.arange(len(matrix)) % 500 > 0] = np.eye(64)[0] + 1e-3 * draw.normal(size=(len(matrix) - 4, 64))
        matrix[::500] = -np.eye(64)[0] + 1e-3 * draw.normal(size=(4, 64))
    else:
        matrix[7] *= 100
    step = 500 if kind == "far" else 20
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(matrix)], "vec_id long, embedding array<double>")
    found = {}
    for r in cross_polytope.nearest(frame, F.col("id") % step == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    queries = range(0, len(matrix), step)
    assert {q: len(found.get(q, ())) for q in queries} == dict.fromkeys(queries, min(20, len(matrix) - 1))
    hits = []
    for q in queries:
        scores = matrix @ matrix[q]
        scores[q] = -np.inf
        hits.append(len(found[q] & set(np.argsort(-scores)[:20].tolist())) / min(20, len(matrix) - 1))
    assert np.mean(hits) >= 0.95


def test_quality_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    documents, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    scored = quality_classifier.score_documents(documents.withColumn("score", F.lit("old")), labels)
    rows = scored.join(labels, "doc_id").where(quality_classifier.held_out("doc_id")).select("score", "quality").collect()
    assert len(rows) > 50 and all(0 <= r.score <= 1 for r in rows)
    assert np.mean([(r.score >= 0.7) == (r.quality == 1) for r in rows]) >= 0.95


def test_quality_without_labels_or_texts(spark):
    documents = spark.createDataFrame([(1, None), (2, ""), (None, "some text"), (2, "")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality_classifier.score_documents(documents, none).collect()} == {1.0}
    some = spark.createDataFrame([(1, 0), (None, 1), (3, 1), (2, None)], "doc_id long, quality int")
    assert quality_classifier.score_documents(documents, some).count() == 4
    assert quality_classifier.score_documents(documents.limit(0), some).count() == 0


PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class=home><header><h1>Site</h1></header>"
    "<nav><ul><li><a href=/a>A</a></ul></nav><div class='cookie-notice'>We use cookies on all of these pages here.</div>"
    "<div id=content><h2>Big &amp; small</h2><p>First <b>para</b> is\n long &lt;enough&gt; to count, with <a href=x>a link</a>.<br>"
    "<p>Second&nbsp;para follows it closely.<ul><li>one<li>two</ul><script>var t='</p>';</script></div>"
    "<div class='comments'><p>I do not agree with it at all.</p></div><aside>Side</aside><form>Sign up</form>"
    "<footer>&copy; 2024</footer><!-- <p>gone</p> --></body></html>"
)


def test_main_text_of_pages(spark):
    want = "Big & small\nFirst para is long <enough> to count, with a link.\nSecond para follows it closely.\none\ntwo"
    pages = [(1, PAGE, "u"), (2, None, None), (3, "", ""), (4, "plain < text", ""), (5, "<p>open <b>tags<p>next", ""), (1, PAGE, "u")]
    pages += [(6, "<script>only();", ""), (7, "<div>" * 3000 + "deep", ""), (8, "<a title=it's>x</a> y <b title='a>b'>it's</b>", "")]
    frame = spark.createDataFrame(pages, "page_id long, html string, text string")
    got = html_text.extract_text(frame)
    assert got.columns == ["page_id", "html", "text", "n_chars"]
    found = {r.page_id: r for r in got.collect()}
    assert found[1].text == want and found[1].n_chars == len(want)
    assert [found[i].text for i in (2, 3, 4, 6, 7, 8)] == ["", "", "plain < text", "", "deep", "x y it's"]
    assert found[5].text == "open tags\nnext"


PARAGRAPHS = [f"Paragraph {i} tells a good deal about the matter at hand, and goes on for a while." for i in range(5)]
LONG = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
NAV = "<nav><ul><li><a href=/a>First</a><li><a href=/b>Second</a></ul></nav>"


@pytest.mark.parametrize(
    "wrapper",
    ["div class='content has-sidebar'", "div class='layout no-sidebar'", "div class='with-menu'", "div class='post comments-open'"]
    + ["div class='site social'", "div id=widget", "form", "section role=search"],
)
@pytest.mark.parametrize("inner", ["article", "div"])
def test_wrappers_with_names_keep_their_text(wrapper, inner):
    page = f"<body>{NAV}<{wrapper}><{inner}>{LONG}</{inner}><div class='share ad'>Buy now</div></{wrapper.split()[0]}><footer>Foot</footer>"
    assert html_text.main_text(page).split("\n") == PARAGRAPHS


def test_density_chooses_the_text():
    foot = f"{NAV}<footer>Foot</footer></body>"
    links = "<div>" + "".join(f"<a href=/{i}>Link {i}</a> " for i in range(20)) + "</div>"
    part = "<{0}><h2>Head {1}</h2><p>A part with number {1} says what there is to say about it.</p></{0}>"
    parts = [x for i in range(4) for x in (f"Head {i}", f"A part with number {i} says what there is to say about it.")]
    cases = [
        (f"<body><div><h1>Title</h1><p>intro</p><section>{LONG}</section></div>{foot}", ["Title", "intro", *PARAGRAPHS]),
        (f"<body>{''.join(part.format('article', i) for i in range(4))}{links}{foot}", parts),
        (f"<body><div>{''.join(part.format('article', i) for i in range(4))}</div>{links}{foot}", parts),
        (f"<body><div>{''.join(part.format('section', i) for i in range(4))}</div>{links}{foot}", parts),
        (f"<body><article>{LONG}</article><article><h2>Head</h2><p>Short one.</p></article>{foot}", [*PARAGRAPHS, "Head", "Short one."]),
        (f"<body>{LONG}{links}{foot}", PARAGRAPHS),
        (f"<body>{links}<div><p>An introduction that stands alone here.</p></div><div>{LONG}</div>{links}{foot}", ["An introduction that stands alone here.", *PARAGRAPHS]),
    ]
    for page, want in cases:
        assert html_text.main_text(page).split("\n") == want, page


def brute_segmentations(pieces, text):
    if not text:
        yield 0.0, []
        return
    for end in range(1, min(len(text), pieces.longest) + 1):
        found = pieces.score.get(text[:end])
        if found is None and end > 1:
            continue
        ids = [found[0]] if found else [pieces.byte_ids[b] for b in text[0].encode()]
        for score, rest in brute_segmentations(pieces, text[end:]):
            yield (found[1] if found else pieces.unknown) + score, ids + rest


def test_pieces_n_best_and_round_trip(spark):
    texts = TEXTS + ["the cat", "aaaaaa", "ab 1", " two  x", "☃!"]
    frame = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, ids int")
    got = {r.doc_id: r for r in sentencepiece_nbest.encode(frame, PIECES, n_best=4).collect()}
    pieces = sentencepiece_nbest.Pieces(PIECES)
    for i, text in enumerate(texts):
        assert got[i].decoded == (text or "")
        if text and len(text) < 9:
            options = sorted(brute_segmentations(pieces, " " + text), key=lambda x: -x[0])
            assert np.allclose([x.score for x in got[i].n_best], [s for s, _ in options[:4]])
            seen = set()
            for ranked in got[i].n_best:
                ids = list(got[i].ids)
                for change in reversed(ranked.changes):
                    ids[change["at"] : change["at"] + change["removed"]] = change["ids"]
                assert any(ids == own and abs(score - ranked.score) < 1e-6 for score, own in options)
                seen.add(tuple(ids))
            assert len(seen) == len(got[i].n_best)
    assert list(got[1].ids) == [] and len(got[1].n_best) == 1
    assert sentencepiece_nbest.encode(frame.limit(0), PIECES).count() == 0


HELD = """
import random, re, sys
import pyarrow as pa
from tickloom.llm import sentencepiece_nbest

def held():
    with open("/proc/self/smaps_rollup") as file:
        return int(re.search(r"Pss_Anon: *([0-9]+)", file.read())[1]) >> 10

class Frame:
    columns, sparkSession = ["text"], None
    schema = []
    def drop(self, *names):
        return self
    def mapInArrow(self, run, schema):
        return run

sentencepiece_nbest.bound_batches = lambda spark: None
run = sentencepiece_nbest.encode(Frame(), sys.argv[1])
draw = random.Random(3)
words = ["".join(draw.choices("etaoinshrdlu", k=draw.randint(2, 9))) for _ in range(20000)]
batches = [pa.RecordBatch.from_pydict({"text": [" ".join(draw.choices(words, k=400)) for _ in range(1000)]}) for _ in range(2)]
before, tables = held(), sentencepiece_nbest.Pieces(sys.argv[1])
print(sum(x.nbytes for x in vars(tables).values() if hasattr(x, "nbytes")) >> 20)
del tables
print(sum(x.num_rows for x in run(iter(batches))), held() - before)
"""


@pytest.mark.skipif(not os.path.exists("/proc/self/smaps_rollup"), reason="memory can't be read here")
def test_pieces_leave_little_memory_to_their_worker():
    found = subprocess.run([sys.executable, "-c", HELD, PIECES], capture_output=True, text=True, check=True, cwd=os.path.dirname(os.path.dirname(os.path.dirname(__file__))))
    tables, rows, held = map(int, found.stdout.split())
    assert rows == 2000
    assert tables < 16
    assert held < 60


def test_elias_fano_selects_every_value():
    draw = np.random.default_rng(1)
    for values in ([], [0], [5, 5, 5], [0, 1 << 40], np.sort(draw.integers(0, 10**6, 5000)), np.arange(700)):
        coded = token_files.EliasFano(token_files.EliasFano.encode(np.array(values, np.uint64)))
        assert coded.values().tolist() == list(values)
        assert [coded.select(i) for i in range(len(values))] == list(values)


def test_token_files_hold_what_the_library_encodes(spark):
    from tokenizers import Tokenizer

    names = [9, 4, 7, -3, 12, 5, 30, None]
    rows = list(zip(names, TEXTS)) + [(7, None), (4, "")]
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, start string")
    folder, shards = token_files.write_shards(frame, WORDS)
    got = [tuple(r) for r in token_files.read_documents(folder, shards).collect()]
    library = Tokenizer.from_file(WORDS)
    start, want = 0, []
    for name, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((name, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(got, key=repr) == sorted(want, key=repr)
    for r in spark.read.format("binaryFile").load(folder + "/*.eftok").collect():
        shard = token_files.Shard(bytes(r.content))
        assert sum(len(shard.document(i)) for i in range(shard.documents)) == shard.ids
    folder, shards = token_files.write_shards(frame.limit(0), WORDS)
    assert token_files.read_documents(folder, shards).count() == 0


def test_word_encoder_equals_the_library():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    encode = token_files.WordEncoder(WORDS, 2)
    for _ in range(2):
        ids, bounds = encode(pa.array(TEXTS))
        for text, a, b in zip(TEXTS, bounds[:-1], bounds[1:]):
            assert ids[a:b].tolist() == library.encode(text or "", add_special_tokens=False).ids


def test_letters_that_come_apart_join_the_marks_behind_them():
    import random
    import unicodedata

    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    encode = token_files.WordEncoder(WORDS, 2)
    letters = [c for c in map(chr, range(0x80, 0x3100)) if c.isalpha() and library.normalizer.normalize_str(c) != c]
    texts = [f"{c}. x{c}! {c}y,; {c}?a" for c in letters]
    rnd = random.Random(7)
    alphabet = [chr(c) for c in range(32, 0x3100) if unicodedata.category(chr(c)) not in ("Cs", "Cn")]
    texts += ["".join(rnd.choices(alphabet, k=12)) + rnd.choice(".,;:!?") for _ in range(3000)]
    ids, bounds = encode(pa.array(texts))
    for text, a, b in zip(texts, bounds[:-1], bounds[1:]):
        assert ids[a:b].tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_one_id_on_many_rows_spans_shards(spark):
    rows = [(1, f"text number {i}") for i in range(2000)] + [(0, "first"), (2, "last")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    folder, shards = token_files.write_shards(frame, WORDS)
    assert shards.count() > 1 and shards.agg({"documents": "max"}).first()[0] < 2000
    got = token_files.read_documents(folder, shards).orderBy("start").collect()
    assert [r.id for r in got] == [0] + [1] * 2000 + [2]
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))


def test_preference_pairs(spark):
    t = [(1, 0, "user", "hi"), (1, 1, "assistant", "a"), (1, 2, "user", "more"), (1, 3, "assistant", "b<|im_end|>")]
    t += [(2, 0, "user", "hi"), (2, 1, "assistant", "a"), (2, 2, "user", "less"), (3, 0, "User ", "hi"), (3, 0, "User ", "hi")]
    t += [(4, 0, None, None), (4, 1, "assistant", "c"), (None, 0, "user", "x"), (5, None, "user", "x"), (6, 0, "user", "one")]
    turns = spark.createDataFrame(t, "conv_id long, turn long, role string, text string")
    got = {(r.chosen_id, r.rejected_id): r for r in preference_chat.format_pairs(preference_chat.neighbour_pairs(turns, 1)).collect()}
    assert set(got) == {(1, 2), (2, 3), (4, 4), (6, 6)}
    first = got[1, 2]
    assert first.prompt_turns == 2
    assert first.prompt == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\na<|im_end|>\n"
    learned = [first.chosen_completion[m.start : m.start + m.length] for m in first.chosen_mask]
    assert learned == ["b<| im_end |><|im_end|>"] and first.rejected_mask == []
    assert got[2, 3].prompt_turns == 0 and got[2, 3].rejected_completion == "<|im_start|>user\nhi<|im_end|>\n"
    assert got[6, 6].rejected_completion is None and got[6, 6].chosen_completion is not None
    assert preference_chat.neighbour_pairs(turns.limit(0)).count() == 0


def test_licenses(spark):
    mit = license_scan.TEMPLATES["MIT"]
    filler = "some words that say nothing of note " * 300
    texts = [filler + mit.upper() + " " + filler, "x\nreleased under  the MIT license\ny", mit[: len(mit) // 2], None, "", "license", filler]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, texts[1], "x"), (1, texts[1], "y")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, license string")
    got = {(r.doc_id, r.license): (r.found, r.n) for r in license_scan.find_licenses(frame).collect()}
    whole = len(license_scan.template_shingles({"m": mit})["m"])
    assert got == {(0, "MIT"): (whole, whole), (1, "MIT-line"): (1, 1), (None, "MIT-line"): (1, 1)}
    assert license_scan.find_licenses(frame, templates={}).count() == 0
    assert license_scan.find_licenses(frame.limit(0)).count() == 0


def test_runs_of_a_hot_first_turn_are_even_with_a_far_id(spark):
    ids = [*range(999), 2**62]
    frame = spark.createDataFrame([(i, t, r, "same") for i in ids for t, r in ((0, "user"), (1, "assistant"))], "conv_id long, turn int, role string, text string")
    runs = frame.select("conv_id").distinct()
    sizes = [r["count"] for r in runs.groupBy(preference_chat._run(runs, 100).alias("run")).count().collect()]
    assert len(sizes) == 10 and max(sizes) <= 120
    pairs = preference_chat.neighbour_pairs(frame, part_rows=100).select("chosen_id", "rejected_id").collect()
    assert sorted(map(tuple, pairs)) == list(zip(ids, ids[1:]))


STORY = "".join(f"<p>Paragraph {i} of a long story, with words enough that its text is dense and clearly the core.</p>" for i in range(6))
TOLD = "\n".join(f"Paragraph {i} of a long story, with words enough that its text is dense and clearly the core." for i in range(6))


@pytest.mark.parametrize(
    "page",
    [
        # Reader comments under names that say which box they are in.
        f"<body><article>{STORY}</article><section class='comments-area'><p>I liked this story very much, well told.</p></section></body>",
        f"<body><article>{STORY}<div id='disqus_thread'><p>I liked this story very much, well told.</p></div></article></body>",
        f"<body><article>{STORY}<div class='pageComments'><p>Nice.</p></div><div class='commentsList'><p>Nice.</p></div></article></body>",
        # A teaser of another story, and page furniture without an article.
        f"<body><article>{STORY}</article><article class='teaser'><h3><a href='/x'>Another story</a></h3><p>It tells of other things.</p></article></body>",
        f"<body><div>{STORY}</div><div class=foot><p>All rights reserved by the owners of this page.</p></div></body>",
        f"<body><div>{STORY}</div><div class='site-footer'><p>All rights reserved by the owners of this page.</p></div></body>",
        # Wrappers whose names only speak of such parts keep their text.
        f"<body><div class='content has-sidebar'><div class='post comments-open'>{STORY}</div></div></body>",
    ],
)
def test_pages_with_comments_teasers_and_wrappers(page):
    assert html_text.main_text(page) == TOLD


def test_labels_in_a_paragraph_and_pages_without_rows(spark):
    page = f"<body><article>{STORY}<p>A word with a <label>label</label> in the middle of the text.</p></article></body>"
    assert html_text.main_text(page) == f"{TOLD}\nA word with a label in the middle of the text."
    none = spark.createDataFrame([], "page_id long, html string, text string")
    assert html_text.extract_text(none).columns == ["page_id", "html", "text", "n_chars"]
    assert html_text.extract_text(none).count() == 0


def test_articles_of_equal_rank_all_stay():
    """Articles whose headings are all links, or none, are parts of one page."""
    plain = "".join(f"<article><h2>Part {i}</h2>{STORY}</article>" for i in range(3))
    linked = plain.replace("<h2>", "<h2><a href='#'>").replace("</h2>", "</a></h2>")
    for page in (plain, linked):
        text = html_text.main_text(f"<body>{page}</body>")
        assert all(f"Part {i}" in text for i in range(3)) and text.count(TOLD) == 3
