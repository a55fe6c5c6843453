"""The cross-tokenizer alignment, the prefix trie and the disclosure of personal data against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from tests.llm import plain_three as plain
from tickloom.llm import cross_tokenizer, disclosure, prefix_trie, queries

TOKENIZERS = [f"/opt/tokenizers/{name}" for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
PIECES = [*" \t\n\r\x0b\x0c\x1c\x85\xa0\u3000\u2028ab.,'sZ9▁é\u0301İ😀𝒳", "<|endoftext|>", "</s>", "  ", "word", " the", "日本"]


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


def test_alignment_query_equals_the_libraries_on_whole_texts(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op11_cross_tokenizer_alignment"](spark, sf_dir).collect()
    assert ordered(got) == ordered(plain.alignment(rows, *TOKENIZERS))


def test_alignment_of_odd_texts(spark):
    rnd = random.Random(3)
    rows = [(i, "".join(rnd.choices(PIECES, k=rnd.randrange(14)))) for i in range(3000)]
    rows += [(None, None), (None, ""), (7, "twice"), (7, "twice"), (8, "x" * 3000 + " " + "日本語" * 500), (9, "one word " * 9000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"a": F.lit(1), "chunk": F.lit("x")})
    aligned = cross_tokenizer.Alignment(frame.repartition(5), *TOKENIZERS)
    assert ordered(aligned.scored_documents().collect()) == ordered(plain.alignment(rows, *TOKENIZERS))


def test_pair_counts_over_several_chunks(spark, monkeypatch):
    chunk = cross_tokenizer.Chunk()
    links = [[5, 5, 5, 9], [9], [5] * 6, []]
    for own in links:
        chunk.add(cross_tokenizer.np.array(own, "int64"))
    rows = [row for batch in chunk.postings(3) for row in batch.to_pylist()]
    total = {b: sum(r["bits_set"] << r["plane"] for r in rows if r["b"] == b) for b in (5, 9)}
    documents = {b: sum(r["documents"] for r in rows if r["b"] == b) for b in (5, 9)}
    assert total == {5: 9, 9: 2} and documents == {5: 2, 9: 2}
    dense = cross_tokenizer.np.arange(0, 60000, 3)
    for places in (dense, dense[:10]):
        assert cross_tokenizer.members(cross_tokenizer.container(places)).tolist() == places.tolist()
    assert len(cross_tokenizer.container(dense)) == cross_tokenizer.BITMAP_BYTES


@pytest.mark.parametrize("many", [4095, 4096, 4097])
def test_a_pair_linked_in_as_many_documents_as_half_a_bitmap_has_bytes(spark, many):
    rows = [(i, "word") for i in range(many)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = cross_tokenizer.Alignment(frame, *TOKENIZERS).scored_documents().collect()
    assert ordered(got) == ordered(plain.alignment(rows, *TOKENIZERS))
    places = cross_tokenizer.np.arange(many) * 3
    assert cross_tokenizer.members(cross_tokenizer.container(places)).tolist() == places.tolist()


def test_alignment_of_an_empty_table(spark):
    aligned = cross_tokenizer.Alignment(spark.createDataFrame([], "doc_id long, text string"), *TOKENIZERS)
    assert aligned.scored_documents().collect() == [] and aligned.pair_counts().collect() == []


def nodes(spark, rows, bits=26):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame = frame.withColumns({"depth": F.lit("x"), "place": F.lit(0), "part": F.lit(1)}).repartition(5)
    placed = prefix_trie.place_turns(frame)
    return ordered(prefix_trie.prefix_trie(*prefix_trie.rebuild(placed), most_bits=bits).collect())


@pytest.mark.parametrize("bits", [16, 26])
def test_trie_of_odd_conversations(spark, bits, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK_TURNS", 64)
    rnd = random.Random(5)
    rows = []
    for c in [*range(-25, 60), 10**12, None]:
        for _ in range(rnd.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c, rnd.choice([None, 0, 1, 2, 3]), rnd.choice([None, "user", "assistant"]), rnd.choice([None, "", "a b", "c", "d e f"])))
    rows += [(c, i, "user", "same text") for c in (77, 78) for i in range(9)] + [(97, 1, "u", "x")] * 3
    rows += [(1000 + k, i, "user", f"w {i % 7}") for k in (0, 1, 2) for i in range(300 + k)]
    assert nodes(spark, rows, bits) == ordered(plain.trie(rows))


def test_trie_where_the_sketch_proves_nothing(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "count_min", lambda rows, bits: [prefix_trie.np.full(1 << 13, 255, "uint8")] * 2)
    rows = [(c, i, "user", f"{c % 3 if i else 0} {i}") for c in range(30) for i in range(4)]
    assert nodes(spark, rows) == ordered(plain.trie(rows))


def test_trie_of_many_copies_joins_its_ends_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 7)
    rows = [(c, 1, "user", "copy of all") for c in range(0, 20000, 20)]
    assert nodes(spark, rows) == ordered(plain.trie(rows))


def test_trie_without_conversations(spark):
    assert nodes(spark, []) == [] and nodes(spark, [(None, 1, "a", "b")]) == []
    assert nodes(spark, [(5, None, None, None)]) == ordered(plain.trie([(5, None, None, None)]))


PARTS = ["1", "2", "9", "0", "55", "@", "a", "b", "-", ".", ".com", " ", "\n", "+", "(", ")", "_", "é", "4111 1111 1111 1111"]
PARTS += ["4111111111111111", "+1 (555) 123-4567", "10.0.0.255", "1.2.3.999", "john@x.org", "%", "\t", "𝒳"]


def test_patterns_equal_the_plain_ones(spark):
    rnd = random.Random(5)
    texts = ["".join(rnd.choices(PARTS, k=rnd.randrange(30))) for _ in range(3000)]
    texts += ["a" * 50000 + "@" + "b." * 3000 + "c", "1." * 20000, "1 " * 20000, "+" + "1 " * 20000, "", "9" * 30000, "a@b.c_d@e.f"]
    texts += ["0001.2.3.4 00000000256.1.1.1"]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(4)
    found = frame.select("i", disclosure.entities(F.col("text")).alias("e")).collect()
    assert {r.i: [(s.start, s.rank, s.end, s.kind) for s in r.e] for r in found} == {i: plain.personal_data(t) for i, t in enumerate(texts)}


@pytest.fixture(scope="module")
def revealing(spark, tmp_path_factory):
    """Documents with a name that stands with one address only, a copied passage, and a common word."""
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(300):
        text = rnd.choices(words, k=60)
        if i < 12:
            text[30:30] = ["Zeltina", "Morok,", "<zeltina@corp.example>", "engineer"]
            text.append("(Zeltina)")
        if i >= 280:
            text[20] = "engineer"
        if i in (14, 15, 16):
            text = ["copied", "passage", "here", "rareword", "call", "+1 (555) 123-4567", "now"]
        rows.append((i, " ".join(text)))
    rows += [(None, None), (3, ""), (5, rows[5][1]), (5, rows[5][1])]
    folder = str(tmp_path_factory.mktemp("pii"))
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{folder}/documents.parquet")
    return folder


def test_disclosing_terms_match_their_sql(spark, revealing):
    import duckdb

    from tools.compare import rows_of

    frame = queries.QUERIES["op13_personal_data_disclosure"](spark, revealing)
    found = frame.collect()
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{revealing}/documents.parquet/*.parquet'")
    cursor = connection.execute(queries.ORACLE["op13_personal_data_disclosure"])
    assert rows_of(frame.columns, found) == rows_of([d[0] for d in cursor.description], cursor.fetchall())
    spans = {r.doc_id: r.spans for r in found}
    assert spans[0].count("term:") == 3 and spans[0].count("email:") == 1
    assert "term:" not in spans[14] and spans[20] == "" and spans[None] == ""


def test_disclosure_keeps_columns_and_sanitises(spark, revealing):
    documents = spark.read.parquet(f"{revealing}/documents.parquet").withColumns({c: F.lit(c) for c in ("id", "key", "row", "pii")})
    found = disclosure.Disclosure(documents)
    assert {(r.term, r.action) for r in found.disclosing().collect()} == {("zeltina", "remove"), ("morok", "remove")}
    result = found.find()
    assert result.columns == ["doc_id", "text", "id", "key", "row", "pii"] and result.count() == 304
    clean = result.where("doc_id = 0").select(disclosure.sanitise(F.col("text"), F.col("pii"))).first()[0]
    assert "[email]" in clean and "eltina" not in clean and "engineer" in clean
    assert disclosure.Disclosure(documents.limit(0)).find().collect() == []
