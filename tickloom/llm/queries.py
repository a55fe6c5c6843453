"""One query for each operator over its whole table, with the SQL that must give the same rows.

The parameters are those of production; nothing is cut, sampled or left out.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.llm import (
    cross_polytope,
    cross_tokenizer,
    decontaminate,
    disclosure,
    html_text,
    license_scan,
    line_dedup,
    preference_chat,
    prefix_trie,
    quality_classifier,
    sentencepiece_nbest,
    token_files,
)
from tickloom.llm.jaccard_join import JaccardJoin

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

TOKENIZERS = "/opt/tokenizers"

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


def load() -> tuple[dict[str, Query], dict[str, str]]:
    return dict(QUERIES), dict(ORACLE)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shingle_table(source: str, name: str, ids: str, size: int) -> str:
    """SQL of the distinct shingles of every text of a table: (ids, s list)."""
    return f"""{name}_words AS (
        SELECT {ids}, list_filter(string_split_regex({LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM {source}),
    {name} AS (
        SELECT {ids}, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {size} THEN [array_to_string(w, ' ')]
            ELSE list_distinct(list_transform(range(1, len(w) - {size - 2}), lambda i: array_to_string(w[i:i + {size - 1}], ' ')))
            END AS s FROM {name}_words)"""


def component_sql(size: int, threshold: int, source: str = "documents") -> str:
    """SQL of (doc_id, n_shingles, component_id) for the Jaccard join."""
    return f"""WITH RECURSIVE {shingle_table(source, "sets", "doc_id", size)},
    flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
    links AS (
        SELECT a.doc_id AS x, b.doc_id AS y FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {threshold} * (a.n + b.n - count(*))),
    reach(doc_id, near) AS (
        SELECT doc_id, doc_id FROM sets
        UNION SELECT reach.doc_id, links.y FROM reach JOIN links ON reach.near = links.x)
    SELECT sets.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least AS component_id
    FROM sets JOIN (SELECT doc_id, min(near) AS least FROM reach GROUP BY doc_id) r ON r.doc_id = sets.doc_id"""


def tokenizer_path(spark: SparkSession, name: str) -> str:
    """A vocabulary file; its folder, the same on all executors, is the setting llm.tokenizers."""
    return os.path.join(spark.conf.get("llm.tokenizers", TOKENIZERS), name)


@query("op1_cross_polytope_neighbours")
def cross_polytope_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_polytope.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, count=20)


@query("op2_license_scan", license_scan.scan_sql())
def license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.find_licenses(table(spark, sf_dir, "documents"))


@query("op3_html_extraction")
def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@query("op4_ngram_jaccard_join", component_sql(3, 90))
def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    join = JaccardJoin(table(spark, sf_dir, "documents"), "doc_id", "text", size=3, threshold=90)
    return join.components().withColumnRenamed("id", "doc_id")


@query("op5_sentencepiece_nbest")
def sentencepiece_nbest_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = sentencepiece_nbest.encode(documents, tokenizer_path(spark, "piece_bpe_32k.model"), n_best=4)
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.xxhash64("ids").alias("ids_hash"),
        "score",
        F.transform("n_best", lambda x: x["score"]).alias("n_best_scores"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


def _rendered_sql(roles: str, texts: str) -> str:
    """SQL of rendered turns, of lists of roles and texts."""
    escaped = f"regexp_replace({texts}[i], '<\\|(im_start|im_end)\\|>', '<| \\1 |>', 'g')"
    return (
        f"array_to_string(list_transform(range(1, len({roles}) + 1), lambda i: "
        f"'<|im_start|>' || {roles}[i] || chr(10) || {escaped} || '<|im_end|>' || chr(10)), '')"
    )


def _learned_sql(roles: str, texts: str) -> str:
    """SQL of the spans of assistant turns as start+length, joined."""
    escaped = f"regexp_replace({texts}[j], '<\\|(im_start|im_end)\\|>', '<| \\1 |>', 'g')"
    before = (
        f"coalesce(list_sum(list_transform(range(1, i), lambda j: length({roles}[j]) + length({escaped}) + 24)), 0) "
        f"+ 13 + length({roles}[i])"
    )
    own = escaped.replace("[j]", "[i]")
    return (
        f"array_to_string(list_transform(list_filter(range(1, len({roles}) + 1), lambda i: {roles}[i] = 'assistant'), "
        f"lambda i: CAST({before} AS BIGINT) || '+' || (length({own}) + 10)), ' ')"
    )


PREFERENCE_SQL = f"""WITH t AS (
        SELECT DISTINCT conv_id, turn, coalesce(lower(trim(role)), 'user') AS role, coalesce(text, '') AS text
        FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
    c AS (SELECT conv_id, list(role ORDER BY turn, role, text) AS r, list(text ORDER BY turn, role, text) AS x FROM t GROUP BY conv_id),
    g AS (SELECT *, lead(conv_id) OVER (PARTITION BY r[1], x[1] ORDER BY conv_id) AS next_id,
                 count(*) OVER (PARTITION BY r[1], x[1]) AS members FROM c),
    p AS (
        SELECT a.conv_id AS a_id, b.conv_id AS b_id, a.r AS ar, a.x AS ax,
               CASE WHEN a.conv_id = b.conv_id THEN b.r[1:len(b.r) - 1] ELSE b.r END AS br,
               CASE WHEN a.conv_id = b.conv_id THEN b.x[1:len(b.x) - 1] ELSE b.x END AS bx
        FROM g a JOIN c b ON b.conv_id = CASE WHEN a.members = 1 THEN a.conv_id ELSE a.next_id END),
    q AS (
        SELECT CASE WHEN len(br) > len(ar) THEN b_id ELSE a_id END AS chosen_id,
               CASE WHEN len(br) > len(ar) THEN a_id ELSE b_id END AS rejected_id,
               CASE WHEN len(br) > len(ar) THEN br ELSE ar END AS cr, CASE WHEN len(br) > len(ar) THEN bx ELSE ax END AS cx,
               CASE WHEN len(br) > len(ar) THEN ar ELSE br END AS rr, CASE WHEN len(br) > len(ar) THEN ax ELSE bx END AS rx FROM p),
    k AS (
        SELECT *, coalesce(list_filter(range(1, least(len(cr), len(rr))), lambda i: cr[i] <> rr[i] OR cx[i] <> rx[i])[1] - 1,
                           greatest(least(len(cr), len(rr)) - 1, 0)) AS n FROM q),
    parts AS (
        SELECT *, cr[1:n] AS pr, cx[1:n] AS px, cr[n + 1:] AS cr2, cx[n + 1:] AS cx2, rr[n + 1:] AS rr2, rx[n + 1:] AS rx2 FROM k)
    SELECT chosen_id, rejected_id, CAST(n AS BIGINT) AS prompt_turns, sha256({_rendered_sql("pr", "px")}) AS prompt_sha256,
        CASE WHEN len(cr) > 0 THEN sha256({_rendered_sql("cr2", "cx2")}) END AS chosen_sha256,
        CASE WHEN len(cr) > 0 THEN {_learned_sql("cr2", "cx2")} END AS chosen_learned,
        CASE WHEN len(rr) > 0 THEN sha256({_rendered_sql("rr2", "rx2")}) END AS rejected_sha256,
        CASE WHEN len(rr) > 0 THEN {_learned_sql("rr2", "rx2")} END AS rejected_learned
    FROM parts"""


@query("op6_preference_chat", PREFERENCE_SQL)
def preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = preference_chat.format_pairs(preference_chat.neighbour_pairs(table(spark, sf_dir, "conversations")))

    def spans(side: str):
        shown = F.transform(f"{side}_mask", lambda s: F.concat_ws("+", s["start"], s["length"]))
        return F.array_join(shown, " ").alias(f"{side}_learned")

    return pairs.select(
        "chosen_id",
        "rejected_id",
        F.col("prompt_turns").cast("long").alias("prompt_turns"),
        F.sha2("prompt", 256).alias("prompt_sha256"),
        F.sha2("chosen_completion", 256).alias("chosen_sha256"),
        spans("chosen"),
        F.sha2("rejected_completion", 256).alias("rejected_sha256"),
        spans("rejected"),
    )


@query("op7_quality_classifier")
def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_classifier.score_documents(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    )
    return scored.select(
        "doc_id",
        quality_classifier.held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query("op8_token_files")
def token_file_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, shards = token_files.write_shards(
        table(spark, sf_dir, "documents"), tokenizer_path(spark, "word_bpe_49k.json"), end_id=2
    )
    return token_files.read_documents(folder, shards).withColumnRenamed("id", "doc_id")


def line_sql(select: str, source: str = "documents", min_documents: int = 10) -> str:
    """SQL over kept(doc_id, n_lines, n_dropped, kept) of the line dedup, and its source."""
    return f"""WITH lines AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place FROM {source}),
    keyed AS (
        SELECT doc_id, line, place, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
    common AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= {min_documents}),
    kept AS (
        SELECT doc_id, count(*) AS n_lines, count(common.key) AS n_dropped,
               coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (common.key IS NULL), '') AS kept
        FROM keyed LEFT JOIN common ON common.key = keyed.key GROUP BY doc_id)
    {select}"""


@query("op9_line_dedup", line_sql("SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM kept"))
def line_dedup_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_common_lines(table(spark, sf_dir, "documents"), min_documents=10, least_chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query(
    "op10_benchmark_decontamination",
    f"""WITH {shingle_table("documents", "sets", "doc_id", 5)}, {shingle_table("benchmark", "items", "item_id", 5)},
    hits AS (
        SELECT doc_id, item_id, count(*) AS common, n FROM (SELECT doc_id, unnest(s) AS g FROM sets)
        JOIN (SELECT item_id, len(s) AS n, unnest(s) AS g FROM items) USING (g) GROUP BY doc_id, item_id, n
        HAVING 100 * count(*) >= 80 * n)
    SELECT documents.doc_id, count(item_id) AS n_items, min(item_id) AS first_item_id,
           coalesce(string_agg(item_id || ':' || common || '/' || n, ' ' ORDER BY item_id), '') AS found
    FROM documents LEFT JOIN hits ON hits.doc_id = documents.doc_id GROUP BY documents.doc_id""",
)
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contained_items(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=5, threshold=80
    )
    shown = F.transform("items", lambda x: F.concat_ws("", x["item_id"], F.lit(":"), x["common"], F.lit("/"), x["item_shingles"]))
    return found.select(
        "doc_id",
        F.size("items").cast("long").alias("n_items"),
        F.get("items", F.lit(0))["item_id"].alias("first_item_id"),
        F.array_join(shown, " ").alias("found"),
    )


@query("op11_cross_tokenizer_alignment")
def cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [tokenizer_path(spark, name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return cross_tokenizer.Alignment(table(spark, sf_dir, "documents"), *paths).scored_documents()


TRIE_SQL = """WITH RECURSIVE o AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
        FROM conversations WHERE conv_id IS NOT NULL),
    bits(b) AS (SELECT range FROM range(8)),
    crc_table AS (
        SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
        FROM (SELECT range AS n FROM range(256))),
    lookup AS (SELECT list(v ORDER BY n) AS t FROM crc_table),
    ids AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % 20 AS root FROM o GROUP BY conv_id),
    h AS (
        SELECT conv_id, n, root, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
                   list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                   lambda c, x: xor(c // 256, t[CAST(xor(c % 256, x) AS BIGINT) + 1])), CAST(4294967295 AS BIGINT)) % 4 AS h
        FROM ids, lookup),
    turns AS (
        SELECT h.conv_id, 0 AS own, o.place, role, text FROM h JOIN o ON o.conv_id = h.root AND o.place <= h.h
        UNION ALL SELECT h.conv_id, 1, o.place, role, text FROM h JOIN o ON o.conv_id = h.conv_id AND o.place > h.h),
    numbered AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, place) AS depth, role, text FROM turns),
    convs AS (
        SELECT h.conv_id, count(depth) AS len,
               coalesce(list(sha256(to_json([role, text])) ORDER BY depth) FILTER (depth IS NOT NULL), []) AS s,
               coalesce(list(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) ORDER BY depth) FILTER (depth IS NOT NULL), []) AS w
        FROM h LEFT JOIN numbered USING (conv_id) GROUP BY h.conv_id),
    prefixes AS (
        SELECT conv_id, len, unnest(range(0, len + 1)) AS depth, s, w FROM convs),
    nodes AS (
        SELECT array_to_string(s[1:depth], '/') AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
               array_to_string(any_value(s[1:depth - 1]), '/') AS parent, CASE WHEN depth > 0 THEN any_value(w[depth]) ELSE 0 END AS words,
               sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (len = depth), '')) AS ends_sha256, max(len) AS longest
        FROM prefixes GROUP BY path, depth),
    under AS (
        SELECT DISTINCT array_to_string(p.s[1:p.depth], '/') AS path, p.depth, n.path AS low, n.depth AS low_depth, n.n_convs, n.words, n.longest
        FROM prefixes p JOIN convs c ON c.conv_id = p.conv_id JOIN nodes n ON n.depth >= p.depth AND n.depth <= c.len AND n.path = array_to_string(c.s[1:n.depth], '/')),
    sums AS (
        SELECT path, depth, count(*) FILTER (longest = low_depth) AS n_leaves, CAST(sum((n_convs - 1) * words) AS BIGINT) AS saved_tokens,
               count(*) FILTER (low_depth = depth + 1) AS n_children
        FROM under GROUP BY path, depth)
    SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n_children, n_leaves, saved_tokens, n.ends_sha256
    FROM nodes n JOIN sums s ON s.path = n.path AND s.depth = n.depth LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.path = n.parent"""


@query("op12_conversation_prefix_trie", TRIE_SQL)
def conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = prefix_trie.place_turns(table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(*prefix_trie.rebuild(placed))


def _pii_sql(reach: int = 100, min_contexts: int = 3, generalise_at: float = 0.9, least_chars: int = 3) -> str:
    """SQL of personal data and of the terms that disclose it, by the plain patterns."""
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    digits = "regexp_replace(value, '[^0-9]', '', 'g')"
    doubled = "list_transform(range(1, len(d) + 1), lambda i: CASE WHEN i % 2 = 1 THEN CAST(d[i] AS INT) WHEN CAST(d[i] AS INT) < 5 THEN 2 * CAST(d[i] AS INT) ELSE 2 * CAST(d[i] AS INT) - 9 END)"
    ends = r"^[!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]+$"
    low = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    each = " UNION ALL ".join(
        f"SELECT row, id, text, '{kind}' AS kind, {rank} AS rank, regexp_extract_all(text, '{p}') AS v, string_split_regex(text, '{p}') AS g FROM docs"
        for rank, (kind, p) in enumerate(patterns.items())
    )
    def terms(words: str) -> str:
        return f"list_filter(list_distinct(list_transform({words}, lambda w: regexp_replace({low.format('w')}, '{ends}', '', 'g'))), lambda w: length(w) >= {least_chars})"

    return f"""WITH docs AS (SELECT row_number() OVER () AS row, doc_id AS id, coalesce(text, '') AS text FROM documents),
    raw AS ({each}),
    found AS (
        SELECT row, id, text, kind, rank, unnest(v) AS value, unnest(range(1, len(v) + 1)) AS i, v, g FROM raw WHERE len(v) > 0),
    placed AS (
        SELECT row, id, text, kind, rank, value, length(array_to_string(g[1:i], '')) + length(array_to_string(v[1:i - 1], '')) AS start FROM found),
    tested AS (
        SELECT *, start + length(value) AS stop, list_reverse(string_split({digits}, '')) AS d FROM placed),
    base AS (
        SELECT row, id, text, kind, rank, start, stop,
               kind || ':' || CASE kind WHEN 'email' THEN {low.format("value")} WHEN 'ip' THEN value ELSE {digits} END AS entity
        FROM tested WHERE CASE kind WHEN 'email' THEN true
            WHEN 'ip' THEN len(list_filter(string_split(value, '.'), lambda x: length(ltrim(x, '0')) > 3 OR (length(ltrim(x, '0')) = 3 AND ltrim(x, '0') > '255'))) = 0
            WHEN 'card' THEN len(d) BETWEEN 14 AND 19 AND list_sum({doubled}) % 10 = 0
            ELSE len(d) BETWEEN 10 AND 15 END),
    cut AS (
        SELECT row, entity, string_split_regex(substring(text, CAST(greatest(start - {reach}, 0) AS BIGINT) + 1, CAST(least(start, {reach}) AS BIGINT)), '[\\x20\\x09-\\x0D]') AS l,
               CASE WHEN start > {reach} THEN 1 ELSE 0 END AS first,
               string_split_regex(substring(text, CAST(stop AS BIGINT) + 1, {reach}), '[\\x20\\x09-\\x0D]') AS r,
               CASE WHEN length(text) > stop + {reach} THEN 1 ELSE 0 END AS last FROM base),
    mentions AS (
        SELECT entity, row, list_sort(list_distinct(flatten(list({terms("list_concat(l[first + 1:len(l) - 1], r[2:len(r) - last])")})))) AS terms FROM cut GROUP BY entity, row),
    known AS (SELECT entity, count(*) AS n_entity FROM mentions GROUP BY entity HAVING count(*) >= {min_contexts}),
    pairs AS (
        SELECT entity, n_entity, term, count(*) AS n_both
        FROM (SELECT entity, n_entity, terms, unnest(terms) AS term FROM mentions JOIN known USING (entity))
        GROUP BY entity, n_entity, term HAVING count(DISTINCT terms) >= {min_contexts}),
    words AS (SELECT row, id, unnest({terms("string_split_regex(text, '[\\x20\\x09-\\x0D]')")}) AS term FROM docs),
    frequency AS (SELECT term, count(*) AS n_term FROM words WHERE term IN (SELECT term FROM pairs) GROUP BY term),
    disclosing AS (
        SELECT entity, term FROM pairs JOIN frequency USING (term), (SELECT count(*) AS n FROM docs)
        WHERE n_entity < n AND 1.0 + ln(n_both / n_term) / ln(CAST(n AS DOUBLE) / n_entity) >= {generalise_at}),
    wanted AS (SELECT DISTINCT row, term FROM base JOIN disclosing USING (entity)),
    pieces AS (
        SELECT row, regexp_extract_all(text, '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+') AS p FROM docs WHERE row IN (SELECT row FROM wanted)),
    each_piece AS (SELECT row, p, unnest(range(1, len(p) + 1)) AS i FROM pieces),
    located AS (
        SELECT row, regexp_replace(p[i], '^[\\x20\\x09-\\x0D]+', '') AS word, length(array_to_string(p[1:i], '')) AS through FROM each_piece),
    bare AS (
        SELECT row, regexp_replace({low.format("word")}, '{ends}', '', 'g') AS term,
               through - length(word) + length(regexp_extract(word, '^[!-/:-@\\[-`{{-~]*')) AS start FROM located),
    hits AS (
        SELECT row, 'term' AS kind, 4 AS rank, start, start + length(term) AS stop FROM bare JOIN wanted USING (row, term)
        WHERE NOT EXISTS (SELECT 1 FROM base WHERE base.row = bare.row AND base.start < bare.start + length(term) AND base.stop > bare.start)),
    spans AS (SELECT row, kind, rank, start, stop FROM base UNION ALL SELECT * FROM hits)
    SELECT docs.id AS doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
           count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
           sha256(coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (kind <> 'term'), '')) AS base_sha256,
           coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank), '') AS spans
    FROM docs LEFT JOIN spans ON spans.row = docs.row GROUP BY docs.row, docs.id"""


@query("op13_personal_data_disclosure", _pii_sql())
def personal_data_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = disclosure.Disclosure(table(spark, sf_dir, "documents").select("doc_id", "text")).find()
    base = F.filter("pii", lambda s: s["kind"] != disclosure.TERM)

    def count(kind: str):
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in disclosure.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(disclosure.shown(base), 256).alias("base_sha256"), disclosure.shown(F.col("pii")).alias("spans")
    )
