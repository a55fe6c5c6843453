"""Information-theoretic sanitisation of personal data, in DataFrame functions alone.

Patterns find e-mail addresses, IP addresses, card and phone numbers: the entities to protect. Corpus
co-occurrence then estimates how strongly the terms around an entity reveal it: the pointwise mutual
information of term and entity, as a share of the entity's own information, is 1 for a term that
occurs with the entity only and 0 for one that is independent of it. In texts that hold the entity, terms
that disclose all of it are removed and those above a threshold are generalised to their kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.session import store

# Order of the kinds at one start, the disclosing terms last.
KINDS = ("email", "ip", "card", "phone")
TERM = "term"

# A pattern starts where a run starts or the last match ended, and takes whole runs: the leftmost matches
# are those of the plain patterns, without going back in long runs of one character class.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){13,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold to be searched for a kind at all.
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}

SEPARATOR = r"[\x20\x09-\x0D]"
PIECE = r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++"
PUNCTUATION = r"[!-/:-@\[-`{-~]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SPAN = "array<struct<start:int,end:int,value:string>>"
TERM_SPANS = "array<struct<start:int,end:int,action:string>>"


def lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _passes_luhn(value: Column) -> Column:
    digits = F.reverse(_digits(value))

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(digit >= 5, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.ltrim(p, F.lit("0")))
        return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    if kind == "card":
        return _passes_luhn(value)
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def matches(text: Column, kind: str) -> Column:
    """Spans of a kind in a text, in code points, end exclusive, with their values; those that fail its test are dropped."""
    pattern = PATTERNS[kind]
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    state = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

    def add(done: Column, x: Column) -> Column:
        start = done["at"] + F.length(x["gap"])
        span = F.struct(start.alias("start"), (start + F.length(x["value"])).alias("end"), x["value"].alias("value"))
        return F.struct(span["end"].alias("at"), F.concat(done["spans"], F.array(span)).alias("spans"))

    steps = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, v: F.struct(g.alias("gap"), v.alias("value")))
    spans = F.filter(F.aggregate(steps, state, add)["spans"], lambda s: _valid(kind, s["value"]))
    hinted = text.contains(HINTS[kind]) if HINTS[kind] else text.rlike("[0-9].{12}")
    return F.when(hinted, spans).otherwise(F.array().cast(SPAN))


def entities(text: Column) -> Column:
    """All spans of personal data in order of start and kind: start, end, kind and normalised value."""

    def of(i: int) -> Column:
        kind = KINDS[i]
        clean = {"email": lower, "ip": lambda v: v}.get(kind, _digits)
        return F.transform(
            matches(text, kind),
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(i).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"),
                F.concat(F.lit(kind + ":"), clean(s["value"])).alias("entity"),
            ),
        )

    return F.array_sort(F.concat(*[of(i) for i in range(len(KINDS))]))


def _terms(pieces: Column, least_chars: int) -> Column:
    """Distinct terms of words: A-Z as a-z, without ASCII punctuation at both ends."""
    bare = F.transform(pieces, lambda w: F.regexp_replace(lower(w), f"^{PUNCTUATION}++|{PUNCTUATION}++$", ""))
    return F.array_distinct(F.filter(bare, lambda w: F.length(w) >= least_chars))


def _context(text: Column, span: Column, reach: int) -> Column:
    """Whole words within ``reach`` characters on both sides of a span."""
    start = F.greatest(span["start"] - reach, F.lit(0))
    left = F.split(F.substring(text, start + 1, span["start"] - start), SEPARATOR)
    right = F.split(F.substring(text, span["end"] + 1, F.lit(reach)), SEPARATOR)
    # A word cut off by the border or grown together with the entity is none.
    first = F.when(start > 0, 1).otherwise(0)
    left = F.slice(left, first + 1, F.greatest(F.size(left) - 1 - first, F.lit(0)))
    last = F.when(F.length(text) > span["end"] + reach, 1).otherwise(0)
    right = F.slice(right, F.lit(2), F.greatest(F.size(right) - 1 - last, F.lit(0)))
    return F.concat(left, right)


class Disclosure:
    """Personal data of ``documents`` and the terms that disclose it.

    A term counts for an entity if it stands within ``reach`` characters of it in at least
    ``min_contexts`` documents whose contexts differ, so copies of a passage prove nothing. Its disclosure is
    1 + ln(n_both / n_term) / ln(n / n_entity), from numbers of documents, all of which are counted. From
    ``generalise_at`` on it is generalised and at 1 removed, wherever it stands in documents that hold the entity.
    An entity of all documents carries no information and is disclosed by nothing.

    Null texts are empty. Equal rows have equal spans, repeated rows count as documents of their own;
    ids are only carried along and may be null or repeated. An empty table gives an empty one.
    """

    def __init__(
        self, documents: DataFrame, ids: str = "doc_id", text: str = "text",
        reach: int = 100, min_contexts: int = 3, generalise_at: float = 0.9, least_chars: int = 3,
    ) -> None:
        self.documents, self.ids, self.text = documents, ids, text
        self.reach, self.min_contexts, self.generalise_at, self.least_chars = reach, min_contexts, generalise_at, least_chars
        self.rows = documents.select(F.col(ids).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        key = F.xxhash64("text")
        holding = self.rows.withColumn("found", entities(F.col("text"))).where(F.size("found") > 0)
        # Numbered while they are written: repeated rows are documents of their own.
        self.holding = store(holding.select(F.monotonically_increasing_id().alias("row"), "id", key.alias("key"), "text", "found"), "pii-holding")

    def disclosing(self) -> DataFrame:
        """entity, term, disclosure and action of the terms to be generalised or removed."""
        spans = self.holding.select("row", "text", F.explode("found").alias("span"))
        contexts = spans.select("row", F.col("span.entity").alias("entity"), _terms(_context(F.col("text"), F.col("span"), self.reach), self.least_chars).alias("terms"))
        mentions = contexts.groupBy("entity", "row").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("terms")))).alias("terms"))
        known = mentions.groupBy("entity").agg(F.count("*").alias("n_entity")).where(F.col("n_entity") >= self.min_contexts)
        near = mentions.join(known, "entity").select("entity", "n_entity", F.xxhash64("terms").alias("context"), F.explode("terms").alias("term"))
        # Counts of a hot entity come together from every task's own, context by context.
        each = near.groupBy("entity", "n_entity", "term", "context").agg(F.count("*").alias("n"))
        pairs = each.groupBy("entity", "n_entity", "term").agg(F.sum("n").alias("n_both"), F.count("*").alias("contexts"))
        pairs = store(pairs.where(F.col("contexts") >= self.min_contexts), "pii-pairs")
        n = self.rows.count()
        words = self.rows.select(F.explode(_terms(F.split("text", SEPARATOR), self.least_chars)).alias("term"))
        if pairs.isEmpty():
            words = words.limit(0)
        frequency = words.groupBy("term").agg(F.count("*").alias("n_term"))
        shown = F.lit(1.0) + F.ln(F.col("n_both") / F.col("n_term")) / F.ln(F.lit(float(n)) / F.col("n_entity"))
        judged = pairs.where(F.col("n_entity") < n).join(frequency, "term").withColumn("disclosure", shown)
        judged = judged.where(F.col("disclosure") >= self.generalise_at)
        action = F.when(F.col("n_both") == F.col("n_term"), "remove").otherwise("generalise")
        return judged.select("entity", "term", "disclosure", action.alias("action"))

    def term_spans(self) -> DataFrame:
        """For each text (id, key) that holds them: spans of its disclosing terms, with start, end and action."""
        terms = store(self.disclosing(), "pii-terms")
        held = self.holding.select("row", F.explode(F.array_distinct(F.col("found.entity"))).alias("entity"))
        wanted = held.join(terms, "entity").groupBy("row", "term").agg(F.max("action").alias("action"))
        affected = self.holding.join(wanted.select("row").distinct(), "row", "left_semi")
        pieces = affected.select("row", "id", "key", "found", F.posexplode(F.regexp_extract_all("text", F.lit(PIECE), F.lit(0))).alias("at", "piece"))
        through = F.sum(F.length("piece")).over(Window.partitionBy("row").orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
        word = F.regexp_replace("piece", f"^{SEPARATOR}++", "")
        open_ = F.length(F.regexp_extract(word, f"^{PUNCTUATION}*+", 0))
        bare = F.regexp_replace(lower(word), f"^{PUNCTUATION}++|{PUNCTUATION}++$", "")
        start = (through - F.length(word) + open_).cast("int")
        placed = pieces.select("row", "id", "key", "found", bare.alias("term"), start.alias("start"), (start + F.length(bare)).alias("end"))
        free = ~F.exists("found", lambda s: (s["start"] < F.col("end")) & (s["end"] > F.col("start")))
        hits = placed.join(wanted, ["row", "term"]).where(free)
        spans = F.sort_array(F.collect_list(F.struct("start", "end", "action"))).alias("terms")
        by_row = hits.groupBy("row", "id", "key").agg(spans)
        return by_row.dropDuplicates(["id", "key"]).select("id", "key", "terms")

    def find(self) -> DataFrame:
        """All rows and columns of the documents, with ``pii``: spans of personal data and of what discloses it.

        A span has start, end (code points, end exclusive), kind (``term`` last at one start) and action. An
        input column named ``pii`` is replaced, unless it holds the ids or texts.
        """
        if "pii" in (self.ids, self.text):
            raise ValueError("ids and texts cannot be in a column named pii")
        spans = self.term_spans().select(F.col("id").alias("__id"), F.col("key").alias("__key"), F.col("terms").alias("__terms"))
        rows = self.documents.drop("pii")
        full = F.coalesce(F.col(self.text), F.lit(""))
        rows = rows.withColumns({"__found": entities(full), "__own": F.xxhash64(full)})
        joined = rows.join(spans, F.col(self.ids).eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__key")), "left")

        def shaped(s: Column, rank: Column, kind: Column, action: Column) -> Column:
            return F.struct(s["start"].alias("start"), rank.alias("rank"), s["end"].alias("end"), kind.alias("kind"), action.alias("action"))

        base = F.transform("__found", lambda s: shaped(s, s["rank"], s["kind"], F.lit("mask")))
        added = F.transform(F.coalesce("__terms", F.array().cast(TERM_SPANS)), lambda s: shaped(s, F.lit(len(KINDS)), F.lit(TERM), s["action"]))
        return joined.withColumn("pii", F.array_sort(F.concat(base, added))).drop("__found", "__own", "__id", "__key", "__terms")


def shown(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def sanitise(text: Column, pii: Column) -> Column:
    """A text without what ``pii`` names: entities become their kind in brackets, generalised terms
    ``[number]``, ``[name]`` (a capital first) or ``[word]``; removed ones go. Where spans overlap, the first counts."""
    full = F.coalesce(text, F.lit(""))
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def add(done: Column, s: Column) -> Column:
        value = F.substring(full, s["start"] + 1, s["end"] - s["start"])
        general = F.when(value.rlike("^[0-9]"), "[number]").when(value.rlike(r"^\p{Lu}"), "[name]").otherwise("[word]")
        put = F.when(s["action"] == "mask", F.concat(F.lit("["), s["kind"], F.lit("]"))).when(s["action"] == "remove", "").otherwise(general)
        gap = F.substring(full, done["at"] + 1, s["start"] - done["at"])
        return F.when(s["start"] < done["at"], done).otherwise(
            F.struct(s["end"].alias("at"), F.concat(done["parts"], F.array(gap, put)).alias("parts"))
        )

    def finish(done: Column) -> Column:
        return F.concat(F.array_join(done["parts"], ""), F.substring(full, done["at"] + 1, F.length(full)))

    return F.aggregate(pii, state, add, finish)
