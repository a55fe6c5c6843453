"""Preference formatting of chat pairs, in DataFrame functions alone.

A pair is a chosen and a rejected conversation. Their longest common prefix of turns, equal in role
and text, is rendered once as the prompt; what follows on each side is its completion, rendered
with a mask of the characters that are to be learned: those of assistant turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# A public chat markup.
START, END = "<|im_start|>", "<|im_end|>"
ROLES = ("system", "user", "assistant", "tool")
LEARNED = "assistant"
# Bound of the runs, whose borders stand in the plan.
MOST_RUNS = 1000

TURN = "struct<turn:bigint,role:string,text:string>"


def conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: conv_id and its turns in order.

    Turns are ordered by their number, then role and text; a fully repeated turn counts once. Rows
    with a null conversation or number are in no conversation. A null role is ``user``; a null text is empty.
    """
    rows = turns.select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.struct(
            F.col(turn).cast("long").alias("turn"),
            F.coalesce(F.lower(F.trim(role)), F.lit("user")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("t"),
    ).where("conv_id IS NOT NULL AND t.turn IS NOT NULL")
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_set("t")).alias("turns"))


def _same(i: Column) -> Column:
    left, right = F.get("chosen", i), F.get("rejected", i)
    return (left["role"] == right["role"]) & (left["text"] == right["text"])


def common_turns() -> Column:
    """Number of turns that ``chosen`` and ``rejected`` share from the start.

    At least one turn stays on each side, so that no completion is empty.
    """
    most = F.greatest(F.lit(0), F.least(F.size("chosen"), F.size("rejected")) - 1)
    places = F.when(most > 0, F.sequence(F.lit(0), most - 1)).otherwise(F.array().cast("array<int>"))
    differing = F.filter(places, lambda i: ~_same(i))
    return F.coalesce(F.get(differing, F.lit(0)), most)


def _escaped(text: Column) -> Column:
    """Marks inside a text are broken up, so that only real ones are read as marks."""
    return F.regexp_replace(text, r"<\|(im_start|im_end)\|>", "<| $1 |>")


def render(turns: Column) -> Column:
    """The text of an array of turns."""
    line = F.transform(turns, lambda t: F.concat(F.lit(START), t["role"], F.lit("\n"), _escaped(t["text"]), F.lit(END + "\n")))
    return F.array_join(line, "")


def learned_spans(turns: Column) -> Column:
    """Character spans (start, length) of what assistant turns say, with the end mark, in rendered turns."""
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def add(state: Column, t: Column) -> Column:
        head = F.length(F.concat(F.lit(START), t["role"], F.lit("\n")))
        body = F.length(_escaped(t["text"])) + len(END)
        span = F.array(F.struct((state["at"] + head).alias("start"), body.alias("length")))
        return F.struct(
            (state["at"] + head + body + 1).alias("at"),
            F.when(t["role"] == LEARNED, F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"),
        )

    return F.aggregate(turns, empty, add)["spans"]


def format_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs (``chosen`` and ``rejected``, arrays of turns) as prompt and masked completions.

    Adds prompt_turns, prompt, and for each side its completion and mask, the spans of the
    completion's characters to learn. The prompt ends with the last common turn. Sides that are equal
    throughout keep their last turn as completion. An empty or null side gives null results on it and
    an empty prompt. All other columns return; those with a result's name are replaced.
    """
    results = ("prompt_turns", "prompt", "chosen_completion", "chosen_mask", "rejected_completion", "rejected_mask")
    ready = pairs.drop(*results).withColumn("prompt_turns", F.when(F.col("chosen").isNull() | F.col("rejected").isNull(), 0).otherwise(common_turns()))
    ready = ready.withColumn("prompt", F.coalesce(render(F.slice("chosen", F.lit(1), F.col("prompt_turns"))), F.lit("")))
    for side in ("chosen", "rejected"):
        rest = F.slice(F.col(side), F.col("prompt_turns") + 1, F.greatest(F.size(side), F.lit(1)))
        known = F.size(side) > 0
        ready = ready.withColumn(f"{side}_completion", F.when(known, render(rest))).withColumn(
            f"{side}_mask", F.when(known, learned_spans(rest))
        )
    return ready


def neighbour_pairs(turns: DataFrame, part_rows: int = 10000) -> DataFrame:
    """A pair for each conversation and the one after it with the same first turn.

    Conversations are grouped by the role and text of their first turn, by hash, and ordered by
    conv_id; each is paired with the next one, the longer of both as chosen (the smaller conv_id
    on a tie), so a group makes fewer pairs than it has members. Groups may hold any share of all
    conversations: they are cut into runs of conv_ids by quantiles of the ids, and the first member of
    each run is carried over to the run before. A conversation alone in its group is paired with itself without its last turn.
    """
    whole = conversations(turns)
    first = F.get("turns", F.lit(0))
    keyed = whole.withColumn("prompt_key", F.xxhash64(first["role"], first["text"]))
    return _pair(keyed, part_rows)


def _run(ids: DataFrame, part_rows: int) -> Column:
    """The run of a conv_id: the number of borders, quantiles of all ids, that are not above it."""
    count = min(-(-ids.count() // part_rows), MOST_RUNS)
    if count < 2:
        return F.lit(0)
    shares = [i / count for i in range(1, count)]
    borders = sorted(set(ids.agg(F.percentile_approx("conv_id", shares, 10 * MOST_RUNS)).first()[0]))
    return F.size(F.filter(F.lit(borders), lambda b: b <= F.col("conv_id")))


def _pair(keyed: DataFrame, part_rows: int) -> DataFrame:
    ids = keyed.select("conv_id", "prompt_key")
    # Runs of conversations of about equal size over all ids; the number of runs follows the rows.
    runs = ids.withColumn("run", _run(ids, part_rows))
    inside = Window.partitionBy("prompt_key", "run").orderBy("conv_id")
    heads = runs.groupBy("prompt_key", "run").agg(F.min("conv_id").alias("head"))
    # One row per group and run, so this window is short whatever the group holds.
    after = Window.partitionBy("prompt_key").orderBy("run")
    heads = heads.withColumn("next_head", F.lead("head").over(after)).select("prompt_key", "run", "next_head")
    linked = runs.withColumn("next_id", F.lead("conv_id").over(inside)).join(heads, ["prompt_key", "run"])
    linked = linked.select("conv_id", "prompt_key", F.coalesce("next_id", "next_head").alias("other_id"))
    alone = runs.groupBy("prompt_key").agg(F.count("*").alias("members")).where("members = 1")
    single = linked.join(alone.select("prompt_key"), "prompt_key").select("conv_id", F.col("conv_id").alias("other_id"))
    several = linked.where("other_id IS NOT NULL").select("conv_id", "other_id")
    links = several.unionByName(single)
    one = keyed.select("conv_id", F.col("turns").alias("own"))
    two = keyed.select(F.col("conv_id").alias("other_id"), F.col("turns").alias("other"))
    both = links.join(one, "conv_id").join(two, "other_id")
    shorter = F.slice("other", F.lit(1), F.greatest(F.size("other") - 1, F.lit(0)))
    both = both.withColumn("other", F.when(F.col("conv_id") == F.col("other_id"), shorter).otherwise(F.col("other")))
    swap = F.size("other") > F.size("own")
    return both.select(
        F.when(swap, F.col("other_id")).otherwise(F.col("conv_id")).alias("chosen_id"),
        F.when(swap, F.col("conv_id")).otherwise(F.col("other_id")).alias("rejected_id"),
        F.when(swap, F.col("other")).otherwise(F.col("own")).alias("chosen"),
        F.when(swap, F.col("own")).otherwise(F.col("other")).alias("rejected"),
    )
