"""License scans: which license notices stand in a text, in DataFrame functions alone.

Texts are cut into overlapping windows of word shingles, twice as long as the templates of a size
class and stepping by half their length, so every occurrence lies whole in a window. A template
and a window that has 80 percent of it have a Jaccard similarity of at least about 0.19; with 48
bands of one MinHash value each they meet in a band with a chance above 99.99 percent. What meets is verified
by the exact share of the template's shingles in the window.

A window meets a template in a band only where its smallest value is that of the template, hence only
at a shingle that gives the template its MinHash value there. So the bands' values are looked up at the
shingles first, and windows are hashed whole only around such a place. Shingles of a template are then counted
in the windows that a band has retrieved, and in no others.

Before that, texts without any anchor are left out: anchors are words chosen so that every shingle
of every template has one, hence a text without them has no shingle of any template.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.session import store

# Wordings of public license notices.
TEMPLATES = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions",
    "MIT-line": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
    "compliance with the License. You may obtain a copy of the License at",
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED",
}

# Words too common to tell a license from other text.
COMMON = frozenset("a above all and any appear are as at be by copy file for from in is it may not of on or that the this to under use whom with without you your".split())

BANDS = 48
SHINGLE_WORDS = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    """Runs of letters and digits, A-Z as a-z."""
    plain = F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SEPARATORS, " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def shingles(own: Column, size: int = SHINGLE_WORDS) -> Column:
    """All shingles in order; a text with fewer words has one of them all, one without words none."""
    many = F.transform(F.sequence(F.lit(1), F.size(own) - size + 1), lambda i: F.array_join(F.slice(own, i, size), " "))
    few = F.when(F.size(own) > 0, F.array(F.array_join(own, " "))).otherwise(F.array().cast("array<string>"))
    return F.when(F.size(own) >= size, many).otherwise(few)


def template_words(templates: dict[str, str]) -> dict[str, list[str]]:
    return {name: "".join(c.lower() if c.isalnum() else " " for c in text).split() for name, text in templates.items()}


def template_shingles(templates: dict[str, str], size: int = SHINGLE_WORDS) -> dict[str, list[str]]:
    """The distinct shingles of each template."""
    own = template_words(templates)
    return {n: sorted({" ".join(w[i : i + size]) for i in range(max(1, len(w) - size + 1))}) for n, w in own.items() if w}


def anchors(templates: dict[str, str], size: int = SHINGLE_WORDS) -> list[str]:
    """Words of which every shingle of every template has one, rare and long words first."""
    open_shingles = [s.split() for own in template_shingles(templates, size).values() for s in own]
    chosen: list[str] = []
    while open_shingles:
        counts: dict[str, int] = {}
        for own in open_shingles:
            for word in set(own):
                counts[word] = counts.get(word, 0) + 1
        best = max(sorted(counts), key=lambda w: (w not in COMMON, min(len(w), 6), counts[w]))
        chosen.append(best)
        open_shingles = [own for own in open_shingles if best not in own]
    return chosen


def size_class(count: int) -> int:
    """Templates of 2**c to 2**(c+1) - 1 shingles are of class c; its windows step by 2**(c+1) and are twice that."""
    return count.bit_length() - 1


def _template_rows(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    rows = [(n, size_class(len(s)), len(s), g) for n, s in template_shingles(templates).items() for g in s]
    made = spark.createDataFrame(rows, "license string, class int, n int, shingle string")
    return made.withColumn("hash", F.xxhash64("shingle"))


def _minima() -> list[Column]:
    return [F.min(F.xxhash64(F.lit(k), "hash")).alias(f"m{k}") for k in range(BANDS)]


def _firing_shingles(rows: DataFrame) -> list[str]:
    """The shingles that give a template the value of one of its bands; a constant of the templates."""
    least = [F.min_by("shingle", F.xxhash64(F.lit(k), "hash")) for k in range(BANDS)]
    found = rows.groupBy("license").agg(F.array_distinct(F.array(*least)).alias("s")).select(F.explode("s").alias("s"))
    return sorted({r["s"] for r in found.collect()})


def find_licenses(
    documents: DataFrame, ids: str = "doc_id", text: str = "text", templates: dict[str, str] | None = None, threshold: int = 80
) -> DataFrame:
    """A row for each text and license notice in it: ids, license, window (the first shingle of the
    best window, from 0), found (shingles there), n (of the template).

    The best window has most of the template's shingles, at least ``threshold`` percent; of equal
    ones the first. Only the id and the text are read; rows with the same id and text are one. A
    null id is kept. A null or empty text has no license; no templates or no texts give no rows. Texts
    are read whole.
    """
    spark = documents.sparkSession
    templates = TEMPLATES if templates is None else templates
    known = template_shingles(templates)
    schema = f"{ids} {documents.schema[ids].dataType.simpleString()}, license string, window long, found long, n long"
    if not known:
        return spark.createDataFrame([], schema)
    # The templates are constants of the call, so what is broadcast does not follow the data.
    rows = _template_rows(spark, templates)
    marks = F.array(*[F.lit(w) for w in anchors(templates)])
    # The words are a column of their own, so that they are split once and not for every shingle.
    texts = documents.select(F.col(ids).alias("id"), F.xxhash64(text).alias("row_key"), words(F.col(text)).alias("words"))
    firing = _firing_shingles(rows)
    places = F.filter(F.transform(shingles(F.col("words")), lambda g, i: F.when(g.isin(firing), i)), lambda i: i.isNotNull())
    near = F.when(F.arrays_overlap("words", marks), places).otherwise(F.array().cast("array<int>"))
    # As a filter the places would be found twice, once to test and once to keep them; a generator finds them once.
    met = F.filter(F.array(F.struct(near.alias("near"), "words")), lambda t: F.size(t["near"]) > 0)
    # What is left is a small part, read twice below.
    texts = store(texts.select("id", "row_key", F.inline(met)), "license-texts")
    texts = texts.select("id", "row_key", "near", shingles(F.col("words")).alias("all"))
    placed = texts.select("id", "row_key", "near", F.posexplode("all").alias("place", "shingle"))
    placed = placed.withColumn("hash", F.xxhash64("shingle"))
    classes = sorted({size_class(len(s)) for s in known.values()})
    step = F.expr("shiftleft(2, class)")
    spread = placed.withColumn("class", F.explode(F.array(*[F.lit(c) for c in classes])))
    # A window without any value of a band meets no template, so only the surroundings of such places are hashed.
    spread = spread.where(F.exists("near", lambda i: F.abs(i - F.col("place")) < 2 * step)).drop("near")
    slot = F.floor(F.col("place") / step).cast("long")
    spread = spread.withColumn("slot", F.explode(F.array(slot, slot - 1))).where("slot >= 0")
    keys = ["id", "row_key", "class", "slot"]
    windows = spread.groupBy(*keys).agg(*_minima())

    wanted = rows.groupBy("license", "class").agg(*_minima()).collect()
    close = reduce(
        lambda a, b: a | b,
        [F.col(f"m{k}").isin(sorted({r[f"m{k}"] for r in wanted})) for k in range(BANDS)],
    )
    bands = F.explode(F.array(*[F.struct(F.lit(k).alias("band"), F.col(f"m{k}").alias("value")) for k in range(BANDS)]))
    values = [(r["license"], r["class"], k, r[f"m{k}"]) for r in wanted for k in range(BANDS)]
    table = spark.createDataFrame(values, "license string, class int, band int, value long")
    met = windows.where(close).select(*keys, bands.alias("b")).select(*keys, "b.*")
    candidates = met.join(F.broadcast(table), ["class", "band", "value"]).select(*keys, "license").distinct()

    inside = spread.join(F.broadcast(rows.select("class", "shingle", "license", "n")), ["class", "shingle"])
    retrieved = inside.alias("h").join(
        candidates.alias("c"),
        F.col("h.id").eqNullSafe(F.col("c.id"))
        & (F.col("h.row_key") == F.col("c.row_key"))
        & (F.col("h.class") == F.col("c.class"))
        & (F.col("h.slot") == F.col("c.slot"))
        & (F.col("h.license") == F.col("c.license")),
        "left_semi",
    )
    hits = retrieved.groupBy(*keys, "license", "n").agg(F.countDistinct("shingle").alias("found"))
    verified = hits.where(F.col("found") * 100 >= F.col("n") * threshold)
    first = F.min(F.struct((-F.col("found")).alias("less"), (F.col("slot") * step).alias("window"), "n")).alias("best")
    best = verified.groupBy("id", "row_key", "license").agg(first)
    return best.select(
        F.col("id").alias(ids),
        "license",
        F.col("best.window").cast("long").alias("window"),
        (-F.col("best.less")).cast("long").alias("found"),
        F.col("best.n").cast("long").alias("n"),
    )


def scan_sql(source: str = "documents", threshold: int = 80) -> str:
    """SQL of the same rows by comparing every window with every template."""
    values = ", ".join(
        f"('{name}', {size_class(len(own))}, {len(own)}, '{shingle}')"
        for name, own in template_shingles(TEMPLATES).items()
        for shingle in own
    )
    return f"""WITH templates(license, class, n, shingle) AS (VALUES {values}),
    plain AS (SELECT doc_id, trim(regexp_replace(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
        '{SEPARATORS}', ' ', 'g')) AS t FROM {source}),
    w AS (SELECT doc_id, string_split(t, ' ') AS w FROM plain WHERE t <> ''),
    s AS (SELECT doc_id, CASE WHEN len(w) < {SHINGLE_WORDS} THEN [array_to_string(w, ' ')] ELSE
        list_transform(range(1, len(w) - {SHINGLE_WORDS - 2}), lambda i: array_to_string(w[i:i + {SHINGLE_WORDS - 1}], ' ')) END AS s FROM w),
    placed AS (SELECT doc_id, unnest(s) AS shingle, unnest(range(0, len(s))) AS place FROM s),
    spread AS (SELECT doc_id, license, class, n, shingle, place // (2 << class) - back AS slot
        FROM placed JOIN templates USING (shingle), (VALUES (0), (1)) AS b(back)),
    hits AS (SELECT doc_id, license, slot * (2 << class) AS place, n, count(DISTINCT shingle) AS found FROM spread WHERE slot >= 0
        GROUP BY doc_id, license, slot, class, n HAVING 100 * count(DISTINCT shingle) >= {threshold} * n)
    SELECT doc_id, license, CAST(place AS BIGINT) AS "window", CAST(found AS BIGINT) AS found, CAST(n AS BIGINT) AS n FROM hits
    QUALIFY row_number() OVER (PARTITION BY doc_id, license ORDER BY found DESC, place) = 1"""
