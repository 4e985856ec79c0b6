"""License scans by MinHash bands over overlapping text windows.

A text's words (runs of ASCII letters and digits, in lower case) make shingles
of five.  Templates fall into classes by size: a template of up to B shingles,
B a power of two, is sought in windows of W = B + B/2 - 1 shingles, a new one
every B/2, so any run of B shingles lies whole in some window.  A window that
holds ``LEAST`` of a template's shingles has a similarity s of at least a
quarter with it; with ``BANDS`` bands of one MinHash value each they collide
with a probability of at least 1 - 0.75 ** 48 > 0.999998.  Collisions are
verified by the exact containment of the template's shingles in the window.

Every step is a DataFrame expression.  Bands can only collide where a window
shares a shingle with a template, so texts and windows that share none are
left out before any MinHash is computed; that changes no result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import materialise

WIDTH, LEAST, BANDS, LONGEST = 5, 0.8, 48, 256
#: Up to so many template shingles are put into the plan as one literal to leave out texts that share none.
LITERALS = 20_000
#: Bytes of template rows up to which they are broadcast; beyond, Spark joins by shuffle.
BROADCAST_BYTES = 8 << 20

#: Notices of common licenses, in their published wording.
NOTICES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "apache-2.0-header",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl-3.0-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "Released under the MIT License."),
    (
        "mit-grant",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, "
        "to deal in the Software without restriction",
    ),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]


def notices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(NOTICES, "template_id string, text string")


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), "[^a-z0-9]+"), lambda w: w != "")


def shingles(text: Column, width: int = WIDTH) -> Column:
    """An array with one element: the hashes of a text's shingles, in order; none where there are too few words.

    The words are bound once, as a lambda's variable: filters that Catalyst
    moves below this expression can't copy it into the loop over its words.
    """

    def of(w: Column) -> Column:
        grams = F.transform(
            F.sequence(F.lit(0), F.size(w) - width), lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(width)))
        )
        return F.when(F.size(w) < width, F.expr("cast(array() as array<long>)")).otherwise(grams)

    return F.transform(F.array(words(text)), of)


def _bands(name: str) -> Column:
    """MinHash values, one a band."""
    return F.expr(f"transform(sequence(1, {BANDS}), j -> array_min(transform({name}, h -> xxhash64(h, j))))")


def _templates(templates: DataFrame) -> DataFrame:
    """(template_id, segment, size class b, set): long templates are cut into segments of at most ``LONGEST`` shingles."""
    rows = (
        templates.select(F.col("template_id").cast("string").alias("template_id"), F.explode(shingles(F.col("text"))).alias("sh"))
        .filter("template_id is not null and size(sh) > 0")
        .select("template_id", F.posexplode(F.expr(f"transform(sequence(0, (size(sh) - 1) div {LONGEST}), k -> array_distinct(slice(sh, cast(k * {LONGEST} + 1 as int), {LONGEST})))")).alias("segment", "set"))
    )
    return rows.withColumn("b", F.expr("cast(pow(2, ceil(log2(size(set)))) as int)")).dropDuplicates(["template_id", "segment"])


def _shares(sh: Column, literals: Column | None) -> Column:
    return F.size(sh) > 0 if literals is None else F.arrays_overlap(sh, literals)


def _windows(docs: DataFrame, b: int, literals: Column | None) -> DataFrame:
    """(key, start, s, b): the windows of one size class that share a shingle with a template."""
    step = max(1, b // 2)
    wide = b + step - 1
    every = F.expr(f"transform(sequence(0, cast((size(sh) - 1) div {step} as int)), k -> named_struct('start', k * {step}, 's', slice(sh, k * {step} + 1, {wide})))")
    return docs.select("key", F.explode(F.filter(every, lambda w: _shares(w["s"], literals))).alias("w")).select("key", "w.start", "w.s", F.lit(b).alias("b"))


def scan(df: DataFrame, templates: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST) -> DataFrame:
    """Rows (doc_id, matches), one per row of ``df``.

    ``matches`` is a sorted array of (template_id, containment, start_word):
    every template of which some window holds at least ``least`` of its
    distinct shingles, its best containment and the first word of the earliest
    such window.  A template of several segments counts the best window of
    each.  A null text, an empty one or one of fewer than five words matches
    nothing; templates of fewer than five words, or with a null id or text, are
    ignored; null ids are kept; repeated rows match alike; empty tables of
    documents or templates give no rows or no matches; other columns are
    ignored.  Texts aren't shuffled.
    """
    t = materialise(_templates(notices(df.sparkSession) if templates is None else templates))
    classes = [r[0] for r in t.select("b").distinct().orderBy("b").collect()]  # at most nine sizes
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    known = t.select(F.explode("set").alias("h")).distinct()
    few = known.limit(LITERALS + 1).collect()
    literals = F.lit([r[0] for r in few]).cast("array<long>") if 0 < len(few) <= LITERALS else None
    with_shared = F.filter(shingles(F.col("text")), lambda sh: _shares(sh, literals))
    held = materialise(docs.select(F.struct("doc_id", "text_hash").alias("key"), F.explode(with_shared).alias("sh")).dropDuplicates(["key"]))
    out = docs.select("doc_id", "text_hash")
    none = F.expr("cast(array() as array<struct<template_id:string,containment:double,start_word:int>>)")
    if not classes:
        return out.select("doc_id", none.alias("matches"))
    windows = None
    for b in classes:
        more = _windows(held, b, literals)
        windows = more if windows is None else windows.unionByName(more)
    size = t.agg(F.sum(F.size("set") * 8 + 64)).first()[0]
    near = F.broadcast if size * BANDS <= BROADCAST_BYTES else (lambda x: x)
    retrieved = (
        windows.select("key", "start", "s", "b", F.posexplode(_bands("s")).alias("band", "value"))
        .join(near(t.select("template_id", "segment", "b", "set", F.posexplode(_bands("set")).alias("band", "value"))), ["b", "band", "value"])
        .groupBy("key", "start", "template_id", "segment")
        .agg(F.first("s").alias("s"), F.first("set").alias("set"))
    )
    whole = t.groupBy("template_id").agg(F.sum(F.size("set")).alias("whole"))
    matches = (
        retrieved.select("key", "template_id", "segment", F.struct(F.size(F.array_intersect("set", "s")).alias("hit"), (-F.col("start")).alias("late")).alias("best"))
        .groupBy("key", "template_id", "segment")
        .agg(F.max("best").alias("best"))
        .groupBy("key", "template_id")
        .agg(F.sum("best.hit").alias("hit"), F.min(-F.col("best.late")).alias("start_word"))
        .join(near(whole), "template_id")
        .withColumn("containment", F.col("hit") / F.col("whole"))
        .filter(F.col("containment") >= least)
        .groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct("template_id", "containment", "start_word"))).alias("matches"))
        .select(F.col("key.doc_id").alias("d"), F.col("key.text_hash").alias("h"), "matches")
    )
    return out.join(matches, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")), "left").select(
        "doc_id", F.coalesce("matches", none).alias("matches")
    )


def oracle(table: str = "documents") -> str:
    """DuckDB SQL for the digest of ``scan`` with the default notices: exact containment in every window, without bands."""
    values = ", ".join("('{}', '{}')".format(a, b.replace("'", "''")) for a, b in NOTICES)
    split = "list_filter(string_split_regex(lower(coalesce(text, '')), '[^a-z0-9]+'), lambda x: x <> '')"
    grams = "list_transform(range(0, len(w) - {0}), lambda i: array_to_string(w[i + 1 : i + {1}], ' '))".format(WIDTH - 1, WIDTH)
    return f"""
with template as (
  select template_id, list_distinct({grams}) as t from (select template_id, {split} as w from (values {values}) v(template_id, text))
), sized as (
  select *, cast(pow(2, ceil(log2(len(t)))) as bigint) as b from template where len(t) > 0
), stepped as (
  select *, greatest(1, b // 2) as step, b + greatest(1, b // 2) - 1 as wide from sized
), doc as (
  select doc_id, {grams} as sh from (select doc_id, {split} as w from {table})
), near as (
  select doc_id, template_id, t, step, wide, sh from doc join stepped on list_has_any(sh, t)
), hit as (
  select doc_id, template_id, len(t) as n, unnest(list_transform(range(0, (len(sh) - 1) // step + 1), lambda k: len(list_intersect(t, sh[k * step + 1 : k * step + wide])))) as m
  from near
), best as (
  select doc_id, template_id, max(m) / any_value(n) as containment from hit group by all having max(m) / any_value(n) >= {LEAST}
), per as (
  select doc_id, count(*) as n, string_agg(template_id, ',' order by template_id) as ids, max(containment) as top from best group by doc_id
)
select d.doc_id, cast(coalesce(n, 0) as bigint) as n_licenses, coalesce(ids, '') as licenses, round(coalesce(top, 0.0), 6) as top_containment
from {table} d left join per using (doc_id)
"""
