"""License scan by diagonal voting on word k-grams.

Every text's rolling hashes of three words (and of two, for templates that
short) are joined with the positions of the same hashes in the templates. A hit
votes for its diagonal (position in the text minus position in the template).
A diagonal with a vote for every gram is a place where the template's words
stand consecutively. Neighbouring diagonals of one template, shifted by words
put in or left out, are merged. A merged span is then verified against the
template: of its matching words the longest series is taken that ascends in both
texts, each template position once, and the span counts where that series covers
enough of the template. Words put in, left out or changed lower the cover, words
repeated add nothing.

Cases: null and empty texts have no words; overlapping places all count;
repeated rows are scanned one by one; an empty table gives an empty result;
only the id of a row is carried along, whatever other columns are named, and a
null id is an id like others; a very long text takes some 100 bytes a byte of
its own task.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from strata.llm import common
from strata.session import materialise

# The phrases and labels every scan counts.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Notices of public licenses, as words.
NOTICES: list[tuple[str, str]] = [
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "cc by nc 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "cc by sa 4 0"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc0", "the person who associated a work with this deed has dedicated the work to the public domain"),
    ("gpl-3.0", "gnu general public license version 3"),
    ("gpl-2.0", "gnu general public license version 2"),
    ("gpl", "it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("epl-2.0", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software"),
    ("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]
SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
WORDS = common.lower_map(SEPARATORS)
LEAST_COVER = 0.8
NEAR = 3  # diagonals this close belong to one span
MAX_GRAMS = 100_000  # with more template positions they are joined instead of broadcast


def words_of(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return common.hashed_words(data, np.array([0, len(data)]), WORDS)[0]


def template_grams(templates: Sequence[str]) -> list[tuple[int, int, int, int]]:
    """(gram, template, position, grams in the template) of every template."""
    out = []
    for number, text in enumerate(templates):
        words = words_of(text)
        if len(words) < 2:
            raise ValueError("a template needs two words at least")
        own = common.grams(words, min(3, len(words))).view(np.int64).tolist()
        out += [(gram, number, position, len(own)) for position, gram in enumerate(own)]
    return out


def hits(df: DataFrame, templates: Sequence[str], text: str = "text", doc_id: str = "doc_id", max_grams: int = MAX_GRAMS) -> DataFrame:
    """Joined gram hits, and one row without a template per text: (row, doc_id, n_words, template, n_grams, place, diagonal)."""

    def roll(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in common.pieces(batches, 1):
            words, owner, _, _ = common.hashed_words(*common.bytes_of(batch.column(1)), WORDS)
            n = np.bincount(owner, minlength=batch.num_rows)
            first = np.concatenate([[0], np.cumsum(n)])
            three, two = (common.grams(words, k).view(np.int64) if len(words) >= k else np.empty(0, np.int64) for k in (3, 2))
            # Per text: a marker, its 3-grams, its 2-grams.
            n3, n2 = np.maximum(n - 2, 0), np.maximum(n - 1, 0)
            lists = [x for i in range(batch.num_rows) for x in (MARK, three[first[i] : first[i] + n3[i]], two[first[i] : first[i] + n2[i]])]
            at = np.concatenate([[0], np.cumsum(1 + n3 + n2)])
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(row, row + batch.num_rows)), batch.column(0), pa.array(n.astype(np.int64)), pa.array(n3.astype(np.int64)),
                pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.concatenate(lists)))], names=["row", doc_id, "n_words", "n3", "grams"])
            row += batch.num_rows

    kind = df.schema[doc_id].dataType.simpleString()
    rolled = df.select(doc_id, common.text_bytes(text)).mapInArrow(roll, f"row long, `{doc_id}` {kind}, n_words long, n3 long, grams array<long>")
    each = rolled.select("row", doc_id, "n_words", "n3", F.posexplode("grams").alias("at", "gram"))
    places = template_grams(templates)
    known = df.sparkSession.createDataFrame(places, "gram long, template int, place int, n_grams int")
    joined = each.join(F.broadcast(known) if len(places) <= max_grams else known, "gram", "left").where("template IS NOT NULL OR at = 0")
    position = F.when(F.col("at") <= F.col("n3"), F.col("at") - 1).otherwise(F.col("at") - 1 - F.col("n3"))
    fits = F.col("template").isNotNull() & (F.col("at") > 0)
    return joined.select("row", doc_id, "n_words", F.when(fits, F.col("template")).alias("template"), "n_grams", "place", (position - F.col("place")).alias("diagonal"))


MARK = np.zeros(1, np.int64)


def longest_ascent(found: Sequence[tuple[int, int]]) -> int:
    """Length of the longest series of (position, place) that ascends in both."""
    ends: list[int] = []
    for _, place in sorted(found, key=lambda f: (f[0], -f[1])):
        at = bisect_left(ends, place)
        ends[at : at + 1] = [place]
    return len(ends)


@F.pandas_udf(IntegerType())
def _in_order(diagonals: pd.Series, places: pd.Series) -> pd.Series:
    return pd.Series([longest_ascent([(int(d) + int(p), int(p)) for d, own in zip(ds, ps) for p in own]) for ds, ps in zip(diagonals, places)], dtype="int32")


def scan(df: DataFrame, templates: Sequence[str], text: str = "text", doc_id: str = "doc_id", max_grams: int = MAX_GRAMS) -> tuple[DataFrame, DataFrame]:
    """All texts (row, id, n_words), and verified spans (row, template, first_word,
    last_start, cover, whole): ``whole`` spans hold the template word for word."""
    written = materialise(hits(df, templates, text, doc_id, max_grams), "license-hits")
    texts = written.where("template IS NULL").select("row", doc_id, "n_words")
    votes = written.where("template IS NOT NULL").groupBy("row", "template", "n_grams", "diagonal").agg(F.collect_set("place").alias("places"))
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    whole = F.size("places") == F.col("n_grams")
    marked = votes.withColumn("new", (F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > NEAR, F.lit(True)) | whole).cast("int"))
    grouped = marked.withColumn("span", F.sum("new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    # Spans of merged diagonals are short, so what is verified together is at most a few times the template.
    own = Window.partitionBy("row", "template", "span")
    near = grouped.withColumn("first", F.min("diagonal").over(own)).where(F.col("diagonal") - F.col("first") <= NEAR * 2)
    spans = near.groupBy("row", "template", "n_grams", "span").agg(
        F.min("diagonal").alias("first_word"), F.max("diagonal").alias("last_start"), F.max(whole).alias("whole"),
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("n_places"), F.collect_list(F.struct("diagonal", "places")).alias("hits"))
    likely = spans.where(F.col("whole") | (F.col("n_places") >= LEAST_COVER * F.col("n_grams")))
    cover = F.when(F.col("whole"), F.lit(1.0)).otherwise(_in_order("hits.diagonal", "hits.places") / F.col("n_grams"))
    kept = likely.select("row", "template", "first_word", "last_start", cover.alias("cover"), "whole")
    return texts, kept.where(F.col("whole") | (F.col("cover") >= LEAST_COVER))


def license_scan(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Counts and labels of every text."""
    base = list(BASE)
    templates = [*base, *[words for _, words in NOTICES]]
    labels = [*BASE.values(), *[label for label, _ in NOTICES]]
    texts, spans = scan(df, templates, text, doc_id)
    is_base = (F.col("template") < len(base)) & F.col("whole")
    label = F.element_at(F.array(*map(F.lit, labels)), F.col("template") + 1)
    join = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    found = spans.where(is_base | (F.col("template") >= len(base))).groupBy("row").agg(
        F.sum(is_base.cast("long")).alias("n_base"), F.min(F.when(is_base, F.col("first_word"))).alias("first_word"),
        F.max(F.when(is_base, F.col("first_word"))).alias("last_word"), join(F.when(is_base, label)).alias("base_labels"),
        join(label).alias("labels"), F.max("cover").alias("score"))
    return texts.join(found, "row", "left").select(
        doc_id, "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), F.col("first_word").cast("long"), F.col("last_word").cast("long"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))


def op8_license_scan(spark, sf_dir: str) -> DataFrame:
    common.small_batches(spark)
    return license_scan(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
