"""License scans: MinHash bands over overlapping windows retrieve templates, containment verifies.

Everything is DataFrame expressions. A text becomes words and the hashes of its five-word shingles.
A window has as many shingles as the template it is compared with; windows start at every sixteenth
of that length (every shingle for short templates). If the share c of a template's shingles stands
in a stretch of text, some window has a Jaccard similarity of at least (c - 1/32) / (2 - c + 1/32),
0.62 for c = 0.8, and BANDS bands of ROWS minimum hashes meet in one with probability

    1 - (1 - 0.62 ** 2) ** 40 > 0.99999998

Only windows that hold a shingle which is one of the template's minimum hashes can meet in a band, so
only those are hashed; this leaves out nothing.

A template of one to four words is one shingle of its own length, which stands in a text or does not:
it is compared wherever its first word stands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparrowmill.llm.common import text_of

SHINGLE = 5
BANDS, ROWS = 40, 2
BROADCAST_TEMPLATES = 4096

# Notices by which works state their license.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in "
     "the LICENSE file."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
     "International License."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright and related "
     "and neighboring rights to this work to the public domain worldwide."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-or-later", "This program is free software; you can redistribute it and/or modify it under "
     "the terms of the GNU General Public License as published by the Free Software Foundation; either "
     "version 2 of the License, or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT-permission", "Permission is hereby granted, free of charge, to any person obtaining a copy of "
     "this software and associated documentation files (the \"Software\"), to deal in the Software "
     "without restriction, including without limitation the rights to use, copy, modify, merge, "
     "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
     "whom the Software is furnished to do so."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("All-rights-reserved", "All rights reserved."),
)



def notices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(NOTICES), "license string, text string")


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def steps(first: Column, last: Column, by: Column | None = None) -> Column:
    """first, first + by, ... up to last; empty if last is below first."""
    return F.when(last >= first, F.sequence(first, last, by)).otherwise(F.array().cast("array<int>"))


def hashes(found: Column) -> Column:
    return F.transform(
        steps(F.lit(1), F.size(found) - SHINGLE + 1), lambda i: F.xxhash64(F.slice(found, i, SHINGLE))
    )


def shingles(found: Column, first: Column, count: Column) -> Column:
    """Distinct shingles, as text, of ``count`` places from ``first`` (0-based) on."""
    last = F.least(first + count, F.size(found) - SHINGLE + 1)
    return F.array_distinct(
        F.transform(steps(first + 1, last), lambda i: F.array_join(F.slice(found, i, SHINGLE), " "))
    )


def minimum(values: Column, k) -> Column:
    """The k-th minimum hash of shingle hashes."""
    return F.array_min(F.transform(values, lambda v: F.xxhash64(v, k)))


def prepared(templates: DataFrame, bands: int, rows: int) -> DataFrame:
    """template, license, size, step, minima, anchors and texts of every template of five words or more.

    minima has one hash per band and row; anchors are the shingle hashes that give them.
    """
    every = F.sequence(F.lit(0), F.lit(bands * rows - 1))
    found = templates.select("license", words(text_of()).alias("words"))
    found = found.select("license", "words", hashes(F.col("words")).alias("h")).where("size(h) > 0")
    # One row per distinct wording of a license.
    found = found.dropDuplicates(["license", "words"])
    return found.select(
        F.xxhash64("license", "words").alias("template"), "license", F.size("h").alias("size"),
        F.greatest(F.lit(1), F.floor(F.size("h") / 16).cast("int")).alias("step"),
        F.transform(every, lambda k: minimum(F.col("h"), k)).alias("minima"),
        F.array_distinct(F.transform(every, lambda k: F.array_min(
            F.transform("h", lambda v: F.struct(F.xxhash64(v, k).alias("m"), v.alias("v"))))["v"])).alias("anchors"),
        shingles(F.col("words"), F.lit(0), F.size("h")).alias("texts"),
    )


def scan_short(documents: DataFrame, templates: DataFrame, containment: float) -> DataFrame | None:
    """scan_licenses for the templates of one to four words; None if there are none."""
    found = templates.select("license", words(text_of()).alias("words"))
    listed = found.where(F.size("words").between(1, SHINGLE - 1)).dropDuplicates(["license", "words"]).collect()
    if not listed:
        return None
    kind = templates.schema["license"].dataType
    begin: dict[str, list[Column]] = {}
    for r in listed:
        begin.setdefault(r["words"][0], []).append(F.struct(
            F.lit(r["license"]).cast(kind).alias("license"), F.array(*[F.lit(w) for w in r["words"]]).alias("t")))
    owners = F.create_map(*[c for w, some in begin.items() for c in (F.lit(w), F.array(*some))])

    def stands(found: Column, i: Column, t: Column) -> Column:
        return F.slice(found, i + 1, F.size(t)) == t

    def look(found: Column) -> Column:
        at = F.filter(steps(F.lit(0), F.size(found) - 1), lambda i: F.get(found, i).isin(list(begin)))
        return let(at, lambda at: F.transform(
            F.array_distinct(F.flatten(F.transform(at, lambda i: F.filter(
                F.element_at(owners, F.get(found, i)), lambda t: stands(found, i, t["t"]))))),
            lambda t: F.struct(
                t["license"].alias("license"), F.lit(1.0).alias("containment"),
                F.array_min(F.filter(at, lambda i: stands(found, i, t["t"]))).alias("word_at"))))

    one = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.inline(let(words(text_of()), look)))
    return one.where(F.col("containment") >= containment)


def scan_licenses(
    documents: DataFrame, templates: DataFrame, containment: float = 0.8, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """The templates that each whole text contains.

    Returns doc_id, license, containment (largest share of a template's distinct five-word shingles
    that stand in one window of its length, at least ``containment``) and word_at (the first word of
    the first such window), one row per document row and wording found. Words are runs of letters and
    digits in lower case. A template of one to four words is one shingle of its own length, found where
    all its words stand in order; one without words matches nothing. Null and empty texts contain
    nothing. Rows without doc_id or with a repeated one are scanned like any other; extra columns are
    not read; an empty table gives an empty table.

    ``templates`` (license, text) is a reference list: up to a few thousand wordings, whose minimum
    shingles become a literal set. No text is shuffled, and a document's row is widened only by the
    templates whose shingles it has. Templates of both kinds take a pass over the documents each.
    """
    parts = [scan_long(documents, templates, containment, bands, rows), scan_short(documents, templates, containment)]
    parts = [p for p in parts if p is not None]
    if not parts:
        kind = templates.schema["license"].dataType.simpleString()
        return documents.sparkSession.createDataFrame(
            [], f"doc_id long, license {kind}, containment double, word_at int"
        )
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def scan_long(
    documents: DataFrame, templates: DataFrame, containment: float, bands: int, rows: int
) -> DataFrame | None:
    """scan_licenses for the templates of five words or more; None if there are none."""
    # The reference list comes to the driver once. Its counted rows bound the broadcast: most hits
    # are of a few templates, which a shuffle by template would bring into as few tasks.
    found = prepared(templates, bands, rows)
    collected = found.collect()
    listed = documents.sparkSession.createDataFrame(collected, found.schema)
    listed = F.broadcast(listed) if len(collected) <= BROADCAST_TEMPLATES else listed
    anchors = listed.select(F.explode("anchors").alias("hash"), "template").groupBy("hash").agg(
        F.collect_set("template").alias("templates")
    ).collect()
    if not anchors:
        return None
    wanted = [r["hash"] for r in anchors]
    owners = F.create_map(
        *[c for r in anchors for c in (F.lit(r["hash"]), F.array(*[F.lit(t) for t in sorted(r["templates"])]))]
    )

    def look(found: Column) -> Column:
        return let(hashes(found), lambda h: F.struct(
            found.alias("words"), h.alias("h"),
            F.filter(steps(F.lit(0), F.size(h) - 1), lambda i: F.get(h, i).isin(wanted)).alias("at"),
        ))

    one = F.transform(F.array(words(text_of())), look)
    hits = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.inline(F.filter(one, lambda m: F.size(m["at"]) > 0))
    )
    named = F.array_distinct(F.flatten(F.transform("at", lambda i: F.element_at(owners, F.get("h", i)))))
    pairs = hits.select("doc_id", "words", "h", "at", F.explode(named).alias("template")).join(
        listed, "template"
    )

    size, step = F.col("size"), F.col("step")
    near = F.filter("at", lambda i: F.array_contains("anchors", F.get("h", i)))
    starts = F.array_distinct(F.flatten(F.transform(near, lambda i: steps(
        F.ceil(F.greatest(F.lit(0), i - size + 1) / step).cast("int") * step, i, step))))

    def meets(window: Column) -> Column:
        """Whether all rows of some band agree."""
        return F.exists(F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.forall(
            F.sequence(b * rows, b * rows + rows - 1), lambda k: minimum(window, k) == F.get("minima", k)))

    met = pairs.withColumn("met", F.filter(starts, lambda s: meets(F.slice("h", s + 1, size))))
    places = F.array_distinct(F.flatten(F.transform(
        "met", lambda s: steps(F.greatest(F.lit(0), s - step + 1), s + step - 1))))
    checked = F.transform(places, lambda s: F.struct(
        (F.size(F.array_intersect("texts", shingles(F.col("words"), s, size))) / F.size("texts")).alias("containment"),
        (-s).alias("before")))
    best = met.where("size(met) > 0").select("doc_id", "license", F.array_max(checked).alias("best"))
    return best.where(F.col("best.containment") >= containment).select(
        "doc_id", "license", F.col("best.containment").alias("containment"),
        (-F.col("best.before")).alias("word_at"),
    )
