"""Licence scan: sparse TF-IDF cosine to notice templates, then inheritance from
the nearest ancestor directory; DataFrame functions only."""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import if_small, read_table, staged

#: Least cosine of a notice with a template.
THRESHOLD = 0.7
#: Base names of files that license their directory.
LICENSE_FILE = r"(?i)^(un)?licen[sc]e|^copying|^notice"

# Usual notices and SPDX lines.
TEMPLATES = (
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "SPDX-License-Identifier: AGPL-3.0-or-later"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-2-Clause", "Released under the 2-clause BSD License."),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "Released under the 3-clause BSD License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "You can redistribute it and/or modify it under the terms of the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("ISC", "Released under the ISC License."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, version 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
_TERM = "[a-z0-9]+"


def terms(text: Column) -> Column:
    """Lower-case ASCII words and numbers; none for null."""
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit(_TERM), F.lit(0)), F.array().cast("array<string>"))


def term_idf(texts: DataFrame, vocabulary: list[str]) -> tuple[dict[str, float], int]:
    """(idf of each of ``vocabulary``, number of texts), counted over all rows of
    ``texts`` (text)."""
    known = F.array(*[F.lit(t) for t in vocabulary])
    counts = {r["t"]: r["count"] for r in texts.select(F.explode(F.array_intersect(terms(F.col("text")), known)).alias("t"))
              .groupBy("t").count().collect()}  # at most len(vocabulary) rows
    n = texts.count()
    return {t: math.log((n + 1) / (counts.get(t, 0) + 1)) + 1 for t in vocabulary}, n


def other_idf(texts: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(term, idf) of the terms ``wanted`` (term), counted over all ``n`` rows of ``texts`` (text)."""
    held = texts.select(F.explode(F.array_distinct(terms(F.col("text")))).alias("term"))
    return (held.join(if_small(wanted), "term", "left_semi").groupBy("term").count()
            .select("term", (F.log(F.lit(float(n + 1)) / (F.col("count") + 1)) + 1).alias("idf")))


def anchor_terms(weights: list[dict[str, float]], threshold: float) -> list[str]:
    """Terms one of which every text within ``threshold`` of a template holds: of
    each template the heaviest ones, until the rest alone can't reach it."""
    out = set()
    for w in weights:
        rest = sum(x * x for x in w.values())
        limit = threshold * threshold * rest
        for t, x in sorted(w.items(), key=lambda tx: (-tx[1], tx[0])):
            if rest < limit:
                break
            out.add(t)
            rest -= x * x
    return sorted(out)


def notice_scores(files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(key, license, score) of the best template within ``threshold`` of any line,
    paragraph or whole text of ``files`` (key, text); ties go to the first name."""
    spark = files.sparkSession
    counts = [Counter(re.findall(_TERM, t.lower())) for _, t in templates]
    vocabulary = sorted(set().union(*counts))
    idf, n = term_idf(files, vocabulary)
    weights = [{t: k * idf[t] for t, k in c.items()} for c in counts]
    anchors = anchor_terms(weights, threshold)
    # Both tables are bounded by the templates.
    vectors = F.broadcast(spark.createDataFrame(
        [(i, templates[i][0], t, x / math.sqrt(sum(y * y for y in w.values()))) for i, w in enumerate(weights) for t, x in w.items()],
        "template int, license string, term string, weight double"))
    known = F.broadcast(spark.createDataFrame(list(idf.items()), "term string, idf double"))

    low = F.lower("text")
    holds = F.lit(False)
    for t in anchors:
        holds = holds | low.contains(t)
    pieces = F.array_distinct(F.concat(F.split("text", "\n"), F.split("text", r"\n\s*\n"), F.array("text")))
    units = (files.where(holds).select("key", F.posexplode(pieces).alias("unit", "piece"))
             .select("key", "unit", terms(F.col("piece")).alias("terms"))
             .where(F.arrays_overlap("terms", F.array(*[F.lit(t) for t in anchors]))))
    counted = staged(units.select("key", "unit", F.explode("terms").alias("term")).groupBy("key", "unit", "term").count())
    others = staged(counted.select("term").distinct().join(known, "term", "left_anti"))
    every = staged(known.unionByName(other_idf(files.select("text"), others, n)))
    weighed = staged(counted.join(if_small(every), "term").select("key", "unit", "term", (F.col("count") * F.col("idf")).alias("w")))
    norms = weighed.groupBy("key", "unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = (weighed.join(vectors, "term").groupBy("key", "unit", "template", "license")
            .agg(F.sum(F.col("w") * F.col("weight")).alias("dot")))
    score = F.floor(F.col("dot") / F.col("norm") * 1e6 + 0.5) / 1e6
    return (dots.join(norms, ["key", "unit"]).withColumn("score", score).where(F.col("score") >= threshold)
            .groupBy("key").agg(F.min(F.struct((-F.col("score")).alias("less"), "license")).alias("best"))
            .select("key", "best.license", (-F.col("best.less")).alias("score")))


def _directory(path: Column) -> Column:
    return F.when(path.contains("/"), F.regexp_extract(path, "^(.*)/[^/]*$", 1)).otherwise(F.lit(""))


def scan(files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(id, path, license, score, origin, origin_path) for every row of ``files``
    (id, path, text).

    A file's own notice comes first (origin ``header``, or ``file`` for a licence
    file); without one it inherits from the licence files of the nearest ancestor
    directory, its own included (origin ``directory``; the best score there, then
    the first name and path); else license is null and origin ``none``.  Null or
    empty texts have no notice; a null path inherits nothing; repeated rows stay.
    """
    rows = files.select("id", "path", "text", F.xxhash64("path", "text").alias("key"))
    own = staged(notice_scores(rows.where("text is not null").select("key", "text"), templates, threshold))
    slim = rows.select("id", "path", "key")
    is_license = F.coalesce(F.regexp_extract("path", "([^/]*)$", 1).rlike(LICENSE_FILE), F.lit(False))
    found = staged(slim.join(own, "key", "left").withColumn("is_license", is_license).withColumn("dir", _directory(F.col("path"))))

    holders = staged(found.where("is_license and license is not null").groupBy(F.col("dir").alias("holder"))
                     .agg(F.min(F.struct((-F.col("score")).alias("less"), "license", "path")).alias("best")))
    parts = F.split("dir", "/")
    up = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.struct(
        i.alias("depth"), F.array_join(F.slice(parts, 1, i), "/").alias("holder")))
    near = (found.select("dir").where("dir is not null").distinct().select("dir", F.explode(up).alias("up")).select("dir", "up.*").distinct()
            .join(if_small(holders), "holder").groupBy("dir")
            .agg(F.max(F.struct("depth", "best")).alias("top"))
            .select("dir", F.col("top.best.license").alias("dir_license"), (-F.col("top.best.less")).alias("dir_score"),
                    F.col("top.best.path").alias("dir_path")))
    has = F.col("license").isNotNull()
    return (found.join(if_small(staged(near)), "dir", "left").select(
        "id", "path", F.coalesce("license", "dir_license").alias("license"),
        F.when(has, F.col("score")).otherwise(F.col("dir_score")).alias("score"),
        F.when(has & F.col("is_license"), "file").when(has, "header").when(F.col("dir_license").isNotNull(), "directory")
        .otherwise("none").alias("origin"),
        F.when(has, F.col("path")).otherwise(F.col("dir_path")).alias("origin_path")))


def document_paths(docs: DataFrame) -> DataFrame:
    """``docs`` laid out as files, for they have no paths: eight directories for
    each source; every tenth document is a licence file of its directory, every
    hundredth one of its source."""
    source, i = F.coalesce("source", F.lit("unknown")), F.col("doc_id")
    path = (F.when(i % 100 == 0, F.concat(source, F.lit("/LICENSE-"), i))
            .when(i % 10 == 0, F.concat(source, F.lit("/"), i % 8, F.lit("/LICENSE-"), i))
            .otherwise(F.concat(source, F.lit("/"), i % 8, F.lit("/"), i, F.lit(".txt"))))
    return docs.select(i.alias("id"), path.alias("path"), "text")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(document_paths(read_table(spark, sf_dir, "documents"))).withColumnRenamed("id", "doc_id")


def _sql() -> str:
    values = ",\n".join("({}, '{}', '{}')".format(i, name, text.replace("'", "''")) for i, (name, text) in enumerate(TEMPLATES))
    return rf"""
WITH templates(template, license, text) AS (VALUES {values}),
f AS (SELECT doc_id, text, CASE WHEN doc_id % 100 = 0 THEN coalesce(source, 'unknown') || '/LICENSE-' || doc_id
                          WHEN doc_id % 10 = 0 THEN coalesce(source, 'unknown') || '/' || (doc_id % 8) || '/LICENSE-' || doc_id
                          ELSE coalesce(source, 'unknown') || '/' || (doc_id % 8) || '/' || doc_id || '.txt' END AS path
      FROM documents),
tt AS (SELECT template, license, term, count(*) AS tf FROM (SELECT template, license, unnest(regexp_extract_all(lower(text), '{_TERM}')) AS term
       FROM templates) GROUP BY ALL),
vocab AS (SELECT DISTINCT term FROM tt),
n AS (SELECT count(*) AS n FROM documents WHERE text IS NOT NULL),
df AS (SELECT term, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{_TERM}')) AS term FROM documents)
       GROUP BY term),
idf AS (SELECT term, ln((n + 1) / (coalesce(df, 0) + 1)) + 1 AS idf FROM vocab FULL JOIN df USING (term), n),
vec AS (SELECT template, license, term, tf * idf AS w, sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY template)) AS norm
        FROM tt JOIN idf USING (term)),
u AS (SELECT DISTINCT doc_id, piece FROM (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS piece FROM f UNION ALL
        SELECT doc_id, unnest(regexp_split_to_array(text, '\n\s*\n')) FROM f UNION ALL SELECT doc_id, text FROM f) WHERE piece IS NOT NULL),
ut AS (SELECT doc_id, piece, term, count(*) AS tf FROM (SELECT doc_id, piece, unnest(regexp_extract_all(lower(piece), '{_TERM}')) AS term FROM u)
       GROUP BY ALL),
uw AS (SELECT doc_id, piece, term, tf * idf AS w FROM ut JOIN idf USING (term)),
un AS (SELECT doc_id, piece, sqrt(sum(w * w)) AS norm FROM uw GROUP BY ALL),
dots AS (SELECT doc_id, piece, template, license, sum(uw.w * vec.w / vec.norm) AS dot FROM uw JOIN vec USING (term) GROUP BY ALL),
sc AS (SELECT doc_id, license, floor(dot / norm * 1e6 + 0.5) / 1e6 AS score FROM dots JOIN un USING (doc_id, piece)),
own AS (SELECT doc_id, license, score FROM sc WHERE score >= {THRESHOLD}
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, license) = 1),
found AS (SELECT f.doc_id, path, license, score, regexp_matches(regexp_extract(path, '([^/]*)$', 1), '{LICENSE_FILE}') AS is_license,
                 regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir FROM f LEFT JOIN own USING (doc_id)),
holders AS (SELECT dir AS holder, license, score, path FROM found WHERE is_license AND license IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, license, path) = 1),
near AS (SELECT d.dir, h.license AS dir_license, h.score AS dir_score, h.path AS dir_path
         FROM (SELECT DISTINCT dir FROM found) d JOIN holders h ON h.holder = '' OR d.dir = h.holder OR starts_with(d.dir, h.holder || '/')
         QUALIFY row_number() OVER (PARTITION BY d.dir ORDER BY length(h.holder) DESC) = 1)
SELECT doc_id, path, coalesce(license, dir_license) AS license, CASE WHEN license IS NOT NULL THEN score ELSE dir_score END AS score,
       CASE WHEN license IS NOT NULL AND is_license THEN 'file' WHEN license IS NOT NULL THEN 'header'
            WHEN dir_license IS NOT NULL THEN 'directory' ELSE 'none' END AS origin,
       CASE WHEN license IS NOT NULL THEN path ELSE dir_path END AS origin_path
FROM found LEFT JOIN near USING (dir)
"""


OP2_SQL = _sql()
