"""Licence notices by sparse TF-IDF cosine, inherited from the nearest directory.

Only DataFrame functions; the templates are a fixed small table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labmart.llm.common import Work, read

#: Licence and the wording of a notice of it.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "Released under the CC0 1.0 public domain dedication license"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, under the MIT license"),
    ("MPL-2.0", "Subject to the terms of the Mozilla Public License, version 2.0"),
]
THRESHOLD = 0.75
#: A line is a notice only if it has one of these; each template has.
TRIGGER = r"(?i)licen[cs]e|CC[ -]BY|CC0"
TERM = r"([a-z0-9]+(?:[.-][a-z0-9]+)*)"
#: Names of files that hold the licence of their directory.
LICENCE_FILE = r"(?i)(^|/)(LICEN[CS]E|COPYING)[^/]*$"


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(1))


def _weights(spark: SparkSession) -> tuple[DataFrame, DataFrame, float]:
    """(template, license, term, weight over the template's norm), (term, idf), idf of other terms."""
    known = [
        F.struct(F.lit(i).alias("template"), F.lit(name).alias("license"), F.lit(notice).alias("notice"))
        for i, (name, notice) in enumerate(TEMPLATES)
    ]
    rows = spark.range(1).select(F.inline(F.array(*known)))
    terms = rows.select("template", "license", F.explode(_terms(F.col("notice"))).alias("term"))
    counts = terms.groupBy("template", "license", "term").agg(F.count("*").alias("tf"))
    n = len(TEMPLATES)
    idf = counts.groupBy("term").agg((F.log((1.0 + n) / (1 + F.count("*"))) + 1).alias("idf"))
    weighted = counts.join(idf, "term").withColumn("w", F.col("tf") * F.col("idf"))
    norms = weighted.groupBy("template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    scaled = weighted.join(norms, "template").select(
        "template", "license", "term", (F.col("w") / F.col("norm")).alias("share")
    )
    return scaled, idf, F.log(F.lit(1.0 + n)) + 1


def _recognised(units: DataFrame, threshold: float, work: Work) -> DataFrame:
    """(unit_key, license, similarity) of the distinct units like a template."""
    spark = units.sparkSession
    share, idf, other = _weights(spark)
    # Both tables hold a few rows for each of the fixed templates.
    share, idf = F.broadcast(share), F.broadcast(idf)
    terms = (
        units.groupBy("unit_key").agg(F.any_value("unit").alias("unit"))
        .select("unit_key", F.explode(_terms(F.col("unit"))).alias("term"))
        .groupBy("unit_key", "term").agg(F.count("*").alias("tf"))
        .join(idf, "term", "left")
        .select("unit_key", "term", (F.col("tf") * F.coalesce("idf", other)).alias("w"))
    )
    terms = work.keep(terms, "terms")
    norms = terms.groupBy("unit_key").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = (
        terms.join(share, "term").groupBy("unit_key", "template", "license")
        .agg(F.sum(F.col("w") * F.col("share")).alias("dot"))
    )
    scored = dots.join(norms, "unit_key").select(
        "unit_key", "template", "license", F.round(F.col("dot") / F.col("norm"), 6).alias("similarity")
    )
    best = scored.where(F.col("similarity") >= threshold).groupBy("unit_key").agg(
        F.max(F.struct("similarity", -F.col("template"), "license")).alias("best")
    )
    return best.select("unit_key", "best.license", "best.similarity")


def scan_licenses(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """path, license, origin, similarity and license_path of each distinct path.

    ``files`` has ``path`` and ``text``. Compared with the templates are all
    lines with a licence word, and the whole text of licence files. origin:
    ``notice`` (its own text), ``inherited`` (the licence file of the nearest
    directory above, named by license_path) or null. Of several notices the
    most similar counts, then the first template. Null and empty texts have no
    notice; rows without path are left out as nothing can name them; rows of
    one path count together; an empty table gives no rows; other columns are
    ignored. Distinct texts are scored once, and distinct directories looked up
    once, however many files share them.
    """
    work = Work(files.sparkSession, "licenses")
    files = files.select("path", "text").where("path IS NOT NULL")
    named = F.col("path").rlike(LICENCE_FILE)
    lines = files.where(F.col("text").rlike(TRIGGER)).select(
        "path",
        F.explode(
            F.concat(
                F.filter(F.split("text", "\n"), lambda x: x.rlike(TRIGGER)),
                F.when(named, F.array("text")).otherwise(F.array().cast("array<string>")),
            )
        ).alias("unit"),
    )
    units = work.keep(lines.select("path", "unit", F.sha2("unit", 256).alias("unit_key")), "units")
    known = work.keep(_recognised(units.select("unit_key", "unit"), threshold, work), "known")
    own = work.keep(
        units.select("path", "unit_key").join(known, "unit_key").groupBy("path").agg(
            F.max(F.struct("similarity", "license")).alias("own")
        ),
        "own",
    )
    folder = F.regexp_replace("path", r"/?[^/]*$", "")
    paths = work.keep(
        files.select("path").distinct().join(own, "path", "left")
        .select("path", folder.alias("folder"), named.alias("named"), "own"),
        "paths",
    )
    holders = (
        paths.where("named AND own IS NOT NULL").groupBy(F.col("folder").alias("above"))
        .agg(F.max(F.struct("own.similarity", "own.license", "path")).alias("holder"))
    )
    parts = F.split("folder", "/")
    above = F.transform(
        F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")
    )
    inherited = work.keep(
        paths.select("folder").distinct().select("folder", F.explode(above).alias("above"))
        .join(work.keep(holders, "holders"), "above")
        .groupBy("folder").agg(F.max_by("holder", F.length("above")).alias("holder")),
        "inherited",
    )
    return paths.join(inherited, "folder", "left").select(
        "path",
        F.coalesce("own.license", "holder.license").alias("license"),
        F.when(F.col("own").isNotNull(), "notice")
        .when(F.col("holder").isNotNull(), "inherited").alias("origin"),
        F.coalesce("own.similarity", "holder.similarity").alias("similarity"),
        F.when(F.col("own").isNull(), F.col("holder.path")).alias("license_path"),
    )


def document_files(docs: DataFrame) -> DataFrame:
    """Documents as files: folders of 500 and 25 ids below their source, the first of 25 named LICENSE."""
    name = F.when(F.col("doc_id") % 25 == 0, "LICENSE").otherwise(
        F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    )
    folder = lambda n: F.floor(F.col("doc_id") / n).cast("string")
    path = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), folder(500), folder(25), name)
    return docs.select("doc_id", path.alias("path"), "text")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and the scan of the file made of it, for every document."""
    files = document_files(read(spark, sf_dir, "documents"))
    return files.select("doc_id", "path").join(scan_licenses(files), "path")


def _values() -> str:
    return ", ".join(f"({i}, '{a}', '{b}')" for i, (a, b) in enumerate(TEMPLATES))


OP9_SQL = f"""
WITH templates(template, license, notice) AS (VALUES {_values()}),
template_terms AS (
  SELECT template, license, term, count(*) AS tf
  FROM (SELECT template, license, unnest(regexp_extract_all(lower(notice), '{TERM}', 1)) AS term FROM templates)
  GROUP BY ALL),
idf AS (SELECT term, ln({1.0 + len(TEMPLATES)} / (1 + count(*))) + 1 AS idf FROM template_terms GROUP BY term),
weighted AS (SELECT template, license, term, tf * idf AS w FROM template_terms JOIN idf USING (term)),
norms AS (SELECT template, sqrt(sum(w * w)) AS norm FROM weighted GROUP BY template),
shares AS (SELECT template, license, term, w / norm AS share FROM weighted JOIN norms USING (template)),
files AS (
  SELECT doc_id, text, concat_ws('/', coalesce(source, 'unknown'), CAST(doc_id // 500 AS VARCHAR),
    CAST(doc_id // 25 AS VARCHAR),
    CASE WHEN doc_id % 25 = 0 THEN 'LICENSE' ELSE CAST(doc_id AS VARCHAR) || '.txt' END) AS path
  FROM documents),
lines AS (
  SELECT path, unnest(string_split(text, chr(10))) AS unit FROM files
  WHERE regexp_matches(text, '{TRIGGER}')),
units AS (
  SELECT path, unit FROM lines WHERE regexp_matches(unit, '{TRIGGER}')
  UNION ALL
  SELECT path, text FROM files WHERE regexp_matches(path, '{LICENCE_FILE}') AND regexp_matches(text, '{TRIGGER}')),
terms AS (
  SELECT unit, term, count(*) * coalesce(any_value(idf.idf), ln({1.0 + len(TEMPLATES)}) + 1) AS w
  FROM (SELECT unit, unnest(regexp_extract_all(lower(unit), '{TERM}', 1)) AS term
        FROM (SELECT DISTINCT unit FROM units)) LEFT JOIN idf USING (term)
  GROUP BY unit, term),
unit_norms AS (SELECT unit, sqrt(sum(w * w)) AS norm FROM terms GROUP BY unit),
scored AS (
  SELECT unit, template, license, round(sum(w * share) / any_value(norm), 6) AS similarity
  FROM terms JOIN shares USING (term) JOIN unit_norms USING (unit) GROUP BY unit, template, license),
known AS (
  SELECT unit, license, similarity FROM scored WHERE similarity >= {THRESHOLD}
  QUALIFY row_number() OVER (PARTITION BY unit ORDER BY similarity DESC, template) = 1),
own AS (
  SELECT path, license, similarity FROM units JOIN known USING (unit)
  QUALIFY row_number() OVER (PARTITION BY path ORDER BY similarity DESC, license DESC) = 1),
paths AS (
  SELECT DISTINCT path, regexp_replace(path, '/?[^/]*$', '') AS folder, own.license, own.similarity
  FROM files LEFT JOIN own USING (path)),
holders AS (
  SELECT folder AS above, path AS holder, license, similarity FROM paths
  WHERE regexp_matches(path, '{LICENCE_FILE}') AND license IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY folder ORDER BY similarity DESC, license DESC, path DESC) = 1),
inherited AS (
  SELECT f.folder, h.holder, h.license, h.similarity
  FROM (SELECT DISTINCT folder FROM paths) f JOIN holders h
    ON f.folder = h.above OR starts_with(f.folder, h.above || '/') OR h.above = ''
  QUALIFY row_number() OVER (PARTITION BY f.folder ORDER BY length(h.above) DESC) = 1)
SELECT files.doc_id, files.path, coalesce(p.license, i.license) AS license,
  CASE WHEN p.license IS NOT NULL THEN 'notice' WHEN i.license IS NOT NULL THEN 'inherited' END AS origin,
  coalesce(p.similarity, i.similarity) AS similarity,
  CASE WHEN p.license IS NULL THEN i.holder END AS license_path
FROM files JOIN paths p USING (path) LEFT JOIN inherited i ON i.folder = p.folder
"""
