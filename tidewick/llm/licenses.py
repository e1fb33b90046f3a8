"""Licences of files: TF-IDF cosine of headers to templates, then the nearest licensed directory.

A file's licence text is all of it if it is a licence file by name, else the lines that speak of a
licence. Its terms are weighted by frequency and rarity among all licence texts, and compared with the
templates through a join on the templates' terms; a term that no template has only adds to the length.
Directories take the licence of the licence files in them; a file without a licence of its own takes that
of the nearest directory above it. Ancestors are found for directories, not for files, so a directory
with very many files costs one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewick.llm.common import kept

#: What a licence line holds, in any case.
LINE = "(?i)licen[sc]|copyright|all rights reserved|spdx-|public domain"
TERM = "[a-z0-9]+(?:[.+-][a-z0-9]+)*"
FILE_NAME = "(?i)(^|/)(licen[sc]e|copying|notice|unlicense)[^/]*$"
LEAST = 0.6

#: Licence and notice; a licence may have several. Fixed values.
TEMPLATES = (
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, all rights are waived under CC0 1.0; public domain."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Released under the ISC License."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software to deal in "
            "the software without restriction, under the MIT License."),
    ("MPL-2.0", "This work is subject to the terms of the Mozilla Public License, version 2.0."),
    ("Proprietary", "Copyright. All rights reserved."))


def templates(spark: SparkSession, rows=TEMPLATES) -> DataFrame:
    """(template, licence, text), numbered in the given order."""
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "template int, licence string, text string")


def licence_text(path: Column, text: Column) -> Column:
    """The whole text of a licence file, the licence lines of another; null if there are none."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(LINE))
    found = F.when(F.coalesce(path.rlike(FILE_NAME), F.lit(False)), text).when(text.rlike(LINE), F.array_join(lines, " "))
    return found


def _terms(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, n) of every text."""
    word = F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit(TERM), F.lit(0))).alias("term")
    return df.select(key, word).groupBy(key, "term").agg(F.count(F.lit(1)).alias("n"))


def matches(texts: DataFrame, known: DataFrame, least: float = LEAST) -> DataFrame:
    """(file, licence, cosine) of the best template for each (file, text) whose cosine is ``least`` or more.

    Rarity of a term is ln((1 + N) / (1 + df)) + 1 over the N texts; ties go to the earlier template.
    Rows of one file must agree in text.
    """
    texts = kept(texts.select("file", "text").dropDuplicates(["file"]), "licence-texts")
    total = F.lit(float(texts.count()))
    terms = kept(_terms(texts, "file", "text"), "licence-terms")
    # Written, so that the planner knows their size: the templates' terms are few.
    df = kept(terms.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "licence-rarity")
    rarity = F.log((total + 1.0) / (F.coalesce("df", F.lit(0)) + 1.0)) + 1.0
    weighted = terms.join(df, "term").select("file", "term", (F.col("n") * rarity).alias("w"))
    length = weighted.groupBy("file").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    own = kept(_terms(known, "template", "text").join(df, "term", "left").select(
        "template", "term", (F.col("n") * rarity).alias("v")), "licence-templates")
    norm = own.groupBy("template").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"))
    dots = weighted.join(own, "term").groupBy("file", "template").agg(F.sum(F.col("w") * F.col("v")).alias("dot"))
    scored = dots.join(length, "file").join(norm, "template").select(
        "file", "template", F.round(F.col("dot") / (F.col("length") * F.col("norm")), 9).alias("cosine"))
    best = F.max(F.struct("cosine", (-F.col("template")).alias("template"))).alias("best")
    best = scored.filter(F.col("cosine") >= least).groupBy("file").agg(best).select(
        "file", (-F.col("best.template")).alias("template"), "best.cosine")
    return best.join(known.select("template", "licence"), "template").select("file", "licence", "cosine")


def _parent(path: Column) -> Column:
    """The directory of a path; '' is the top, and the top has none (null)."""
    return F.when(path == "", F.lit(None)).otherwise(F.regexp_replace(path, "(^|/)[^/]*$", ""))


def scan(files: DataFrame, known: DataFrame, least: float = LEAST) -> DataFrame:
    """``files`` (file, path, text, speaks) with licence, cosine, and the directory it was inherited from.

    Files that speak for their directory, by name or where ``speaks`` is true, give it their licence; of
    several licences the one of most files counts, then the first by name. ``origin`` is 'own',
    'inherited' or 'none'. ``file`` is a number; rows without one, or that share one, are told apart by their
    licence texts; repeated rows give repeated results. A null text has no licence of its own; a null path has no directory. An empty table
    gives no rows; other columns are ignored.
    """
    speaks = F.coalesce(F.col("path").rlike(FILE_NAME), F.lit(False)) | F.coalesce("speaks", F.lit(False))
    own = licence_text(F.col("path"), F.col("text"))
    files = files.select("file", "path", speaks.alias("speaks"), own.alias("text"), F.xxhash64("file", F.col("file").isNull(), own).alias("_id"))
    files = kept(files, "licence-lines")  # few lines of each text; the texts are read once
    found = matches(files.filter("text IS NOT NULL").select(F.col("_id").alias("file"), "text"), known, least)
    found = found.withColumnRenamed("file", "_id")
    rows = files.select("file", "path", "speaks", "_id").join(found, "_id", "left").withColumn("directory", _parent(F.col("path")))
    votes = rows.filter("speaks AND licence IS NOT NULL AND directory IS NOT NULL").groupBy(
        "directory", "licence").agg(F.count(F.lit(1)).alias("n"))
    licensed = votes.groupBy("directory").agg(F.min(F.struct((-F.col("n")).alias("n"), "licence")).alias("v")).select(
        F.col("directory").alias("above"), F.col("v.licence").alias("of_directory"))
    parts = F.split("directory", "/")
    depth = F.when(F.col("directory") == "", F.lit(0)).otherwise(F.size(parts))
    levels = F.explode(F.sequence(F.lit(0), depth)).alias("depth")
    above = rows.select("directory").filter("directory IS NOT NULL").distinct().select("directory", parts.alias("p"), levels)
    above = above.select("directory", "depth", F.array_join(F.slice("p", F.lit(1), F.col("depth")), "/").alias("above"))
    nearest = above.join(licensed, "above").groupBy("directory").agg(
        F.max(F.struct("depth", "above", "of_directory")).alias("d")).select("directory", "d.above", "d.of_directory")
    out = rows.join(nearest, "directory", "left")
    return out.select(
        "file", "path", F.coalesce("licence", "of_directory").alias("licence"), "cosine",
        F.when(F.col("licence").isNull(), F.col("above")).alias("inherited_from"),
        F.when(F.col("licence").isNotNull(), "own").when(F.col("of_directory").isNotNull(), "inherited")
        .otherwise("none").alias("origin"))
