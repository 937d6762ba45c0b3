"""Licence scans in DataFrame functions only.

Vectors of sparse TF-IDF weights are compared with templates by their cosine: those of
each line, each paragraph, each run of comment lines (a header is one, wherever it
stands), and of the whole text of each licence file.  Terms are exploded, weighted by the
number of files that have them, and joined to the templates' terms.  A licence that has
versions is told only by a term of its version; without one the family is told.  A file without a licence of its own inherits that of the nearest directory
above that has a licence file; ancestors are found by joining paths, once for each
directory and not for each file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved
from .licence_blocks import HEADERS, bodies

# Short notices by which files name their licence.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-2.0", "This program is free software; you can redistribute it under the terms of the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1"),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted, BSD 3-Clause License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-4.0", "Licensed under the Creative Commons Attribution 4.0 International License, CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
]
# For licences of a family the terms of which one must be there, else only the family is told (or nothing).
TELLING = {
    "Apache-2.0": ("Apache", ("2",)), "GPL-2.0": ("GPL", ("2",)), "GPL-3.0": ("GPL", ("3",)), "LGPL-2.1": ("LGPL", ("1",)), "LGPL-3.0": ("LGPL", ("3",)), "AGPL-3.0": ("AGPL", ("3",)), "MPL-2.0": ("MPL", ("2",)), "EPL-2.0": ("EPL", ("2",)),
    "BSD-3-Clause": ("BSD", ("neither", "endorse", "3")), "CC-BY-4.0": ("CC-BY", ("4",)), "CC-BY-SA-4.0": ("CC-BY", ("sa", "sharealike")), "CC-BY-NC-4.0": ("CC-BY", ("nc", "noncommercial")), "ISC": (None, ("appear", "isc")), "BSL-1.0": (None, ("boost", "bsl", "reproduce")),
}
#: Of a piece's words, repeats included, so many must be the template's: a mention in a sentence is no notice.
COVERED = 0.6
#: Names of licence files.
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice|unlicense)([.\-_].*)?$"
THRESHOLD = 0.6


def terms(text: Column) -> Column:
    """Lower-case runs of a-z and 0-9."""
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def templates_table() -> list[tuple[int, str, str, bool]]:
    """(template, license, notice, whole): whole licence texts are compared with licence files only."""
    short = [*TEMPLATES, *HEADERS]
    short += [(k, f"SPDX-License-Identifier: {k}") for k in sorted({k for k, _ in short})]
    return [(i, k, t, i >= len(short)) for i, (k, t) in enumerate([*short, *bodies()])]


_MARK, _PLAIN, _OPEN, _CLOSE = "(?:#|//|--|;|%|[*])", "[^ \\t\\n#/;%*-]", "(?:/[*]|\"\"\"|'''|<!--)", "(?:[*]/|-->)"
#: What makes runs of a text (in front of which a line end was put): patterns and what stands for them, CUT between runs.
CUT = "\x01"
CUTS = [
    ("\r", ""),
    ("\\n(?:#![^\\n]*|<[?]php[^\\n]*|[ \\t]*#[^\\n]*coding[:=][^\\n]*)", ""),
    ("\\n[ \\t#/*;%-]*(?i:copyright)[ \\t]*(?:[(](?i:c)[)]|©|[0-9])[^\\n]*", "\n"),
    (f"(\\n[ \\t]*{_PLAIN}[^\\n]*)(\\n[ \\t\\n]*{_MARK})", "{1}" + CUT + "{2}"),
    (f"(\\n[ \\t]*{_MARK}[^\\n]*)(\\n[ \\t\\n]*{_PLAIN})", "{1}" + CUT + "{2}"),
    (f"(\\n[ \\t]*{_OPEN})", CUT + "{1}"),
    (f"({_CLOSE}[ \\t]*\\n)", "{1}" + CUT),
]
#: Where a paragraph of a run ends, and how a run of comments begins.
PARAGRAPH = f"{CUT}|\\n[ \\t]*(?:#+|//+|[*]+|;+|%+|--+)?[ \\t]*\\n"
COMMENT = f"^[ \\t\\n]*(?:{_MARK}|{_OPEN})"


def runs(text: Column) -> Column:
    """The text with CUT between its runs of comment lines, block comments and other lines; shebangs and copyright lines are gone."""
    out = F.concat(F.lit("\n"), text)
    for pattern, by in CUTS:
        out = F.regexp_replace(out, pattern, by.format("", "$1", "$2"))
    return out


def document_frequencies(files: DataFrame) -> DataFrame:
    """(term, df) of every term of the files (path, text)."""
    return files.select(F.explode(F.array_distinct(terms(F.col("text")))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))


def _needed(rows: list, threshold: float) -> list[str]:
    """Terms of which a text has one at least if its cosine to a template reaches the threshold.

    The cosine is at most the length of the template's unit vector over shared terms.  So
    of each template the commonest terms may be left out while their squares sum to less
    than the threshold's.
    """
    found, by = set(), {}
    for r in rows:
        by.setdefault(r.template, []).append(r)
    for of in by.values():
        left = threshold * threshold - 1e-9
        for r in sorted(of, key=lambda r: (-r.df, r.term)):
            left -= r.w * r.w
            if left < 0:
                found.add(r.term)
    return sorted(found)


def declared(files: DataFrame, *, threshold: float = THRESHOLD) -> DataFrame:
    """(path, declared, score) by pieces of all files, every term weighted by its files.

    The pieces are each line, each paragraph and each run of comments of more than a line,
    and the whole text of each licence file.  Whole licence texts are templates for the
    last only.  No piece that reaches the threshold is left out.  Of equal scores a licence
    goes before a family, then the alphabet decides.
    """
    spark = files.sparkSession
    n = files.count()
    df = saved(document_frequencies(files), "df")
    idf = F.log((F.lit(1.0) + n) / (1 + F.coalesce("df", F.lit(0)))) + 1
    # Bounded by the templates.
    rows = spark.createDataFrame(templates_table(), "template int, license string, notice string, whole boolean")
    counted = rows.select("template", "license", "whole", F.explode(terms(F.col("notice"))).alias("term")).groupBy("template", "license", "whole", "term").agg(F.count("*").alias("tf"))
    known = df.join(F.broadcast(counted.select("term").distinct()), "term")
    weights = counted.join(F.broadcast(known), "term", "left").select("template", "license", "whole", "term", F.coalesce("df", F.lit(0)).alias("df"), (F.col("tf") * idf).alias("weight"))
    norms = weights.groupBy("template").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    telling = spark.createDataFrame([(k, t, True) for k, (_, ts) in TELLING.items() for t in ts], "license string, term string, tells boolean")
    families = spark.createDataFrame([(k, family) for k, (family, _) in TELLING.items()], "license string, family string")
    weighed = weights.join(F.broadcast(norms), "template").join(F.broadcast(telling), ["license", "term"], "left").join(F.broadcast(families.withColumn("needs", F.lit(True))), "license", "left")
    templates = saved(weighed.select("template", "license", "whole", "term", "df", (F.col("weight") / F.col("norm")).alias("w"), F.coalesce("tells", ~F.coalesce("needs", F.lit(False))).alias("tells"), "family"), "templates")
    needed = F.array(*[F.lit(w) for w in _needed(templates.where("not whole").collect(), threshold)])

    named = files.where("path is not null").select("path", "text", F.xxhash64("text").alias("h"), F.element_at(F.split("path", "/"), -1).rlike(LICENCE_FILE).alias("whole"))
    likely = named.where(F.arrays_overlap(terms(F.col("text")), needed))
    lines = likely.select("path", "h", F.posexplode(F.split("text", "\n")).alias("part", "piece"))
    cut = likely.select("path", "h", runs(F.col("text")).alias("cut"))
    longer = F.trim(F.col("piece"), F.lit(" \t\n")).contains("\n")
    paragraphs = cut.select("path", "h", F.posexplode(F.split("cut", PARAGRAPH)).alias("part", "piece")).where(longer)
    comments = cut.select("path", "h", F.posexplode(F.split("cut", CUT)).alias("part", "piece")).where(longer & F.col("piece").rlike(COMMENT))
    pieces = lines.unionByName(paragraphs.withColumn("part", -10 - 2 * F.col("part"))).unionByName(comments.withColumn("part", -11 - 2 * F.col("part")))
    pieces = pieces.select("path", "h", "part", terms(F.col("piece")).alias("words")).where(F.arrays_overlap("words", needed))
    body = named.where("whole").select("path", "h", F.lit(-2).alias("part"), terms(F.col("text")).alias("words"))
    vector = ["path", "h", "part"]
    counts = saved(pieces.unionByName(body).select(*vector, F.explode("words").alias("term")).groupBy(*vector, "term").agg(F.count("*").alias("tf")), "term-counts")
    weighted = saved(counts.join(df, "term", "left").select(*vector, "term", "tf", (F.col("tf") * idf).alias("weight")), "line-terms")
    length = weighted.groupBy(*vector).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"), F.sum("tf").alias("words"))
    pairs = weighted.join(F.broadcast(templates.drop("df")), "term").where(~F.col("whole") | (F.col("part") == -2))
    dots = pairs.groupBy(*vector, "template", "license", "family").agg(F.sum(F.col("weight") * F.col("w")).alias("dot"), F.sum("tf").alias("shared"), F.max("tells").alias("told"))
    scores = dots.join(length, vector).where(F.col("shared") >= COVERED * F.col("words")).select("path", F.when(F.col("told"), F.col("license")).otherwise(F.col("family")).alias("license"), F.col("told"), F.round(F.col("dot") / F.col("norm"), 6).alias("score")).where((F.col("score") >= threshold) & F.col("license").isNotNull())
    best = scores.groupBy("path", "license", "told").agg(F.max("score").alias("score")).groupBy("path").agg(F.min(F.struct((-F.col("score")).alias("minus"), (~F.col("told")).alias("vague"), F.col("license"))).alias("b"))
    return best.select("path", F.col("b.license").alias("declared"), (-F.col("b.minus")).alias("score"))


def scan(files: DataFrame, *, path: str = "path", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(path, declared, score, license, inherited_from) of every file.

    path is `dir/dir/name`; a file of the name `LICENSE`, `COPYING` and the like speaks
    for its directory and all below that have none nearer.  Of several in a directory
    the highest score wins, then the smallest name.  Equal scores go to the licence
    first in the alphabet.  A null path has no directory and inherits nothing; null and
    empty texts declare nothing.  Rows with the same path are judged as one file.
    """
    rows = _rows(files, path, text)
    return _inherit(rows, saved(declared(rows, threshold=threshold), "declared"))


def _rows(files: DataFrame, path: str, text: str) -> DataFrame:
    return files.select(files[f"`{path}`"].alias("path"), F.coalesce(files[f"`{text}`"], F.lit("")).alias("text"))


def _inherit(rows: DataFrame, own: DataFrame) -> DataFrame:
    split = F.split("path", "/")
    slim = rows.select("path").withColumn("name", F.element_at(split, -1)).withColumn("dir", F.array_join(F.slice(split, F.lit(1), F.size(split) - 1), "/"))
    speaking = slim.where(F.col("name").rlike(LICENCE_FILE)).join(own, "path").groupBy("dir").agg(F.min(F.struct((-F.col("score")).alias("minus"), "name", "declared")).alias("b")).select(F.col("dir").alias("above"), F.col("b.declared").alias("inherited"))
    dirs = slim.where("path is not null").select("dir").distinct()
    parts = F.when(F.col("dir") == "", F.array().cast("array<string>")).otherwise(F.split("dir", "/"))
    above = dirs.withColumn("parts", parts).select("dir", F.explode(F.sequence(F.lit(0), F.size("parts"))).alias("depth"), "parts").select("dir", "depth", F.array_join(F.slice("parts", F.lit(1), F.col("depth")), "/").alias("above"))
    nearest = above.join(speaking, "above").groupBy("dir").agg(F.max(F.struct("depth", "above", "inherited")).alias("b")).select("dir", F.col("b.above").alias("inherited_from"), F.col("b.inherited").alias("inherited"))
    joined = slim.join(own, "path", "left").join(nearest, "dir", "left")
    return joined.select("path", "declared", "score", F.coalesce("declared", "inherited").alias("license"), F.when(F.col("declared").isNull(), F.col("inherited_from")).alias("inherited_from"))
