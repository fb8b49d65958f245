"""License scans: headers and licence files compared to templates, then inherited down the tree.

Each unit of a file (a line, a paragraph, and the whole of a licence file) is a
sparse TF-IDF vector, with document frequencies over all files for all of its words,
and is compared to the licence templates by cosine. A file
without a licence of its own takes that of the nearest directory above it that
holds a licence file, by joins on directory paths. All steps are Spark SQL.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

#: Least cosine of a licence.
CUT = 0.6
#: Usual statements of licences, one or more for each.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
)
#: Names of licence files.
LICENSE_NAME = r"(?i)^(licen[sc]e|copying|unlicense)([.\-_].*)?$"
#: Fixed value: words are runs of letters and digits, lower-cased.
GAP = "[^a-z0-9]+"


def words(text: Column) -> Column:
    """The words of a text."""
    return F.array_remove(F.split(F.lower(text), GAP), "")


def _plain_words(text: str) -> list[str]:
    out, word = [], ""
    for c in text.lower() + " ":
        if c.isascii() and c.isalnum():
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def idf_of(files: DataFrame, templates, n: int) -> dict[str, float]:
    """Inverse document frequency, over all ``n`` files, of the templates' words (a bounded number)."""
    vocabulary = sorted({w for _, t in templates for w in _plain_words(t)})
    wanted = F.array(*[F.lit(w) for w in vocabulary])
    seen = files.select(F.explode(F.array_intersect(words(F.col("text")), wanted)).alias("word")).groupBy("word").count()
    counts = {r["word"]: r["count"] for r in seen.collect()}
    return {w: math.log((1 + n) / (1 + counts.get(w, 0))) + 1 for w in vocabulary}


def _vectors(templates, idf: dict[str, float]) -> list[tuple[str, int, dict[str, float]]]:
    """Licence, number and unit vector of each template."""
    out = []
    for i, (name, text) in enumerate(templates):
        raw = {w: n * idf[w] for w, n in Counter(_plain_words(text)).items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        out.append((name, i, {w: v / norm for w, v in raw.items()}))
    return out


def telling_words(vectors, cut: float) -> list[str]:
    """Words of which a unit needs at least one to reach the cut.

    The lightest words of a template whose weights together stay under the cut
    cannot reach it alone, whatever the unit holds besides; the others are telling.
    """
    out = set()
    for _, _, vector in vectors:
        light = 0.0
        for word, weight in sorted(vector.items(), key=lambda x: (x[1], x[0])):
            light += weight * weight
            if math.sqrt(light) >= cut:
                out.add(word)
    return sorted(out)


def license_scan(files: DataFrame, templates=TEMPLATES, cut: float = CUT) -> DataFrame:
    """One row per file: ``path, license, score, origin, source_dir``.

    ``files`` has ``path`` and ``text``. ``origin`` is ``own`` (a unit of the file
    reaches the cut; the highest cosine counts, then the licence that sorts first),
    ``inherited`` (``source_dir`` names the directory) or ``none``. Null and empty texts have no
    licence of their own; a null path lies in no directory and inherits nothing.
    Several licence files of a directory: the highest cosine, then the first name.
    Rows that repeat a path each get a row, and count each in the frequencies. Empty tables
    give no rows; other columns are left out and may have any name; texts may be of any
    length.
    """
    spark = files.sparkSession
    rows = files.select(F.col("path").cast("string").alias("path"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = rows.count()
    idf = idf_of(rows, templates, n)
    vectors = _vectors(templates, idf)
    telling = F.lit(r"(?<![a-z0-9])(" + "|".join(telling_words(vectors, cut)) + ")(?![a-z0-9])")
    text, low = F.col("text"), F.lower(F.col("text"))
    name = F.regexp_extract("path", "([^/]*)$", 1)
    holds = lambda x: F.regexp_like(x, telling)
    lines = F.split(low, "\n")
    paragraphs = F.filter(F.split(low, "\n[\\x20\\x09\\x0D]*\n"), lambda x: F.instr(x, "\n") > 0)
    whole = F.when(F.regexp_like(name, F.lit(LICENSE_NAME)), F.array(low)).otherwise(F.array().cast("array<string>"))
    units = F.when(holds(low), F.filter(F.concat(lines, paragraphs, whole), holds)).otherwise(F.array().cast("array<string>"))
    read = written(
        rows.select(
            F.monotonically_increasing_id().alias("row"), "path", F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("dir"),
            F.regexp_like(name, F.lit(LICENSE_NAME)).alias("is_license"), F.transform(units, words).alias("units"),
        ),
        "read",
    )

    weights = spark.createDataFrame([(w, v, i, n) for n, i, vector in vectors for w, v in vector.items()], "word string, weight double, template int, license string")
    counted = read.select("row", F.posexplode("units").alias("unit", "words")).select("row", "unit", F.explode("words").alias("word"))
    counted = written(counted.groupBy("row", "unit", "word").count(), "counted")
    # in how many files each word of a unit occurs; files are counted before words meet
    asked = written(counted.select("word").distinct(), "asked")
    seen = rows.select(F.explode(F.array_distinct(words(text))).alias("word")).groupBy("word").count().join(asked, "word", "left_semi")
    rarity = written(seen.select("word", (F.log((1.0 + n) / (1.0 + F.col("count"))) + 1.0).alias("idf")), "rarity")
    terms = written(counted.join(rarity, "word").select("row", "unit", "word", (F.col("count") * F.col("idf")).alias("w")), "terms")
    norms = terms.groupBy("row", "unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = terms.join(weights, "word").groupBy("row", "unit", "template", "license").agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    scored = dots.join(norms, ["row", "unit"]).select("row", "license", F.round(F.col("dot") / F.col("norm"), 9).alias("score"))
    own = scored.where(F.col("score") >= cut).groupBy("row").agg(F.min(F.struct(-F.col("score"), "license")).alias("best")).select(
        "row", F.col("best.license").alias("own"), (-F.col("best.col1")).alias("score")
    )
    known = written(read.drop("units").join(own, "row", "left"), "known")

    # the licence of each directory that holds a licence file
    homes = known.where("is_license and own is not null").groupBy("dir").agg(
        F.min(F.struct(-F.col("score"), "own", "path")).alias("best")
    ).select(F.col("dir").alias("home"), F.col("best.own").alias("given"), (-F.col("best.col1")).alias("given_score"))
    # every directory once, however many files it holds, with all directories above it
    above = known.where("own is null and path is not null").select("dir").distinct().select(
        "dir", F.explode(F.expr("transform(sequence(0, size(split(dir, '/'))), i -> array_join(slice(split(dir, '/'), 1, i), '/'))")).alias("home")
    ).distinct()
    nearest = above.join(homes, "home").groupBy("dir").agg(
        F.max(F.struct(F.length("home"), "home", "given", "given_score")).alias("near")
    ).select("dir", "near.home", "near.given", "near.given_score")
    nearest = written(nearest, "nearest")
    asks = known.where("own is null and path is not null")
    settled = known.where("own is not null or path is null").select("path", "own", "score", F.lit(None).cast("string").alias("home"))
    given = asks.join(nearest, "dir", "left").select("path", F.col("given").alias("own"), F.col("given_score").alias("score"), "home")
    return settled.unionByName(given).select(
        "path",
        F.col("own").alias("license"),
        F.round("score", 6).alias("score"),
        F.when(F.col("home").isNotNull(), "inherited").when(F.col("own").isNotNull(), "own").otherwise("none").alias("origin"),
        F.col("home").alias("source_dir"),
    )
