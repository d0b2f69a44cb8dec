"""Licence scan: TF-IDF cosine of header lines and licence files to templates, then inheritance along paths.

All of it is DataFrame operations. A file's lines, its windows of as many words as a template has (across
lines, at every word), and also the whole of a licence file, are bags of words, weighted by term frequency and by the inverse document frequency over all files. Only lines that hold a
telling term are weighed: the telling terms are the heaviest of each template, as many as it takes for
the rest of the template to stay below the threshold by itself (Cauchy-Schwarz), so no match is lost.
A licence has several templates (licence_texts.py). Those of up to SHORT words also need all words that name
the licence, so that the notice of another licence in the same phrase is not taken for it. A window needs HELD of
its template's words. Running sums give each window's cosine but for repeated words in its norm, which only lower
it; windows that this bound leaves are weighed exactly.
A file without a licence of its own takes that of the nearest directory above it that has a licence file.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from .licence_texts import TEXTS
from .scratch import Scratch

#: Short licence notices by name; TEXTS has further templates.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Proprietary": "All rights reserved.",
}
SEPARATOR = "[^a-z0-9.]+"
WORD = "[a-z0-9](?:[a-z0-9.]*[a-z0-9])?"
#: Templates of up to so many words must have all their words but these in what matches them.
SHORT = 12
UNNAMING = frozenset("a an and are as at available can com copyright distributed file found free governed http https in is license licence licensed of org or public released software source terms the this to under use version with work".split())
#: Part of a template's distinct words that a window must hold; a few common words can have the weight of a short template.
HELD = 0.75
#: A file that also holds another licence has that one, whatever the score: its copyright line often has these words.
WEAKEST = "Proprietary"
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)([.-].*)?$"


def words(text: Column) -> Column:
    """Lower-cased words; a full stop counts only inside one."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def document_frequencies(files: DataFrame, terms: list[str]) -> tuple[int, dict[str, int]]:
    """How many files there are, and how many hold each of the (few) terms."""
    asked = F.broadcast(files.sparkSession.createDataFrame([(t,) for t in terms], "term string"))
    held = files.select(F.explode(F.array_distinct(words(F.col("text")))).alias("term")).join(asked, "term")
    counts = held.groupBy("term").agg(F.count("*").alias("n")).collect()
    return files.count(), dict.fromkeys(terms, 0) | {r["term"]: r["n"] for r in counts}


def _split(text: str) -> list[str]:
    import re

    return [w for w in (x.strip(".") for x in re.split(SEPARATOR, text.lower())) if w]


def _any_of(found: set[str]) -> str:
    """A pattern of the words as a tree of letters, so that few branches are tried at a place."""
    tree: dict = {}
    for w in found:
        at = tree
        for c in w:
            at = at.setdefault(c, {})
        at[""] = {}

    def pattern(at: dict) -> str:
        parts = [("[.]" if c == "." else c) + pattern(x) for c, x in sorted(at.items()) if c]
        if not parts:
            return ""
        return parts[0] if len(parts) == 1 and "" not in at else f"(?:{'|'.join(parts)}){'?' if '' in at else ''}"

    return "(?<![a-z0-9])" + (pattern(tree) or "(?!)") + "(?![a-z0-9])"


def scan(files: DataFrame, templates: list[tuple[str, str]], threshold: float, scratch: Scratch) -> DataFrame:
    """row, licence, score of the files (row, path, text, is_file) that hold one of the templates (licence, text); the best unit counts, ties by name."""
    bags = [_split(text) for _, text in templates]
    terms = sorted({w for bag in bags for w in bag})
    n, df = document_frequencies(files, terms)
    idf = {w: round(math.log((n + 1) / (df[w] + 1)) + 1, 9) for w in terms}
    unknown = round(math.log(n + 1) + 1, 9)
    weight = [{w: bag.count(w) * idf[w] for w in sorted(set(bag))} for bag in bags]
    size = [math.sqrt(sum(x * x for x in v.values())) for v in weight]
    telling: set[str] = set()
    for v, whole in zip(weight, size, strict=True):
        rest = sum(x * x for w, x in v.items() if w not in telling)
        for w in sorted(v, key=lambda w: (-v[w], w)):
            if rest < (0.999 * threshold * whole) ** 2:
                break
            if w not in telling:
                telling.add(w)
                rest -= v[w] ** 2
    any_of = _any_of(telling)
    spark = files.sparkSession
    # the tables of templates are as large as the templates, some hundreds of rows
    known = F.broadcast(spark.createDataFrame(list(idf.items()), "term string, idf double"))
    naming = [set(bag) - UNNAMING if len(bag) <= SHORT else set() for bag in bags]
    shares = [(t, w, x / size[t], w in naming[t]) for t, v in enumerate(weight) for w, x in v.items()]
    vectors = F.broadcast(spark.createDataFrame(shares, "template int, term string, share double, names boolean"))
    counts = [(t, name, len(naming[t]), len(weight[t]), len(bags[t])) for t, (name, _) in enumerate(templates)]
    needed = F.broadcast(spark.createDataFrame(counts, "template int, licence string, n_names long, n_terms long, n_words int"))

    def weighed(units: DataFrame, *key: str) -> DataFrame:
        """row, key, term, w of units (row, key, term)."""
        counted = units.groupBy("row", *key, "term").agg(F.count("*").alias("tf")).join(known, "term", "left")
        return counted.withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(unknown)))

    def scored(met: DataFrame) -> DataFrame:
        return met.withColumn("score", F.round(F.col("dot") / F.col("norm"), 6)).where(F.col("score") >= threshold).select("row", "licence", "score")

    norm, dot = F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), F.sum(F.col("w") * F.col("share")).alias("dot")
    # few files, read from here on: the pattern is tried once on each text, and words are found once.
    # A window may reach past the end of the file, where there are words without weight
    longest = max(map(len, bags))
    padded = F.concat(words(F.col("text")), F.array_repeat(F.lit(""), longest))
    told = F.array_compact(F.transform("w", lambda t, i: F.when(t.isin(sorted(telling)), i)))
    hits = scratch.write(files.where(F.lower("text").rlike(any_of)).withColumn("w", padded).withColumn("told", told), "hits")
    # Lines and stretches are dealt out once, and all that follows keeps to their keys, so that it needs no further exchange.
    # Equal files fall together here
    unit = F.concat(F.split("text", "\n"), F.when(F.col("is_file"), F.array("text")).otherwise(F.array().cast("array<string>")))
    lines = hits.select("row", F.posexplode(unit).alias("at", "line")).where(F.lower("line").rlike(any_of)).dropDuplicates(["row", "at"])
    of_lines = weighed(lines.select("row", "at", F.explode(words(F.col("line"))).alias("term")), "at")
    dots = of_lines.join(vectors, "term").groupBy("row", "at", "template").agg(dot, F.count_if("names").alias("names"))
    by_line = scored(dots.join(needed, "template").where("names = n_names").join(of_lines.groupBy("row", "at").agg(norm), ["row", "at"]))

    # a window that matches has a telling term, so that only stretches around these leave a file
    apart = lambda p, q: q - p > 2 * longest + 1
    first = F.filter("told", lambda p, i: (i == 0) | apart(F.get("told", i - 1), p))
    last = F.filter("told", lambda p, i: (i == F.size("told") - 1) | apart(p, F.get("told", i + 1)))
    spans = F.zip_with(first, last, lambda p, q: F.struct(F.greatest(p - longest, F.lit(0)).alias("stretch"), F.least(q + longest, F.size("w") - 1).alias("end")))
    stretches = hits.select("row", "w", F.explode(spans).alias("x")).select("row", "x.stretch", F.slice("w", F.col("x.stretch") + 1, F.col("x.end") - F.col("x.stretch") + 1).alias("ws")).dropDuplicates(["row", "stretch"])
    # and most of its template's words, so that few templates are left for a stretch
    listed = [(t, len(bags[t]), sorted(v), sorted(naming[t])) for t, v in enumerate(weight)]
    listed = F.broadcast(spark.createDataFrame(listed, "template int, n_words int, terms array<string>, naming array<string>"))
    holds = stretches.withColumn("held", F.array_intersect("ws", F.array(*map(F.lit, terms))))
    enough = (F.size(F.array_except("naming", "held")) == 0) & (F.size(F.array_intersect("terms", "held")) >= HELD * F.size("terms"))
    tried = holds.join(listed, enough).select("row", "stretch", "template", "n_words", F.posexplode("ws").alias("at", "term"))
    squares = F.broadcast(spark.createDataFrame([(w, x * x) for w, x in idf.items()] + [("", 0.0)], "term string, square double"))
    gains = F.broadcast(spark.createDataFrame([(t, w, x * idf[w] / size[t]) for t, v in enumerate(weight) for w, x in v.items()], "template int, term string, gain double"))
    each = tried.join(squares, "term", "left").join(gains, ["template", "term"], "left")
    so_far = Window.partitionBy("row", "stretch", "template").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    total = lambda c, other: F.coalesce(F.sum(F.coalesce(c, F.lit(other))).over(so_far), F.lit(0.0))
    sums = each.select("row", "stretch", "template", "at", "term", "n_words", total("square", unknown * unknown).alias("q"), total("gain", 0.0).alias("g"))
    # sums before a window's first word meet those before the word after its last
    opens, closes = F.struct(F.col("at").alias("start"), (F.col("term") != "").alias("opens")), F.struct((F.col("at") - F.col("n_words")).alias("start"), F.lit(None).cast("boolean").alias("opens"))
    ends = sums.select("row", "stretch", "template", "n_words", "q", "g", F.explode(F.array(opens, closes)).alias("x")).where("x.start >= 0").select("*", "x.start", "x.opens")
    at_start = lambda c: F.max(F.when(F.col("opens"), F.col(c)))
    at_end = lambda c: F.max(F.when(F.col("opens").isNull(), F.col(c)))
    near = ends.groupBy("row", "stretch", "template", "n_words", "start").agg((at_end("q") - at_start("q")).alias("q"), (at_end("g") - at_start("g")).alias("g"))
    near = near.where(F.col("g") >= 0.999 * threshold * F.sqrt("q")).select("row", "stretch", "template", "n_words", "start")
    inside = near.join(stretches, ["row", "stretch"]).select("row", "stretch", "start", "template", F.explode(F.slice("ws", F.col("start") + 1, F.col("n_words"))).alias("term")).where("term <> ''")
    window = ["row", "stretch", "start", "template"]
    of_windows = weighed(inside, *window[1:]).join(vectors, ["term", "template"], "left").groupBy(*window).agg(norm, dot, F.count_if("names").alias("names"), F.count("share").alias("held"))
    by_window = scored(of_windows.join(needed, "template").where((F.col("names") == F.col("n_names")) & (F.col("held") >= HELD * F.col("n_terms"))))
    scored_units = by_line.unionByName(by_window)
    best = scored_units.groupBy("row").agg(F.min(F.struct((F.col("licence") == WEAKEST).alias("last"), (-F.col("score")).alias("s"), "licence")).alias("b"))
    return best.select("row", F.col("b.licence").alias("licence"), (-F.col("b.s")).alias("score"))


def license_scan(files: DataFrame, templates: dict[str, str | list[str]] | None = None, threshold: float = 0.6, is_licence_file: str = LICENCE_FILE) -> DataFrame:
    """Per row of files (path, text): path, own_license, own_score, license, inherited_from, depth.

    license is the row's own, or that of the nearest licence file (by the name pattern) in a directory above it, whose
    path is inherited_from and whose level is depth, from 1, or 0 and '' for the root of relative paths; both are null for an own
    licence and for none. Roots of relative and of absolute paths are different directories. Several
    licence files in a directory: the best score counts, ties by licence name. Null or empty texts have no own licence, but
    inherit. Null paths inherit nothing. Repeated rows come back as often as given. An empty table gives an empty
    result. Other columns are kept, except that names that clash with the result's are taken by the result.
    """
    scratch = Scratch(files.sparkSession, "licences")
    given = [*TEMPLATES.items(), *TEXTS.items()] if templates is None else templates.items()
    listed = [(name, text) for name, texts in given for text in ([texts] if isinstance(texts, str) else texts)]
    made = {"own_license", "own_score", "license", "inherited_from", "depth"}
    extra = [c for c in files.columns if c not in made | {"path", "text"}]
    text = F.col("text").cast("string")
    name = F.element_at(F.split(F.col("path").cast("string"), "/"), -1)
    base = files.select(F.struct(F.lit(0), *extra).alias("extra"), F.col("path").cast("string").alias("path"), text.alias("text"), F.coalesce(name.rlike(is_licence_file), F.lit(False)).alias("is_file"))
    # equal files have equal results, so that a row's key need not be its own
    base = base.withColumn("row", F.struct(F.xxhash64("path", "text"), F.hash("path", "text")))
    found = scratch.write(scan(base.select("row", "path", "text", "is_file"), listed, threshold, scratch), "found")
    placed = base.drop("text").join(found, "row", "left").withColumn("dir", F.regexp_replace("path", "/?[^/]*$", "")).withColumn("absolute", F.col("path").startswith("/"))
    placed = scratch.write(placed.drop("row"), "placed")
    granted = placed.where("is_file and licence is not null").groupBy(F.col("dir").alias("above"), "absolute").agg(F.min(F.struct((-F.col("score")).alias("s"), "licence")).alias("g")).select("above", "absolute", F.col("g.licence").alias("granted"))
    levels = placed.where("dir is not null").select("dir", "absolute").distinct().withColumn("parts", F.split("dir", "/"))
    level = F.sequence(F.col("absolute").cast("int"), F.when(F.col("absolute") | (F.col("dir") != ""), F.size("parts")).otherwise(0))
    chain = levels.select("dir", "absolute", F.explode(level).alias("level"), "parts").select("dir", "absolute", "level", F.array_join(F.slice("parts", F.lit(1), F.col("level")), "/").alias("above"))
    near = chain.join(granted, ["above", "absolute"]).groupBy("dir", "absolute").agg(F.max(F.struct("level", "above", "granted")).alias("n"))
    out = placed.join(near, ["dir", "absolute"], "left")
    taken = F.col("licence").isNull()
    return out.select(*[F.col("extra").getField(c).alias(c) for c in extra], "path", F.col("licence").alias("own_license"), F.col("score").alias("own_score"), F.coalesce("licence", F.col("n.granted")).alias("license"), F.when(taken, F.col("n.above")).alias("inherited_from"), F.when(taken, F.col("n.level")).cast("int").alias("depth"))
