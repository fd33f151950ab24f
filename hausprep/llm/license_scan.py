"""Licence scan by canonical digests (operator 2); DataFrame functions only.

A text is made canonical (lower case, copyright lines out, equivalent spellings made one, punctuation to
spaces, spaces to one) and its SHA-256 is joined with the digests of known licences, canonical in the same
way.  Entire documents are hash-joined with the (bounded, broadcast) table of digests; as licences and notices
stand within other text, every run of consecutive lines that may be a known text is looked up too: a line that
begins like one is joined with the lines after it to the known text's length, and that digest must be the known one.
"""

from __future__ import annotations

import re
from collections import defaultdict
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Known licence notices; ``full_texts`` has the licences and standard notices in full.
KNOWN = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
)
#: Usual headings of the texts of ``short.txt``.
TITLES = {"MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"), "ISC": ("ISC License", "The ISC License"),
          "BSD-2-Clause": ("BSD 2-Clause License",), "BSD-3-Clause": ("BSD 3-Clause License",), "Zlib": ("zlib License",)}
#: Pattern and the one spelling that stands for it, after lower-casing.
SPELLINGS = (("licence", "license"), ("sub-license", "sublicense"), ("https://", "http://"), ("&", " and "), ("©", "(c)"))
#: Copyright lines.  Lines of a licence may begin with these words too, where its text wraps.
_GOES_ON = (r"(?![^\S\n]+(?:notices?|holders?|owners?|ownership|laws?|licen[cs]\w*|interests?|statements?|and|or|on|in|of|to|is|as|for"
            r"|treat\w+|disclaimers?|permissions?|protection|rights?|status|claims?|works?|if|under|resulting|conditions?|material"
            r"|infringement|information|legends?|you|any|a|doctrines?|representations"
            r"|the[^\S\n]+(?:software|library|program|licen[cs]es?))\b)(?![^\S\n]*(?:$|[,.;\"')]))")
COPYRIGHT = rf"(?im)^[\s*#/]*(?:(?:copyright\b|\(c\)){_GOES_ON}.*|©.*|all rights reserved[.]?[^\S\n]*)$"
MAX_KNOWN = 200      # known texts that may be broadcast
_HEAD = 40           # characters of a known text that a line is held against before any digest


def full_texts() -> tuple[tuple[str, str], ...]:
    """``license, text`` of the files in ``licenses``, with and without heading, list numbers and appendix."""
    found = []
    for path in sorted((Path(__file__).parent / "licenses").glob("*.txt")):
        text = path.read_text(encoding="utf-8")
        if path.name == "short.txt":
            for part in re.split(r"(?m)^== ", text)[1:]:
                name, body = part.split("\n", 1)
                for variant in dict.fromkeys((body, re.sub(r"(?m)^\d\. ", "", body))):
                    found.append((name, variant))
                    if len(body) > 500:
                        found += [(name, f"{title}\n{variant}") for title in TITLES.get(name, ())]
        else:
            found.append((path.stem, text))
            head, end, _ = text.partition("END OF TERMS AND CONDITIONS")
            if end:
                found += [(path.stem, head + end), (path.stem, head)]
    return tuple(found)


def canonical(text: Column) -> Column:
    out = F.lower(F.regexp_replace(text, COPYRIGHT, ""))
    for pattern, one in SPELLINGS:
        out = F.replace(out, F.lit(pattern), F.lit(one))
    return F.trim(F.regexp_replace(out, r"[^\p{L}\p{N}]+", " "))


def _digest(canonical_text: Column) -> Column:
    return F.sha2(canonical_text.cast("binary"), 256)


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """``digest, license, text`` (canonical) of at most ``MAX_KNOWN`` known texts."""
    if len(known) > MAX_KNOWN:
        raise ValueError(f"more than {MAX_KNOWN} known texts")
    rows = spark.createDataFrame(list(known), "license string, text string")
    return rows.select("license", canonical(F.col("text")).alias("text")).groupBy(_digest(F.col("text")).alias("digest")) \
        .agg(F.min("license").alias("license"), F.min("text").alias("text"))


def scan(docs: DataFrame, known=None) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_matches`` (runs of lines that are a known text and lie in no longer one),
    ``licenses`` (sorted, comma-joined) and ``whole`` (the whole text is a known one).

    Lines without a letter or digit and copyright lines count for no run.  Null and empty texts match nothing;
    repeated rows give repeated results.
    """
    spark = docs.sparkSession
    rows = known_digests(spark, KNOWN + full_texts() if known is None else known).collect()      # at most MAX_KNOWN rows
    digests = spark.createDataFrame([(r["digest"], r["license"]) for r in rows], "digest string, whole string")
    by_word = defaultdict(list)
    for r in sorted(rows):
        t = r["text"]
        if t:
            by_word[t.split(" ")[0]].append(F.struct(
                F.lit(t[:_HEAD]).alias("head"), F.lit(len(t)).alias("size"), F.lit(t.count(" ") + 1).alias("words"),
                F.lit(r["digest"]).alias("digest"), F.lit(r["license"]).alias("license")))
    table = F.create_map(*[x for word, texts in by_word.items() for x in (F.lit(word), F.array(*texts))])

    lines = F.filter(F.transform(F.split("text", "\n", -1), canonical), lambda x: x != "")
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    docs = docs.select("doc_id", _digest(canonical(F.col("text"))).alias("digest"), lines.alias("lines")) \
        .join(F.broadcast(digests), "digest", "left")
    like = F.transform("lines", lambda x, i: F.transform(
        F.filter(F.try_element_at(table, F.substring_index(x, " ", 1)), lambda t: F.startswith(t["head"], F.left(x, F.lit(_HEAD)))),
        lambda t: F.struct(i.alias("first"), t.alias("t"))))
    docs = docs.withColumn("like", F.flatten(F.filter(like, lambda x: x.isNotNull())))
    run = lambda c: F.array_join(F.slice("lines", c["first"] + 1, c["t"]["words"]), "\n")
    docs = docs.withColumn("runs", F.transform("like", lambda c: F.struct(
        c["first"].alias("first"), c["t"].alias("t"), F.left(run(c), c["t"]["size"]).alias("own"),
        F.substring(run(c), c["t"]["size"] + 1, F.lit(1)).alias("next"))))
    same = lambda c: c["next"].isin("", "\n") & (_digest(F.translate(c["own"], "\n", " ")) == c["t"]["digest"])
    docs = docs.withColumn("runs", F.transform(F.filter("runs", same), lambda c: F.struct(
        c["first"].alias("first"), (c["first"] + F.size(F.split(c["own"], "\n", -1))).alias("last"), c["t"]["license"].alias("license"))))
    docs = docs.withColumn("long", F.filter("runs", lambda c: c["last"] - c["first"] > 1))
    within = lambda c: F.exists("long", lambda o: (o["first"] <= c["first"]) & (o["last"] >= c["last"])
                                & (o["last"] - o["first"] > c["last"] - c["first"]))
    every = F.coalesce(F.transform(F.filter("runs", lambda c: ~within(c)), lambda c: c["license"]), F.array().cast("array<string>"))
    docs = docs.select("doc_id", "whole", every.alias("every"))
    return docs.select(
        "doc_id", F.greatest(F.size("every"), F.col("whole").isNotNull().cast("int")).cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.filter(F.concat("every", F.array("whole")), lambda x: x.isNotNull()))), ",")
        .alias("licenses"), F.col("whole").isNotNull().alias("whole"))
