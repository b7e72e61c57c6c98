"""License scans by canonical digests.

A text is made canonical: A-Z lower-cased, copyright lines dropped,
equivalent spellings made one, every run of characters other than a-z and 0-9
taken as one space (letters of other scripts
stay).  Its SHA-256 digest is looked up, by a hash join, among the
digests of known licence texts made canonical the same way.  Entire texts are
compared: the whole document, each of its lines (a notice stands on a line of its
own), and every run of two or more consecutive lines that begins with a known
text's first word and has as many words, so texts of several lines and wrapped
notices are found inside longer documents.  A known text that begins or ends
within a line is not.

In runs, and once more for the whole document, only lines that state a holder
(copyright with a sign, a year, a placeholder or "by") count as copyright lines,
so that "copyright holders ..." at a line's start stays, however the text is
wrapped.  The known texts are short notices, short licences in full, and digests
of the long ones (``license_texts``).

Null and empty texts, and texts that consist of copyright lines alone, match
nothing.  Repeated documents are judged each; a known text listed under two
names gives both.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .license_texts import DIGESTS, short_texts

#: Short notices of well-known licences.
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\")"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("reserved", "All rights reserved."),
)

#: Spellings that count as equal, whole words.
SPELLINGS = (("licence", "license"), ("licenced", "licensed"), ("sublicence", "sublicense"),
             ("favour", "favor"), ("organisation", "organization"), ("authorise", "authorize"),
             ("authorised", "authorized"), ("acknowledgement", "acknowledgment"), ("v", "version"),
             ("noncommercial", "nc"), ("http", "https"))

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A line that names a copyright holder, after lower-casing.
COPYRIGHT_LINE = r"(^|\n)[ \t*#/]*(copyright|\(c\)|©)[^\n]*"
#: The same for lines that state a holder, not those that go on about copyright.
HOLDER_LINE = r"(^|\n)[ \t*#/]*(copyright *(\(c\)|©|[0-9<\[{]|by )|\(c\) *(copyright|[0-9<\[{])|©)[^\n]*"
#: ASCII other than a-z, 0-9 and the newline.
GAP = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"


def canonical(text: Column, dropped: str = COPYRIGHT_LINE) -> Column:
    """Canonical lines of a text, joined by newlines."""
    t = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    t = F.regexp_replace(t, dropped, "\n")
    t = F.regexp_replace(t, GAP, "  ")
    t = F.concat(F.lit(" "), F.replace(t, F.lit("\n"), F.lit("  \n  ")), F.lit(" "))
    for a, b in SPELLINGS:
        t = F.replace(t, F.lit(f" {a} "), F.lit(f" {b} "))
    return F.regexp_replace(t, " +", " ")


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def whole(lines: Column) -> Column:
    """The entire canonical text in one line."""
    return F.trim(F.regexp_replace(lines, "[ \n]+", " "))


def known_digests(known: DataFrame) -> DataFrame:
    """(license, text) to distinct (digest, license, first, words), the last two the
    first word and the number of words; empty texts match nothing.

    Rows may have their digest, first and words instead of a text.
    """
    forms = F.array(*[whole(canonical(F.col("text"), x)) for x in (COPYRIGHT_LINE, HOLDER_LINE)])
    out = (known.where("text is not null").select(F.explode(F.array_distinct(forms)).alias("t"), "license").where("t <> ''")
           .select(_digest(F.col("t")).alias("digest"), "license", F.substring_index("t", " ", 1).alias("first"), F.size(F.split("t", " ")).alias("words")))
    if "digest" in known.columns:
        out = out.unionByName(known.where("digest is not null").select("digest", "license", "first", "words"))
    return out.distinct()


def known_texts(spark: SparkSession) -> DataFrame:
    texts = [(n, t, None, None, None) for n, t in (*KNOWN, *short_texts())]
    return spark.createDataFrame([*texts, *[(n, None, d, f, w) for n, f, w, d in DIGESTS]],
                                 "license string, text string, digest string, first string, words int")


def runs_of(text: str, shapes: dict[str, list[int]]) -> list[tuple[str, int, int]]:
    """(digest, first line, lines) of the runs of canonical lines, two or more but not all, whose
    first word and number of words are those of a known text."""
    lines = [x.strip(" ") for x in text.split("\n")]
    lines = [x for x in lines if x]
    at, upto = [0], 0
    for x in lines:
        upto += x.count(" ") + 1
        at.append(upto)
    place = {n: k for k, n in enumerate(at)}
    out = []
    for i, x in enumerate(lines):
        for n in shapes.get(x.split(" ", 1)[0], ()):
            j = place.get(at[i] + n, 0)
            if j > i + 1 and j - i < len(lines):
                out.append((hashlib.sha256(" ".join(lines[i:j]).encode()).hexdigest(), i, j - i))
    return out


def _with_runs(text: DataFrame, known: DataFrame) -> DataFrame:
    """(id, t, body) to (id, t, runs): (digest, at, n) of the runs of n lines, and n = 0 for the whole body."""
    shapes: dict[str, list[int]] = {}
    for r in known.select("first", "words").distinct().collect():
        shapes.setdefault(r.first, []).append(r.words)
    shared = text.sparkSession.sparkContext.broadcast(shapes)
    runs = pa.list_(pa.struct([("digest", pa.string()), ("at", pa.int32()), ("n", pa.int32())]))
    schema = text.select("id", "t", F.array().cast("array<struct<digest:string,at:int,n:int>>").alias("runs")).schema

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t, body in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                found = runs_of(t if body is None else body, shared.value)
                if found:  # the entire text is no run, whichever copyright lines it loses
                    entire = hashlib.sha256(" ".join(t.split()).encode()).hexdigest()
                    found = [x for x in found if x[0] != entire]
                if body is not None and (words := body.split()):
                    found.append((hashlib.sha256(" ".join(words).encode()).hexdigest(), 0, 0))
                out.append([{"digest": d, "at": k, "n": n} for d, k, n in found])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, runs)], names=["id", "t", "runs"])

    return text.mapInArrow(one, schema)


def scan(docs: DataFrame, known: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licences of every document: ``id_col``, digest, license, line_licenses, n_license_lines.

    ``digest`` is that of the entire canonical text, ``license`` the known
    licences equal to it and ``line_licenses`` those equal to one of its
    lines or a run of some of its lines (names sorted, comma-joined, empty where
    none); ``n_license_lines`` counts such lines, and each line in such runs
    once.  Rows that repeat an id are one document of pooled lines, with the digest
    that sorts first.
    """
    source = F.col(text_col).cast("string")
    low = F.lower(source)
    holder = F.contains(low, F.lit("copyright")) | F.contains(low, F.lit("(c)"))
    listed = known_digests(known)
    text = _with_runs(docs.select(F.col(id_col).alias("id"), canonical(source).alias("t"),
                                  F.when(holder, canonical(source, HOLDER_LINE)).alias("body")), listed)
    text = text.withColumn("row", F.monotonically_increasing_id())
    none = F.lit(None).cast("string")
    run = lambda x: F.struct(*[F.lit(None).cast("int") if x is None else x[c] for c in ("at", "n")])
    unit = lambda whole, u, digest, x=None: F.struct(whole.alias("whole"), u.alias("u"), digest.alias("digest"), run(x).cast("struct<at:int,n:int>").alias("run"))
    units = text.select("id", "row", F.explode(F.concat(
        F.array(unit(F.lit(True), whole(F.col("t")), none)),
        F.transform(F.split("t", "\n"), lambda x: unit(F.lit(False), F.trim(x), none)),
        F.transform("runs", lambda x: unit(x["n"] == 0, none, x["digest"], x)))).alias("x"))
    units = (units.where("x.whole or x.digest is not null or x.u <> ''")
             .select("id", "row", "x.whole", F.coalesce("x.digest", F.when(F.col("x.u") != "", _digest(F.col("x.u")))).alias("digest"), "x.run.at", "x.run.n"))
    found = units.join(listed.select(F.col("digest").alias("known"), "license").distinct(), F.col("digest") == F.col("known"), "left")
    names = lambda whole: F.array_join(F.array_sort(F.collect_set(
        F.when(F.col("whole") == F.lit(whole), F.col("license")))), ",")
    part = ~F.col("whole") & F.col("license").isNotNull()
    line = part & F.col("n").isNull()
    in_runs = F.size(F.array_distinct(F.flatten(F.collect_set(F.when(part & (F.col("n") > 0), F.transform(
        F.sequence("at", F.col("at") + F.col("n") - 1), lambda k: F.struct("row", k)))))))
    return (found.groupBy("id").agg(
        F.min(F.when(F.col("whole") & F.col("n").isNull(), F.coalesce("digest", _digest(F.lit(""))))).alias("digest"),
        names(True).alias("license"), names(False).alias("line_licenses"),
        (F.sum(line.cast("long")) + in_runs).alias("n_license_lines")).withColumnRenamed("id", id_col))
