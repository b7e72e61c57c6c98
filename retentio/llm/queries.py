"""Registered queries of the subpackage, and their SQL where it can say them.

Every query applies its operator with production parameters to the whole
table it is meant for and derives the digest columns from its outputs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from . import decontam, fingerprint, jaccard, licenses, linededup, minhash, mixing, periodic, quality, secrets, toxicity, urls, whitening
from .shared import held_out

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def learnable(labels: DataFrame) -> DataFrame:
    """The labels that may be learnt from."""
    return labels.where(~held_out("doc_id"))


@query("op1_toxicity")
def op1_toxicity(spark, d):
    docs, labels = read_table(spark, d, "documents"), read_table(spark, d, "labels")
    lexicon = toxicity.fit(toxicity.training_sample(docs, learnable(labels)))
    scored = toxicity.scan(docs, lexicon)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
                         F.size("matches").alias("n_matches"))


@query("op2_secrets")
def op2_secrets(spark, d):
    docs = read_table(spark, d, "documents")
    ratios = secrets.fit(secrets.labelled_samples(docs))
    spans = secrets.scan(docs, ratios)
    text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["kind"] != "random")
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return spans.select(
        "doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"),
        n("random").alias("n_random"),
        F.sha2(F.array_join(F.transform(base, text), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", text), ",").alias("spans"))


@query("op3_quality")
def op3_quality(spark, d):
    docs, labels = read_table(spark, d, "documents"), read_table(spark, d, "labels")
    model = quality.fit(quality.training_rows(docs, learnable(labels)))
    return quality.scan(docs, model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@query("op4_mixing")
def op4_mixing(spark, d):
    return (mixing.take(read_table(spark, d, "documents"))
            .select("doc_id", "size", "source_size", "target", "taken"))


ORACLES["op4_mixing"] = r"""
WITH s AS (
  SELECT doc_id, source, md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents),
src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM s GROUP BY source),
cum AS (
  SELECT *, 3 * source_size AS cap,
         CAST((SELECT sum(source_size) FROM src) - coalesce(sum(3 * source_size) OVER before, 0) AS BIGINT) AS rest,
         CAST(sum(w) OVER after AS BIGINT) AS weight,
         row_number() OVER (ORDER BY 3 * source_size * 1.0 / w, source) AS k
  FROM src
  WINDOW before AS (ORDER BY 3 * source_size * 1.0 / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         after AS (ORDER BY 3 * source_size * 1.0 / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
open AS (SELECT min(k) AS k FROM cum WHERE w * rest <= cap * weight),
t AS (
  SELECT c.source, c.source_size,
         CASE WHEN c.k < open.k THEN CAST(c.cap AS DOUBLE)
              ELSE CAST(c.w AS DOUBLE) * CAST(o.rest AS DOUBLE) / CAST(o.weight AS DOUBLE) END AS target
  FROM cum c, open JOIN cum o ON o.k = open.k),
q AS (
  SELECT s.*, row_number() OVER (PARTITION BY source ORDER BY h, size) AS twin,
         sum(size) OVER (PARTITION BY source ORDER BY h, size ROWS UNBOUNDED PRECEDING) AS fin
  FROM s),
c AS (
  SELECT q.*, t.source_size, t.target, e,
         CASE WHEN target > 0 THEN CAST(e * t.source_size + fin AS DOUBLE) / target ELSE 0.0 END AS finish
  FROM q JOIN t ON q.source IS NOT DISTINCT FROM t.source, (SELECT unnest([0, 1, 2]) AS e)),
m AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source NULLS FIRST, h, e, twin ROWS UNBOUNDED PRECEDING) AS upto FROM c)
SELECT doc_id, size, source_size, target,
       CAST(sum(CASE WHEN upto <= (SELECT sum(size) FROM s) THEN size ELSE 0 END) AS BIGINT) AS taken
FROM m GROUP BY doc_id, source, size, source_size, target, h, twin
"""


@query("op5_decontamination")
def op5_decontamination(spark, d):
    hits = decontam.scan(read_table(spark, d, "documents"), read_table(spark, d, "benchmark"))
    items = F.array_sort(F.array_distinct(F.col("hits.item_id")))
    return hits.select("doc_id", "n_words", "n_hit", F.size(items).cast("long").alias("n_items"),
                       F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
                       (F.col("n_hit") > 0).alias("contaminated"))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLES["op5_decontamination"] = rf"""
WITH dw AS (SELECT doc_id, {_WORDS} AS w FROM documents),
iw AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n,
         array_to_string(w[k : k + least(10, len(w)) - 1], ' ') AS key
  FROM iw, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS r(k) WHERE len(w) > 0),
pos AS (
  SELECT doc_id, n, k, array_to_string(w[k : k + n - 1], ' ') AS key
  FROM dw, (SELECT DISTINCT n FROM win), unnest(range(1, len(w) - n + 2)) AS r(k)),
hit AS (SELECT pos.doc_id, pos.k, pos.n, win.item_id FROM pos JOIN win USING (n, key)),
words AS (
  SELECT doc_id, count(DISTINCT i) AS n_hit
  FROM (SELECT DISTINCT doc_id, k, n FROM hit), unnest(range(k, k + n)) AS r(i) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids
  FROM hit GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op6_fingerprints")
def op6_fingerprints(spark, d):
    return fingerprint.edit_likeness(read_table(spark, d, "documents"))


@query("op7_line_dedup")
def op7_line_dedup(spark, d):
    return linededup.report(read_table(spark, d, "documents"))


@query("op8_url_filter")
def op8_url_filter(spark, d):
    return urls.judge(read_table(spark, d, "pages"))


@query("op9_ngram_jaccard")
def op9_ngram_jaccard(spark, d):
    return jaccard.groups(read_table(spark, d, "documents"))


def _groups_sql(shingle: int, percent: int, more: str = "") -> str:
    """Components of documents linked by the Jaccard similarity of their shingles."""
    return rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct([array_to_string(w[k : k + {shingle - 1}], ' ') FOR k IN range(1, greatest(len(w) - {shingle - 1}, 1) + 1)]) AS s
      FROM w WHERE len(w) > 0),
n AS (SELECT doc_id, len(s) AS n FROM s),
t AS (SELECT doc_id, unnest(s) AS t FROM s),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM t a JOIN t b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= {percent} * (x.n + y.n - i)),
reach AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
g AS (
  SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles,
         least(w.doc_id, coalesce((SELECT min(b) FROM reach WHERE reach.a = w.doc_id), w.doc_id)) AS component_id
  FROM w LEFT JOIN n USING (doc_id))
SELECT doc_id, n_shingles, component_id{more} FROM g
"""


ORACLES["op9_ngram_jaccard"] = _groups_sql(4, 85)


@query("op10_licenses")
def op10_licenses(spark, d):
    return licenses.scan(read_table(spark, d, "documents"), licenses.known_texts(spark))


def _canonical_sql(text: str) -> str:
    q = lambda s: "'" + s.replace("'", "''") + "'"
    t = f"translate(coalesce({text}, ''), '{licenses.UPPER}', '{licenses.LOWER}')"
    t = f"regexp_replace({t}, {q(licenses.COPYRIGHT_LINE)}, chr(10), 'g')"
    t = f"regexp_replace({t}, {q(licenses.GAP)}, '  ', 'g')"
    t = f"' ' || replace({t}, chr(10), '  ' || chr(10) || '  ') || ' '"
    for a, b in licenses.SPELLINGS:
        t = f"replace({t}, ' {a} ', ' {b} ')"
    return f"regexp_replace({t}, ' +', ' ', 'g')"


def _license_oracle() -> str:
    q = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({q(a)}, {q(b)})" for a, b in licenses.KNOWN)
    whole = "trim(regexp_replace(t, '[ \\n]+', ' ', 'g'))"
    return f"""
WITH k AS (SELECT license, {_canonical_sql('text')} AS t FROM (VALUES {known}) AS v(license, text)),
known AS (SELECT DISTINCT license, sha256({whole}) AS digest FROM k WHERE {whole} <> ''),
d AS (SELECT doc_id, {_canonical_sql('text')} AS t FROM documents),
units AS (
  SELECT doc_id, true AS whole, {whole} AS u FROM d
  UNION ALL SELECT doc_id, false, trim(x) FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d) WHERE trim(x) <> ''),
f AS (SELECT doc_id, whole, sha256(u) AS digest, license
      FROM units LEFT JOIN known ON sha256(u) = known.digest AND u <> '')
SELECT doc_id, min(CASE WHEN whole THEN digest END) AS digest,
       coalesce(string_agg(DISTINCT license, ',' ORDER BY license) FILTER (WHERE whole), '') AS license,
       coalesce(string_agg(DISTINCT license, ',' ORDER BY license) FILTER (WHERE NOT whole), '') AS line_licenses,
       CAST(count(license) FILTER (WHERE NOT whole) AS BIGINT) AS n_license_lines
FROM f GROUP BY doc_id
"""


ORACLES["op10_licenses"] = _license_oracle()


@query("op11_whitening")
def op11_whitening(spark, d):
    vectors = read_table(spark, d, "embeddings")
    rows = whitening.components(vectors, whitening.fit(vectors))
    return rows.select("vec_id", "component", "n", F.col("deviation").try_cast("long").alias("deviation"), "whitened",
                       "explained", "identity_error")


@query("op12_periodic_runs")
def op12_periodic_runs(spark, d):
    docs = read_table(spark, d, "documents")
    found = periodic.scan(docs.withColumn("text", periodic.repeated_tail(F.col("text"), F.col("doc_id"))))
    best = periodic.strongest(F.col("runs"))
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                              r["period"].cast("string"), F.lit("\n"))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def _periodic_oracle(scales: int = 13) -> str:
    """Grams of doubling length by windows, next occurrences, and islands of them
    on each lag; ``scales`` 13 covers texts of up to 196,608 words."""
    ctes, pairs, at = [], [], "w"
    for k in range(4 + scales):
        size, name = 1 << k, f"g{k}"
        if k:
            ctes.append(f"{name} AS (SELECT doc_id, n, i, hash(h, lead(h, {size // 2}) OVER (PARTITION BY doc_id ORDER BY i)) AS h "
                        f"FROM {at} WHERE n >= {max(24, 3 * (size // 2 + 1) if size > 16 else 24)})")
        else:
            ctes.append(f"{name} AS (SELECT doc_id, n, i, hash(word) AS h FROM w)")
        at = name
        if k >= 4:
            pairs.append(f"SELECT {size} AS size, {size // 2 if size > 16 else 0} AS least, doc_id, i, "
                         f"lead(i) OVER (PARTITION BY doc_id, h ORDER BY i) - i AS q FROM {name} WHERE i + {size} <= n")
    return f"""
WITH crc_table AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_concat([b], [0, 0, 0, 0, 0, 0, 0, 0]),
                          lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
    FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS b))),
d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
                         list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                         lambda c, b: xor(c // 256, t[1 + xor(c % 256, b)])), CAST(4294967295 AS BIGINT)) AS h
  FROM documents, crc_table),
s AS (SELECT doc_id, w, CAST(len(w) AS BIGINT) AS n, h, h // 10 AS g FROM d),
a AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM s),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
w AS (
  SELECT doc_id, n, i, w[1 + CASE WHEN a IS NULL OR i < a THEN i ELSE a + (i - a) % p END] AS word
  FROM p, unnest(range(n)) AS r(i)),
{', '.join(ctes)},
pairs AS ({' UNION ALL '.join(pairs)}),
islands AS (
  SELECT doc_id, size, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island
  FROM pairs WHERE q > least AND q <= size),
runs AS (
  SELECT doc_id, min(i) AS start, max(i) + any_value(size) + q - min(i) AS length, q AS period
  FROM islands GROUP BY doc_id, q, island
  HAVING max(i) + any_value(size) + q - min(i) >= greatest(24, 3 * q)),
best AS (
  SELECT * FROM runs
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY CAST(length AS DECIMAL(38, 18)) / period DESC, start, period) = 1),
gone AS (SELECT DISTINCT doc_id, k AS i FROM runs, unnest(range(start + period, start + length)) AS r(k)),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs
  FROM runs GROUP BY doc_id),
kept AS (
  SELECT w.doc_id, string_agg(word, ' ' ORDER BY w.i) AS text
  FROM w LEFT JOIN gone ON gone.doc_id = w.doc_id AND gone.i = w.i WHERE gone.i IS NULL GROUP BY w.doc_id)
SELECT s.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period,
       (1000 * length) // period AS exponent_milli,
       sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM s LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


ORACLES["op12_periodic_runs"] = _periodic_oracle()


@query("op13_minhash_dedup")
def op13_minhash_dedup(spark, d):
    return minhash.groups(read_table(spark, d, "documents"))


ORACLES["op13_minhash_dedup"] = _groups_sql(3, 85, ", doc_id = component_id AS kept")
