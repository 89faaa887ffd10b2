"""License scan by TF-IDF cosine, and inheritance down directories (DataFrame functions only).

Every line of a text that speaks of a license is a notice. Notices and
templates are vectors of term counts times inverse notice frequency; a
document's license is the template with the largest cosine to one of its
notices, if that reaches a bound. A directory's license is that of its
best-matching file, license files (by name) before all others; a file
without a notice of its own takes the license of its nearest directory,
going up, that has one.

Only notice lines are cut into terms, and templates are a bounded list, so
nothing of the size of the texts is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.llm.common import documents, fresh_name, materialize, with_key

# The notices that the licenses' own texts ask to be put in files.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0, the Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0, the Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC0-1.0", "Released into the public domain under CC0 1.0 Universal"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)
#: What a notice line speaks of, and which file names are license files'.
CUE = "(?i)licen[cs]|copyright|spdx|public domain|warrant(y|ies)|redistribut"
LICENSE_FILE = "(?i)(^|/)(licen[cs]e|copying|notice)([.-][^/]*)?$"
TERM = "[a-z0-9]+"
#: The least cosine that counts as a match.
LEAST = 0.6


def _terms(df: DataFrame, key: list[str], line: str) -> DataFrame:
    """``key, term, tf``."""
    term = F.explode(F.regexp_extract_all(F.lower(F.col(line)), F.lit(TERM), 0)).alias("term")
    return df.select(*key, term).groupBy(*key, "term").agg(F.count(F.lit(1)).alias("tf"))


def notices(rows: DataFrame) -> DataFrame:
    """``rk, line_no, line`` of every notice of the keyed texts."""
    lines = F.posexplode(F.split("text", "\n")).alias("line_no", "line")
    return rows.where(F.col("text").rlike(CUE)).select("rk", lines).where(F.col("line").rlike(CUE))


def match_notices(found: DataFrame, templates=TEMPLATES) -> DataFrame:
    """``rk, license, score``: the best template of each text, by its best notice."""
    spark: SparkSession = found.sparkSession
    terms = materialize(_terms(found, ["rk", "line_no"], "line"), "terms")
    seen = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = (F.log(F.lit(1 + found.count()) / (1 + F.coalesce("df", F.lit(0)))) + 1).alias("idf")
    listed = F.explode(F.array(*(F.struct(F.lit(n).alias("license"), F.lit(t).alias("line")) for n, t in templates)))
    model = _terms(spark.range(1).select(listed.alias("t")).select("t.*"), ["license"], "line")
    model = model.join(seen, "term", "left").select("license", "term", "tf", idf)
    size = model.groupBy("license").agg(F.sqrt(F.sum(F.col("tf") * F.col("tf") * F.col("idf") * F.col("idf"))).alias("size"))
    model = materialize(model.join(size, "license").withColumnRenamed("tf", "model_tf"), "templates")  # as long as the templates
    weights = terms.join(seen, "term").select("rk", "line_no", "term", "tf", idf)
    sizes = weights.groupBy("rk", "line_no").agg(F.sqrt(F.sum(F.col("tf") * F.col("tf") * F.col("idf") * F.col("idf"))).alias("own_size"))
    dots = terms.join(F.broadcast(model), "term").groupBy("rk", "line_no", "license", "size")
    dots = dots.agg(F.sum(F.col("tf") * F.col("model_tf") * F.col("idf") * F.col("idf")).alias("dot"))
    scored = dots.join(sizes, ["rk", "line_no"]).select("rk", "license", F.round(F.col("dot") / (F.col("size") * F.col("own_size")), 6).alias("score"))
    best = F.min(F.struct((-F.col("score")).alias("order"), "license", "score")).alias("best")
    return scored.groupBy("rk").agg(best).select("rk", "best.license", "best.score")


def ancestors(directory: Column) -> Column:
    """All directories on the way, the nearest last; the root is the empty string."""
    parts = F.filter(F.split(directory, "/"), lambda p: p != "")
    return F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def license_scan(df: DataFrame, path: Column, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, least: float = LEAST) -> DataFrame:
    """``doc_id, license, score, origin, directory`` per row of ``df``.

    ``origin`` is "own" with the cosine as ``score``; "inherited" with the
    ``directory`` whose license it is and that one's score; or "none". Equal
    cosines go to the license first in the alphabet. A null path is a file
    in the root; null and empty texts have no notice; repeated rows are files
    of their own; an empty table gives an empty result; other columns are
    ignored.
    """
    place = fresh_name(df, "path_of_file")
    rows, key = with_key(df.withColumn(place, F.coalesce(path, F.lit(""))), id_col)
    files = rows.select(
        F.col(key).cast("long").alias("rk"),
        F.col(id_col).alias("doc_id"),
        F.regexp_replace(place, "/?[^/]*$", "").alias("in_dir"),
        F.col(place).rlike(LICENSE_FILE).alias("by_name"),
    )
    texts = rows.select(F.col(key).cast("long").alias("rk"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    own = materialize(match_notices(materialize(notices(texts), "notices"), templates).where(F.col("score") >= least), "licenses")
    files = files.join(own, "rk", "left")
    clean = F.array_join(F.filter(F.split("in_dir", "/"), lambda p: p != ""), "/").alias("directory")
    rank = F.min(F.struct((~F.col("by_name")).alias("a"), (-F.col("score")).alias("b"), "license", "score"))
    dirs = files.where("license IS NOT NULL").groupBy(clean).agg(rank.alias("best")).select("directory", F.col("best.license").alias("dir_license"), F.col("best.score").alias("dir_score"))
    asking = files.where("license IS NULL").select("rk", F.posexplode(ancestors(F.col("in_dir"))).alias("depth", "directory"))
    given = asking.join(dirs, "directory").groupBy("rk").agg(F.max(F.struct("depth", "directory", "dir_license", "dir_score")).alias("g"))
    out = files.join(given, "rk", "left")
    origin = F.when(F.col("license").isNotNull(), "own").when(F.col("g").isNotNull(), "inherited").otherwise("none")
    return out.select(
        "doc_id",
        F.coalesce("license", "g.dir_license").alias("license"),
        F.coalesce("score", "g.dir_score").alias("score"),
        origin.alias("origin"),
        F.col("g.directory").alias("directory"),
    )


def document_path() -> Column:
    """Documents have no path; they are laid out as ``source/<digits of doc_id but the last>/doc_id.txt``."""
    digits = F.regexp_replace((F.col("doc_id").cast("string")).substr(F.lit(1), F.length(F.col("doc_id").cast("string")) - 1), "(.)", "$1/")
    return F.concat(F.col("source"), F.lit("/"), digits, F.col("doc_id").cast("string"), F.lit(".txt"))


def query(spark, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir), document_path())


def _sql() -> str:
    values = ", ".join(f"('{name}', '{text}')" for name, text in TEMPLATES)
    return f"""
WITH files AS (
  SELECT doc_id, coalesce(text, '') AS text,
         source || '/' || regexp_replace(left(CAST(doc_id AS VARCHAR), -1), '(.)', '\\1/', 'g') || CAST(doc_id AS VARCHAR) || '.txt' AS path
  FROM documents),
dirs AS (SELECT doc_id, regexp_replace(coalesce(path, ''), '/?[^/]*$', '') AS dir, regexp_matches(path, '{LICENSE_FILE}') AS by_name FROM files),
lines AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS line_no, unnest(string_split(text, chr(10))) AS line FROM files),
notices AS (SELECT * FROM lines WHERE regexp_matches(line, '{CUE}')),
terms AS (
  SELECT doc_id, line_no, term, count(*) AS tf
  FROM (SELECT doc_id, line_no, unnest(regexp_extract_all(lower(line), '{TERM}')) AS term FROM notices) GROUP BY ALL),
seen AS (SELECT term, count(*) AS df FROM terms GROUP BY term),
units AS (SELECT count(*) AS units FROM notices),
model AS (
  SELECT license, m.term, tf, ln((1 + units) / (1 + coalesce(df, 0))) + 1 AS idf
  FROM (SELECT license, term, count(*) AS tf
        FROM (SELECT license, unnest(regexp_extract_all(lower(line), '{TERM}')) AS term FROM (VALUES {values}) v(license, line)) GROUP BY ALL) m
  LEFT JOIN seen s ON s.term = m.term CROSS JOIN units),
sizes AS (SELECT license, sqrt(sum(tf * tf * idf * idf)) AS size FROM model GROUP BY license),
own_sizes AS (
  SELECT doc_id, line_no, sqrt(sum(tf * tf * idf * idf)) AS size
  FROM (SELECT doc_id, line_no, tf, ln((1 + units) / (1 + df)) + 1 AS idf FROM terms JOIN seen USING (term) CROSS JOIN units) GROUP BY ALL),
scored AS (
  SELECT t.doc_id, m.license, round(sum(t.tf * m.tf * idf * idf) / (any_value(s.size) * any_value(o.size)), 6) AS score
  FROM terms t JOIN model m ON m.term = t.term JOIN sizes s ON s.license = m.license
  JOIN own_sizes o ON o.doc_id = t.doc_id AND o.line_no = t.line_no GROUP BY t.doc_id, t.line_no, m.license),
own AS (SELECT * FROM scored WHERE score >= {LEAST} QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, license) = 1),
dir_license AS (
  SELECT dir, license, score FROM own JOIN dirs USING (doc_id)
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY by_name DESC, score DESC, license) = 1),
given AS (
  SELECT d.doc_id, l.dir, l.license, l.score FROM dirs d JOIN dir_license l ON d.dir = l.dir OR starts_with(d.dir, l.dir || '/')
  QUALIFY row_number() OVER (PARTITION BY d.doc_id ORDER BY length(l.dir) DESC) = 1)
SELECT d.doc_id, coalesce(o.license, g.license) AS license, coalesce(o.score, g.score) AS score,
       CASE WHEN o.license IS NOT NULL THEN 'own' WHEN g.license IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       CASE WHEN o.license IS NULL THEN g.dir END AS directory
FROM dirs d LEFT JOIN own o USING (doc_id) LEFT JOIN given g USING (doc_id)
"""


ORACLE_SQL = _sql()
