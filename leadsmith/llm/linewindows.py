"""Line dedup over overlapping three-line windows.

The lines of a text that hold more than white space are numbered; every run of three
consecutive such lines (compared without white space at their ends) is hashed to 128 bits.
A window found more than once over the whole input is repeated; its first occurrence, by
document id and then position, stays and every later one goes.  The covered positions of
a document's later occurrences are merged, and those lines leave its text.

All of it is DataFrame functions.  Counts and first occurrences per window are
pre-aggregated on the map side; occurrences meet them in a hash join that Spark can split for
a hot window.  The text is read three times, shuffled at most once, by the final join, and not sorted.

Defined results: a document is its id with its text, so rows equal in both count as one
document and get the same result; a null id sorts first; a null text stays null without
windows; a text that loses lines is joined again from the lines left (blank lines between
them stay); extra columns of the input pass through ``cleaned`` untouched.  Texts with one
or two such lines stay as they are, as the oracle has it; with ``short`` (as in the pipeline)
their whole sequence is one window, so a later whole copy of such a text goes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadsmith.llm.common import staged

WINDOW = 3
#: White space taken off the ends of a line before it is compared.
BLANK = " \t\r\x0b\x0c"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _filled(text: Column) -> Column:
    """Positions of the lines that hold more than white space, with the trimmed line."""
    return F.filter(F.transform(_lines(text), lambda x, i: F.struct(i.alias("at"), F.trim(x, F.lit(BLANK)).alias("line"))),
                    lambda x: x["line"] != "")


def windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW, short: bool = False) -> DataFrame:
    """One row per window: id, text hash, window number (from 0), 128-bit hash.

    ``short``: a text of one line up to ``width - 1`` lines is one window (the hashes skip the nulls of the missing lines)."""
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), _filled(F.col(text_col)).alias("f"))
    part = [F.get("f", F.col("w") + i)["line"] for i in range(width)]
    return (keyed.where(F.size("f") >= (1 if short else width))
            .select("id", "th", "f", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("f") - width))).alias("w"))
            .select("id", "th", "w", F.xxhash64(*part).alias("h1"), F.xxhash64(F.lit("second"), *reversed(part)).alias("h2")))


def later_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW, short: bool = False) -> DataFrame:
    """Per document that loses lines: id, text hash, sorted window numbers of later occurrences.

    Figures of fixed width tell whether a window has several places (id, text hash, number) and in which id the first
    lies: a hash aggregate, without a sort of all windows.  The occurrences of repeated windows are staged;
    only those in the first id are compared place by place."""
    w = windows(docs, id_col, text_col, width, short)
    spread = [f(c).alias(f"{n}_{c}") for c in ("id", "th", "w") for f, n in ((F.min, "lo"), (F.max, "hi"))]
    # a row that is repeated as it stands has the same place, so it makes no window a repeated one
    several = F.count_if(F.col("id").isNull()).between(1, F.count("*") - 1)
    repeated = (w.groupBy("h1", "h2").agg(*spread, several.alias("mixed"), F.count_if(F.col("id").isNull()).alias("n_null"))
                .where("mixed or lo_id <> hi_id or lo_th <> hi_th or lo_w <> hi_w"))
    repeated = repeated.select("h1", "h2", F.when(F.col("n_null") == 0, F.col("lo_id")).alias("first_id"))  # a null id comes first
    hits = staged(w.join(repeated.hint("shuffle_hash"), ["h1", "h2"])
                  .select("h1", "h2", "id", "th", "w", F.col("id").eqNullSafe(F.col("first_id")).alias("own")), "line-windows")
    place = F.struct("th", "w")
    first = hits.where("own").groupBy("h1", "h2").agg(F.min(place).alias("first"))
    again = hits.where("own").join(first, ["h1", "h2"]).where(place != F.col("first"))
    later = hits.where("not own").select("id", "th", "w").unionByName(again.select("id", "th", "w"))
    return later.groupBy("id", "th").agg(F.array_sort(F.collect_set("w")).alias("later"))


def cleaned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW, short: bool = False) -> DataFrame:
    """The input rows with the text after line dedup, plus _n_lines, _n_windows, _n_later, _n_removed (longs)."""
    gone = later_windows(docs, id_col, text_col, width, short).select(
        F.col("id").alias("_gid"), F.col("th").alias("_gth"), F.col("later").alias("_later")).hint("shuffle_hash")
    rows = docs.withColumn("_th", F.xxhash64(text_col)).join(
        gone, F.col(id_col).eqNullSafe(F.col("_gid")) & (F.col("_th") == F.col("_gth")), "left")
    filled = _filled(F.col(text_col))
    covered = F.array_distinct(F.flatten(F.transform("_later", lambda s: F.sequence(s, F.least(s + width, F.size("_filled")) - 1))))
    rows = (rows.withColumn("_filled", F.transform(filled, lambda x: x["at"]))
            .withColumn("_covered", F.transform(covered, lambda i: F.get("_filled", i))))
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size(_lines(F.col(text_col))) - 1), "_covered"),
                       lambda i: F.get("_all", i))
    rows = rows.withColumn("_all", F.when(F.col("_covered").isNotNull(), _lines(F.col(text_col))))
    # nothing but blank lines left: the text is empty
    joined = F.when(F.size("_covered") == F.size("_filled"), "").otherwise(F.array_join(left, "\n"))
    return (rows.withColumn(text_col, F.when(F.col("_covered").isNull(), F.col(text_col)).otherwise(joined))
            .withColumn("_n_lines", F.size("_filled").cast("long"))
            .withColumn("_n_windows", F.greatest(F.least(F.lit(1 if short else 0), F.size("_filled")), F.size("_filled") - (width - 1)).cast("long"))
            .withColumn("_n_later", F.coalesce(F.size("_later"), F.lit(0)).cast("long"))
            .withColumn("_n_removed", F.coalesce(F.size("_covered"), F.lit(0)).cast("long"))
            .drop("_th", "_gid", "_gth", "_later", "_filled", "_covered", "_all"))


def line_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_windows, n_later, n_removed, kept_chars, kept_md5 per row."""
    out = cleaned(docs.select("doc_id", "text"))
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_windows").alias("n_windows"),
                      F.col("_n_later").alias("n_later"), F.col("_n_removed").alias("n_removed"),
                      F.length("text").cast("long").alias("kept_chars"), F.md5(F.col("text").cast("binary")).alias("kept_md5"))


ORACLE_CTES = """
lines AS (
  SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM (SELECT DISTINCT doc_id, text FROM {docs})),
filled AS (
  SELECT doc_id, text, pos, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS line,
         row_number() OVER (PARTITION BY doc_id, text ORDER BY pos) - 1 AS f
  FROM lines WHERE trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) <> ''),
win AS (
  SELECT * FROM (
    SELECT doc_id, text, f, line AS a,
           lead(line, 1) OVER (PARTITION BY doc_id, text ORDER BY f) AS b,
           lead(line, 2) OVER (PARTITION BY doc_id, text ORDER BY f) AS c FROM filled) WHERE c IS NOT NULL),
ranked AS (
  SELECT doc_id, text, f, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, text, f) AS rn FROM win),
gone AS (
  SELECT DISTINCT doc_id, text, f + d AS f FROM ranked, (SELECT unnest([0, 1, 2]) AS d) WHERE rn > 1),
counts AS (
  SELECT doc_id, text, count(*) AS n_windows, count(*) FILTER (rn > 1) AS n_later FROM ranked GROUP BY ALL),
marked AS (
  SELECT l.doc_id, l.text, l.line, l.pos, fl.f IS NOT NULL AS is_filled, g.f IS NOT NULL AS is_gone
  FROM lines l
  LEFT JOIN filled fl ON fl.doc_id IS NOT DISTINCT FROM l.doc_id AND fl.text IS NOT DISTINCT FROM l.text AND fl.pos = l.pos
  LEFT JOIN gone g ON g.doc_id IS NOT DISTINCT FROM l.doc_id AND g.text IS NOT DISTINCT FROM l.text AND g.f = fl.f),
kept AS (
  SELECT doc_id, text, count(*) FILTER (is_filled) AS n_lines, count(*) FILTER (is_gone) AS n_removed,
         CASE WHEN count(*) FILTER (is_gone) = 0 THEN text
              WHEN count(*) FILTER (is_gone) = count(*) FILTER (is_filled) THEN ''
              ELSE string_agg(line, chr(10) ORDER BY pos) FILTER (NOT is_gone) END AS kept_text
  FROM marked GROUP BY doc_id, text)
"""

ORACLE_SQL = "WITH " + ORACLE_CTES.format(docs="documents") + """
SELECT d.doc_id, k.n_lines::BIGINT AS n_lines, coalesce(c.n_windows, 0)::BIGINT AS n_windows,
       coalesce(c.n_later, 0)::BIGINT AS n_later, k.n_removed::BIGINT AS n_removed,
       length(k.kept_text)::BIGINT AS kept_chars, md5(k.kept_text) AS kept_md5
FROM documents d JOIN kept k ON k.doc_id IS NOT DISTINCT FROM d.doc_id AND k.text IS NOT DISTINCT FROM d.text
LEFT JOIN counts c ON c.doc_id IS NOT DISTINCT FROM d.doc_id AND c.text IS NOT DISTINCT FROM d.text
"""
