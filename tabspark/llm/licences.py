"""Licences of documents by canonical digest.

Method: a text is put into canonical form (lower case, copyright lines, title
lines and "all rights reserved" dropped, equivalent spellings made one, everything but letters and digits
made single blanks), hashed, and joined by hash to the digests of known
licences.  The whole text of a document is looked up, and so is each of its lines as
a whole, since notices stand alone in a line, and each of its paragraphs of several lines
(runs between blank lines), since notices are wrapped.

The SQL form follows the same rules.

All of it is DataFrame functions.  The known digests are as many as the list
that is given (here a fixed one of some thirty), broadcast for the join.

Defined results: a null or empty text has no licence, and neither has a line
that is empty in canonical form; a notice that occurs in several lines counts
each time and is named once, and a paragraph that is no more than the whole text or one of its lines is not counted again; repeated rows are looked up each for itself; an empty
table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabspark.llm.licence_texts import MORE_TEXTS, SPELLINGS, TEXTS

COPYRIGHT_LINE = r"(?m)^[^a-z0-9\n]*(copyright|\(c\))([^a-z\n][^\n]*)?$"

TITLE_LINE = (r"(?m)^[^a-z0-9\n]*((the )?((mit|expat|isc|zlib|0bsd|(simplified |new |modified |revised )?bsd|bsd zero[- ]clause|"
              r"(the )?[23][- ]clause bsd|bsd[- ][023][- ]clause)( \"[a-z]+\"( or \"[a-z]+\")?)? licen[sc]e|unlicense)"
              r"( \([a-z0-9 -]+\))?|all rights reserved)[^a-z0-9\n]*$")
KNOWN = TEXTS + MORE_TEXTS


def canonical(text: Column) -> Column:
    """Canonical form; characters beyond ASCII count as letters."""
    out = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, " ")
    out = F.regexp_replace(out, TITLE_LINE, " ")
    for pattern, to in SPELLINGS:
        out = F.regexp_replace(out, pattern, to)
    return F.trim(F.regexp_replace(out, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))


def known_digests(df: DataFrame, texts: list[tuple[str, str]] = KNOWN) -> DataFrame:
    """(digest, licence) of known texts; of texts with the same form the least name."""
    rows = df.sparkSession.createDataFrame(texts, "licence string, text string")
    return rows.groupBy(F.sha2(canonical(F.col("text")), 256).alias("digest")).agg(F.min("licence").alias("licence"))


def licence_scan(docs: DataFrame, texts: list[tuple[str, str]] = KNOWN) -> DataFrame:
    """(doc_id, licence, notices, n_notices): of the whole text (or null), and of its lines, named in order."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    known = F.broadcast(known_digests(docs, texts))
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").alias("doc_id"), text.alias("text"))
    part = lambda kind: lambda own: F.struct(F.lit(kind).alias("kind"), own.alias("text"))
    # A paragraph of several lines still has a line end when the white space around it is gone.
    wrapped = F.filter(F.split("text", r"\n[ \t\r]*\n"), lambda own: F.btrim(own, F.lit(" \t\r\n\x0b\f")).contains("\n"))
    parts = F.concat(F.array(part("whole")(F.col("text"))), F.transform(F.split("text", "\n"), part("line")),
                     F.transform(wrapped, part("paragraph")))
    looked = (rows.select("row_id", "doc_id", F.explode(parts).alias("part"))
              .select("row_id", "doc_id", "part", canonical(F.col("part.text")).alias("form"))
              .withColumn("digest", F.when(F.col("form") != "", F.sha2("form", 256)))
              .join(known, "digest", "left"))
    kind = F.col("part.kind")
    # Looked at for the few paragraphs that are known texts.
    in_its_line = F.exists(F.split("part.text", "\n"), lambda line: canonical(line) == F.col("form"))
    wrapped_own = F.when((kind == "paragraph") & F.col("licence").isNotNull(),
                         F.when(~in_its_line, F.struct("digest", "licence")))
    looked = looked.select("row_id", "doc_id", F.when(kind == "whole", F.struct("licence", "digest")).alias("whole"),
                           F.when(kind == "line", F.col("licence")).alias("in_line"), wrapped_own.alias("wrapped"))
    found = looked.groupBy("row_id", "doc_id").agg(
        F.max("whole").alias("whole"), F.collect_set("in_line").alias("lines"), F.count("in_line").alias("n_lines"),
        F.collect_list("wrapped").alias("wrapped"))
    others = F.filter("wrapped", lambda own: ~own["digest"].eqNullSafe(F.col("whole.digest")))
    return (found.withColumn("wrapped", others)
            .select("doc_id", F.col("whole.licence").alias("licence"),
                    F.array_join(F.sort_array(F.array_union("lines", F.col("wrapped.licence"))), ",").alias("notices"),
                    (F.col("n_lines") + F.size("wrapped")).alias("n_notices")))


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _canonical_sql(text: str) -> str:
    out = f"regexp_replace(lower({text}), {_quoted(COPYRIGHT_LINE)}, ' ', 'g')"
    out = f"regexp_replace({out}, {_quoted(TITLE_LINE)}, ' ', 'g')"
    for pattern, to in SPELLINGS:
        out = f"regexp_replace({out}, {_quoted(pattern)}, {_quoted(to)}, 'g')"
    return f"trim(regexp_replace({out}, {_quoted('[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')}, ' ', 'g'))"


# A paragraph counts unless it is the whole text or one of its own lines in canonical form.
SCAN_SQL = f"""
WITH known AS (
  SELECT sha256({_canonical_sql('text')}) AS digest, min(licence) AS licence
  FROM (VALUES {', '.join(f'({_quoted(n)}, {_quoted(t)})' for n, t in KNOWN)}) AS k(licence, text)
  GROUP BY 1
), own AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents
), parts AS (
  SELECT row_id, doc_id, 'whole' AS kind, text FROM own
  UNION ALL
  SELECT row_id, doc_id, 'line', unnest(string_split(text, chr(10))) FROM own
  UNION ALL
  SELECT row_id, doc_id, 'paragraph', unnest(list_filter(string_split_regex(text, '\\n[ \\t\\r]*\\n'),
    lambda p: contains(trim(p, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), chr(10)))) FROM own
), forms AS (
  SELECT row_id, doc_id, kind, text, {_canonical_sql('text')} AS form FROM parts
), looked AS (
  SELECT row_id, doc_id, kind, text, form, licence FROM forms LEFT JOIN known ON form <> '' AND sha256(form) = digest
), counted AS (
  SELECT p.row_id, p.doc_id, p.kind, p.licence
  FROM looked p JOIN looked w ON w.row_id = p.row_id AND w.kind = 'whole'
  WHERE p.kind = 'line' OR (p.kind = 'paragraph' AND p.licence IS NOT NULL AND (w.licence IS NULL OR w.form <> p.form)
    AND NOT list_contains(list_transform(string_split(p.text, chr(10)), lambda line: {_canonical_sql('line')}), p.form))
)
SELECT w.doc_id, any_value(w.licence) AS licence,
  coalesce(string_agg(DISTINCT c.licence, ',' ORDER BY c.licence), '') AS notices, count(c.licence) AS n_notices
FROM looked w LEFT JOIN counted c ON c.row_id = w.row_id WHERE w.kind = 'whole' GROUP BY w.row_id, w.doc_id
"""
