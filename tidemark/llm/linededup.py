"""Operator 11: line dedup.

Every line of every text is normalised and hashed; a hash counts the distinct
documents it occurs in, and a line found in at least ``min_docs`` documents is
dropped from all of them but the one with the largest id. What is left of a
text is put together again by position.

DataFrame functions only:

* A line travels as 128 bits of hash, its document's id, 128 bits of the text's
  hash and its position. Texts are moved once, to meet their dropped positions.
* Distinct documents are counted in two grouped steps, both with a partial
  stage: (line, document), then line.
* A line that holds more than 1 / ``PIECES`` of all lines is dealt into as many
  pieces as its share asks for when lines meet the dropped keys. There are
  fewer than ``PIECES`` such lines whatever the input, so their list is sent to
  every task; no piece holds more than about 1 / ``PIECES`` of the lines.
* The last join reads written tables on both sides, so that a document
  repeated very often can be split at run time.

Defined results: a null or empty text is one empty line; a line keeps its own
spelling when it stays; all lines of the keeping document stay, repeats too;
rows that agree in id count as one document, and rows without an id as one that
comes below all others; a text that loses all its lines is empty; an empty
table gives an empty result. Columns beside id and text are carried along,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import table, written

MIN_CHARS = 20    # code points of a key that may be dropped
MIN_DOCS = 3      # documents that hold such a key
PIECES = 2000     # a line with a larger part of all lines than one in so many is dealt out

BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, everything else left alone."""
    return (F.when(F.octet_length(text) == F.char_length(text), F.lower(text))
            .otherwise(F.translate(text, UPPER, UPPER.lower())))


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _hashes(value: Column, name: str) -> list[Column]:
    """128 bits of hash as two longs."""
    return [F.xxhash64(value).alias(f"{name}1"), F.xxhash64(F.lit(11), value).alias(f"{name}2")]


def dropped_positions(docs: DataFrame, id_col: str, text_col: str,
                      min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per distinct (id, text) that loses lines: doc, t1, t2 (the text's
    hash) and gone, the positions of its dropped lines."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = written(
        docs.select(F.col(id_col).alias("doc"), *_hashes(text, "t"), text.alias("text"))   # hashed once a text, not a line
        .select("doc", "t1", "t2", F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
        .withColumn("key", line_key(F.col("line"))).where(F.char_length("key") >= min_chars)
        .select("doc", "t1", "t2", "pos", *_hashes(F.col("key"), "h")), "lines")
    total = lines.count()
    keys = written(
        lines.groupBy("h1", "h2", "doc").agg(F.count(F.lit(1)).alias("n_lines"))
        .groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_lines").alias("n_lines"),
                                 F.max("doc").alias("keeper"))
        .where(F.col("n_docs") >= min_docs)
        .withColumn("pieces", F.ceil(F.col("n_lines") * F.lit(float(PIECES)) / F.lit(float(max(total, 1)))))
        .select("h1", "h2", "keeper", "pieces"), "line-keys")
    hot = keys.where("pieces > 1").select("h1", "h2", "pieces")   # fewer than PIECES rows
    dealt = lines.join(F.broadcast(hot), ["h1", "h2"], "left").withColumn(
        "piece", F.when(F.col("pieces").isNull(), F.lit(0).cast("long"))
        .otherwise(F.pmod(F.xxhash64("doc", "t1", "pos"), F.col("pieces"))))
    each = keys.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
    lost = (dealt.drop("pieces").join(each.drop("pieces"), ["h1", "h2", "piece"])
            .where(~F.col("doc").eqNullSafe(F.col("keeper"))))
    return written(lost.groupBy("doc", "t1", "t2").agg(F.collect_set("pos").alias("gone")), "line-drops")


def _without(text: Column, gone: Column) -> Column:
    """The text without the lines at the positions ``gone``. The split text is
    bound to a variable, so that it is split once and not once a line."""
    def kept(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")

    return F.transform(F.array(_lines(text)), kept)[0]


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Per row of ``docs``: row (struct of its columns), kept (the text that is
    left), n_lines (before dropping) and n_dropped."""
    gone = dropped_positions(docs, f"`{id_col}`", f"`{text_col}`", min_chars, min_docs)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc"), *_hashes(text, "t"), F.struct("*").alias("row"))
    lost = gone.withColumnRenamed("doc", "of")
    met = rows.join(lost, rows["doc"].eqNullSafe(lost["of"]) & (rows["t1"] == lost["t1"])
                    & (rows["t2"] == lost["t2"]), "left")
    whole = F.coalesce(F.col("row").getField(text_col), F.lit(""))
    return met.select(
        "row", F.when(F.col("gone").isNull(), whole).otherwise(_without(whole, F.col("gone"))).alias("kept"),
        (F.char_length(whole) - F.char_length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"))


def op11_linededup(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_lines(docs).select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP11_SQL = """
WITH texts AS (SELECT row_number() OVER () AS row_no, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines
               FROM documents),
lines AS (SELECT row_no, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM texts),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
keys AS (SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20 GROUP BY key
         HAVING count(DISTINCT doc_id) + max(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) >= 3),
marked AS (SELECT k.*, s.key IS NOT NULL AND k.doc_id IS DISTINCT FROM s.keeper AS gone
           FROM keyed k LEFT JOIN keys s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY row_no, doc_id
"""
