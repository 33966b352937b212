"""Line dedup: lines found in many documents lose all their occurrences (DataFrame only).

Line keys are hashed, range-partitioned on (hash, salt of the document) and sorted by document
and position inside each partition; one streaming pass marks the first occurrence of a key in
each document, and the marks are summed per key.  Occurrences of keys at or over ``min_docs``
return to their documents as a run-length compressed keep bitmap (``keep`` lines, then ``drop``
lines, ...), never as text.  The salt spreads a key that holds a third of all lines over many
range partitions, in the join back too; the sums need one row per key and salt only.

Edge cases: null or empty text is one empty line and is kept; empty keys never drop; rows equal
in id and text count as one document; an empty table gives an empty result; other columns are
never touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabwright.llm.common import K1, K2, ROW, ascii_lower, hash_pair, keyed, keyed_rows

BLANK = " \t\n\x0b\x0c\r"
SALTS = 256


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANK)))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def keep_runs(docs: DataFrame, min_docs: int = 10, min_chars: int = 1,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document that loses a line: row key, ``n_dropped`` and ``runs``, an array of
    (keep, drop) line counts in document order; lines after the last run are kept."""
    base = keyed(docs, id_col, text_col)
    lines = (base.select(K1, K2, F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
             .select(K1, K2, "pos", line_key(F.col("line")).alias("key"))
             .where(F.length("key") >= F.lit(max(1, min_chars))))
    h1, h2 = hash_pair("key")
    occ = (lines.select(h1.alias("h1"), h2.alias("h2"), F.pmod(F.col(K1), F.lit(SALTS)).alias("salt"),
                        K1, K2, "pos")
           .repartitionByRange("h1", "h2", "salt")
           .sortWithinPartitions("h1", "h2", "salt", K1, K2, "pos"))
    w = Window.partitionBy("h1", "h2", "salt").orderBy(K1, K2, "pos")
    doc = F.struct(K1, K2)
    first = F.coalesce((F.lag(doc).over(w) != doc).cast("long"), F.lit(1))
    common = (occ.withColumn("first", first).groupBy("h1", "h2")
              .agg(F.sum("first").alias("n_docs"), F.collect_set("salt").alias("salts"))
              .where(F.col("n_docs") >= min_docs).select("h1", "h2", F.explode("salts").alias("salt")))
    # joined with the salt, so a common key's occurrences stay spread
    dropped = occ.join(common, ["h1", "h2", "salt"]).select(K1, K2, "pos").distinct()
    by_doc = Window.partitionBy(K1, K2).orderBy("pos")
    islands = (dropped.withColumn("island", F.col("pos") - F.row_number().over(by_doc))
               .groupBy(K1, K2, "island")
               .agg(F.min("pos").alias("start"), F.count(F.lit(1)).cast("int").alias("drop")))
    by_start = Window.partitionBy(K1, K2).orderBy("start")
    end = F.lag(F.col("start") + F.col("drop"), 1, 0).over(by_start)
    return (islands.withColumn("keep", F.col("start") - end)
            .groupBy(K1, K2)
            .agg(F.sort_array(F.collect_list(F.struct("start", "keep", "drop"))).alias("runs"),
                 F.sum("drop").alias("n_dropped"))
            .select(K1, K2, "n_dropped",
                    F.transform("runs", lambda r: F.struct(r["keep"].alias("keep"), r["drop"].alias("drop")))
                    .alias("runs")))


def kept_text(text: Column, runs: Column) -> Column:
    """The text without the dropped lines; the runs unfold to one byte per line for the lookup."""
    bits = F.array_join(F.transform(runs, lambda r: F.concat(F.repeat(F.lit("1"), r["keep"]),
                                                             F.repeat(F.lit("0"), r["drop"]))), "")
    flags = F.encode(bits, "UTF-8")
    kept = F.filter(lines_of(text), lambda _, i: F.coalesce(
        F.substring(flags, i + 1, F.lit(1)), F.lit(b"")) != F.lit(b"0"))
    return F.when(runs.isNull(), F.coalesce(text, F.lit(""))).otherwise(F.array_join(kept, "\n"))


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text`` (the kept lines), ``n_lines, n_dropped, runs``; one row per input row."""
    runs = keep_runs(docs, min_docs, min_chars, id_col, text_col)
    d = keyed(docs, id_col, text_col).join(runs, [K1, K2], "left")
    return d.select("doc_id", kept_text(F.col("text"), F.col("runs")).alias("text"),
                    F.size(lines_of(F.col("text"))).cast("long").alias("n_lines"),
                    F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"), "runs")


def with_kept_text(docs: DataFrame, min_docs: int = 10, min_chars: int = 1,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input with all its columns, its text replaced by the kept lines."""
    runs = keep_runs(docs, min_docs, min_chars, id_col, text_col)
    d = keyed_rows(docs, id_col, text_col).join(runs, [K1, K2], "left")
    new = F.when(F.col("runs").isNull(), F.col(f"{ROW}.`{text_col}`")).otherwise(
        kept_text(F.col("text"), F.col("runs")))
    return d.select(*[(new if c == text_col else F.col(f"{ROW}.`{c}`")).alias(c) for c in docs.columns])
