"""Small shared pieces: ASCII-only lower case, row keys, lineage cuts, size-checked broadcast.

Row keys: operators join their decisions back by a 128-bit hash of (id, text) instead of the id,
so null ids, repeated ids and repeated rows need no special case: rows equal in id and text are
one document and get one decision; rows that share an id but not the text are two documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.session import ensure_checkpoint_dir, scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
K1, K2 = "__k1", "__k2"
ROW = "__row"

# A side is broadcast only after its bytes were counted and found below this bound.
BROADCAST_BYTES = 32 * 1024 * 1024


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` does exactly that on pure-ASCII strings."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(
        F.translate(c, UPPER, UPPER.lower()))


def hash_pair(*cols) -> tuple[Column, Column]:
    """Two independently seeded 64-bit hashes of the columns (128 bits together)."""
    return F.xxhash64(*cols), F.xxhash64(F.lit(20011), *cols)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text`` (null text: empty) and the row key, nothing else of the input."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__raw"))
    a, b = hash_pair("doc_id", "__raw")
    return d.select("doc_id", F.coalesce("__raw", F.lit("")).alias("text"),
                    a.alias(K1), b.alias(K2))


def keyed_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The whole input row packed in one struct (so no name can clash) plus text and row key."""
    a, b = hash_pair(F.col(id_col), F.col(text_col))
    return docs.select(F.struct("*").alias(ROW), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       a.alias(K1), b.alias(K2))


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the folder named by spark.checkpoint.dir."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back (columns can then be pruned)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def bounded(df: DataFrame, bytes_per_row: int) -> DataFrame:
    """Mark ``df`` for broadcast when its counted rows stay below BROADCAST_BYTES; beyond that
    return it as it is, and Spark joins it by a shuffle (AQE splits skewed keys there)."""
    return F.broadcast(df) if df.count() * bytes_per_row <= BROADCAST_BYTES else df


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def map_texts(docs: DataFrame, fn, columns: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id`` and text (plus ``extra`` columns) through a per-document Python function in Arrow
    batches: ``fn()`` is called once per task and returns ``text, *extra -> tuple`` in the order of
    ``columns`` (DDL).  Ids pass through as they are, so null ids keep their type."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructField, StructType, _parse_datatype_string

    id_type = docs.schema["doc_id"].dataType
    out = StructType([StructField("doc_id", id_type), *_parse_datatype_string(columns).fields])
    schema = to_arrow_schema(out)

    def run(batches):
        one = fn()
        for b in batches:
            rows = [one(*x) for x in zip(*(b.column(i).to_pylist() for i in range(1, b.num_columns)), strict=True)]
            cols = list(zip(*rows, strict=True)) if rows else [()] * (len(schema) - 1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(schema.field(0).type),
                 *(pa.array(c, f.type) for c, f in zip(cols, list(schema)[1:], strict=True))], schema=schema)

    return docs.select("doc_id", "text", *extra).mapInArrow(run, out)
