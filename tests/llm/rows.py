"""Edge rows that every operator has to take."""

from pyspark.sql import types as T

LONG = " ".join(f"wort{k % 997} satz{k % 31}." for k in range(20_000))

EDGE = [
    (1, "The quick brown fox jumps over the lazy dog. It was not amused by that at all.", "en", "a", 78),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, "   \n\t ", "en", "a", 6),
    (5, LONG, "de", "b", len(LONG)),
    (6, "The quick brown fox jumps over the lazy dog. It was not amused by that at all.", "en", "a", 78),
    (7, "12345 --- !!! 67", "en", None, 16),
    (7, "12345 --- !!! 67", "en", None, 16),
    (None, "A row without a key, but with text.", "en", "a", 35),
]

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())])

#: Names that operators use for their own columns.
CLASHING = ["score", "lang_pred", "fp", "root", "removed", "kept", "units", "own", "hash", "key", "ids", "leaks",
            "mark_1", "again", "column_0", "__text", "y", "k", "main_text", "count"]


def frame(spark, rows=EDGE, extra=False):
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit("x") for c in CLASHING})
    return df


def write_tables(spark, folder, documents, **tables):
    documents.write.parquet(f"{folder}/documents.parquet")
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return folder
