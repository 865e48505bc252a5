"""Line deduplication over all documents, DataFrame functions only.

A line's key is the line without white space ``[\\x20\\x09-\\x0D]`` at both ends and
with A-Z lower-cased.  A key of at least ``min_chars`` code points that occurs in
at least ``min_docs`` documents loses all its lines except in the document with
the largest id that holds it.

Method: (key digest, doc, position) rows are range-partitioned by digest and
sorted by document (largest first) and position; one streaming pass marks the
document that comes first and the lines that lose.  Only (doc, position) of the
losing lines goes back to its document, as a sparse bitmap: 64-line words that
keep everything are left out.  Text is not part of that shuffle.

Keys that hold more than ``hot_support`` of all distinct (document, line) pairs would put one
group into one task.  A frequent-items pass finds candidates, an ordinary aggregate counts them exactly, and that bounded table
is broadcast; their lines never reach the range shuffle.

Defined cases: null or empty text is one empty line.  A null ``doc_id`` is one
document that sorts below all others; rows with the same ``doc_id`` count as one
document, each row keeps its own bitmap (rows are told apart by their text).
Extra columns are ignored by ``keep_bitmaps`` and passed through by ``apply_bitmaps``.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import WHITE, discard, frequent_items, materialize, text_or_empty

ROW = ["__doc", "__text_md5"]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_or_empty(F.col(text_col))
    return docs.select(F.col(id_col).alias("__doc"), F.md5(text).alias("__text_md5"),
                       F.split(text, "\n", -1).alias("__lines"))


def same_letters(key):
    """A form that two keys share exactly when they agree after lower-casing A-Z (cheaper than lower-casing
    A-Z alone).  ASCII keys: lower().  Others: lower() of the UTF-8 bytes read as Latin-1, which lowers A-Z and
    moves the lead bytes C2..DE to E2..FE; how many continuation bytes follow still tells those apart."""
    return (F.when(F.octet_length(key) == F.char_length(key), F.lower(key))
            .otherwise(F.lower(F.decode(key.cast("binary"), "ISO-8859-1"))))


def line_digests(lines: str, min_chars: int):
    """Array of md5 digests of the lines' keys, null where the key is too short."""

    def digest(line):
        key = F.btrim(line, F.lit(WHITE))
        return F.when(F.char_length(key) >= min_chars, F.md5(same_letters(key)))

    return F.transform(F.col(lines), digest)


def hot_digests(keyed: DataFrame, min_docs: int, hot_support: float) -> DataFrame:
    """Exact verdict (digest, newest document, whether others lose it) of the keys that may exceed the
    support; a bounded table (see ``frequent_items``)."""
    spark = keyed.sparkSession
    distinct = (keyed.select("__doc", F.explode(F.array_distinct("__digests")).alias("__h"))
                .where(F.col("__h").isNotNull()))
    found = spark.createDataFrame([(h,) for h in frequent_items(distinct, "__h", hot_support)], "__hot string")
    # per document id first: repeated rows of one document count once
    per_doc = (distinct.join(F.broadcast(found), F.col("__h") == F.col("__hot"))
               .groupBy("__hot", "__doc").agg(F.lit(1).alias("__one")))
    exact = (per_doc.groupBy("__hot").agg(F.max("__doc").alias("__newest"), F.count(F.lit(1)).alias("__n"))
             .select("__hot", "__newest", (F.col("__n") >= min_docs).alias("__hot_drop")))
    # the row that matches nothing keeps one plan with and without frequent keys
    return spark.createDataFrame([*exact.collect(), ("", None, False)], exact.schema)


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40,
                 min_docs: int = 5, hot_support: float = 1e-3) -> DataFrame:
    """Sparse drop bitmaps: (__doc, __text_md5, n_dropped, drop_words array<struct<word, bits>>),
    one row per document row that loses a line.  Bit p of word w is line 64*w + p; absent words keep all."""
    keyed = materialize(_keyed(docs, id_col, text_col).select(*ROW, line_digests("__lines", min_chars).alias("__digests")),
                        "line-digests")
    hot = F.broadcast(hot_digests(keyed, min_docs, hot_support))
    lines = (keyed.select(*ROW, F.posexplode("__digests").alias("__pos", "__h"))
             .where(F.col("__h").isNotNull()).join(hot, F.col("__h") == F.col("__hot"), "left"))
    is_hot = F.col("__hot").isNotNull()
    loses = F.coalesce(F.col("__hot_drop"), F.lit(False)) & ~F.col("__doc").eqNullSafe(F.col("__newest"))
    # a hot line that loses is settled: it travels under a digest of its own place, spread evenly
    place = F.md5(F.concat_ws(":", F.col("__text_md5"), F.col("__doc").cast("string"), F.col("__pos").cast("string")))
    rows = (lines.where(~is_hot | loses)
            .select(F.unhex(F.when(is_hot, place).otherwise(F.col("__h"))).alias("__h"), *ROW, "__pos",
                    is_hot.alias("__lost"))
            .repartitionByRange("__h").sortWithinPartitions("__h", F.desc_nulls_last("__doc"), "__pos"))
    ranked = (rows.withColumn("__rank", F.dense_rank().over(
        Window.partitionBy("__h").orderBy(F.desc_nulls_last("__doc"))))
        .withColumn("__n", F.max("__rank").over(Window.partitionBy("__h"))))
    lost = ranked.where(F.col("__lost") | ((F.col("__n") >= min_docs) & (F.col("__rank") > 1)))
    words = (lost.groupBy(*ROW, F.floor(F.col("__pos") / 64).cast("int").alias("word"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("__pos") % 64)).alias("bits")))
    marks = materialize(words.groupBy(*ROW)
                        .agg(F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"),
                             F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("drop_words")), "line-marks")
    discard(keyed)
    return marks


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` rows packed in ``__row`` with n_lines, n_dropped and kept_text."""
    text = text_or_empty(F.col(text_col))
    left = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col(id_col).alias("__doc"),
                       F.md5(text).alias("__text_md5"))
    marks = bitmaps.select(F.col("__doc").alias("__bdoc"), F.col("__text_md5").alias("__bmd5"), "n_dropped", "drop_words")
    both = left.join(marks, F.col("__doc").eqNullSafe(F.col("__bdoc")) & (F.col("__text_md5") == F.col("__bmd5")), "left")
    bits = F.map_from_entries("drop_words")
    whole = text_or_empty(F.col(f"__row.`{text_col}`"))
    lines = F.split(whole, "\n", -1)

    def kept(line, i):
        word = F.element_at(F.col("__bits"), F.floor(i / 64).cast("int"))
        return F.coalesce(F.call_function("shiftrightunsigned", word, i % 64).bitwiseAND(F.lit(1)) == 0, F.lit(True))

    return (both.withColumn("__bits", bits)
            .select("__row", F.size(lines).cast("long").alias("n_lines"),
                    F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
                    F.when(F.col("__bits").isNull(), whole)
                    .otherwise(F.array_join(F.filter(lines, kept), "\n")).alias("kept_text")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    return apply_bitmaps(docs, keep_bitmaps(docs, id_col, text_col, **params), id_col, text_col)
