"""The stages of ``corpus_pipeline.py``: documents in, documents out (the last gives packed pieces).

Every stage keeps the columns of its input, whatever they are called; ``n_chars`` follows the text
where the column exists.

Defined cases: a null or empty text passes toxicity, line dedup and near dedup unchanged and leaves at mixing, which
takes words; a null id stays to the end.  Repeated rows are judged alike; of rows with the same id and text one stays.
An empty table gives an empty result at every stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm import line_dedup as LD
from strata.llm import mixing as MX
from strata.llm import near_dedup as ND
from strata.llm import packing as PK
from strata.llm import toxicity as TX
from strata.llm.common import WORD, materialize, table, text_or_empty


def _with_text(columns: list[str], text: Column) -> list[Column]:
    """The packed row's columns with another text."""
    out = []
    for c in columns:
        if c == "text":
            out.append(text.alias("text"))
        elif c == "n_chars":
            out.append(F.char_length(text).cast("long").alias("n_chars"))
        else:
            out.append(F.col(f"__row.`{c}`").alias(c))
    return out


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go: by id (a null one too) and text, so rows of one id with other texts are judged apart.
    The scorer carries these keys and not the rows, so a task holds a text once."""
    md5 = F.md5(text_or_empty(F.col("text")))
    scored = TX.toxicity(docs, table(spark, sf_dir, "labels"), carry={"md5": md5})
    toxic = materialize(scored.where("predicted = 1").select(F.col("doc_id").alias("toxic_id"), F.col("__row.md5").alias("toxic_md5"))
                        .distinct(), "toxic")
    scored._model.destroy()  # the later stages have the driver's memory without it
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
                       F.col("doc_id").cast("long").alias("__id"), md5.alias("__md5"))
    same = F.col("__id").eqNullSafe(F.col("toxic_id")) & (F.col("__md5") == F.col("toxic_md5"))
    return rows.join(toxic, same, "left_anti").select("__row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go from the texts; every document stays."""
    marked = LD.dedup_lines(docs)
    text = F.when(F.col("n_dropped") > 0, F.col("kept_text")).otherwise(F.col("__row.text"))
    return marked.select(*_with_text(docs.columns, text))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies (five words, similarity of 0.8 or more) stays; rows without words or
    without an id all stay.  At 0.8 more trees and a wider margin than op4's keep misses as rare."""
    classes = ND.near_classes(docs, percent=80, trees=8, margin=0.09)
    lost = classes.where(~F.col("kept")).select(F.col("doc_id").alias("lost_id"), F.col("text_md5").alias("lost_md5"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
                       F.col("doc_id").cast("long").alias("__id"), F.md5(text_or_empty(F.col("text"))).alias("__md5"))
    left = rows.join(lost, (F.col("__id") == F.col("lost_id")) & (F.col("__md5") == F.col("lost_md5")), "left_anti")
    # rows repeated with their id are copies too: the one with the least hash of all its columns stays
    # (of maps the hash is undefined, they are left out of it); the join has dealt the rows by these keys already
    hashed = [F.col(f"__row.`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    same = F.row_number().over(Window.partitionBy("__id", "__md5").orderBy(F.xxhash64(*hashed)))
    has_words = text_or_empty(F.col("__row.text")).rlike(WORD)
    return (left.withColumn("__copy", same).where((F.col("__copy") == 1) | F.col("__id").isNull() | ~has_words)
            .select("__row.*"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix's documents: one row for each time a document's words are taken, with the words
    taken that time (the text as it is when that is all of them)."""
    mixed = MX.mix(docs, carry=True).where("taken > 0")
    times = mixed.withColumn("__epoch", F.explode(F.sequence(F.lit(1).cast("long"), F.array_max("uses.times"))))
    spans = F.filter("uses", lambda u: u["times"] >= F.col("__epoch"))
    words = F.regexp_extract_all(F.col("__row.text"), F.lit(f"({WORD})"), F.lit(1))
    # the outer transform binds the words once a row; inside the inner one they would be found again for each span
    part = F.element_at(F.transform(F.array(words), lambda ws: F.flatten(F.transform(F.col("__spans"), lambda u: F.slice(
        ws, (u["from"] + 1).cast("int"), (u["to"] - u["from"]).cast("int"))))), 1)
    covered = F.aggregate("__spans", F.lit(0).cast("long"), lambda n, u: n + u["to"] - u["from"])
    text = F.when(covered == F.col("size"), F.col("__row.text")).otherwise(F.array_join(part, " "))
    return times.withColumn("__spans", spans).select(*_with_text(docs.columns, text))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of 4096-id sequences with their ids."""
    from strata.llm.queries import tokenizer_path
    return PK.pack(docs, tokenizer_path())
