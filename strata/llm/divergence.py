"""Divergence audit of sources: how far apart the term distributions of a language's sources are, and by which terms.

Terms are runs of letters ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased.  Every language keeps the terms
found in at least ``min_docs`` of its documents; each (language, source) group and each language gives every kept term the integer
share ``p = 1 + floor(scale (count + 2) / (N + 2 V))``; two shares differ by ``floor((p - q)^2 / (p + q))``.

Method: chunk factorization.  A document's chunks (runs between ASCII white space, which no term can span) are counted in
its task, so that what is shuffled is one row per (language, source, chunk) of a slice of documents.  Every globally distinct
chunk is tokenized once; its terms are joined back to the chunk counts and summed.  Distinct documents
add up over a chunk, not over a term, as a document may hold a term in several chunks.  A term one chunk of which is in
``min_docs`` documents is kept, one whose chunks' documents add up to less is not; for the terms between, the
documents of their chunks (each fewer than ``min_docs``) are listed by a second pass and counted exactly.

Shares of all terms in all sources are compared in arrays: tasks take blocks of terms and add up a matrix of values for each pair of
tiles of ``TILE`` sources, so no pair of rows is ever made.

Defined cases: null text, lang and source are empty strings.  Every row is a document of its own, repeated rows and
null ids too.  A group without terms has count 0 of every kept term; a language without kept terms has pairs of
value 0 and no term rows; one with a single source has no pairs.  Extra columns are ignored.  An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import ascii_lower, byte_slices, discard, materialize

TERM = r"([^\x00-\x40\x5B-\x60\x7B-\x7F]+)"
TILE = 256
MAX_SMALL = 1_000_000  # rows (language, term, chunk) that may be sent to all tasks


def _runs(*columns: np.ndarray) -> np.ndarray:
    """First index of every run of equal rows."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _pairs(part: pa.RecordBatch, key: str):
    """Distinct (chunk, document) pairs of a slice, sorted by chunk and then the documents' key column:
    (chunk values, chunk code, document, count, every document's key)."""
    lists = pc.ascii_split_whitespace(part.column("text"))
    chunks = pc.list_flatten(lists).dictionary_encode()
    doc = pc.list_parent_indices(lists).to_numpy()
    code = chunks.indices.to_numpy().astype(np.int64)
    values = chunks.dictionary
    empty = pc.index(values, pa.scalar("", values.type)).as_py()
    if empty >= 0:
        doc, code = doc[code != empty], code[code != empty]
    # documents are renumbered by key, so that pairs sorted by (chunk, document) are sorted by (chunk, key)
    keys = part.column(key).to_numpy()
    order = np.argsort(keys, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    pair = np.sort(code * len(order) + rank[doc])
    at = _runs(pair)
    count = np.diff(np.concatenate([at, [len(pair)]]))
    code, doc = np.divmod(pair[at], max(1, len(order)))
    return values, code, order[doc], count, keys


def chunk_counter(slice_bytes: int):
    """(grp, chunk, n, docs) of every slice of documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", slice_bytes):
                values, code, doc, count, grp = _pairs(part, "grp")
                if len(code):
                    at = _runs(code, grp[doc])
                    docs = np.diff(np.concatenate([at, [len(code)]]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(grp[doc[at]]), values.take(pa.array(code[at])), pa.array(np.add.reduceat(count, at)), pa.array(docs)],
                        names=["grp", "chunk", "n", "docs"])

    return run


def rare_lister(slice_bytes: int, min_docs: int):
    """(language, chunk, doc) of the chunks that fewer than ``min_docs`` of a slice's documents of the language hold;
    ``doc`` numbers the rows of the table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in byte_slices(batch, "text", slice_bytes):
                values, code, doc, _, language = _pairs(part, "language")
                if len(code):
                    at = _runs(code, language[doc])
                    docs = np.diff(np.concatenate([at, [len(code)]]))
                    rare = np.repeat(docs < min_docs, docs)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(language[doc[rare]]), values.take(pa.array(code[rare])), pa.array(doc[rare] + number)],
                        names=["language", "chunk", "doc"])
                number += part.num_rows

    return run


def texts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """(rows, groups): the texts with a number for their language and their group, and the groups' own table.

    The numbers are hashes, which keeps names out of the large shuffles; they are checked to be distinct, and taken
    with another salt where they are not."""
    names = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
                          for c, n in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))])
    salt = 0
    while True:
        rows = names.select("*", F.xxhash64(F.lit(salt), "lang").alias("language"), F.xxhash64(F.lit(salt), "lang", "source").alias("grp"))
        groups = materialize(rows.select("lang", "source", "language", "grp").distinct(), "groups")
        n = groups.agg(F.countDistinct("lang"), F.countDistinct("language"), F.count(F.lit(1)), F.countDistinct("grp")).first()
        if n[0] == n[1] and n[2] == n[3]:
            return rows, groups
        salt += 1


def chunk_terms(rows: DataFrame, slice_bytes: int) -> DataFrame:
    """(grp, chunk, term, n, docs): the chunk counts with the terms of their chunk, n times the term's number
    in the chunk; a chunk is tokenized once."""
    counts = (rows.select("text", "grp").mapInArrow(chunk_counter(slice_bytes), "grp long, chunk string, n long, docs long")
              .groupBy("grp", "chunk").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    counts = materialize(counts, "chunk-counts")
    terms = (counts.select("chunk").distinct()
             .select("chunk", F.explode(F.regexp_extract_all(ascii_lower(F.col("chunk")), F.lit(TERM), F.lit(1))).alias("term"))
             .groupBy("chunk", "term").agg(F.count(F.lit(1)).alias("times")))
    joined = counts.join(terms.hint("shuffle_hash"), "chunk").select("grp", "chunk", "term", (F.col("n") * F.col("times")).alias("n"), "docs")
    joined = materialize(joined, "chunk-terms")
    discard(counts)
    return joined


def kept_terms(rows: DataFrame, groups: DataFrame, joined: DataFrame, min_docs: int, slice_bytes: int) -> DataFrame:
    """(language, term) of the terms in at least ``min_docs`` documents of the language."""
    chunks = (joined.join(groups.select("grp", "language"), "grp").groupBy("language", "term", "chunk").agg(F.sum("docs").alias("docs")))
    chunks = materialize(chunks, "term-chunks")
    bounds = chunks.groupBy("language", "term").agg(F.max("docs").alias("low"), F.sum("docs").alias("high"))
    bounds = materialize(bounds.where(F.col("high") >= min_docs), "term-bounds")
    between = bounds.where(F.col("low") < min_docs).select("language", "term")
    # a chunk in min_docs documents would have decided its terms
    asked = materialize(chunks.where(F.col("docs") < min_docs).select("language", "term", "chunk")
                        .join(between, ["language", "term"], "left_semi"), "terms-between")
    discard(chunks)
    listed = rows.select("text", "language").mapInArrow(rare_lister(slice_bytes, min_docs), "language long, chunk string, doc long")
    small = asked.count() <= MAX_SMALL  # a checked size; beyond it Spark joins by shuffle
    found = listed.join(F.broadcast(asked) if small else asked, ["language", "chunk"])
    exact = (found.groupBy("language", "term", "doc").agg(F.lit(1).alias("one"))
             .groupBy("language", "term").agg(F.count(F.lit(1)).alias("docs")).where(F.col("docs") >= min_docs))
    return bounds.where(F.col("low") >= min_docs).select("language", "term").unionByName(exact.select("language", "term"))


def _share(count: Column, n: Column, v: Column, scale: int) -> Column:
    """1 + floor(scale (count + 2) / (n + 2 v)) in exact decimals."""
    num = (count + F.lit(2)).cast("decimal(20,0)") * F.lit(scale).cast("decimal(10,0)")
    return (F.call_function("div", num, (n + F.lit(2) * v).cast("decimal(20,0)")) + F.lit(1)).cast("long")


def _apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def pair_adder(tile: int, most: int = 64):
    """Sums of the shares' differences: a matrix per (lang, tile, tile) of sources, given out when the task has ``most`` of them
    and at its end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int, int], np.ndarray] = {}

        def give() -> Iterator[pa.RecordBatch]:
            for (lang, a, b), m in sums.items():
                i, j = np.nonzero(m)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(i), pa.string()), pa.array(a * tile + i), pa.array(b * tile + j),
                                                  pa.array(m[i, j])], names=["lang", "i", "j", "value"])
            sums.clear()

        for batch in batches:
            rows = zip(batch.column("lang").to_pylist(), batch.column("a").to_numpy(), batch.column("b").to_numpy(),
                       batch.column("base"), batch.column("at"), batch.column("p"))
            for lang, a, b, base, at, p in rows:
                share = base.values.to_numpy().copy()
                share[at.values.to_numpy()] = p.values.to_numpy()
                left, right = share[a * tile:(a + 1) * tile], share[b * tile:(b + 1) * tile]
                gap = left[:, None] - right
                value = gap * gap // (left[:, None] + right)
                if (lang, a, b) not in sums:
                    if len(sums) >= most:
                        yield from give()
                    sums[lang, a, b] = np.zeros(value.shape, np.int64)
                sums[lang, a, b] += value
        yield from give()

    return run


def audit(docs: DataFrame, min_docs: int = 10, scale: int = 1_000_000_000, top: int = 10, text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source", slice_bytes: int = 8 << 20) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank."""
    rows, named = texts(docs, text_col, lang_col, source_col)
    joined = chunk_terms(rows, slice_bytes)
    kept = materialize(kept_terms(rows, named, joined, min_docs, slice_bytes)
                       .join(named.select("language", "lang").distinct(), "language").select("lang", "term"), "kept-terms")
    counts = joined.groupBy("grp", "term").agg(F.sum("n").alias("count")).join(named, "grp").select("lang", "source", "term", "count")
    counts = materialize(counts.join(kept, ["lang", "term"]), "term-counts")
    discard(joined)

    group_n = counts.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    lang_v = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    groups = (named.join(group_n, ["lang", "source"], "left").join(lang_v, "lang", "left")
              .select("lang", "source", zero(F.col("n")).alias("n"), zero(F.col("v")).alias("v")))
    # sources are numbered within their language
    groups = materialize(groups.withColumn("i", (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("long")), "groups")
    shares = counts.join(groups, ["lang", "source"]).withColumn("p", _share(F.col("count"), F.col("n"), F.col("v"), scale))

    # term: against the language as a whole
    lang_n = groups.groupBy("lang").agg(F.sum("n").alias("lang_n"))
    lang_count = counts.groupBy("lang", "term").agg(F.sum("count").alias("lang_count"))
    own = (shares.join(lang_count, ["lang", "term"]).join(lang_n, "lang")
           .withColumn("q", _share(F.col("lang_count"), F.col("lang_n"), F.col("v"), scale)).where(F.col("p") > F.col("q"))
           .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _apart(F.col("p"), F.col("q")).alias("value")))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = own.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)

    # pair: a term's shares in all sources, as the shares of a count of 0 and those that differ from it
    bases = groups.where("v > 0").groupBy("lang").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", _share(F.lit(0).cast("long"), F.col("n"), F.col("v"), scale).alias("p")))),
                    lambda x: x["p"]).alias("base"), F.max("i").alias("last"))
    vectors = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("i", "p")).alias("own"))
    tiles = F.sequence(F.lit(0).cast("long"), F.expr(f"last div {TILE}"))
    blocks = (vectors.join(bases, "lang").withColumn("a", F.explode(tiles)).withColumn("b", F.explode(F.expr(f"sequence(a, last div {TILE})")))
              .select("lang", "a", "b", "base", F.col("own.i").alias("at"), F.col("own.p").alias("p")))
    sums = (blocks.mapInArrow(pair_adder(TILE), "lang string, i long, j long, value long")
            .groupBy("lang", "i", "j").agg(F.sum("value").alias("value")))
    # tiles above the diagonal only: the value is the same both ways
    both = sums.unionByName(sums.where(f"i div {TILE} <> j div {TILE}").select("lang", F.col("j").alias("i"), F.col("i").alias("j"), "value"))
    names = groups.select("lang", "i", "source")
    others = (names.join(names.groupBy("lang").agg(F.collect_list(F.struct(F.col("i").alias("j"), F.col("source").alias("item"))).alias("all")), "lang")
              .select("lang", "source", "i", F.inline("all")).where("i <> j"))
    pairs = (others.join(both, ["lang", "i", "j"], "left")
             .select("lang", "source", F.lit("pair").alias("part"), "item", zero(F.col("value")).alias("value"))
             .withColumn("rank", F.row_number().over(ranked)))
    return pairs.unionByName(terms)
