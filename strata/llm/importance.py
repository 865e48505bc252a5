"""Importance resampling towards a target distribution, with a distributed radix sort.

A text's features are its runs of 1 to 3 consecutive words ``[a-z0-9 and non-ASCII]+`` (A-Z lower-cased first), joined by
one space; a feature's bucket is the crc32 of its bytes modulo ``buckets``.  A bucket's gain is the floored
log-ratio of its smoothed shares in the target texts and in all documents; a document's weight is the sum
of its features' gains, its score adds a Gumbel value drawn from its id, and the highest scores are drawn (sampling
without replacement in proportion to the weights).

Method: the weights are scored with arrays, a slice of texts at a time.  CRC is linear over bits, so a word's remainder is
the exclusive or of a table entry per byte, and a run's is that of its words' remainders moved by the bytes that
follow.  Ranks come from a least-significant-digit radix sort over the key (score descending, id ascending with null last,
features): every pass counts its digit per block of the present order, prefix sums over (digit, block) give each
block's first destination for each digit, and a row's destination is that plus its place among the block's rows of the digit
(stable).  Blocks have at most ``block_rows`` rows, so no value of a digit, however common, meets in one task.

Defined cases: null text has no words.  A null id draws as the text ``42:`` and ranks after equal scores of other
ids.  Repeated rows are drawn each for itself.  Texts of fewer than ``min_words`` words are weighed but never drawn.
Extra columns are ignored by ``resample`` and kept by ``drawn``.  An empty table gives an empty result; an empty target
makes gains of the smoothing alone.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import byte_slices, discard, materialize, utf8
from strata.llm.wordblocks import LOWER

SHORT = 48  # words of more bytes take the library's crc32
BLOCK = 1 << 20  # bytes worked on at a time
_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
SCORED = "doc_id long, n_words long, n_features long, weight long"


class Crc:
    """Tables for crc32 by parts.  ``raw`` remainders start from 0 without the final inversion, so they are linear."""

    def __init__(self):
        # raw remainder of one byte followed by d zero bytes
        at = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], np.uint32)
        rows = [at]
        for _ in range(SHORT):
            rows.append((rows[-1] >> np.uint32(8)) ^ at[rows[-1] & np.uint32(255)])
        self.byte = np.stack(rows)
        # a remainder moved by d zero bytes: one table per byte of the remainder
        moves = np.empty((SHORT + 2, 4, 256), np.uint32)
        for k in range(4):
            r = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
            for d in range(SHORT + 2):
                moves[d, k] = r
                r = (r >> np.uint32(8)) ^ at[r & np.uint32(255)]
        self.moves = moves.reshape(-1)
        # crc32 of d zero bytes: what turns a raw remainder into the real one
        self.zeros = np.array([zlib.crc32(b"\0" * d) for d in range(3 * SHORT + 3)], np.uint32)
        self.space = self.byte[0][0x20]

    def words(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Raw remainders of short words."""
        if not len(start):
            return np.empty(0, np.uint32)
        first = np.concatenate([[0], np.cumsum(size)])
        place = np.arange(first[-1]) - np.repeat(first[:-1], size)
        left = np.repeat(size, size) - 1 - place
        each = self.byte[left, data[np.repeat(start, size) + place]]
        return np.bitwise_xor.reduceat(each, first[:-1])

    def moved(self, raw: np.ndarray, by: np.ndarray) -> np.ndarray:
        at = by.astype(np.int64) << 10
        out = self.moves[at + (raw & np.uint32(255))]
        for k in range(1, 4):
            out ^= self.moves[at + (256 * k) + ((raw >> np.uint32(8 * k)) & np.uint32(255))]
        return out


_CRC: list[Crc] = []


def crc() -> Crc:
    if not _CRC:
        _CRC.append(Crc())
    return _CRC[0]


def _spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], _WORD_BYTE[data], [False]]).view(np.int8)))
    return edge[0::2], edge[1::2]


def run_crcs(data: np.ndarray, start: np.ndarray, end: np.ndarray, doc: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(crc32, index of the first word) of all runs of 1, 2 and 3 words of one document."""
    t = crc()
    size = end - start
    short = size <= SHORT
    raw = np.zeros(len(size), np.uint32)
    raw[short] = t.words(data, start[short], size[short])
    head, length, plain = raw, size, short
    for k in (1, 2, 3):
        n = len(size) - k + 1
        if n <= 0:
            return
        if k > 1:
            tail = slice(k - 1, k - 1 + n)
            plain = plain[:n] & short[tail]
            own = np.where(short[tail], size[tail], 0)
            # head, a space, then the next word
            spaced = t.moved(head[:n], np.ones(n, np.int64)) ^ t.space
            head = t.moved(spaced, own) ^ raw[tail]
            length = length[:n] + 1 + size[tail]
        at = np.flatnonzero(doc[:n] == doc[k - 1:])
        out = head[at] ^ t.zeros[np.where(plain[at], length[at], 0)]
        for j in np.flatnonzero(~plain[at]):  # runs with a long word
            i = at[j]
            out[j] = zlib.crc32(b" ".join(data[start[m]:end[m]].tobytes() for m in range(i, i + k)))
        yield out, at


def _blocks(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(data, start, end, document, own) of the words of runs of texts, about ``BLOCK`` bytes at a time.  A long text is cut between words;
    two words of the cut before come again so that no run is lost; runs that start before ``own`` and end before it are not counted twice."""
    joined = (b"\n".join(texts) + b"\n").translate(LOWER)
    data = np.frombuffer(joined, np.uint8)
    begin = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)])
    start, end = [], []
    at = 0
    while at < len(data):
        stop = min(len(data), at + BLOCK)
        while stop < len(data) and _WORD_BYTE[data[stop]]:
            stop += 1
        s, e = _spans(data[at:stop])
        start.append(s + at)
        end.append(e + at)
        at = stop
    start, end = np.concatenate(start), np.concatenate(end)
    doc = np.searchsorted(begin, start, side="right") - 1
    step = BLOCK // 4
    for i in range(0, max(len(start), 1), step):
        lead = max(0, i - 2)
        yield data, start[lead:i + step], end[lead:i + step], doc[lead:i + step], np.int64(i - lead)


def bucket_runs(texts: list[bytes], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(bucket, document, words in a run) of every feature, part by part."""
    for data, start, end, doc, own in _blocks(texts):
        for k, (value, at) in enumerate(run_crcs(data, start, end, doc), 1):
            new = at + k - 1 >= own  # the run's last word is of this part
            yield (value[new] % np.uint32(buckets)).astype(np.int64), doc[at[new]], k


def bucket_counter(buckets: int, slice_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in byte_slices(batch, "text", slice_bytes):
                for bucket, _, _ in bucket_runs(utf8(part, "text"), buckets):
                    total += np.bincount(bucket, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    return run


def weigher(gains: np.ndarray, slice_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", slice_bytes):
                texts = utf8(part, "text")
                n = len(texts)
                words, features, weight = (np.zeros(n, np.int64) for _ in range(3))
                for bucket, doc, k in bucket_runs(texts, len(gains)):
                    if not len(doc):
                        continue
                    cut = np.concatenate([[0], np.flatnonzero(np.diff(doc)) + 1])
                    many = np.diff(np.concatenate([cut, [len(doc)]]))
                    own = doc[cut]
                    features[own] += many
                    if k == 1:
                        words[own] += many
                    weight[own] += np.add.reduceat(gains[bucket], cut)
                rest = [part.column(c) for c in part.schema.names if c not in ("doc_id", "text")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(words), pa.array(features), pa.array(weight), *rest],
                    names=["doc_id", "n_words", "n_features", "weight", *[c for c in part.schema.names if c not in ("doc_id", "text")]])

    return run


def bucket_counts(texts: DataFrame, buckets: int, slice_bytes: int = 1 << 21) -> DataFrame:
    """(bucket, n) over all texts of the column ``text``; at most ``buckets`` rows."""
    return (texts.select("text").mapInArrow(bucket_counter(buckets, slice_bytes), "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """Every bucket's gain, an array of ``buckets`` longs: the only thing the scoring tasks are sent."""
    spark = docs.sparkSession
    both = (spark.range(buckets).select(F.col("id").alias("bucket"), F.lit(0).cast("long").alias("s"), F.lit(0).cast("long").alias("t"))
            .unionByName(bucket_counts(docs, buckets).select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t")))
            .unionByName(bucket_counts(target, buckets).select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t")))
            .groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).toArrow())
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    at = both["bucket"].to_numpy()
    s[at], t[at] = both["s"].to_numpy(), both["t"].to_numpy()
    big_s, big_t = int(s.sum()) + buckets, int(t.sum()) + buckets
    return np.array([math.floor(1000 * math.log((float(b + 1) * float(big_s)) / (float(a + 1) * float(big_t))))
                     for a, b in zip(s.tolist(), t.tolist())], np.int64)


def gumbel(doc_id: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln u)) of the id's own u between 0 and 1."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    u = (h.cast("long").cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u))).cast("long")


def scored(docs: DataFrame, gains: np.ndarray, seed: int, id_col: str, text_col: str, carry: bool = False,
           slice_bytes: int = 1 << 21) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every row (and the whole row as ``__row``)."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *([row] if carry else []))
    schema = SCORED + (f", __row {rows.schema['__row'].dataType.simpleString()}" if carry else "")
    return rows.mapInArrow(weigher(gains, slice_bytes), schema).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))


# --------------------------------------------------------------------------- radix sort

LOWEST = -(1 << 63)
#: Key fields from the lowest to the highest, and whether they ascend.
KEY = {"features": True, "id": True, "no_id": True, "score": False}


def key_values() -> dict[str, Column]:
    return {"features": F.col("n_features"), "id": F.col("doc_id"), "no_id": F.col("doc_id").isNull().cast("long"), "score": F.col("score")}


def key_fields(rows: DataFrame) -> tuple[int, list[tuple[Column, int]]]:
    """Number of rows, and the key's fields from the lowest to the highest: a long read as unsigned, and its bits."""
    values = key_values()
    made = rows.agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{k}_{a}") for k, c in values.items()
                                                   for a, f in (("lo", F.min), ("hi", F.max))]).first()
    fields = []
    for k, c in values.items():
        lo, hi = (made[f"{k}_{a}"] or 0 for a in ("lo", "hi"))
        c = F.coalesce(c, F.lit(lo).cast("long"))
        if hi - lo < 1 << 63:
            fields.append((c - F.lit(lo).cast("long") if KEY[k] else F.lit(hi).cast("long") - c, (hi - lo).bit_length()))
        else:  # the whole range of longs: the sign bit turned
            fields.append((c.bitwiseXOR(F.lit(LOWEST if KEY[k] else -1 ^ LOWEST).cast("long")), 64))
    return made["n"], fields


def digit(fields: list[tuple[Column, int]], low: int, width: int) -> Column:
    """Bits ``low`` to ``low + width`` of the concatenated key."""
    out, at = F.lit(0).cast("long"), 0
    for value, bits in fields:
        if bits and at < low + width and at + bits > low:
            out = out.bitwiseOR(F.shiftrightunsigned(value, low - at) if at <= low else F.shiftleft(value, at - low))
        at += bits
    return out.bitwiseAND(F.lit((1 << width) - 1))


def radix_ranks(rows: DataFrame, block_rows: int = 1 << 16, width: int = 12) -> tuple[DataFrame, int]:
    """``rank`` (1, 2, ...) of every row by score descending, doc_id ascending (null last), n_features; and the number of rows.

    ``rows`` needs the columns doc_id, n_features and score, and must be a stored table (it is read more than once)."""
    spark = rows.sparkSession
    n, fields = key_fields(rows)
    per_block = max(1, min(block_rows, math.ceil(n / (2 * int(spark.conf.get("spark.sql.shuffle.partitions"))))))
    # the first order is that of the stored table: rows are numbered within the partitions that read it
    block = F.expr(f"__pos div {per_block}")
    order = materialize(rows.withColumn("__pos", F.monotonically_increasing_id()).withColumn("__block", block), "radix")
    total = sum(bits for _, bits in fields)
    for low in range(0, max(total, 1), width):
        now = order.withColumn("__digit", digit(fields, low, width))
        counts = now.groupBy("__digit", "__block").agg(F.count(F.lit(1)).alias("__n"))
        # two levels of prefix sums: over the blocks of a digit, and over the digits (at most 2**width rows)
        blocks = Window.partitionBy("__digit").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
        digits = Window.orderBy("__digit").rowsBetween(Window.unboundedPreceding, -1)
        starts = (counts.groupBy("__digit").agg(F.sum("__n").alias("__m"))
                  .select("__digit", F.coalesce(F.sum("__m").over(digits), F.lit(0)).alias("__start")))
        offsets = (counts.withColumn("__before", F.coalesce(F.sum("__n").over(blocks), F.lit(0)))
                   .join(F.broadcast(starts), "__digit")  # at most 2**width rows
                   .select("__digit", "__block", (F.col("__start") + F.col("__before")).alias("__offset")))
        place = F.row_number().over(Window.partitionBy("__digit", "__block").orderBy("__pos"))
        moved = (now.withColumn("__place", place).join(offsets, ["__digit", "__block"])
                 .withColumn("__pos", (F.col("__offset") + F.col("__place") - 1).cast("long")))
        step = materialize(moved.drop("__digit", "__place", "__offset").withColumn("__block", block), "radix")
        discard(order)
        order = step
    return order.withColumn("rank", (F.col("__pos") + 1).cast("long")).drop("__block", "__pos"), n


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 5,
             min_words: int = 20, buckets: int = 10_000, seed: int = 42, block_rows: int = 1 << 16, width: int = 12) -> DataFrame:
    """One row per document row: doc_id, n_features, weight, score, rank (null where not drawn)."""
    gains = bucket_gains(docs.select(F.col(text_col).cast("string").alias("text")), target.select(F.col("text").cast("string").alias("text")), buckets)
    rows = materialize(scored(docs, gains, seed, id_col, text_col), "scores")
    keep = ["doc_id", "n_features", "weight", "score"]
    ranked, n = radix_ranks(rows.where(F.col("n_words") >= min_words).select(*keep), block_rows, width)
    drawn = percent * n // 100
    out = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return (out.unionByName(rows.where(F.col("n_words") < min_words).select(*keep, F.lit(None).cast("long").alias("rank")))
            .withColumnRenamed("doc_id", id_col))


def drawn(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 5,
          min_words: int = 20, buckets: int = 10_000, seed: int = 42) -> DataFrame:
    """The drawn rows with all their columns: those whose key lies before the last drawn one's, and of the rows that share
    the last one's key as many as were drawn."""
    gains = bucket_gains(docs.select(F.col(text_col).cast("string").alias("text")), target.select(F.col("text").cast("string").alias("text")), buckets)
    rows = scored(docs, gains, seed, id_col, text_col, carry=True).where(F.col("n_words") >= min_words)
    stored = materialize(rows.select("doc_id", "n_features", "score"), "scores")
    ranked, n = radix_ranks(stored)
    last = ranked.where(F.col("rank") == percent * n // 100).first()
    if last is None:
        return docs.limit(0)
    key = [(-F.col("score"), -last["score"]), (F.col("doc_id").isNull().cast("int"), int(last["doc_id"] is None)),
           (F.coalesce(F.col("doc_id"), F.lit(0).cast("long")), last["doc_id"] or 0), (F.col("n_features"), last["n_features"])]
    before, same = F.lit(False), F.lit(True)
    for c, v in key:
        before, same = before | (same & (c < F.lit(v))), same & (c == F.lit(v))
    first = ranked.where(same).agg(F.min("rank")).first()[0]
    tied = rows.where(same).withColumn("__at", F.row_number().over(Window.partitionBy("score").orderBy(F.xxhash64("__row"))))
    return (rows.where(before).select("__row.*")
            .unionByName(tied.where(F.col("__at") <= last["rank"] - first + 1).select("__row.*")))
