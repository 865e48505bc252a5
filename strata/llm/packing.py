"""Packing token ids into fixed-length sequences along a space-filling curve.

Each document (its ids and one end id) becomes a hashed vector: token ids fall into
``BINS`` bins by hash, counts are square-rooted and scaled to length 1, and a fixed random
projection gives ``DIMS`` numbers.  Every dimension is cut at its corpus quantiles, the cell's
Hilbert index is the sort key, and rows are range-partitioned and sorted by it (ties by a hash
of the row).  Neighbours along the curve are laid end to end as one token stream over all partitions
(partition totals are summed up first), cut every ``length`` ids.  So only the very last sequence can
need padding, unless its size is a power of two.

Defined cases: null or empty text is the end id alone; a null id stays null; repeated
rows are packed each; ``doc_tokens`` counts the row's own ids; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import byte_slices, discard, materialize, tidy, utf8

BINS, DIMS, BITS = 256, 4, 8


def _projection() -> np.ndarray:
    return np.random.default_rng(20).standard_normal((BINS, DIMS))


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index along the Hilbert curve of each row of cell numbers (n x dims, each below 2**bits)."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        q = 1 << level
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(high, q - 1, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] & (1 << level), (1 << level) - 1, 0)
    x ^= flip
    out = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            out = (out << 1) | ((x[i] >> level) & 1)
    return out


def tokenizer(path: str, end_id: int, slice_bytes: int, cache_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from strata.llm.tokens import encoder
        enc = encoder(path, cache_words)
        end = np.array([end_id], enc.dtype).tobytes()
        bins = ((np.arange(max(enc.size, end_id + 1), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)).astype(np.int64)
        project = _projection()
        for batch in batches:
            for part in byte_slices(batch, "text", slice_bytes):
                ids = [i + end for i in enc.ids(utf8(part, "text"))]
                sizes = np.fromiter((len(i) // enc.dtype.itemsize for i in ids), np.int64, len(ids))
                flat = np.frombuffer(b"".join(ids), enc.dtype)
                cell = np.repeat(np.arange(len(ids)), sizes) * BINS + bins[flat]
                vec = np.sqrt(np.bincount(cell, minlength=len(ids) * BINS).reshape(-1, BINS))
                vec /= np.sqrt((vec ** 2).sum(1, keepdims=True))
                place = vec @ project
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(ids, pa.binary()), pa.array(sizes),
                     *(pa.array(place[:, d]) for d in range(DIMS))],
                    names=["doc_id", "ids", "n", *(f"p{d}" for d in range(DIMS))])

    return tidy(run)


def curve_keys(cuts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.stack([batch.column(f"p{d}").to_numpy() for d in range(DIMS)], 1)
            cells = np.stack([np.searchsorted(cuts[d], place[:, d], side="right") for d in range(DIMS)], 1)
            key = pa.array(hilbert(cells, BITS) if len(cells) else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), batch.column("n"), key],
                                             names=["doc_id", "ids", "n", "curve"])

    return tidy(run)


def running_start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add each row's place in its partition's stream."""
    before = 0
    for batch in batches:
        n = batch.column("n").to_numpy()
        ends = before + np.cumsum(n)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), batch.column("n"),
                                          pa.array(ends - n)], names=["doc_id", "ids", "n", "start"])
        before = int(ends[-1]) if len(ends) else before


def cutter(length: int, wide: bool, with_ids: bool):
    """Rows (doc_id, ids, n, at: place in the whole stream) to pieces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = np.dtype("<u4") if wide else np.dtype("<u2")
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")}
            for doc, raw, n, at in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "ids", "n", "at"))):
                ids, start = np.frombuffer(raw, dtype).astype("<u4"), 0
                while start < n:
                    seq, offset = divmod(at + start, length)
                    size = min(length - offset, n - start)
                    piece = ids[start:start + size].tobytes()
                    for c, v in zip(out, (doc, start, size, zlib.crc32(piece), n, seq, offset, piece if with_ids else None)):
                        out[c].append(v)
                    start += size
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, pa.binary() if c == "ids" else pa.int64()) for c, v in out.items()], names=list(out))

    return tidy(run)


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2,
         length: int = 4096, slice_bytes: int = 1 << 20, cache_words: int = 300_000, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids
    (little-endian unsigned 32-bit, null without ``with_ids``)."""
    from strata.llm.tokens import Encoder
    spark = docs.sparkSession
    wide = max(Encoder(tokenizer_path).size, end_id + 1) > 0xFFFF
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    places = ", ".join(f"p{d} double" for d in range(DIMS))
    encoded = materialize(rows.mapInArrow(tokenizer(tokenizer_path, end_id, slice_bytes, cache_words),
                                          f"doc_id long, ids binary, n long, {places}"), "pack-ids", "zstd")
    shares = [i / (1 << BITS) for i in range(1, 1 << BITS)]
    quantiles = encoded.agg(*[F.percentile_approx(f"p{d}", shares, 10_000) for d in range(DIMS)]).first()
    cuts = np.array([q if q is not None else [0.0] * len(shares) for q in quantiles])
    ordered = (encoded.mapInArrow(curve_keys(cuts), "doc_id long, ids binary, n long, curve long")
               .withColumn("tie", F.xxhash64("doc_id", "n", F.crc32("ids")))
               .repartitionByRange("curve", "tie").sortWithinPartitions("curve", "tie"))
    laid = materialize(ordered.select("doc_id", "ids", "n")
                       .mapInArrow(running_start, "doc_id long, ids binary, n long, start long")
                       .withColumn("part", F.spark_partition_id()), "pack-laid", "zstd")
    discard(encoded)
    totals = laid.groupBy("part").agg(F.sum("n").alias("tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    bases = totals.select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    return (laid.join(bases, "part").select("doc_id", "ids", "n", (F.col("start") + F.col("base")).alias("at"))
            .mapInArrow(cutter(length, wide, with_ids),
                        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
                        "offset long, ids binary"))
