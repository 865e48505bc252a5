"""Quality rules: base counts and a log-likelihood ratio of hashed n-grams.

Words and word pairs are hashed into ``buckets``.  Two multinomials over the buckets are
counted: the trusted target (every row labelled quality 1, met by a join with the labels) and the raw corpus (every
document).  A document's score is its log-likelihood ratio per n-gram, smoothed by one
count per bucket share.  Trusted rows are dealt to ``folds`` by hash of their id, and each is scored by counts
that leave out its fold, here and in the result: a row is never scored by what it taught.  The threshold is the exact ``floor``
quantile of the scores of all trusted rows that pass the base rules, found by their ranks: about that share of good texts is
lost, in a small corpus as in a large one, and every document is decided the same way on every run.  Only the bounded
bucket counts and the threshold's two scores reach the driver.

Defined cases: null or empty text has no words: all counts 0, base_failed, score 0, not kept.
A null id is never trusted.  Repeated rows are scored each, labels of one id that
differ make it untrusted.  Without trusted rows the ratio is 0 and nothing fails by it.
Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import byte_slices, materialize, utf8
from strata.operators.keys import assign_dense

#: Characters counted as symbols (fixed value).
SYMBOLS = b"#*$%&|<>"
BASE_SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
               "n_repeat_words long, score double, own_score double")


def _buckets(words, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of every word and every pair of words."""
    pairs, at = words.windows(2)
    h = np.concatenate([words.hash, pairs])
    return (h % np.uint64(buckets)).astype(np.int64), np.concatenate([words.doc, words.doc[at]])


def _repeated(words) -> np.ndarray:
    """Per text: words that lie in a 3-word window found at least twice in the text."""
    tri, at = words.windows(3)
    covered = np.zeros(len(words.hash), bool)
    if len(tri):
        doc = words.doc[at].astype(np.uint64)
        from strata.llm.wordblocks import mix64
        order = np.argsort(key := mix64(tri + doc * np.uint64(0x9E3779B97F4A7C15)), kind="stable")
        same = np.zeros(len(key), bool)
        eq = key[order[1:]] == key[order[:-1]]
        same[order[1:]] |= eq
        same[order[:-1]] |= eq
        for j in range(3):
            covered[at[same] + j] = True
    return np.bincount(words.doc[covered], minlength=words.n_texts)


def _dup_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def _sums(mask: np.ndarray, words) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask)])
    return total[words.text_start[1:]] - total[words.text_start[:-1]]


def ngram_counter(folds: int, buckets: int, slice_bytes: int):
    """Counts of the buckets in the texts of each fold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from strata.llm.wordblocks import Words
        of_fold = np.zeros(buckets * folds, np.int64)
        for batch in batches:
            for part in byte_slices(batch, "text", slice_bytes):
                bucket, doc = _buckets(Words(utf8(part, "text")), buckets)
                of_fold += np.bincount(bucket * folds + part.column("fold").to_numpy()[doc], minlength=len(of_fold))
        of_fold = of_fold.reshape(buckets, folds)
        at = np.flatnonzero(of_fold.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(of_fold[at, f]) for f in range(folds))],
                                         names=["bucket", *(f"n{f}" for f in range(folds))])

    return run


def bucket_counts(rows: DataFrame, folds: int, buckets: int, slice_bytes: int) -> np.ndarray:
    """folds x buckets (bounded by the parameters), summed over all ``rows`` (text, fold)."""
    parts = [f"n{f}" for f in range(folds)]
    counts = (rows.select("text", "fold").mapInArrow(ngram_counter(folds, buckets, slice_bytes), ", ".join(f"{c} long" for c in ["bucket", *parts]))
              .groupBy("bucket").agg(*[F.sum(c).alias(c) for c in parts]).toArrow())
    out = np.zeros((folds, buckets))
    for f, c in enumerate(parts):
        out[f, counts["bucket"].to_numpy()] = counts[c].to_numpy()
    return out


def scorer(ratios: np.ndarray, slice_bytes: int):
    """Base counts and two scores: by the last of ``ratios`` (of all trusted rows), and by that without the row's fold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from strata.llm.wordblocks import Words
        symbol = np.zeros(256, bool)
        symbol[list(SYMBOLS)] = True
        for batch in batches:
            for part in byte_slices(batch, "text", slice_bytes):
                texts = utf8(part, "text")
                words = Words(texts)
                bucket, doc = _buckets(words, ratios.shape[1])
                fold = part.column("fold").to_numpy()
                grams = np.maximum(np.bincount(doc, minlength=len(texts)), 1)
                total, own = (np.bincount(doc, ratios[row, bucket], minlength=len(texts)) for row in (-1, fold[doc]))
                inside = np.zeros(len(words.data) + 1, np.int8)
                inside[words.start] = 1
                inside[words.end] -= 1
                chars = np.cumsum(inside[:-1], dtype=np.int8).astype(bool) & ((words.data & 0xC0) != 0x80)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(np.asarray(x, np.int64)) for x in (
                        words.counts(), _sums(chars, words), _sums(symbol[words.data], words),
                        [_dup_lines(t) for t in texts], _repeated(words))),
                     pa.array(total / grams), pa.array(own / grams)],
                    names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score", "own_score"])

    return run


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Every id labelled quality 1 and nothing else, once."""
    return (labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
            .agg(F.min("quality").alias("__q")).where(F.col("__q") == 1).select("doc_id"))


def exact_quantile(rows: DataFrame, column: str, share: float) -> float | None:
    """The quantile of a column without nulls, between two neighbours in proportion (none without rows): the rows are
    ranked over all partitions and two of them read."""
    ranked = assign_dense(rows.select(column), [column], "__rank")
    n = ranked.count()
    if not n:
        return None
    place = share * (n - 1)
    lo, hi = int(np.floor(place)), int(np.ceil(place))
    at = {r["__rank"] - 1: r[column] for r in ranked.where(F.col("__rank").isin(lo + 1, hi + 1)).collect()}
    return at[lo] if lo == hi else (hi - place) * at[lo] + (place - lo) * at[hi]


def log_ratio(target: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Of trusted counts over the corpus; the target is shrunk to the corpus: a bucket it has hardly seen says little."""
    shrunk = target + share * len(share)
    return np.log(shrunk / shrunk.sum()) - np.log(share)


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            buckets: int = 1 << 16, folds: int = 5, floor: float = 0.002,
            min_words: int = 50, max_repeat: float = 0.5, slice_bytes: int = 1 << 20) -> DataFrame:
    doc_id = F.col(id_col).cast("long")
    fold = F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0)).cast("long")
    rows = docs.select(doc_id.alias("doc_id"), F.col(text_col).cast("string").alias("text"), fold.alias("fold"))
    trusted = trusted_ids(labels)
    # dealt by id at every size, so that the labels are never held whole; the texts are not sorted for it
    own_rows = lambda side: side.join(trusted.hint("shuffle_hash"), "doc_id", "left_semi")
    raw = 1 + bucket_counts(rows.withColumn("fold", F.lit(0).cast("long")), 1, buckets, slice_bytes)[0]  # one count each as smoothing
    of_fold = bucket_counts(own_rows(rows), folds, buckets, slice_bytes)
    share = raw / raw.sum()
    any_trusted = trusted.limit(1).count() > 0
    ratios = np.array([log_ratio(of_fold.sum(0) - left, share) for left in [*of_fold, 0]]) if any_trusted else np.zeros((folds + 1, buckets))
    failed = ((F.col("n_words") < min_words)
              | (100 * F.col("n_repeat_words") > 100 * max_repeat * F.col("n_words")))
    # counts and scores without texts, so that they are found once and the labels meet narrow rows
    scored = materialize(rows.mapInArrow(scorer(ratios, slice_bytes), BASE_SCHEMA), "quality").withColumn("base_failed", failed)
    own = own_rows(scored).where(~F.col("base_failed"))
    low = exact_quantile(own, "own_score", floor) if any_trusted else None
    threshold = -np.inf if low is None else float(low)
    marked = scored.join(trusted.select(F.col("doc_id").alias("__trusted")).hint("shuffle_hash"), F.col("doc_id") == F.col("__trusted"), "left")
    score = F.when(F.col("__trusted").isNotNull(), F.col("own_score")).otherwise(F.col("score"))
    return (marked.withColumn("score", score).drop("own_score", "__trusted")
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score", "base_failed",
                    (~F.col("base_failed") & (F.col("score") >= F.lit(threshold))).alias("kept")))
