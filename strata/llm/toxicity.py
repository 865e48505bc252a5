"""Toxicity scores from the nearest labelled examples (exact TF-IDF cosine).

The examples are labelled rows that are not held out, ``max_examples`` at most (the smallest by
hash of their id: a documented bound of the labelled sample); equal texts make one example with
their mean label.  Every word of every example and of every scored text is a term.  A term weighs
(1 + log tf) * idf * lift.  idf is log(1 + documents / max(df, m)): df is counted over all documents, and m is the
least power of two that no more than ``idf_words`` words reach, so the idf of rarer words saturates
there and none is left out.  lift is at least 1: the square of the rate of label 1 among the
term's examples, shrunk to the rate of all examples by ``lift_prior`` of them, over that rate.

Every text, whole, is a query over all examples: terms of few examples by their postings, common ones only in
examples whose block maxima allow them among the k nearest (``BlockMaxIndex``).  So the k nearest are exact.  Votes are weighted by
1 / (distance + eps) and shrunk to the labels' rate by ``prior_weight`` votes; a text that shares no term
with an example gets that rate.  Evidence: the nearest example ids with their cosines.  Ties go to
the smaller text digest.  Terms are told apart by a 64-bit hash.

Defined cases: null or empty text gets the base rate.  Null ids or labels are no examples; an id
with several labels has their mean.  Without examples every score is 0.
Repeated rows are scored each; extra columns are ignored (``carry`` names those to keep); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import byte_slices, discard, materialize, text_or_empty, tidy, utf8

_LETTERS = bytes(b + 32 if 65 <= b <= 90 else (b if b > 127 or 97 <= b <= 122 else 32) for b in range(256))
FLUSH = 400_000


def terms_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms (hashes of runs of letters, any byte beyond ASCII counts as one, A-Z lower-cased) of each
    text: text number, term, times; by text and term."""
    from strata.llm.wordblocks import Words
    words = Words([t.translate(_LETTERS) for t in texts])
    order = np.argsort(words.hash)
    order = order[np.argsort(words.doc[order], kind="stable")]
    doc, term = words.doc[order], words.hash[order]
    new = np.flatnonzero(np.concatenate([[True], (np.diff(doc) != 0) | (term[1:] != term[:-1])])) if len(doc) else np.empty(0, int)
    return doc[new], term[new], np.diff(np.concatenate([new, [len(doc)]]))


def frequency_counter(slice_bytes: int):
    """(terms, counts): in how many of the texts each term occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def merged() -> pa.RecordBatch:
            terms = np.concatenate([h[0] for h in held])
            order = np.argsort(terms)
            terms, counts = terms[order], np.concatenate([h[1] for h in held])[order]
            first = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]]))
            terms, counts = terms[first], np.add.reduceat(counts, first)
            cut = range(0, len(terms), 50_000)
            return pa.RecordBatch.from_arrays(
                [pa.array([terms[i:i + 50_000].view(np.int64) for i in cut], pa.list_(pa.int64())),
                 pa.array([counts[i:i + 50_000] for i in cut], pa.list_(pa.int64()))], names=["terms", "counts"])

        for batch in batches:
            for part in byte_slices(batch, "text", slice_bytes):
                terms, counts = np.unique(terms_of(utf8(part, "text"))[1], return_counts=True)
                if len(terms):
                    held.append((terms, counts))
                    size += len(terms)
                if size > 4 * FLUSH:
                    yield merged()
                    held, size = [], 0
        if held:
            yield merged()

    return tidy(run)


class BlockMaxIndex:
    """Unit vectors by term; exact k nearest by cosine.  Postings hold an example and a number into ``values`` (a table of
    the distinct parts of weights); a weight is ``values[code] * scale[term] / norm[example]``.

    Terms of more than a share ``dense`` of the vectors are common: their postings are also rows of a matrix whose
    examples lie in blocks of ``block``, like beside like (``arrange``).  A query sums its other terms over their
    postings; the largest weight of each common term in a block then bounds what the block's examples can gain.
    Only examples whose bound reaches the k-th cosine found so far are summed over the common terms; queries whose bounds leave
    more than a share ``LOOSE`` of the examples are summed over all of them at once.  Cosines end in double precision."""

    MARGIN = 1e-4  # for rounding: bounds are summed in single precision
    LOOSE = 0.05
    kind = np.float32  # of the postings' weights

    def __init__(self, vectors: list[dict[int, float]], n_terms: int, block: int = 16):
        triples = [(e, t, w) for e, v in enumerate(vectors) for t, w in v.items()]
        e, t, w = (np.array(x) for x in zip(*triples)) if triples else (np.empty(0), np.empty(0), np.empty(0))
        order = np.lexsort((e, t))
        values, code = np.unique(w[order].astype(float), return_inverse=True)
        self._fill(np.searchsorted(t[order], np.arange(n_terms + 1)), e[order].astype(np.int32), code, values,
                   np.ones(n_terms), np.ones(len(vectors)), block)
        self.kind = np.float64

    @classmethod
    def of(cls, cut: np.ndarray, example: np.ndarray, code: np.ndarray, values: np.ndarray, scale: np.ndarray,
           norm: np.ndarray, block: int = 16) -> "BlockMaxIndex":
        """Of postings by term: those of term t are from ``cut[t]`` to ``cut[t + 1]``."""
        out = cls.__new__(cls)
        out._fill(cut, example, code, values, scale, norm, block)
        return out

    def _fill(self, cut, example, code, values, scale, norm, block, dense: float = 0.1):
        self.cut, self.code, self.values, self.scale = cut, code, values, scale
        n_terms, self.n, self.block = len(cut) - 1, len(norm), block
        self.common = np.flatnonzero(np.diff(cut) > max(dense * self.n, 64))
        self.column = np.full(n_terms, -1, np.int32)
        self.column[self.common] = np.arange(len(self.common))
        # place -> example; postings hold places from here on
        self.order = self.arrange(example, norm)
        place = np.empty(self.n, example.dtype)
        place[self.order] = np.arange(self.n)
        self.example = place[example] if len(example) else example
        self.unit = 1 / norm[self.order]
        self.starts = np.arange(0, self.n, self.block)
        self._matrix = self._most = self._weight = None

    def _common_weights(self, c: int, example: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = slice(self.cut[self.common[c]], self.cut[self.common[c] + 1])
        return example[at], (self.values[self.code[at]] * self.scale[self.common[c]] * unit[example[at]]).astype(np.float32)

    def arrange(self, example: np.ndarray, norm: np.ndarray, rounds: int = 4, chunk: int = 1024) -> np.ndarray:
        """Examples in clusters (k-means of their common terms, from evenly spaced examples), in chunks."""
        k, width = min(256, self.n // 64), len(self.common)
        if k < 2 or not width:
            return np.arange(self.n)
        own = [self._common_weights(c, example, 1 / norm) for c in range(width)]
        at = np.concatenate([o[0] for o in own])
        by_example = np.argsort(at, kind="stable")
        column = np.repeat(np.arange(width, dtype=np.int32), [len(o[0]) for o in own])[by_example]
        weight = np.concatenate([o[1] for o in own])[by_example]
        at = at[by_example].astype(np.int32)
        del own, by_example

        def rows(lo: int, hi: int) -> np.ndarray:
            m, (i, j) = np.zeros((hi - lo, width), np.float32), np.searchsorted(at, (lo, hi))
            m[at[i:j] - lo, column[i:j]] = weight[i:j]
            return m

        centre = np.concatenate([rows(i, i + 1) for i in np.arange(k) * self.n // k])
        cluster = np.empty(self.n, np.int32)
        for _ in range(rounds):
            total = np.zeros_like(centre)
            unit = centre / np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-9)
            for lo in range(0, self.n, chunk):
                m = rows(lo, min(lo + chunk, self.n))
                cluster[lo:lo + chunk] = (m @ unit.T).argmax(1)
                for c in np.unique(cluster[lo:lo + chunk]):
                    total[c] += m[cluster[lo:lo + chunk] == c].sum(0)
            centre = total
        return np.argsort(cluster, kind="stable")

    def matrix(self) -> np.ndarray:
        """Common terms x places; made where it is used, so that it is not sent along."""
        if self._matrix is None:
            m = np.zeros((len(self.common), self.n), np.float32)
            for c in range(len(self.common)):
                at, w = self._common_weights(c, self.example, self.unit)
                m[c, at] = w
            self._matrix = m
            self._weight = np.empty(len(self.code), self.kind)
            for t in range(0, len(self.scale), 1 << 14):
                at = slice(self.cut[t], self.cut[min(t + (1 << 14), len(self.scale))])
                scale = np.repeat(self.scale[t:t + (1 << 14)], np.diff(self.cut[t:t + (1 << 14) + 1]))
                self._weight[at] = self.values[self.code[at]] * scale * self.unit[self.example[at]]
            self._most = np.maximum.reduceat(m, self.starts, 1)
        return self._matrix

    def __getstate__(self) -> dict:
        """Without what can be made again; sizes and codes in as few bytes as hold them."""
        lost = {"_matrix": None, "_most": None, "_weight": None, "column": None, "starts": None}
        return self.__dict__ | lost | {"cut": _smallest(np.diff(self.cut)), "code": _bytes_of(self.code)}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.cut, self.code = np.append(0, np.cumsum(self.cut, dtype=np.int64)), _codes_of(*self.code)
        self.column = np.full(len(self.cut) - 1, -1, np.int32)
        self.column[self.common] = np.arange(len(self.common))
        self.starts = np.arange(0, self.n, self.block)

    def nearest_all(self, query: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int, k: int) -> list[list[tuple[int, float]]]:
        """For each of ``n`` queries (query number, term, weight, by query) its (example, cosine), best first; ties to the
        smaller example number; cosine above 0 only."""
        if not self.n:
            return [[] for _ in range(n)]
        self.matrix()
        column = self.column[term]
        wide = column >= 0
        q = np.zeros((n, len(self.common)))
        q[query[wide], column[wide]] = weight[wide]
        gain = q.astype(np.float32) @ self._most
        query, term, weight = query[~wide], term[~wide], weight[~wide]
        first = np.searchsorted(query, np.arange(n + 1))
        lo, hi = self.cut[term], self.cut[term + 1]
        out, loose = [], {}
        for i in range(n):
            at = slice(first[i], first[i + 1])
            rest = self._sum(lo[at], hi[at], weight[at])
            hit = self._candidates(gain[i], q[i], rest, k)
            if len(hit) > self.n * self.LOOSE:
                loose[i] = rest
            out.append([] if i in loose else self._ranked(hit, q[i], rest, k))
        rows = list(loose)
        for j in range(0, len(rows), 64):
            part = rows[j:j + 64]
            for i, near in zip(part, q[part].astype(np.float32) @ self._matrix):
                near = near + loose[i]
                tops = np.maximum.reduceat(near, self.starts)
                least = np.partition(tops, len(tops) - k)[len(tops) - k] if len(tops) > k else 0.0
                out[i] = self._ranked(np.flatnonzero((near > 0) & (near >= least - self.MARGIN)), q[i], loose[i], k)
        return out

    def _sum(self, lo: np.ndarray, hi: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """What the postings in these ranges add to the places."""
        if not len(lo):
            return np.zeros(self.n)
        ranges = list(zip(lo.tolist(), hi.tolist()))
        w = np.concatenate([self._weight[i:j] for i, j in ranges]) * np.repeat(weight, hi - lo)
        return np.bincount(np.concatenate([self.example[i:j] for i, j in ranges]), w, self.n)

    def _cosines(self, hit: np.ndarray, on: np.ndarray, q: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """Of the places ``hit``, with the common terms ``on`` and their weights; as exact as the weights' type."""
        return rest[hit] + (q @ self._matrix[np.ix_(on, hit)] if len(on) else 0)

    def _candidates(self, gain: np.ndarray, q: np.ndarray, rest: np.ndarray, k: int) -> np.ndarray:
        """Places whose bound reaches the k-th cosine of the blocks with the highest bounds."""
        bound = rest + np.repeat(gain, self.block)[:self.n]
        tops = np.maximum.reduceat(bound, self.starts)
        few = min(len(tops), max(1, 4 * k // self.block))
        blocks = np.argpartition(tops, len(tops) - few)[len(tops) - few:]
        place = (blocks[:, None] * self.block + np.arange(self.block)).ravel()
        hit = place[place < self.n]
        on = np.flatnonzero(q)
        own = q[on].astype(np.float32)
        for _ in range(2):  # once more with the highest bounds that the first blocks leave
            score = self._cosines(hit, on, own, rest)
            least = np.partition(score, len(score) - k)[len(score) - k] if len(score) >= k else 0.0
            left = np.flatnonzero(bound >= max(least - self.MARGIN, 1e-300))
            if len(left) <= 16 * k:
                break
            hit = left[np.argpartition(bound[left], len(left) - 8 * k)[len(left) - 8 * k:]]
        return left

    def _ranked(self, hit: np.ndarray, q: np.ndarray, rest: np.ndarray, k: int) -> list[tuple[int, float]]:
        on = np.flatnonzero(q)
        if len(hit) > 4 * k:
            score = self._cosines(hit, on, q[on].astype(np.float32), rest)
            hit = hit[score >= np.partition(score, len(score) - k)[len(score) - k] - self.MARGIN]
        ranked = sorted((-round(float(s), 12), int(e)) for s, e in zip(self._cosines(hit, on, q[on], rest), self.order[hit]) if s > 0)
        return [(e, -s) for s, e in ranked[:k]]

    def nearest(self, query: dict[int, float], k: int) -> list[tuple[int, float]]:
        """``nearest_all`` of one query."""
        terms = sorted(query)
        return self.nearest_all(np.zeros(len(terms), np.int64), np.array(terms, np.int64),
                                np.array([query[t] for t in terms], float), 1, k)[0]


def _smallest(v: np.ndarray) -> np.ndarray:
    return v.astype(np.min_scalar_type(v.max(initial=0)))


def _bytes_of(code: np.ndarray) -> tuple:
    """Codes by their low bytes, and the few above 255 by place."""
    if code.itemsize == 1:
        return code, None, None
    at = np.flatnonzero(code > 255)
    return code.astype(np.uint8), _smallest(at), code[at]


def _codes_of(low: np.ndarray, at: np.ndarray | None, own: np.ndarray | None) -> np.ndarray:
    if at is None:
        return low
    code = low.astype(own.dtype)
    code[at] = own
    return code


class Model:
    """Term weights, index and votes; what tasks receive by broadcast (bounded by the parameters and the examples)."""

    def __init__(self, keys: np.ndarray, weight: np.ndarray, rare: float, number: np.ndarray, ids: np.ndarray, labels: np.ndarray,
                 index: BlockMaxIndex, k: int, prior_weight: float, eps: float = 0.05):
        # known terms in order, their weights, and their numbers in the index (-1: in no example)
        self.keys, self.weight, self.rare, self.number = keys, weight, rare, number
        self.ids, self.labels, self.index = ids, labels, index
        self.k, self.prior_weight, self.eps = k, prior_weight, eps
        self.rate = float(labels.sum()) / (len(labels) + 1)

    def __getstate__(self) -> dict:
        """Index numbers go as one bit a term (they count the known ones in order), and scales that are those terms' weights not at all."""
        known, index = self.number >= 0, self.index.__getstate__()
        if np.array_equal(self.number[known], np.arange(known.sum())) and np.array_equal(self.weight[known], self.index.scale):
            return self.__dict__ | {"number": np.packbits(known), "index": index | {"scale": None}}
        return self.__dict__ | {"index": index}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.index = BlockMaxIndex.__new__(BlockMaxIndex)
        if state["index"]["scale"] is None:
            known = np.unpackbits(self.number, count=len(self.keys)).astype(bool)
            self.number = np.where(known, np.cumsum(known, dtype=np.int32) - 1, np.int32(-1))
            state["index"]["scale"] = self.weight[known]
        self.index.__setstate__(state["index"])

    def score_all(self, texts: list[bytes], group: int = 256) -> list[tuple[float, list[tuple[int, float]]]]:
        doc, term, tf = terms_of(texts)
        at = np.minimum(np.searchsorted(self.keys, term), max(len(self.keys) - 1, 0))
        hit = self.keys[at] == term if len(self.keys) else np.zeros(len(term), bool)
        w = 1 + np.log(tf)
        w[hit] *= self.weight[at[hit]]
        w[~hit] *= self.rare
        w /= np.sqrt(np.bincount(doc, w * w, len(texts)))[doc]
        number = np.full(len(term), -1, np.int64)
        number[hit] = self.number[at[hit]]
        doc, w, number = doc[number >= 0], w[number >= 0], number[number >= 0]
        out = []
        for i in range(0, len(texts), group):
            n = min(group, len(texts) - i)
            lo, hi = np.searchsorted(doc, (i, i + n))
            for near in self.index.nearest_all(doc[lo:hi] - i, number[lo:hi], w[lo:hi], n, self.k):
                weights = [1 / (max(1 - c, 0) + self.eps) for _, c in near]
                votes = sum(v * self.labels[e] for (e, _), v in zip(near, weights))
                # prior_weight votes at cosine 0
                pull = self.prior_weight / (1 + self.eps)
                out.append((float((votes + pull * self.rate) / (sum(weights) + pull)), [(int(self.ids[e]), c) for e, c in near[:3]]))
        return out


def held_out(id_col: Column, folds: int, fold: int) -> Column:
    """crc32 of the id as text, modulo ``folds``, equals ``fold``; a null id is not held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == fold, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, folds: int, fold: int, max_examples: int,
        idf_words: int, lift_prior: float, k: int, prior_weight: float, slice_bytes: int) -> Model:
    spark = docs.sparkSession
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
             .where(~held_out(F.col("doc_id"), folds, fold)).groupBy("doc_id")
             .agg(F.avg(F.col("toxic").cast("double")).alias("label")))
    ids = spark.createDataFrame(known.select(F.col("doc_id").cast("long").alias("doc_id"), "label")
                                .orderBy(F.xxhash64(known["doc_id"]), "doc_id").limit(max_examples).toArrow())
    text = text_or_empty(F.col(text_col))
    sample = materialize(docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
                         .join(F.broadcast(ids), "doc_id").groupBy(F.md5("text").alias("md5"))
                         .agg(F.min("doc_id").alias("doc_id"), F.first("text").alias("text"), F.avg("label").alias("label")), "toxic-examples")
    examples = sample.select("md5", "doc_id", "label").orderBy("md5").toArrow()  # max_examples rows at most
    numbers = spark.createDataFrame(pa.table({"md5": examples["md5"], "number": pa.array(np.arange(len(examples)), pa.int32())}))
    segments = sample.join(F.broadcast(numbers), "md5").select("number", "text").mapInArrow(
        segmenter(slice_bytes), "part int, terms array<long>, numbers array<int>, times array<int>")
    postings = _postings(segments.groupBy("part").applyInArrow(merge_segments, MERGED).toArrow(), len(examples))
    labelled = examples["doc_id"].to_numpy(), examples["label"].to_numpy().astype(float)
    del examples, numbers, segments
    discard(sample)

    # document frequencies over all documents; those of the commoner words go along, the others saturate
    n_docs = docs.count()
    pairs = (docs.select(text.alias("text")).mapInArrow(frequency_counter(slice_bytes), "terms array<long>, counts array<long>")
             .select(F.explode(F.arrays_zip("terms", "counts")).alias("z")))
    frequency = materialize(pairs.groupBy(F.col("z.terms").alias("term")).agg(F.sum("z.counts").alias("df")), "toxic-df")
    digits = np.zeros(64, np.int64)
    for r in frequency.groupBy(F.length(F.bin("df")).alias("digits")).count().collect():
        digits[r["digits"]] = r["count"]
    reached = digits[::-1].cumsum()[::-1][1:]  # words of at least 2 ** i documents
    least = 1 << next(i for i in range(48) if reached[i] <= idf_words or i == 47)
    common = frequency.where(F.col("df") >= least).select("term", F.col("df").cast("int" if n_docs < 1 << 31 else "long").alias("df")).toArrow()
    discard(frequency)
    found, df = common["term"].to_numpy().astype(np.int64, copy=False).view(np.uint64), common["df"].to_numpy()
    del common
    return _model(*labelled, *postings, found, df, n_docs, least, lift_prior, k, prior_weight)


MERGED = "terms binary, sizes binary, numbers binary, times binary, kinds string"
PARTS = 64


def segmenter(slice_bytes: int):
    """Postings of a slice of the examples, in ``PARTS`` parts by term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in byte_slices(batch, "text", slice_bytes):
                doc, term, times = terms_of(utf8(piece, "text"))
                part = (term >> np.uint64(58)).astype(np.int32)
                order = np.argsort(part, kind="stable")
                number = piece.column("number").to_numpy()[doc[order]]
                cuts = pa.array(np.searchsorted(part[order], np.arange(PARTS + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(cuts, pa.array(v)) for v in (term[order].view(np.int64), number.astype(np.int32), times[order].astype(np.int32))]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(PARTS), pa.int32()), *lists], names=["part", "terms", "numbers", "times"])

    return tidy(run)


def merge_segments(rows: pa.Table) -> pa.Table:
    """One part's postings by term and example: terms, their sizes, example numbers and times, as little-endian integers, the last
    three in the smallest (``kinds``) that hold them: all parts go through the driver."""
    term, number, times = (np.concatenate([np.empty(0, t), *[c.flatten().to_numpy() for c in rows[name].chunks]], dtype=t)
                           for name, t in (("terms", np.int64), ("numbers", np.int32), ("times", np.int32)))
    order = np.lexsort((number, term))
    term = term[order]
    first = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else np.empty(0, np.int64)
    sizes = np.diff(np.append(first, len(term)))
    small = [v.astype(np.min_scalar_type(v.max(initial=0))) for v in (sizes, number[order], times[order])]
    return pa.table([pa.array([v.tobytes()], pa.binary()) for v in [term[first], *small]] + [pa.array([",".join(v.dtype.str for v in small)])],
                    names=["terms", "sizes", "numbers", "times", "kinds"])


def _postings(merged: pa.Table, n: int):
    """Terms, and by term the cuts, examples and times (numbers into their distinct values), in the smallest integers
    that hold them: the driver keeps all examples' postings."""
    kinds = [k.split(",") for k in merged["kinds"].to_pylist()]
    get = lambda name, kind: [np.frombuffer(b.as_buffer(), kind(i)) for i, b in enumerate(b for c in merged[name].chunks for b in c)]
    terms = get("terms", lambda i: np.uint64)
    sizes, numbers, times = (get(name, lambda i, j=j: kinds[i][j]) for j, name in enumerate(("sizes", "numbers", "times")))
    order = np.argsort([t[0] if len(t) else 0 for t in terms], kind="stable")  # parts come in any order
    distinct = np.unique(np.concatenate([np.empty(0, np.int32), *map(np.unique, times)]))

    def joined(parts: list[np.ndarray], dtype, of=lambda part: part) -> np.ndarray:
        """The parts in order, one after the other in one array."""
        out, at = np.empty(sum(map(len, parts)), dtype), 0
        for i in order:
            out[at:at + len(parts[i])] = of(parts[i])
            at += len(parts[i])
        return out

    code = np.min_scalar_type(max(len(distinct), 1))
    return (joined(terms, np.uint64), np.append(0, np.cumsum(joined(sizes, np.int64))), joined(numbers, np.min_scalar_type(max(n, 1))),
            joined(times, code, lambda part: np.searchsorted(distinct, part)), 1 + np.log(distinct.astype(float)))


def _model(ids, labels, vocabulary, cut, example, code, values, found: np.ndarray, df: np.ndarray, n_docs: int, least: int,
           lift_prior: float, k: int, prior_weight: float, chunk: int = 1 << 14) -> Model:
    place = np.minimum(np.searchsorted(vocabulary, found), max(len(vocabulary) - 1, 0))
    keys = np.concatenate([vocabulary, found[vocabulary[place] != found] if len(vocabulary) else found])
    del place
    keys.sort()
    weight = np.full(len(keys), least, np.float64)  # the frequencies at first
    weight[np.searchsorted(keys, found)] = df
    del found, df
    np.divide(n_docs, weight, out=weight)
    weight += 1
    np.log(weight, out=weight)
    number = np.full(len(keys), -1, np.int32)
    at = np.searchsorted(keys, vocabulary)
    number[at] = np.arange(len(vocabulary))
    share = labels.mean() if len(labels) else 0.0
    square = np.zeros(len(ids))
    for i in range(0, len(vocabulary), chunk):  # by chunks of terms: sums over postings stay small
        terms = slice(i, min(i + chunk, len(vocabulary)))
        own, size = slice(cut[terms.start], cut[terms.stop]), np.diff(cut[terms.start:terms.stop + 1])
        if share > 0:
            toxic = np.add.reduceat(labels[example[own]], cut[terms] - cut[terms.start])
            weight[at[terms]] *= np.maximum(1, (toxic + lift_prior * share) / (size + lift_prior) / share) ** 2
        square += np.bincount(example[own], np.square(values[code[own]] * np.repeat(weight[at[terms]], size)), len(ids))
    index = BlockMaxIndex.of(cut, example, code, values, weight[at], np.sqrt(np.where(square > 0, square, 1)))
    return Model(keys, weight, float(np.log(1 + n_docs / least)), number, ids, labels, index, k, prior_weight)


def scorer(model, slice_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        for batch in batches:
            for part in byte_slices(batch, "text", slice_bytes):
                found = m.score_all(utf8(part, "text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([f[0] for f in found], pa.float64()),
                     pa.array([[{"doc_id": i, "cosine": c} for i, c in f[1]] for f in found],
                              pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64())]))),
                     *([part.column("__row")] if "__row" in part.schema.names else [])],
                    names=["doc_id", "score", "evidence", *(["__row"] if "__row" in part.schema.names else [])])

    return tidy(run)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5,
             fold: int = 0, max_examples: int = 20_000, idf_words: int = 1 << 20, lift_prior: float = 5.0,
             k: int = 16, prior_weight: float = 0.5, slice_bytes: int = 1 << 20, carry: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence array<struct<doc_id, cosine>>, and ``__row``, a struct of the columns in
    ``carry`` (name: column), if given."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(fit(docs, labels, id_col, text_col, folds, fold, max_examples, idf_words,
                                             lift_prior, k, prior_weight, slice_bytes))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(F.col(text_col)).alias("text"),
                       *([F.struct(*[c.alias(name) for name, c in carry.items()]).alias("__row")] if carry else []))
    schema = "doc_id long, score double, evidence array<struct<doc_id long, cosine double>>"
    if carry:
        schema += f", __row {rows.schema['__row'].dataType.simpleString()}"
    out = rows.mapInArrow(scorer(model, slice_bytes), schema)
    out = out.select("doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), "score",
                     (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence", *(["__row"] if carry else []))
    out._model = model  # for callers who know when no plan needs it any more
    return out
