"""Every corpus operator on odd rows (nulls, empty and long texts, ties, repeated rows, clashing names, empty
tables) and against brute force."""

import hashlib
import io
import math
import os
import re
import struct
import zipfile
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [os.getcwd(), os.environ.get("PYTHONPATH", "")]))
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LINE = "This line is longer than forty code points, É é ß."
SCHEMA = "doc_id long, text string, source string, n_chars long, __h string, __doc long, node long, ids string, score double, row string"


@pytest.fixture(scope="module", autouse=True)
def workers_find_the_package(spark):
    spark.sparkContext.environment["PYTHONPATH"] = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def odd_rows():
    base = " ".join(f"word{i}" for i in range(120))
    near = base.replace("word60", "other")
    texts = [None, "", "   \n\t", "one two", base, base.upper(), near, near, "ÄÖ É " + base, "x" * 5000,
             "\n".join([LINE] * 2 + ["short"]), LINE.upper().replace("ß", "SS"), "very long " * 20_000]
    rows = [(i, t, f"s{i % 3}" if i % 5 else None, None) for i, t in enumerate(texts)]
    rows += [(20 + i, f"{LINE}\nown {i}", "s1", 3) for i in range(6)]
    rows += [(4, base, "s1", 1), (4, base, "s1", 1), (None, base, None, None), (None, None, None, None), (3, "another text", "s0", 9)]
    return [r + ("h", 7, 8, "i", 0.5, "r") for r in rows]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, 1, int(i % 2)) for i in range(30)] + [(None, None, None), (3, 0, 1)],
                                 "doc_id long, quality int, toxic int")


def path():
    from strata.llm.queries import tokenizer_path
    return tokenizer_path()


def test_line_dedup(odd, empty):
    from strata.llm.line_dedup import dedup_lines
    got = dedup_lines(odd).collect()
    holders = defaultdict(set)
    for r in odd_rows():
        for line in (r[1] or "").split("\n"):
            key = line.strip(" \t\n\x0b\x0c\r").translate(LOW)
            if len(key) >= 40:
                holders[key].add(r[0])
    newest = {k: max(x for x in v if x is not None) for k, v in holders.items() if len(v) >= 5}
    want = Counter()
    for r in odd_rows():
        lines = (r[1] or "").split("\n")
        keys = [line.strip(" \t\n\x0b\x0c\r").translate(LOW) for line in lines]
        kept = [line for line, k in zip(lines, keys) if k not in newest or newest[k] == r[0]]
        want[(r[0], len(lines), len(lines) - len(kept), "\n".join(kept))] += 1
    assert Counter((r["__row"]["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in got) == want
    assert any(k[2] for k in want)
    assert dedup_lines(empty).count() == 0


def test_hot_lines_take_the_same_verdict(spark):
    from strata.llm.line_dedup import dedup_lines
    docs = spark.createDataFrame([(i, f"{LINE}\n{'own line of this document, long enough ' * 2}{i}") for i in range(400)],
                                 "doc_id long, text string").repartition(4)
    for support in (1e-3, 0.6):  # frequent-items path and the ordinary one
        got = {r["__row"]["doc_id"]: r["n_dropped"] for r in dedup_lines(docs, hot_support=support).collect()}
        assert got == {i: int(i < 399) for i in range(400)}


def test_exact_dedup(odd, empty):
    from strata.llm.exact_dedup import exact_dedup
    got = exact_dedup(odd, carry=True).collect()
    groups = defaultdict(list)
    for r in odd_rows():
        groups[(r[1] or "").translate(LOW)].append(r[0])
    assert len(got) == len(odd_rows())
    kept = Counter()
    for r in got:
        key = (r["__row"]["text"] or "").translate(LOW)
        ids = [i for i in groups[key] if i is not None]
        assert r["keep_id"] == (max(ids) if ids else None) and r["group_size"] == len(groups[key])
        assert r["text_sha256"] == hashlib.sha256(key.encode()).hexdigest()
        kept[key] += r["kept"]
    assert set(kept.values()) == {1}
    assert exact_dedup(empty).count() == 0


def test_frequent_digests_take_the_same_result(spark):
    from strata.llm.exact_dedup import exact_dedup
    docs = spark.createDataFrame([(i, "same" if i % 3 else f"own {i}") for i in range(600)], "doc_id long, text string").repartition(5)
    results = [sorted(map(tuple, exact_dedup(docs, support=s).collect())) for s in (1e-3, 0.9)]
    assert results[0] == results[1] and sum(r[3] for r in results[0]) == 201


def test_token_counts_and_cutting(odd, empty):
    from tokenizers import Tokenizer

    from strata.llm.token_counts import count_tokens
    from strata.llm.tokens import Encoder
    lib = Tokenizer.from_file(path())
    lib.no_truncation()
    lib.no_padding()
    whole = lambda t: lib.encode(t or "", add_special_tokens=False).ids
    got = Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in count_tokens(odd, path()).collect())
    assert got == Counter((r[0], len((r[1] or "").encode()), len(whole(r[1]))) for r in odd_rows())
    assert count_tokens(empty, path()).count() == 0
    texts = ["a<|endoftext|>b <|startoftext|> don't we'll, x.y,,z", "İstanbul ΑΣ ét é 12 3.4 ...", "Hello, HELLO hello.", "q" * 3000]
    enc = Encoder(path(), cache_words=3)
    for _ in range(3):
        assert [np.frombuffer(b, enc.dtype).tolist() for b in enc.ids([t.encode() for t in texts])] == [whole(t) for t in texts]
    # a text longer than a group, words longer than a hash is trusted for, and a cache that is cleared out often
    long = " ".join(f"word{i % 5000} {'x' * (i % 90)}" for i in range(40_000))
    enc = Encoder(path(), cache_words=500)
    for batch in (["a b", long, "", "c d"], ["a b", "", "c"], [long[:2000]]):
        assert [np.frombuffer(b, enc.dtype).tolist() for b in enc.ids([t.encode() for t in batch])] == [whole(t) for t in batch]


def _components(rows, percent=85):
    sets = {}
    for n, r in enumerate(rows):
        words = WORD.findall((r[1] or "").translate(LOW))
        sets[n] = frozenset(tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()
    parent = {n: n for n in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    live = [n for n in sets if sets[n] and rows[n][0] is not None]
    for a in live:
        for b in live:
            if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[root(b)] = root(a)
    smallest = defaultdict(list)
    for n in live:
        smallest[root(n)].append(rows[n][0])
    return {n: (len(sets[n]), min(smallest[root(n)]) if n in live else rows[n][0]) for n in sets}


@pytest.mark.parametrize("limit", [2048, 2])
def test_near_dedup(odd, empty, limit):
    from strata.llm.near_dedup import near_classes
    rows = odd_rows()
    want = Counter((rows[n][0], size, comp, rows[n][0] is None or rows[n][0] == comp) for n, (size, comp) in _components(rows).items())
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_classes(odd, limit=limit).collect())
    assert got == want
    if limit == 2:
        assert near_classes(empty).count() == 0


def test_near_dedup_dense_group(spark):
    """Copies of one text with a few words changed: links exist for some pairs only; nodes larger than the limit branch."""
    from strata.llm.near_dedup import near_classes
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for d in range(90):
        words = list(base)
        for j in rng.choice(150, rng.integers(0, 5), replace=False):
            words[j] = f"c{d}x{j}"
        rows.append((d, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = {rows[n][0]: comp for n, (_, comp) in _components(rows).items()}
    for limit in (1024, 16):
        assert {r["doc_id"]: r["component_id"] for r in near_classes(docs, limit=limit).collect()} == want


def test_near_dedup_second_pass_tests_all_pairs_and_passes_on_a_forest(spark):
    """Vertices of several labels: the links that leave a group are a forest whose components are those of all
    linked pairs; the operator finds the same with blocks of a few sets."""
    from strata.llm.near_dedup import _joining_links, near_classes, sketch
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 62, 200).astype(np.uint64)
    raw = [np.unique(np.concatenate([rng.permutation(base)[:188], rng.integers(0, 1 << 62, 6).astype(np.uint64)])) for _ in range(60)]
    n = np.array([len(s) for s in raw])
    local = np.split(np.unique(np.concatenate(raw), return_inverse=True)[1], np.cumsum(n)[:-1])
    sk = np.stack([sketch(s)[1] for s in raw])
    for percent in (84, 85, 86, 88):
        want = {(a, b) for a in range(60) for b in range(a) if 100 * (c := len(np.intersect1d(raw[a], raw[b]))) >= percent * (n[a] + n[b] - c)}

        def classes(pairs):
            label = np.arange(60)
            for a, b in pairs:
                label[label == label[a]] = label[b]
            return {frozenset(np.flatnonzero(label == x).tolist()) for x in label}

        got = _joining_links(sk, n, np.arange(60), local, percent, percent / 100 - 0.09)
        assert classes(got) == classes(want)
        assert len(got) == 60 - len(classes(got))
    rows = []
    for d in range(80):
        words = [f"w{i}" for i in range(150)]
        for j in rng.choice(150, rng.integers(1, 5), replace=False):
            words[j] = f"c{d}x{j}"
        rows.append((d, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = {rows[k][0]: comp for k, (_, comp) in _components(rows).items()}
    assert {r["doc_id"]: r["component_id"] for r in near_classes(docs, set_limit=1500).collect()} == want


def test_near_dedup_stage_links_from_80_percent(spark, tmp_path):
    """Copies with two scattered words changed in 120 (0.84), and a dense group against brute force at 80."""
    from strata.llm.near_dedup import near_classes
    from strata.llm.stages import near_dedup
    rows = []
    for d in range(60):
        words = [f"w{d}x{j}" for j in range(120)]
        rows.append((2 * d, " ".join(words)))
        words[30] = words[80] = f"changed{d}"
        rows.append((2 * d + 1, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r["doc_id"] for r in near_dedup(spark, docs, str(tmp_path)).collect()} == {2 * d for d in range(60)}
    rng = np.random.default_rng(4)
    rows = []
    for d in range(90):
        words = [f"w{i}" for i in range(150)]
        for j in rng.choice(150, rng.integers(0, 6), replace=False):
            words[j] = f"c{d}x{j}"
        rows.append((d, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = {rows[n][0]: comp for n, (_, comp) in _components(rows, 80).items()}
    got = near_classes(docs, percent=80, trees=8, margin=0.09, limit=16)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == want
    assert {r["doc_id"] for r in near_dedup(spark, docs, str(tmp_path)).collect()} == set(want.values())


def test_components(spark):
    from strata.llm.components import components
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 150), (7, 300)], "a long, b long")
    got = {r["node"]: r["label"] for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(61)}, 300: 0, 100: 100, 150: 100, 200: 100}


def test_lm_gradients_and_base_scores(odd, empty):
    from strata.llm import lm_score as LM
    rng = np.random.default_rng(0)
    m = LM.Attention(6, 4, 5)
    m.p = {k: v.astype(float) for k, v in m.p.items()}
    m.hide = m.hide.astype(float)
    x, y, mask = rng.integers(0, 7, (3, 5)), rng.integers(0, 6, (3, 5)), rng.random((3, 5)) < 0.8
    loss = lambda: -(np.take_along_axis(m.forward(x), y[..., None], 2)[..., 0] * mask).sum() / mask.sum()
    g = m.gradients(x, y, mask)
    for k in m.p:
        for i in list(np.ndindex(m.p[k].shape))[:6]:
            old = m.p[k][i]
            m.p[k][i] = old + 1e-5
            up = loss()
            m.p[k][i] = old - 1e-5
            assert abs((up - loss()) / 2e-5 - g[k][i]) < 1e-6
            m.p[k][i] = old
    fast = m.target_scores(x, y, mask)
    assert np.allclose(fast, np.take_along_axis(m.forward(x), y[..., None], 2)[..., 0][mask], atol=1e-5)
    sizes = np.array([1, 32, 33, 500])
    text, start, number = LM.windows(sizes, 32, 24)
    seen = Counter()
    for t, s, n in zip(text, start, number):
        first, end = int(sizes[:t].sum()), int(sizes[:t + 1].sum())
        seen.update(range(s + (8 if n else 0), min(s + 32, end)))
        assert s >= first
    assert seen == Counter(range(int(sizes.sum())))
    tokens, counts = [], Counter()
    for r in odd_rows():
        t = WORD.findall((r[1] or "").translate(LOW)) + ["\n"]
        held = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 2
        tokens.append((r[0], held, t))
        if not held:
            counts.update(t)
    n, v = sum(counts.values()), len(counts)
    want = Counter((d, h, len(t), sum(counts[w] > 0 for w in t), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t), 4))
                   for d, h, t in tokens)
    got = LM.score_texts(odd, path(), head_words=20).collect()  # most words take the join
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got) == want
    assert all(r["score"] < 0 for r in got)
    assert LM.score_texts(empty, path()).count() == 0


def test_lm_trains_on_every_window():
    """Over the rounds every window of every training text is taken once."""
    import inspect
    from types import SimpleNamespace

    import pyarrow as pa

    from strata.llm import lm_score as LM
    defaults = {k: v.default for k, v in inspect.signature(LM.score_texts).parameters.items()}
    every, rounds = defaults["train_every"], defaults["rounds"]
    assert rounds % every == 0
    rng = np.random.default_rng(2)
    ids = [rng.integers(0, 6, n).astype(np.int32).tobytes() for n in (1, 5, 9, 40, 200)]
    batch = pa.RecordBatch.from_arrays([pa.array([-7, 3, 11, 2**62, 5], pa.int64()), pa.array(ids, pa.binary())], names=["th", "ids"])
    shared = SimpleNamespace(value={"classes": 6, "dim": 4, "window": 8, "stride": 6, "dtype": np.dtype(np.int32),
                                    "class_of": np.arange(6), "flat": LM.Attention(6, 4, 8).flat()})
    weights = [sum(b.column("weight")[0].as_py() for b in LM.trainer(shared, every, t, 1 << 20, 64, 0.01)([batch])) for t in range(rounds)]
    assert sum(weights) == rounds // every * (1 + 5 + 9 + 40 + 200)
    with pytest.raises(ValueError):
        LM.score_texts(None, "", train_every=8, rounds=2)


def test_packing(odd, empty):
    from strata.llm.packing import pack
    got = pack(odd, path(), length=64).collect()
    seqs, covered = defaultdict(list), Counter()
    for r in got:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
        covered[(r["doc_id"], r["doc_tokens"])] += r["length"]
    for s in seqs.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= 64
    assert sum(sum(n for _, n in s) < 64 for s in seqs.values()) <= 1
    assert all(total % n == 0 for (_, n), total in covered.items())
    assert sum(covered.values()) == sum(n * k for (_, n), k in Counter((r["doc_id"], r["doc_tokens"]) for r in got if r["start"] == 0).items())
    assert pack(empty, path()).count() == 0


def test_hilbert_neighbours_touch():
    from strata.llm.packing import hilbert
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    order = np.argsort(key := hilbert(cells, 3))
    assert sorted(key) == list(range(512))
    assert (np.abs(np.diff(cells[order], axis=0)).sum(1) == 1).all()


def test_toxicity(spark, odd, empty, labels):
    from strata.llm.toxicity import BlockMaxIndex, toxicity
    got = toxicity(odd, labels).collect()
    assert len(got) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity(empty, labels).count() == 0
    assert {r["score"] for r in toxicity(odd, labels.limit(0)).collect()} == {0.0}
    rng = np.random.default_rng(1)
    vectors = []
    for _ in range(300):
        v = {int(t): float(w) for t, w in zip(rng.choice(40, 4, replace=False), rng.random(4) + 0.1)}
        norm = math.sqrt(sum(w * w for w in v.values()))
        vectors.append({t: w / norm for t, w in v.items()})
    index = BlockMaxIndex(vectors, 40, block=16)
    for q in vectors[:40]:
        exact = sorted(((-round(sum(w * v.get(t, 0) for t, w in q.items()), 12), e) for e, v in enumerate(vectors)))[:10]
        assert index.nearest(q, 10) == [(e, -s) for s, e in exact if s < 0]
    rows = [(i, f"plain words number {i % 7} here" + (" idiot scum" if i % 4 == 0 else ""), "s") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    marks = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)], "doc_id long, quality int, toxic int")
    held = [r for r in toxicity(docs, marks).collect() if r["held_out"]]
    assert held and all(r["predicted"] == int(r["doc_id"] % 4 == 0) for r in held)


def test_toxicity_uses_every_term(spark):
    """Toxic words that are rare among the toxic examples count, and evidence is the exact cosine over all words."""
    from strata.llm.toxicity import held_out, toxicity
    rng = np.random.default_rng(7)
    kinds = [f"slur{c}" for c in "abcdefghijklmnopqrstuvwxy"]
    texts = {}
    for i in range(1500):
        words = [f"w{chr(97 + a)}{chr(97 + b)}" for a, b in rng.integers(0, 20, (30, 2))]
        if i % 5 == 0:
            words[3] = words[17] = kinds[i // 5 % len(kinds)]
        texts[i] = " ".join(words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    marks = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in texts], "doc_id long, quality int, toxic int")
    ids = docs.select("doc_id", held_out(docs["doc_id"], 5, 0).alias("h")).collect()
    known = {r["doc_id"] for r in ids if not r["h"]}
    got = toxicity(docs, marks).collect()
    held = [r for r in got if r["held_out"]]
    assert sum(r["predicted"] for r in held if r["doc_id"] % 5 == 0) >= 0.9 * sum(r["doc_id"] % 5 == 0 for r in held) > 0
    assert not any(r["predicted"] for r in held if r["doc_id"] % 5)
    # brute force
    words = {i: Counter(t.split()) for i, t in texts.items()}
    df, used, toxic = Counter(), Counter(), Counter()
    for i, c in words.items():
        df.update(set(c))
        used.update(set(c) if i in known else ())
        toxic.update(set(c) if i in known and i % 5 == 0 else ())
    share = sum(i % 5 == 0 for i in known) / len(known)
    lift = lambda t: max(1, (toxic[t] + 5 * share) / (used[t] + 5) / share) ** 2 if used[t] else 1
    vector = lambda c: {t: (1 + math.log(n)) * math.log(1 + len(texts) / df[t]) * lift(t) for t, n in c.items()}
    vectors = {i: vector(c) for i, c in words.items()}
    norm = {i: math.sqrt(sum(w * w for w in v.values())) for i, v in vectors.items()}
    for r in got[:60]:
        q = vectors[r["doc_id"]]
        want = sorted((sum(w * vectors[e].get(t, 0) for t, w in q.items()) / norm[e] / norm[r["doc_id"]] for e in known), reverse=True)[:3]
        assert np.allclose([x["cosine"] for x in r["evidence"]], want, atol=1e-6)


def test_quality_base_counts(odd, empty, labels):
    from strata.llm.quality import quality
    got = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
                  for r in quality(odd, labels).collect())
    want = Counter()
    for r in odd_rows():
        text = r[1] or ""
        words = WORD.findall(text)
        tri = Counter(zip(words, words[1:], words[2:]))
        covered = {j + k for j in range(len(words) - 2) if tri[tuple(words[j:j + 3])] > 1 for k in range(3)}
        lines = [line for line in text.split("\n") if WORD.search(line)]
        want[(r[0], len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
              len(words) < 50 or 100 * len(covered) > 50 * len(words))] += 1
    assert got == want
    assert quality(empty, labels).count() == 0


def test_mixing(odd, empty):
    from strata.llm.mixing import mix
    got = mix(odd, block=4).collect()
    again = mix(odd, block=4).collect()
    key = lambda r: (r["__doc"] is None, r["__doc"] or 0, r["size"], r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, again))
    sizes, taken, target = Counter(), Counter(), {}
    for r in got:
        assert r["taken"] <= 3 * r["size"]
        sizes[r["__source"]] += r["size"]
        taken[r["__source"]] += r["taken"]
        target[r["__source"]] = r["target"]
    assert sum(sizes.values()) == sum(len(WORD.findall(r[1] or "")) for r in odd_rows())
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    free, left = set(names), sum(sizes.values())
    want = {}
    while True:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 3 * sizes[s]}
        want |= {s: weight[s] * level for s in free}
        if not over:
            break
        for s in over:
            want[s] = 3.0 * sizes[s]
            left -= want[s]
        free -= over
    for s in names:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= 4 * 12
    assert mix(empty).count() == 0


def test_permutation_is_one(spark):
    from pyspark.sql import functions as F

    from strata.llm.mixing import permuted
    for n in (1, 2, 3, 10, 97, 1000):
        got = [r[0] for r in spark.range(n).select(permuted(F.col("id"), F.lit(n).cast("long"), F.lit(5))).collect()]
        assert sorted(got) == list(range(n))


def test_warc(spark):
    from strata.llm.warc import read_packages, write_packages
    page = "<p>" + "é" * 600
    rows = [(1, "http://a/", page, "x"), (5, None, page, "x"), (9, "http://b/\r\nX: y", page, "x"), (2, "u", None, None), (3, "u", "small", "x"),
            (4, "u", "small", "x"), (None, "u", "z" * 2000, "x"), (None, "u", "z" * 2000, "x"), (9, "http://c/", page, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload string").repartition(2)
    manifest = write_packages(pages)
    got = read_packages(manifest).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["payload"] is not None:
            assert hashlib.sha1(r["payload"]).hexdigest() == r["payload_digest"] and len(r["payload"]) == r["payload_bytes"]
    kinds = Counter((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in got)
    n = len(page.encode())
    assert kinds == Counter({(1, n, "revisit", 9): 1, (5, n, "revisit", 9): 1, (9, n, "response", None): 1, (9, n, "revisit", 9): 1,
                             (2, 0, "response", None): 1, (3, 5, "response", None): 1, (4, 5, "response", None): 1,
                             (None, 2000, "response", None): 1, (None, 2000, "revisit", None): 1})
    assert read_packages(write_packages(pages.limit(0))).count() == 0


def test_zip64_directory():
    from strata.llm.warc import members
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.writestr("a", b"first")
        z.writestr("b", b"second member")
    raw = out.getvalue()
    at = raw.rfind(b"PK\x05\x06")
    entries, length, start = struct.unpack("<HII", raw[at + 10:at + 20])
    # the first entry's offset moves to a ZIP64 extra field, the totals to a ZIP64 end record
    p = start
    name_len, = struct.unpack("<H", raw[p + 28:p + 30])
    entry = bytearray(raw[p:p + 46 + name_len])
    header = struct.unpack("<I", entry[42:46])[0]
    entry[42:46], entry[30:32] = b"\xff" * 4, struct.pack("<H", 12)
    directory = bytes(entry) + struct.pack("<HHQ", 1, 8, header) + raw[p + 46 + name_len:at]
    end64 = b"PK\x06\x06" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, entries, entries, len(directory), start)
    locator = b"PK\x06\x07" + struct.pack("<IQI", 0, start + len(directory), 1)
    end = b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    data = raw[:start] + directory + end64 + locator + end
    found = members(lambda n, o: data[o:o + n], len(data))
    assert {k: data[o:o + n] for k, (o, n) in found.items()} == {"a": b"first", "b": b"second member"}


def test_stages_keep_columns(spark, odd, labels, tmp_path):
    import corpus_pipeline
    labels.selectExpr("doc_id", "quality", "0 AS toxic").write.parquet(str(tmp_path / "labels.parquet"))
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == odd.columns, name
        docs.count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() > 0


@pytest.mark.parametrize("name", ["op1_line_dedup", "op3_exact_dedup", "op10_warc"])
def test_queries_match_sql(spark, name):
    import duckdb

    from strata.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    fn, sql = QUERIES[name]
    mine = fn(spark, sf).toArrow()
    cols = sorted(mine.column_names)
    theirs = con.sql(sql).to_arrow_table()
    key = lambda r: tuple(str(r[c]) for c in cols)
    assert sorted(map(key, mine.to_pylist())) == sorted(map(key, theirs.to_pylist()))
