"""Importance resampling, URL rules and the divergence audit on odd rows and against brute force."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, score long, rank int, weight long, __pos long, n long, docs long, row string"


@pytest.fixture(scope="module", autouse=True)
def workers_find_the_package(spark):
    spark.sparkContext.environment["PYTHONPATH"] = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def odd_rows():
    base = " ".join(f"word{i % 17} Über-{i % 5}, x{'y' * (i % 7)}" for i in range(60))
    long_word = "é" * 40  # over SHORT bytes
    texts = [None, "", " \n\t ", "one two", base, base.upper(), base + " " + long_word + " end", f"{long_word} {long_word} {long_word}",
             "q" * 5000, "\x00a\x7fb{c}d", "naïve. naïve, NAÏVE 12 3.4", "very long text " * 30_000]
    rows = [(i, t, ["en", "de", None][i % 3], [f"s{i % 4}", None][i % 5 == 0]) for i, t in enumerate(texts)]
    rows += [(50 + i, f"shared words of a language {'Common,' if i % 2 else 'common'} {i}" + " filler" * 20, "en", f"s{i % 3}") for i in range(24)]
    rows += [(-5, base, "en", "s1"), (-5, base, "en", "s1"), (-5, base + " more", "en", "s2"), (None, base, None, None), (None, base, None, None),
             (2**62, base, "fr", "only"), (-(2**62) - 7, base, "fr", "only"), (9, "...", "empty", "a"), (10, None, "empty", "b")]
    return [r + (1, 2, 3, 4, 5, 6, "r") for r in rows]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


TARGET = ["common words of a language", None, "word1 Über 3 x", "naïve 12"]


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TARGET)], "item_id long, text string")


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
    return words, [" ".join(words[i:i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def brute_resample(rows, target, percent=5, buckets=10_000):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    made = [(r[0], *features(r[1])) for r in rows]
    s, t = Counter(), Counter()
    for _, _, fs in made:
        s.update(map(bucket, fs))
    for x in target:
        t.update(map(bucket, features(x)[1]))
    big_s, big_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * big_s / ((s[b] + 1) * big_t))) for b in s}
    out = []
    for doc, words, fs in made:
        weight = sum(gain[bucket(f)] for f in fs)
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for k, r in enumerate(able[:percent * len(able) // 100], 1):
        r[4] = k
    return Counter(tuple(r[:5]) for r in out)


@pytest.mark.parametrize("percent", [5, 60, 100])
def test_resample_equals_brute_force(odd, target, percent):
    from strata.llm.importance import resample
    got = Counter(map(tuple, resample(odd, target, percent=percent, block_rows=3, width=5).collect()))
    assert got == brute_resample(odd_rows(), TARGET, percent)


def test_resample_of_empty_tables(odd, empty, target):
    from strata.llm.importance import drawn, resample
    assert resample(empty, target).count() == 0 and drawn(empty, target).count() == 0
    assert Counter(map(tuple, resample(odd, target.limit(0)).collect())) == brute_resample(odd_rows(), [])


@pytest.mark.parametrize("percent", [30, 77, 100])
def test_drawn_rows_are_the_ranked_ones(odd, target, percent):
    from strata.llm.importance import drawn
    got = drawn(odd, target, percent=percent)
    assert got.columns == odd.columns
    want = Counter(k[0] for k, n in brute_resample(odd_rows(), TARGET, percent).items() if k[4] for _ in range(n))
    assert Counter(r["doc_id"] for r in got.collect()) == want


def test_runs_of_words_across_cuts(monkeypatch):
    from strata.llm import importance
    rng = random.Random(7)
    texts = [" ".join("".join(rng.choices("abÉ9.", k=rng.choice([1, 3, 60, 130]))) for _ in range(rng.randrange(40))) for _ in range(60)]
    for block in (16, 64, 1 << 20):  # parts of 4, 16 and many words
        monkeypatch.setattr(importance, "BLOCK", block)
        got = Counter()
        for bucket, doc, _ in importance.bucket_runs([t.encode() for t in texts], 1 << 31):
            got.update(zip(doc.tolist(), bucket.tolist()))
        assert got == Counter((d, zlib.crc32(f.encode()) % (1 << 31)) for d, t in enumerate(texts) for f in features(t)[1])


def test_radix_ranks_any_width(spark):
    from strata.llm.common import materialize
    from strata.llm.importance import radix_ranks
    rng = random.Random(3)
    ids = [rng.choice([None, -(2**63), 2**63 - 1, 0, 1, 2, rng.randrange(-10**6, 10**6)]) for _ in range(400)]
    rows = [(i, rng.randrange(4), rng.choice([-3, 0, 5, 10**12])) for i in ids]
    table = materialize(spark.createDataFrame(rows, "doc_id long, n_features long, score long").repartition(5), "radix-test")
    want = sorted(rows, key=lambda r: (-r[2], r[0] is None, r[0] or 0, r[1]))
    for width, block_rows in ((12, 1 << 16), (7, 10)):
        ranked, n = radix_ranks(table, block_rows, width)
        assert n == 400 and [tuple(r)[:3] for r in sorted(ranked.collect(), key=lambda r: r["rank"])] == want


# --------------------------------------------------------------------------- URL rules

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
         ("a.b.org", "/fr/x", "block"), ("both.org", "", "allow"), ("both.org", "", "block")]
PAGE = "page_id long, url string, html string, host string, key string, rule string, path string"


def judge_brute(url, rules=RULES):
    host = path = ""
    if url and "://" in url:
        host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
        host = host.translate(LOW)
    fits = [(len(h + p), len(h), h + p, a) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fits:
        return host, path, None, "allow"
    top = max(f[:3] for f in fits)
    return host, path, top[2], "block" if any(f[:3] == top and f[3] == "block" for f in fits) else "allow"


def odd_urls():
    made = [None, "", "no scheme", "://", "http://", "http://net", "http://net/", "HTTP://A.NET/x", "http://x.example.net/en/1?a#b", "http://example.net/EN/",
            "http://example.net/en", "http://notexample.net/en/", "http://example.com?x=/de/", "http://a.example.com/de/#/", "http://a..org/fr/", "http://.org/fr/y",
            "http://org./fr/", "http://z.a.b.org/fr/xy", "http://b.org/fr/x", "http://u:p@net:80/", "x://y://net/", "http://ÄÖ.NET/ü", "http://both.org", "http://q.both.org/any",
            "http://" + "a." * 3000 + "net/" + "p" * 3000, "a\nb://net/\nx"]
    return [(i, u, None, "h", "k", "r", "p") for i, u in enumerate(made)] + [(3, "http://net/", None, "h", "k", "r", "p")] * 2 + [(None, "http://net/", None, "h", "k", "r", "p")]


def test_url_rules_equal_brute_force(spark):
    from strata.llm.url_filter import judge, rules_frame
    pages = spark.createDataFrame(odd_urls(), PAGE).repartition(3)
    got = Counter(map(tuple, judge(pages, rules_frame(spark, RULES)).collect()))
    assert got == Counter((r[0], *judge_brute(r[1])) for r in odd_urls())
    none = judge(pages, rules_frame(spark, RULES).limit(0))
    assert {(r["rule"], r["verdict"]) for r in none.collect()} == {(None, "allow")}
    assert judge(pages.limit(0), rules_frame(spark, RULES)).count() == 0


def test_cascade_is_exact_over_its_universe(spark):
    from strata.llm.url_filter import build_cascade
    from pyspark.sql import functions as F
    universe = spark.range(20_000).selectExpr("concat('key', id) AS key")
    listed = spark.range(0, 26_000, 13).selectExpr("concat('key', id) AS key")
    for claimed in (20_000, 4_000):  # the second one expects few others, so level 1 is small and many keys pass it
        cascade = build_cascade("t", universe, listed, claimed)
        assert len(cascade.levels) >= 3
        got = {r["key"] for r in cascade.attach(universe).where(F.expr(cascade.listed("key"))).collect()}
        assert got == {f"key{i}" for i in range(0, 20_000, 13)}
    with pytest.raises(ValueError):
        build_cascade("t", universe, listed, 20_000, max_filter_bits=1000)


def test_many_rules(spark):
    from strata.llm.url_filter import judge, rules_frame
    rng = random.Random(5)
    hosts = [f"h{i}.site{i % 40}.org" for i in range(300)]
    rules = [(h.split(".", rng.randrange(2))[-1], rng.choice(["/", "/a/", "/a/b", ""]), rng.choice(["allow", "block"])) for h in hosts]
    urls = [(i, f"https://{rng.choice(['', 'www.'])}{rng.choice(hosts)}{rng.choice(['', '/', '/a/', '/a/b/c', '/b'])}") for i in range(2000)]
    got = {tuple(r) for r in judge(spark.createDataFrame(urls, "page_id long, url string"), rules_frame(spark, rules)).collect()}
    assert got == {(i, *judge_brute(u, rules)) for i, u in urls}


# --------------------------------------------------------------------------- divergence

def audit_brute(rows, min_docs=10, scale=10**9, top=10):
    docs = [((r[2] or ""), (r[3] or ""), Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (r[1] or "").translate(LOW)))) for r in rows]
    seen = Counter((lang, t) for lang, _, c in docs for t in c)
    kept = defaultdict(list)
    for (lang, t), n in seen.items():
        if n >= min_docs:
            kept[lang].append(t)
    count, sources = defaultdict(Counter), defaultdict(set)
    for lang, source, c in docs:
        sources[lang].add(source)
        count[lang, source].update(c)
    share = lambda n, total, v: 1 + scale * (n + 2) // (total + 2 * v)
    apart = lambda p, q: (p - q) ** 2 // (p + q)
    out = []
    for lang, names in sources.items():
        terms = kept[lang]
        v = len(terms)
        total = {s: sum(count[lang, s][t] for t in terms) for s in names}
        p = {s: {t: share(count[lang, s][t], total[s], v) for t in terms} for s in names}
        whole = {t: share(sum(count[lang, s][t] for s in names), sum(total.values()), v) for t in terms}
        for s in names:
            pairs = [(o, sum(apart(p[s][t], p[o][t]) for t in terms)) for o in names if o != s]
            own = [(t, apart(p[s][t], whole[t])) for t in terms if count[lang, s][t] and p[s][t] > whole[t]]
            for part, items, most in (("pair", pairs, None), ("term", own, top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(ranked, 1)]
    return Counter(out)


@pytest.mark.parametrize("min_docs", [1, 3, 10])
def test_audit_equals_brute_force(odd, min_docs):
    from strata.llm.divergence import audit
    want = audit_brute(odd_rows(), min_docs)
    assert Counter(map(tuple, audit(odd, min_docs=min_docs).collect())) == want
    assert {k[2] for k in want} == {"pair", "term"} and any(k[0] == "" for k in want)


def test_terms_in_several_chunks_count_a_document_once(spark):
    """Five documents hold the term in two chunks each: ten by the chunks' sum, five in truth."""
    from strata.llm.divergence import audit
    rows = [(i, "word Word, other" if i < 5 else "other", "en", f"s{i % 2}") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)
    got = Counter(map(tuple, audit(docs, slice_bytes=20).collect()))
    assert got == audit_brute(rows) and not any(k[3] == "word" for k in got)
    assert Counter(map(tuple, audit(docs, min_docs=5, slice_bytes=20).collect())) == audit_brute(rows, 5)


def test_audit_of_an_empty_table_and_large_counts(spark, empty):
    from pyspark.sql import functions as F
    from strata.llm.divergence import _share, audit
    assert audit(empty).count() == 0
    n, total, v = 3 * 10**13, 7 * 10**13 + 1, 12345  # scale * n is beyond a long
    got = spark.range(1).select(_share(F.lit(n), F.lit(total), F.lit(v), 10**9)).first()[0]
    assert got == 1 + 10**9 * (n + 2) // (total + 2 * v)


def test_tiles_of_many_sources(spark, monkeypatch):
    from strata.llm import divergence
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "Beta."], 6)), "en", f"s{i % 11}") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    monkeypatch.setattr(divergence, "TILE", 4)
    assert Counter(map(tuple, divergence.audit(docs).collect())) == audit_brute(rows)


@pytest.mark.parametrize("name", ["op11_importance", "op12_url_filter", "op13_divergence"])
def test_queries_over_whole_tables(spark, name):
    from strata.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    got = Counter(map(tuple, QUERIES[name][0](spark, sf).collect()))
    read = lambda t: [tuple(r) for r in spark.read.parquet(f"{sf}/{t}.parquet").collect()]
    if name == "op11_importance":
        want = brute_resample(read("documents"), [r[1] for r in read("benchmark")])
    elif name == "op12_url_filter":
        want = Counter((r[0], *judge_brute(r[1], RULES[:4])) for r in read("pages"))
    else:
        want = audit_brute(read("documents"))
    assert got == want
