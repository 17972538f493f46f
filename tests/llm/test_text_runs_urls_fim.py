"""Periodic runs, url filter and fill-in-middle: nulls, empty and long texts, ties, repeated rows, empty tables and extra columns, against brute force and SQL."""

import hashlib
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from conftest import DATA, duck_rows, rows_of
from pyspark.sql import functions as F

from revlake.llm import fim, queries, runs, url_filter

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute_runs(words, least=24, exponent=3):
    """Runs by comparing the text with itself at each distance, smallest first."""
    codes = np.unique(np.array(words, dtype=object), return_inverse=True)[1] if len(words) else np.zeros(0, int)
    out = []
    for p in range(1, len(codes) // exponent + 1):
        same = np.concatenate(([False], codes[p:] == codes[:-p], [False]))
        edge = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            n = b - a + p
            if n >= max(least, exponent * p) and not any(s <= a and a + n <= s + m for s, m, _ in out):
                out.append((a, n, p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def expected_runs(doc_id, text):
    words = WORD.findall((text or "").encode())
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute_runs(words)
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    return (
        doc_id, len(found), *best, best[1] * 1000 // best[2] if found else None, hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest(),
    )


@pytest.fixture(scope="module")
def odd(spark):
    base = " ".join(f"w{i}" for i in range(7))
    texts = [None, "", " \t\n", "a", "x " * 23, "x " * 24, "x " * 25 + "y", (base + " ") * 3, (base + " ") * 4 + "w0 w1 end", "q " + "a b a b c " * 9, "é 漢 " * 40, "\x1c\x85 odd", "with <P> inside", "a  b\n\nc \x0b d ", "🙂 " * 30]
    rows = [(i, t, i, "x", 1) for i, t in enumerate(texts)] + [(3, "x y " * 30, 1, "x", 1), (3, "x y " * 30, 1, "x", 1), (None, "z " * 50, None, None, None)]
    # ids whose texts are made to repeat themselves
    rows += [(i, " ".join(f"v{(i * k) % 97}" for k in range(200)), 1, "x", 1) for i in [k for k in range(100, 1000) if zlib.crc32(str(k).encode()) % 10 == 0][:12]]
    return spark.createDataFrame(rows, "doc_id long, text string, n long, form string, runs int")


def at(tmp_path, **tables):
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def runs_rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()), key=repr)


def test_runs_equal_brute_force(spark, odd, tmp_path):
    got = runs_rows(queries.op11_runs(spark, at(tmp_path, documents=odd)))
    assert got == sorted((expected_runs(r["doc_id"], r["text"]) for r in odd.collect()), key=repr)
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert runs_rows(queries.op11_runs(spark, DATA)) == sorted((expected_runs(r["doc_id"], r["text"]) for r in docs.collect()), key=repr)


def test_runs_of_random_words():
    rng = random.Random(5)
    for _ in range(600):
        least, exponent, kinds, w = *rng.choice([(24, 3), (2, 2), (6, 2), (9, 3), (12, 4)]), rng.randint(1, 4), []
        while len(w) < rng.randint(0, 120):
            some = [rng.randint(0, kinds) for _ in range(rng.randint(1, 9))]
            w += some * rng.choice([1, 1, rng.randint(1, 8)])
        assert [tuple(r) for r in runs.find_runs(np.array(w, np.int64), least, exponent).tolist()] == brute_runs(w, least, exponent), (w, least, exponent)


def test_lyndon_arrays_by_definition():
    rng = random.Random(6)
    for _ in range(500):
        w = [rng.randint(0, rng.randint(1, 3)) for _ in range(rng.randint(1, 30))]
        longest = [next(j - i for j in range(i + 1, len(w) + 1) if j == len(w) or w[j:] < w[i:]) for i in range(len(w))]
        assert runs.lyndon(np.array(w)).tolist() == longest, w


def test_runs_of_long_texts(spark):
    """10 MB of one word, of a long period, and of text without repeats."""
    rng = np.random.default_rng(1)
    block = " ".join(f"{x:x}" for x in rng.integers(0, 1 << 30, 150_000))
    texts = ["ab " * 3_300_000, (block + " ") * 8, " ".join(f"{x:x}" for x in rng.integers(0, 1 << 40, 900_000))]
    got = {r["doc_id"]: r for r in runs.periodic_runs(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).select("doc_id", "runs", F.length("collapsed").alias("n")).collect()}
    assert [tuple(x) for x in got[0]["runs"]] == [(0, 3_300_000, 1)] and got[0]["n"] == 2
    assert [tuple(x) for x in got[1]["runs"]] == [(0, 1_200_000, 150_000)] and got[1]["n"] == len(block)
    assert got[2]["runs"] == [] and got[2]["n"] == len(texts[2])


def test_runs_and_fim_of_empty_tables(spark, odd, tmp_path):
    where = at(tmp_path, documents=odd.limit(0))
    assert queries.op11_runs(spark, where).count() == 0 and queries.op13_fill_in_middle(spark, where).count() == 0


def test_fim_equals_sql(spark, odd, tmp_path):
    where = at(tmp_path, documents=odd)
    con = duckdb.connect()
    con.sql(f"create view documents as select * from read_parquet('{where}/documents.parquet/*.parquet')")
    assert rows_of(queries.op13_fill_in_middle(spark, where)) == duck_rows(con, queries.ORACLE["op13_fill_in_middle"])


def test_fim_of_long_texts_and_all_forms(spark):
    """10 MB texts: parts join to the text, and each form is rebuilt."""
    texts = ["ab\tcd  " * 1_500_000, "x" * 10_000_000, " " * 10_000_000]
    docs = spark.createDataFrame([(i, texts[i % 3]) for i in range(6)], "doc_id long, text string")
    for spm in (0, 100):
        got = fim.fill_in_middle(docs, percent=100, spm_percent=spm).withColumn("back", F.sha2(fim.restore(F.col("output"), F.col("form")), 256))
        rows = got.select("doc_id", "n", "form", F.length("output").alias("l"), "back", "prefix_chars", "middle_chars").collect()
        assert {r["form"] for r in rows} == {"spm" if spm else "psm"} and {r["n"] for r in rows} == {3_000_001, 1}
        assert all(r["back"] == hashlib.sha256(texts[r["doc_id"] % 3].encode()).hexdigest() and r["l"] == len(texts[r["doc_id"] % 3]) + 9 for r in rows)


def test_boundary_sets_find_each_offset():
    """Each kind of container, and sets that go over several."""
    rng = np.random.default_rng(2)
    sets = [np.arange(100), np.arange(65_530, 65_560), np.array([5]), np.array([0, 65_535, 65_536, 200_000]), np.sort(rng.choice(65_536, 9_000, False)), np.sort(rng.choice(300_000, 40_000, False)), np.concatenate((np.arange(50_000), 70_000 + 2 * np.arange(9_000)))]
    kinds = set()
    for offsets in sets:
        known = fim.Boundaries(offsets)
        kinds |= {type(c) for c in known.containers}
        assert len(known) == len(offsets) and known.after(0) == 0
        assert all(known.after(k + 1) == offsets[k] for k in (range(len(offsets)) if len(offsets) < 200 else [0, 1, len(offsets) - 1, *rng.integers(0, len(offsets), 500).tolist()]))
    assert kinds == {fim.Array, fim.Bitmap, fim.Runs}


URLS = [None, "", "nothing", "http://", "://x", "http://A.Example.ORG/es/1?x=/en/1", "https://example.org", "http://example.org/es/", "http://example.org/es", "http://sub.example.org/en/12/?q#f", "http://notexample.org/es/1", "http://badexample.org:80/en/1", "http://org/x", "http://x.com/de/1", "http://x.com/fr/1#/de/", "http://x.com/it/?://y", "http://redhouse.net/de/bluehouse", "http://x.net/de/1", "http://x.net/fr/1", "http://redredhouse.net/", "http://ÄÖ.net/é", "http://x.net?a/b", "http://x.net#a/b", "http://a..com/de/", "http://x.com/de/1", "http://x.com/de/1", f"http://{'red' * 300}.net/", "http://" + "." * 5000 + "com/fr/", "http://x.net/" + "q/" * 20000]


def brute_rule(host, path, rules):
    fits = [(len(h) + len(p), len(h), v, h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[3::-1][:2] if fits else (None, None)


def brute_words(name, counts):
    """The cheapest of all ways to cut a name; a piece is a known word or an unknown one."""
    if name[0] == "#":
        return [name]
    total, cheapest = sum(counts.values()), None
    for cut in itertools.product((0, 1), repeat=len(name) - 1):
        ends = [i + 1 for i, c in enumerate(cut) if c] + [len(name)]
        parts = [name[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        cost = sum(min(math.log(total / counts[w]) if w in counts else math.inf, math.log(total) + len(w) * math.log(10)) for w in parts)
        if cheapest is None or cost < cheapest[0] - 1e-9:
            cheapest = (cost, parts)
    return cheapest[1]


def test_url_filter_equals_brute_force(spark, tmp_path):
    urls = [u for u in URLS if not u or len(u) < 100]
    html = "<p class=nothing>red house blue house red <b>house</b> net de fr x example"
    pages = spark.createDataFrame([(i % 20, u, html if i % 2 else None, "h", 1) for i, u in enumerate(urls)] + [(None, "http://x.com/de/1", "", "h", 1)], "page_id long, url string, html string, host string, rule int")
    got = queries.op12_url_filter(spark, at(tmp_path, pages=pages)).collect()
    split = lambda u: re.match(r"([^/?#]*)([^?#]*)", u.split("://", 1)[1], re.S).groups() if u and "://" in u else ("", "")
    split = (lambda f: lambda u: ("".join(c.lower() if c.isascii() else c for c in f(u)[0]), f(u)[1]))(split)
    every = [(r["page_id"], *split(r["url"])) for r in pages.collect()]
    counts = {}
    for r in pages.collect():
        for w in re.findall(r"[^\W\d_]+", re.sub("<[^<>]*>", " ", (r["html"] or "").lower())):
            counts[w] = counts.get(w, 0) + 1
    words = lambda host, path: [(k, w) for k, x in (("h", host), ("p", path)) for name in re.findall(r"[^\W\d_]+|\d+", x.lower()) for w in brute_words(f"#{len(name)}" if name.isdigit() else name, counts)]
    taught = {v: [w for _, h, p in every if brute_rule(h, p, queries.URL_RULES)[1] == v for w in words(h, p)] for v in ("allow", "block")}
    urls_of = {v: sum(brute_rule(h, p, queries.URL_RULES)[1] == v for _, h, p in every) for v in taught}
    vocabulary = set(taught["allow"]) | set(taught["block"])
    weight = lambda w, v: math.log((taught[v].count(w) + 1) / (len(taught[v]) + len(vocabulary)))
    score = lambda h, p: math.log(urls_of["block"] / urls_of["allow"]) + sum(weight(w, "block") - weight(w, "allow") for w in words(h, p) if w in vocabulary)
    want = []
    for page, h, p in every:
        rule, says = brute_rule(h, p, queries.URL_RULES)
        want.append((page, h, p, rule, says or ("block" if score(h, p) > 0 else "allow")))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert {x[4] for x in want if x[3] is None} == {"allow", "block"}


def test_words_of_names(spark):
    """Viterbi against all ways to cut; names of 100,000 letters; names without a known word."""
    rng = random.Random(3)
    counts = {"red": 9, "house": 5, "redhouse": 1, "ed": 2, "a": 4, "use": 3}
    found = sorted({"".join(rng.choice(["red", "house", "a", "use", "zq", "e", "d"]) for _ in range(rng.randint(1, 4)))[:12] for _ in range(60)} | {"zzzz", "#4"})
    names = spark.createDataFrame([(x,) for x in [*found, "red" * 33_000, "ß" * 50_000]], "name string")
    got = {r["name"]: r["words"] for r in url_filter.segmented(names, spark.createDataFrame(list(counts.items()), "piece string, n long")).collect()}
    cost = lambda ws: sum(min(math.log(sum(counts.values()) / counts[w]) if w in counts else math.inf, math.log(sum(counts.values())) + len(w) * math.log(10)) for w in ws)
    assert set(got) == {r["name"] for r in names.collect()}
    assert all("".join(got[x]) == x and (x == "#4" or abs(cost(got[x]) - cost(brute_words(x, counts))) < 1e-9) for x in found)
    assert got["red" * 33_000] == ["red"] * 33_000 and got["ß" * 50_000] == ["ß" * 50_000]


def test_url_filter_of_long_urls_no_rules_and_empty_tables(spark, tmp_path):
    pages = spark.createDataFrame([(i, u, "<" * 100_000) for i, u in enumerate(URLS)], "page_id long, url string, html string")
    none = spark.createDataFrame([], url_filter.RULES)
    assert [r["verdict"] for r in url_filter.judge(pages, none).collect()] == ["allow"] * len(URLS)
    block = spark.createDataFrame([("com", "", "block"), (None, "/", "allow"), ("com", "", "block")], url_filter.RULES)
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.judge(pages, block).collect()}
    assert got[13] == ("com", "block") and len(got) == len(URLS)
    assert queries.op12_url_filter(spark, at(tmp_path, pages=pages.limit(0))).count() == 0
