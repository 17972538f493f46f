"""Operators on small tables with nulls, empty and long texts, repeated rows and extra columns, against brute force."""

import base64
import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import DATA, duck, duck_rows, rows_of
from pyspark.sql import functions as F

from revlake.llm import bpe, embed_dedup, exact_dedup, html_extract, langid, line_dedup, minhash, packing, quality, queries, warc
from revlake.llm.components import components

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN
TEXTS = [None, "", " ", "a", "The cat sat.", "the CAT\tsat.", "The cat  sat.", "The cat sat.", "é漢字 ümläut\n\n x", "word " * 3000, "nospace" * 800, "<|endoftext|> it's 12345 !!", "a\nb\nc\nd\ne", "x\na\nb\nc\nd\ne", "\x1c\x85 odd space"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 2 else "fr", f"s{i % 3}", len(t or ""), i, "x") for i, t in enumerate(TEXTS)]
    rows += [(4, TEXTS[4], "en", "s", 1, 0, "x"), (None, "The cat sat.", None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, id long, digest string")


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    assert rows_of(queries.queries()[name](spark, DATA)) == duck_rows(duck(DATA), queries.ORACLE[name])


def write(spark, tmp_path, **tables):
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


@pytest.mark.parametrize("name", ["op2_exact_dedup", "op5_line_dedup"])
def test_odd_documents_equal_sql(spark, docs, tmp_path, name):
    import duckdb

    passage = "\n".join(f"line {i} of a passage" for i in range(9))
    more = [(i, f"{x}\n{passage}\n{x}", "en", "s", 1, i, "x") for i, x in [(20, "p"), (20, "q"), (20, "p"), (21, "r\n" + "own words " * 30), (22, "own words " * 30), (None, "t"), (None, "u")]]
    at = write(spark, tmp_path, documents=docs.unionByName(spark.createDataFrame(more, docs.schema)))
    con = duckdb.connect()
    con.sql(f"create view documents as select * from read_parquet('{at}/documents.parquet/*.parquet')")
    assert rows_of(queries.queries()[name](spark, at)) == duck_rows(con, queries.ORACLE[name])


def test_line_dedup_judges_rows_by_their_text(spark):
    """Of rows that share an id, only those that hold the repeated passage lose it; ids may be strings."""
    a, b = ("\n".join(f"{x} {i}" for i in range(12)) for x in "ab")
    for ids in ((1, 1, 2, 2, None), ("x", "x", "y", "y", None)):
        got = line_dedup.line_dedup(spark.createDataFrame(list(zip(ids, (a, b, a, b + "\nown", None), strict=True)), f"doc_id {'long' if ids[0] == 1 else 'string'}, text string")).collect()
        texts = {(r["doc_id"], r["n_lines"]): (r["text"], r["removed_lines"]) for r in got}
        first = [r for r in got if r["doc_id"] == ids[0]]
        assert {r["text"] for r in first} == {a, b} and all(r["removed_lines"] == 0 for r in first)
        assert texts[ids[2], 12][1] >= 8 and texts[ids[2], 13][1] >= 8 and "own" in texts[ids[2], 13][0] and texts[None, 1] == ("", 0)


def test_line_dedup_finds_repeated_passages(spark):
    """Share of the lines of repeated passages that go: of eight short lines most, of long lines all."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(500)]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared, long = ["\n".join(line(9) for _ in range(8)) for _ in range(30)], [line(55) for _ in range(30)]
    rows = [(100 * k + i, "\n".join([line(8), p, line(8), q, line(7)])) for k in range(3) for i, (p, q) in enumerate(zip(shared, long, strict=True))]
    got = line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).filter("doc_id >= 100").collect()
    assert all(q not in r["text"] for r, q in ((r, long[r["doc_id"] % 100]) for r in got))
    assert sum(r["removed_lines"] - 1 for r in got) >= 0.4 * 8 * len(got)


def test_every_operator_takes_empty_tables(spark, docs):
    none = docs.limit(0)
    pages = none.selectExpr("doc_id AS page_id", "source AS url", "text AS html")
    assert exact_dedup.exact_dedup(none).count() == 0 and line_dedup.line_dedup(none).count() == 0 and minhash.near_dedup(none).count() == 0
    assert html_extract.extract(pages).count() == 0 and bpe.decode(bpe.encode(none, RANKS, PATTERN), RANKS).count() == 0
    assert langid.predict(none, langid.learn(none)).count() == 0
    assert quality.predict(quality.features(none), quality.fit(quality.features(none).selectExpr("doc_id AS id", "stats", "1 AS label"))).count() == 0
    assert packing.pack(packing.stored(packing.pieces(none, JSON, PATTERN), packing.run_dir(spark, "none"))).count() == 0
    assert embed_dedup.near_vectors(none.selectExpr("doc_id AS vec_id", "CAST(array(1.0) AS array<float>) AS embedding")).count() == 0


def test_warc_round_trip(spark, tmp_path):
    big = "x" * 1200
    rows = [(1, "http://a/\r\nX: y", big), (2, "http://b", big), (3, None, "small"), (4, "u", "small"), (5, "u", None), (None, "u", big), (2, "http://b", big)]
    path = warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "w"))
    got = sorted(((r["id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.read_records(spark, path).collect()), key=str)
    assert got == sorted([(1, "revisit", 2, 1200), (2, "response", None, 1200), (2, "response", None, 1200), (3, "response", None, 5), (4, "response", None, 5), (5, "response", None, 0), (None, "revisit", 2, 1200)], key=str)
    assert spark.read.parquet(f"{path}/payloads").count() == 3
    for r in warc.read_records(spark, path).collect():
        i, u, body = next(x for x in rows if x[0] == r["id"])
        body = (body or "").encode()
        sha, revisit = hashlib.sha1(body).hexdigest(), r["record_type"] == "revisit"
        name = f"<urn:page:{'none' if i is None else i}:{sha}>"
        more = f"WARC-Profile: {warc.PROFILE}\r\nWARC-Refers-To: <urn:page:{r['refers_to']}:{sha}>\r\n" if revisit else ""
        uri = (u or "").replace("\r", "%0D").replace("\n", "%0A")
        head = f"WARC/1.1\r\nWARC-Type: {r['record_type']}\r\nWARC-Record-ID: {name}\r\nWARC-Target-URI: {uri}\r\nWARC-Date: {warc.NO_DATE}\r\nWARC-Payload-Digest: sha1:{sha}\r\n{more}Content-Type: text/html\r\nContent-Length: {0 if revisit else len(body)}\r\n\r\n"
        assert bytes(r["record"]) == head.encode() + (b"" if revisit else body) + b"\r\n\r\n" and bytes(r["payload"]) == body and r["digest_agrees"]
    bad = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.lit(b"?"))
    bad.write.parquet(f"{path}/other/payloads")
    with pytest.raises(Exception, match="differs from its digest"):
        warc.read_payloads(spark, f"{path}/other").collect()


def test_warc_empty_and_clashing(spark, tmp_path):
    rows = spark.createDataFrame([(1, "u", "x" * 2000), (2, "u", "x" * 2000)], "page_id long, url string, html string").withColumns({c: F.lit("clash") for c in ("id", "uri", "payload", "digest", "sha1", "bytes", "owner")})
    got = warc.read_records(spark, warc.write_archive(rows, str(tmp_path / "c"))).collect()
    assert sorted((r["id"], r["record_type"], r["refers_to"]) for r in got) == [(1, "revisit", 2), (2, "response", None)]
    assert warc.read_records(spark, warc.write_archive(rows.limit(0), str(tmp_path / "e"))).count() == 0


def test_directory_splits_overfull_buckets(spark, tmp_path):
    keys = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(500)] + [f"{i:064x}" for i in range(0, 1 << 18, 1 << 11)]
    d, bits = exact_dedup.directory(spark.createDataFrame([(k,) for k in keys], "digest string"), str(tmp_path / "d"), 20, 4)
    slots = {r["slot"]: (r["bucket"], r["depth"]) for r in d.collect()}
    loads = collections.Counter(slots[int(k[:15], 16) >> 60 - bits][0] for k in keys if int(k[:15], 16) >> 60 - bits in slots)
    assert sum(loads.values()) == len(keys)
    assert {s for k in keys if (s := int(k[:15], 16) >> 60 - bits)} <= slots.keys()
    assert all(n <= 20 for b, n in loads.items() if slots[b][1] < 14) and len({x for _, x in slots.values()}) > 2
    assert all(b <= s < b + (1 << bits - depth) for s, (b, depth) in slots.items())


def test_exact_dedup_chains_collisions(spark):
    """With an index hash of few values different texts share digests; the result is the same."""
    rows = [(i, f"text {i % 37}") for i in range(300)] + [(None, "text 5"), (7, "text 7"), (None, "alone"), (None, "alone"), (900, None), (901, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"digest": F.lit("clash"), "bucket": F.lit(1), "id": F.lit("x")})
    short = lambda norm: F.lpad(F.hex(F.pmod(F.hash(norm), F.lit(5)).cast("long")), 64, "0")
    want = rows_of(exact_dedup.exact_dedup(df))
    assert rows_of(exact_dedup.exact_dedup(df, capacity=2, digest=short)) == want == rows_of(exact_dedup.exact_dedup(df, capacity=3))
    assert len(want[1]) == len(rows)


def test_bpe_equals_library(spark, docs):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    lib = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    own = bpe.Encoder(ranks, PATTERN, cached=50)
    rng = random.Random(5)
    texts = ["".join(rng.choice(["a", "the", " ", "  ", "\n", "é", "1", "!!", "'s", "ion", "aaaa", "漢", "　"]) for _ in range(rng.randrange(80))) for _ in range(400)] + ["ab" * 5000, "a" * 9000] + [chr(c) + "x " + chr(c) for c in range(0, 0x3000) if c]
    for some in (texts, texts[:100], texts[50:]):
        ids, ends = own.encode(some)
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)] == [lib.encode_ordinary(x) for x in some]
    got = bpe.decode(bpe.encode(docs, RANKS, PATTERN, keep=("id", "doc_id", "text")), RANKS).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r["ids"] == lib.encode_ordinary(r["text"] or "") and bytes(r["decoded"]).decode() == (r["text"] or "")


def reference_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_components(ids, sets, percent):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = root(ids[a]), root(ids[b])
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def test_minhash_equals_brute_force_in_large_buckets(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(400)]
    base = [rng.choice(words) for _ in range(150)]
    texts = [None, "", "one two", "ONE two", "one  two\n", "a b c d e", " ".join(base)]
    for k in range(90):
        t = base[:]
        for _ in range(rng.randrange(1, 6)):
            t[rng.randrange(len(t))] = rng.choice(words)
        texts.append(" ".join(t))
    texts += [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 200))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [reference_set(t) for t in texts]
    want = brute_components(list(range(len(texts))), sets, 85)
    old = minhash.BLOCK
    try:
        minhash.BLOCK = 10
        got = {r["doc_id"]: r for r in minhash.near_dedup(df, percent=85).collect()}
    finally:
        minhash.BLOCK = old
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(got[i]["n_shingles"] == len(s) and got[i]["kept"] == (want[i] == i) for i, s in enumerate(sets))
    assert len(set(want.values())) < len(texts) - 30


def test_minhash_rows_that_share_an_id(spark):
    """Each row goes by its own text, whatever rows share its id."""
    rng = random.Random(2)
    a, b = (" ".join(rng.choice("abcdefghijkl") + str(rng.randrange(99)) for _ in range(150)) for _ in range(2))
    for ids in ([1, 1, 2, 3], ["p", "p", "q", "r"]):
        rows = list(zip(ids, (a, b, a + " x", b + " y"), strict=True))
        df = spark.createDataFrame(rows, f"doc_id {'long' if ids[0] == 1 else 'string'}, text string").withColumns({"id": F.lit("clash"), "no": F.lit(1), "set_hash": F.lit("x")})
        got = minhash.near_dedup(df).collect()
        assert len(got) == 4 and {r["component_id"] for r in got} == {ids[0]} and sorted(r["kept"] for r in got) == [False, False, True, True]


def test_minhash_odd_rows(spark, docs):
    got = minhash.near_dedup(docs).collect()
    assert len(got) == docs.count()
    assert [r["kept"] for r in got if r["doc_id"] is None] == [True]
    same = {r["component_id"] for r in got if r["doc_id"] in (4, 5, 6, 7)}
    assert same == {4}


def test_shingle_hashes_are_sets_of_words():
    rng = random.Random(1)
    texts = [" ".join(rng.choice("a b cc Dd \x1c é".split(" ")) for _ in range(rng.randrange(0, 40))) for _ in range(300)]
    by_hash, by_set = {}, {}
    for t in texts:
        h, s = minhash.shingles(t).tobytes(), reference_set(t)
        assert by_hash.setdefault(h, s) == s and by_set.setdefault(s, h) == h


def test_components_on_paths_and_hubs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101 + i) for i in range(50)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 151)}


def test_html_blocks_and_templates(spark):
    page = "<html><head><title>T</title></head><body><header>Site</header><nav><ul><li>n</ul></nav><div class='cookie-notice'>c</div>{promo}<article><h1>H &amp; h</h1><p>one<br>two <i>x</i><p>three<!-- no --><script>var a='</p>';</script><form>f</form><div id='comments'>hi</div></article><aside>s</aside><footer>f</footer>"
    plain = "<body><div><p>Shared box text here</p></div><p>own {i}</p></body>"
    rows = [(i, "http://H.example/x", page.format(promo="")) for i in range(3)] + [(100 + i, "http://user@h2.example:80/p", plain.format(i=i)) for i in range(30)] + [(500, None, None), (501, "u", ""), (502, "u", "<p>a<b>b</p>c<"), (503, "u", "plain")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit("clash"), "host": F.lit("clash")})
    got = {r["page_id"]: r["text"] for r in html_extract.extract(df).collect()}
    assert got[0] == "H & h\n\none two x\n\nthree" and got[105] == "own 5" and got[500] == "" and got[501] == "" and got[502] == "ab\n\nc<" and got[503] == "plain"


def test_html_wrapper_around_main_content(spark):
    nav, foot = "<nav><ul><li>n</ul></nav>", "<footer>f</footer>"
    forms = {"a": "<body><div id=page>{nav}<article><p>own {i}</p></article>{foot}</div></body>", "m": "<body><div><section>{nav}<div><main><p>own {i}</p></main></div></section>{foot}</div></body>", "r": "<body><div>{nav}<div role=main><p>own {i}</p></div>{foot}</div></body>"}
    box = "<body><div><div><p>Shared box</p></div><div><p>own {i}</p></div></div></body>"
    rows = [(f"{k}{i}", f"http://{k}.example/{i}", t.format(nav=nav, foot=foot, i=i)) for k, t in (forms | {"b": box}).items() for i in range(30)]
    got = {r["page_id"]: r["text"] for r in html_extract.extract(spark.createDataFrame(rows, "page_id string, url string, html string")).collect()}
    assert got == {f"{k}{i}": f"own {i}" for k in "amrb" for i in range(30)}


def test_html_templates_decide_on_the_given_pages(spark):
    """Equal to counting in one process; without the counts nearly all pages would keep what stands beside their article."""
    rows = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    rows += [(10_000, None, None), (10_001, rows[0][1], None), (10_001, rows[0][1], rows[0][2])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"_html": F.lit("clash"), "hashes": F.lit("clash")})
    got = collections.Counter((r["page_id"], r["text"]) for r in html_extract.extract(df).collect())
    by_host = collections.defaultdict(list)
    for _, u, h in rows:
        by_host[u.split("://")[1].split("/")[0].lower() if u else ""].append(html_extract.Page(h or "").hashes)
    want, bare = collections.Counter(), 0
    for i, u, h in rows:
        own = by_host[u.split("://")[1].split("/")[0].lower() if u else ""]
        few = len(own) < html_extract.MIN_PAGES or not u
        counts = collections.Counter(x for hashes in own for x in hashes)
        found = None if few else frozenset(x for x, n in counts.items() if n >= html_extract.MIN_PAGES and n >= html_extract.SHARES[x & 3] * len(own))
        want[i, html_extract.Page(h or "", found).text()] += 1
        bare += not few and html_extract.Page(h or "").text() != html_extract.Page(h or "", found).text()
    assert got == want and bare > 0.5 * sum(len(x) for u, x in by_host.items() if u and len(x) >= html_extract.MIN_PAGES)
    old = html_extract.BROADCAST_TEMPLATES
    try:
        html_extract.BROADCAST_TEMPLATES = 0
        assert collections.Counter((r["page_id"], r["text"]) for r in html_extract.extract(df).collect()) == want
    finally:
        html_extract.BROADCAST_TEMPLATES = old


def test_html_banner_inside_the_article_and_words_in_text(spark):
    """A container that all articles of a host share goes whatever it is called; one that stands in a single article stays whatever it is called; quoted paragraphs stay."""
    page = "<body><div class=x7>Today {i}</div><article><h1>T {i}</h1><p>Quoted by all.</p><div class=q3><p>Join us now</p></div><p>own {i}</p>{more}</article></body>"
    more = {3: "<div class=notice><p>A real notice</p></div>", 4: "<section class='ad related'><p>real too</p></section>"}
    rows = [(i, f"https://one.example/{i}", page.format(i=i, more=more.get(i, "<div class='comments'><p>reader %d says</p></div>" % i if i > 9 else ""))) for i in range(40)]
    got = {r["page_id"]: r["text"] for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    tail = {3: "\n\nA real notice", 4: "\n\nreal too"}
    assert got == {i: f"T {i}\n\nQuoted by all.\n\nown {i}{tail.get(i, '')}" for i in range(40)}


def test_html_equals_articles_by_another_parser(spark):
    """Counts alone leave of the given pages what the standard library's parser finds in their articles."""
    from html.parser import HTMLParser

    class Article(HTMLParser):
        def __init__(self):
            super().__init__()
            self.depth, self.no, self.blocks = 0, 0, [""]

        def handle_starttag(self, tag, attrs):
            self.depth += tag == "article"
            self.no += tag in ("script", "style", "form", "nav", "aside")
            self.blocks += [""] if tag in ("p", "h1", "h2", "h3", "div", "ul", "li", "article", "section", "blockquote") else []
            self.blocks[-1] += " " if tag == "br" else ""

        def handle_endtag(self, tag):
            self.handle_starttag(tag, [])
            self.depth -= 2 * (tag == "article")
            self.no -= 2 * (tag in ("script", "style", "form", "nav", "aside"))

        def handle_data(self, data):
            if self.depth and not self.no:
                self.blocks[-1] += data

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {}
    for r in pages.collect():
        page = Article()
        page.feed(r["html"] or "")
        page.close()
        want[r["page_id"]] = "\n\n".join(t for b in page.blocks if (t := " ".join(b.split())))
    assert {r["page_id"]: r["text"] for r in html_extract.extract(pages).collect()} == want


@pytest.mark.parametrize("bit", ["<a ", "<b></i>", '<a ">"', "<a '\">'", "<!-", "<!--", "<b>x", "<p><button>", "<li><i>", "<div><p>y</p>", "&#1", "<a b = ' c=\" ", "<"])
def test_html_time_grows_with_the_page(bit):
    """Long runs of each kind of fault take seconds, with and without main content after them, or under an open paragraph and many elements."""
    import time

    at = time.process_time()
    for page in (bit * (300_000 // len(bit)), bit * (300_000 // len(bit)) + "<main>m</main>", "<p><button>" + "<i>" * 20_000 + f"<h1>{bit}</h1>" * 10_000):
        for known in (None, frozenset()):
            html_extract.Page(page, known).text()
    assert time.process_time() - at < 20


def test_html_faults_have_defined_texts():
    text = lambda s: html_extract.Page(s).text()
    assert text("a <b c") == "a <b c" and text("<p>a</i></p>b") == "a\n\nb" and text('<a b=">">x</a>') == "x" and text('<a b="c>x</a>y') == "xy" and text("a<!--b") == "a"
    assert text(f"&#{'9' * 5000};&#{'0' * 5000}65;&#{'9' * 20}b") == "\ufffdA\ufffdb"
    words = " ".join(map(str, range(20)))
    assert text(f"<p>{words}</p>" * 20_000) == "\n\n".join([words] * 20_000)


def test_html_paragraphs_that_some_pages_share_are_text(spark):
    """Outside of main content a container goes that a tenth of the host's pages have, a paragraph stays."""
    rows = [(i, f"http://q.example/{i}", f"<body><div><p>own {i}</p>{'<p>Quoted words</p>' if i < 13 else ''}</div>{f'<div><p>Box</p></div>' if i < 13 else ''}</body>") for i in range(100)]
    got = {r["page_id"]: r["text"] for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"own {i}" + ("\n\nQuoted words" if i < 13 else "") for i in range(100)}


def test_language_accuracy_on_held_out(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = queries.op7_language_id(spark, DATA).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    assert got.filter("lang = lang_pred").count() >= 0.97 * got.count()
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !!")], "doc_id long, text string")
    assert {(r["lang_pred"], r["score"]) for r in langid.predict(odd, langid.learn(docs)).collect()} == {("und", 0.0)}


def test_languages_against_brute_force(spark):
    """Predictions and cosines equal those of sums over all n-grams, whatever the size of a block of languages."""
    rng = random.Random(8)
    made = [(i, " ".join("".join(rng.choice(a) for _ in range(rng.randrange(2, 8))) for _ in range(40)), f"l{k}") for k, a in enumerate(("abcdef", "defghi", "ghijkl", "jklmno", "xyzéß")) for i in range(k * 10, k * 10 + 6)]
    odd = [(100, None, "l0"), (101, "", "l1"), (102, "12 !", "l2"), (None, "abc abc def", None), (0, "xyz ß", None), (0, "xyz ß", None), (103, "ab" * 50_000, None), (104, "ΑΒΓ", None)]
    df = spark.createDataFrame([(*r, "clash", "clash", "clash") for r in made + odd], "doc_id long, text string, lang string, _text string, lang_pred string, score string")

    def bundle(text):
        out = np.zeros(langid.DIMENSIONS)
        for c, n in collections.Counter(langid.gram_codes(text).tolist()).items():
            letters = [np.random.default_rng([langid.SEED, c >> 21 * k & 0x1FFFFF]).choice(np.array([-1, 1]), langid.DIMENSIONS) for k in range(langid.GRAM)]
            out += n * np.prod([np.roll(x, k) for k, x in enumerate(letters)], 0)
        return out

    sums = {lang: sum(bundle(t) for _, t, x in made if x == lang) for lang in sorted({x for *_, x in made})}
    want = collections.Counter()
    for i, t, _ in made + odd:
        cosines = {x: v @ (d := bundle(t)) / np.linalg.norm(v) / (np.linalg.norm(d) or 1) for x, v in sums.items()}
        has = any(map(str.isalpha, t or ""))
        want[i, max(cosines, key=cosines.get) if has else "und", round(max(0, *cosines.values()), 6) if has else 0.0] += 1
    old = langid.BLOCK_LANGUAGES
    try:
        for langid.BLOCK_LANGUAGES in (old, 2):
            got = langid.predict(df, langid.learn(df)).collect()
            assert collections.Counter((r["doc_id"], r["lang_pred"], round(r["score"], 6)) for r in got) == want
    finally:
        langid.BLOCK_LANGUAGES = old


def test_quality_fit_against_brute_force(spark):
    """Weights solve the ridge equations of all rows, and the calibration is that of scores from fits without the row's fold."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 5))
    y = (np.sin(x[:, 0]) + x[:, 1] ** 2 + 0.3 * rng.normal(size=300) > 1).astype(int)
    rows = spark.createDataFrame([(i, a.tolist(), int(b)) for i, (a, b) in enumerate(zip(x, y, strict=True))], "id long, stats array<double>, label int")
    m = quality.fit(rows, frequencies=40)
    folds = np.array([r[0] for r in rows.select(F.pmod(F.hash(F.col("id").cast("string")), F.lit(quality.FOLDS))).collect()])
    z = m.expand(x)
    solve = lambda own: np.linalg.solve(z[own].T @ z[own] + quality.RIDGE * np.eye(z.shape[1]), z[own].T @ y[own])
    assert np.allclose(m.weights, solve(np.ones(300, bool)))
    raw = np.zeros(300)
    for k in range(quality.FOLDS):
        raw[folds == k] = z[folds == k] @ solve(folds != k)
    at = np.digitize(raw, np.linspace(-0.5, 1.5, quality.BINS - 1))
    w, good, total = (np.bincount(at, v, quality.BINS) for v in (np.ones(300), y, raw))
    where, level = quality.pool(total[w > 0] / w[w > 0], good[w > 0], w[w > 0])
    assert np.allclose(m.at, where) and np.allclose(m.level, level) and (np.diff(m.level) > 0).all()
    auc = (m.score(x)[y == 1][:, None] > m.score(x)[y == 0][None, :]).mean()
    assert auc > 0.9


def test_quality_with_few_labels(spark):
    """Whatever folds the labelled rows fall into; nulls, repeated ids and clashing columns."""
    texts = [(i, f"Some words of text {i}. " * (i % 5 + 1), i % 2) for i in range(8)]
    docs = spark.createDataFrame([(i, t, "clash", "clash", "clash") for i, t, _ in texts] + [(None, None, "c", "c", "c"), (1, "", "c", "c", "c"), (1, "x " * 200_000, "c", "c", "c")], "doc_id long, text string, stats string, score string, _text string")
    for own in ([2, 3], [0, 1], [0, 1, 2, 3], [1, 3], [], range(8)):
        labels = spark.createDataFrame([(i, q) for i, _, q in texts if i in own] + [(None, 1), (500, 0), (3, None)], "doc_id long, quality int")
        got = queries.scored(spark, docs, labels).collect()
        assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)


def test_bundle_is_the_sum_of_bound_vectors():
    v = langid.Vectors(256)
    codes = langid.gram_codes("Ab a")
    assert [c != 0 for c in codes] == [True] * len(codes) and len(codes) == 4
    assert np.array_equal(v.bundle(np.concatenate([codes, codes])), 2 * sum(v.bind(int(c)).astype(float) for c in codes))


def test_quality_separates_held_out(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = queries.op8_quality(spark, "/root/testdata/sf0.01").join(labels, "doc_id").filter("held_out").toPandas()
    good, bad = got[got.quality == 1].score.to_numpy(), got[got.quality == 0].score.to_numpy()
    assert (good[:, None] > bad[None, :]).mean() > 0.95 and got.score.between(0, 1).all()
    assert (got.predicted == got.quality).mean() > 0.95


def test_isotonic_pooling():
    at, level = quality.pool(np.array([0.0, 1, 2, 3]), np.array([0.0, 2, 1, 3]), np.array([1.0, 2, 2, 3]))
    assert level.tolist() == [0.0, 0.75, 1.0] and at.tolist() == [0.0, 1.5, 3.0]


def test_packing_is_whole_and_tight(spark, docs):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(JSON)
    assert lib.encode("a <|endoftext|> b", add_special_tokens=False).ids == packing.tokenizer(JSON, PATTERN).encode("a <|endoftext|> b")
    parts = packing.pieces(docs, JSON, PATTERN, capacity=64)
    got = packing.pack(packing.stored(parts, packing.run_dir(spark, "t")), capacity=64).toPandas()
    want = collections.Counter()
    for r in docs.collect():
        ids = np.array([*lib.encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % 64 or 64
        cuts = [0, *range(first, len(ids) + 1, 64)]
        want.update((r["doc_id"], p, s, e - s, zlib.crc32(ids[s:e].tobytes())) for p, (s, e) in enumerate(zip(cuts, cuts[1:], strict=False)))
    assert want == collections.Counter((None if d != d else int(d), *x) for d, *x in got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False))
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert list(g.offset) == [0, *g.length.cumsum()[:-1]] and g.length.sum() <= 64


def test_packing_of_repeated_and_text_ids(spark):
    """Rows with one id, or none, of one length: each has a place of its own, and several tasks share them."""
    rows = [(None, "a b"), ("x", "a b"), ("x", "a b")] * 400
    parts = packing.pieces(spark.createDataFrame(rows, "doc_id string, text string"), JSON, PATTERN, capacity=64)
    old = packing.ROWS_PER_SALT
    try:
        packing.ROWS_PER_SALT = 100
        got = packing.pack(packing.stored(parts, packing.run_dir(spark, "same")), capacity=64).toPandas()
    finally:
        packing.ROWS_PER_SALT = old
    n = got.length.iloc[0]
    assert len(got) == 1200 and (got.length == n).all() and len(got[["sequence_id", "offset"]].drop_duplicates()) == 1200
    assert got.sequence_id.nunique() == -(-1200 // (64 // n)) and ((got.offset % n) == 0).all() and (got.offset + n <= 64).all()


def test_plans_beat_best_fit_decreasing():
    import bisect

    rng = np.random.default_rng(2)
    for sizes in (rng.integers(1, 2048, 3000), rng.integers(200, 900, 3000), rng.integers(680, 700, 500), np.array([2048, 2048, 1])):
        counts = collections.Counter(sizes.tolist())
        plan = packing.plan(dict(counts))
        used = collections.Counter()
        for chosen, times in plan:
            assert sum(chosen) <= 2048
            for s in chosen:
                used[s] += times
        assert used == counts
        bins, n = [], 0
        for s in sorted(sizes.tolist(), reverse=True):
            k = bisect.bisect_left(bins, s)
            room = bins.pop(k) if k < len(bins) else 2048
            n += room == 2048 and k >= len(bins)
            bisect.insort(bins, room - s)
        assert sum(t for _, t in plan) <= n


def fewest(sizes, room):
    """Exact: over all sets of pieces, (sequences, fill of the last) at least."""
    best = {0: (0, room)}
    for mask in range(1, 1 << len(sizes)):
        best[mask] = min((n, used + s) if used + s <= room else (n + 1, s) for k, s in enumerate(sizes) if mask >> k & 1 for n, used in [best[mask ^ 1 << k]])
    return best[(1 << len(sizes)) - 1][0]


def test_plans_are_exact_on_small_cases():
    """Also where best fit decreasing needs more sequences."""
    rng, lost = random.Random(4), 0
    for _ in range(400):
        sizes = [rng.randrange(2, 13) for _ in range(rng.randrange(4, 10))]
        counts = dict(collections.Counter(sizes))
        found = packing.plan(counts, 20)
        used = collections.Counter()
        for chosen, times in found:
            assert sum(chosen) <= 20
            for x in chosen:
                used[x] += times
        n = sum(t for _, t in found)
        assert used == counts and n == fewest(sizes, 20)
        lost += sum(t for _, t in packing.best_fit(counts, 20)) > n
    assert lost


def test_vectors_that_share_an_id(spark):
    """Two vectors under one id are linked each by themselves, and connect nothing."""
    e = np.eye(4)
    rows = [(1, e[0]), (1, e[1]), (2, e[0] + 0.1 * e[2]), (3, e[1] + 0.1 * e[2]), (4, e[3]), (4, e[3])]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in rows], "vec_id long, embedding array<double>").withColumn("class", F.lit("clash"))
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in embed_dedup.near_vectors(df).collect())
    assert got == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1), (4, 1, 4), (4, 1, 4)]
    edge = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.95, float(np.sqrt(1 - 0.95**2)) * (1 + 1e-9)])], "vec_id long, embedding array<double>")
    assert [r["n_links"] for r in embed_dedup.near_vectors(edge).collect()] == [0, 0]


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(30, 32))
    v = np.concatenate([c + 0.12 * rng.normal(size=(40, 32)) for c in centres]).astype(np.float32)
    v[5] = v[4]
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    odd = [(9000, None), (9001, [0.0] * 32), (9002, [float("nan")] * 32), (9003, [1.0, None] + [0.0] * 30), (9004, [float("inf")] * 32), (9005, [1.0, 2.0]), (None, v[4].tolist()), (9006, [-0.0] * 31 + [2.0]), (9007, [0.0] * 31 + [4.0])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumns({"label": F.lit(1), "links": F.lit(1)})
    got = embed_dedup.near_vectors(df, leaf=100).toPandas()
    assert len(got) == len(rows) + len(odd)
    u = v.astype(float) / np.linalg.norm(v.astype(float), axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    want = near.sum(1) - 1
    own = got[got.vec_id.between(0, 5000)].sort_values("vec_id")
    assert (own.n_links.to_numpy() <= want).all() and own.n_links.sum() >= 0.9 * want.sum()
    rest = got[got.vec_id.between(9000, 9005)]
    assert (rest.n_links == 0).all() and (rest.component_id == rest.vec_id).all() and rest.kept.all()
    assert got[got.vec_id == 9007].component_id.item() == 9006 and got[got.vec_id.isna()].n_links.item() == 0


def test_vectors_of_a_dense_group(spark):
    """A third of the rows in one group whose cosines are about 0.96, not 1: no cut may go through it."""
    rng = np.random.default_rng(6)
    n, d = 6000, 64
    v = rng.normal(size=(n, d))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    v[: n // 3] = v[0] + np.sqrt((1 / 0.96 - 1) / d) * rng.normal(size=(n // 3, d))
    v[n // 3 + 1 :: 2] = v[n // 3 :: 2][: len(v[n // 3 + 1 :: 2])] + 0.02 * rng.normal(size=v[n // 3 + 1 :: 2].shape)
    got = embed_dedup.near_vectors(spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>"), leaf=50).toPandas().sort_values("vec_id")
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    want = (u @ u.T >= 0.95).sum(1) - 1
    found = got.n_links.to_numpy()
    assert (found <= want).all() and found[: n // 3].sum() >= 0.98 * want[: n // 3].sum() and found[n // 3 :].sum() >= 0.98 * want[n // 3 :].sum()


def test_vectors_of_many_dimensions(spark):
    rows = [(2 * d + k, [1.0] * d) if k else (2 * d, [1.0] * (d - 1) + [1.01]) for d in range(2, 130) for k in (0, 1)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embed_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {i: (1, i // 2 * 2) for i, _ in rows}


def test_pipeline_keeps_clean_documents(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    columns = docs.columns
    found = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, found, "/root/testdata/sf0.01")
        assert found.columns == columns
        path = str(tmp_path / str(_))
        found.write.parquet(path)
        found = spark.read.parquet(path)
    kept = {r["doc_id"] for r in found.select("doc_id").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    good = set(labels[labels.quality == 1].doc_id)
    groups = {r["doc_id"]: r["component_id"] for r in minhash.near_dedup(docs).collect()}
    alone = {d for d, n in groups.items() if list(groups.values()).count(n) == 1}
    assert len(good & alone & kept) >= 0.98 * len(good & alone)
    assert len(set(labels[labels.quality == 0].doc_id) & kept) <= 0.1 * (labels.quality == 0).sum()
    last = corpus_pipeline.STAGES[-1][1](spark, found, "")
    assert {r["doc_id"] for r in last.select("doc_id").collect()} == kept


def test_pipeline_decides_by_row(spark, tmp_path):
    """Null ids keep their rows; rows that repeat an id stand and fall each by its own text."""
    import corpus_pipeline

    rng = random.Random(11)
    words = [f"wort{a}{b}" for a in "abcdefgh" for b in "klmnopqr"]
    made = [" ".join(rng.choice(words) for _ in range(80)) for _ in range(8)]
    near = made[5].rsplit(" ", 1)[0] + " end"
    texts = [(1, made[0]), (1, made[0]), (1, made[1]), (2, made[2]), (2, "123 !!"), (None, made[3]), (None, made[3]), (None, made[4]), (3, made[5]), (None, near), (4, made[6]), (4, near), (None, "456 ??"), (None, made[6] + " "), (5, made[7])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts], "doc_id long, text string, lang string, source string, n_chars int")
    at = write(spark, tmp_path, labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    found = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, found, at)
        found.write.parquet(str(tmp_path / name))
        found = spark.read.parquet(str(tmp_path / name))
    got = collections.Counter((r["doc_id"], r["text"].strip()) for r in found.collect())
    either = [k for k in ((4, made[6]), (None, made[6])) if k in got]
    assert len(either) == 1 and got == collections.Counter([(1, made[0]), (1, made[1]), (2, made[2]), (None, made[3]), (None, made[4]), (3, made[5]), (5, made[7]), *either])
