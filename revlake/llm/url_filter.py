"""URL filters: rules by host and path prefix, and for urls without a rule naive Bayes over the words that hosts and paths are put together from.

Rules: a rule (host, path, verdict) fits its host and all subdomains where the url's path starts with the rule's; the longest wins, then the one with the longer
host, then ``block``. Urls are matched by equality only: the last k labels of the host for each k that rules have, and prefixes of the path in the lengths that the found hosts' rules have.

Words: hosts and paths are cut into names, runs of letters or of digits. A run of digits is one word, its length. A run of letters is split into words by
Viterbi under a unigram model: the counts of all words in the pages' visible text. Letters that no known word covers make up unknown words, which cost as much as a word
not seen and ten times less for each letter. Only words up to ``LONGEST`` letters are looked up; longer names can be unknown words or split. Ties go to the shorter last word.

Verdicts: urls that a rule decides teach a multinomial naive Bayes the words of each verdict, add-one smoothed; words of hosts and paths are told apart. Words that teach nothing weigh
nothing. A url is blocked if block is likelier, so ties are allowed; where nothing teaches, all is allowed. Weights are whole numbers, so sums don't depend on their order.

All steps work on distinct (host, path) with counts, distinct names and distinct words, so hot hosts, urls and repeated rows are grouped before they are joined; a name's pieces
meet the word counts in a join. Nulls: a null url, or one without ``://``, has an empty host and path and no words; a null page text teaches no words. Rows that repeat an id are each judged. Urls and texts may
have any length. Only the columns in ``keep`` are passed on, so others can't clash. An empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlake.llm.common import frugal, run_dir, small_batches, stored

ALLOW, BLOCK = "allow", "block"
#: Letters of the longest word that is looked up.
LONGEST = 24
#: Weights are logarithms in units of 2 ** -20.
UNIT = 1 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = "host string, path string, verdict string"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host, in lower case, and path of a url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def ruled(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (id, host, path, ...) with ``rule`` and ``verdict`` of the longest rule that fits, else null."""
    rules = rules.select(F.col("host").alias("of"), F.col("path").alias("prefix"), F.col("verdict").alias("says")).filter("of is not null and prefix is not null and says is not null").distinct()
    labels = lambda host: F.size(F.split(host, r"\."))
    # A number for each count of labels, so few rows whatever the rules.
    counts = [r[0] for r in rules.select(labels(F.col("of"))).distinct().collect()]
    if not counts:
        return urls.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(None).cast("string")})
    suffixes = F.filter(F.array(*(F.when(labels(F.col("host")) >= k, F.substring_index("host", ".", -k)) for k in counts)), lambda x: x.isNotNull())
    lengths = rules.groupBy("of").agg(F.collect_set(F.length("prefix")).alias("lengths"))
    near = urls.select("id", "path", F.explode(suffixes).alias("of")).join(lengths, "of")
    near = near.select("id", "of", F.explode(F.filter("lengths", lambda m: m <= F.length("path"))).alias("m"), "path").select("id", "of", F.expr("left(path, m)").alias("prefix"))
    fits = near.join(rules, ["of", "prefix"])
    best = fits.groupBy("id").agg(F.max(F.struct((F.length("of") + F.length("prefix")).alias("l"), F.length("of").alias("h"), "says", "of", "prefix")).alias("b"))
    return urls.join(best, "id", "left").select(*urls.columns, F.concat("b.of", "b.prefix").alias("rule"), F.col("b.says").alias("verdict"))


def names(kind: str, c: Column) -> Column:
    """The names in a host or path, a struct of (kind, name) each."""
    return F.transform(F.regexp_extract_all(F.lower(c), F.lit(r"\p{L}+|\p{N}+"), F.lit(0)), lambda x: F.struct(F.lit(kind).alias("kind"), F.when(x.rlike(r"^\p{N}"), F.concat(F.lit("#"), F.length(x).cast("string"))).otherwise(x).alias("name")))


def named(urls: DataFrame, *more: str) -> DataFrame:
    """A row (kind, name) for each name in the host and path of each url."""
    return urls.select(*more, F.explode(F.concat(names("h", F.col("host")), names("p", F.col("path")))).alias("x")).select(*more, "x.kind", "x.name")


def word_counts(texts: DataFrame, text_col: str) -> DataFrame:
    """(piece, n): how often each word stands in the texts, without their markup."""
    visible = F.regexp_replace(F.lower(text_col), "<[^<>]*>", " ")
    words = texts.select(F.explode(F.regexp_extract_all(visible, F.lit(r"\p{L}+"), F.lit(0))).alias("piece"))
    return words.filter(F.length("piece") <= LONGEST).groupBy("piece").agg(F.count("*").alias("n"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for no, name in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            for a in range(0, len(name), 4096):  # a batch of rows at a time, however long the name is
                spots = [(i, name[i : i + k]) for i in range(a, min(a + 4096, len(name))) for k in range(1, min(LONGEST, len(name) - i) + 1)]
                yield pa.RecordBatch.from_arrays([pa.array([no] * len(spots), pa.int64()), pa.array([i for i, _ in spots], pa.int64()), pa.array([p for _, p in spots])], ["no", "at", "piece"])


class Viterbi:
    """The cheapest words of a name, found from left to right: at each place the cheapest way there, by a known word or inside an unknown one."""

    def __init__(self, name: str, total: int):
        self.name, self.total, n = name, total, len(name)
        self.unseen, self.letter = math.log(total), math.log(10)
        self.cost, self.start = [0.0] + [math.inf] * n, [0] * (n + 1)
        self.open, self.opened, self.at = math.inf, 0, 0

    def reach(self, place: int) -> None:
        """Unknown words up to ``place``; all known words that end before it have been taken."""
        while self.at < place:
            fresh = self.cost[self.at] + self.unseen
            if fresh <= self.open:
                self.open, self.opened = fresh, self.at
            self.open += self.letter
            self.at += 1
            self.offer(self.open, self.opened, self.at)

    def offer(self, cost: float, start: int, end: int) -> None:
        if cost < self.cost[end] or (cost == self.cost[end] and start > self.start[end]):
            self.cost[end], self.start[end] = cost, start

    def word(self, at: int, length: int, count: int) -> None:
        """A known word; words come by their place."""
        self.reach(at)
        self.offer(self.cost[at] + math.log(self.total / count), at, at + length)

    def words(self) -> list[str]:
        end = len(self.name)
        self.reach(end)
        out = []
        while end:
            out.append(self.name[self.start[end] : end])
            end = self.start[end]
        return out[::-1]


def _segment(total: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Viterbi | None = None
        for b in batches:
            done: list[Viterbi] = []
            for at, length, count, name in zip(*(b.column(k).to_pylist() for k in range(1, 5)), strict=True):
                if name is not None:  # a name's first row
                    done += [now] if now else []
                    now = Viterbi(name, total)
                else:
                    now.word(at, length, count)
            yield segments(done)
        if now:
            yield segments([now])

    return run


def segments(done: list[Viterbi]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v.name for v in done], pa.string()), pa.array([v.words() for v in done], pa.list_(pa.string()))], ["name", "words"])


def segmented(found: DataFrame, counts: DataFrame) -> DataFrame:
    """(name, words) of each of the distinct names in ``found``; ``counts`` has the unigrams (piece, n)."""
    spark = found.sparkSession
    small_batches(spark)
    at = run_dir(spark, "names")
    counts = stored(counts, f"{at}/counts")
    total = max(counts.agg(F.sum("n")).first()[0] or 0, 1)
    letters = stored(found.filter(~F.col("name").startswith("#")).select(F.monotonically_increasing_id().alias("no"), "name"), f"{at}/names")
    pieces = letters.mapInArrow(frugal(_pieces), "no long, at long, piece string")
    known = pieces.join(counts.hint("merge"), "piece").select("no", "at", F.length("piece").cast("long").alias("length"), "n", F.lit(None).cast("string").alias("name"))
    nothing = F.lit(0).cast("long")
    # The name itself comes before its words, and only there.
    known = known.unionByName(letters.select("no", F.lit(-1).cast("long").alias("at"), nothing.alias("length"), nothing.alias("n"), "name"))
    split = known.repartition("no").sortWithinPartitions("no", "at", "length").mapInArrow(frugal(_segment(total)), "name string, words array<string>")
    return split.unionByName(found.filter(F.col("name").startswith("#")).select("name", F.array("name").alias("words")))


def weights(taught: DataFrame, words: DataFrame) -> tuple[DataFrame, int]:
    """(kind, word, weight): what a word says for ``block``; and the weight that all urls start with. ``taught`` has host, path, verdict and how often the url stands there."""
    urls = {r["verdict"]: r["n"] for r in taught.groupBy("verdict").agg(F.sum("n").alias("n")).collect()}
    known = named(taught, "verdict", "n").groupBy("kind", "name", "verdict").agg(F.sum("n").alias("n")).join(words, "name").select("kind", F.explode("words").alias("word"), "verdict", "n")
    n = {v: F.coalesce(F.sum(F.when(F.col("verdict") == v, F.col("n"))), F.lit(0)).alias(v) for v in (ALLOW, BLOCK)}
    counts = stored(known.groupBy("kind", "word").agg(*n.values()), f"{run_dir(taught.sparkSession, 'words')}/counts")
    if not urls.get(ALLOW) or not urls.get(BLOCK):
        return counts.select("kind", "word", F.lit(0).cast("long").alias("weight")), 1 if urls.get(BLOCK) else 0
    allow, block, kinds = counts.agg(F.sum(ALLOW), F.sum(BLOCK), F.count("*")).first()
    odds = F.log((F.col(BLOCK) + 1) / F.lit(float((block or 0) + kinds))) - F.log((F.col(ALLOW) + 1) / F.lit(float((allow or 0) + kinds)))
    return counts.select("kind", "word", F.round(odds * UNIT).cast("long").alias("weight")), round(math.log(urls[BLOCK] / urls[ALLOW]) * UNIT)


def judge(pages: DataFrame, rules: DataFrame, *, url_col: str = "url", text_col: str = "html", keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """The columns in ``keep``, ``host``, ``path``, ``rule`` (host and path of the rule that decides, else null) and ``verdict``; ``rules`` has host, path and verdict."""
    at = run_dir(pages.sparkSession, "urls")
    host, path = split_url(F.col(url_col))
    urls = pages.select(host.alias("host"), path.alias("path")).groupBy("host", "path").agg(F.count("*").alias("n"))
    urls = stored(urls.withColumn("id", F.monotonically_increasing_id()), f"{at}/urls")  # stored, as the numbers could differ when computed again
    urls = stored(ruled(urls, rules), f"{at}/ruled")
    words = stored(segmented(named(urls).select("name").distinct(), word_counts(pages, text_col)), f"{at}/words")
    model, start = weights(urls.filter(F.col("verdict").isNotNull()), words)
    open_urls = urls.filter(F.col("verdict").isNull())
    said = named(open_urls).distinct().join(words, "name").select("kind", "name", F.explode("words").alias("word")).join(model, ["kind", "word"])
    said = stored(said.groupBy("kind", "name").agg(F.sum("weight").alias("weight")), f"{at}/said")
    scores = named(open_urls, "id").join(said.hint("merge"), ["kind", "name"]).groupBy("id").agg(F.sum("weight").alias("weight"))
    verdict = F.coalesce("verdict", F.when(F.coalesce("weight", F.lit(0)) + start > 0, BLOCK).otherwise(ALLOW))
    known = stored(urls.join(scores, "id", "left").select("host", "path", "rule", verdict.alias("verdict")), f"{at}/verdicts")
    return pages.select(*keep, host.alias("host"), path.alias("path")).join(known.hint("merge"), ["host", "path"], "left").select(*keep, "host", "path", "rule", "verdict")
