"""Exact duplicates of texts by an extendible-hash index in shared files. DataFrame functions only.

1. Entries: each row's normalised text and its SHA-256, once, as a stored table; and the keys, the distinct digests with the rows they have.
2. The directory. A bucket holds the keys that share their leading bits, up to ``capacity``. Round by round the keys of overfull buckets are
   written anew with one more bit, which doubles the directory; keys whose bucket fits are settled. The directory names the bucket of each slot.
3. The index. Entries go to owner tasks by ranges of buckets. Inside a bucket entries of one digest are a chain, grouped by the bytes of their
   texts, so different texts that share a digest stay apart. Before that, the rows of hot digests (a list of at most ``HOT_KEYS``) are combined by task.
4. Each row looks up its digest; where a chain has more than one text, it compares bytes along it. Both sides are stored tables, so Spark can
   split the rows of a hot digest.

As the capacity grows with the keys, a directory has about ``2 * MOST_BUCKETS`` slots, unless digests are uneven, which SHA-256's aren't.

Nulls: a null text counts as empty. A null id never names the row that stays, unless all ids of the group are null; then
``keep_id`` is null and those rows are kept. Repeated ids with equal texts are each kept (ties). Other columns are not read, so none can clash.
An empty table gives an empty result; texts may be of any length.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlake.llm.common import run_dir, stored

#: Keys that a bucket of the index holds before it is split, at least, and buckets that the keys of a large table are dealt over.
CAPACITY, MOST_BUCKETS = 1024, 1 << 17
#: Leading bits of a digest that buckets may use, and bits that splits may add to the first directory: keys that even these don't part share a bucket over the capacity.
BITS, MOST_SPLITS = 60, 10
#: A digest is hot from so many rows on; if more than HOT_KEYS digests could have them, from the count on that no more can have.
HOT_ROWS, HOT_KEYS = 1000, 100_000
#: Slots of a directory that is broadcast; a larger one is joined by a shuffle.
BROADCAST_SLOTS = 1 << 20


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def leading(digest: Column, bits: int) -> Column:
    """The leading bits of a hexadecimal digest as a number."""
    return F.shiftright(F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("long"), BITS - bits)


def directory(keys: DataFrame, at: str, capacity: int, depth: int) -> tuple[DataFrame, int]:
    """(slot, bucket, depth) and the directory's bits. ``keys``: stored distinct digests. Slots are numbers of so many bits; a bucket is named by
    its first slot."""
    settled: list[tuple[DataFrame, int]] = []
    last = min(depth + MOST_SPLITS, BITS)
    left = keys.select("digest").withColumn("bucket", leading(F.col("digest"), depth))
    while True:
        loads = stored(left.groupBy("bucket").agg(F.count("*").alias("load")), f"{at}/loads-{depth}")
        fits = F.col("load") <= (capacity if depth < last else F.lit(2**62))
        settled.append((loads.filter(fits).select("bucket"), depth))
        over = loads.filter(~fits).select("bucket")
        if not over.limit(1).count():
            break
        # One more bit for the keys of overfull buckets; the others stay where they are.
        depth += 1
        left = stored(left.join(over.hint("merge"), "bucket", "left_semi").withColumn("bucket", leading(F.col("digest"), depth)), f"{at}/split-{depth}")
    slots = None
    for found, bits in settled:
        first = F.shiftleft(F.col("bucket"), depth - bits)
        some = found.select(F.explode(F.sequence(first, first + (1 << (depth - bits)) - 1)).alias("slot"), first.alias("bucket"), F.lit(bits).alias("depth"))
        slots = some if slots is None else slots.unionByName(some)
    return stored(slots, f"{at}/directory"), depth


def exact_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", capacity: int | None = None, digest=None) -> DataFrame:
    """Per row: id, ``keep_id`` (smallest id of its equal texts), ``group_size``, ``kept``, ``text_sha256``.

    ``digest`` may name another hexadecimal hash of 15 digits or more for the index, such as a short one that collides in a test."""
    spark = docs.sparkSession
    at = run_dir(spark, "exact")
    own = F.sha2("norm", 256)
    rows = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("norm"))
    rows = rows.withColumn("text_sha256", own)
    rows = stored(rows.withColumn("digest", F.col("text_sha256") if digest is None else digest(F.col("norm"))), f"{at}/entries")
    keys = stored(rows.groupBy("digest").agg(F.count("*").alias("n")), f"{at}/keys")
    distinct, total = keys.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    capacity = capacity or max(CAPACITY, distinct // MOST_BUCKETS)
    slots, bits = directory(keys, at, capacity, max(0, math.ceil(math.log2(max(distinct, 1) / capacity))))
    few = 1 << bits <= BROADCAST_SLOTS
    # No more than HOT_KEYS digests can have more than total / HOT_KEYS rows.
    hot = keys.filter(F.col("n") > max(HOT_ROWS, total // HOT_KEYS)).select("digest", F.lit(True).alias("hot"))
    known = rows.select("digest", "norm", "id").join(F.broadcast(hot), "digest", "left")
    sums = [F.min("id").alias("id"), F.sum("rows").alias("rows")]
    single = known.filter("hot is null").select("digest", "norm", "id", F.lit(1).cast("long").alias("rows"))
    joined = known.filter("hot").select("digest", "norm", "id", F.lit(1).cast("long").alias("rows")).groupBy("digest", "norm").agg(*sums)
    entries = single.unionByName(joined).withColumn("slot", leading(F.col("digest"), bits))
    entries = entries.join(F.broadcast(slots) if few else slots.hint("merge"), "slot").drop("slot", "depth")
    # Owner tasks: as buckets are ranges of tasks already, the groupings by bucket need no further shuffle.
    owned = entries.repartitionByRange(F.col("bucket")).groupBy("bucket", "digest", "norm").agg(*sums)
    chains = owned.groupBy("bucket", "digest").agg(F.count("*").alias("texts"), F.min("id").alias("keep_id"), F.sum("rows").alias("group_size"))
    chains = stored(chains.sortWithinPartitions("bucket", "digest"), f"{at}/index")
    found = rows.select("id", "text_sha256", "digest").join(chains.filter("texts = 1").select("digest", "keep_id", "group_size").hint("merge"), "digest").drop("digest")
    if chains.filter("texts > 1").limit(1).count():
        # Chains of several texts: their entries with the texts, compared byte by byte.
        odd = chains.filter("texts > 1").select("digest")
        links = rows.join(odd.hint("merge"), "digest", "left_semi")
        whole = stored(links.groupBy("digest", "norm").agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size")), f"{at}/chained")
        found = found.unionByName(links.join(whole.hint("merge"), ["digest", "norm"]).select("id", "text_sha256", "keep_id", "group_size"))
    return found.select(F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
