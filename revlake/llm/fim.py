"""Fill-in-middle: a text is cut at two token boundaries and its parts change places, so that a model learns to fill gaps.

A token is white space and the word after it, or white space at the text's end. The ends of a text's tokens, counted in code points, form a set in the manner of
Roaring bitmaps: offsets are split by their upper 16 bits into containers, each stored in the smallest of three forms, a sorted array, a bitmap or runs.
Cumulative cardinalities say which container holds the k-th boundary, a select inside it gives the offset. Both cuts are such selects.

What happens to a document depends on its id alone: the first four groups of eight hex digits of SHA-256 of ``seed:id`` are h1 to h4. The prefix ends after the
smaller of h1 and h2 modulo n + 1 tokens, the middle after the larger; h3 decides whether the text is changed, h4 which form it takes.

Nulls: a null text counts as empty, a null id as an id without digits. Empty texts and texts that hold a marker stay as they are (``plain``). Rows that repeat
an id are cut each in its own text by the same numbers. There are no ties: boundaries are distinct. Texts may have any length; a worker holds one text's code points and containers.
Only the columns in ``keep`` are passed on, so others can't clash. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlake.llm.common import frugal, small_batches

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


class Array:
    """Sorted low halves of offsets."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])


class Bitmap:
    """A bit for each of 65,536 offsets, in 1,024 words with the bits set before each."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(1 << 16, bool)
        bits[low] = True
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, "right")) - 1
        word = int(self.words[at])
        for _ in range(k - int(self.before[at])):
            word &= word - 1
        return 64 * at + (word & -word).bit_length() - 1


class Runs:
    """Starts of stretches of consecutive offsets, with the offsets before each."""

    def __init__(self, low: np.ndarray, first: np.ndarray):
        self.starts = low[first].astype(np.uint16)
        self.before = first

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.starts[at]) + k - int(self.before[at])


class Boundaries:
    """A set of offsets, given in ascending order, that finds its k-th one."""

    def __init__(self, offsets: np.ndarray):
        self.keys, first = np.unique(offsets >> 16, return_index=True)
        self.before = np.append(first, len(offsets))
        self.containers = [self.container(offsets[a:b] & 0xFFFF) for a, b in zip(self.before[:-1], self.before[1:], strict=True)]

    @staticmethod
    def container(low: np.ndarray) -> Array | Bitmap | Runs:
        first = np.flatnonzero(np.diff(low, prepend=-2) != 1)
        if 4 * len(first) < min(2 * len(low), 8192):
            return Runs(low, first)
        return Array(low) if 2 * len(low) <= 8192 else Bitmap(low)

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, "right")) - 1
        return (int(self.keys[at]) << 16) + self.containers[at].select(k - int(self.before[at]))

    def after(self, n: int) -> int:
        """The offset behind the first ``n`` tokens."""
        return self.select(n - 1) if n else 0


def token_ends(text: str) -> np.ndarray:
    """Offsets behind the tokens of a text: a word's end, or the end of the text."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    blank = (codes == 0x20) | ((codes >= 0x09) & (codes <= 0x0D))
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    return np.append(ends, len(codes)) if len(codes) else ends


def _cuts(n_keep: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, first, second = [], [], []
            for text, h1, h2 in zip(b.column(n_keep), b.column(n_keep + 1).to_pylist(), b.column(n_keep + 2).to_pylist(), strict=True):
                known = Boundaries(token_ends(text.as_py()))
                x, y = sorted((h1 % (len(known) + 1), h2 % (len(known) + 1)))
                n.append(len(known)), first.append(known.after(x)), second.append(known.after(y))
            yield pa.RecordBatch.from_arrays([*b.columns[: n_keep + 1], b.column(n_keep + 3), *(pa.array(x, pa.int64()) for x in (n, first, second))], names)

    return run


def fill_in_middle(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), seed: int = 42, percent: int = 50, spm_percent: int = 80) -> DataFrame:
    """The columns in ``keep``; ``n``, the text's tokens; ``form``: ``plain``, ``psm`` or ``spm``; ``prefix_chars`` and ``middle_chars``, null where plain;
    ``output``, the text in its new form. ``percent`` of the texts change, ``spm_percent`` of these have their suffix first."""
    small_batches(docs.sparkSession)
    code = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring(code, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]
    text = F.coalesce(F.col(text_col), F.lit(""))
    marked = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    form = F.when((text == "") | marked | (h[2] % 100 >= percent), "plain").when(h[3] % 100 < spm_percent, "spm").otherwise("psm")
    rows = docs.select(*keep, text.alias("_text"), h[0].alias("_h1"), h[1].alias("_h2"), form.alias("_form"))
    added = [T.StructField("_text", T.StringType()), T.StructField("form", T.StringType()), T.StructField("n", T.LongType()), T.StructField("_a", T.LongType()), T.StructField("_b", T.LongType())]
    cut = rows.mapInArrow(frugal(_cuts(len(keep), [*keep, *(f.name for f in added)])), T.StructType([*(docs.schema[c] for c in keep), *added]))
    part = lambda start, end: F.substring("_text", (start + 1).cast("int"), (end - start).cast("int"))
    a, b = F.col("_a"), F.col("_b")
    prefix, middle, suffix = part(F.lit(0), a), part(a, b), part(b, F.lit((1 << 31) - 1))
    output = F.when(F.col("form") == "plain", F.col("_text")).when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
    output = output.otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    moved = F.col("form") != "plain"
    return cut.select(*keep, "n", "form", F.when(moved, a).alias("prefix_chars"), F.when(moved, b - a).alias("middle_chars"), output.alias("output"))


def restore(output: Column, form: Column) -> Column:
    """The text that was there before: markers are only once in an output, so the parts lie between them."""
    part = lambda after, before: F.split_part(F.split_part(output, F.lit(after), F.lit(2)), F.lit(before), F.lit(1))
    middle = F.split_part(output, F.lit(MIDDLE), F.lit(2))
    psm = F.concat(part(PREFIX, SUFFIX), middle, part(SUFFIX, MIDDLE))
    spm = F.concat(part(PREFIX, MIDDLE), middle, part(SUFFIX, PREFIX))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
