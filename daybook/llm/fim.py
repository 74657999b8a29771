"""Fill-in-middle transformation by a learned rank index.

A text is cut between tokens: a word with the white space before it, or the white space at the end. The offsets of all
token bounds of a block of texts, rank after rank, are nearly a straight line; segments of a bounded error stand for
them, with what each is off by. A cut is given as a rank: its segment predicts the offset, the residual corrects it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import slices

SEED = 42
#: Of 100 texts, those that are cut at all; of 100 cut ones, those whose suffix comes first.
CUT, SUFFIX_FIRST = 50, 80
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: A segment is off by this many bytes at most, before rounding.
ERROR = 64
#: Bounds that the fit of a segment looks at first; twice as many each time they fit.
FIRST_LOOK, MOST_LOOK = 128, 8192

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


@dataclass(frozen=True)
class RankIndex:
    """The offset of each rank 0, 1, ...: segments by their first rank, offset there and slope, and residuals."""

    first: np.ndarray
    offset: np.ndarray
    slope: np.ndarray
    residual: np.ndarray

    @classmethod
    def fit(cls, offsets: np.ndarray, error: int = ERROR) -> RankIndex:
        """Segments as long as a line through the first offset of each stays within ``error`` of the others."""
        first, slope, start = [], [], 0
        while start < len(offsets):
            end, steepness = _longest(offsets, start, error)
            first.append(start)
            slope.append(steepness)
            start = end
        at = np.array(first, dtype=np.int64)
        empty = np.zeros(0, dtype=np.int8)
        bare = cls(at, offsets[at], np.array(slope, dtype=np.float64), empty)
        off = offsets - bare.predicted(np.arange(len(offsets)))
        kind = np.result_type(*(np.min_scalar_type(-abs(int(v)) - 1) for v in (off.min(), off.max()))) if len(off) else np.int8
        return cls(bare.first, bare.offset, bare.slope, off.astype(kind))

    def predicted(self, ranks: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.first, ranks, side="right") - 1
        return self.offset[at] + np.floor(self.slope[at] * (ranks - self.first[at])).astype(np.int64)

    def exact(self, ranks: np.ndarray) -> np.ndarray:
        return self.predicted(ranks) + self.residual[ranks]


def _longest(offsets: np.ndarray, start: int, error: int) -> tuple[int, float]:
    """(end, slope) of the longest segment from ``start``: slopes within reach of every offset narrow to a cone."""
    low, high, at, look = -np.inf, np.inf, start + 1, FIRST_LOOK
    while at < len(offsets):
        stop = min(len(offsets), at + look)
        run, rise = np.arange(at - start, stop - start), offsets[at:stop] - offsets[start]
        lows = np.maximum.accumulate(np.maximum((rise - error) / run, low))
        highs = np.minimum.accumulate(np.minimum((rise + error) / run, high))
        reach = int(np.searchsorted(lows > highs, True))  # once apart, they stay apart
        if reach:
            low, high = float(lows[reach - 1]), float(highs[reach - 1])
        at += reach
        if at < stop:
            break
        look = min(2 * look, MOST_LOOK)
    return at, (low + high) / 2 if at > start + 1 else 0.0


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts in turn, offsets of their starts and of the last end) of an array without nulls."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, bounds, data = texts.buffers()
    if not len(texts) or data is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    at = np.frombuffer(bounds, dtype=kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def token_ends(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Offsets behind each token, in turn."""
    space = _SPACE[data]
    ends = np.empty_like(space)
    ends[:-1] = ~space[:-1] & space[1:]
    ends[bounds[1:][np.diff(bounds) > 0] - 1] = True
    return np.flatnonzero(ends) + 1


def cuts(texts: pa.Array, one: np.ndarray, other: np.ndarray, error: int = ERROR) -> tuple[np.ndarray, ...]:
    """(tokens, characters of the prefix, characters of the middle) of each text, cut by two draws."""
    data, bounds = text_bytes(texts)
    starts, n_texts = bounds[:-1], len(texts)
    ends = token_ends(data, bounds)
    before = np.searchsorted(ends, starts, side="right")
    n = np.searchsorted(ends, bounds[1:], side="right") - before
    n[np.diff(bounds) == 0] = 0
    # Ranks of a text begin with its start, so a text of n tokens has n + 1 of them.
    base = before + np.arange(n_texts)
    offsets = np.empty(len(ends) + n_texts, dtype=np.int64)
    inner = np.ones(len(offsets), dtype=bool)
    inner[base] = False
    offsets[base], offsets[inner] = starts, ends
    index = RankIndex.fit(offsets, error)
    one, other = one % (n + 1), other % (n + 1)
    first, second = index.exact(base + np.minimum(one, other)), index.exact(base + np.maximum(one, other))
    chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    return n, chars[first] - chars[starts], chars[second] - chars[first]


def _cut(text: Column, one: Column, other: Column) -> Column:
    def of(texts: pa.Array, ones: pa.Array, others: pa.Array) -> pa.Array:
        parts, done = [], 0
        a, b = np.asarray(ones, dtype=np.int64), np.asarray(others, dtype=np.int64)
        for part in slices(texts):
            here = slice(done, done := done + len(part))
            parts.append(cuts(part, a[here], b[here]))
        sides = zip(*parts, strict=True) if parts else [[np.zeros(0, dtype=np.int64)]] * 3
        names = ("n", "prefix_chars", "middle_chars")
        return pa.StructArray.from_arrays([pa.array(np.concatenate(side), pa.int64()) for side in sides], names=names)

    return F.arrow_udf(of, "n long, prefix_chars long, middle_chars long")(text, one, other)


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four numbers of 32 bits from the SHA-256 of the seed and the id; a null id has no digits."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, seed: int = SEED, cut: int = CUT, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """(row, text, n, form, prefix_chars, middle_chars, output) of each row of ``docs``, the whole row among them.

    Every draw comes from the id, so reruns agree and rows under one id are drawn alike, each over its own text. Null
    texts are empty. Texts that are empty, hold a mark, or are not drawn stay ``plain``; a part may be empty. A text of
    any length is one value, as it was before. Other columns are only carried, in ``row``; an empty table gives none.
    """
    one, other, drawn, order = draws(F.col("doc_id"), seed)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.struct("*").alias("row"), text.alias("text"), one.alias("h1"), other.alias("h2"), drawn.alias("h3"), order.alias("h4")
    )
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains("text", F.lit(mark))
    plain = (F.col("text") == "") | marked | (F.col("h3") % 100 >= cut)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < suffix_first, "spm").otherwise("psm")
    found = rows.withColumns({"form": form, "at": _cut(F.col("text"), F.col("h1"), F.col("h2"))})
    is_cut = F.col("form") != "plain"
    found = found.select(
        "row", "text", "at.n", "form", *(F.when(is_cut, F.col(f"at.{c}")).alias(c) for c in ("prefix_chars", "middle_chars"))
    )
    second = F.col("prefix_chars") + F.col("middle_chars")
    prefix, middle = (F.substr("text", F.lit(1), F.col("prefix_chars")), F.substr("text", F.col("prefix_chars") + 1, F.col("middle_chars")))
    suffix = F.substr("text", second + 1)
    p, s, m = F.lit(PREFIX), F.lit(SUFFIX), F.lit(MIDDLE)
    output = (
        F.when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle))
        .when(F.col("form") == "spm", F.concat(s, suffix, p, prefix, m, middle))
        .otherwise(F.col("text"))
    )
    return found.withColumn("output", output)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from. A cut text holds no mark, so each mark of its output stands there once."""

    def between(first: str, last: str) -> Column:
        return F.split_part(F.split_part(output, F.lit(first), F.lit(2)), F.lit(last), F.lit(1))

    middle = F.split_part(output, F.lit(MIDDLE), F.lit(2))
    psm = F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digest(found: DataFrame) -> DataFrame:
    """What :func:`fill_in_middle` gives, with checksums of the output and of the text rebuilt from it."""
    back = restored(F.col("output"), F.col("form"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"),
    )
