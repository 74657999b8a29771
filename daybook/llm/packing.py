"""Packing of token ids into windows whose mixture follows the sources' shares.

Each source's documents are a queue. Deficit round-robin gives every queue its share of each window, in whole tokens: the
fractions left over are its deficit, the largest deficits take the tokens that are left in the window, and all deficits go
on to the next window. As documents may be cut anywhere, what a queue has had before any window follows from the
shares alone. So every task works out the windows of its own documents, wherever their queues stand.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import kept, slices

WINDOW = 4096
END_ID = 2
#: Sources with a smaller share than this many tokens a window share a queue, which a round-robin of longer windows fills.
LEAST_QUOTA = 64
#: Distinct pieces of text whose ids a worker remembers.
REMEMBERED = 3 << 17

#: How the word tokenizer cuts text into pieces, fixed values of its file. Where a file says the same, plain text is cut here, so
#: that a piece is encoded once however often it occurs; all else goes through the tokenizer as it is.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
STEPS = ["NFC", "Replace", "Lowercase"]
END_OF_WORD = "</w>"
#: Printable ASCII but the apostrophe, and the letters of Latin-1: neither NFC nor a contraction changes those.
_PLAIN = "!-&(-~À-ÖØ-öø-ÿ"
_PLAIN_TEXT = re.compile(f"[\t-\r {_PLAIN}]*")
_PLAIN_CHUNK = re.compile(f"[{_PLAIN}]*")
_CHUNKS = re.compile("[^\t-\r ]+")
_PIECES = re.compile("[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9\t-\r ]+")

_encoders: dict[str, Encoder] = {}


def public_tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """A tokenizer file's ids for texts, as little-endian integers of ``kind``: 16 bits where the vocabulary allows it."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.kind = "<u2" if self.whole.get_vocab_size() <= 1 << 16 else "<u4"
        form = json.loads(self.whole.to_str())
        steps = [s["type"] for s in (form["normalizer"] or {}).get("normalizers", [])]
        cuts = (form["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        model = form["model"]
        self.cuts = steps == STEPS and cuts[0].get("pattern") == {"Regex": SPLIT} and model.get("end_of_word_suffix") == END_OF_WORD
        self.pieces: dict[str, bytes] = {}
        if self.cuts:
            merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
            bare = models.BPE(vocab=model["vocab"], merges=merges, end_of_word_suffix=END_OF_WORD, cache_capacity=0)
            self.bare = Tokenizer(bare)
            bytewise = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            self.bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), bytewise])
            self.ends = np.zeros(self.whole.get_vocab_size(), dtype=bool)
            for token, i in model["vocab"].items():
                self.ends[i] = token.endswith(END_OF_WORD)

    def __call__(self, texts: list[str]) -> list[bytes]:
        if not self.cuts:
            whole = self.whole.encode_batch_fast(texts, add_special_tokens=False)
            return [np.array(found.ids, dtype=self.kind).tobytes() for found in whole]
        if len(self.pieces) > REMEMBERED:
            self.pieces.clear()
        known = self.pieces
        cut = [_PIECES.findall(t.lower()) if self.plain(_PLAIN_TEXT, t) else self.mixed(t) for t in texts]
        self.learn(set().union(*cut).difference(known))
        return [b"".join([known[p] for p in pieces]) for pieces in cut]

    @staticmethod
    def plain(pattern: re.Pattern, text: str) -> bool:
        return pattern.fullmatch(text) is not None and "<|" not in text

    def mixed(self, text: str) -> list[str]:
        """The pieces of a text's plain chunks; each other chunk stands whole, marked, and is encoded as it is."""
        out = []
        for chunk in _CHUNKS.findall(text):
            if self.plain(_PLAIN_CHUNK, chunk):
                out += _PIECES.findall(chunk.lower())
            else:
                out.append(marked := f" {chunk}")
                if marked not in self.pieces:
                    ids = self.whole.encode(chunk, add_special_tokens=False).ids
                    self.pieces[marked] = np.array(ids, dtype=self.kind).tobytes()
        return out

    def learn(self, new: set[str]) -> None:
        """Encode many pieces as one text; each ends with the one token that ends a word."""
        pieces = list(new)
        runs = [pieces[i : i + 1024] for i in range(0, len(pieces), 1024)]
        for run, found in zip(runs, self.bare.encode_batch_fast([" ".join(r) for r in runs], add_special_tokens=False), strict=True):
            ids = np.array(found.ids, dtype=self.kind)
            data, ends = ids.tobytes(), ((np.flatnonzero(self.ends[ids]) + 1) * ids.itemsize).tolist()
            for piece, first, last in zip(run, [0, *ends], ends, strict=False):
                self.pieces[piece] = data[first:last]


def text_ids(texts: list[str], path: str) -> tuple[list[bytes], int]:
    """(each text's ids and the end id, bytes of an id)."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    end = np.array([END_ID], dtype=_encoders[path].kind).tobytes()
    return [ids + end for ids in _encoders[path](texts)], len(end)


def tokenized(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, source, part, before, ids, n) of each row, written to the shared folder.

    ``ids`` are ``n`` integers of the least width that the vocabulary allows. ``part`` numbers the task that read it, ``before`` counts the tokens of the same source that the task read before.
    """
    rows = docs.select("doc_id", "source", F.col("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, read = TaskContext.get().partitionId(), {}
        for batch in batches:
            first = 0
            for texts in slices(batch["text"]):
                own = batch.slice(first, len(texts))
                first += len(texts)
                ids, width = text_ids(texts.to_pylist(), path)
                n = [len(i) // width for i in ids]
                before = []
                for source, size in zip(own["source"].to_pylist(), n, strict=True):
                    before.append(read.get(source, 0))
                    read[source] = before[-1] + size
                columns = [own["doc_id"], own["source"], pa.array([part] * len(n), pa.int32()), pa.array(before, pa.int64()), pa.array(ids, pa.binary()), pa.array(n, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "source", "part", "before", "ids", "n"])

    types = dict(docs.select("doc_id", "source").dtypes)
    schema = f"doc_id {types['doc_id']}, source {types['source']}, part int, before long, ids binary, n long"
    return kept(rows.mapInArrow(encode, schema), "tokens")


class Rounds:
    """What each queue has had before any window, from the queues' tokens alone."""

    def __init__(self, tokens: list[int], window: int = WINDOW):
        self.tokens, self.window, self.total = tokens, window, sum(tokens)
        # A queue of under a token a window gets whole tokens as they fall due, never one in advance.
        self.advance = [i for i, t in enumerate(tokens) if t * window >= self.total]
        self._had: dict[int, tuple[list[int], list[int]]] = {}

    def had(self, k: int) -> list[int]:
        """Tokens that each queue has had before window ``k``."""
        return self.state(k)[0]

    def state(self, k: int) -> tuple[list[int], list[int]]:
        """(what each queue has had, the sums over the queues before it). Deficits are what is due beyond whole tokens."""
        if k not in self._had:
            if len(self._had) * len(self.tokens) > 1 << 20:
                self._had.clear()
            due = min(k * self.window, self.total)
            whole = [divmod(due * t, self.total) for t in self.tokens]
            had = [w for w, _ in whole]
            left = due - sum(had)
            for i in sorted(self.advance, key=lambda i: (-whole[i][1], i))[:left]:
                had[i] += 1
            self._had[k] = had, list(accumulate(had, initial=0))
        return self._had[k]

    def at(self, queue: int, position: int) -> int:
        """The window that holds this token of the queue."""
        k = position * self.total // (self.tokens[queue] * self.window)
        while self.had(k)[queue] > position:
            k -= 1
        while self.had(k + 1)[queue] <= position:
            k += 1
        return k

    def pieces(self, queue: int, start: int, length: int) -> Iterator[tuple[int, int, int, int]]:
        """(first, length, window, offset) of the pieces of a document that stands at ``start`` of its queue."""
        k, first = self.at(queue, start), 0
        while first < length:
            (now, now_before), (then, then_before) = self.state(k), self.state(k + 1)
            size = min(length - first, then[queue] - (start + first))
            if size > 0:
                yield first, size, k, then_before[queue] - now_before[queue] + start + first - now[queue]
            first += max(size, 0)
            k += 1


def through(levels: list[Rounds], level: int, queue: int, start: int, length: int) -> Iterator[tuple[int, int, int, int]]:
    """As ``Rounds.pieces`` of the outermost level: what a level deals out is, in its order, the last queue of the level before it."""
    if not level:
        yield from levels[0].pieces(queue, start, length)
        return
    outer, last = len(levels[level - 1].tokens) - 1, None
    for first, size, k, offset in levels[level].pieces(queue, start, length):
        at = k * levels[level].window + offset
        for begin, own, window, place in through(levels, level - 1, outer, at, size):
            if last and last[2] == window and last[3] + last[1] == place:
                last = last[0], last[1] + own, window, last[3]
            else:
                if last:
                    yield last
                last = first + begin, own, window, place
    if last:
        yield last


def nested(sizes: list[int], window: int, least: int) -> tuple[list[tuple[int, int]], list[tuple[list[int], int]]]:
    """((level, queue) of each source, (tokens of the queues, window) of each level).

    A source with ``least`` tokens a window or more has a queue of its level; all others are its last queue, which the next level
    deals out in longer windows. Each level takes the sources of half the largest size that is left or more, so levels are few.
    """
    places: list[tuple[int, int]] = [(0, 0)] * len(sizes)
    levels: list[tuple[list[int], int]] = []
    left = list(range(len(sizes)))
    while left:
        total = sum(sizes[i] for i in left)
        if levels:
            window = -(-2 * least * total // max(sizes[i] for i in left))
        named = [i for i in left if sizes[i] * window >= total * least]
        for queue, i in enumerate(named):
            places[i] = len(levels), queue
        rest = total - sum(sizes[i] for i in named)
        levels.append(([sizes[i] for i in named] + [rest] * (rest > 0), window))
        left = [i for i in left if sizes[i] * window < total * least]
    return places, levels


def queues(tokens: DataFrame, window: int, least: int) -> tuple[DataFrame, list[tuple[list[int], int]]]:
    """((source, part, level, queue, base), (tokens of the queues, window) of each level). The driver holds a number per source."""
    sizes = kept(tokens.groupBy("source", "part").agg(F.sum("n").alias("n")), "parts")
    by_source = sizes.groupBy("source").agg(F.sum("n").alias("size")).orderBy(F.col("source").asc_nulls_last()).collect()
    places, levels = nested([r["size"] for r in by_source], window, least)
    kind = dict(tokens.dtypes)["source"]
    rows = [(r.source, *place) for r, place in zip(by_source, places, strict=True)]
    numbers = tokens.sparkSession.createDataFrame(rows, f"named {kind}, level int, queue int")
    order = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.withColumn("base", F.coalesce(F.sum("n").over(order), F.lit(0)))
    placed = placed.join(numbers, placed["source"].eqNullSafe(numbers["named"]))
    return placed.select("source", "part", "level", "queue", "base"), levels


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, least: int = LEAST_QUOTA) -> DataFrame:
    """The pieces of all documents: (doc_id, start, ids, doc_tokens, sequence_id, offset); ids as 32-bit little-endian.

    Windows are full, the last one excepted. Null and empty texts are the end id alone. Repeated rows are packed
    each; null sources are a source. Other columns are not read.
    """
    tokens = tokenized(docs, path or public_tokenizer())
    bases, levels = queues(tokens, window, least)
    bases = kept(bases, "bases")
    same = tokens["source"].eqNullSafe(bases["source"]) & (tokens["part"] == bases["part"])
    placed = tokens.join(bases, same).select("doc_id", "level", "queue", (F.col("base") + F.col("before")).alias("at"), "ids", "n")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rounds = [Rounds(*level) for level in levels]
        for batch in batches:
            rows = []
            columns = (batch[c].to_pylist() for c in ("level", "queue", "at", "ids", "n"))
            for i, (level, queue, at, ids, n) in enumerate(zip(*columns, strict=True)):
                if len(ids) < 4 * n:
                    ids = np.frombuffer(ids, "<u2").astype("<u4").tobytes()
                for first, size, k, offset in through(rounds, level, queue, at, n):
                    rows.append((i, first, ids[4 * first : 4 * (first + size)], n, k, offset))
            if rows:
                i, start, ids, n, k, offset = zip(*rows, strict=True)
                numbers = [pa.array(x, pa.int64()) for x in (start, n, k, offset)]
                out = [batch["doc_id"].take(pa.array(i)), numbers[0], pa.array(ids, pa.binary()), *numbers[1:]]
                yield pa.RecordBatch.from_arrays(out, ["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset"])

    doc_id = dict(docs.select("doc_id").dtypes)["doc_id"]
    schema = f"doc_id {doc_id}, start long, ids binary, doc_tokens long, sequence_id long, offset long"
    return placed.mapInArrow(cut, schema)


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with the length and the CRC-32 of their ids in their place."""
    return pieces.select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("length"),
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids, n): each window's ids, in order, before padding. A group holds one window."""
    ordered = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("pieces"))
    ids = F.aggregate(F.col("pieces"), F.lit(b""), lambda so_far, p: F.concat(so_far, p["ids"]))
    return ordered.select("sequence_id", ids.alias("ids")).withColumn("n", (F.octet_length("ids") / 4).cast("int"))
