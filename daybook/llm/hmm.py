"""A hidden Markov language model over words, trained on all training texts by distributed Baum-Welch.

A hidden state emits a word in two steps: one of CLASSES hashed classes by the state, then a word of the class by the word's
count. So the states' tables are of bounded size whatever the vocabulary, and go to every task, while counts of
words are joined. Each round of Baum-Welch sums the expected counts of all partitions. A text's likelihood is the
scaled forward recursion over its classes times the shares of its words in theirs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import held_out, kept, slices, sums, words_of

FOLDS, OUT = 7, 2
STATES = 8
CLASSES = 1 << 14
ROUNDS = 4
SEED = 11
#: Expected counts that are added before they become probabilities.
SMOOTH = 0.01
#: Words that every task holds with their counts, the most frequent ones; counts of all others are joined.
HEAD = 1 << 19
#: Steps of a text that Baum-Welch holds at a time; of what comes before, it keeps the state at the border alone.
STRETCH = 512
#: Tokens of all texts side by side that it holds at a time.
TOKENS = 1 << 20
#: Bytes of text that are scored side by side.
SCORED_BYTES = 8 << 20
#: The end of a text, a token like any word; no word holds white space.
END = "\n"


def word_hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) >> 1


def hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(word_hash, words), np.int64, len(words))


def class_of(hashed: np.ndarray) -> np.ndarray:
    """Each word's class; class 0 is the end's alone."""
    return np.where(hashed == word_hash(END), 0, 1 + hashed % (CLASSES - 1)).astype(np.int32)


def with_ends(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each distinct token, index of each token in turn, tokens of each text), the ends included."""
    words, codes, lengths = words_of(texts)
    out = np.full(len(codes) + len(lengths), len(words), dtype=np.int64)
    ends = np.cumsum(lengths + 1) - 1
    inside = np.ones(len(out), dtype=bool)
    inside[ends] = False
    out[inside] = codes
    return hashes([*words, END]), out, lengths + 1


@dataclass
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # class by state

    @classmethod
    def drawn(cls, class_counts: np.ndarray) -> Model:
        """States that stay, each with a random preference among the classes."""
        draw = np.random.default_rng(SEED)
        emit = (class_counts + 1.0)[:, None] * draw.gamma(1.0, size=(CLASSES, STATES))
        move = np.full((STATES, STATES), 0.1 / (STATES - 1))
        np.fill_diagonal(move, 0.9)
        return cls(np.full(STATES, 1 / STATES), move, emit / emit.sum(axis=0))

    def as_type(self, kind) -> Model:
        return Model(self.start.astype(kind), self.move.astype(kind), self.emit.astype(kind))

    @classmethod
    def counted(cls, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> Model:
        start, move = start + SMOOTH, move + SMOOTH
        # What is added to a class follows its own count, so that common classes stay common in every state.
        emit = emit + SMOOTH * (emit.sum(axis=1, keepdims=True) + 1) / STATES
        return cls(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def steps(lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Runs of sequences of like length: (their numbers, longest first; how many of them have a token at each step)."""
    order = np.argsort(-lengths, kind="stable")
    first = 0
    while first < len(order):
        last = first + max(1, TOKENS // max(1, min(STRETCH, int(lengths[order[first]]))))
        some = order[first:last]
        own = lengths[some]
        yield some, len(some) - np.searchsorted(own[::-1], np.arange(int(own[0])), side="right")
        first = last


def forward(
    model: Model, classes: np.ndarray, at: np.ndarray, alive: np.ndarray, state: np.ndarray | None = None, held: list | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(natural logarithm of the likelihood of each sequence, last scaled states), by the recursion over all side by side.

    ``at`` has the place of each sequence's first class, ``state`` the states before it, if it is not a text's first.
    ``held`` gets each step's classes, scaled states and scales.
    """
    total, ones = np.zeros(len(at)), np.ones(STATES, dtype=model.emit.dtype)
    for t, n in enumerate(alive):
        now_classes = classes[at[:n] + t]
        now = model.emit[now_classes]
        now *= model.start if state is None else state[:n] @ model.move
        scale = now @ ones
        now /= scale[:, None]
        state = now
        total[:n] += np.log(scale)
        if held is not None:
            held.append((now_classes, state, scale))
    return total, state


def expected(model: Model, sequences: Iterator[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected counts of first states, moves and emissions, by the forward and backward recursions over whole texts.

    The forward pass keeps the states before each stretch of STRETCH steps. The backward pass takes the stretches from
    the last to the first, works out the states of one again, and hands its last vector on to the stretch before. So what is
    held does not grow with the length of a text but for a vector a stretch.
    """
    counts = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((CLASSES, STATES))
    for classes, lengths in gathered(sequences):
        firsts = np.cumsum(lengths) - lengths
        for some, alive in steps(lengths):
            at, borders = firsts[some], [None]
            stretches = [(b, alive[b : b + STRETCH]) for b in range(0, len(alive), STRETCH)]
            for b, own in stretches[:-1]:
                borders.append(forward(model, classes, at + b, own, borders[-1])[1])
            back = np.ones((0, STATES), dtype=model.emit.dtype)
            for (b, own), border in zip(reversed(stretches), reversed(borders), strict=True):
                held: list = []
                forward(model, classes, at + b, own, border, held)
                back = _backward(model, own, held, border, back, counts)
    start, move, emitted = counts
    return start, move * model.move, emitted


def _backward(model: Model, alive: np.ndarray, held: list, border: np.ndarray | None, back: np.ndarray, counts: tuple) -> np.ndarray:
    """Adds a stretch's expected counts, moves still without the model's; returns what goes on to the stretch before."""
    start, move, emitted = counts
    seen, seen_at = [], []
    for t in range(len(alive) - 1, -1, -1):
        now, state, scale = held[t]
        if alive[t] > len(back):
            back = np.concatenate((back, np.ones((alive[t] - len(back), STATES), dtype=back.dtype)))
        seen.append(state * back)
        seen_at.append(now)
        before = held[t - 1][1] if t else border
        if before is None:
            start += seen[-1].sum(axis=0, dtype=np.float64)
        else:
            back = model.emit[now] * back
            back /= scale[:, None]
            move += before[: alive[t]].T @ back
            back = back @ model.move.T
    own, weight = np.concatenate(seen_at), np.concatenate(seen)
    for k in range(STATES):
        emitted[:, k] += np.bincount(own, weight[:, k], minlength=CLASSES)
    return back


def gathered(sequences: Iterator[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(all classes in turn, length of each sequence) of runs of sequences of some millions of classes."""
    some, size = [], 0
    for own in sequences:
        some.append(own)
        size += len(own)
        if size > 4 * TOKENS:
            yield np.concatenate(some), np.array([len(x) for x in some])
            some, size = [], 0
    if some:
        yield np.concatenate(some), np.array([len(x) for x in some])


def likelihoods(model: Model, classes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Natural logarithm of the likelihood of each text's classes, exact over its whole length."""
    out = np.zeros(len(lengths))
    firsts = np.cumsum(lengths) - lengths
    for some, alive in steps(lengths):
        out[some] = forward(model, classes, firsts[some], alive)[0]
    return out


def encoded(texts: DataFrame) -> DataFrame:
    """(classes): each text's classes as 16-bit integers, written to the shared folder for all rounds."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch["text"]):
                hashed, codes, lengths = with_ends(part)
                own = class_of(hashed).astype("<u2")[codes]
                ends = np.cumsum(lengths)
                rows = [own[e - n : e].tobytes() for e, n in zip(ends, lengths, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["classes"])

    return kept(texts.select("text").mapInArrow(encode, "classes binary"), "classes")


def word_counts(texts: DataFrame) -> DataFrame:
    """(h, c): how often each token of ``text`` occurs, the ends included."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch["text"]):
                hashed, codes, _ = with_ends(part)
                counts = np.bincount(codes, minlength=len(hashed))
                yield pa.RecordBatch.from_arrays([pa.array(hashed), pa.array(counts)], ["h", "c"])

    return texts.select("text").mapInArrow(count, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def baum_welch(sequences: DataFrame, model: Model) -> Model:
    """One round: every partition's expected counts, summed. Their number is that of the model's parameters."""
    shared = sequences.sparkSession.sparkContext.broadcast(model.as_type(np.float32))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = (np.frombuffer(row.as_buffer(), "<u2") for batch in batches for row in batch["classes"])
        start, move, emitted = expected(shared.value, own)
        used = np.flatnonzero(emitted.any(axis=1))
        at = np.concatenate((-1 - np.arange(STATES + 1), used))
        values = np.concatenate((start[None], move, emitted[used]))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(list(values))], ["at", "counts"])

    each = [F.sum(F.col("counts")[k]).alias(f"s{k}") for k in range(STATES)]
    found = sequences.mapInArrow(count, "at long, counts array<double>").groupBy("at").agg(*each)
    start, move, emitted = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((CLASSES, STATES))
    # At most CLASSES + STATES + 1 rows.
    for at, *values in found.collect():
        if at >= 0:
            emitted[at] = values
        elif at == -1:
            start[:] = values
        else:
            move[-2 - at] = values
    return Model.counted(start, move, emitted)


def totals(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, distinct tokens) of each class: at most CLASSES rows."""
    of = F.when(F.col("h") == word_hash(END), 0).otherwise(1 + F.col("h") % (CLASSES - 1))
    tokens, distinct = np.zeros(CLASSES, dtype=np.int64), np.zeros(CLASSES, dtype=np.int64)
    for at, n, v in counts.groupBy(of.alias("at")).agg(F.sum("c"), F.count("*")).collect():
        tokens[at], distinct[at] = n, v
    return tokens, distinct


def head(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(hashes in order, counts, floor): all words of more than ``floor`` training tokens, ``most`` at most."""
    by_count = counts.groupBy(F.least("c", F.lit(1 << 20)).alias("c")).agg(F.count("*").alias("n"))
    floor, room = 1 << 62, most
    for c, n in by_count.orderBy(F.col("c").desc()).toLocalIterator():
        if n > room:
            break
        floor, room = c - 1, room - n
    frequent = counts.filter(F.col("c") > floor).select("h", "c").toArrow()
    h, c = (np.asarray(frequent[name], dtype=np.int64) for name in ("h", "c"))
    order = np.argsort(h)
    return h[order], c[order], floor


def language_model(docs: DataFrame, most: int = HEAD, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row of ``docs``.

    Held out, and never learned from, is a row whose id's crc32 is 2 modulo 7, or that has no id. Null texts are empty:
    their one token is the end. ``score`` is the model's log10 probability of the text. A word that training lacks has
    the share in its class that one more occurrence of one more word would have. Repeated rows are learned from each.
    """
    texts = docs.select("doc_id", held_out(F.col("doc_id"), FOLDS, OUT).alias("held_out"), "text")
    training = texts.filter(~F.col("held_out"))
    counts = kept(word_counts(training), "words")
    tokens, distinct = totals(counts)
    all_tokens, vocabulary = int(tokens.sum()), int(distinct.sum())
    model = Model.drawn(tokens)
    if all_tokens:
        sequences = encoded(training)
        for _ in range(rounds):
            model = baum_welch(sequences, model)
    frequent, occurrences, floor = head(counts, most)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model, tokens + distinct + 1, frequent, np.log10(occurrences + 1.0)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, of_class, frequent, log_count = shared.value
        log_class = np.log10(of_class)
        for batch in batches:
            first = 0
            for part in slices(batch["text"], SCORED_BYTES):
                own = batch.slice(first, len(part))
                first += len(part)
                hashed, codes, lengths = with_ends(part)
                classes = class_of(hashed)
                at = np.minimum(np.searchsorted(frequent, hashed), max(0, len(frequent) - 1))
                known = frequent[at] == hashed if len(frequent) else np.zeros(len(hashed), dtype=bool)
                logs = np.where(known, log_count[at] if len(frequent) else 0.0, 0.0)
                by_class = likelihoods(model, classes[codes], lengths) / np.log(10) - sums(log_class[classes][codes], lengths)
                open_ = ~known[codes]
                rest = hashed[codes[open_]]
                left = sums(open_.astype(np.int64), lengths)
                offsets = pa.array(np.concatenate(([0], np.cumsum(left))), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        own["doc_id"],
                        own["held_out"],
                        pa.array(lengths),
                        pa.array(lengths - left),
                        pa.array(sums(logs[codes], lengths)),
                        pa.array(by_class),
                        pa.ListArray.from_arrays(offsets, pa.array(rest)),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_known", "logs", "by_class", "rest"],
                )

    doc_id = dict(docs.select("doc_id").dtypes)["doc_id"]
    schema = f"doc_id {doc_id}, held_out boolean, n_tokens long, n_known long, logs double, by_class double, rest array<long>"
    found = texts.mapInArrow(score, schema)
    if floor > 0:
        found = with_rare(kept(found, "scored"), counts.filter(F.col("c") <= floor))
    base = F.col("logs") - F.col("n_tokens") * float(np.log10(all_tokens + vocabulary + 1.0))
    return found.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(all_tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (F.col("logs") + F.col("by_class")).alias("score"),
    )


def with_rare(found: DataFrame, rare: DataFrame) -> DataFrame:
    """``found`` with the counts of rarer words joined; each of those has few tokens, so no key is hot."""
    numbered = found.withColumn("row", F.monotonically_increasing_id())
    numbered = kept(numbered, "numbered")
    met = numbered.select("row", F.explode("rest").alias("h")).join(rare, "h")
    more = met.groupBy("row").agg(F.sum(F.log10(F.col("c") + 1.0)).alias("more"), F.count("*").alias("n"))
    joined = numbered.drop("rest").join(more, "row", "left")
    return joined.withColumn("logs", F.col("logs") + F.coalesce("more", F.lit(0.0))).withColumn(
        "n_known", F.col("n_known") + F.coalesce("n", F.lit(0))
    )
