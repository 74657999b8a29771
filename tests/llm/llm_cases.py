"""Small tables with every awkward case, for all operators."""

import numpy as np

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use inside.
CLASHES = "row string, t string, size long, range long, score double, fp long, h string, source_size long, queue int"
LABELS = "doc_id long, quality int, toxic int"
VECTORS = "vec_id long, embedding array<float>, label int"

LONG = " ".join(f"w{i % 977} x{i % 13}" for i in range(15_000))

AWKWARD = [
    (1, "one two three four five\nthe same line everywhere\nOne last", "en", "a"),
    (1, "one two three four five\nthe same line everywhere\nOne last", "en", "a"),  # repeated
    (1, "another text under the same id", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, "b"),
    (4, " \t\n\r\x0b\x0c ", "en", "b"),
    (None, "a text without an id", "en", "b"),
    (None, "a text without an id", "en", "b"),
    (None, None, None, None),
    (5, LONG, "en", "c"),
    (6, LONG + " and a tail", "en", "c"),
    (7, "one two three four five\nthe same line everywhere\none last", "en", "a"),
    (8, "Ünïcode   “quoted” 日本語 é́ <|endoftext|> it's 'll \x00 \x1f x", "fr", None),
    (9, "x", "en", ""),
    (10, "\n\nthe same line everywhere\n\n  the same line everywhere  \n", "en", "d"),
]


def awkward(spark):
    docs = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in AWKWARD], DOCS)
    names = [c.strip().split() for c in CLASHES.split(",")]
    return docs.selectExpr("*", *(f"cast(1 as {kind}) as {name}" for name, kind in names))


def documents(spark, rows):
    return spark.createDataFrame([(i, text, "en", source, len(text or "")) for i, text, source in rows], DOCS)


def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 0, 1), (5, 1, None), (None, 1, 1), (7, None, 0), (99, 1, 1)], LABELS)


def words(text):
    """Words by the definition, not by a library's split."""
    out, word = [], ""
    for c in text or "":
        if c == " " or "\x09" <= c <= "\x0d":
            out += [word] * bool(word)
            word = ""
        else:
            word += c
    return out + [word] * bool(word)


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def vectors(spark, n=400, length=16, seed=1):
    """Random vectors, copies of one, scaled copies, and all that take no part."""
    draw = np.random.default_rng(seed).normal(size=(n, length)).astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(draw)]
    rows += [(1000 + i, draw[7].tolist(), 0) for i in range(60)]  # 1000 and 1050 ask
    rows += [(1100 + i, (draw[50] * 2).tolist(), 0) for i in range(3)]
    rows += [rows[3], rows[50]]
    nan, inf = float("nan"), float("inf")
    rows += [(2000, None, 0), (2050, [0.0] * length, 0), (2100, [nan] * length, 0), (2150, [inf] + [0.0] * (length - 1), 0)]
    rows += [(2200, [None] + [0.0] * (length - 1), 0), (None, draw[0].tolist(), 0), (2250, [1.0, 2.0], 0), (2300, [], 0)]
    return spark.createDataFrame(rows, VECTORS), rows
