"""Fill-in-middle, source divergence and licence scans against SQL, brute force and properties."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import AWKWARD, DOCS, awkward, documents, lowered
from test_llm_text import as_rows, by_sql

from daybook.llm import divergence, fim, licences
from daybook.llm.queries import llm_queries

NEW = ["op11_fill_in_middle", "op12_source_divergence", "op13_licences"]
APPLY = {
    "op11_fill_in_middle": lambda docs: fim.digest(fim.fill_in_middle(docs)),
    "op12_source_divergence": divergence.divergence,
    "op13_licences": licences.licences,
}


@pytest.mark.parametrize("name", NEW)
def test_awkward_rows_equal_sql(spark, name):
    df = APPLY[name](awkward(spark))
    found = as_rows(df.columns, df.collect())
    assert found == by_sql(name, documents=awkward(spark)) and len(found) >= len(AWKWARD)


@pytest.mark.parametrize("name", NEW)
def test_empty_tables_give_no_rows(spark, name):
    assert APPLY[name](spark.createDataFrame([], DOCS)).collect() == []


# Fill-in-middle

TOKEN = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
TEXTS = st.lists(st.text(alphabet="ab \t\n\x0b é日😀<PSM>", max_size=60), max_size=12)


@given(TEXTS, st.integers(0, 40), st.randoms(use_true_random=False))
@settings(max_examples=150, deadline=None)
def test_cuts_by_definition(texts, error, rnd):
    one, other = (np.array([rnd.getrandbits(32) for _ in texts], dtype=np.int64) for _ in range(2))
    n, prefix, middle = fim.cuts(pa.array(texts, pa.string()), one, other, error)
    for i, text in enumerate(texts):
        tokens = TOKEN.findall(text)
        a, b = sorted((int(one[i]) % (len(tokens) + 1), int(other[i]) % (len(tokens) + 1)))
        assert (n[i], prefix[i], middle[i]) == (len(tokens), len("".join(tokens[:a])), len("".join(tokens[a:b])))


@given(st.lists(st.integers(0, 500), min_size=1, max_size=400), st.integers(0, 64))
@settings(max_examples=100, deadline=None)
def test_segments_are_off_by_no_more_than_the_error(steps, error):
    offsets = np.cumsum(np.array(steps, dtype=np.int64))
    index = fim.RankIndex.fit(offsets, error)
    ranks = np.arange(len(offsets))
    assert (index.exact(ranks) == offsets).all()
    assert np.abs(index.residual.astype(np.int64)).max() <= error + 1
    assert len(index.first) == 1 + sum(a > 0 for a in index.first)


def test_even_offsets_are_one_segment_and_a_jump_begins_another():
    assert len(fim.RankIndex.fit(np.arange(0, 700_000, 7)).first) == 1
    assert list(fim.RankIndex.fit(np.array([0, 5, 10, 10_000, 10_005])).first) == [0, 3]


def test_slices_of_longer_arrays_are_cut_alike():
    texts = pa.array(["a b c", "d e", "", "f g h i"]).slice(1, 3)
    n, prefix, middle = fim.cuts(texts, np.array([1, 0, 3]), np.array([1, 0, 1]))
    assert (n.tolist(), prefix.tolist(), middle.tolist()) == ([2, 0, 4], [1, 0, 1], [0, 0, 4])


def test_outputs_hold_the_marks_in_order_and_give_the_text_back(spark):
    texts = ["one two  three\n", "a <S> b", "", "<", "< <P <", "x " * 5000 + "<M"] * 40
    docs = documents(spark, [(i, t, "s") for i, t in enumerate(texts)])
    found = fim.fill_in_middle(docs)
    rows = found.select("*", fim.restored(found["output"], found["form"]).alias("back")).collect()
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    for r in rows:
        assert r.back == r.text
        h = hashlib.sha256(f"42:{r.row.doc_id}".encode()).hexdigest()
        if r.text == "" or "<S>" in r.text or int(h[16:24], 16) % 100 >= 50:
            assert (r.form, r.output, r.prefix_chars, r.middle_chars) == ("plain", r.text, None, None)
        else:
            marks = ("<S>", "<P>", "<M>") if int(h[24:32], 16) % 100 < 80 else ("<P>", "<S>", "<M>")
            assert (r.form == "spm") == (marks[0] == "<S>")
            assert [m for m in re.findall("<[PSM]>", r.output)] == list(marks)


# Source divergence


def test_divergence_by_definition(spark):
    rnd = random.Random(3)
    vocabulary = [f"w{chr(97 + i)}" for i in range(20)] + ["Été", "日本", "x"]
    rows = [
        (i, " ".join(rnd.choices(vocabulary[s : s + 12], k=rnd.randrange(15))), lang, f"s{s}")
        for i, (lang, s) in enumerate((rnd.choice(["en", "fr", None]), rnd.randrange(5)) for _ in range(300))
    ]
    rows.append((1000, "rare", "en", "bare"))
    docs = spark.createDataFrame([(*r, 0) for r in rows], DOCS)
    want = []
    for lang in ("en", "fr", ""):
        mine = [(re.findall("[a-z\x80-\U0010ffff]+", lowered(text)), s) for _, text, la, s in rows if (la or "") == lang]
        df = Counter(t for terms, _ in mine for t in set(terms))
        kept = [t for t in df if df[t] >= 8]
        count = {s: Counter(t for terms, s2 in mine if s2 == s for t in terms if t in kept) for s in {s for _, s in mine}}
        whole = sum(count.values(), Counter())

        def share(c, n, kept=kept):
            return 1 + 10**9 * (c + 5) // (n + 5 * len(kept))

        p = {s: {t: share(c[t], c.total()) for t in kept} for s, c in count.items()}
        q = {t: share(whole[t], whole.total()) for t in kept}
        for s in p:
            pairs = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in p if o != s)
            terms = sorted((q[t] - p[s][t], t.encode(), t) for t in kept if count[s][t] and p[s][t] > q[t])
            want += [(lang, s, "pair", o, -v, r) for r, (v, _, o) in enumerate(pairs, 1)]
            want += [(lang, s, "term", t, -v, r) for r, (v, _, t) in enumerate(terms[:4], 1)]
    found = [tuple(r) for r in divergence.divergence(docs, least_docs=8, ranks=4).collect()]
    assert sorted(found) == sorted(want)


@pytest.mark.parametrize("held, block", [(1, 1), (3, 30), (1 << 18, 1 << 21)])
def test_parts_and_blocks_add_up(spark, monkeypatch, held, block):
    rows = [(i, "aa bb" if i % 3 else "bb cc dd", "en", f"s{i % 4}", 0) for i in range(200)]
    docs = spark.createDataFrame(rows, DOCS)
    monkeypatch.setattr(divergence, "HELD", held)
    monkeypatch.setattr(divergence, "BLOCK", block)
    found = divergence.divergence(docs)
    assert as_rows(found.columns, found.collect()) == by_sql("op12_source_divergence", documents=docs)


@given(st.lists(st.integers(0, 10**13), min_size=1, max_size=20), st.integers(1, 10**6))
@settings(max_examples=100, deadline=None)
def test_shares_are_exact(counts, terms):
    size = sum(counts) + 5 * terms
    assert divergence.shares(np.array(counts), size).tolist() == [1 + 10**9 * (c + 5) // size for c in counts]


def test_share_columns_are_exact(spark):
    rows = [(3, 10, 2), (0, 0, 1), (10**13, 3 * 10**15, 10**6), (7, 7, 1)]
    df = spark.createDataFrame(rows, "c long, n long, v long")
    found = [r[0] for r in df.select(divergence.share(*map(df.__getitem__, "cnv"))).collect()]
    assert found == [1 + 10**9 * (c + 5) // (n + 5 * v) for c, n, v in rows]


# Licences


def wordings(markup, rnd):
    """A text that a template accepts, its regions filled at random."""
    out = []
    for part in licences.parsed(markup) if isinstance(markup, str) else markup:
        if isinstance(part, str):
            out.append(part)
        elif isinstance(part, tuple):
            out += [rnd.choice(["acme", "the", "9"]) for _ in range(rnd.randint(*part))]
        elif rnd.random() < 0.5:
            out += wordings(rnd.choice(part), rnd)
    return out


def accepted_at(parts, words, at):
    """Ends of all runs from ``at`` that a template accepts, by trying everything."""
    ends = {at}
    for part in parts:
        if isinstance(part, str):
            ends = {e + 1 for e in ends if e < len(words) and words[e] == part}
        elif isinstance(part, tuple):
            ends = {e + n for e in ends for n in range(part[0], part[1] + 1) if e + n <= len(words)}
        else:
            ends = ends | {f for e in ends for alternative in part for f in accepted_at(alternative, words, e)}
    return ends


MARKUPS = ("a b", "[x] a [b|c d] e", "a {1-2} b", "{0-1} d [e [f]] a", "a [{1-2}] c")


@given(st.lists(st.sampled_from("abcdefxz"), max_size=14))
@settings(max_examples=400, deadline=None)
def test_places_by_trying_everything(words):
    scanner = licences.Scanner(MARKUPS)
    found = scanner.places(scanner.numbered([w.encode() for w in words]))
    want = []
    for t, markup in enumerate(MARKUPS):
        parts = licences.parsed(markup)
        for first in range(len(words)):
            if ends := accepted_at(parts, words, first):
                want.append((t, first, min(ends)))
    assert sorted(found) == sorted(want)


def test_every_template_accepts_its_wordings_and_nothing_less(spark):
    rnd, rows, want = random.Random(5), [], []
    for label, markup in licences.TEMPLATES:
        parts = licences.parsed(markup)
        for _ in range(4):
            words = wordings(markup, rnd)
            must = [i for i, w in enumerate(words) if w in parts]
            cut = rnd.choice(must)
            for changed in (words, [*words[:cut], "other", *words[cut + 1 :]], [*words[:cut], "very", *words[cut:]]):
                text = "Before. " + ", ".join(w.upper() if rnd.random() < 0.2 else w for w in changed) + "\nafter"
                rows.append((len(rows), text, "s"))
                given_words = ["before", *changed, "after"]
                labels = {
                    la
                    for la, m in (*licences.TEMPLATES, *((v, k) for k, v in licences.PHRASES.items()))
                    if any(accepted_at(licences.parsed(m), given_words, i) for i in range(len(given_words)))
                }
                want.append((len(rows) - 1, ",".join(sorted(labels))))
                assert changed is not words or label in labels
    found = licences.licences(documents(spark, rows)).select("doc_id", "labels").collect()
    assert sorted(map(tuple, found)) == want


def test_places_are_counted_and_base_labels_stay(spark):
    text = "MIT License, mit-license; CC BY-NC 4.0. Licensed under CC BY-NC 4.0 (the Apache License)"
    (row,) = licences.licences(documents(spark, [(1, text, "s")])).collect()
    assert (row.n_base, row.first_word, row.last_word) == (5, 0, 17)
    assert row.base_labels == "apache,cc-by,mit" and row.labels == "apache,cc-by,cc-by-nc,mit" and 0.8 < row.score < 1


@pytest.mark.parametrize("markup", ["[a", "a]", "a | b", "{2-1} a", "[a]", "A b", "a.b", "{1-2}"])
def test_markup_that_means_nothing_is_refused(markup):
    with pytest.raises(ValueError):
        licences.compiled((markup,))


def test_remembered_steps_are_bounded(monkeypatch):
    monkeypatch.setattr(licences, "REMEMBERED", 2)
    scanner = licences.Scanner(MARKUPS)
    words = list("xabaecdeazzb")
    assert scanner.places(scanner.numbered([w.encode() for w in words])) == licences.Scanner(MARKUPS).places(
        scanner.numbered([w.encode() for w in words])
    )
    assert len(scanner._steps) <= 2


def test_queries_are_registered():
    assert set(NEW) <= set(llm_queries())
