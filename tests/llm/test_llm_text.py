"""Fingerprints, lines, mixing, packing and sharding against brute force and SQL."""

import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest
import xxhash
from llm_cases import AWKWARD, awkward, documents, lowered, words
from tokenizers import Tokenizer

from daybook.llm import components as links_module
from daybook.llm import graytree, linededup, mixing, packing, prefix, sharding, simhash
from daybook.llm.oracle import llm_oracles
from daybook.llm.queries import llm_queries

ORACLES = llm_oracles()


def as_rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([row[i] for i in order]) for row in data)


def by_sql(name, **tables):
    connection = duckdb.connect()
    for table, frame in tables.items():
        connection.register(table, frame.toArrow())
    cursor = connection.execute(ORACLES[name])
    return as_rows([c[0] for c in cursor.description], cursor.fetchall())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, data, name):
    tables = {t: spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "embeddings")}
    df = llm_queries()[name](spark, data)
    assert as_rows(df.columns, df.collect()) == by_sql(name, **tables)


# SimHash


def fingerprint(text):
    w = words(lowered(text))
    grams = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(nodes, near):
    """{node: its component as a frozenset}, by search from each node."""
    out = {}
    for n in nodes:
        if n not in out:
            seen, todo = {n}, [n]
            while todo:
                todo += (new := [m for m in nodes if m not in seen and near(todo[-1], m)]) and [] or []
                todo.pop()
                seen.update(new)
                todo += new
            out |= dict.fromkeys(seen, frozenset(seen))
    return out


def groups(rows):
    prints = [fingerprint(text) for _, text in rows]
    together = smallest_reachable(sorted(set(prints)), lambda a, b: (a ^ b).bit_count() <= 2)
    least = defaultdict(list)
    for (i, _), fp in zip(rows, prints, strict=True):
        least[together[fp]] += [i] * (i is not None)
    return [(i, f"{fp:016x}", min(least[together[fp]], default=None)) for (i, _), fp in zip(rows, prints, strict=True)]


def found_groups(df):
    return [(r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in simhash.groups(df).collect()]


def test_simhash_groups_of_awkward_texts(spark):
    assert sorted(map(repr, found_groups(awkward(spark)))) == sorted(map(repr, groups([r[:2] for r in AWKWARD])))


def test_simhash_groups_of_given_documents(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(found_groups(docs)) == sorted(groups(rows))


@pytest.mark.parametrize("pages", [1, 13, 64])
def test_links_connect_what_two_bits_connect(spark, monkeypatch, pages):
    monkeypatch.setattr(simhash, "LEAST_PAGES", pages)
    monkeypatch.setattr(simhash, "PROBE_ROWS", 40)
    draw = random.Random(pages)
    prints = {0, (1 << 64) - 1, 1 << 63} | {draw.getrandbits(64) for _ in range(150)}
    for base in draw.sample(sorted(prints), 60):
        for _ in range(draw.randint(1, 4)):
            prints.add(base := base ^ sum(1 << b for b in draw.sample(range(64), draw.randint(1, 3))))
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    fps = spark.createDataFrame([(s,) for s in signed.values()], "fp long")
    got = defaultdict(set)
    for r in links_module.components(simhash.links(fps)).collect():
        got[r.root].add(r.node)
    want = {c for c in smallest_reachable(sorted(prints), lambda a, b: (a ^ b).bit_count() <= 2).values() if len(c) > 1}
    assert {frozenset(c) for c in got.values()} == {frozenset(signed[p] for p in c) for c in want}


def test_tree_finds_all_within_reach():
    draw = np.random.default_rng(2)
    base = draw.integers(0, 1 << 63, 40, dtype=np.uint64)
    items = np.unique(np.concatenate([base ^ np.uint64(1 << int(draw.integers(64))) ^ np.uint64(k) for k in range(20)]))
    items = items[np.argsort(graytree.gray_rank(items))]
    pairs = {(int(q), int(i)) for qs, its in graytree.GrayTree(items).within(items, 2) for q, i in zip(qs, its, strict=True)}
    apart = np.bitwise_count(items[:, None] ^ items[None, :])
    assert pairs == set(map(tuple, np.argwhere(apart <= 2).tolist()))


def test_gray_rank_inverts_the_gray_code():
    n = np.arange(5000, dtype=np.uint64)
    assert (graytree.gray_rank(n ^ (n >> np.uint64(1))) == n).all()


def test_components_of_long_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(300, 340)] + [(9, 9), (8, 7), (7, 8)]
    random.Random(1).shuffle(chain)
    found = {r.node: r.root for r in links_module.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    want = dict.fromkeys(range(100, 161), 100) | dict.fromkeys([1, *range(300, 340)], 1) | {7: 7, 8: 7}
    assert found == want
    assert links_module.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_one_of_each_group_stays_with_all_columns(spark):
    df = awkward(spark)
    out = simhash.one_of_each(df)
    assert out.columns == df.columns
    by_group = {}
    for i, fp, least in groups([r[:2] for r in AWKWARD]):
        by_group.setdefault(fp, least)
    got = Counter(f"{fingerprint(r.text):016x}" for r in out.collect())
    together = smallest_reachable(sorted({int(fp, 16) for fp in by_group}), lambda a, b: (a ^ b).bit_count() <= 2)
    assert sum(got.values()) == len(set(together.values()))
    assert all(sum(got[f"{fp:016x}"] for fp in c) == 1 for c in set(together.values()))
    assert {r.doc_id for r in out.collect() if r.text and r.text.startswith("one two")} == {1}


# Lines


def cleaned(rows, sites, least, long=50):
    """By the definition: (doc_id, text) -> text without later copies of wide lines."""
    sites = max(2, -(-len({s for *_, s in rows} - {None}) // 5)) if sites is None else sites
    spread, first = defaultdict(set), {}
    for i, text, source in rows:
        for place, line in enumerate((text or "").split("\n")):
            key = line.strip(" \t\n\x0b\x0c\r")
            if len(words(line)) >= least:
                spread[key] |= {source} - {None}
                order = (i is None, i or 0, place)
                first[key] = min(first.get(key, order), order)
    out = []
    for i, text, _ in rows:
        lines = (text or "").split("\n")
        keys = [line.strip(" \t\n\x0b\x0c\r") for line in lines]
        stays = [
            len(words(line)) < least or len(spread[k]) < (2 if len(words(line)) > long else sites) or first[k] == (i is None, i or 0, place)
            for place, (line, k) in enumerate(zip(lines, keys, strict=True))
        ]
        kept = "\n".join(line for line, s in zip(lines, stays, strict=True) if s)
        out.append((i, None if text is None else kept, 0 if text is None else len(lines), stays.count(False)))
    return out


def test_lines_by_definition(spark):
    rows = [(r[0], r[1], r[3]) for r in AWKWARD if r[:2] != (1, "another text under the same id")]
    df = documents(spark, rows)
    got = linededup.cleaned(df, sites=2, words=3).select("row.doc_id", "text", "lines", "removed").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, cleaned(rows, 2, 3)))


def test_line_on_many_sites_is_counted_by_sketch_and_near_the_threshold_exactly(spark):
    rows = [(i, f"this line is on {n} sites\nown words {i} of {n}", f"site{i}") for n in (1, 30, 39, 40, 41, 50, 200) for i in range(n)]
    rows = [(k, text, source) for k, (_, text, source) in enumerate(rows)]
    got = linededup.cleaned(documents(spark, rows), sites=40, words=3).collect()
    assert sorted(map(repr, ((r.row.doc_id, r.text, r.lines, r.removed) for r in got))) == sorted(map(repr, cleaned(rows, 40, 3)))


def test_short_lines_on_many_sites_go(spark):
    text = "All rights reserved.\n\nHome\nfar and wide {0}\nfew"
    rows = [(i, text.format(i) if i < 7 else text.format(i)[:-4], f"site{i}") for i in range(8)]
    df = documents(spark, rows)
    got = linededup.cleaned(df, sites=8).select("row.doc_id", "text", "lines", "removed")
    assert {r.doc_id: (r.text, r.removed) for r in got.collect()} == {
        i: (text, 0) if not i else ("\nfar and wide {0}\nfew".format(i)[: None if i < 7 else -4], 2)
        for i, text, _ in rows
    }


def test_threshold_follows_the_number_of_sites(spark):
    # 200 documents of 5 sites that share a line: two sites are enough. Of 30 sites, six are; a long line goes at two.
    rows = [(i, f"the same line in all of them\nown words of {i}", f"site{i % 5}") for i in range(200)]
    got = linededup.cleaned(documents(spark, rows))
    assert got.filter("removed = 1").count() == 199
    long = " ".join(f"w{i}" for i in range(51))
    shared = {"on five": range(5), "on six": range(6), long: (3, 4), long[:-4]: (7, 8)}
    rows = [(i, "\n".join([f"own {i}", *(line for line, on in shared.items() if i in on)]), f"s{i}") for i in range(30)]
    df = documents(spark, [*rows, (99, "on five\nown", None)])
    assert linededup.threshold(df) == 6 and linededup.threshold(df.filter("doc_id < 2")) == 2 and linededup.threshold(df.limit(0)) == 2
    got = linededup.cleaned(df).select("row.doc_id", "text", "lines", "removed")
    assert as_rows(got.columns, got.collect()) == by_sql("op8_lines", documents=df)
    assert {r.doc_id: r.removed for r in got.collect() if r.removed} == {**dict.fromkeys(range(1, 6), 1), 4: 2}


def test_lines_of_awkward_rows_keep_every_row(spark):
    df = awkward(spark)
    out = linededup.cleaned(df, sites=2, words=3)
    assert out.select("row.*").columns == df.columns and out.count() == len(AWKWARD)


# Mixing


def test_mixing_of_awkward_rows(spark):
    got = mixing.taken(awkward(spark)).collect()
    sizes = defaultdict(int)
    for _, text, _, source in AWKWARD:
        sizes[source] += len(words(text))
    assert sorted(map(repr, ((r.doc_id, r["size"], r.source_size) for r in got))) == sorted(
        repr((i, len(words(text)), sizes[source])) for i, text, _, source in AWKWARD
    )
    assert all(0 <= r.taken <= 3 * r["size"] for r in got)


def filled(sizes, weights):
    """Targets by repeated resharing, in fractions."""
    left, target = set(sizes), {}
    rest = Fraction(sum(sizes.values()))
    while left:
        share = {s: rest * weights[s] / sum(weights[t] for t in left) for s in left}
        over = {s for s in left if share[s] >= 3 * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = Fraction(3 * sizes[s])
            rest -= target[s]
        left -= over
    return target


@pytest.mark.parametrize("sizes", [[10], [5, 0, 7], [1, 1000, 1000], [1000, 1, 1, 1, 50, 3, 900], [0, 0], [3, 3, 3, 3]])
def test_targets_by_resharing(spark, sizes):
    names = [f"s{i:02d}" for i in range(len(sizes) - 1)] + [None]
    got = mixing.targets(spark.createDataFrame(list(zip(names, sizes, strict=True)), "source string, source_size long")).collect()
    want = filled(dict(enumerate(sizes)), {i: i % 3 + 1 for i in range(len(sizes))})
    assert {r.source: r.target for r in got} == {n: pytest.approx(float(want[i])) for i, n in enumerate(names)}


def test_taken_words_come_near_the_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mixing.taken(docs).collect()
    assert sorted(got) == sorted(mixing.taken(docs.repartition(5)).collect())
    by_target = defaultdict(list)
    for r in got:
        by_target[(r.target, r.source_size)].append(r)
    for (target, _), rows in by_target.items():
        assert abs(sum(r.taken for r in rows) - target) <= len(by_target)
        assert all(r.taken <= 3 * r["size"] for r in rows)
    whole = defaultdict(list)
    for r in mixing.taken(docs, cut=False).collect():
        assert r.taken % max(1, r["size"]) == 0
        whole[(r.target, r.source_size)].append(r)
    for (target, _), rows in whole.items():
        assert abs(sum(r.taken for r in rows) - target) <= max(r["size"] for r in rows) + 0.05 * target


def test_mixed_documents_are_whole_and_in_the_counted_numbers(spark):
    df = awkward(spark)
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    counted = Counter()
    for r in mixing.taken(df, cut=False).collect():
        counted[r.doc_id] += r.taken
    got = Counter()
    for r in out.collect():
        got[r.doc_id] += len(words(r.text))
    assert +got == +counted


def hot_documents(spark):
    """Half the rows under one id, a third of the rest alike, in two sources."""
    draw = random.Random(3)
    text = lambda: " ".join(f"w{draw.randrange(50)}" for _ in range(draw.randrange(1, 9)))
    rows = [(7, text(), "a") for _ in range(600)] + [(8, "rows alike", "b")] * 200
    rows += [(i, text(), "ab"[i % 2]) for i in range(100, 500)] + [(None, "no id", None)] * 5
    return documents(spark, rows)


def test_mixing_of_hot_ids_and_rows_alike_equals_sql(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 16)
    docs = hot_documents(spark)
    got = mixing.taken(docs)
    assert as_rows(got.columns, got.collect()) == by_sql("op7_mixing", documents=docs)
    units, _ = mixing.queue(docs, mixing.WEIGHTS, mixing.REPEATS)
    assert units.agg({"n": "sum"}).first()[0] == docs.count() and units.filter("n = 200").count() == 1
    rows = mixing.spelled(units)
    assert rows.count() == docs.count() and rows.select("source_rank", "h", "nth").distinct().count() == docs.count()


def test_ranges_of_a_queue_hold_few_rows_of_a_hot_id(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(mixing, "RANGE_ROWS", 16)
    monkeypatch.setattr(mixing, "running", lambda df, *rest: seen.append(df) or prefix.running(df, *rest))
    mixing.mix(hot_documents(spark))
    assert len(seen) == 2
    for df in seen:
        groups = [c for c in ("source_rank",) if df is seen[0]]
        assert df.groupBy(*groups, "range").count().agg({"count": "max"}).first()[0] <= 4 * 16


def test_mixed_documents_of_hot_rows_stand_in_the_order_of_the_mix(spark):
    docs = hot_documents(spark)
    out = [(r.doc_id, r.text, r.source) for r in mixing.mixed_documents(docs).collect()]
    assert out == [(r.doc_id, r.text, r.source) for r in mixing.mixed_documents(docs.repartition(7)).collect()]
    _, mixed, _ = mixing.mix(docs)
    placed = mixed.orderBy("offset").select("doc_id", "source", "size", "words").collect()
    assert [(i, source, len(words(text))) for i, text, source in out] == [(r.doc_id, r.source, r.words) for r in placed]


def test_running_sums_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(prefix, "FAN", 3)
    rows = [(g, i // 4, i, i % 7) for g in "ab" for i in range(100)]
    df = spark.createDataFrame(rows, "g string, range long, i long, x long")
    for group in (["g"], []):
        got = prefix.running(df, group, [prefix.F.col("i"), prefix.F.col("g")], "x", "s").collect()
        for r in got:
            earlier = [x for g, _, i, x in rows if (g == r.g or not group) and (i, g) < (r.i, r.g)]
            assert r.s == sum(earlier)


# Packing


def packed(docs, **more):
    return packing.digest(packing.pack(docs, **more)).collect()


def holds(pieces, rows, window):
    """Every rule of the contract; returns tokens by window and source."""
    tokenizer = Tokenizer.from_file(packing.public_tokenizer())
    want = Counter()
    ids = {}
    for i, text, _ in rows:
        own = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        ids.setdefault(i, []).append(own)
        want[(i, len(own))] += 1
    by_window, got = defaultdict(list), defaultdict(int)
    for p in pieces:
        by_window[p.sequence_id].append(p)
        got[(p.doc_id, p.doc_tokens)] += p.length
        crcs = {zlib.crc32(np.array(own[p.start : p.start + p.length], dtype="<u4").tobytes()) for own in ids[p.doc_id]}
        assert p.length > 0 and p.ids_crc32 in crcs
    assert got == {k: n * k[1] for k, n in want.items()}
    assert sorted(by_window) == list(range(len(by_window)))
    for k, own in by_window.items():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == [sum(q.length for q in own[:j]) for j in range(len(own))]
        assert sum(p.length for p in own) == window or k == len(by_window) - 1


@pytest.mark.parametrize("window,least", [(4096, 64), (64, 4), (50, 50)])
def test_packing_round_trip(spark, window, least):
    rows = [(r[0], r[1], r[3]) for r in AWKWARD]
    holds(packed(awkward(spark), window=window, least=least), rows, window)


def test_packing_of_given_documents(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").repartition(3)
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    pieces = packed(docs)
    holds(pieces, rows, 4096)
    source = {i: s for i, _, s in rows}
    total, by = Counter(), defaultdict(Counter)
    for p in pieces:
        total[source[p.doc_id]] += p.length
        by[p.sequence_id][source[p.doc_id]] += p.length
    everything = sum(total.values())
    for k, own in by.items():
        due = 4096 if k < len(by) - 1 else everything - 4096 * k
        for s, n in total.items():
            assert abs(own[s] - due * n / everything) <= 2


def test_texts_have_the_ids_of_the_tokenizer(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    chunks = sorted({c for t in [*texts, *(r[1] or "" for r in AWKWARD)] for c in words(t)})
    chunks += ["it's", "I'LL", "a1b22,,x", "<|endoftext|>x", "<|startoftext|>", "ª", "µº", "İI", "ÀÉß", "e\u0301", "x\u00a0y", "ΑΣ", "~~~", "'", "1'2"]
    tokenizer = Tokenizer.from_file(packing.public_tokenizer())
    texts += [*chunks, " ".join(chunks), "\n".join(chunks[-20:])]
    got, width = packing.text_ids(texts, packing.public_tokenizer())
    assert width == 2
    for text, ids in zip(texts, got, strict=True):
        assert np.frombuffer(ids, "<u2").tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2]


def test_other_tokenizers_encode_whole_texts():
    path = packing.public_tokenizer("byte_bpe_50k.json")
    want = [*Tokenizer.from_file(path).encode("Two  words\n", add_special_tokens=False).ids, 2]
    assert packing.text_ids(["Two  words\n"], path) == ([np.array(want, dtype="<u2").tobytes()], 2)


def test_rounds_give_each_queue_its_share():
    draw = random.Random(3)
    for _ in range(50):
        sizes = [draw.choice([1, 3, 50, 4000, 90_000]) for _ in range(draw.randint(1, 8))]
        # Sources of under a token a window share the last queue.
        large = [n for n in sizes if n * 64 >= sum(sizes)]
        tokens = large + [sum(sizes) - sum(large)] * (sum(large) < sum(sizes))
        rounds, before = packing.Rounds(tokens, 64), [0] * len(tokens)
        windows = -(-sum(tokens) // 64)
        for k in range(1, windows + 1):
            had = rounds.had(k)
            assert sum(had) == min(64 * k, sum(tokens))
            assert all(0 <= h - b for h, b in zip(had, before, strict=True))
            assert all(abs(h - min(64 * k, sum(tokens)) * t / sum(tokens)) < 1 for h, t in zip(had, tokens, strict=True))
            before = had
        assert before == tokens


def test_every_source_of_many_has_its_share_of_every_window(spark):
    equal, small = 300, 40
    rows = [(i, " ".join(["word"] * 120), f"site{i % equal}") for i in range(3 * equal)]
    rows += [(len(rows) + i, "one word", f"small{i}") for i in range(small)] + [(5000 + i, "hot " * 3000, "hot") for i in range(30)]
    pieces = packed(documents(spark, rows), window=4096, least=64)
    holds(pieces, rows, 4096)
    source = {i: s for i, _, s in rows}
    total, had = Counter(), Counter()
    for p in pieces:
        total[source[p.doc_id]] += p.length
    everything = sum(total.values())
    for k in range(max(p.sequence_id for p in pieces) + 1):
        for p in pieces:
            if p.sequence_id == k:
                had[source[p.doc_id]] += p.length
        due = min(4096 * (k + 1), everything)
        # Inside the shared queue a source is ahead or behind by its share of a longer window at most.
        assert all(abs(had[s] - due * n / everything) <= 2 * 64 + 2 for s, n in total.items())
        assert k == 0 or sum(had[f"site{i}"] > 0 for i in range(equal)) >= min(equal, 4096 * (k + 1) // 1000)


def test_nested_queues_deal_out_every_token_once():
    draw = random.Random(8)
    for _ in range(20):
        sizes = [draw.choice([1, 2, 30, 500, 4000]) for _ in range(draw.randint(1, 120))]
        places, levels = packing.nested(sizes, 512, 8)
        rounds, got = [packing.Rounds(*level) for level in levels], []
        for (level, queue), n in zip(places, sizes, strict=True):
            own = list(packing.through(rounds, level, queue, 0, n))
            assert [first for first, *_ in own] == [sum(size for _, size, *_ in own[:j]) for j in range(len(own))]
            assert sum(size for _, size, *_ in own) == n
            got += [512 * k + offset + j for _, size, k, offset in own for j in range(size)]
        assert sorted(got) == list(range(sum(sizes)))


def test_sequences_hold_their_pieces(spark, data):
    pieces = packing.pack(spark.read.parquet(f"{data}/documents.parquet")).cache()
    whole = packing.sequences(pieces).collect()
    lengths = defaultdict(int)
    for p in pieces.collect():
        lengths[p.sequence_id] += len(p.ids) // 4
    assert {r.sequence_id: r.n for r in whole} == lengths
    pieces.unpersist()


# Sharding


def test_table_is_filled_in_turns():
    shards, slots = ["a", "b", "c", "d"], 101
    table, order = [None] * slots, {s: [] for s in shards}
    for s in shards:
        offset, skip = sharding.preference(s, slots)
        order[s] = [(offset + j * skip) % slots for j in range(slots)]
    while None in table:
        for i, s in enumerate(shards):
            free = [x for x in order[s] if table[x] is None]
            if free:
                table[free[0]] = i
    assert sharding.filled_table(shards, slots) == table


def test_shares_are_even_and_a_lost_shard_moves_little():
    names = sharding.shard_names(20)
    table = sharding.filled_table(names, 2039)
    share = Counter(table)
    assert max(share.values()) - min(share.values()) <= 1
    fewer = sharding.filled_table(names[:-1], 2039)
    moved = sum(a != b for a, b in zip(table, fewer, strict=True) if a != 19)
    assert moved < 0.1 * 2039


def test_tables_need_a_prime():
    for bad in (1, 100, 2047):
        with pytest.raises(ValueError):
            sharding.filled_table(["a", "b"], bad)


def test_awkward_rows_are_all_placed(spark, tmp_path):
    df = awkward(spark)
    got = sharding.place(df).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r.shard < sharding.SHARDS for r in got)
    assert len({(r.doc_id, r.slot) for r in got if r.doc_id == 1}) == 1
    sharding.write_shards(df, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == len(AWKWARD)


def test_files_of_a_shard_follow_the_bytes(spark, tmp_path, monkeypatch):
    docs = spark.range(400).selectExpr("id as doc_id", "repeat('x', 100) as text", "'a' as __piece", "1 as slot", "2 as piece")
    for size, files in ((1 << 20, 1), (5000, 4)):
        monkeypatch.setattr(sharding, "PIECE_BYTES", size)
        path = tmp_path / f"by{size}"
        sharding.write_shards(docs, str(path), ["left", "right"], 101)
        written = [len(list(folder.glob("*.parquet"))) for folder in path.glob("__shard=*")]
        # Pieces may meet in one task.
        assert len(written) == 2 and all(min(files, 2) <= n <= files for n in written)
        assert spark.read.parquet(str(path)).select(docs.columns).exceptAll(docs).isEmpty()
        assert spark.read.parquet(str(path)).count() == 400
    sharding.write_shards(docs.filter("false"), str(tmp_path / "none"))
    assert not list((tmp_path / "none").glob("__shard=*"))


def test_placement_stays_in_the_jvm(spark, data):
    plan = llm_queries()["op10_sharding"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_empty_tables(spark):
    none = awkward(spark).filter("false")
    for rows in (
        simhash.groups(none), simhash.one_of_each(none), linededup.cleaned(none), mixing.taken(none),
        mixing.mixed_documents(none), packing.pack(none), sharding.place(none),
    ):
        assert rows.collect() == []
