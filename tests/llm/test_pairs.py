"""N-gram join, substring dedup, decontamination and neighbours against brute force."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandloom.llm import ngram_join as N
from demandloom.llm import passages as P
from demandloom.llm import tiling as G
from demandloom.llm.components import components
from demandloom.llm.neighbours import nearest
from demandloom.llm.storage import CLEANUP, written


def prose(rng: random.Random, count: int) -> list[str]:
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 7))) for _ in range(count)]


@pytest.fixture(scope="module")
def texts() -> dict[int, str | None]:
    """Copies, near copies of one base, a frequent line, short and long texts, blanks and nulls."""
    rng = random.Random(5)
    line = " ".join(prose(rng, 9))
    out: dict[int, str | None] = {1: None, 2: "", 3: " \n\t", 4: "One", 5: "one", 6: "one two"}
    base = prose(rng, 120)
    for k in range(10, 40):
        words = list(base)
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
            words[rng.randrange(len(words))] = prose(rng, 1)[0]
        out[k] = " ".join(words)
    for k in range(40, 60):
        words = prose(rng, rng.randint(1, 30))
        out[k] = " ".join(words) + "\n" + line + "\n" + " ".join(prose(rng, rng.randint(0, 20)))
    out[60], out[61] = out[41].upper(), out[42]
    passage = prose(rng, 70)
    for k in range(70, 76):
        out[k] = " ".join(prose(rng, 40) + passage + prose(rng, 40))
    changed = list(passage)
    changed[35] = "different"
    out[76] = " ".join(prose(rng, 20) + changed)
    out[80] = " ".join(prose(rng, 6000))
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "x", 1) for i, t in texts.items()]
    return spark.createDataFrame(rows + [rows[8], (None, texts[10], "x", 1)], "doc_id long, text string, node string, h int")


def shingles(text: str | None, size: int) -> frozenset:
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    size = min(size, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def expected_components(texts, size, percent):
    sets = {i: shingles(t, size) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80), (1, 50)])
def test_ngram_join_equals_brute_force(docs, texts, size, percent):
    rows = N.ngram_join(docs, size, percent).collect()
    expected = expected_components(texts, size, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows if r.doc_id is not None} == expected
    assert len(rows) == len(texts) + 2  # the repeated row and the one without id
    assert [r.component_id for r in rows if r.doc_id is None] == [expected[10][1]]


def test_one_per_group_keeps_columns_and_first_rows(docs, texts):
    kept = N.one_per_group(docs, 5, 80)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.where("doc_id is not null").collect())
    assert ids == sorted(i for i, (_, c) in expected_components(texts, 5, 80).items() if i == c)
    assert kept.where("doc_id is null").count() == 1


def test_leading_tiers_hold_a_prefix():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 40, 300):
        found = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        part, need = N.leading_tiers(found, 90)
        assert len(part) >= min(len(found), N.prefix_length(len(found), 90)) and len(part) == len(need)


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(300)] + [(1000, 1000 + k) for k in range(1, 200)] + [(5, 5), (7, None)]
    rows = components(spark.createDataFrame(path, "a long, b long"), "a", "b").collect()
    assert {r.node: r.root for r in rows} == {i: 0 for i in range(1, 301)} | {1000 + k: 1000 for k in range(1, 200)}


def repeated_places(texts, length):
    first: dict[tuple, int] = {}
    words = {i: (t or "").encode().lower().split() for i, t in sorted(texts.items())}
    for i, w in words.items():
        for j in range(len(w) - length + 1):
            first.setdefault(tuple(w[j : j + length]), i)
    places = defaultdict(set)
    for i, w in words.items():
        for j in range(len(w) - length + 1):
            if first[tuple(w[j : j + length])] < i:
                places[i].update(range(j, j + length))
    return words, places


def test_repeated_passages_hold_every_repeat(docs, texts):
    rows = P.repeated_passages(docs).collect()
    words, expected = repeated_places(texts, 50)
    found = defaultdict(set)
    for r in rows:
        found[r.doc_id].update(range(r.start_word, r.end_word))
        assert r.first_doc_id < r.doc_id and r.similarity >= 0.8 and r.end_word - r.start_word >= 50
        one = words[r.doc_id][r.start_word : r.end_word]
        two = words[r.first_doc_id][r.first_start : r.first_start + len(one)]
        assert len(set(one) & set(two)) > 0.7 * len(set(one))
    assert all(places <= found[i] for i, places in expected.items())
    assert 76 in found  # a word was changed in the middle
    assert not set(found) & {1, 2, 3, 4, 5, 6, 70, 80}


def test_passages_behind_partial_holders_and_along_chains(spark):
    """The first holder of a bucket has too little of the passage, or is too unlike the document, and hides another."""
    rng = random.Random(21)
    out, partial, chains = [], [], []
    for k in range(12):
        passage, base = prose(rng, 70), 100 * k
        for part in range(4):  # 40 words each at most, between other words
            out.append((base + part, " ".join(prose(rng, 30) + passage[10 * part : 10 * part + 40] + prose(rng, 30))))
        out += [(base + i, " ".join(prose(rng, 30) + passage + prose(rng, 30))) for i in (10, 11)]
        partial.append(base + 11)
        one = prose(rng, 200)
        two, three = list(one), list(one)
        for place in range(20, 200, 50):  # 20 of 196 shingles a step; four and eight changes
            two[place] = three[place] = "changed"
            three[place + 25 if place < 170 else 195] = "again"
        out += [(base + 20 + i, " ".join(words)) for i, words in enumerate((one, two, three))]
        chains.append(base + 22)
    rows = P.repeated_passages(spark.createDataFrame(out, "doc_id long, text string")).collect()
    assert {r.doc_id for r in rows if r.doc_id in partial and r.first_doc_id % 100 == 10} == set(partial)
    assert {r.doc_id for r in rows} >= set(chains)


def test_passages_with_words_put_in_or_left_out(spark):
    """Neither part has 46 shingles of its own; the Jaccard similarity of the whole is 0.86 or more."""
    rng = random.Random(8)
    out, edits = [], {"in": lambda w: w[:40] + ["new"] + w[40:], "out": lambda w: w[:40] + w[41:], "two": lambda w: w[:40] + ["new", "er"] + w[40:]}
    for k in range(30):
        passage, edit = prose(rng, 80), list(edits.values())[k % 3]
        out += [(10 * k, " ".join(prose(rng, 30) + passage + prose(rng, 30))), (10 * k + 1, " ".join(prose(rng, 45) + edit(passage) + prose(rng, 9)))]
    texts = {i: t.encode().split() for i, t in out}
    rows = P.repeated_passages(spark.createDataFrame(out, "doc_id long, text string")).collect()
    found = {r.doc_id: r for r in rows}
    assert set(found) == {10 * k + 1 for k in range(30)} and len(rows) == 30
    for i, r in found.items():
        one = shingles(b" ".join(texts[i][r.start_word : r.end_word]).decode(), 5)
        whole = shingles(b" ".join(texts[r.first_doc_id]).decode(), 5)
        assert 79 <= r.end_word - r.start_word <= 82 and r.first_start == 30
        assert r.similarity == pytest.approx(len(one & whole) / (len(one) + 76 - len(one & whole)))


def test_window_centres_are_the_wide_nodes_of_the_cartesian_tree():
    def nodes(order, least):
        out, stack = [], [(0, len(order))]
        while stack:
            start, end = stack.pop()
            if end - start >= least:
                centre = start + int(order[start:end].argmin())
                out.append(centre)
                stack += [(start, centre), (centre + 1, end)]
        return sorted(out)

    rng = np.random.default_rng(9)
    for length in (46, 47, 100, 700):
        tokens = rng.integers(0, 60 if length == 100 else 2**40, (3, length)).astype(np.uint64) << np.uint64(24)
        tokens &= ~np.uint64((1 << P.PLACE_BITS) - 1)
        for least in (1, 5, 46):
            assert [c.tolist() for c in P.window_centres(tokens, least)] == [nodes(row, least) for row in tokens]


def test_similarity_is_that_of_the_shingle_sets():
    rng = np.random.default_rng(6)
    for _ in range(200):
        one = rng.integers(1, 40, 120)
        two = one.copy()
        two[rng.integers(0, 120, rng.integers(0, 5))] = 99
        two = np.insert(two, rng.integers(0, 120, rng.integers(0, 4)), 77)
        for start, end, other, last, shared, union in P.alike(one, two, 5, 46):
            here, there = ({tuple(w[k : k + 5]) for k in range(x, y)} for w, x, y in ((one.tolist(), start, end), (two.tolist(), other, last)))
            assert (shared, union) == (len(here & there), len(here | there)) and shared >= 0.8 * union and end - start >= 46


def covered(rows, doc):
    out = set()
    for r in rows:
        if r.doc_id == doc:
            out |= set(range(r.start_word, r.end_word))
    return out


def test_what_two_documents_share_beyond_the_first_holder_is_found(spark):
    """A holds 60 words, B and C hold them and 1 to 45 more on one side: C is covered as a whole."""
    rng, out, wanted = random.Random(31), [], {}
    for k, more in enumerate((1, 2, 3, 4, 6, 10, 17, 25, 33, 45) * 2):
        passage, beyond = prose(rng, 60), prose(rng, more)
        longer = beyond + passage if k % 2 else passage + beyond
        for j, part in enumerate((passage, longer, longer)):
            before = prose(rng, 30 + k)
            out.append((10 * k + j, " ".join(before + part + prose(rng, 30))))
        wanted[10 * k + 2] = set(range(len(before), len(before) + len(longer)))
    rows = P.repeated_passages(spark.createDataFrame(out, "doc_id long, text string")).collect()
    assert all(covered(rows, doc) >= words for doc, words in wanted.items())


def test_passages_behind_a_row_of_partial_holders(spark):
    """Each earlier document holds some words more than the one before it, none has 50 of them."""
    rng, out, wanted = random.Random(41), [], set()
    for k in range(40):
        passage, side = prose(rng, 50), k % 2
        for j in range(11):
            part = passage[: 29 + 2 * j] if side else passage[21 - 2 * j :]
            out.append((20 * k + j, " ".join(prose(rng, 30) + part + prose(rng, 30))))
        out += [(20 * k + i, " ".join(prose(rng, 30) + passage + prose(rng, 30))) for i in (15, 16)]
        wanted.add((20 * k + 16, 20 * k + 15, 30, 80))
    rows = P.repeated_passages(spark.createDataFrame(out, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.first_doc_id, r.start_word, r.end_word) for r in rows} == wanted


def test_all_words_of_long_rows_of_one_word_are_found(spark):
    """A word repeated on and on is met on every shift; each stretch of it that an earlier document holds is repeated."""
    rng, texts = random.Random(51), {}
    for k in range(20):
        word, pair = prose(rng, 1), prose(rng, 2)
        for j, (many, more) in enumerate(((60, 30), (100, 26), (400, 130), (401, 131))):
            texts[10 * k + j] = " ".join(prose(rng, 20) + word * many + prose(rng, 35 + j) + pair * more + prose(rng, 20))
    rows = P.repeated_passages(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    words, expected = repeated_places(texts, 50)
    assert len(expected) == 60 and all(places <= covered(rows, doc) for doc, places in expected.items())
    for r in rows:
        one, two = words[r.doc_id][r.start_word : r.end_word], words[r.first_doc_id][r.first_start :]
        assert r.similarity < 1 or one == two[: len(one)]


def test_partial_holders_make_no_rounds(spark, monkeypatch):
    """Documents are compared once, however many of them share a little more than the one before."""
    rng, out, calls, wanted = random.Random(52), [], [], set()
    real = P._compared
    monkeypatch.setattr(P, "_compared", lambda *given: calls.append(1) or real(*given))
    for k in range(10):
        passage = prose(rng, 60)
        for j in range(20):
            out.append((40 * k + j, " ".join(prose(rng, 30) + passage[: 30 + j] + prose(rng, 30))))
        out += [(40 * k + i, " ".join(prose(rng, 30) + passage + prose(rng, 30))) for i in (25, 26)]
        wanted.add((40 * k + 26, 40 * k + 25, 30, 90))
    rows = P.repeated_passages(spark.createDataFrame(out, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.first_doc_id, r.start_word, r.end_word) for r in rows} == wanted and len(calls) == 1


def test_a_run_left_out_joins_its_other_neighbour(spark):
    """Joined from the left, the third run would make the whole too unlike; with the second alone it is similar enough."""
    rng = np.random.default_rng(53)
    one = rng.integers(1000, 2**30, 160)
    two = one.copy()
    for place in (22, 55, 60, 65, 70, 75, 106, 135):
        two[place] = place
    found = set()
    for begin, end, other, _, shared, union in P.alike(one, two, 5, 46):
        found |= set(range(begin, end + 4))
        assert begin == other and 5 * shared >= 4 * union
    assert found >= set(range(76, 160))


def test_a_frequent_short_line_makes_no_pairs(spark, monkeypatch):
    """45 words that many documents hold are no passage; what is compared grows with the documents, not with their square."""
    rng, counts = random.Random(32), {}
    line = prose(rng, 45)
    docs = [(k, " ".join(prose(rng, 40) + line + prose(rng, 40))) for k in range(160)]
    real = P._compared

    def counted(texts, matches, *rest):
        counts.setdefault(size, []).append(matches.count())
        return real(texts, matches, *rest)

    monkeypatch.setattr(P, "_compared", counted)
    for size in (40, 80, 160):
        assert P.repeated_passages(spark.createDataFrame(docs[:size], "doc_id long, text string")).count() == 0
    assert sum(counts[160]) < 5 * sum(counts[40]) and sum(counts[160]) < 160 * 60


def test_one_per_group_keeps_the_texts_of_a_repeated_id(spark):
    rng = random.Random(34)
    a, b = " ".join(prose(rng, 40)), " ".join(prose(rng, 40))
    rows = [(1, a, 3), (2, a, 3), (2, b, 5), (2, b, 4), (3, None, 1), (None, a, 1)]
    kept = N.one_per_group(spark.createDataFrame(rows, "doc_id long, text string, node long"))
    found = sorted((r.doc_id or 0, r.text or "", r.node) for r in kept.collect())
    assert (2, b, 4) in found and (3, "", 1) in found and (0, a, 1) in found
    assert len(found) == 4 and len([r for r in found if r[0] and r[1] == a]) == 1


def test_texts_of_a_repeated_id_are_cut_on_their_own(spark):
    rng = random.Random(33)
    passage, other = prose(rng, 70), [prose(rng, 60) for _ in range(4)]
    rows = [(1, " ".join(passage)), (2, " ".join(other[0])), (2, " ".join(other[1] + passage)), (2, " ".join(other[2])), (3, " ".join(other[3]))]
    df = spark.createDataFrame([(*r, 5, "clash") for r in rows], "doc_id long, text string, n_chars long, place string")
    found = P.repeated_passages(df).collect()
    assert [(r.doc_id, r.first_doc_id, r.start_word, r.end_word) for r in found] in ([(2, 1, 60, 130)], [(1, 2, 0, 70)])
    kept = sorted((r.doc_id, r.text) for r in P.without_repeats(df).collect())
    whole = sorted([(1, " ".join(passage)), *[(2, " ".join(o)) for o in other[:3]], (3, " ".join(other[3]))])
    cut_other = sorted([(2, " ".join(other[0])), (2, " ".join(other[1] + passage)), (2, " ".join(other[2])), (3, " ".join(other[3]))])
    assert [(i, t.strip()) for i, t in kept] in (whole, cut_other)


def test_shortest_near_passages_are_found(spark):
    """50 words, the middle one replaced: 41 of 51 shingles are shared, just above 0.8."""
    rng, out = random.Random(50), []
    for k in range(200):
        passage = prose(rng, 50)
        other = passage[:25] + ["replaced"] + passage[26:]
        out += [(2 * k, " ".join(prose(rng, 60) + passage + prose(rng, 60))), (2 * k + 1, " ".join(prose(rng, 80) + other + prose(rng, 40)))]
    rows = P.repeated_passages(spark.createDataFrame(out, "doc_id long, text string")).collect()
    assert len({r.doc_id for r in rows}) >= 190 and all(r.first_doc_id == r.doc_id - 1 for r in rows)


def test_without_repeats_leaves_first_copy(docs, texts):
    kept = P.without_repeats(docs.withColumn("n_chars", F.length("text")))
    assert kept.columns == [*docs.columns, "n_chars"]
    rows = {r.doc_id: r for r in kept.where("doc_id is not null").collect()}
    assert rows[70].text == texts[70] and rows[1].text is None
    assert len(rows[71].text.split()) == 80 and rows[71].n_chars == len(rows[71].text)


def test_remove_words_keeps_the_rest_as_it_is():
    assert P.remove_words("a  b\nc d\n", [(1, 3)]) == "a  d\n"
    assert P.remove_words("é b c", [(0, 1), (0, 2)]) == "c"
    assert P.remove_words("a b", [(0, 2)]) == ""


def naive_tiles(item, text, least):
    marked, other, total = [False] * len(item), [False] * len(text), 0
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                k = 0
                while i + k < len(item) and j + k < len(text) and item[i + k] == text[j + k] and not marked[i + k] and not other[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        length, i, j = best
        if length < least:
            return total
        for k in range(length):
            marked[i + k] = other[j + k] = True
        total += length


def test_greedy_tiles_equal_the_naive_search():
    rng = np.random.default_rng(3)
    for _ in range(60):
        item = rng.integers(0, 4, rng.integers(1, 30)).astype(np.uint64)
        text = rng.integers(0, 4, rng.integers(1, 60)).astype(np.uint64)
        tiles = G.greedy_tiles(item, text, np.arange(len(text)), 3)
        lengths = [t[2] for t in tiles]
        assert lengths == sorted(lengths, reverse=True)
        assert all(np.array_equal(item[a : a + n], text[b : b + n]) for a, b, n in tiles)
        assert abs(sum(lengths) - naive_tiles(item.tolist(), text.tolist(), 3)) <= 4  # ties may be taken in another order


def test_contamination_finds_reordered_items(spark):
    rng = random.Random(9)
    item = prose(rng, 40)
    turned = prose(rng, 30) + item[20:] + prose(rng, 10) + item[:20]
    rows = [(1, " ".join(turned)), (2, " ".join(prose(rng, 100))), (3, None), (4, ""), (5, " ".join(item[:15])), (6, " ".join(item)), (6, " ".join(item)), (None, " ".join(item).upper())]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(7, " ".join(item), 1), (7, " ".join(item), 1), (8, "too short", 1), (9, None, 1), (None, " ".join(item), 1)], "item_id long, text string, doc_id int")
    found = sorted((r.doc_id or 0, r.item_id, r.covered) for r in G.contamination(docs, bench).collect())
    assert found == [(0, 7, 40), (1, 7, 40), (6, 7, 40), (6, 7, 40)]
    assert sorted(r.doc_id for r in G.without_benchmark(docs, bench).collect()) == [2, 3, 4, 5]
    assert G.contamination(docs, bench.limit(0)).count() == 0


def test_nearest_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    vectors = {i: rng.normal(size=16) for i in range(1, 400)}
    for i in range(300, 330):
        vectors[i] = vectors[100]
    vectors[331] = vectors[100] * 3
    bad = {400: None, 450: [0.0] * 16, 500: [float("nan")] + [1.0] * 15, 550: [None] + [1.0] * 15, 600: [float("inf")] + [1.0] * 15}
    rows = [(i, [float(x) for x in v], 1) for i, v in vectors.items()] + [(i, v, 1) for i, v in bad.items()] + [(None, [1.0] * 16, 1)]
    df = spark.createDataFrame(rows + rows[:3], "vec_id long, embedding array<double>, rank int")
    found = defaultdict(list)
    for r in nearest(df).collect():
        found[r.query_id].append((r["rank"], r.vec_id, r.score))
    ids = np.array(list(vectors))
    unit = np.array([vectors[i] / np.linalg.norm(vectors[i]) for i in ids])
    assert set(found) == {i for i in vectors if i % 50 == 0}
    for query, rows in found.items():
        scores = np.round(unit @ unit[list(ids).index(query)], 12)
        expected = sorted((-s, i) for s, i in zip(scores, ids.tolist()) if i != query)[:5]
        assert [r[1] for r in sorted(rows)] == [i for _, i in expected]
        assert np.allclose([r[2] for r in sorted(rows)], [-s for s, _ in expected], atol=1e-9)


def test_written_tables_leave_no_shuffle_files(spark):
    before = spark.conf.get(CLEANUP, None)
    docs = spark.range(0, 10_000, 1, 4).groupBy((F.col("id") % 977).alias("key")).count()

    def files():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return sum("shuffle_" in blocks.apply(i).name() for i in range(blocks.size()))

    held = files()
    table = written(docs, "shuffled")
    assert files() <= held and table.count() == 977 and spark.conf.get(CLEANUP, None) == before


@pytest.mark.parametrize("operator", [N.ngram_join, N.one_per_group, P.repeated_passages, P.without_repeats])
def test_empty_tables_give_no_rows(spark, operator):
    assert operator(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_neighbours_of_nothing(spark):
    assert nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
