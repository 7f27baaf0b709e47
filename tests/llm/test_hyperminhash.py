"""HyperMinHash near-duplicates against brute force, and its sketch against its definition."""

from __future__ import annotations

import random

import numpy as np
import pytest

from demandloom.llm import hyperminhash as H
from demandloom.llm import ngram_join as N


def prose(rng: random.Random, count: int) -> list[str]:
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 7))) for _ in range(count)]


def varied_texts() -> dict[int, str | None]:
    """Copies, near copies around one base and along a chain, short texts, a common line, blanks and nulls."""
    rng = random.Random(11)
    out: dict[int, str | None] = {1: None, 2: "", 3: " \n\t", 4: "One", 5: "one", 6: "one two"}
    base = prose(rng, 150)
    for k in range(10, 45):
        words = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 6, 9])):
            words[rng.randrange(len(words))] = prose(rng, 1)[0]
        out[k] = " ".join(words)
    chain = prose(rng, 200)
    for k in range(50, 70):
        chain = chain[4:] + prose(rng, 4)
        out[k] = " ".join(chain)
    line = " ".join(prose(rng, 12))
    for k in range(70, 90):
        out[k] = " ".join(prose(rng, rng.randint(0, 6))) + "\n" + line + "\n" + " ".join(prose(rng, rng.randint(0, 3)))
    for k in range(90, 96):  # six shingles in seven: the smallest sets that link without being equal
        out[k] = "a b c d e f g h" + (" i" if k % 2 else "") + (" j" if k == 95 else "")
    out[97], out[98], out[99] = out[10].upper(), out[50], " ".join(prose(rng, 5000))
    return out


def shingles(text: str | None, size: int) -> frozenset:
    words = (text or "").encode().lower().split()
    size = min(size, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if words else frozenset()


def brute(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    out = []
    for k, (i, _) in enumerate(rows):
        component = least.get(find(k))
        out.append((i, len(sets[k]), component, component is None if i is None else i == component))
    return sorted(out, key=str)


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_classes_equal_brute_force(spark, size, percent):
    texts = varied_texts()
    rows = [*texts.items(), (10, texts[10]), (12, texts[60]), (None, texts[11]), (None, "nobody has this one " * 3)]
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], "doc_id long, text string, node int, registers string")
    found = [tuple(r) for r in H.near_duplicates(df, size, percent).collect()]
    assert sorted(found, key=str) == brute(rows, size, percent)


def test_a_crowd_of_near_copies(spark, monkeypatch):
    """Many variants of one text, some too far from it but near to each other, with few words to choose from."""
    monkeypatch.setattr(H, "CROWD", 10)
    monkeypatch.setattr(H, "RARE", 6)
    rng = random.Random(21)
    base, spare = prose(rng, 150), prose(rng, 12)
    rows = []
    for k in range(120):
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 6, 7])):
            words[rng.randrange(len(words))] = rng.choice(spare)
        rows.append((k, " ".join(words)))
        if k % 10 == 0:  # a pair around a variant of its own
            for _ in range(6):
                words[rng.randrange(len(words))] = prose(rng, 1)[0]
            rows += [(200 + k, " ".join(words)), (201 + k, " ".join([*words[:-1], "x"]))]
    made = []
    real = H._sifted
    monkeypatch.setattr(H, "_sifted", lambda pairs, *a: made.append(pairs.count()) or real(pairs, *a))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = [tuple(r) for r in H.near_duplicates(df, 3, 85).collect()]
    assert sorted(found, key=str) == brute(rows, 3, 85)
    assert sum(made) < 144 * 143 / 2 / 3  # far fewer than all pairs


def test_no_documents(spark):
    assert H.near_duplicates(spark.createDataFrame([], "doc_id long, text string"), 3, 85).count() == 0


def test_documents_without_links(spark):
    rng = random.Random(4)
    rows = [(k, " ".join(prose(rng, 40))) for k in range(20)]
    found = H.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert sorted(r.component_id for r in found) == list(range(20)) and all(r.kept for r in found)


def test_registers_hold_the_least_value_of_each_bucket():
    rng = np.random.default_rng(1)
    hashes = np.unique(rng.integers(0, 2**64, 500, dtype=np.uint64))
    found = H.registers_of(hashes)
    for bucket in range(H.BUCKETS):
        inside = [int(h) & ((1 << H.VALUE_BITS) - 1) for h in hashes if int(h) >> H.VALUE_BITS == bucket]
        if not inside:
            assert found[bucket] == 0
            continue
        bits = f"{min(inside):0{H.VALUE_BITS}b}"
        zeros = len(bits) - len(bits.lstrip("0"))
        mantissa = (bits[zeros + 1 :] + "0" * 64)[: H.MANTISSA]
        assert found[bucket] == (zeros + 1 << H.MANTISSA) + int(mantissa, 2)


def test_estimate_is_near_the_truth_and_corrected_for_chance(monkeypatch):
    rng = np.random.default_rng(2)
    errors = []
    for _ in range(200):
        common, one, two = (rng.integers(0, 2**64, n, dtype=np.uint64) for n in (1700, 150, 150))
        x, y = (H.registers_of(np.unique(np.concatenate((common, part)))) for part in (one, two))
        estimate, used, _ = H.estimated_jaccard(x[None], y[None], np.array([1850]), np.array([1850]))
        errors.append(estimate[0] - 0.85)
        assert used[0] == H.BUCKETS
    assert abs(np.mean(errors)) < 0.012 and np.std(errors) < 0.06
    monkeypatch.setattr(H, "MANTISSA", 3)  # short registers meet by chance; without a correction the mean would be 0.02
    agreeing = []
    for _ in range(300):
        x, y = (H.registers_of(np.unique(rng.integers(0, 2**64, 2000, dtype=np.uint64))) for _ in range(2))
        agreeing.append((x == y).mean())
    chance = H.accidental(np.array([2000]), np.array([2000]))[0]
    assert abs(np.mean(agreeing) - chance) < 0.004 and chance > 0.015


def test_links_are_never_refused_by_the_sketch():
    rng = np.random.default_rng(3)
    for count in (6, 7, 10, 30, 100, 1000):
        for _ in range(100):
            room = int(count * 0.15 / 1.15)
            common = rng.integers(0, 2**64, count, dtype=np.uint64)
            x = np.unique(common)
            y = np.unique(np.concatenate((common[room // 2 :], rng.integers(0, 2**64, max(1, room // 2), dtype=np.uint64))))
            both = len(np.intersect1d(x, y))
            if 100 * both >= 85 * (len(x) + len(y) - both):
                sketches = H.registers_of(x)[None], H.registers_of(y)[None]
                assert H.may_link(*sketches, np.array([len(x)]), np.array([len(y)]), 85)[0]
                assert np.intersect1d(H.bands_of(sketches[0][0]), H.bands_of(sketches[1][0])).size


def test_set_sizes_that_cannot_link_have_no_bands():
    assert H.smallest_linked(85) == 6 and H.smallest_linked(80) == 4 and H.smallest_linked(50) == 1
    assert N.shingle_set(b"a b", 3).size == 1
