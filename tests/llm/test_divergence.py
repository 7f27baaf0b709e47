"""Source divergence against a plain count, and the skyband against the ranking it must contain."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np

from demandloom.llm import divergence as D

SCHEMA = "text string, lang string, source string, term string, n int"


def plain(rows, ranks=10, least=10):
    docs = defaultdict(Counter)
    counts = defaultdict(Counter)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in counts}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        sources = sorted(s for g, s in counts if g == lang)
        whole = sum((counts[lang, s] for s in sources), Counter())

        def shares(counted):
            total = sum(counted[t] for t in kept)
            return {t: 1 + 10**9 * (counted[t] + 2) // (total + 2 * len(kept)) for t in kept}

        by = {s: shares(counts[lang, s]) for s in sources}
        q = shares(whole)
        for s in sources:
            pairs = [(o, sum((by[s][t] - by[o][t]) ** 2 // (by[s][t] + by[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, (by[s][t] - q[t]) ** 2 // (by[s][t] + q[t])) for t in kept if counts[lang, s][t] and by[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda i: (-i[1], i[0].encode()))
                out += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(items, 1) if part == "pair" or rank <= ranks]
    return sorted(out)


def check(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    found = sorted(tuple(r) for r in D.source_divergence(df, **{k: v for k, v in (("ranks", kw.get("ranks")), ("least_docs", kw.get("least"))) if v}).collect())
    assert found == plain(rows, **kw)
    return found


def corpus(seed, rows=300):
    rng = random.Random(seed)
    common = ["the", "Él", "größe", "naïve", "x", "of-the", "it's", "A1B", "日本 語"] + [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)]
    out = [(None, None, None), ("", "en", "bare"), ("1 2 3", "xx", "p"), ("only few", "yy", "a"), ("", "yy", "b"), (None, "en", "")]
    for _ in range(rows):
        lang, source = rng.choice(["en", "en", "en", "de", ""]), rng.choice(["hot", "hot", "hot", "b", "c", None, ""])
        words = rng.choices(common, weights=[1 + (hash((source, w)) % 7 == 0) * 5 for w in range(len(common))], k=rng.randint(0, 40))
        out.append((rng.choice([" ", "\n", ", "]).join(words), lang, source))
    return out + out[20:40] + [("the " * 60_000, "en", "hot")]


def test_report_equals_plain_counts(spark):
    rows = corpus(2)
    found = check(spark, rows)
    assert {r[2] for r in found} == {"pair", "term"} and max(r[5] for r in found if r[2] == "term") == 10
    check(spark, rows, ranks=3, least=2)


def test_tables_emptied_early_and_skybands_taken_often(spark, monkeypatch):
    rows = corpus(3, 120)
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).coalesce(1)
    schema = df.select("text", "lang", "source").toArrow().to_batches()
    monkeypatch.setattr(D, "TABLE_TERMS", 20)
    named = [b.set_column(i, n, b.column(i).fill_null("")) for b in schema for i, n in [(0, "text")]]
    named = [b.set_column(i, n, b.column(i).fill_null("")) for b in named for i, n in [(1, "lang")]]
    named = [b.set_column(i, n, b.column(i).fill_null("")) for b in named for i, n in [(2, "source")]]
    got = defaultdict(Counter)
    parts = 0
    for batch in D._counted(iter(named)):
        parts += 1
        for r in batch.to_pylist():
            got[r["lang"], r["source"]][r["term"]] += r["n"]
    assert parts > 20
    want = defaultdict(Counter)
    for text, lang, source in rows:
        want[lang or "", source or ""].update(t.decode() for t in D.terms_of((text or "").encode()))
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def test_skyband_holds_every_possible_first_rank():
    rng = random.Random(6)
    for _ in range(60):
        size, k = rng.randint(1, 80), rng.randint(1, 6)
        terms = [f"{rng.randrange(10**6):06d}" for _ in range(size)]
        rows = [(t, rng.randint(1, 9), rng.randint(0, 30)) for t in dict.fromkeys(terms)]
        rows = [(t, c, c + extra) for t, c, extra in rows]
        names, counts, totals = zip(*rows)
        kept = set(D.skyband(np.array(counts), np.array(totals), [n.encode() for n in names], k))
        for whole, lang_whole in ((50, 900), (500, 600), (5, 5000)):
            v = len(rows)
            p = [1 + 10**9 * (c + 2) // (whole + 2 * v) for c in counts]
            q = [1 + 10**9 * (c + 2) // (lang_whole + 2 * v) for c in totals]
            able = [i for i in range(v) if p[i] > q[i]]
            able.sort(key=lambda i: (-((p[i] - q[i]) ** 2 // (p[i] + q[i])), names[i].encode()))
            assert set(able[:k]) <= kept


def test_merged_skybands_equal_the_skyband_of_all():
    rng = random.Random(8)
    rows = [(f"t{i:04d}", rng.randint(1, 40), 40 + rng.randint(0, 200)) for i in rng.sample(range(3000), 900)]

    def band(part):
        names, counts, totals = zip(*part)
        return [part[i] for i in D.skyband(np.array(counts), np.array(totals), [n.encode() for n in names], 10)]

    assert sorted(band(band(rows[:500]) + band(rows[500:]))) == sorted(band(rows))


def test_a_band_fed_in_parts_is_the_skyband_of_all(monkeypatch):
    monkeypatch.setattr(D, "HELD", 40)
    monkeypatch.setattr(D, "BEST", 15)
    rng = random.Random(12)
    for k in (1, 4, 10):
        rows = [(f"{'longprefix' if i % 3 else ''}t{i:04d}", rng.randint(1, 30), 30 + rng.randint(0, 90)) for i in rng.sample(range(4000), 1200)]
        band = D.Band(k)
        for start in range(0, 1200, 70):
            names, counts, totals = zip(*rows[start : start + 70])
            band.add([n.encode() for n in names], np.array(counts), np.array(totals))
        band.reduce()
        names, counts, totals = zip(*rows)
        whole = {rows[i] for i in D.skyband(np.array(counts), np.array(totals), [n.encode() for n in names], k)}
        assert {(t.decode(), int(c), int(n)) for t, c, n in zip(band.terms, band.counts, band.totals)} == whole


def test_no_documents(spark):
    assert D.source_divergence(spark.createDataFrame([], SCHEMA)).count() == 0


def test_languages_without_kept_terms_have_pairs_of_value_zero(spark):
    assert check(spark, [("a b", "en", "x"), ("c", "en", "y")]) == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]
