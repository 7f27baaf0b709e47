"""Operators that look at one row at a time, and mixing: round trips, brute force and held-out accuracy."""

from __future__ import annotations

import base64
import hashlib
import math
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from demandloom.llm import crossentropy, licenses, mixing, quality, queries, toxicity, warc

SF = "/root/testdata/sf0.01"


def test_warc_round_trip(spark):
    rows = [(1, "http://a", "hello"), (2, None, "hello"), (3, "u\nv", None), (4, "u", ""), (5, "u", "x" * 200_000), (None, "u", "hello"),
            (None, "n", "alone"), (5, "u", "x" * 200_000), (0, "é", "größe")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string")
    folder = warc.archive_folder(pages)
    index = warc.write_archive(pages, folder)
    found = sorted((r.page_id if r.page_id is not None else -1, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to or -9)
                   for r in warc.read_archive(index, folder).collect())
    first = {"hello": 1, "": 3, "x" * 200_000: 5, "größe": 0}
    expected = []
    for page, _, html in rows:
        data = (html or "").encode()
        head = first.get(html or "")
        revisit = head is not None and head != page
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        expected.append((-1 if page is None else page, len(data), digest, "revisit" if revisit else "response", head if revisit else -9))
    assert found == sorted(expected)
    chosen = warc.read_archive(index.where("url = 'é'"), folder).collect()
    assert [r.payload.decode() for r in chosen] == ["größe"]
    large = warc.write_archive(pages, warc.archive_folder(pages), least=1000)
    assert large.where("record_type = 'revisit'").count() == 0


def test_archives_are_read_by_their_bytes(spark, monkeypatch):
    """A small index of large archives is many tasks; the folder takes its scheme from Spark's file system."""
    monkeypatch.setattr(warc, "READ_BYTES", 20_000)
    rng = np.random.default_rng(3)
    pages = spark.createDataFrame([(k, "u", rng.bytes(3000).hex()) for k in range(60)], "page_id long, url string, html string").coalesce(2)
    folder = warc.archive_folder(pages)
    read = warc.read_archive(warc.write_archive(pages, folder), folder)
    assert read.rdd.getNumPartitions() >= 6 and sorted(r.page_id for r in read.collect()) == list(range(60))
    assert folder.startswith("file:///")
    assert warc.archive_folder(pages, lambda _, path: f"hdfs://name:8020{path}").startswith("hdfs://name:8020/")


def test_warc_of_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    folder = warc.archive_folder(pages)
    assert warc.read_archive(warc.write_archive(pages, folder), folder).count() == 0


def test_damaged_records_are_refused():
    data = warc.record_bytes(1, "u", b"abc", warc.base32_sha1(b"abc"), None, False)
    assert warc.parse_record(data)[1] == b"abc"
    with pytest.raises(Exception):
        warc.parse_record(data[:-3])


def words_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def base_of(text):
    words, places, labels = words_of(text), [], set()
    for phrase, label, _ in licenses.BASE:
        parts = phrase.split()
        for k in range(len(words) - len(parts) + 1):
            if words[k : k + len(parts)] == parts:
                places.append(k)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_license_scan(spark):
    texts = [None, "", "CC-BY, cc  by\ncc", "Licensed under the Apache License, Version 2.0.", "ALL rights\treserved General Public License",
             "mit und von", "under the terms of the MIT license", "SPDX-License-Identifier: GPL-3.0-or-later", "Kelvin cc by",
             "word " * 50_000 + "cc by", "Licensed under CC BY-NC 4.0. " * 300]
    rows = [(k, t, "x") for k, t in enumerate(texts)] + [(None, "cc by", "x")] * 2
    found = licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string, labels string")).collect()
    assert len(found) == len(rows)
    by = {r.doc_id: r for r in found}
    for k, text in enumerate(texts):
        r = by[k]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_of(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
    assert by[3].labels == "apache-2.0" and by[3].score == 0.95
    assert by[5].labels == "" and by[6].labels == "mit" and by[7].labels == "gpl-3.0" and by[7].score == 1.0
    assert by[10].n_base == 300 and "cc-by-nc" in by[10].labels
    assert licenses.rule_count() > 200


RULE_NAMES = ["Apache 2.0", "MIT", "CC0 1.0", "GPL v3", "public domain", "PostgreSQL"]
RULE_TEXTS = [text.format(name) for name in RULE_NAMES for text in (
    "SPDX-License-Identifier: {}", "is licensed under the {}", "Released under {}.", "available under {}",
    "provided under {}", "distributed under {}", "under the terms of the {}", "License: {}", "{} licence")] + [
    "copyright 2020", "(c) 2020", "without warranty", "Permission is hereby granted, free of charge, to all", "proprietary and confidential",
    "Redistribution and use in source and binary forms", "for non-commercial use only", "published in the public domain", "placed into public domain"]


def test_license_prefilter_drops_no_rule(spark):
    docs = spark.createDataFrame(list(enumerate(RULE_TEXTS)), "doc_id long, text string")
    found = {r.doc_id: r for r in licenses.license_scan(docs).collect()}
    assert found == {r.doc_id: r for r in licenses.license_scan(docs, prefilter=False).collect()}
    by = {text: found[k].labels for k, text in enumerate(RULE_TEXTS)}
    assert all(by.values()) and by["Released under Apache 2.0."] == "apache-2.0" and by["for non-commercial use only"] == "non-commercial"


SPDX_IDS = {
    "Apache-2.0": "apache-2.0", "MIT": "mit", "BSD-3-Clause": "bsd-3-clause", "BSD-2-Clause": "bsd-2-clause", "GPL-2.0-only": "gpl-2.0",
    "GPL-3.0-or-later": "gpl-3.0", "LGPL-2.1-only": "lgpl-2.1", "AGPL-3.0-only": "agpl-3.0", "MPL-2.0": "mpl-2.0", "EPL-2.0": "epl-2.0",
    "CDDL-1.0": "cddl-1.0", "BSL-1.0": "boost", "CC0-1.0": "cc0-1.0", "CC-BY-NC-4.0": "cc-by-nc", "CC-BY-SA-4.0": "cc-by-sa",
    "CC-BY-NC-ND-4.0": "cc-by-nc-nd", "CC-BY-NC-SA-4.0": "cc-by-nc-sa", "CC-BY-ND-4.0": "cc-by-nd", "OFL-1.1": "ofl-1.1", "EUPL-1.2": "eupl-1.2",
    "MS-PL": "ms-pl", "ISC": "isc", "Zlib": "zlib", "Unlicense": "unlicense", "Artistic-2.0": "artistic-2.0", "ODbL-1.0": "odbl"}
WRAPPED = {
    "Licensed under the\nApache License, Version 2.0": ("apache-2.0", 0.95), "released under the\n# MIT license": ("mit", 0.9),
    " * Licensed  under the   *\n * Apache License,   *\n * Version 2.0": ("apache-2.0", 0.95), "// for\n// non-commercial\n// use only": ("non-commercial", 0.6),
    "/* Permission is hereby granted, free of charge, to any person\n * obtaining a copy of this software and associated\n * documentation files": ("mit", 0.95)}


def test_license_ids_and_wrapped_notices(spark):
    cases = [(f"SPDX-License-Identifier: {name}", label, 1.0) for name, label in SPDX_IDS.items()]
    cases += [(f"License: {name}", label, 0.85) for name, label in SPDX_IDS.items()] + [(text, *both) for text, both in WRAPPED.items()]
    docs = spark.createDataFrame([(k, text) for k, (text, _, _) in enumerate(cases)], "doc_id long, text string")
    found = {r.doc_id: r for r in licenses.license_scan(docs).collect()}
    got = [(text, [x for x in found[k].labels.split(",") if x != "cc-by" or label == "cc-by"], found[k].score) for k, (text, label, _) in enumerate(cases)]
    assert got == [(text, [label], score) for text, label, score in cases]


LICENSE_PROSE = {
    "The library is available in Python.": "", "provided in Ruby and PHP": "", "published in C and available in PHP": "", "mit license plates": "",
    "a permit license": "", "licensed under Mitsubishi rules": "", "Eclipse Public License - v 1.0": "epl-1.0", "Eclipse Public License v2.0": "epl-2.0",
    "Creative Commons Attribution 4.0 International License": "cc-by-4.0", "Creative Commons Attribution-ShareAlike 3.0 Unported": "cc-by-sa",
    "CC BY 3.0 license": "cc-by,cc-by-3.0", "This work is MIT-licensed.": "mit", "Mozilla Public License, v. 2.0": "mpl-2.0",
    "SPDX-License-Identifier: (MIT OR Apache-2.0)": "apache-2.0,mit", "SPDX-License-Identifier: MIT AND (ISC OR GPL-2.0-only)": "gpl-2.0,isc,mit",
    "SPDX-License-Identifier: MIT. The isc chip": "mit", "licensed under the GNU General Public License, version 2": "gpl,gpl-2.0",
    "GNU Lesser General Public License version 2.1": "gpl,lgpl-2.1", "GNU Affero General Public License v3.0": "agpl-3.0,gpl",
    "Apache License, Version 2.0": "apache-2.0", "Apache License 2.01": "", "Apache License Version 2": "apache-2.0", "dedicated to the public domain": "public-domain"}


def test_license_prose(spark):
    docs = spark.createDataFrame(list(enumerate(LICENSE_PROSE)), "doc_id long, text string")
    found = {r.doc_id: r.labels for r in licenses.license_scan(docs).collect()}
    assert {text: found[k] for k, text in enumerate(LICENSE_PROSE)} == LICENSE_PROSE
    assert found == {r.doc_id: r.labels for r in licenses.license_scan(docs, prefilter=False).collect()}


def test_license_each_name_is_hit_and_missed(spark):
    """Every short name is found in its phrasing, and not where it is the end of a longer word."""
    names = sorted({name for _, _, name in licenses.LICENSES if re.fullmatch(r"[a-z0-9 ]+", name)})
    texts = [f"licensed under the {name}" for name in names] + [f"licensed under the q{name}q license" for name in names]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.labels for r in licenses.license_scan(docs).collect()}
    labels = {name: {label for label, _, other in licenses.LICENSES if other == name} for name in names}
    for k, name in enumerate(names):
        assert labels[name] & set(found[k].split(",")) and not labels[name] & set(found[len(names) + k].split(",")), name


@pytest.mark.parametrize("count", [0, 1, 255, 256, 257, 1000])
def test_license_intervals_equal_a_plain_search(spark, count):
    text = "".join(f"{'x' * (k % 7)}mit{'y' * (k % 3)}" for k in range(count)) + "end"
    row = spark.createDataFrame([(text, "mi?t|e")], "text string, pattern string").select(licenses._intervals(F.col("text"), F.col("pattern"))).first()[0]
    assert [(r.start, r.end) for r in row] == [m.span() for m in re.finditer("mi?t|e", text)]


def test_license_scan_of_given_documents(spark):
    docs = queries.table(spark, SF, "documents")
    texts = dict(docs.select("doc_id", "text").collect())
    for r in queries.op4_licenses(spark, SF).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_of(texts[r.doc_id])


def area(scores, labels):
    order = np.argsort(np.argsort(scores))
    ones = labels.sum()
    return (order[labels == 1].sum() - ones * (ones - 1) / 2) / (ones * (len(labels) - ones))


def labelled(spark, found, label, score):
    labels = {r.doc_id: r[label] for r in queries.table(spark, SF, "labels").collect()}
    rows = [(r[score], labels[r.doc_id], r.held_out) for r in found if r.doc_id in labels]
    held = np.array([(s, y) for s, y, h in rows if h], float)
    return area(held[:, 0], held[:, 1])


def test_toxicity_held_out(spark):
    found = queries.op5_toxicity(spark, SF).collect()
    assert len(found) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    assert labelled(spark, found, "toxic", "score") > 0.85


def test_quality_held_out(spark):
    found = queries.op3_quality(spark, SF).collect()
    assert len(found) == 1000 and labelled(spark, found, "quality", "tail_probability") > 0.95


def test_ordinal_thresholds_are_ordered():
    rng = np.random.default_rng(4)
    names = ["bad", "poor", "fair", "good"]
    rows = [(" ".join([names[g]] * 3 + [f"w{rng.integers(50)}" for _ in range(5)]), g + 1) for g in rng.integers(0, 4, 400)]
    model = quality.fit_ordinal(rows)
    assert model.grades == [1, 2, 3, 4] and (np.diff(model.thresholds) > 0).all()
    expected = [model.score(" ".join([name] * 3).encode(), 3)[0] for name in names]
    assert expected == sorted(expected) and expected[3] - expected[0] > 1.5


@pytest.mark.parametrize("scores", [toxicity.toxicity_scores, quality.quality_scores])
def test_scores_without_labels_or_texts(spark, scores):
    docs = spark.createDataFrame([(1, None, 0.5), (None, "", 0.5), (1, None, 0.5)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert scores(docs, labels).count() == 3
    assert scores(docs.limit(0), labels.limit(0)).count() == 0


def test_cross_entropy_counts_everything(spark):
    rows = [(1, "a b a b"), (2, "a b c"), (3, None), (4, ""), (None, "c c"), (2, "a b c")]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, score double")
    target = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "doc_id long, text string")
    pair = crossentropy.train_pair(docs, target)
    sums = {name: int(table.sum()) for name, table in pair.tables.items()}
    assert sums == {"target_words": 4, "target_pairs": 3, "all_words": 12, "all_pairs": 8}
    found = {(r.doc_id, r.n_tokens): r for r in crossentropy.cross_entropy_difference(docs, target).collect()}
    assert found[1, 4].score < found[2, 3].score and found[3, 0].score is None
    uni, two = pair.tables["all_words"], pair.tables["all_pairs"]
    words, pairs = crossentropy.slots(b"a b c")
    single = [(uni[w] + 0.5) / (12 + 0.5 * len(uni)) for w in words]
    chances = [single[0]] + [(two[pairs[k]] + 8 * single[k + 1]) / (uni[words[k]] + 8) for k in range(2)]
    assert found[2, 3].background_loss == pytest.approx(-sum(map(math.log, chances)) / 3)


def test_cross_entropy_model_grows_with_the_words(spark):
    """More distinct words than the 2**18 slots that once held them: no two share a count, losses are those of exact counts."""
    rows = [(k, " ".join(f"w{k}x{j}" for j in range(1000))) for k in range(300)] + [(300, "w0x0 w0x1 w0x1"), (301, "w0x0 w0x1 w0x1"), (302, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([(0,), (300,)], "doc_id long")
    pair = crossentropy.train_pair(docs, target)
    assert len(pair.tables["all_words"]) == 300_000 and len(pair.tables["all_pairs"]) == 300 * 999 + 1
    found = {r.doc_id: r for r in crossentropy.cross_entropy_difference(docs, target).collect()}
    size, total, goal = 300_000, 300_006, 1003
    assert found[301].n_tokens == 3 and found[302].n_tokens == 0 and found[302].score is None and len(found) == 303
    one, two = (3 + 0.5) / (total + 0.5 * size), (5 + 0.5) / (total + 0.5 * size)
    whole = -sum(map(math.log, (one, (3 + 8 * two) / (3 + 8), (2 + 8 * two) / (5 + 8)))) / 3
    one, two = (2 + 0.5) / (goal + 0.5 * size), (3 + 0.5) / (goal + 0.5 * size)
    near = -sum(map(math.log, (one, (2 + 8 * two) / (2 + 8), (1 + 8 * two) / (3 + 8)))) / 3
    assert found[301].background_loss == pytest.approx(whole) and found[301].target_loss == pytest.approx(near)
    assert found[300].score == pytest.approx(near - whole)


def plain_losses(rows, goal):
    """Every document's losses from counts kept as dictionaries."""
    texts = [(i, (t or "").encode().lower().split()) for i, t in rows]
    counts = {}
    for kind, chosen in (("target", [w for i, w in texts if i in goal]), ("whole", [w for _, w in texts])):
        words, pairs = defaultdict(int), defaultdict(int)
        for w in chosen:
            for k, word in enumerate(w):
                words[word] += 1
                pairs[tuple(w[k - 1 : k + 1])] += k > 0
        counts[kind] = words, pairs, sum(words.values())
    size, out = len({word for _, w in texts for word in w}), []
    for i, w in texts:
        losses = []
        for words, pairs, total in counts.values():
            single = [(words[word] + 0.5) / (total + 0.5 * size) for word in w]
            chances = [(pairs[w[k - 1], w[k]] + 8 * s) / (words[w[k - 1]] + 8) if k else s for k, s in enumerate(single)]
            losses.append(-sum(map(math.log, chances)) / len(w) if w else None)
        out.append((i, len(w), *losses))
    return out


@pytest.mark.parametrize("goal", [{3, 4, 50}, set()])
def test_losses_equal_plain_counts(spark, monkeypatch, goal):
    """Blocks of few words, nulls, empty and very long texts, repeated rows and ids, clashing columns; also no target."""
    monkeypatch.setattr(crossentropy, "BLOCK", 300)
    rng = np.random.default_rng(4)
    words = [f"W{k}" for k in range(60)] + ["the"] * 20 + ["größe"]
    rows = [(int(k) if k % 9 else None, " ".join(rng.choice(words, rng.integers(0, 90)))) for k in range(60)]
    rows += [(70, None), (71, ""), (72, " \n"), (3, "the w1 THE"), (3, "the w1 THE"), (73, "w2"), (74, " ".join(rng.choice(words, 20_000)))]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, chosen string, bucket int").repartition(3)
    target = spark.createDataFrame([(k,) for k in [*goal, None]], "doc_id long")
    found = [tuple(r) for r in crossentropy.cross_entropy_difference(df, target).collect()]
    order = lambda r: (r[0] is None, r[0] or 0, r[1], r[3] or 0)
    for one, two in zip(sorted(found, key=order), sorted(plain_losses(rows, goal), key=order), strict=True):
        assert one[:2] == two[:2] and one[2:4] == pytest.approx(two[2:4])
        assert one[4] == (pytest.approx(two[2] - two[3]) if two[1] else None)


def test_a_large_target_is_joined(spark, monkeypatch):
    rows = [(k % 7, f"a b{k % 3} c{k % 5} a") for k in range(40)]
    docs, target = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(k,) for k in (1, 2, 3)], "doc_id long")
    sent = sorted(map(tuple, crossentropy.cross_entropy_difference(docs, target).collect()))
    monkeypatch.setattr(crossentropy, "KNOWN_IDS", 2)
    joined = sorted(map(tuple, crossentropy.cross_entropy_difference(docs, target).collect()))
    assert [r[:2] for r in sent] == [r[:2] for r in joined] and [x for r in sent for x in r[2:]] == pytest.approx([x for r in joined for x in r[2:]])


def test_no_documents_have_no_losses(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert crossentropy.cross_entropy_difference(none, none.select("doc_id")).count() == 0


def test_packed_numbers_come_back():
    rng = np.random.default_rng(1)
    for values in (np.array([], np.uint32), np.array([7], np.uint8), rng.integers(0, 2**64, 99, dtype=np.uint64)):
        assert (crossentropy.unpacked(crossentropy.packed(values)) == values).all()
        assert (crossentropy.unpacked_sorted(crossentropy.packed_sorted(np.sort(values).astype(np.uint64))) == np.sort(values)).all()


def test_a_null_source_is_not_the_empty_one(spark):
    rows = [(k, "w " * 10, [None, "", "=", "x"][k % 4]) for k in range(40)]
    found = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {(r.source, round(r.weight, 9)) for r in found} == {(None, 0.25), ("", 0.25), ("=", 0.25), ("x", 0.25)}
    alone = mixing.mix_sources(spark.createDataFrame([(1, "a b", "s"), (2, "w " * 60_000, "s")], "doc_id long, text string, source string"))
    assert {(r.source, r.weight) for r in alone.collect()} == {("s", 1.0)}


def test_mixing_meets_its_weights(spark):
    rows = [(k, "w " * (k % 7 + 1), "big" if k % 4 else ("mid" if k % 8 else "small"), "x") for k in range(800)]
    rows += [(9000, "one two", None, "x"), (9001, None, "big", "x"), (None, "a b c", "big", "x"), (9002, "", "none", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, block string")
    read = mixing.mix_sources(docs, entropy=0.9, max_passes=None).collect()
    sizes, got, weights = defaultdict(int), defaultdict(int), {}
    for _, text, source, _ in rows:
        sizes[source] += len((text or "").split())
    budget = sum(sizes.values())
    for r in read:
        got[r.source] += r.n_tokens
        weights[r.source] = r.weight
    x = read[0].exponent
    used = {s: n for s, n in sizes.items() if n}
    shares = {s: (n / budget) ** x for s, n in used.items()}
    norm = sum(shares.values())
    for source, share in shares.items():
        assert weights[source] == pytest.approx(share / norm)
        quota = share / norm * budget
        assert quota - 1 <= got[source] < quota + 8  # one document beyond at most
    entropy = -sum(s / norm * math.log(s / norm) for s in shares.values())
    assert entropy >= 0.9 * math.log(len(shares)) - 1e-5
    assert {r.doc_id for r in read if r.source is None} == {9000}
    limited = mixing.mix_sources(docs, entropy=0.9, max_passes=2.0).collect()
    assert max(r["pass"] for r in limited) <= 2
    assert mixing.mix_sources(docs.limit(0)).count() == 0


def test_pipeline_keeps_columns_and_ends_in_a_mix(spark):
    docs = queries.table(spark, SF, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = queries_written(stage(spark, docs, SF), name)
        assert docs.columns == columns and 0.8 * before < docs.count() <= before
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert set(r.doc_id for r in mixed.select("doc_id").distinct().collect()) <= {r.doc_id for r in docs.select("doc_id").collect()}


def queries_written(df, name):
    from demandloom.llm.storage import written

    return written(df, name)
