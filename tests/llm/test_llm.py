"""The training-data operators against brute force on small tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import base64
import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from basketry.llm import bloom, chat_format, context_tree, fertility, license_scan, toxicity, words
from basketry.llm.components import components
from basketry.llm.decontaminate import contamination, decontaminate
from basketry.llm.jaccard_join import _with_partners, jaccard_join
from basketry.llm.mixing import mix, mixed, settle, targets
from basketry.llm.substring_dedup import cut_repeats, levels, substring_dedup
from basketry.llm.url_filter import filter_urls

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="session")
def texts():
    rng = random.Random(3)
    vocabulary = [f"{a}{b}" for a in ("ka", "lo", "mé", "ti", "the") for b in ("ra", "su", "", "x1")]
    passage = [rng.choice(vocabulary) for _ in range(70)]
    out = [None, "", "one", "two words", "a b\0c \t d", "x" * 5000, "The THE the"]
    for _ in range(25):
        own = [rng.choice(vocabulary) for _ in range(rng.randint(3, 200))]
        if rng.random() < 0.5:
            at = rng.randint(0, len(own))
            own[at:at] = passage[: rng.randint(40, 70)]
        out.append(rng.choice([" ", "\n", "  "]).join(own))
    base = [rng.choice(vocabulary) + str(i % 50) for i in range(160)]
    for n in (0, 1, 2, 3, 5, 9, 14):  # near copies, some of them beyond the limit
        copy = list(base)
        for i in rng.sample(range(160), n):
            copy[i] = "new"
        out.append(" ".join(copy))
    return [*out, out[10], out[10], " ".join(rng.choice(vocabulary) for _ in range(6000))]


@pytest.fixture(scope="session")
def docs(spark, texts):
    data = [(i * 3, t, f"s{i % 4}" if i % 4 else None, "clash", 1) for i, t in enumerate(texts)] + [(None, "null id here", "s1", "clash", 1)]
    return spark.createDataFrame(data, "doc_id long, text string, source string, places string, n_words long").repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string")


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def test_words_and_hashes(texts):
    seen = {}
    for w in words.chunks(pa.array(texts), words.PLAIN, 1000):
        for r in range(w.rows):
            a, z = w.bounds[r], w.bounds[r + 1]
            own = [w.raw[s:e].tobytes().decode() for s, e in zip(w.starts[a:z], w.ends[a:z])]
            assert own == WORD.findall(texts[w.first + r] or "")
            for word, h in zip(own, w.hashes[a:z].tolist()):
                assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)
    h = np.arange(1, 30, dtype=np.uint64)
    assert words.windows(h, 5)[3] == words.windows(h[3:8], 5)[0] and len(set(words.windows(h, 5).tolist())) == 29
    assert (words.sliding_min(np.array([5, 3, 4, 1, 9]), 3)[:3] == [3, 1, 1]).all()


def test_bloom(spark):
    keys = np.random.default_rng(0).integers(-(2**62), 2**62, 500)
    bits = bloom.build(spark.createDataFrame([(int(k),) for k in keys] + [(None,)], "k long"), 16)
    assert bloom.maybe(bits, keys).all() and bloom.maybe(bits, keys + 1).mean() < 0.2


def test_substring_dedup(docs, none):
    first, want = {}, {}
    for r in sorted((r for r in docs.collect() if r.doc_id is not None), key=lambda r: r.doc_id):
        own = WORD.findall(r.text or "")
        gone = set()
        for i in range(len(own) - 49):
            if first.setdefault(tuple(own[i : i + 50]), r.doc_id) < r.doc_id:
                gone |= set(range(i, i + 50))
        kept = " ".join(w for i, w in enumerate(own) if i not in gone)
        want[r.doc_id] = (len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in substring_dedup(docs).collect()}
    assert got.pop(None)[:2] == (3, 0) and got == want and any(n for _, n, *_ in want.values())
    cut = cut_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    assert all(r.text == (want[r.doc_id][3] if want[r.doc_id][1] else o.text) for r, o in zip(*[sorted((x for x in d.collect() if x.doc_id is not None), key=lambda x: x.doc_id) for d in (cut, docs)]))
    assert substring_dedup(none).count() == 0


def test_substring_dedup_rows_of_one_id(spark):
    p, o = " ".join(f"p{i}" for i in range(60)), " ".join(f"o{i}" for i in range(60))
    rows = [(1, p), (7, p), (7, o), (7, o), (None, p), (None, p), (9, f"x {o} y")]
    got = [(r.doc_id, r.kept_text) for r in substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(map(str, got)) == sorted(map(str, [(1, p), (7, ""), (7, o), (7, o), (None, p), (None, p), (9, "x y")]))
    assert levels(50) == [7, 13, 25, 50] and levels(8) == [8] and levels(9) == [5, 9]


def test_jaccard_join(docs, none):
    sets = {}
    for r in docs.where("doc_id IS NOT NULL").collect():
        own = WORD.findall(low(r.text))
        sets[r.doc_id] = {tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))} if own else set()
    leader = {d: d for d in sets}
    top = lambda d: d if leader[d] == d else top(leader[d])
    links = 0
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and sets[b]:
                x, y = sorted((top(a), top(b)))
                leader[y], links = x, links + 1
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join(docs).collect()}
    assert got.pop(None) == (1, None) and got == {d: (len(s), top(d)) for d, s in sets.items()} and links > 5
    assert jaccard_join(none).count() == 0


def test_jaccard_join_in_lots(docs, monkeypatch):
    """Blocks dealt into lots, by members and by shingles, lose no link."""
    want = sorted(map(str, jaccard_join(docs).collect()))
    for name in ("BLOCK", "PART"):
        with monkeypatch.context() as m:
            m.setattr(f"basketry.llm.jaccard_join.{name}", 3)
            assert sorted(map(str, jaccard_join(docs).collect())) == want


def test_shapes_with_partners():
    """A shape stays if a member of it has another member within its bounds, however the rows are cut into batches."""
    rng = random.Random(5)
    rows = sorted({(rng.randint(1, 6), rng.randint(1, 60), rng.randint(1, 9)): rng.randint(1, 2) for _ in range(90)}.items())
    rows = [(*key, m) for key, m in rows]
    want = set()
    for f, n, c, m in rows:
        reach = 7 * c / 3 + 3
        near = lambda x: 0.75 * n <= x <= min(n, 0.75 * n + reach) or max(n, (n - reach) / 0.75) <= x <= n / 0.75  # noqa: B023, E731
        others = [x for g, x, d, k in rows if g == f for _ in range(k - ((x, d) == (n, c)))]  # noqa: B023
        if any(map(near, others)):
            want.add((f, n, c))
    for size in (1, 4, 1000):
        batches = [pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows[i : i + size], strict=True)], ["first", "n", "c", "m"]) for i in range(0, len(rows), size)]
        got = [tuple(r.values()) for b in _with_partners(iter(batches)) for r in b.to_pylist()]
        assert len(got) == len(set(got)) and set(got) == want and len(want) < len(rows)
    assert not list(_with_partners(iter([])))


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 30)] + [(50, 40), (40, 41), (7, 7), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(2, 31)}, 41: 40, 50: 40}


def test_decontamination(spark, docs, texts, none):
    item = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    tests = [(1, " ".join(WORD.findall(texts[12])[3:30])), (2, "Two, words!"), (10, None), (None, "the"), (3, "absent words here"), (4, " ".join(["the"] * 20))]
    benchmark = spark.createDataFrame(tests, "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in contamination(docs, benchmark).collect()}
    for i, t in enumerate(texts):
        own, hit, items = item.findall(low(t)), set(), set()
        for name, test in tests:
            w = item.findall(low(test))
            size = min(13, len(w))
            for k in range(len(w) - size + 1 if w and name is not None else 0):
                for j in range(len(own) - size + 1):
                    if own[j : j + size] == w[k : k + size]:
                        hit |= set(range(j, j + size))
                        items.add(str(name))
        sha = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        assert got[i * 3] == (len(own), len(hit), len(items), sha, len(hit) > 0 and 20 * len(hit) >= len(own))
    seen = {r.doc_id: (r.longest_words, r.longest_item) for r in contamination(docs, benchmark).collect()}
    in_blocks = contamination(docs, benchmark, block_words=20)
    assert {r.doc_id: (r.longest_words, r.longest_item) for r in in_blocks.collect()} == seen and {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in in_blocks.collect()} == got
    for i, t in enumerate(texts):
        own, best = item.findall(low(t)), (0, "")
        for name, test in tests:
            w = item.findall(low(test)) if name is not None else []
            for k in range(len(w)):
                for j in range(len(own)):
                    n = 0
                    while k + n < len(w) and j + n < len(own) and w[k + n] == own[j + n]:
                        n += 1
                    best = max(best, (n, str(name))) if n else best
        assert seen[i * 3] == (best if best[0] else (0, None))
    assert {r.doc_id for r in decontaminate(docs, benchmark, block_words=20).collect()} == {r.doc_id for r in decontaminate(docs, benchmark).collect()} == {d for d, x in got.items() if not x[4]} and decontaminate(docs, benchmark).columns == docs.columns
    assert contamination(none, benchmark).count() == 0 and contamination(docs, benchmark.limit(0)).where("n_hit > 0").count() == 0


def test_mixing(spark, docs, none, monkeypatch):
    import basketry.llm.mixing as m

    monkeypatch.setattr(m, "BUCKET", 3)  # a tree of several levels
    got = mix(docs).collect()
    assert len(got) == docs.count() and all(r.size == len(WORD.findall(t or "")) for r in got if r.doc_id is not None for t in [docs.where(F.col("doc_id") == r.doc_id).first().text][:1] if r.doc_id < 30)
    by = collections.defaultdict(lambda: [0, 0, 0.0, 0])
    for r in got:
        assert r.taken in (0, r.size, 2 * r.size) and r.target <= 2 * r.source_size
        by[r.source] = [by[r.source][0] + r.taken, r.source_size, r.target, max(by[r.source][3], r.size)]
    assert all(abs(taken - target) <= largest / 2 for taken, _, target, largest in by.values())
    assert sum(t for _, _, t, _ in by.values()) == pytest.approx(1.5 * sum(r.size for r in got))
    again = {(r.doc_id, r.size): r.taken for r in mix(docs.repartition(5)).collect()}
    assert again == {(r.doc_id, r.size): r.taken for r in got} and mix(none).count() == 0
    goals = targets(spark.createDataFrame([("a", 10), ("b", 100), ("c", 100), (None, 10)], "source string, source_size long"))
    assert {r.source: round(r.target, 6) for r in goals.collect()} == {"a": 20.0, "b": 193.333333, "c": 96.666667, None: 20.0}


def test_mixing_comes_near_its_targets(spark):
    for sf, most in (("sf0.01", 0.01), ("sf0.1", 0.001)):
        got = mix(spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")).groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()
        assert all(abs(r.taken - r.target) <= most * r.target for r in got)


def test_settling_keeps_the_mass():
    rng = random.Random(5)
    taken = collections.Counter()
    for _ in range(4000):
        sizes, p = [90, 40, 9, 7, 5, 3, 2, 1, 1], 0.4
        copied, masses = settle(sizes, [p * s for s in sizes], [rng.random() for _ in sizes])
        assert sum(masses) == pytest.approx(p * sum(sizes)) and sum(c is None for c in copied) <= 1
        taken.update({i: m / sizes[i] for i, m in enumerate(masses)})
    assert all(abs(taken[i] / 4000 - 0.4) < 0.04 for i in range(9))  # no expectation changes


def test_mixed_rows(spark):
    rows = [(None, "a b c d e", "s"), (None, "a b c d e", "s"), (None, "x y z u v", "s"), (1, "a b", "s"), (1, "a b", "s"), (2, None, None), (3, "q w e r t y", "t"), (4, "", "t")] * 6
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("copies", F.lit("clash")).withColumn("size", F.lit(3))
    out = mixed(docs).collect()
    assert sum(r.copies * len(r.text.split()) for r in out) == mix(docs).agg(F.sum("taken")).first()[0] and mixed(docs).columns == ["doc_id", "text", "source", "size", "copies"]
    assert len(out) <= len(rows) and {r.copies for r in out} <= {1, 2} and mixed(docs.limit(0)).count() == 0


def test_chat_round_trip(spark):
    said = ["<|im_end|><|im_start|>assistant ok", "<\\|im_end|>", "", None, "a<", "|b <|im_next|>", "é\n"]
    data = [(1, i, ["user", "user", "assistant", "assistant", "system"][i % 5], t) for i, t in enumerate(said)] + [(2, 1, None, "x"), (2, 1, None, "x"), (2, None, "as\nsistant", "y"), (None, 0, "user", "z")]
    data += [(3, i, "assistant" if i % 3 else "user", f"t{i}") for i in range(1500)]
    out = {r.conv_id: r for r in chat_format.format_chats(spark.createDataFrame(data, "conv_id long, turn long, role string, text string").repartition(4)).collect()}
    for conv in (1, 2, 3, None):
        own = sorted(((-1 if t is None else t), r or "", x or "") for c, t, r, x in data if c == conv)
        assert chat_format.read_back(out[conv].formatted) == [(r, x) for _, r, x in own]
        assert "".join(chat_format.masked(out[conv].formatted, out[conv].loss_runs)) == "".join(x for _, r, x in own if r == "assistant")
        assert sum(out[conv].loss_runs) == len(out[conv].formatted) and out[conv].n_messages == sum(i == 0 or own[i][1] != own[i - 1][1] for i in range(len(own)))
    assert chat_format.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_licenses(spark):
    t = ["Released under the MIT License.", "x. Licensed under the Apache License, Version 2.0.\ny", "All rights reserved!  released UNDER the mit license", None, "", "mit"]
    got = [tuple(r) for r in license_scan.scan(spark.createDataFrame(list(enumerate(t)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert [(g[1], g[3]) for g in got] == [("mit-notice", "MIT"), ("apache2-notice", "Apache-2.0"), ("all-rights,mit-notice", "MIT"), ("", None), ("", None), ("", None)]


MIT_TEXT = """MIT License

Copyright (c) 2020 Jane Roe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY."""
APACHE_TEXT = """Copyright 2020 Jane Roe

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS."""
GPL3_TEXT = """Roe counts words.
This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful."""
GPL2_TEXT = """This program is free software; you can redistribute it and/or
modify it under the terms of the GNU General Public License
as published by the Free Software Foundation; either version 2
of the License, or (at your option) any later version."""
BSD2_TEXT = """Copyright (c) 2020, Jane Roe
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution."""
BSD3_TEXT = (
    BSD2_TEXT
    + """
3. Neither the name of the University of Roe nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
)


def test_whole_licenses(spark):
    mit, gpl3 = "mit-grant,mit-condition,as-is", "gpl-grant,gpl3-or-later"
    whole = [(MIT_TEXT, mit, "MIT"), (APACHE_TEXT, "apache2-notice,apache2-compliance,apache2-copy", "Apache-2.0"), (GPL3_TEXT, gpl3, "GPL-3.0-or-later"),
             (GPL2_TEXT, "gpl-grant,gpl2-or-later", "GPL-2.0-or-later"), (BSD2_TEXT, "all-rights,bsd-grant", "BSD-2-Clause"), (BSD3_TEXT, "all-rights,bsd-grant,bsd-endorse", "BSD-3-Clause")]
    more = [("\n".join(" ".join(part.split("\n")) for part in MIT_TEXT.split("\n\n")), mit, "MIT"), (MIT_TEXT.replace("\n", "\r\n"), mit, "MIT")]
    more += [("/*\n" + "\n".join(f" * {line}".rstrip() for line in text.split("\n")) + "\n */", ids, name) for text, ids, name in whole]
    none = [("Permission is hereby granted,\n\nfree of charge", "", None), ("This is not licensed under\nthe MIT License.", "", None), ("All rights.\nReserved.", "", None), ("日本" * 30000, "", None)]
    cases = whole + more + none
    got = license_scan.scan(spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(cases)], "doc_id long, text string")).orderBy("doc_id").collect()
    assert [(g.sentence_ids, g.license) for g in got] == [(ids, name) for _, ids, name in cases]


def test_urls(spark):
    rules = spark.createDataFrame([("net", "/", "block"), ("example.net", "/en/", "allow")], "host string, path string, verdict string")
    sites = spark.createDataFrame([("BAD.org.", None), ("bad.org", "/"), ("mixed.com", "/junk"), ("BÜCHER.de", "/"), (None, "/")] + [(f"site{i}.example", "/") for i in range(20000)], "host string, path string")
    bad, ok = (None, "block", "bad.org/"), (None, "allow", None)
    urls = {"http://A.example.NET/en/x?q": ("example.net/en/", "allow", None), "http://example.net/de/": ("net/", "block", None), "https://www.bad.org/": bad, "http://bad.org": bad, "http://bad.org?x": bad,
            "http://bad.org:80/a": bad, "http://u:p@bad.org/": bad, "http://bad.org.": bad, "http://bad.org.:8080#x": bad, "http://bad.org@good.org/": ok, "http://notbad.org/": ok, "http://x.net": ok, None: ok, "nothing": ok, "": ok, "http://": ok,
            "http://a.net?/en/": ok, "http://mixed.com/junk/x": (None, "block", "mixed.com/junk/"), "http://mixed.com//junk//x": (None, "block", "mixed.com/junk/"), "http://mixed.com/junky": ok, "http://mixed.com/junk": (None, "block", "mixed.com/junk/"), "http://MIXED.com/junk?x": (None, "block", "mixed.com/junk/"), "http://BÜCHER.de/": (None, "block", "bÜcher.de/"), "http://bücher.de/": ok, "http://a.site19999.example/x": (None, "block", "site19999.example/"), "http://site20000.example/x": ok}
    pages = spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate(urls)] * 2 + [(None, None, "", "")], "page_id long, url string, host string, verdict string")
    got = [(r.url, (r.rule, r.verdict, r.site)) for r in filter_urls(pages, rules, sites).collect()]
    assert len(got) == 2 * len(urls) + 1 and all(urls[u] == v for u, v in got)
    assert filter_urls(pages.limit(0), rules, sites).count() == 0 and filter_urls(pages, rules.limit(0), sites.limit(0)).where("verdict = 'block'").count() == 0


def test_fertility_counts(docs, none):
    for r in fertility.fertility(docs).where("doc_id IS NOT NULL").collect():
        t = docs.where(F.col("doc_id") == r.doc_id).first().text or "" if r.doc_id < 45 else None
        if t is None:
            continue
        own = WORD.findall(t)
        grams = collections.Counter(tuple(own[i : i + 3]) for i in range(len(own) - 2))
        again = {k for i in range(len(own) - 2) if grams[tuple(own[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words) == (len(own), sum(map(len, own)), len(lines) - len(set(lines)), len(again))
        assert r.base_failed == (len(own) < 50 or 100 * len(again) > 50 * len(own)) and not (r.base_failed and r.kept)
    assert fertility.fertility(none).count() == 0


def test_fertility_rejects_junk(spark):
    rng = random.Random(0)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    good = [r.doc_id for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1").collect()]
    rows = []
    for r in docs.where("lang = 'en' AND length(text) > 1500").orderBy("doc_id").limit(15).collect():
        letters = list(r.text.replace(" ", ""))
        rng.shuffle(letters)
        code, letters = base64.b64encode(r.text.encode()).decode(), "".join(letters)
        rows += [" ".join(code[i : i + 20] for i in range(0, len(code), 20)), " ".join(letters[i : i + 5] for i in range(0, len(letters), 5)), " ".join(rng.randbytes(4).hex() for _ in range(200))]
        rows.append(re.sub("[aeiou]", "é", r.text).encode().decode("latin-1"))
        rows.append(" ".join(["buy", "now"] * 200))
    junk = spark.createDataFrame([(10**6 + i, t, "en") for i, t in enumerate(rows)], "doc_id long, text string, lang string")
    kept = {r.doc_id: r.kept for r in fertility.fertility(docs.union(junk)).where("NOT base_failed").collect()}
    assert not any(k for d, k in kept.items() if d >= 10**6) and sum(d >= 10**6 for d in kept) >= 55
    own = [kept[d] for d in good if d in kept]
    assert sum(own) >= 0.98 * len(own) > 200
    few = fertility.fertility(docs.limit(50).withColumn("kept", F.lit("clash")))
    assert few.count() == 50 and few.where("kept AND base_failed").count() == 0


def test_context_tree(spark, none, monkeypatch, tmp_path):
    data = [(i, t) for i, t in enumerate(["abab", "Abba é", None, "", "the cat the cat", "zz"] * 2)] + [(None, "ab")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    rows = [(d, low(t)) for d, t in data]
    tokens = {i: WORD.findall(t) + [None] for i, (_, t) in enumerate(rows)}
    out = [d is not None and zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in rows]
    counts = collections.Counter(w for i in tokens if not out[i] for w in tokens[i])
    n, v, depth = sum(counts.values()), len(counts), context_tree.DEPTH
    bits = lambda t: [(ctx, node, bit) for ctx, byte in [(b[i - depth : i][::-1], b[i]) for b in [[255] * depth + list(t.encode()) + [255]] for i in range(depth, len(b))] for node, bit in [((1 << j) | (byte >> (8 - j)), byte >> (7 - j) & 1) for j in range(8)]]
    seen, below = collections.defaultdict(lambda: [0, 0]), collections.defaultdict(set)
    for i, (_, t) in enumerate(rows):
        for ctx, node, bit in bits(t) if not out[i] else []:
            for k in range(depth + 1):
                seen[node, tuple(ctx[:k])][bit] += 1
                below[node, tuple(ctx[:k])] |= {tuple(ctx[: k + 1])} if k < depth else set()
    block = lambda a: math.lgamma(a[0] + 0.5) + math.lgamma(a[1] + 0.5) - math.log(math.pi) - math.lgamma(sum(a) + 1)

    def weighted(node, ctx):
        own = block(seen[node, ctx])
        return own if len(ctx) == depth else math.log(0.5) + np.logaddexp(own, sum(weighted(node, c) for c in below[node, ctx]))

    def p(node, ctx, bit, k=0):
        a = seen.get((node, tuple(ctx[:k])), [0, 0])
        here = (a[bit] + 0.5) / (sum(a) + 1)
        if k == depth:
            return here
        w = math.exp(math.log(0.5) + block(a) - weighted(node, tuple(ctx[:k]))) if sum(a) else 0.5
        return w * here + (1 - w) * p(node, ctx, bit, k + 1)

    got = {r.doc_id: r for r in context_tree.lm_scores(docs).collect()}
    for i, (d, t) in enumerate(rows):
        r = got[d]
        assert (r.held_out, r.n_tokens, r.train_tokens, r.n_known) == (out[i], len(tokens[i]), n, sum(counts[w] > 0 for w in tokens[i]))
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens[i]))
        assert r.score == pytest.approx(sum(math.log10(p(node, ctx, bit)) for ctx, node, bit in bits(t)), rel=1e-5)
        assert r.bits_per_byte == pytest.approx(-r.score / math.log10(2) / (len(t.encode()) + 1))
    assert context_tree.lm_scores(none).count() == 0
    # Almost nothing broadcast, many tasks, other partitions and order, and clashing columns: the same.
    monkeypatch.setattr(context_tree, "MOST_STRINGS", 3)
    monkeypatch.setattr(context_tree, "MOST_WORDS", 1)
    monkeypatch.setattr(context_tree, "PER_TASK", 4)
    again = context_tree.lm_scores(docs.orderBy(F.rand(1)).repartition(5).withColumn("key", F.lit("clash")).withColumn("held_out", F.lit(7))).collect()
    assert all((r.doc_id, r.n_known, r.n_tokens) == (got[r.doc_id].doc_id, got[r.doc_id].n_known, got[r.doc_id].n_tokens) and r.score == pytest.approx(got[r.doc_id].score) and r.base_score == pytest.approx(got[r.doc_id].base_score) for r in again)
    # A file of nulls and empty texts beside others, and such a table alone.
    path = f"{tmp_path}/docs"
    for i, part in enumerate(([(1, "ab c"), (2, "ab")], [(3, None), (4, "")])):
        spark.createDataFrame(part, "doc_id long, text string").coalesce(1).write.parquet(f"{path}/p={i}")
    assert context_tree.lm_scores(spark.read.parquet(path)).where("score < 0").count() == 4
    assert context_tree.lm_scores(spark.createDataFrame([(3, None), (4, "")], "doc_id long, text string").coalesce(1)).where("score < 0").count() == 2


def test_toxicity(spark, none):
    rng = random.Random(1)
    word = lambda: rng.choice("ka lo ti ma ne ru".split()) + rng.choice("ra su no mi".split())
    data, labels = [(0, None), (1, ""), (2, "!!")], []
    for i in range(3, 260):
        own, bad = [word() for _ in range(rng.randint(10, 90))], i % 3 == 0
        for _ in range(3 * bad):
            own[rng.randrange(len(own))] = rng.choice(["vilex", "grunk", "morbo"])
        data.append((i, " ".join(own)))
        labels.append((i, int(bad)))
    docs, marks = spark.createDataFrame(data, "doc_id long, text string"), spark.createDataFrame(labels + [(None, 1)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, marks).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= got[i].score <= 1 for i in got)
    held = [(got[i].predicted, y) for i, y in labels if got[i].held_out]
    assert len(held) > 30 and sum(a == b for a, b in held) / len(held) > 0.9 and got[0].predicted == got[1].predicted == got[2].predicted == 0
    assert toxicity.toxicity(docs, marks.limit(0)).agg(F.max("score")).first()[0] == 0 and toxicity.toxicity(none, marks).count() == 0


def test_toxicity_sample(spark):
    docs = spark.createDataFrame([(i, f"text {i} here") for i in range(20)] * 3 + [(2, None), (3, "y " * 20000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(5000)], "doc_id long, toxic int")  # most labelled ids are not in the table
    got = toxicity.sampled(docs, labels, sample=5).collect()
    assert collections.Counter(r.toxic for r in got) == {0: 5, 1: 5} and len({(r.doc_id, r.text) for r in got}) == 10
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 and r.text == f"text {r.doc_id} here" for r in got)


def test_network_forward():
    """Against the recurrences written out for one window."""
    rng = np.random.default_rng(3)
    (w,) = words.chunks(pa.array(["some words of a short text, some more"]), words.ALNUM, 1 << 30)
    x = toxicity.inputs(w)
    p = {k: v.astype(np.float64) for k, v in toxicity._start(x, np.array([1.0]), rng).items()}
    v, h, n = toxicity._vectors(p, x).astype(np.float64), toxicity.HIDDEN, len(w.hashes)
    sigmoid = lambda a: 1 / (1 + math.exp(-a))
    states = [[None] * n, [None] * n]
    for d in (0, 1):
        s = [0.0] * h
        for t in range(n) if d == 0 else reversed(range(n)):
            gx = [sum(v[x.windows[0, t], i] * p["in"][d][i, j] for i in range(v.shape[1])) + p["bias"][d][j] for j in range(3 * h)]
            gh = [sum(s[i] * p["back"][d][i, j] for i in range(h)) for j in range(3 * h)]
            z, r = [sigmoid(gx[j] + gh[j]) for j in range(h)], [sigmoid(gx[h + j] + gh[h + j]) for j in range(h)]
            s = [z[j] * s[j] + (1 - z[j]) * math.tanh(gx[2 * h + j] + r[j] * gh[2 * h + j]) for j in range(h)]
            states[d][t] = s
    both = [states[0][t] + states[1][t] for t in range(n)]
    weight = [math.exp(sum(a * b for a, b in zip(p["attention"], s))) for s in both]
    pooled = [sum(weight[t] * both[t][i] for t in range(n)) / sum(weight) for i in range(2 * h)]
    want = sum(a * b for a, b in zip(pooled, p["out"])) + p["end"][0]
    assert toxicity._forward(p, v, x.windows, False)[0][0] == pytest.approx(want, rel=1e-4)


def test_network_gradient():
    rng = np.random.default_rng(0)
    (w,) = words.chunks(pa.array([" ".join(f"w{i % 7}" for i in range(40))]), words.ALNUM, 1 << 30)
    x = toxicity.inputs(w)
    p = toxicity._start(x, np.array([1.0]), rng)
    p = {k: v.astype(np.float64) for k, v in p.items()}
    v = toxicity._vectors(p, x).astype(np.float64)
    out, kept = toxicity._forward(p, v, x.windows, True)
    g, _ = toxicity._backward(p, v, x.windows, kept, np.ones(len(out)))
    for k in ("in", "back", "bias", "attention", "out"):
        at = tuple(rng.integers(0, s) for s in p[k].shape)
        p[k][at] += 1e-3
        up = toxicity._forward(p, v, x.windows, False)[0].sum()
        p[k][at] -= 2e-3
        down = toxicity._forward(p, v, x.windows, False)[0].sum()
        p[k][at] += 1e-3
        assert (up - down) / 2e-3 == pytest.approx(float(g[k][at]), rel=0.05, abs=2e-3)


def test_pipeline(spark):
    import corpus_pipeline

    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and corpus_pipeline.ORACLE_SQL is None
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert set(out.columns) == {*docs.columns, "copies"} and 0 < out.count() <= docs.count()


def test_pipeline_stages_with_odd_rows(spark):
    import corpus_pipeline as c

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(40)
    odd = docs.union(docs).union(docs.withColumn("doc_id", F.lit(None).cast("long"))).union(docs.withColumn("text", F.lit(None).cast("string"))).union(docs.limit(3).withColumn("source", F.lit(None).cast("string")))
    odd = odd.withColumn("copies", F.lit("clash"))
    for _, stage in c.STAGES:
        out = stage(spark, odd, folder)
        assert set(out.columns) == set(odd.columns) and 0 < out.count() <= odd.count() and stage(spark, odd.limit(0), folder).count() == 0
    once = c.one_of_near_copies(spark, odd, folder)
    assert once.where("doc_id IS NOT NULL").groupBy("doc_id", "text").count().where("count > 1").count() == 0 and once.where("doc_id IS NULL").count() == 40
    taken = c.mix_sources(spark, odd, folder)
    assert taken.where("copies NOT IN (1, 2)").count() == 0
