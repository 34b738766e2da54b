"""Near copies by row, quality bands of small tables and tokeniser metrics against brute force."""

import base64
import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from basketry.llm import fertility
from basketry.llm.jaccard_join import one_of_each_group

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall((text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def groups(texts):
    """The component of each text, by comparing all of them."""
    sets, of = [shingles(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                of = [of[j] if c == of[i] else c for c in of]
    return of


def test_texts_that_share_an_id_count_by_themselves(spark):
    rng = random.Random(8)
    p, o = (" ".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=60)) for _ in range(2))
    rows = spark.createDataFrame([(1, p, 5), (7, p, 6), (7, o, 7), (7, o, 7), (9, o + " and more", 8)], "doc_id long, text string, component_id int")
    assert sorted((r.doc_id, r.text, r.component_id) for r in one_of_each_group(rows).collect()) == sorted([(1, p, 5), (7, o, 7)])


def test_one_of_each_group_equals_brute_force(spark):
    rng = random.Random(9)
    base = [[rng.choice("abcdefgh") + str(rng.randint(0, 40)) for _ in range(rng.randint(1, 90))] for _ in range(12)]
    rows = []
    for i in range(70):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 6])):
            words[rng.randrange(len(words))] = "new"
        rows.append((rng.randint(0, 40), " ".join(words), rng.choice(["de", None])))
    rows += [(3, None, "de"), (3, "", "de"), (3, " ", "de"), (50, "", None), *rows[:3], (None, rows[0][1], "en"), (None, rows[0][1], "en")]
    got = one_of_each_group(spark.createDataFrame(rows, "doc_id long, text string, n string")).collect()
    known = [r for r in rows if r[0] is not None]
    of = groups([r[1] for r in known])
    want = {(d, t) for (d, t, _), c in zip(known, of, strict=True) if not shingles(t)}
    for c in set(of):
        member = [(d, t) for (d, t, _), x in zip(known, of, strict=True) if x == c and shingles(t)]
        want |= {min(member, key=lambda m: (m[0], hashlib.md5(m[1].encode()).hexdigest()))} if member else set()
    kept = collections.Counter((r.doc_id, r.text) for r in got if r.doc_id is not None)
    assert dict(kept) == dict.fromkeys(want, 1) and sum(r.doc_id is None for r in got) == 2


def test_bands_of_small_tables(spark):
    """The same rule for a table of 200 documents: planted junk goes, labelled good documents stay."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    rows = docs.where("length(text) > 800").orderBy("doc_id").limit(6).collect()
    junk = [(10**6 + i, " ".join(re.findall(".{1,20}", base64.b64encode(r.text.encode()).decode())), r.lang) for i, r in enumerate(rows)]
    found = fertility.fertility(docs.union(spark.createDataFrame(junk, docs.schema))).where("NOT base_failed")
    kept = {r.doc_id: r.kept for r in found.collect()}
    assert not any(kept[10**6 + i] for i in range(len(junk)))
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    good, bad = ([kept[r.doc_id] for r in labels.where(f"quality = {q}").collect() if r.doc_id in kept] for q in (1, 0))
    assert sum(good) >= 0.98 * len(good) and sum(bad) < len(bad)


def test_metrics_equal_brute_force(spark):
    texts = ["a cat # sat", "é né $5 日本 <b>", "one one one", "x" * 40, None, "", "&&& ||| %%% ***", "the quick brown fox\nthe quick\nthe quick\n\n"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pieces = sentencepiece.SentencePieceProcessor(model_file=f"{fertility.FOLDER}/{fertility.PIECES}")
    for r in fertility.fertility(rows).collect():
        text = texts[r.doc_id] or ""
        words = WORD.findall(text)
        ids = [i for w in words for i in pieces.encode(w)]
        counts = collections.Counter(ids)
        entropy = -sum(n / len(ids) * math.log2(n / len(ids)) for n in counts.values()) / math.log2(len(ids)) if len(ids) > 1 else 0.0
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", text)) and r.word_chars == sum(map(len, words))
        assert r.entropy == pytest.approx(entropy, abs=1e-9)
        assert r.chars_per_token == pytest.approx(r.word_chars / max(len(ids), 1)) and r.byte_share == pytest.approx(sum(pieces.is_byte(i) for i in ids) / max(len(ids), 1))


def test_language_bands_by_hand(spark):
    """Quartiles of a language count with its documents, those of the wider group with the weight."""
    rows = [("en", "latin", 2.0 + i / 100) for i in range(41)] + [("de", "latin", 3.0)] + [(None, "greek", 1.0)]
    measured = spark.createDataFrame([(lang, s, False, v, v, 0.0, 0.5) for lang, s, v in rows] + [("en", "latin", True, 99.0, 99.0, 9.0, 9.0)], "lang string, script string, base_failed boolean, chars_per_token double, chars_per_byte_level_token double, byte_share double, entropy double")
    got = {(r.lang, r.script): r.chars_per_token_low for r in fertility.language_bands(measured, 4.0, 20).collect()}
    def quartiles(keep):
        return np.percentile([v for lang, s, v in rows if keep(lang, s)], [25, 75]), sum(keep(lang, s) for lang, s, _ in rows)

    every = quartiles(lambda lang, s: True)[0]
    for lang, script in got:
        wide, n = quartiles(lambda _, s, script=script: s == script)
        wide = (wide * n + every * 20) / (n + 20)
        own, n = quartiles(lambda x, s, lang=lang, script=script: (x, s) == (lang, script))
        own = (own * n + wide * 20) / (n + 20)
        assert got[lang, script] == pytest.approx(own[0] - max(4 * (own[1] - own[0]), 0.1))
    assert set(got) == {("en", "latin"), ("de", "latin"), (None, "greek")}


def test_pipeline_stage_keeps_what_stands_nowhere_else(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = corpus_pipeline.one_of_near_copies(spark, docs, "/root/testdata/sf0.001")
    rows = docs.select("doc_id", "text").collect()
    of = groups([r.text for r in rows])
    least = {}
    for r, c in zip(rows, of, strict=True):
        least[c] = min(least.get(c, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in out.select("doc_id").collect()) == sorted(least.values()) and out.columns == docs.columns
    assert out.join(docs, docs.columns, "left_semi").count() == out.count()
    assert corpus_pipeline.one_of_near_copies(spark, docs.where(F.lit(False)), "").count() == 0


ISC_TEXT = """Copyright 2020 Jane Roe

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE."""
LGPL3_TEXT = """This library is free software: you can redistribute it and/or modify
it under the terms of the GNU Lesser General Public License as published
by the Free Software Foundation, either version 3 of the License, or (at
your option) any later version."""
MPL_TEXT = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */"""
APACHE_LINES = ['Licensed under the Apache License, Version 2.0 (the "License");', "you may not use this file except in compliance with the License.", "You may obtain a copy of the License at", "", "    http://www.apache.org/licenses/LICENSE-2.0"]
ZLIB_TEXT = """This software is provided 'as-is', without any express or implied
warranty.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented."""


def test_more_licences_and_tags(spark):
    from basketry.llm import license_scan

    apache = "apache2-notice,apache2-compliance,apache2-copy"
    cases = [(ISC_TEXT, "isc-grant,author-disclaims", "ISC"), (LGPL3_TEXT, "lgpl-grant,lgpl3-or-later", "LGPL-3.0-or-later"), (MPL_TEXT, "mpl2-notice,mpl2-copy", "MPL-2.0"), (ZLIB_TEXT, "zlib-as-is,zlib-grant", "Zlib")]
    cases += [("\n".join(f"{sign} {line}" for line in APACHE_LINES), apache, "Apache-2.0") for sign in ("#", "//", "REM", "dnl", "--", ";;", " *")]
    cases += [(f"// SPDX-License-Identifier: {name}\nint x;", f"spdx-{name.lower()}", name) for name in license_scan.SPDX]
    cases += [(text.replace("\n", " "), ids, name) for text, ids, name in cases[1:2]]
    cases += [("rem tene bras\nremote", "", None), ("SPDX-License-Identifier: MIT OR Nothing", "", None), (None, "", None), ("all rights reserved. " * 3000, ",".join(["all-rights"] * 3000), "proprietary")]
    rows = spark.createDataFrame([(i if i else None, t, "clash", 1) for i, (t, _, _) in enumerate(cases)] * 2, "doc_id long, text string, sentence string, row int")
    got = sorted(((r.doc_id or 0, r.sentence_ids, r.license) for r in license_scan.scan(rows).collect()), key=str)
    assert got == sorted([(i, ids, name) for i, (_, ids, name) in enumerate(cases)] * 2, key=str)
    assert license_scan.scan(rows.limit(0)).count() == 0 and len({name for name, _ in license_scan.RULES}) > 25
    own = spark.createDataFrame([("rem tene bras", "own")], "sentence string, ids string")
    assert [r.sentence_ids for r in license_scan.scan(spark.createDataFrame([(1, "x\n\nRem; tene\nbras!")], "doc_id long, text string"), own).collect()] == [""]  # a comment word goes
