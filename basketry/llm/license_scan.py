"""Licence scans by sentence rules, in DataFrame functions.

A text is normalised to words and cut into sentences. Single line feeds and semicolons may end a sentence and may stand inside
one, so wrapped texts and their comment signs do no harm: a sentence is any run of neighbouring lines without a harder cut.
Runs that begin like a known sentence are joined by the whole sentence with a table of them, which gives their
identifiers; all others never leave their row. The sequence of a text's identifiers is matched against ordered rules; the
first rule whose identifiers stand in it side by side decides.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.llm.store import kept

# Sentences of well-known public licences and licence notices, normalised, and their identifiers.
SENTENCES = {
    "released under the mit license": "mit-notice",
    "licensed under the mit license": "mit-notice",
    "this project is licensed under the mit license": "mit-notice",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-condition",
    "the software is provided as is without warranty of any kind express or implied": "as-is",
    "licensed under the apache license version 2 0": "apache2-notice",
    "licensed under the apache license version 2 0 the license": "apache2-notice",
    "you may not use this file except in compliance with the license": "apache2-compliance",
    "you may obtain a copy of the license at": "apache2-copy",
    "this work is licensed under the gnu general public license version 3": "gpl3-notice",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl-grant",
    "either version 3 of the license or at your option any later version": "gpl3-or-later",
    "either version 2 of the license or at your option any later version": "gpl2-or-later",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-endorse",
    "licensed under cc by 4 0": "cc-by-notice",
    "licensed under cc by sa 4 0": "cc-by-sa-notice",
    "licensed under cc by nc 4 0": "cc-by-nc-notice",
    "all rights reserved": "all-rights",
}
# Sentences as the licences' own texts have them; some bear several identifiers.
TEXTS = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice including the next paragraph shall be included in all copies or substantial portions of the software": "mit-condition",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "as-is",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and non infringement": "as-is",
    "apache license version 2 0 january 2004": "apache2-notice",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "apache2-copy",
    "you may obtain a copy of the license at https www apache org licenses license 2 0": "apache2-copy",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl-grant,gpl3-or-later",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl-grant,gpl2-or-later",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl-grant",
    "gnu general public license version 3 29 june 2007": "gpl3-notice",
}
# More licences and notices as they are written, and the identifiers of their sentences.
PROSE = [
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "isc-grant"),
    ("Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "isc-grant"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.", "0bsd-grant"),
    ('The software is provided "as is" and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness.', "author-disclaims"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.", "mit0-grant"),
    ("Except as contained in this notice, the name of the X Consortium shall not be used in advertising or otherwise to promote the sale, use or other dealings in this Software without prior written authorization from the X Consortium.", "x11-name"),
    ("This software is provided 'as-is', without any express or implied warranty.", "zlib-as-is"),
    ("Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:", "zlib-grant"),
    ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:", "boost-grant"),
    ("Distributed under the Boost Software License, Version 1.0.", "boost-notice"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
    ("Do what the fuck you want to public license", "wtfpl-title"),
    ("Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies.", "postgresql-grant"),
    ("All advertising materials mentioning features or use of this software must display the following acknowledgement:", "bsd-advert"),
    ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.", "lgpl-grant,lgpl21-or-later"),
    ("This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "lgpl-grant,lgpl3-or-later"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "lgpl-grant,lgpl3-or-later"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "agpl-grant,agpl3-or-later"),
    ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.", "gpl2-only-grant"),
    ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License, version 2, as published by the Free Software Foundation.", "gpl2-only-grant"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License version 3 as published by the Free Software Foundation.", "gpl3-only-grant"),
    ("GNU General Public License version 2, June 1991", "gpl2-title"),
    ("GNU Affero General Public License version 3, 19 November 2007", "agpl3-title"),
    ("GNU Lesser General Public License version 3, 29 June 2007", "lgpl3-title"),
    ("Mozilla Public License version 2.0", "mpl2-title"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v", "mpl2-notice"),
    ("If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/", "mpl2-copy"),
    ("If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/", "mpl2-copy"),
    ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0", "epl2-notice"),
    ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at http://www.eclipse.org/legal/epl-2.0", "epl2-notice"),
    ("To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide.", "cc0-dedication"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "cc-by-notice"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "cc-by-sa-notice"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "cc-by-nc-notice"),
]
# Licences whose SPDX tags are known.
SPDX = [
    "MIT", "MIT-0", "X11", "ISC", "0BSD", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "Zlib", "BSL-1.0", "Unlicense", "WTFPL", "PostgreSQL", "Apache-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only",
    "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "MPL-2.0", "EPL-2.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0",
]


def normal(sentence: str) -> str:
    """A sentence as the scan sees it: words of a-z and digits, in lower case."""
    return " ".join(re.findall("[a-z0-9]+", sentence.lower()))


KNOWN = SENTENCES | TEXTS | {normal(text): ids for text, ids in PROSE} | {normal(f"SPDX-License-Identifier: {name}"): f"spdx-{name.lower()}" for name in SPDX}
# The name of the holder that this sentence bears is replaced by "the copyright holder".
ENDORSE = r"neither[ ~]the[ ~]name[ ~]of[ ~](?:[a-z0-9]+[ ~]){1,12}?nor[ ~]the[ ~]names[ ~]of[ ~]its[ ~]contributors"
# Rules in the order in which they are tried: licence, identifiers in sequence.
RULES = [(name, [f"spdx-{name.lower()}"]) for name in SPDX] + [
    ("X11", ["mit-grant", "mit-condition", "as-is", "x11-name"]),
    ("MIT", ["mit-grant", "mit-condition", "as-is"]),
    ("MIT-0", ["mit0-grant", "as-is"]),
    ("ISC", ["isc-grant"]),
    ("0BSD", ["0bsd-grant", "author-disclaims"]),
    ("Zlib", ["zlib-as-is", "zlib-grant"]),
    ("BSL-1.0", ["boost-grant"]),
    ("PostgreSQL", ["postgresql-grant"]),
    ("Apache-2.0", ["apache2-notice", "apache2-compliance", "apache2-copy"]),
    ("AGPL-3.0-or-later", ["agpl-grant", "agpl3-or-later"]),
    ("LGPL-3.0-or-later", ["lgpl-grant", "lgpl3-or-later"]),
    ("LGPL-2.1-or-later", ["lgpl-grant", "lgpl21-or-later"]),
    ("GPL-3.0-or-later", ["gpl-grant", "gpl3-or-later"]),
    ("GPL-2.0-or-later", ["gpl-grant", "gpl2-or-later"]),
    ("GPL-2.0-only", ["gpl2-only-grant"]),
    ("GPL-3.0-only", ["gpl3-only-grant"]),
    ("BSD-4-Clause", ["bsd-grant", "bsd-advert", "bsd-endorse"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-endorse"]),
    ("MPL-2.0", ["mpl2-notice"]),
    ("MPL-2.0", ["mpl2-title"]),
    ("EPL-2.0", ["epl2-notice"]),
    ("Unlicense", ["unlicense"]),
    ("WTFPL", ["wtfpl-title"]),
    ("CC0-1.0", ["cc0-dedication"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-notice"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-notice"]),
    ("CC-BY-4.0", ["cc-by-notice"]),
    ("AGPL-3.0-only", ["agpl3-title"]),
    ("LGPL-3.0-only", ["lgpl3-title"]),
    ("GPL-3.0-only", ["gpl3-notice"]),
    ("GPL-2.0-only", ["gpl2-title"]),
    ("BSL-1.0", ["boost-notice"]),
    ("Apache-2.0", ["apache2-notice"]),
    ("MIT", ["mit-notice"]),
    ("MIT", ["mit-grant"]),
    ("BSD-2-Clause", ["bsd-grant"]),
    ("proprietary", ["all-rights"]),
]
MOST_LINES, HEAD = 40, 2  # lines of a known sentence; words of its beginning


def marked(text: Column) -> Column:
    """Words with one sign between them: ``|`` for a cut (full stops, exclamation and question marks before ASCII white space or the end; lines without a letter a-z or digit), ``~`` for a single line feed or semicolon, else a space. A-Z are lower-cased, comment words (``rem``, ``dnl``) at the beginning of lines go, and ``|`` stands at both ends."""
    low = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ;", "abcdefghijklmnopqrstuvwxyz\n")
    cut = F.regexp_replace(F.regexp_replace(low, r"(^|\n)[ \t]*(?:rem|dnl)(?=[ \t\r\n]|$)", "$1"), r"[.!?]+(?:[ \t\r\f]+|\n|$)", "\n\n")
    spaced = F.trim(F.regexp_replace(cut, r"[^a-z0-9\n]+", " "))
    lined = F.regexp_replace(F.regexp_replace(spaced, r" ?\n[ \n]*\n ?", "|"), r" ?\n ?", "~")
    return F.concat(F.lit("|"), F.regexp_replace(lined, ENDORSE, "neither the name of the copyright holder nor the names of its contributors"), F.lit("|"))


def candidate_runs(text: Column, heads: Sequence[str], most_lines: int = MOST_LINES) -> Column:
    """Runs of lines that begin like a known sentence: ``cut`` and ``line`` where each begins, and ``runs``, the texts of the first line, the first two, and so on, up to the next cut."""

    def of_cut(part: Column, cut: Column) -> Column:
        lines = F.split(part, "~")

        def of_line(line: Column, at: Column) -> Column:
            begin = F.substring_index(F.array_join(F.slice(lines, at + 1, HEAD), " "), " ", HEAD)
            return F.struct(cut.alias("cut"), at.alias("line"), begin.isin(*heads).alias("known"), lines.alias("lines"))

        starts = F.filter(F.transform(lines, of_line), lambda s: s["known"])
        runs = lambda s: F.transform(F.sequence(F.lit(1), F.least(F.size(s["lines"]) - s["line"], F.lit(most_lines))), lambda n: F.array_join(F.slice(s["lines"], s["line"] + 1, n), " "))
        return F.transform(starts, lambda s: F.struct(s["cut"].alias("cut"), s["line"].alias("line"), runs(s).alias("runs")))

    return F.flatten(F.transform(F.split(marked(text), r"\|"), of_cut))


def sentence_table(spark: SparkSession, known: Mapping[str, str] = KNOWN) -> DataFrame:
    """``sentence, ids`` of known sentences (normalised) and their identifiers."""
    return spark.createDataFrame(sorted(known.items()), "sentence string, ids string")


def scan(docs: DataFrame, known: DataFrame | None = None, rules: Sequence[tuple[str, Sequence[str]]] = RULES) -> DataFrame:
    """``doc_id, sentence_ids, rule_no, license``, one row for each row of ``docs`` (``doc_id``, ``text``).

    ``sentence_ids``: identifiers of the known sentences (``sentence, ids``; else ``sentence_table``) in the order of the
    text, joined by commas (empty if there are none, as in null and empty texts). From where a sentence begins the longest
    known one counts, and none that begins inside it. Sentences have two words or more and ``MOST_LINES`` lines at most. ``rule_no`` counts from 1; if no
    rule matches it is 0 and ``license`` is null. Null ids and repeated rows stay. Other columns are not read.
    """
    known = sentence_table(docs.sparkSession) if known is None else known
    heads = [r[0] for r in known.select(F.substring_index("sentence", " ", HEAD)).distinct().collect()]  # of the licence list
    rows = docs.select("doc_id", candidate_runs(F.col("text"), heads).alias("found"))
    rows = kept(rows.withColumn("row", F.monotonically_increasing_id()), "licence-candidates")
    tried = rows.select("row", F.explode("found").alias("f")).select("row", "f.cut", "f.line", F.posexplode("f.runs").alias("more", "sentence"))
    hits = tried.join(known, "sentence").groupBy("row", "cut", "line").agg(F.max(F.struct("more", "ids")).alias("b")).select("row", "cut", "line", (F.col("line") + F.col("b.more")).alias("last"), "b.ids")
    before = Window.partitionBy("row", "cut").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    whole = hits.withColumn("covered", F.coalesce(F.max("last").over(before) >= F.col("line"), F.lit(False))).where("NOT covered")
    named = whole.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("cut", "line", "ids"))).alias("s")).select("row", F.array_join(F.transform("s", lambda x: x["ids"]), ",").alias("ids"))
    found = rows.select("row", "doc_id").join(named, "row", "left").select("doc_id", F.coalesce("ids", F.lit("")).alias("sentence_ids"))
    lined = F.concat(F.lit(","), "sentence_ids", F.lit(","))
    first = F.coalesce(*[F.when(lined.contains(f",{','.join(sequence)},"), F.lit(i)) for i, (_, sequence) in enumerate(rules, 1)])
    found = found.withColumn("rule_no", F.when(F.col("sentence_ids") == "", 0).otherwise(F.coalesce(first, F.lit(0))))
    names = F.array(*[F.lit(name) for name, _ in rules])
    return found.withColumn("license", F.when(F.col("rule_no") > 0, F.try_element_at(names, F.col("rule_no"))))
