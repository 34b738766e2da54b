"""The filter audit, the token alignment and the sharding against brute force on small tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from basketry.llm import sharding, token_alignment
from basketry.llm.filter_audit import filter_audit
from basketry.llm.queries import op12_token_alignment
from basketry.llm.sharding import grid, numbered, placed, sharded
from basketry.llm.token_alignment import Aligned, Memory, alignments, link_counts, pieces

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [
    None, "", " ", "a", "a b", "  two  spaces ", "tabs\t and\n\n lines \n", "▁ is a piece", "nbsp   here", "<|endoftext|> <s> </s> <0x41>", "日本語 のテキスト 🙂 naïve café", "a\x00b c", "ÉCOLE d'été: it's don't I'LL",
    "x" * 3000, "  \u0085 x 　 y ᠎ z \x1c w", "ﬁ ligature Å ① ½", "one two three " * 400,
]


@pytest.fixture(scope="session")
def docs(spark):
    rng = random.Random(5)
    texts = TEXTS + [" ".join(rng.choice(["The", "cat", "IS", "on", "#1", "mat,", "naïve", "12345", "été"]) + rng.choice(["", "", "s", "\n"]) for _ in range(rng.randint(1, 300))) for _ in range(30)]
    texts += [texts[20], texts[20], texts[25], "one two three " * 400]
    rows = [(i // 2 if i == 41 else i, t, [None, "", "en", "de"][i % 4], "clash", 1) for i, t in enumerate(texts)] + [(None, texts[20], "en", "clash", 1), (None, None, "xx", "clash", 2), (3, "a", "de", "clash", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n string, number int").repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


def test_filter_audit(spark, docs, none):
    labels = spark.createDataFrame([(i, int(i % 3 == 0), int(i % 5 == 0), "clash") for i in range(0, 50, 2)] + [(4, 1, None, "x"), (4, None, None, "x"), (None, 1, 1, "x")], "doc_id long, quality int, toxic int, part string")
    rows, said = docs.collect(), collections.defaultdict(lambda: [False, False])
    for x in labels.collect():
        if x.doc_id is not None:
            said[x.doc_id] = [said[x.doc_id][0] or x.quality == 1, said[x.doc_id][1] or x.toxic == 1]
    every = []
    for r in rows:
        text = r.text or ""
        words = WORD.findall(text)
        fails = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
            "E": r.doc_id is not None and any((o.text or "") == text and o.doc_id is not None and o.doc_id < r.doc_id for o in rows)}
        every.append((r.lang or "", {f for f in fails if fails[f]}, *said.get(r.doc_id, (False, False))))
    assert {f for _, fails, *_ in every for f in fails} == set("ABCDE")
    want, total = {}, collections.Counter()
    for part, order in itertools.product({x[0] for x in every}, map("".join, itertools.permutations("ABCDE"))):
        for step, f in enumerate(order, 1):
            c = [0] * 6
            for p, fails, good, toxic in every:
                if p == part:
                    here = not fails & set(order[: step - 1])
                    c = [a + b for a, b in zip(c, [here and f not in fails, here and f in fails, not here and f in fails, fails == {f}, here and f in fails and good, here and f in fails and toxic], strict=True)]
            want[part, order, step] = c
            total[part, f] += c[1]
    got = filter_audit(docs, labels).collect()
    assert len(got) == len(want) == 600 * 4
    assert {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost] for r in got} == want
    assert all(r.shapley == total[r.part, r.filter_order[r.step - 1]] for r in got)
    assert filter_audit(none, labels).count() == 0 and filter_audit(docs, labels.limit(0)).count() == 2400


def aligned_by_bytes(text):
    """Encodes the whole text at once and compares byte ranges pair by pair."""
    a, b, a_bytes, b_bytes, *_ = token_alignment._vocabularies(token_alignment.FOLDER)
    said = b" " + (text or "").encode()
    ids = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
    tokens = [a_bytes[i] for i in ids[0]], [b_bytes[i] for i in ids[1]]
    if not text or b"".join(tokens[0]) != said or b"".join(tokens[1]) != said:
        return 0, 0, 0, "", collections.Counter()
    spans = []
    for own in tokens:
        ends = list(itertools.accumulate(map(len, own)))
        spans.append([(e - len(t), e) for e, t in zip(ends, own, strict=True)])
    links, first = [], 0
    for i, (s, e) in enumerate(spans[0]):
        while spans[1][first][1] <= s:
            first += 1
        for k in range(first, len(spans[1])):
            if spans[1][k][0] >= e:
                break
            links.append((ids[0][i], ids[1][k]))
    cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
    groups, begin = [], 0
    for cut in cuts:
        groups.append("|".join(",".join(str(i) for i, (_, e) in zip(own, at, strict=True) if begin < e <= cut) for own, at in zip(ids, spans, strict=True)))
        begin = cut
    return len(ids[0]), len(ids[1]), len(groups), ";".join(groups), collections.Counter(links)


def test_alignments(docs, none):
    want = collections.Counter((r.doc_id, *aligned_by_bytes(r.text)[:4]) for r in docs.collect())
    got = alignments(docs).collect()
    assert collections.Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.groups) for r in got) == want
    assert all(sum(r.times) == r.n_links and len(set(r.pairs)) == len(r.pairs) for r in got)
    assert alignments(none).count() == 0 and link_counts(alignments(none)).count() == 0


@pytest.mark.parametrize("most_pairs", [0, 40, 1 << 20])
def test_link_counts(docs, most_pairs):
    every = [(r.doc_id, aligned_by_bytes(r.text)) for r in docs.collect()]
    held = collections.Counter(pair for _, x in every for pair in x[4])
    best = collections.defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    want = collections.Counter((i, sum(x[4].values()), sum(n for p, n in x[4].items() if held[p] == best[p[0]]), sum(n * held[p] for p, n in x[4].items())) for i, x in every)
    got = link_counts(alignments(docs).drop("groups"), most_pairs)
    assert collections.Counter((r.doc_id, r.n_links, r.n_best, r.count_sum) for r in got.collect()) == want


def test_digest_of_groups(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = collections.Counter((r.doc_id, hashlib.sha256(g.encode()).hexdigest() if (g := aligned_by_bytes(r.text)[3]) else "") for r in docs.collect())
    assert collections.Counter((r.doc_id, r.groups_sha256) for r in op12_token_alignment(spark, str(tmp_path)).collect()) == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\tabcABC'sé▁日,.  ᠎\x1c0"), st.characters(exclude_categories=["Cs"])), max_size=40), min_size=1, max_size=3))
def test_pieces_are_encoded_alike(texts):
    memory = Memory(token_alignment.FOLDER)
    rows = list(zip(*token_alignment._rows(texts, memory), strict=True))
    for text, row in zip(texts, rows, strict=True):
        n_a, n_b, n_groups, groups, links = aligned_by_bytes(text)
        assert (row[0], row[1], row[2], row[4]) == (n_a, n_b, n_groups, groups) and row[3] == sum(links.values())


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(token_alignment, "MOST_PIECES", 5)
    memory, texts = Memory(token_alignment.FOLDER), [f"word{i} and word{i % 3}" for i in range(40)]
    for text in texts:
        assert token_alignment._rows([text], memory)[4] == [aligned_by_bytes(text)[3]]
        assert len(memory.number) <= 8
    assert pieces("a b  c d\n e") == ["a", "b  c", "d\n e"] and Aligned(["", "x"], token_alignment.FOLDER).n_a.tolist() == [0, 1]


def test_sharding(docs, none):
    rows, got = docs.collect(), sharded(docs, shards=7).collect()
    size = lambda t: len((t or "").encode()) + 8
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == collections.Counter((r.doc_id, size(r.text), zlib.crc32((r.text or "").encode())) for r in rows)
    assert sorted(r.number for r in got) == sorted(r.place for r in got) == list(range(len(rows)))
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(7)) and all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    order = sorted(got, key=lambda r: r.number)
    key = [(r.doc_id is not None, r.doc_id or 0, r.size, r.text_crc32) for r in order]
    assert key == sorted(key) and [r.place for r in order] != list(range(len(rows)))
    again = sharded(docs.repartition(5), shards=7).collect()  # dealt otherwise: the same shards
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert sharded(none).count() == 0 and numbered(none)[1] == 0


@pytest.mark.parametrize("rows", [1, 2, 3, 7, 24, 1009, 4099])
def test_walks_end_inside_and_meet_no_one(spark, rows, monkeypatch):
    height, width = grid(rows)
    assert rows <= height * width < rows + height
    monkeypatch.setattr(sharding, "grid", lambda n: (n, 2) if n > 2 else (2, 3))  # a grid with as many cells beyond the rows: long walks
    got = placed(spark.range(rows).withColumnRenamed("id", "number"), rows, seed=3).collect()
    assert sorted(r.place for r in got) == list(range(rows))
    if rows > 1000:
        assert sum(abs(a.place - b.place) < rows / 20 for a, b in itertools.pairwise(sorted(got))) < rows / 6  # neighbours part
