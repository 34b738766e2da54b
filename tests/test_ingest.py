"""Increments, cold storage, landing files, rules and trees against brute force and planted faults."""

import datetime
import hashlib
import json
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from basketry.operators import joins, rules, tree
from basketry.sources import increments, records, storage

D = datetime.date


def put(spark, root, rows):
    batch = spark.createDataFrame(rows, "key int, month string, value int, at int")
    return increments.replaced(spark, root, batch, ["key"], "month", [F.desc("at")]), batch


def rows_at(spark, root, like):
    return sorted(tuple(r) for r in increments.table_at(spark, root, like).select("key", "month", "value", "at").collect())


def test_batches_equal_a_rebuild(spark, tmp_path):
    rng = random.Random(5)
    root, state = f"{tmp_path}/table", {}
    for n in range(4):
        rows = [(rng.randint(0, 40), rng.choice(["2024-01", "2024-02", "2024-03", "2024-04"]), rng.randint(0, 99), i) for i in range(rng.randint(5, 25))]
        for run in range(2):  # the second run of a batch changes nothing
            touched, like = put(spark, root, rows)
            best = {}
            for r in rows:
                best[r[0]] = max(best.get(r[0], r), r, key=lambda x: x[3])
            state |= best
            assert rows_at(spark, root, like) == sorted(state.values())
        assert touched <= 4


def test_a_partition_that_loses_all_its_rows(spark, tmp_path):
    root = f"{tmp_path}/table"
    put(spark, root, [(1, "2024-01", 5, 1), (2, "2024-02", 6, 1), (3, None, 7, 1)])
    before = {f for f in os.listdir(f"{root}/month=2024-02") if f.endswith(".parquet")}
    _, like = put(spark, root, [(1, "2024-03", 8, 2)])
    assert not os.path.exists(f"{root}/month=2024-01")
    assert sorted(map(str, rows_at_any(spark, root, like))) == sorted(map(str, [(1, "2024-03", 8, 2), (2, "2024-02", 6, 1), (3, None, 7, 1)]))
    assert {f for f in os.listdir(f"{root}/month=2024-02") if f.endswith(".parquet")} == before  # other partitions are not written
    assert put(spark, root, [(None, "2024-03", 8, 2)])[0] == 0 and put(spark, root, [])[0] == 0
    put(spark, root, [(3, "2024-05", 1, 9)])  # a null partition is emptied too
    assert (3, "2024-05", 1, 9) in rows_at_any(spark, root, like) and len(rows_at_any(spark, root, like)) == 3


def rows_at_any(spark, root, like):
    return [tuple(r) for r in increments.table_at(spark, root, like).select("key", "month", "value", "at").collect()]


def test_a_broken_run_can_be_repeated(spark, tmp_path, monkeypatch):
    root = f"{tmp_path}/table"
    put(spark, root, [(1, "2024-01", 5, 1), (2, "2024-02", 6, 1)])
    monkeypatch.setattr(increments, "_emptied", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        put(spark, root, [(1, "2024-03", 8, 2)])
    monkeypatch.undo()
    _, like = put(spark, root, [(1, "2024-03", 8, 2)])
    assert rows_at(spark, root, like) == [(1, "2024-03", 8, 2), (2, "2024-02", 6, 1)]


def test_seed_rows_in_order(spark, tmp_path):
    seed = spark.createDataFrame([(D(2024, 3, 1), 1.0, "a", None), (D(2024, 1, 1), 2.0, "b", 7.0), (None, 3.0, "c", None)], "month date, headline double, note string, core double")
    news = spark.createDataFrame([(D(2024, 2, 1), 1.23456789, "new", None), (D(2024, 1, 1), 9.0, None, None), (D(2024, 1, 1), 8.0, None, 1.0), (None, 1.0, "x", 1.0)], "month date, headline double, note string, core double")
    out = increments.upserted_seed(seed, news, "month")
    want = [(D(2024, 1, 1), 9.0, "b", 7.0), (D(2024, 2, 1), 1.2346, "new", None), (D(2024, 3, 1), 1.0, "a", None)]
    assert [tuple(r) for r in out.collect()] == want
    increments.write_seed(out, f"{tmp_path}/seed")
    again = storage.seed(spark, f"{tmp_path}/seed", "month date, headline double, note string, core double")
    assert [tuple(r) for r in again.collect()] == want
    increments.write_seed(increments.upserted_seed(again.limit(0), news.limit(0), "month"), f"{tmp_path}/none")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        storage.seed(spark, f"{tmp_path}/seed", "month date, headline double, note double, core double").collect()


def test_exports_are_verified(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(D(2024, 1 + i % 3, 1 + i % 28), i, f"n{i}" if i % 5 else None) for i in range(300)] + [(D(2024, 1, 1), 1, "twice")] * 2, "day date, item int, name string")
    report = {(r.year, r.month): (r.n, r.stored, r.ok) for r in storage.exported(rows, "day", f"{tmp_path}/cold").collect()}
    assert report == {(2024, 1): (102, 102, True), (2024, 2): (100, 100, True), (2024, 3): (100, 100, True)}
    whole = storage.offload
    monkeypatch.setattr(storage, "offload", lambda r, d, root: whole(r.where("item <> 31").withColumn("name", F.when(F.col("item") == 7, "changed").otherwise(F.col("name"))), d, root))
    report = {r.month: (r.n, r.stored, r.ok) for r in storage.exported(rows, "day", f"{tmp_path}/other").collect()}
    assert report == {1: (102, 102, True), 2: (100, 98 + 1, False), 3: (100, 100, True)}  # items 7 and 31 stand in month 2


def test_files_against_the_catalogue(spark, tmp_path):
    rows = spark.range(2000).withColumn("part", F.col("id") % 4)
    rows.write.partitionBy("part").parquet(f"{tmp_path}/files 5% here")
    catalog = spark.createDataFrame(storage.catalog_of(spark, f"{tmp_path}/files 5% here").collect())
    paths = [os.path.join(d, f) for d, _, files in os.walk(f"{tmp_path}/files 5% here") for f in files if f.endswith(".parquet")]
    assert {(os.path.basename(r.path), r.length, r.sha256) for r in catalog.collect()} == {(os.path.basename(p), os.path.getsize(p), hashlib.sha256(open(p, "rb").read()).hexdigest()) for p in paths}
    with open(paths[0], "r+b") as f:
        f.seek(10)
        f.write(b"!")
    os.remove(paths[1])
    bad = {os.path.basename(r.path) for r in storage.verified(spark, f"{tmp_path}/files 5% here", catalog).where("NOT ok").collect()}
    assert bad == {os.path.basename(p) for p in paths[:2]}


def test_landing_files_with_broken_lines(spark, tmp_path):
    good = {"item": "i1", "name": "Tea", "store": "s", "price": 2, "currency": "USD"}
    lines = {
        "2024-01-01": [json.dumps(good), "", '{"item": "i2", "price"', json.dumps({**good, "item": ""}), json.dumps({**good, "price": "2"}), json.dumps({**good, "price": 0}), "[]", json.dumps({**good, "price": True})],
        "2024-01-02": [json.dumps({**good, "item": 7, "name": "x" * 2_000_000, "extra": {"a": 1}}), "\xff", json.dumps({"item": "only", "price": 1e-3})],
    }
    for day, rows in lines.items():
        os.makedirs(f"{tmp_path}/in/day={day}/store=a")
        with open(f"{tmp_path}/in/day={day}/store=a/part.json", "w", encoding="latin-1") as f:
            f.write("\n".join(rows))
    os.makedirs(f"{tmp_path}/in/day=2024-01-03")
    open(f"{tmp_path}/in/day=2024-01-03/_SUCCESS", "w").close()
    found = records.landed(spark, f"{tmp_path}/in")
    assert sorted((r.day, r.item, len(r.name or ""), r.price) for r in records.records(found).collect()) == sorted([(D(2024, 1, 1), "i1", 3, 2.0), (D(2024, 1, 2), "7", 2_000_000, 1.0 * 2), (D(2024, 1, 2), "only", 0, 0.001)])
    faults = sorted((r.day.day, r.line, r.fault) for r in records.quarantine(found).collect())
    assert faults == [(1, 3, "no JSON"), (1, 4, "no item"), (1, 5, "no price"), (1, 6, "no price"), (1, 7, "no record"), (1, 8, "no price"), (2, 2, "no JSON")]
    os.makedirs(f"{tmp_path}/none")
    assert records.landed(spark, f"{tmp_path}/none").count() == 0


def test_filters_on_the_day_reach_the_listing(spark, tmp_path):
    for i in range(1, 6):
        os.makedirs(f"{tmp_path}/in/day=2024-01-0{i}")
        with open(f"{tmp_path}/in/day=2024-01-0{i}/a.json", "w") as f:
            f.write('{"item": "i", "price": 1}')
    os.chmod(f"{tmp_path}/in/day=2024-01-01/a.json", 0)
    found = records.landed(spark, f"{tmp_path}/in").where("day > DATE '2024-01-02' AND day <= DATE '2024-01-04' AND item = 'i'")
    assert found.rdd.getNumPartitions() == 2 and found.count() == 2
    reader = records.LandingReader(f"{tmp_path}/in")
    left = list(reader.pushFilters([records.EqualTo(("day",), D(2024, 1, 3)), records.EqualTo(("item",), "i")]))
    assert [f.attribute for f in left] == [("item",)] and [p.day for p in reader.partitions()] == ["2024-01-03"]


def test_required_literals_are_sound():
    rng = random.Random(4)
    atoms = ["ab", "c", "[xy]", "d?", "(?:ef|gh)", "(i|j)k", "l+", "m{2}", r"\b", r"\s", ".", "n*", "(?=o)", "pq"]
    checked = 0
    for _ in range(3000):
        pattern = "".join(rng.choice(atoms) for _ in range(rng.randint(1, 5)))
        needed = rules.literals(pattern)
        for _ in range(30):
            text = "".join(rng.choice("abcdefghijklmnopqxy ABEF") for _ in range(rng.randint(0, 14)))
            if needed and re.search(pattern, text, re.IGNORECASE):
                checked += 1
                assert any(w in text.lower() for w in needed), (pattern, text, needed)
    assert checked > 100
    assert rules.literals(r"a|bcd") is None and rules.literals(r"[[a]b]cd") is None and rules.literals("(") is None


def test_many_rules_equal_each_rule_alone(spark, monkeypatch):
    rng = random.Random(9)
    words = ["rice", "milk", "tea", "coke", "fish", "salt", "oil", "egg", "ESPRESSO", "naïve"]
    texts = [(i, " ".join(rng.choices(words, k=rng.randint(0, 8)))) for i in range(120)] + [(500, None), (501, ""), (502, "x" * 50_000 + " rice")]
    table = [(i, rf"\b{rng.choice(words)}\s+{rng.choice(words)}\b", rng.choice([None, rng.choice(words)]), rng.randint(0, 9), f"L{i}") for i in range(60)]
    table += [(60, "[aeiou]{3}", None, 5, "vowels"), (61, "tea|milk", "rice", 3, "drink"), (62, None, None, 0, "none"), (63, r"^\s*$", None, 1, "blank")]
    items = spark.createDataFrame(texts, "id int, name string")
    frame = spark.createDataFrame(table, "rule int, pattern string, negative_pattern string, priority int, label string")
    want = {(i, r[0]) for i, t in texts if t is not None for r in table if r[1] and re.search(r[1], t, re.I | re.A) and not (r[2] and re.search(r[2], t, re.I | re.A))}
    assert {(r.id, r.rule) for r in rules.rule_hits(items, frame, "id", "name").collect()} == want and len(want) > 100
    monkeypatch.setattr(rules, "MOST_RULES", 7)  # several passes
    assert {(r.id, r.rule) for r in rules.rule_hits(items, frame, "id", "name").collect()} == want
    first = {r.id: r.label for r in joins.rule_join(items, frame, "id", "name").collect()}
    of = {r[0]: r for r in table}
    assert first == {i: min(((of[n][3], of[n][4]) for j, n in want if j == i), default=(0, None))[1] for i, _ in texts}
    plan = rules.rule_hits(items, frame, "id", "name")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert rules.rule_hits(items, frame.limit(0), "id", "name").count() == 0


def test_paths_of_uneven_trees_and_their_faults(spark):
    form = "code string, parent string"
    nodes = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("d", "a"), ("z", None), ("b", "a")], form)
    assert {(r.code, r.root, r.depth) for r in tree.paths(nodes).collect()} == {("a", "a", 0), ("b", "a", 1), ("c", "a", 2), ("d", "a", 1), ("z", "z", 0)}
    assert {tuple(r) for r in tree.leaves_below(nodes).collect()} == {("a", "c"), ("a", "d"), ("b", "c"), ("c", "c"), ("d", "d"), ("z", "z")}
    assert tree.path_faults(nodes).count() == 0
    bad = spark.createDataFrame([("a", None), ("x", "y"), ("y", "w"), ("w", "x"), ("u", "y"), ("v", "u"), ("s", "s"), ("l", "gone"), ("m", "l"), ("t", "a"), ("t", "x")], form)
    assert {tuple(r) for r in tree.path_faults(bad).collect()} == {("x", "cycle"), ("y", "cycle"), ("w", "cycle"), ("u", "below a cycle"), ("v", "below a cycle"), ("s", "cycle"), ("l", "lost"), ("m", "lost"), ("t", "several parents")}
    leaves = spark.createDataFrame([(1, "c", 110.0, 2.0), (1, "d", 100.0, 1.0), (2, "c", None, 2.0), (2, "d", 120.0, 1.0), (1, "nowhere", 1.0, 1.0)], "p int, code string, index double, weight double")
    got = {(r.p, r.code): (r["index"], r.weight) for r in tree.roll_up_tree(leaves, nodes, "p").collect()}
    assert got[1, "b"] == (110.0, 2.0) and got[1, "a"] == pytest.approx((320 / 3, 3.0)) and got[2, "b"] == (None, 2.0) and got[2, "a"] == (120.0, 3.0) and len(got) == 8
    with pytest.raises(ValueError, match="not a tree"):
        tree.roll_up_tree(leaves, bad, "p")
    assert tree.roll_up_tree(leaves, nodes.limit(0), "p").count() == 0


def test_sheets_find_their_month_and_rows(spark):
    sheets = {
        "plain": {(0, 0): "Index numbers", (4, 5): "Jun 2024", (6, 0): "0", (6, 5): "1,219.10456", (6, 6): "0.3", (6, 7): "2.5", (7, 0): "01", (7, 5): "220.5", (8, 0): "2.0", (8, 5): "n.a.", (9, 0): "12", (9, 5): "99", (10, 0): "13", (10, 5): "7"},
        "dated": {(3, 2): "2024-05-15 00:00:00", (3, 3): "2024-06-15", (11, 3): "May 2020", (6, 0): " 00 ", (6, 2): "1", (6, 3): "2", (7, 0): "x1", (7, 3): "5"},
        "no month": {(6, 0): "00", (6, 5): "1"}, "no headline": {(4, 5): "Jun 2024", (7, 0): "01", (7, 5): "3"}, "bad date": {(4, 5): "2024-13-01", (6, 0): "00", (6, 5): "1"},
    }
    cells = spark.createDataFrame([(s, r, c, v) for s, x in sheets.items() for (r, c), v in x.items()] + [("plain", 30, 2, None)], "sheet string, row int, col int, value string")
    got = {r.sheet: (r.month, r.headline, r.mom, r.yoy, r.divisions) for r in storage.official_sheets(cells).collect()}
    assert got == {"plain": (D(2024, 6, 1), 1219.1046, 0.3, 2.5, {"01": 220.5, "12": 99.0}), "dated": (D(2024, 6, 1), 2.0, None, None, None)}
