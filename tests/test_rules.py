"""The matching ladder, overrides, history and gates against brute force and planted cases."""

import hashlib
import math
import random
import re

from pyspark.sql import functions as F

from basketry.functions import names
from basketry.operators import classify, clean, match, quality


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row[:]
        for j, y in enumerate(b, 1):
            row[j] = last[j - 1] + 1 if x == y else max(last[j], row[j - 1])
    return row[-1]


def vector(name):
    out = {}
    for word in set(re.findall(r"[a-z0-9]+", name.lower())):
        bucket = int(hashlib.md5(word.encode()).hexdigest(), 16) % 768
        out[bucket] = out.get(bucket, 0) + 1
    return out


def brute(name, catalog, k):
    v = vector(name)
    near = []
    for item, other in catalog:
        w = vector(other)
        cosine = sum(x * w.get(b, 0) for b, x in v.items()) / math.sqrt(sum(x * x for x in v.values()) * sum(x * x for x in w.values())) if v and w else 0
        if round(cosine, 9) >= 0.4:
            near.append((-round(cosine, 9), item, other))
    best = None
    for cosine, item, other in sorted(near)[:k]:
        a, b = (" ".join(sorted(t.lower().split())) for t in (name, other))
        score = round(max(-cosine, 2 * lcs(a, b) / (len(a) + len(b))), 4)
        best = min(best or (1, 0, ""), (-score, cosine, item))
    return (None, None, "new") if best is None else (best[2], -best[0], "match" if -best[0] >= 0.75 else "new")


def test_arbitration_equals_brute_force(spark):
    rng = random.Random(3)
    words = ["cold", "fresh", "widget", "soap", "rice", "angkor", "milk", "tea", "gadget", "pear", "plum", "salt"]
    catalog = [(f"i{n:03}", " ".join(rng.sample(words, rng.randint(2, 5)))) for n in range(120)]
    asked = [(n, " ".join(rng.sample(words, rng.randint(1, 4))) + rng.choice(["", "x", " extra"])) for n in range(80)] + [(80, None), (81, ""), (82, "unheard of"), (83, catalog[5][1].upper()), (84, catalog[5][1])]
    got = match.arbitrated(spark.createDataFrame(asked, "id int, name string"), spark.createDataFrame([*catalog, ("i999", None)], "item string, name string"), k=7).collect()
    assert len(got) == len(asked)
    for row in got:
        assert (row["item"], row["score"], row["decision"]) == brute(asked[row["id"]][1] or "", catalog, 7), asked[row["id"]]


def test_full_ladder_takes_steps_in_order(spark):
    catalog = spark.createDataFrame([("a", "Fresh Milk Angkor", "A", "1l"), ("b", "Jasmine Rice Gold", "B", "5kg"), ("c", "Zz", "C", None)], "item string, name string, brand string, size string")
    records = spark.createDataFrame([
        (1, "s", "88001234", None, "anything", None, None), (2, "s", None, "k1", "other", None, None), (3, "s", None, None, "Fresh Milk Angkor", "x", "1l"), (4, "s", None, None, "angkor milk fresh", None, "1l"),
        (5, "s", None, None, "jasmine rice golden", "B", None), (6, "s", None, None, " zz", "c", None), (7, "s", None, None, "brand new thing", None, None), (8, "t", None, None, "brand new thing", None, None), (9, "t", None, None, None, None, None),
    ], "raw_id int, store string, barcode string, sku string, name string, brand string, size string")
    barcodes, skus = spark.createDataFrame([("88001234", "a")], "barcode string, item string"), spark.createDataFrame([("s", "k1", "b")], "store string, sku string, item string")
    out = {r.raw_id: (r["item"], r.method) for r in match.full_ladder(records, barcodes, skus, catalog.select("name", "size", "item"), catalog).collect()}
    assert out == {1: ("a", "barcode"), 2: ("b", "sku"), 3: ("a", "name"), 4: ("a", "vector"), 5: ("b", "review"), 6: ("c", "vector"), 7: ("new7", "new"), 8: ("new7", "new_in_batch"), 9: ("new9", "new")}
    empty = match.full_ladder(records.limit(0), barcodes, skus, catalog.select("name", "size", "item"), catalog)
    assert empty.count() == 0


def test_overrides_match_whole_words_by_rank(spark):
    items = spark.createDataFrame([(1, "s", "b1", None, "Cold Tea"), (2, "s", None, "p1", "x"), (3, "t", None, None, "iced cold tea!"), (4, "s", None, None, "COLD, tea"), (5, "s", None, None, "coldtea"), (6, None, None, None, None)], "item int, store string, barcode string, product_key string, name string")
    rules = spark.createDataFrame([("barcode", "b1", None, "01"), ("product_key", "p1", "", "02"), ("name", "cold tea", "s", "03"), ("name", "tea", None, "04"), ("name", "Cold Tea", "", "05"), ("name", " ", None, "06"), ("other", "tea", None, "07")], "kind string, value string, store string, division string")
    out = {r["item"]: (r.override_division, r.override_kind) for r in classify.overrides(items, rules).collect()}
    assert out == {1: ("01", "barcode"), 2: ("02", "product_key"), 3: ("05", "name"), 4: ("03", "name"), 5: (None, None), 6: (None, None)}
    assert classify.overrides(items, rules.limit(0)).where("override_division IS NOT NULL").count() == 0


def test_names_in_two_scripts(spark):
    rows = spark.createDataFrame([("ទឹកដោះគោស្រស់ 1 ltr",), ("SPK org chips 2 pcs",), (None,), ("",)], "n string").select(names.segmented("n"), names.expanded("n"), names.full_name("n")).collect()
    assert tuple(rows[0]) == ("FRESH MILK 1 ltr", "ទឹកដោះគោស្រស់ 1 L", "FRESH MILK 1 L")
    assert rows[1][1] == "SPICY ORGANIC chips 2 PIECE" and tuple(rows[2]) == tuple(rows[3]) == ("", "", "")
    pair = spark.createDataFrame([("tv 43 inch 20W", "tv 55 inch"), ("tv 43 inch", "tv 43\" 20W"), (None, "x")], "a string, b string")
    assert [r[0] for r in pair.select(names.disjoint_specs("a", "b")).collect()] == [True, False, False]


def test_history_and_gates(spark):
    rows = spark.createDataFrame([(1, 1, None), (1, 2, None), (1, 3, "a"), (1, 3, "b"), (1, 5, "b"), (2, 1, "z")], "k int, at int, v string")
    out = sorted(tuple(r) for r in clean.history(rows, ["k"], "at", ["v"]).select("k", "valid_from", "valid_to", "is_current", "v").collect())
    assert out == [(1, 1, 3, False, None), (1, 3, None, True, "b"), (2, 1, None, True, "z")]
    assert clean.since(rows.limit(0).withColumn("d", F.current_date()), "d").count() == 0
    failed = {r.rule: r.failures for r in quality.checked(rows, {"v known": F.col("v").isin("a", "b")}, ["k", "at"]).collect()}
    assert failed == {"v known": 3, "unique": 1}
