"""The review queue, merges, names with references and synonyms, and overrides by pattern."""

import html

from pyspark.sql import functions as F

from basketry.functions import names, text
from basketry.operators import classify, match


def test_reviews_are_settled_in_groups(spark):
    form = "review int, raw_id int, raw_name string, item string, item_name string, barcode string, brand string, size string"
    queue = spark.createDataFrame([
        (1, 10, "Galaxy S24 256GB", "a", "galaxy  s24 256gb ", None, "S", None),  # equal when cleaned
        (2, 20, "Galaxy S24 128GB", "a", "Galaxy S24 256GB", "", "S", None),  # another storage: a new item
        (3, 30, "Galaxy S24 128GB", "a", "Galaxy S24 256GB", None, "S", None),  # the same pair
        (4, 40, "Galaxy S24 128GB", "a", "Galaxy S24 256GB", "8801", "S", None),  # its barcode is known
        (5, 50, "Galaxy S24 128GB", "a", "Galaxy S24 256GB", "8802", "S", None),  # an unknown barcode: an item of its own
        (6, 60, "Red tea", "b", "Red tea tin", None, None, "1kg"),  # no reason either way
        (7, 70, "Known tea", "b", "Tea", None, None, "1KG "),  # the catalogue has name and size
        (8, 80, "Known tea", "b", "Tea", None, "x", "2kg"),
        (9, 90, None, "b", None, None, None, None),
    ], form)
    items = spark.createDataFrame([("i1", "x", " 8801 ", None), ("i2", "Known  Tea", None, "1kg"), ("i3", None, "", None)], "item string, name string, barcode string, size string")
    got = {r.review: (r.raw_id, r.decision, r["item"], r.method, r.confidence) for r in match.reviewed(queue, items).collect()}
    assert got == {1: (10, "approve", "a", "rule_guard", 1.0), 2: (20, "split", "new2", "new", 1.0), 3: (30, "split", "new2", "new", 1.0), 4: (40, "split", "i1", "barcode", 1.0), 5: (50, "split", "new5", "new", 1.0),
                   6: (60, "split", "new6", "new", 0.85), 7: (70, "split", "i2", "name", 0.85), 8: (80, "split", "new8", "new", 0.85), 9: (90, "approve", "b", "rule_guard", 1.0)}
    assert match.reviewed(queue.limit(0), items).count() == 0


def test_merges_follow_chains(spark):
    merges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "c"), ("d", "gone"), ("e", "e")], "item string, master string")
    assert {tuple(r) for r in match.final_masters(merges).collect()} >= {("a", "c"), ("b", "c"), ("c", "c"), ("d", "gone"), ("e", "e")}
    rows = spark.createDataFrame([("a", 1), ("c", 2), ("x", 3), (None, 4), ("d", 5)], "item string, n int")
    assert {tuple(r) for r in match.repointed(rows, merges).collect()} == {("c", 1), ("c", 2), ("x", 3), (None, 4), ("gone", 5)}
    assert {r["item"] for r in match.merged(merges.select("item"), merges).collect()} == {"c", "e"}


def test_character_references(spark):
    texts = ["Caf&eacute; &amp; Th&#233;", "&#x1F375; tea &#8364;", "&unknown; &", "&#xD800;&#0;", "a &lt;b&gt; &quot;c&quot; &#39;d&#39;", "&eacute", "&amp;eacute;", "none", "", "&uuml;&Uuml;&uuml;"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(text.unescaped(F.col("t"))).collect()]
    assert [g for t, g in zip(texts, got, strict=True) if t not in ("&#xD800;&#0;", "&eacute", "&amp;eacute;")] == [html.unescape(t) for t in texts if t not in ("&#xD800;&#0;", "&eacute", "&amp;eacute;")]
    assert got[3] == "&#xD800;&#0;" and got[5] == "&eacute"


def test_khmer_words_have_english_ones_too(spark):
    rows = spark.createDataFrame([("ទឹកដោះគោ Coke 1L",), ("Coke",), (None,)], "n string").select(names.name_words("n").alias("w")).collect()
    assert {"milk", "water", "coca", "cola", "1l", "ទឹកដោះគោ"} <= set(rows[0].w) and rows[1].w == ["coca", "cola"] and rows[2].w == []


def test_golden_specifications(spark):
    cases = {
        "Samsung Galaxy S24 Ultra 256GB 5G": {"storage": ["256GB", "5G"], "series": ["ULTRA"], "is_5g": ["5G"]},
        "UA55DU8100KXXT SAMSUNG 55 inch 4K TV": {"screen": ["55"], "model_code": ["UA55DU8100KXXT"]},
        "MX-ST90B/XT SAMSUNG Sound Tower": {"model_code": ["ST90B/XT"]},
        "AR18DYHZBWKNST SAMSUNG Inverter Air Conditioner 18,000 BTU": {"btu": ["18000"], "model_code": ["AR18DYHZBWKNST"]},
        "iPhone 15 Pro Max 1 TB, 48 MP": {"storage": ["1TB"], "series": ["PRO MAX"], "camera": ["48"]},
        "Anker power bank 20000 mAh 65W 2 pcs": {"mah": ["20000MAH"], "wattage": ["65W"], "pcs": ["2PCS"]},
        'TV TH-43LX650 43" LED': {"screen": ["43"]},
        "Rice 5kg": {}, "": {}, "note10 promax": {"series": ["PROMAX"]}, "12345 W 5 W 900 BTU": {},
    }
    rows = spark.createDataFrame([(n,) for n in cases], "n string").select("n", names.spec_sets("n").alias("s")).collect()
    for r in rows:
        assert {k: v for k, v in r.s.asDict().items() if v} == cases[r.n], r.n
    apart = [("Galaxy S24 128GB", "Galaxy S24 256GB"), ("MX-ST90B/XT Tower", "MX-ST40B/XT Tower"), ("AR18DYHZBWKNST", "AR24DYHZBWKNST"), ("UA43DU8100KXXT 43 inch", "UA55DU8100KXXT 55 inch"), ("Galaxy S24 256GB Black", "Galaxy S24 256GB Gray")]
    assert [r[0] for r in spark.createDataFrame(apart, "a string, b string").select(names.disjoint_specs("a", "b")).collect()] == [True, True, True, True, False]


def test_overrides_by_pattern(spark):
    items = spark.createDataFrame([(1, "s", "Cold brew coffee"), (2, "t", "cold brew coffee"), (3, "t", "iced tea"), (4, None, "teapot"), (5, "s", None)], "item int, store string, name string")
    rules = spark.createDataFrame([("cold (brew|press)", None, "01"), ("Coffee", "s", "02"), ("tea", "", "03"), ("t.a", None, "04"), (" ", None, "05"), ("iced", "s", "06")], "value string, store string, division string")
    assert {r["item"]: r.override_division for r in classify.pattern_overrides(items, rules).collect()} == {1: "02", 2: "01", 3: "04", 4: None, 5: None}
