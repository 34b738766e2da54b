"""Golden values of text functions."""

from pyspark.sql import functions as F

from basketry.functions import text
from basketry.operators import match, vectors


def one(spark, make, *values):
    df = spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(make(*[F.col(f"c{i}") for i in range(len(values))]).alias("x")).first().x


def test_names(spark):
    assert one(spark, text.clean_name, "Rice 5kg 4,000KHR") == "RICE 5KG"
    assert one(spark, text.clean_name, " Tea &amp; Milk  promo ") == "TEA & MILK"
    assert one(spark, text.clean_name, None) == ""


def test_sizes(spark):
    for size, packs, value, unit in (("2 x 500ml", 2, 500, "ml"), ("1.5 kg", 1, 1.5, "kg"), ("500ml x 2", 2, 500, "ml"), ("none", 1, None, "")):
        assert one(spark, lambda a: F.struct(text.pack_quantity(a, F.lit("")), text.size_value(a, F.lit("")), text.size_unit(a, F.lit(""))), size) == (packs, value, unit)
    assert one(spark, text.sizes_agree, "500g", "540g") and not one(spark, text.sizes_agree, "500g", "600g") and one(spark, text.sizes_agree, None, "500g") and one(spark, text.sizes_agree, "1kg", "1000 g")
    assert not one(spark, text.sizes_agree, "M", "L")


def test_specs(spark):
    assert not one(spark, text.specs_agree, "Phone X 128GB", "Phone X 256GB") and one(spark, text.specs_agree, "Cola 330ml", "Cola 330 ml")
    assert not one(spark, text.specs_agree, "Cola Zero 330ml", "Cola 330ml")
    assert one(spark, text.hedonic_specs, "Phone 8GB 256GB 6.5 inch 50MP 5G").asDict() == {"memory": 8, "storage": 256, "screen": 6.5, "camera": 50, "is_5g": 1}


def test_barcodes(spark):
    good = {"8801234567": True, "11111111": False, "123": False, "123456789012": False, "123400000000": False, "12a4": False, None: False}
    assert all(one(spark, text.valid_barcode, code) == ok for code, ok in good.items())


def test_buckets_are_md5(spark):
    import hashlib

    words = ["coca", "cola", "ទឹក"]
    assert one(spark, lambda c: text.hash_buckets(F.split(c, " ")), " ".join(words)) == [int(hashlib.md5(w.encode()).hexdigest(), 16) % 768 for w in words]


def test_scores():
    assert match.token_sort_score("milk fresh", "Fresh Milk") == 1.0 and match.token_sort_score(None, "x") == 0.0
    assert match.token_sort_score("abcd", "abxd") == 0.75


def test_nearest(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [0.0, 1.0]), (4, None)], "id long, vector array<double>")
    got = [(r.query, r.neighbour, r["rank"]) for r in vectors.nearest_vectors(rows.where("id = 1"), rows, 2).collect()]
    assert sorted(got) == [(1, 2, 1), (1, 3, 2)]
    assert vectors.nearest_vectors(rows.where("id > 9"), rows, 2).count() == 0


def test_queries_are_registered_with_sql():
    import __spark_entry__ as entry

    names, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(names) and len(names) > 80


def test_sizes_are_read_alike_once_and_by_expression(spark):
    import random

    rng = random.Random(3)
    bits = ["2 x 500ml", "500 ml x 2", "330ml", "5kg", "x", "12 pcs", "6 X 1.5 l", "case", "beer", "ctn cola", "", "0.5", "1,5 l", "3*200 G", "24 can", "a12", "2 tin x"]
    rows = [(i, rng.choice([None, " ".join(rng.choices(bits, k=rng.randint(0, 3)))]), rng.choice([None, " ".join(rng.choices(bits, k=rng.randint(0, 4)))]), "clash") for i in range(400)]
    frame = spark.createDataFrame(rows, "id int, a string, b string, size_unit string")
    one = text.with_sizes(frame, "a", "b").select("id", "pack_qty", "size_value", "size_unit").orderBy("id").collect()
    other = frame.select("id", text.pack_quantity("a", "b"), text.size_value("a", "b"), text.size_unit("a", "b")).orderBy("id").collect()
    assert list(map(tuple, one)) == list(map(tuple, other)) and len({r.size_unit for r in one}) > 5
