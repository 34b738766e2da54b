"""Queries of names, overrides, history, gates, cold months and cards, each with DuckDB SQL that says the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions import names, text
from basketry.operators import classify, clean, index, match, nowcast, quality, tree, views
from basketry.plans.index_queries import CHAIN, q_headline
from basketry.plans.silver_queries import QUERIES as SILVER
from basketry.plans.silver_queries import q_ladder as q_classes
from basketry.plans.view_queries import OFFICIAL, _official
from basketry.sources import storage
from basketry.sources.scratch import folder, written
from basketry.sources.tables import observations, table


def _part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part")


def _dealt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` for work on each row that costs more than a shuffle: dealt to all tasks, as its file is small and a few tasks would read it."""
    return _part(spark, sf_dir).repartition("p_partkey")


def code12(c: str) -> Column:
    return F.lpad((F.col(c) % 12 + 1).cast("string"), 2, "0")


CODE12 = "lpad(CAST({} % 12 + 1 AS VARCHAR), 2, '0')"


# -- names


def q_full_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("p_partkey")
    name = F.concat(F.when(n % 4 == 0, "ទឹកដោះគោស្រស់").when(n % 4 == 1, "ទឹកផ្លែឈើ").when(n % 4 == 2, "spk").otherwise("Org"), F.lit(" "), "p_name", F.lit(" 2 BTL "), F.col("p_size"), F.lit(" grams $1.50"))
    return _dealt(spark, sf_dir).select("p_partkey", names.segmented(name).alias("segmented"), names.expanded(name).alias("expanded"), names.full_name(name).alias("full_name"))


def q_spec_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("p_size")
    phone = F.concat(F.lit("Phone "), n, F.lit(" GB pro max "), n + 10, F.lit("MP 5g ab"), n + 10, F.lit("xyz/ "), n, F.lit("gb"))
    other = F.concat(F.lit("TV 43\" ua"), n + 10, F.lit("q7 18,000 BTU ar"), n + 10, F.lit("k9 20W "), n + 1000, F.lit("mah "), n, F.lit(" pcs"))
    parts = _dealt(spark, sf_dir).withColumn("s", names.spec_sets(F.when(F.col("p_partkey") % 2 == 0, phone).otherwise(other)))
    kinds = ["storage", "wattage", "mah", "pcs", "series", "screen", "btu", "model_code", "camera", "is_5g"]
    return parts.select("p_partkey", *[F.array_join(F.col(f"s.{k}"), ",").alias(k) for k in kinds])


def q_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match.name_vectors(_part(spark, sf_dir).select("p_partkey", F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("name")), "p_partkey").select("p_partkey", "bucket", F.round("weight", 8).alias("weight"))


def q_script(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _part(spark, sf_dir).select("p_partkey", F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("ទឹក "), "p_name", F.lit(" ត្រី"))).otherwise(F.col("p_name")).alias("name"))
    return parts.select("p_partkey", text.is_khmer("name").alias("khmer"), F.array_join(text.khmer_tokens("name"), "|").alias("tokens"))


def q_device_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("p_size")
    name = F.concat(F.lit("Phone "), n % 30, F.lit("GB "), n * 16, F.lit("GB "), n, F.lit(" inch "), n * 6, F.lit("MP"), F.when(n % 2 == 0, " 5G").otherwise(""))
    return _part(spark, sf_dir).select("p_partkey", text.hedonic_specs(name).alias("s")).select("p_partkey", "s.memory", "s.storage", "s.screen", "s.camera", "s.is_5g")


def q_full_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part is a record, its name with its words turned and, for some, a typo; each seventh part is in the catalogue. Without SQL: tested against brute force."""
    parts = _part(spark, sf_dir).select(F.col("p_partkey").alias("k"), F.concat_ws(" ", "p_name", "p_type", F.concat(F.lit("no"), F.col("p_partkey"))).alias("name"), F.col("p_brand").alias("brand"), F.col("p_size").cast("string").alias("size"))
    catalog = parts.where("k % 7 = 0").select(F.concat(F.lit("p"), "k").alias("item"), "name", "brand", "size")
    turned = F.array_join(F.reverse(F.split("name", " ")), " ")
    records = parts.select(F.col("k").alias("raw_id"), (F.col("k") % 9).cast("string").alias("store"), F.lit(None).cast("string").alias("barcode"), F.lit(None).cast("string").alias("sku"), F.when(F.col("k") % 2 == 0, turned).otherwise(F.concat("name", F.lit("x"))).alias("name"), "brand", "size")
    none = spark.createDataFrame([], "barcode string, store string, sku string, item string")
    return match.full_ladder(records, none.select("barcode", "item"), none.select("store", "sku", "item"), catalog.select("name", "size", "item"), catalog)


def q_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Barcodes and skus that a batch of records teaches; parts with an even key are known."""
    rows = _part(spark, sf_dir).select(F.col("p_partkey").alias("raw_id"), F.col("p_brand").alias("store"), F.concat(F.lit("88"), F.lpad(F.col("p_size").cast("string"), 8, "0")).alias("barcode"), F.concat(F.lit("s"), F.col("p_partkey") % 40).alias("sku"))
    matched = rows.select("raw_id", F.concat(F.lit("i"), "raw_id").alias("item"), F.when(F.col("raw_id") % 3 == 0, "new").when(F.col("raw_id") % 3 == 1, "name_brand_size").otherwise("barcode").alias("method"))
    known = rows.where("raw_id % 50 = 4")
    return match.aliases(rows, matched, known.select("barcode"), known.select("store", "sku"))


# -- classification


def q_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _part(spark, sf_dir)
    items = part.select(F.col("p_partkey").alias("item"), F.col("p_brand").alias("store"), F.concat(F.lit("88"), "p_partkey").alias("barcode"), F.concat("p_brand", F.lit(":"), "p_size").alias("product_key"), F.concat_ws(" ", "p_name", "p_type").alias("name"))
    codes = items.where("item % 11 = 0").select(F.lit("barcode").alias("kind"), F.col("barcode").alias("value"), F.lit(None).cast("string").alias("store"), F.lit("01").alias("division"))
    keys = part.where("p_size = 7").select(F.lit("product_key"), F.concat("p_brand", F.lit(":7")), F.lit(None).cast("string"), F.lit("02")).distinct()
    scoped = part.groupBy("p_brand").agg(F.min("p_name").alias("n")).select(F.lit("name"), F.upper("n"), "p_brand", F.lit("03"))
    everywhere = part.agg(F.max("p_type").alias("t")).select(F.lit("name"), "t", F.lit(""), F.lit("04"))
    return classify.overrides(items, codes.union(keys).union(scoped).union(everywhere)).select("item", "override_division", "override_kind")


def q_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _part(spark, sf_dir).select("p_partkey", "p_brand", code12("p_size").alias("division"))
    return part.select("p_partkey", classify.guarded("division", "p_brand", {"11": ["Brand#11", "Brand#12"]}, {"04": ["Brand#13", "Brand#5"], "07": ["Brand#5"]}).alias("division"))


SCOPED = [("widget", "cold", ["Brand#13"], "01"), ("cold", None, ["Brand#5", "Brand#11"], "02"), ("large|small", None, [], "03")]


def q_scoped_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _part(spark, sf_dir).select("p_partkey", classify.store_rule_chain("p_name", "p_brand", SCOPED).alias("label"))


def q_classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("item"), F.col("l_suppkey").alias("store"))
    classes = _part(spark, sf_dir).where("p_size > 10").select(F.col("p_partkey").alias("item"), F.lit("rule").alias("method"), F.col("p_brand").alias("code"), F.col("p_type").alias("division"))
    return classify.classified(lines, classes, ["item"]).select("l_orderkey", "l_linenumber", "item", "division", "code", "method")


def q_reclassify(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id")
    done = q_classes(spark, sf_dir).select("doc_id", "division", F.when(F.col("method") == "purity", "cache").otherwise(F.col("method")).alias("method"))
    return classify.to_reclassify(docs, done, "doc_id")


REWRITES = [("ECONOMY", "cold", "ECONOMY.1"), ("ECONOMY", "widget", "ECONOMY.2"), ("LARGE", "^small", "LARGE.1")]


def q_rewritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _part(spark, sf_dir).select("p_partkey", classify.rewritten("p_type", "p_name", REWRITES).alias("code"))


def q_method_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows each step of the ladder decided, and how many stay without a division."""
    return q_classes(spark, sf_dir).groupBy("method").agg(F.count("*").alias("n"), F.count_if(F.col("division") == classify.UNKNOWN).alias("unknown"), F.countDistinct("division").alias("divisions"))


# -- cleaning


def q_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _part(spark, sf_dir).withColumn("division", F.when(F.col("p_size") % 10 == 0, "UNCLASSIFIED").when(F.col("p_size") % 10 == 1, F.lit(None)).otherwise((F.col("p_size") % 12 + 1).cast("string")))
    clear = clean.index_division("division")
    return part.select("p_partkey", clear.alias("division"), clean.price_label(clear, F.col("p_retailprice") * F.col("p_size") * 50).alias("label"), clean.discount_pct("p_size", F.col("p_retailprice") / 30).alias("discount"),
                       clean.category_path(F.array("p_type", F.lit(" "), F.concat(F.lit(" "), "p_brand"))).alias("category"))


def q_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.since(table(spark, sf_dir, "events"), "ts", back=7).select("event_id", "user_id")


def q_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("customer"), F.col("o_orderdate").cast("date").alias("day"), (F.col("o_totalprice") > 150_000).alias("large"))
    return clean.history(orders, ["customer"], "day", ["large"])


def q_actuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    official = _official(spark, sf_dir).select("month", F.round("official", 4).alias("value"))
    return clean.official_or_own(official, q_headline(spark, sf_dir).select("month", F.col("headline").alias("value")), ["month"])


def q_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").groupBy("event_type", (F.col("event_id") % 2).alias("half")).agg(F.count("*").alias("record_count"), F.sort_array(F.collect_set(F.col("user_id") % 20)).alias("payloads"))
    half = lambda i: e.where(F.col("half") == i).select("event_type", "record_count", "payloads")
    out = clean.merged_batches(half(0), half(1), ["event_type"])
    return out.select("event_type", "record_count", F.array_join(F.transform("payloads", lambda x: x.cast("string")), ",").alias("payloads"))


# -- index


def q_unit_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").join(_part(spark, sf_dir).select(F.col("p_partkey").alias("l_partkey"), "p_retailprice", "p_size"), "l_partkey")
    rows = lines.select("l_orderkey", "l_linenumber", (F.col("l_extendedprice") / F.col("l_quantity")).alias("shelf"), F.col("p_retailprice").alias("shelf0"), (F.col("l_extendedprice") / F.col("l_quantity") / F.col("l_linenumber")).alias("unit"), F.when(F.col("p_size") > 5, F.col("p_retailprice") / 2).alias("unit0"))
    by_unit = index.unit_or_shelf("shelf", "shelf0", "unit", "unit0")
    return rows.select("l_orderkey", "l_linenumber", by_unit.alias("by_unit"), F.round(F.when(by_unit, F.col("unit") / F.col("unit0")).otherwise(F.col("shelf") / F.col("shelf0")), 6).alias("ratio"))


def q_with_hedonic(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("item"), F.col("l_suppkey").alias("store"), F.col("l_extendedprice").alias("price"))
    adjusted = _part(spark, sf_dir).where("p_size > 25").select(F.col("p_partkey").alias("item"), F.col("p_retailprice").alias("adjusted"))
    return index.with_hedonic(lines, adjusted, ["item"]).select("l_orderkey", "l_linenumber", "item", "price")


def q_prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").where("value > 0").groupBy(code12("user_id").alias("division"), F.col("ts").cast("date").alias("day"))
    rows = e.agg((F.avg("value") / 1000).alias("momentum_7"), (F.max("value") / 1000).alias("momentum_14"), (F.min("value") / 100).alias("fx_7"), (F.count("*") / 1000).alias("fx_14"))
    rows = rows.withColumn("in_holiday", (F.day("day") % 3 == 0).cast("double"))
    return nowcast.structural_prior(rows).select("division", "day", F.round("prior", 8).alias("prior"))


def q_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = q_headline(spark, sf_dir).select("month", F.col("headline").alias("forecast"))
    pairs = own.join(_official(spark, sf_dir).withColumnRenamed("official", "actual"), "month")
    return nowcast.spread(pairs).select(F.round("sigma", 4).alias("sigma"), "months")


def q_headline_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest headline, core and monthly change, as one row."""
    rows = written(q_headline(spark, sf_dir), "headline")
    last = rows.agg(F.max("month")).first()[0]
    two = rows.where(F.col("month").isin(last, F.add_months(F.lit(last), -1)))
    now = lambda c: F.max(F.when(F.col("month") == F.lit(last), F.col(c)))
    before = F.max(F.when(F.col("month") != F.lit(last), F.col("headline")))
    return two.agg(F.max("month").alias("month"), now("headline").alias("headline"), now("core").alias("core"), F.round((now("headline") / before - 1) * 100, 2).alias("mom"))


# -- gates


def q_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {"key present": F.col("l_orderkey").isNotNull(), "flag known": F.col("l_returnflag").isin("A", "N"), "discount in range": F.col("l_discount").between(0, 0.09), "price fits": F.col("l_extendedprice") >= F.col("l_quantity") * 1000}
    return quality.checked(table(spark, sf_dir, "lineitem"), rules, ["l_orderkey", "l_linenumber"])


def q_empty_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").where("value > 120").groupBy(F.col("user_id").cast("string").alias("store"), F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("records"))
    expected = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("store"))
    return quality.empty_sources(expected, e)


def q_sizes_lost(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _part(spark, sf_dir).select("p_partkey", F.concat("p_name", F.lit(" "), "p_size", F.lit(" ml")).alias("name_raw"))
    rows = part.withColumn("name_clean", F.when(F.col("p_partkey") % 10 == 0, F.regexp_replace("name_raw", "[0-9]+ ml", "")).otherwise(text.clean_name("name_raw")))
    return quality.sizes_lost(rows).select("p_partkey")


def q_tariffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(F.when(F.col("n_regionkey") < 2, "power").when(F.col("n_regionkey") < 4, "water").otherwise("gas").alias("source"), (F.col("n_nationkey") - 3).alias("rate"),
                                                   F.when(F.col("n_nationkey") % 9 == 0, "TRUE").when(F.col("n_nationkey") % 9 == 1, "yes").otherwise("FALSE").alias("representative"), F.make_date(F.lit(2018) + F.col("n_nationkey"), F.lit(1), F.lit(1)).alias("effective_from"))
    return quality.tariff_faults(nation, "2040-06-01", ["power", "water"])


def q_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _part(spark, sf_dir).select("p_partkey", F.when(F.col("p_size") % 9 == 0, F.lit(None)).otherwise(F.concat_ws(".", F.when(F.col("p_size") % 5 == 0, F.col("p_size").cast("string")).otherwise(code12("p_size")), F.when(F.col("p_size") % 7 != 0, F.col("p_partkey").cast("string")))).alias("code"))
    return quality.malformed(part, "code")


def q_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key")), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key")), "key")


def q_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.weights_off(_part(spark, sf_dir).select((F.col("p_size") * 1.0).alias("weight")))


def q_tree_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _part(spark, sf_dir)
    leaves = part.groupBy(F.concat_ws(".", code12("p_size"), F.replace("p_brand", F.lit("Brand#"), F.lit(""))).alias("code")).agg(F.sum(F.col("p_size") * 1.0).alias("weight"))
    tops = part.where("p_size % 12 <> 4").groupBy(code12("p_size").alias("code")).agg((F.sum(F.col("p_size") * 1.0) + F.max(F.when(F.col("p_size") % 12 == 2, 5.0).otherwise(0.0))).alias("weight"))
    return tree.faults(tree.nodes_of(leaves.union(tops)))


def q_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _part(spark, sf_dir)
    nodes = tree.nodes_of(part.select(code12("p_size").alias("code"), F.lit(1.0).alias("weight")).distinct().union(part.groupBy(F.concat_ws(".", code12("p_size"), (F.col("p_size") % 5).cast("string")).alias("code")).agg(F.sum(F.col("p_size") * 1.0).alias("weight"))))
    items = part.select(F.col("p_partkey").alias("item"), F.concat_ws(".", code12("p_size"), (F.col("p_partkey") % 8).cast("string"), F.lit("9")).alias("code"), F.col("p_name").alias("name"))
    return tree.map_to_leaf(items, nodes).select("item", "leaf")


def q_guard_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("p_size")
    part = _part(spark, sf_dir).select("p_partkey", F.concat("p_name", F.lit(" "), n, F.lit("ml")).alias("raw_name"), F.concat(F.lit(" "), F.upper("p_name"), F.lit(" "), F.when(n % 3 == 0, n).otherwise(n * 2), F.lit("ML")).alias("item_name"), (0.8 + n / 500).alias("confidence"))
    return match.review_guard(part).select("p_partkey", "decision")


# -- storage


def q_cold_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows written as cold months under the shared folder, and two months read back by partition."""
    root = f"{folder(spark).rstrip('/')}/cold-{spark.sparkContext.applicationId}-{abs(hash(sf_dir))}"
    storage.offload(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate"), "l_shipdate", root)
    both = [storage.read_month(spark, root, 1997, m, ["l_orderkey", "l_linenumber"]).withColumn("month", F.lit(m)) for m in (3, 12)]
    return both[0].unionByName(both[1])


def q_official_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = table(spark, sf_dir, "part").groupBy(F.col("p_size").alias("month")).agg(*[F.avg(F.when(F.col("p_type") == t, F.col("p_retailprice"))).alias(d) for d, t in (("00", "ECONOMY"), ("01", "LARGE"))])
    return storage.long_benchmark(wide, ["00", "01"]).select("month", "division", F.round("index", 6).alias("index"))


def q_class_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean price and items by class, of one division where the parameter is given."""
    rows = views.optional(_part(spark, sf_dir), p_type="ECONOMY", p_size=None)
    return rows.groupBy("p_brand").agg(F.round(F.avg("p_retailprice"), 6).alias("price"), F.count("*").alias("items"))


LADDER_SQL = SILVER["classification_ladder"][1]
ROUNDED = "own AS (SELECT month, round(headline, 4) AS headline, round(core, 4) AS core FROM headline)"

QUERIES = {
    "full_names": (q_full_names, r"""WITH p AS (SELECT *, CASE p_partkey % 4 WHEN 0 THEN 'ទឹកដោះគោស្រស់' WHEN 1 THEN 'ទឹកផ្លែឈើ' WHEN 2 THEN 'spk' ELSE 'Org' END AS a, CASE p_partkey % 4 WHEN 0 THEN 'FRESH MILK' WHEN 1 THEN 'FRUIT JUICE' WHEN 2 THEN 'SPICY' ELSE 'ORGANIC' END AS b FROM part)
        SELECT p_partkey, CASE WHEN p_partkey % 4 < 2 THEN b ELSE a END || ' ' || p_name || ' 2 BTL ' || p_size || ' grams $1.50' AS segmented,
          CASE WHEN p_partkey % 4 < 2 THEN a ELSE b END || ' ' || p_name || ' 2 BOTTLE ' || p_size || ' G $1.50' AS expanded, b || ' ' || upper(p_name) || ' 2 BOTTLE ' || p_size || ' G' AS full_name FROM p"""),
    "spec_sets": (q_spec_sets, """WITH p AS (SELECT p_partkey, p_partkey % 2 = 0 AS phone, p_size AS n, p_size + 10 AS m FROM part)
        SELECT p_partkey, CASE WHEN phone THEN array_to_string(list_sort([n || 'GB', '5G']), ',') ELSE '' END AS storage, CASE WHEN phone THEN '' ELSE '20W' END AS wattage, CASE WHEN phone THEN '' ELSE (n + 1000) || 'MAH' END AS mah,
          CASE WHEN phone THEN '' ELSE n || 'PCS' END AS pcs, CASE WHEN phone THEN 'PRO MAX' ELSE '' END AS series, CASE WHEN phone THEN '' ELSE array_to_string(list_sort(list_distinct(['43', '' || m])), ',') END AS screen,
          CASE WHEN phone THEN '' ELSE array_to_string(list_sort(list_distinct(['18000', m || '000'])), ',') END AS btu,
          CASE WHEN phone THEN 'AB' || m || 'XYZ' ELSE 'AR' || m || 'K9,UA' || m || 'Q7' END AS model_code, CASE WHEN phone THEN '' || m ELSE '' END AS camera, CASE WHEN phone THEN '5G' ELSE '' END AS is_5g FROM p"""),
    "name_vectors": (q_vectors, """WITH w AS (SELECT DISTINCT p_partkey, unnest(regexp_extract_all(lower(p_name || ' ' || p_brand || ' ' || p_type), '[a-z0-9]+')) AS word FROM part),
        b AS (SELECT p_partkey, CAST(CAST('0x' || md5(word) AS UHUGEINT) % 768 AS INTEGER) AS bucket, count(*) AS n FROM w GROUP BY ALL)
        SELECT p_partkey, bucket, round(n / sqrt(sum(n * n) OVER (PARTITION BY p_partkey)), 8) AS weight FROM b"""),
    "name_script": (q_script, "SELECT p_partkey, p_partkey % 3 = 0 AS khmer, CASE WHEN p_partkey % 3 = 0 THEN 'ទឹក|ត្រី' ELSE '' END AS tokens FROM part"),
    "device_specs": (q_device_specs, """WITH p AS (SELECT p_partkey, p_size AS n, [p_size % 30, p_size * 16] AS gb FROM part)
        SELECT p_partkey, CAST(coalesce(list_max(list_filter(gb, lambda x: x BETWEEN 1 AND 24)), 0) AS DOUBLE) AS memory, CAST(coalesce(list_max(list_filter(gb, lambda x: x BETWEEN 32 AND 2048)), 0) AS DOUBLE) AS storage,
          CAST(CASE WHEN n BETWEEN 3 AND 20 THEN n ELSE 0 END AS DOUBLE) AS screen, CAST(CASE WHEN n * 6 BETWEEN 2 AND 250 THEN n * 6 ELSE 0 END AS DOUBLE) AS camera, CAST(n % 2 = 0 AS INTEGER) AS is_5g FROM p"""),
    "matching_full_ladder": (q_full_ladder, None),
    "learnt_aliases": (q_aliases, """WITH r AS (SELECT p_partkey AS id, p_brand AS store, '88' || lpad(CAST(p_size AS VARCHAR), 8, '0') AS barcode, 's' || (p_partkey % 40) AS sku FROM part)
        SELECT 'barcode' AS kind, NULL AS store, barcode AS code, min('i' || id) AS item FROM r WHERE id % 3 < 2 AND barcode NOT IN (SELECT barcode FROM r WHERE id % 50 = 4) GROUP BY barcode
        UNION ALL SELECT 'sku', store, sku, min('i' || id) FROM r WHERE id % 3 = 0 AND (store, sku) NOT IN (SELECT (store, sku) FROM r WHERE id % 50 = 4) GROUP BY store, sku"""),
    "exact_overrides": (q_overrides, """WITH f AS (SELECT p.*, min(p_name) OVER (PARTITION BY p_brand) AS least, max(p_type) OVER () AS top FROM part p),
        k AS (SELECT p_partkey AS item, CASE WHEN p_partkey % 11 = 0 THEN 'barcode' WHEN p_size = 7 THEN 'product_key' WHEN contains(' ' || lower(p_name) || ' ' || lower(p_type) || ' ', ' ' || lower(least) || ' ') THEN 'store name'
          WHEN p_type = top THEN 'name' END AS kind FROM f)
        SELECT item, CASE kind WHEN 'barcode' THEN '01' WHEN 'product_key' THEN '02' WHEN 'store name' THEN '03' WHEN 'name' THEN '04' END AS override_division, replace(kind, 'store ', '') AS override_kind FROM k"""),
    "model_guards": (q_guards, f"""WITH d AS (SELECT p_partkey, p_brand, {CODE12.format('p_size')} AS division FROM part)
        SELECT p_partkey, CASE WHEN division = '11' AND p_brand NOT IN ('Brand#11', 'Brand#12') THEN NULL WHEN division = '04' AND p_brand IN ('Brand#13', 'Brand#5') THEN NULL WHEN division = '07' AND p_brand = 'Brand#5' THEN NULL ELSE division END AS division FROM d"""),
    "store_scoped_rules": (q_scoped_rules, """SELECT p_partkey, CASE WHEN p_name LIKE '%widget%' AND p_name NOT LIKE '%cold%' AND p_brand <> 'Brand#13' THEN '01' WHEN p_name LIKE '%cold%' AND p_brand NOT IN ('Brand#5', 'Brand#11') THEN '02'
        WHEN p_name LIKE '%large%' OR p_name LIKE '%small%' THEN '03' END AS label FROM part"""),
    "classified_prices": (q_classified, """SELECT l_orderkey, l_linenumber, l_partkey AS item, p_type AS division, p_brand AS code, CASE WHEN p_partkey IS NOT NULL THEN 'rule' END AS method
        FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 10) ON l_partkey = p_partkey"""),
    "reclassify_rows": (q_reclassify, f"WITH l AS ({LADDER_SQL}) SELECT doc_id FROM l WHERE NOT (division <> 'UNCLASSIFIED' AND method IN ('override', 'purity'))"),
    "code_rewrites": (q_rewritten, """SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' AND p_name LIKE '%cold%' THEN 'ECONOMY.1' WHEN p_type = 'ECONOMY' AND p_name LIKE '%widget%' THEN 'ECONOMY.2' WHEN p_type = 'LARGE' AND p_name LIKE 'small%' THEN 'LARGE.1' ELSE p_type END AS code FROM part"""),
    "method_shares": (q_method_shares, f"WITH l AS ({LADDER_SQL}) SELECT method, count(*) AS n, count(*) FILTER (division = 'UNCLASSIFIED') AS unknown, count(DISTINCT division) AS divisions FROM l GROUP BY method"),
    "price_labels": (q_labels, """WITH p AS (SELECT *, CASE WHEN p_size % 10 IN (0, 1) THEN '01' ELSE lpad(CAST(p_size % 12 + 1 AS VARCHAR), 2, '0') END AS division, p_retailprice / 30 AS original FROM part)
        SELECT p_partkey, division, CASE WHEN division = '04' AND p_retailprice * p_size * 50 < 10000 THEN 'too low for housing' WHEN division = '01' AND p_retailprice * p_size * 50 > 1e6 THEN 'too high for food' ELSE 'plausible' END AS label,
          CASE WHEN original > p_size AND p_size > 0 THEN round((original - p_size) / original * 100, 2) END AS discount, p_type || ' > ' || p_brand AS category FROM p"""),
    "incremental_rows": (q_since, "SELECT event_id, user_id FROM events WHERE ts >= (SELECT max(CAST(ts AS DATE)) - 7 FROM events)"),
    "version_history": (q_history, """WITH d AS (SELECT o_custkey AS customer, CAST(o_orderdate AS DATE) AS day, bool_or(o_totalprice > 150000) AS large FROM orders GROUP BY ALL),
        s AS (SELECT *, lag(large) OVER (PARTITION BY customer ORDER BY day) AS was FROM d), c AS (SELECT * FROM s WHERE was IS NULL OR was <> large)
        SELECT customer, large, day AS valid_from, lead(day) OVER w AS valid_to, lead(day) OVER w IS NULL AS is_current FROM c WINDOW w AS (PARTITION BY customer ORDER BY day)"""),
    "actual_values": (q_actuals, f"""WITH {CHAIN}, {OFFICIAL}, {ROUNDED} SELECT month, round(official, 4) AS value, 'official' AS origin FROM official
        UNION ALL SELECT month, headline, 'own' FROM own WHERE month NOT IN (SELECT month FROM official)"""),
    "staged_batches": (q_batches, """WITH h AS (SELECT event_type, event_id % 2 AS half, count(*) AS n, array_to_string(list_sort(list(DISTINCT user_id % 20)), ',') AS payloads FROM events GROUP BY ALL)
        SELECT event_type, max(n) AS record_count, string_agg(payloads, ',' ORDER BY half) AS payloads FROM h GROUP BY 1"""),
    "unit_or_shelf": (q_unit_choice, """WITH r AS (SELECT l_orderkey, l_linenumber, l_extendedprice / l_quantity / p_retailprice AS shelf, CASE WHEN p_size > 5 THEN (l_extendedprice / l_quantity / l_linenumber) / (p_retailprice / 2) END AS unit FROM lineitem JOIN part ON l_partkey = p_partkey),
        u AS (SELECT *, unit IS NOT NULL AND NOT ((unit >= 3 OR unit <= 0.33) AND shelf BETWEEN 0.70 AND 1.40) AS by_unit FROM r)
        SELECT l_orderkey, l_linenumber, by_unit, round(CASE WHEN by_unit THEN unit ELSE shelf END, 6) AS ratio FROM u"""),
    "hedonic_joined": (q_with_hedonic, "SELECT l_orderkey, l_linenumber, l_partkey AS item, coalesce(p_retailprice, l_extendedprice) AS price FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 25) ON l_partkey = p_partkey"),
    "structural_prior": (q_prior, f"""WITH r AS (SELECT {CODE12.format('user_id')} AS division, CAST(ts AS DATE) AS day, avg(value) / 1000 AS m7, max(value) / 1000 AS m14, min(value) / 100 AS f7, count(*) / 1000 AS f14 FROM events WHERE value > 0 GROUP BY ALL),
        d AS (SELECT *, CASE WHEN day(day) % 3 = 0 THEN 0.0012 ELSE 0 END AS s, coalesce(max(m7) FILTER (division = '01') OVER (PARTITION BY day), 0) AS food, coalesce(max(m7) FILTER (division = '07') OVER (PARTITION BY day), 0) AS road FROM r)
        SELECT division, day, round(CAST(CASE division WHEN '01' THEN m7 / 7 + 0.048 * road / 7 + s * 0.5 + 0.15 * f7 / 7 WHEN '02' THEN m7 / 7 + 0.2 * f7 / 7 + s * 0.25 WHEN '04' THEN m14 / 14 * 0.5 + 0.1 * f14 / 14
          WHEN '07' THEN m7 / 7 + 0.35 * f7 / 7 + s * 0.5 WHEN '11' THEN m7 / 7 + 0.3 * food / 7 + 0.05 * road / 7 + s * 0.25 ELSE m7 / 14 * 0.3 END AS DOUBLE), 8) AS prior FROM d"""),
    "error_spread": (q_spread, f"WITH {CHAIN}, {OFFICIAL}, {ROUNDED} SELECT round(stddev_samp(headline - official), 4) AS sigma, count(*) AS months FROM own JOIN official USING (month)"),
    "headline_card": (q_headline_card, f"""WITH {CHAIN}, {ROUNDED}, t AS (SELECT max(month) AS last FROM own)
        SELECT o.month, o.headline, o.core, round((o.headline / b.headline - 1) * 100, 2) AS mom FROM own o JOIN t ON o.month = last LEFT JOIN own b ON b.month = CAST(last - INTERVAL 1 MONTH AS DATE)"""),
    "schema_checks": (q_checked, """SELECT 'key present' AS rule, count(*) FILTER (l_orderkey IS NULL) AS failures FROM lineitem UNION ALL SELECT 'flag known', count(*) FILTER (l_returnflag NOT IN ('A', 'N')) FROM lineitem
        UNION ALL SELECT 'discount in range', count(*) FILTER (NOT l_discount BETWEEN 0 AND 0.09) FROM lineitem UNION ALL SELECT 'price fits', count(*) FILTER (l_extendedprice < l_quantity * 1000) FROM lineitem
        UNION ALL SELECT 'unique', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)"""),
    "empty_sources": (q_empty_sources, """WITH e AS (SELECT CAST(user_id AS VARCHAR) AS store, max(CAST(ts AS DATE)) AS d FROM events WHERE value > 120 GROUP BY 1), l AS (SELECT max(d) AS last FROM e)
        SELECT CAST(s_suppkey AS VARCHAR) AS store, d AS repair_from, CASE WHEN coalesce(d = (SELECT last FROM l), false) THEN 'PASSED' ELSE 'EMPTY' END AS status FROM supplier LEFT JOIN e ON store = CAST(s_suppkey AS VARCHAR)"""),
    "sizes_lost": (q_sizes_lost, "SELECT p_partkey FROM part WHERE p_partkey % 10 = 0 AND NOT regexp_matches(lower(p_name), '(ml|g|kg|oz|lb|l|gram|grams|kilo|kilos|liter|liters|litre|litres|mls|gm)\\b')"),
    "tariff_faults": (q_tariffs, """WITH t AS (SELECT CASE WHEN n_regionkey < 2 THEN 'power' WHEN n_regionkey < 4 THEN 'water' ELSE 'gas' END AS source, n_nationkey AS n FROM nation)
        SELECT source, 'row' AS fault FROM t WHERE n <= 3 OR n > 22 OR n % 9 = 1 UNION ALL SELECT s, 'representative count' FROM (VALUES ('power'), ('water')) v(s) WHERE (SELECT count(*) FROM t WHERE source = s AND n % 9 = 0) <> 1"""),
    "malformed_codes": (q_malformed, f"""WITH c AS (SELECT p_partkey, p_size, CASE WHEN p_size % 9 <> 0 THEN CASE WHEN p_size % 5 = 0 THEN CAST(p_size AS VARCHAR) ELSE {CODE12.format('p_size')} END || CASE WHEN p_size % 7 <> 0 THEN '.' || p_partkey ELSE '' END END AS code FROM part)
        SELECT p_partkey, code FROM c WHERE code IS NULL OR p_size % 7 = 0 OR p_size = 5"""),
    "missing_keys": (q_missing, "SELECT DISTINCT c_custkey AS key FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)"),
    "weights_sum": (q_weights, "SELECT CAST(sum(p_size) AS DOUBLE) AS total FROM part HAVING abs(sum(p_size) - 100) > 0.01"),
    "tree_faults": (q_tree_faults, f"""WITH l AS (SELECT {CODE12.format('p_size')} AS d, replace(p_brand, 'Brand#', '') AS b, sum(p_size) AS w FROM part GROUP BY ALL)
        SELECT d || '.' || b AS code, 'no parent' AS fault FROM l WHERE d = '05' UNION ALL SELECT DISTINCT d, 'children do not add up' FROM l WHERE d = '03' UNION ALL SELECT '*', 'leaves do not add up' FROM (SELECT sum(w) AS s FROM l) WHERE abs(s - 100) > 0.01"""),
    "leaf_mapping": (q_leaves, f"""WITH g AS (SELECT {CODE12.format('p_size')} AS d, CAST(p_size % 5 AS VARCHAR) AS c, sum(p_size) AS w FROM part GROUP BY ALL), h AS (SELECT d, arg_min(d || '.' || c, (-w, d || '.' || c)) AS heaviest FROM g GROUP BY d),
        i AS (SELECT p_partkey AS item, {CODE12.format('p_size')} AS d, CAST(p_partkey % 8 AS VARCHAR) AS c FROM part)
        SELECT item, coalesce(g.d || '.' || g.c, heaviest) AS leaf FROM i LEFT JOIN g ON g.d = i.d AND g.c = i.c LEFT JOIN h ON h.d = i.d"""),
    "review_guard": (q_guard_pairs, """SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'approve' WHEN p_size > 0 THEN 'split' WHEN 0.8 + p_size / 500 < 0.85 THEN 'split' ELSE 'open' END AS decision FROM part"""),
    "cold_months": (q_cold_months, "SELECT l_orderkey, l_linenumber, CAST(month(l_shipdate) AS INTEGER) AS month FROM lineitem WHERE year(l_shipdate) = 1997 AND month(l_shipdate) IN (3, 12)"),
    "official_long": (q_official_long, """SELECT p_size AS month, '00' AS division, round(avg(p_retailprice), 6) AS index FROM part WHERE p_type = 'ECONOMY' GROUP BY 1
        UNION ALL SELECT p_size, '01', round(avg(p_retailprice), 6) FROM part WHERE p_type = 'LARGE' GROUP BY 1"""),
    "class_card": (q_class_card, "SELECT p_brand, round(avg(p_retailprice), 6) AS price, count(*) AS items FROM part WHERE p_type = 'ECONOMY' GROUP BY 1"),
}
