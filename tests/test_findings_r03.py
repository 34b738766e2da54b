"""What the third review found, each on a small table."""

import datetime
import os

import duckdb

from basketry.operators import classify, match, rules
from basketry.plans import ingest_queries, silver_queries


def documents(spark, folder, texts):
    rows = [(i, t, "de", "src1") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality long, toxic long").write.parquet(f"{folder}/labels.parquet")


# Words end where ASCII letters do, and lines at \n alone, as in the SQL: before, "die" went on in "dieöpf", and   broke a line.
TEXTS = ["Der Hund, dieöpf", "der die", "der\ndie", "éidiot", "xidiot", "une la ", None]
LABELS = ["04", "04", None, "01", None, None, None]


def test_words_end_where_ascii_letters_do(spark, tmp_path):
    documents(spark, tmp_path, TEXTS)
    assert [r.label for r in silver_queries.q_rules(spark, str(tmp_path)).orderBy("doc_id").collect()] == LABELS
    assert [r.label for r in silver_queries.q_rule_table(spark, str(tmp_path)).orderBy("doc_id").collect()] == LABELS
    ladder = [r.division for r in silver_queries.q_ladder(spark, str(tmp_path)).orderBy("doc_id").collect()]
    assert ladder == [label or "UNCLASSIFIED" for label in LABELS]


def test_values_of_0_are_records(spark, tmp_path):
    at = datetime.datetime(2024, 1, 20)
    events = [(1, at, 5, "a", 0.0), (2, at, 5, "a", 2.5), (79, at, 5, "a", 0.0), (83, at, 5, "a", 0.0)]
    spark.createDataFrame(events, "event_id long, ts timestamp, user_id long, event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    got = {(r.fault, r.n, r.total) for r in ingest_queries.q_landing(spark, str(tmp_path)).collect()}
    assert got == {("good", 2, 2.5), ("no price", 1, None), ("no item", 1, None)}


def test_words_of_a_rule_are_one_literal():
    """Before, a rule of two words met every text with the longer of them."""
    assert rules.literals(r"(^|[^A-Za-z])that\s+ering([^A-Za-z]|$)") == {"that ering"}
    assert rules.literals(r"mit +license\s{2,}x") == {"mit license x"} and rules.literals(r"that\s*ering") == {"ering"}
    assert rules.plain("That \n\t ERING\v") == "that ering "


def test_overrides_gather_nothing_on_the_driver(spark):
    """Before, rules and items found were broadcast, which ran out of memory on the driver."""
    from basketry.plans.rule_queries import q_overrides

    found = q_overrides(spark, "/root/testdata/sf0.001")
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def parts_and_lines(spark, folder, parts, lines):
    """``part`` from (key, name, brand, type) and ``lineitem`` from (part, store, quantity, price, day)."""
    spark.createDataFrame([(*p, 1, 900.0) for p in parts], "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{folder}/part.parquet")
    rows = [(i, p, s, 1, q, x, 0.0, 0.0, "N", "O", datetime.datetime.fromisoformat(day)) for i, (p, s, q, x, day) in enumerate(lines)]
    form = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    spark.createDataFrame(rows, form).write.parquet(f"{folder}/lineitem.parquet")


def both_ways(spark, folder, queries, name):
    """A query's rows from Spark and from its SQL."""
    query, sql = queries[name]
    found = query(spark, str(folder))
    with duckdb.connect() as con:
        for t in os.listdir(folder):
            con.execute(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM '{folder}/{t}/*.parquet'")
        wanted = con.execute(f"SELECT {', '.join(found.columns)} FROM ({sql})").fetchall()
    return sorted(map(tuple, found.collect()), key=repr), sorted(wanted, key=repr)


def test_records_of_one_raw_id_are_decided_each(spark, tmp_path):
    """With more than 10,000 stores, items and stores share raw ids (1, 10005 and 2, 5): before, one of such records took the other's place or both became one."""
    from basketry.plans import model_queries

    parts = [(i, f"name {i % 3}", "Brand#1", "LARGE") for i in range(1, 15)]
    pairs = [(1, 10005), (2, 5), (5, 10001), (6, 1), (9, 10002), (10, 2), (12, 20003), (13, 10003), (14, 3)]
    parts_and_lines(spark, tmp_path, parts, [(p, s, 1.0, 10.0, "1995-03-04") for p, s in pairs])
    found, wanted = both_ways(spark, tmp_path, model_queries.QUERIES, "matching_ladder")
    assert found == wanted and len(found) == len(pairs)


def test_names_of_different_models_do_not_meet(spark, monkeypatch):
    """Before, the 160 names of a batch all met each other, as they share two words; now only those without a model (the last four) meet all."""
    names = [f"cold fresh plate no{i}" for i in range(10, 166)] + ["cold fresh plate", "cold plates", "plate cold big", "fresh plate"]
    records = spark.createDataFrame([(i, "s", None, None, n, None) for i, n in enumerate(names)], "raw_id int, store string, barcode string, sku string, name string, size string")
    met, real = [], match.near_vectors
    monkeypatch.setattr(match, "near_vectors", lambda *a: met.append(real(*a)) or met[-1])
    members, looks = match.batch_keys(records)
    assert 0 < sum(x.count() for x in met) < 10 * len(names)
    alike = {(r.id, r.key) for r in looks.where("cosine < 1").collect()}
    assert (0, "t|cold fresh plate") in alike and (156, "t|cold fresh plate no10") in alike and (0, "t|cold fresh plate no11") not in alike


def test_a_pattern_is_tried_once_for_all_its_rules(spark, monkeypatch):
    """Before, each text was tried by every rule, also where rules differ in their store or division only."""
    rows = [(v, s, d) for v in ("Cold tea", "COLD TEA") for s in ("s1", "s2", "s3", "", None) for d in ("03", "02")]
    known = spark.createDataFrame([*rows, ("tea", "s1", "09"), ("tea", "s9", "08"), (" ", "s1", "07"), ("rice", "s1", None)], "value string, store string, division string")
    items = spark.createDataFrame([(1, "s1", "Cold Tea"), (2, "s4", "cold tea x"), (3, "s9", "ice tea"), (4, "s9", "COLD TEA"), (5, None, "cold tea"), (6, "s1", None), (7, "", "tea")], "item int, store string, name string")
    tried, real = [], classify.rule_hits
    monkeypatch.setattr(classify, "rule_hits", lambda rows, rules, *a: tried.append(rules.count()) or real(rows, rules, *a))
    got = {r["item"]: r.override_division for r in classify.pattern_overrides(items, known).collect()}
    assert got == {1: "02", 2: "02", 3: "08", 4: "08", 5: "02", 6: None, 7: None} and tried == [2]


def test_names_are_made_by_all_tasks(spark):
    """Before, one task made the names of a whole file of parts."""
    from basketry.plans.rule_queries import q_full_names, q_spec_sets

    for query in (q_full_names, q_spec_sets):
        assert "p_partkey" in query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString().split("Exchange hashpartitioning(")[1][:20]


def test_the_chain_writes_only_what_is_read_again(spark, monkeypatch):
    """Before, relatives were written twice, with the columns of all steps."""
    from basketry.operators import index
    from basketry.plans.index_queries import q_compiled_divisions

    seen, real = {}, index.written
    monkeypatch.setattr(index, "written", lambda df, name: seen.setdefault(name, df.columns) and real(df, name))
    assert q_compiled_divisions(spark, "/root/testdata/sf0.001").count() > 0
    assert len(seen["compared-relatives"]) == 7 and "compiled-relatives" not in seen
