"""Filter interaction audit by aggregating the edges of the lattice of filter subsets.

What a filter removes depends on the filters before it, but not on their order: a document of which all failures are known
adds to one count on each edge (filters applied so far, next filter). Each order of all filters is a path through that
lattice, and a step of it is an edge, so documents are counted once for each set of failures, sets spread over the edges,
and the counts joined to the steps of every order. Five filters have 80 edges and 600 steps.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.llm.store import kept

LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SYMBOLS = 100, 80, 10, "[#$%&*|]"
WORD = r"[^\x20\x09-\x0D]+"
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def text_failures(text: Column) -> dict[str, Column]:
    """The filters that look at one text (null counts as empty): few words, few distinct words, many capitals, symbols."""
    whole = F.coalesce(text.cast("string"), F.lit(""))
    words = F.regexp_extract_all(whole, F.lit(f"({WORD})"))
    capitals = F.char_length(F.regexp_replace(whole, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < LEAST_WORDS,
        "B": F.size(F.array_distinct(words)).cast("long") * 100 < F.size(words).cast("long") * LEAST_DISTINCT,
        "C": capitals.cast("long") * 100 > F.char_length(whole).cast("long") * MOST_CAPITALS,
        "D": whole.rlike(SYMBOLS),
    }


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, a, b, c, d, e, good, toxic`` (booleans, but for ``part``) for each row of ``docs`` (``doc_id, text, lang``).

    ``e``: the whole text is that of a document with a smaller id, by SHA-256; a null id is neither smaller nor larger than
    any. ``good`` and ``toxic``: some row of ``labels`` says so of the id. Null and empty texts are equal, and so are null
    and empty languages.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    fails = text_failures(F.col("text"))
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("same"),
        *[f.alias(name.lower()) for name, f in fails.items()])
    own = kept(own, "filter-failures")
    copies = own.groupBy("same").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").select("same", "least")
    copies = kept(copies, "filter-copies")
    said = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    said = kept(said.agg(F.max((F.col("quality") == 1)).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")).where("good OR toxic"), "filter-labels")
    found = own.join(copies, "same", "left").join(said, "doc_id", "left")
    no = F.lit(False)
    return found.select("part", "a", "b", "c", "d", F.coalesce(F.col("doc_id") > F.col("least"), no).alias("e"), F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"))


def edges(counted: DataFrame, filters: Sequence[str]) -> DataFrame:
    """``part, before, next`` with COUNTS: what happens to each part's documents on each edge of the lattice.

    ``counted`` has ``part, failed`` (a set of filters as bits), ``good, toxic`` (booleans) and ``n``. ``before`` is the set
    of filters applied so far, ``next`` the number of a filter that is not among them.
    """
    every = [(before, i) for before in range(1 << len(filters)) for i in range(len(filters)) if not before >> i & 1]
    spread = counted.withColumn("edge", F.explode(F.array(*[F.struct(F.lit(b).alias("before"), F.lit(i).alias("next")) for b, i in every]))).select("*", "edge.before", "edge.next")
    bit = F.pow(F.lit(2), F.col("next")).cast("int")
    failed, fails = F.col("failed"), F.col("failed").bitwiseAND(bit) != 0
    reached = failed.bitwiseAND(F.col("before")) == 0
    when = {
        "kept": reached & ~fails, "removed": reached & fails, "redundant": ~reached & fails, "unique_fails": failed == bit,
        "good_lost": reached & fails & F.col("good"), "toxic_lost": reached & fails & F.col("toxic")}
    return spread.groupBy("part", "before", "next").agg(*[F.sum(F.when(of, F.col("n")).otherwise(0)).alias(name) for name, of in when.items()])


def steps(spark: SparkSession, filters: Sequence[str]) -> DataFrame:
    """``filter_order, step, before, next`` for every order of the filters: the edges on each path through the lattice."""
    rows = []
    for order in permutations(range(len(filters))):
        before = 0
        for step, i in enumerate(order, 1):
            rows.append(("".join(filters[j] for j in order), step, before, i))
            before |= 1 << i
    return spark.createDataFrame(rows, "filter_order string, step int, before int, next int")


def lattice_audit(counted: DataFrame, filters: Sequence[str]) -> DataFrame:
    """``part, filter_order, step``, COUNTS and ``shapley`` from counts by set of failures (see ``edges``): one row for each part and step of each order. ``shapley`` is what the step's filter removes, summed over all orders. The steps are ``n * n!`` rows for ``n`` filters, so this is for a handful."""
    n = len(filters)
    found = edges(counted, filters)
    applied = F.bit_count("before")
    paths = F.element_at(F.array(*[F.lit(factorial(i) * factorial(n - 1 - i)) for i in range(n)]), applied + 1)  # orders that pass an edge
    found = found.withColumn("shapley", F.sum(F.col("removed") * paths).over(Window.partitionBy("part", "next")))
    return steps(counted.sparkSession, filters).join(found, ["before", "next"]).select("part", "filter_order", "step", *COUNTS, "shapley")


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of five filters over ``docs`` (``doc_id, text, lang``) and ``labels`` (``doc_id, quality, toxic``): A few words, B few distinct words, C many capitals, D symbols, E copies of a document with a smaller id.

    Repeated rows count as often as they stand (none is a copy of itself: their ids are equal); see ``failures`` for nulls.
    Without documents there are no parts and no rows. Other columns are not read.
    """
    filters = "ABCDE"
    failed = sum((F.col(name.lower()).cast("int") * (1 << i) for i, name in enumerate(filters)), F.lit(0))
    counted = failures(docs, labels).groupBy("part", failed.alias("failed"), "good", "toxic").agg(F.count("*").alias("n"))
    return lattice_audit(counted, filters)
