"""URL filters: a blocked Bloom filter of listed canonical URLs, and an exact hash join for what it passes.

A list entry is a host and a path ending in a slash; it covers the host, its subdomains and all paths below. A URL
therefore has one key for each tail of its host's labels and each head of its path, as long as the list has such. Keys
that the filter rules out cost no shuffle; the others are joined with the list, which removes false positives. Rules are
matched with a URL's host and path as written; listed URLs with their canonical form: A-Z lower-cased, without user, port
and closing dots, without repeated slashes, and with a slash at the end of the path. ``www`` is a host as any other, and
percent signs and other alphabets are left as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm import bloom
from basketry.llm.store import kept


def host(url: Column) -> Column:
    """After the first ``://`` up to a slash, question mark, number sign or the end, A-Z lower-cased; empty for null or without ``://``."""
    return lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path(url: Column) -> Column:
    """After the host up to a question mark, number sign or the end; empty as the host."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def canonical_host(host: Column) -> Column:
    """Without user, port and closing dots, A-Z lower-cased."""
    return F.regexp_replace(F.regexp_replace(lower(host), r"(?s)^.*@", ""), r"\.*(?::[0-9]*)?$", "")


def canonical_path(path: Column) -> Column:
    """With one slash for several, one at the beginning and one at the end."""
    return F.regexp_replace(F.concat(F.lit("/"), path, F.lit("/")), "/+", "/")


def canonical_urls(urls: DataFrame) -> DataFrame:
    """``host, path``, once each, of the canonical forms of ``urls`` (``url``); those without a host are left out."""
    found = urls.select(canonical_host(host(F.col("url"))).alias("host"), canonical_path(path(F.col("url"))).alias("path"))
    return found.where("host <> ''").distinct()


RULE, SITE = "0 ", "1 "  # what a key begins with


def _keys(form: str, host: Column, path: Column, labels: int, depth: int) -> Column:
    """The tails of a host's labels (``labels`` at most) with the heads of its path (``depth`` slashes at most)."""
    parts, steps = F.split(host, r"\."), F.split(path, "/")
    tails = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(labels))), lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), "."))
    heads = F.transform(F.sequence(F.lit(1), F.least(F.size(steps) - 1, F.lit(depth))), lambda n: F.concat(F.array_join(F.slice(steps, F.lit(1), n), "/"), F.lit("/")))
    both = F.flatten(F.transform(tails, lambda t: F.transform(heads, lambda h: F.concat(F.lit(form), t, h))))
    return F.when((host != "") & path.startswith("/"), both).otherwise(F.array().cast("array<string>"))


def _possible(batches: Iterator[pa.RecordBatch], bits: Broadcast) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        urls, keys, hashes = batch.columns
        passes = pa.array(bloom.maybe(bits.value, hashes.flatten().to_numpy()))
        yield pa.RecordBatch.from_arrays([urls.take(pc.list_parent_indices(keys)).filter(passes), keys.flatten().filter(passes)], ["url", "key"])


def filter_urls(pages: DataFrame, rules: DataFrame, sites: DataFrame, bits_per_entry: int = 16) -> DataFrame:
    """Judges ``pages`` (``page_id``, ``url``): ``page_id, url, host, path, rule, verdict, site``.

    ``rules`` (``host, path, verdict``; a path begins and ends with a slash) go first: the longest one that covers the url
    decides (of equal ones, ``allow``). Urls under no rule are blocked if one of the ``sites`` (``host, path``, brought to
    their canonical form; a null path is a slash) covers them: ``site`` is the longest. All others are allowed. Null urls
    and urls without ``://`` have an empty host and path, and are allowed. Null ids and repeated rows stay; other columns
    are not read. Rules and sites may be tables of any size; entries with a null host are left out.
    """
    spark = pages.sparkSession
    site_path = canonical_path(F.coalesce(F.col("path"), F.lit("")))
    entries = rules.where("host IS NOT NULL").select(F.lit(RULE).alias("form"), "host", F.coalesce("path", F.lit("/")).alias("path"), "verdict").union(
        sites.where("host IS NOT NULL").select(F.lit(SITE), canonical_host(F.col("host")), site_path, F.lit("block")))
    entries = entries.groupBy("form", F.concat("form", "host", "path").alias("key"), "host", "path").agg(F.min("verdict").alias("verdict"))
    entries = kept(entries.select("form", "key", "verdict", F.size(F.split("host", r"\.")).alias("labels"), (F.size(F.split("path", "/")) - 1).alias("depth")), "listed-urls")
    n, labels, depth = entries.agg(F.count("*"), F.coalesce(F.max("labels"), F.lit(1)), F.coalesce(F.max("depth"), F.lit(1))).first()
    bits = bloom.build(entries.select(F.xxhash64("key").alias("key")), bloom.blocks_for(n, bits_per_entry))
    shared = spark.sparkContext.broadcast(bits)

    own = pages.select("page_id", F.col("url").cast("string").alias("url"), host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    both = F.concat(_keys(RULE, F.col("host"), F.col("path"), labels, depth), _keys(SITE, canonical_host(F.col("host")), canonical_path(F.col("path")), labels, depth))
    keyed = own.where("url IS NOT NULL AND host <> ''").select("url", both.alias("keys"))
    hashed = keyed.where("size(keys) > 0").distinct().withColumn("hashes", F.transform("keys", lambda k: F.xxhash64(k)))
    possible = hashed.mapInArrow(partial(_possible, bits=shared), "url string, key string")
    best = F.min_by(F.struct("form", F.expr("substring(key, 3)").alias("entry"), "verdict"), F.struct("form", -F.length("key"), "key"))
    # Written: the judged urls are few, and adaptive execution can then split a url that very many pages have.
    judged = kept(possible.join(entries.select("key", "form", "verdict"), "key").groupBy("url").agg(best.alias("best")).select("url", "best.*"), "judged-urls")
    out = own.where("url IS NOT NULL").join(judged, "url", "left")
    nothing = [F.lit(None).cast("string").alias(c) for c in ("form", "entry", "verdict")]
    out = out.select("page_id", "url", "host", "path", "form", "entry", "verdict").union(own.where("url IS NULL").select("page_id", "url", "host", "path", *nothing))
    return out.select("page_id", "url", "host", "path", F.when(F.col("form") == RULE, F.col("entry")).alias("rule"), F.coalesce("verdict", F.lit("allow")).alias("verdict"), F.when(F.col("form") == SITE, F.col("entry")).alias("site"))
