"""Raw scraped records to clean observations: canonical fields, currency, sizes, promotions, flags, validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions import text
from basketry.functions.exprs import col, falsy, truthy

FALLBACK_RATE, MOST_PRICE = 4044.0, 1e8


def field(payload: str, name: str) -> Column:
    return F.get_json_object(payload, f"$.{name}")


def in_riel(price: Column, currency: Column | str, rate: Column | str) -> Column:
    return F.when(F.upper(col(currency)) == "KHR", price).otherwise(price * F.coalesce(col(rate), F.lit(FALLBACK_RATE)))


def discount_pct(price: Column | str, original: Column | str, digits: int = 2) -> Column:
    """How far a price is below the original, in per cent; null unless original > price > 0. Not clamped."""
    return F.when((col(original) > col(price)) & (col(price) > 0), F.round((col(original) - col(price)) / col(original) * 100.0, digits))


def clean(raw: DataFrame, matches: DataFrame, rates: DataFrame, land_stores: Sequence[str] = ("khmer24", "realestate")) -> DataFrame:
    """Clean observations of raw prices (``raw_price_id, store, name, price, currency, scraped_at, payload``).

    ``matches``: ``raw_price_id, item_id``; ``rates``: ``day, rate``. Prices not above 0 are left out; the rate is the day's, or
    the fallback; ``is_outlier`` and ``cpi_eligible`` are flags only.
    """
    fields = raw.where("price > 0").select("*", F.col("scraped_at").cast("date").alias("day"), field("payload", "package_size").alias("size_text"), field("payload", "category_native").alias("category"),
                                           field("payload", "barcode").alias("barcode"), field("payload", "original_price").try_cast("double").alias("original"),
                                           truthy(field("payload", "on_promo")).alias("raw_promo"), (~falsy(field("payload", "cpi_eligible"))).alias("raw_eligible"),
                                           truthy(field("payload", "is_fallback")).alias("is_fallback"))
    joined = fields.join(matches, "raw_price_id", "left").join(rates, "day", "left")
    parsed = joined.withColumns({"price_khr": in_riel(F.col("price"), "currency", "rate"), "original_khr": in_riel(F.col("original"), "currency", "rate"), "name_clean": text.clean_name("name")})
    parsed = text.with_sizes(parsed, "size_text", "name")
    below = (F.col("original_khr") > F.col("price_khr")) & (F.col("price_khr") > 0)
    share = (F.col("original_khr") - F.col("price_khr")) / F.col("original_khr") * 100.0
    amount = F.col("size_value") * F.coalesce(F.nullif(F.col("pack_qty"), F.lit(0.0)), F.lit(1.0))
    land = F.col("store").isin(*land_stores) & F.coalesce(F.col("category").ilike("%land for rent%"), F.lit(False))
    large = F.col("size_unit").isin("kg", "l") & (F.col("size_value") > 0) & ~(F.col("price_khr") / amount).between(10, 5e7)
    outlier = (F.col("price_khr") > MOST_PRICE) | F.coalesce(F.col("price") > 10 * F.col("original"), F.lit(False)) | F.coalesce(large, F.lit(False)) | land
    return parsed.withColumns({
        "discount_pct": F.coalesce(discount_pct("price", "original"), F.lit(0.0)), "on_promo": F.col("raw_promo") | F.coalesce(below & (share >= 1.0), F.lit(False)),
        "unit_price_khr": text.unit_price("price_khr", "size_value", "size_unit", "pack_qty"), "is_outlier": outlier,
        "cpi_eligible": F.col("raw_eligible") & (F.col("price_khr") <= MOST_PRICE) & ~land})


def canonical(raw: DataFrame, riel_stores: Sequence[str] = (), riel_above: float = 50_000, most_khr: float = 5e7, most_usd: float = 1.5e4) -> DataFrame:
    """Canonical fields of a record whose source may name them differently: ``product_id | item_id | sku``, ``name | title``, ``price | current_price``, ``category | category_native``.

    The id falls back to the source with 12 digits of the name's SHA-1. The currency is the record's, else KHR for stores
    that price in it and for prices above ``riel_above``, else USD. A record is eligible up to a price cap of its currency.
    """
    have = set(raw.columns)
    first = lambda *names: F.coalesce(*[F.nullif(F.trim(F.col(n).cast("string")), F.lit("")) for n in names if n in have], F.lit(None).cast("string"))
    name, price = first("name", "title"), first("price", "current_price").try_cast("double")
    currency = F.coalesce(F.upper(first("currency")), F.when(F.col("store").isin(*riel_stores) | (price > riel_above), F.lit("KHR")).otherwise("USD"))
    cap = F.when(currency == "KHR", F.lit(most_khr)).otherwise(most_usd)
    identifier = F.coalesce(first("product_id", "item_id", "sku"), F.concat(F.col("store"), F.lit("_"), F.substring(F.sha1(F.coalesce(name, F.lit("")).cast("binary")), 1, 12)))
    return raw.select("store", identifier.alias("item_id"), name.alias("name"), price.alias("price"), currency.alias("currency"), first("category", "category_native").alias("category"),
                      first("original_price").try_cast("double").alias("original_price"), F.coalesce((price > 0) & (price <= cap), F.lit(False)).alias("cpi_eligible"))


def category_path(parts: Column) -> Column:
    """An array of category names as ``A > B``, blanks left out."""
    return F.array_join(F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != ""), " > ")


def violations(records: DataFrame) -> DataFrame:
    """Adds ``violations``: what is wrong with a canonical record; empty if nothing is."""
    rules = [(F.coalesce(F.col("item_id"), F.lit("")) == "", "no id"), (F.coalesce(F.col("name"), F.lit("")) == "", "no name"), (F.col("price").isNull(), "no price"),
             (F.col("price") <= 0, "price not above 0"), (~F.coalesce(F.col("currency").isin("KHR", "USD"), F.lit(False)), "unknown currency"),
             (F.col("original_price") < F.col("price"), "original below price")]
    return records.withColumn("violations", F.array_compact(F.array(*[F.when(bad, F.lit(said)) for bad, said in rules])))


def validation_summary(records: DataFrame) -> DataFrame:
    checked = violations(records).withColumn("bad", F.size("violations") > 0)
    return checked.groupBy("store").agg(F.count("*").alias("total"), F.count_if(~F.col("bad")).alias("valid"), F.count_if(F.col("bad")).alias("invalid"))


def price_label(division: Column | str, price: Column | str) -> Column:
    """A price that is odd for its division."""
    return F.when((col(division) == "04") & (col(price) < 10_000), "too low for housing").when((col(division) == "01") & (col(price) > 1e6), "too high for food").otherwise("plausible")


def index_division(division: Column | str, unclassified: str = "01") -> Column:
    """A two-digit division; unknown ones go to ``unclassified``."""
    d = F.trim(F.coalesce(col(division), F.lit("")))
    return F.when(d.isin("", "UNCLASSIFIED"), F.lit(unclassified)).otherwise(F.substring(F.lpad(d, F.greatest(F.length(d), F.lit(2)), F.lit("0")), 1, 2))


#: Divisions whose sizes are weights and volumes.
CONSUMABLES = ("01", "02", "05", "06", "12")


def comparable_unit_price(division: Column | str, unit_price: Column | str, consumables: Sequence[str] = CONSUMABLES) -> Column:
    """A unit price in divisions where it means something; null elsewhere, where what looks like a size is a specification."""
    return F.when(index_division(division).isin(*consumables), col(unit_price))


def new_rows(incoming: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows to append: one for each key, none that is there already."""
    return incoming.dropDuplicates(list(keys)).join(existing.select(*keys), list(keys), "left_anti")


def upserted(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The latest row by key of both; equal times go to the incoming one."""
    both = existing.withColumn("__new", F.lit(0)).unionByName(incoming.withColumn("__new", F.lit(1)))
    rest = [c for c in existing.columns if c not in keys]
    best = both.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(order, "__new")).alias("r"))
    return best.select(*[c if c in keys else F.col(f"r.{c}").alias(c) for c in existing.columns])


def merged_batches(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Staged batches by key: the larger count, and both payload arrays, the existing one first."""
    both = existing.withColumn("__no", F.lit(0)).unionByName(incoming.withColumn("__no", F.lit(1)))
    payloads = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("__no", "payloads"))), lambda x: x["payloads"]))
    return both.groupBy(*keys).agg(F.max("record_count").alias("record_count"), payloads.alias("payloads"))


def since(rows: DataFrame, date: str, day: str | None = None, back: int = 7) -> DataFrame:
    """Rows of one day, or of the last ``back`` days up to the latest date. The latest date is one value from the files' statistics, and the filter reaches the scan."""
    if day is not None:
        return rows.where(F.col(date) == F.lit(day).cast("date"))
    last = rows.agg(F.date_sub(F.max(F.col(date).cast("date")), back)).first()[0]
    return rows.where(F.col(date) >= F.lit(last)) if last else rows.limit(0)


def history(rows: DataFrame, keys: Sequence[str], order: str, tracked: Sequence[str]) -> DataFrame:
    """Versions of keys: ``keys, tracked, valid_from, valid_to, is_current``; a row whose tracked columns equal the version before it starts no version. Of rows at one time the largest counts."""
    last = rows.groupBy(*keys, order).agg(F.max(F.struct(*tracked)).alias("__now"))
    along = Window.partitionBy(*keys).orderBy(order)
    before = F.lag(F.struct("__now")).over(along)  # wrapped, so that a first row differs from a row of nulls
    starts = last.withColumn("__was", before).where(F.col("__was").isNull() | ~F.col("__was.__now").eqNullSafe(F.col("__now")))
    ends = F.lead(order).over(along)
    return starts.select(*keys, *[F.col(f"__now.{c}").alias(c) for c in tracked], F.col(order).alias("valid_from"), ends.alias("valid_to"), ends.isNull().alias("is_current"))


def official_or_own(official: DataFrame, own: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Official rows, and own ones for keys that have no official row; ``origin`` says which."""
    rest = own.join(official.select(*keys).distinct(), list(keys), "left_anti")
    return official.withColumn("origin", F.lit("official")).unionByName(rest.withColumn("origin", F.lit("own")))
