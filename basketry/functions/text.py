"""Product texts: cleaning, sizes, specifications, barcodes and hashed vectors, as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.exprs import any_of, blank_to_null, col, extract

# HTML entities, promotional words, Khmer digits, units with the base they convert to, and their synonyms.
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&reg;": "", "&trade;": "", "&amp;": "&"}
PROMO_WORDS = ["sale", "promo", "promotion", "discount", "clearance", "hot deal", "best seller", "new arrival", "limited", "special offer", "flash sale", "buy [0-9]+ get [0-9]+", "free shipping", "bundle"]
KHMER_DIGITS = ("០១២៣៤៥៦៧៨៩", "0123456789")
UNIT_SYNONYMS = {
    "g": ["g", "gm", "gram", "grams"], "kg": ["kg", "kilo", "kilos", "kilogram", "kilograms"], "ml": ["ml", "millilitre", "milliliter", "millilitres", "milliliters"],
    "l": ["l", "ltr", "litre", "liter", "litres", "liters"], "cl": ["cl", "centilitre", "centiliter", "centilitres", "centiliters"], "can": ["can", "cans"], "bottle": ["bottle", "bottles"],
    "box": ["box", "boxes"], "pack": ["pack", "packs", "pk"], "bag": ["bag", "bags"], "piece": ["piece", "pieces", "pc", "pcs"], "cup": ["cup", "cups"], "bar": ["bar", "bars"],
    "tube": ["tube", "tubes"], "packet": ["packet", "packets", "pkt"], "roll": ["roll", "rolls"], "stick": ["stick", "sticks"], "pair": ["pair", "pairs"], "set": ["set", "sets"], "dozen": ["dozen", "doz"],
    "oz": ["oz", "ounce", "ounces"], "lb": ["lb", "lbs", "pound", "pounds"], "sachet": ["sachet", "sach"], "carton": ["carton", "ctn"], "jar": ["jar", "jars"], "tablet": ["tablet", "tab", "tablets"],
    "capsule": ["capsule", "cap", "capsules"], "serving": ["serving", "servings"],
}
LENGTHS = {"m": ("length", 1.0), "cm": ("length", 0.01), "mm": ("length", 0.001)}
CLOTHING = ["xxs", "xs", "s", "m", "l", "xl", "xxl", "xxxl", "2xl", "3xl", "4xl"]
TO_BASE = {"kg": ("mass", 1.0), "g": ("mass", 0.001), "l": ("volume", 1.0), "ml": ("volume", 0.001), "cl": ("volume", 0.01)}
NUMBER, MEASURE = r"([0-9]+(?:\.[0-9]+)?)", "(kg|g|ml|l|cl|oz|lb)"
PIECES = "(kg|g|ml|l|cl|oz|lb|can|bottle|pack|pkt|box|pc|pcs|tin|bar)"
MULTIPLE = rf"(?i)([0-9]+)\s*[xX*]\s*{NUMBER}\s*{MEASURE}\b"  # 2 x 500ml
TRAILING = rf"(?i){NUMBER}\s*{MEASURE}\s*[xX*]\s*([0-9]+)\b"  # 500ml x 2
SINGLE = rf"(?i){NUMBER}\s*{MEASURE}\b"
MULTIPLE_PIECES, SINGLE_PIECES = rf"(?i)([0-9]+)\s*[xX*]\s*{NUMBER}\s*{PIECES}\b", rf"(?i){NUMBER}\s*{PIECES}\b"


def replaced(text: Column, table: Mapping[str, str]) -> Column:
    for old, new in table.items():
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def unescaped(text: Column) -> Column:
    """Character references as their characters: those of ENTITIES by that table, other Latin-1 names (with a semicolon) and numbers (decimal or after ``x``); what is no reference stays."""

    def character(reference: Column) -> Column:
        inside = F.regexp_replace(reference, "^&|;$", "")
        number = F.coalesce(F.conv(extract(inside, "^#[xX]([0-9a-fA-F]{1,6})$"), 16, 10), extract(inside, "^#([0-9]{1,7})$")).cast("int")
        known = F.when(number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF), F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))
        return F.coalesce(known, looked_up({name: chr(code) for name, code in name2codepoint.items()}, inside), reference)

    references = F.array_distinct(F.regexp_extract_all(text, F.lit("(&#[0-9]{1,7};|&#[xX][0-9a-fA-F]{1,6};|&[a-zA-Z][a-zA-Z0-9]*;)"), F.lit(1)))
    done = F.aggregate(references, replaced(text, ENTITIES), lambda t, r: F.replace(t, r, character(r)))
    return F.when(F.contains(text, F.lit("&")), done).otherwise(text)


def clean_name(text: Column | str) -> Column:
    """A name for matching: entities decoded, amounts of money and promotional words cut, digits in one script, single spaces, upper case. Null gives an empty string."""
    t = unescaped(F.coalesce(col(text), F.lit("")))
    t = F.translate(t, *KHMER_DIGITS)
    t = F.regexp_replace(t, r"(?i)(?:US\$|\$|៛)\s*[0-9][0-9,.]*|[0-9][0-9,.]*\s*(?:KHR|USD|riels?|៛|\$)", " ")
    t = F.regexp_replace(t, r"(?i)\b(?:" + "|".join(PROMO_WORDS).replace(" ", r"\s*") + r")\b", " ")
    t = F.regexp_replace(t, r"[ \t\r\n]+", " ")
    return F.upper(F.regexp_replace(t, r"^[ \-–|,.;:!*]+|[ \-–|,.;:!*]+$", ""))


def is_khmer(text: Column | str) -> Column:
    return F.coalesce(col(text), F.lit("")).rlike("[\\u1780-\\u17ff]")


def khmer_tokens(text: Column | str) -> Column:
    return F.regexp_extract_all(F.coalesce(col(text), F.lit("")), F.lit("([\\u1780-\\u17ff]+)"), F.lit(1))


def _is_case(name: Column) -> Column:
    """Whether a name says that it is a case of drinks."""
    case = name.rlike(r"(?i)\b(case|ctn)\b|\((case|ctn)\)") & name.rlike("(?i)(beer|stout|cider|ale|soda|coke|cola|pepsi|water|drink|tea|coffee)")
    return case & ~name.rlike(r"(?i)pencil|trolley|phone|dispenser|brief|stroller|laptop|screen|monitor|cable|charger|tv|case\s*for")


def pack_quantity(size: Column | str, name: Column | str) -> Column:
    """Pieces in a pack: from ``2 x 500ml`` or ``500ml x 2`` in the size, then in the name; a case of drinks is 24; else 1."""
    s, n = F.coalesce(col(size), F.lit("")), F.coalesce(col(name), F.lit(""))
    case = _is_case(n)
    found = [extract(s, MULTIPLE, 1), extract(s, TRAILING, 3), extract(n, MULTIPLE, 1), extract(n, TRAILING, 3), extract(s, MULTIPLE_PIECES, 1)]
    return F.coalesce(*[x.try_cast("double") for x in found], F.when(case, F.lit(24.0)), F.lit(1.0))


def _size_parts(size: Column | str, name: Column | str) -> list[tuple[Column, Column]]:
    s, n = F.coalesce(col(size), F.lit("")), F.coalesce(col(name), F.lit(""))
    order = [(s, MULTIPLE, 2, 3), (s, TRAILING, 1, 2), (s, SINGLE, 1, 2), (n, MULTIPLE, 2, 3), (n, TRAILING, 1, 2), (n, SINGLE, 1, 2), (s, SINGLE_PIECES, 1, 2)]
    return [(extract(text, pattern, value), extract(text, pattern, unit)) for text, pattern, value, unit in order]


def size_value(size: Column | str, name: Column | str) -> Column:
    return F.coalesce(*[v.try_cast("double") for v, _ in _size_parts(size, name)])


def size_unit(size: Column | str, name: Column | str) -> Column:
    """The unit beside the size, as its common name."""
    return unit_name(F.coalesce(*[u for _, u in _size_parts(size, name)], F.lit("")))


def with_sizes(rows: DataFrame, size: str, name: str) -> DataFrame:
    """``rows`` with ``pack_qty``, ``size_value`` and ``size_unit``: the same as the three expressions above, but each pattern is searched once a row, and only in texts with a digit."""
    texts = {f"__{t}": F.when(F.col(c).rlike("[0-9]"), F.col(c)) for t, c in (("s", size), ("n", name))}
    patterns = {"multiple": MULTIPLE, "trailing": TRAILING, "single": SINGLE, "multiple_pieces": MULTIPLE_PIECES, "single_pieces": SINGLE_PIECES}
    wanted = [("s", "multiple"), ("s", "trailing"), ("s", "single"), ("n", "multiple"), ("n", "trailing"), ("n", "single"), ("s", "multiple_pieces"), ("s", "single_pieces")]
    found = rows.withColumns(texts).withColumns({f"__{t}_{p}": F.regexp_extract(f"__{t}", patterns[p], 0) for t, p in wanted})

    def group(t: str, p: str, number: int) -> Column:
        return extract(F.nullif(F.col(f"__{t}_{p}"), F.lit("")), patterns[p], number)

    packs = [("s", "multiple", 1), ("s", "trailing", 3), ("n", "multiple", 1), ("n", "trailing", 3), ("s", "multiple_pieces", 1)]
    sizes = [("s", "multiple", 2), ("s", "trailing", 1), ("s", "single", 1), ("n", "multiple", 2), ("n", "trailing", 1), ("n", "single", 1), ("s", "single_pieces", 1)]
    out = found.withColumns({
        "pack_qty": F.coalesce(*[group(*x).try_cast("double") for x in packs], F.when(_is_case(F.coalesce(F.col(name), F.lit(""))), F.lit(24.0)), F.lit(1.0)),
        "size_value": F.coalesce(*[group(*x).try_cast("double") for x in sizes]), "__unit": F.coalesce(*[group(t, p, g + 1) for t, p, g in sizes], F.lit(""))})
    return out.withColumn("size_unit", unit_name("__unit")).drop("__unit", *texts, *[f"__{t}_{p}" for t, p in wanted])


def looked_up(table: Mapping[str, object], key: Column) -> Column:
    """A constant table's value, or null. The key stands in the plan once, however large the table."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def unit_name(unit: Column | str) -> Column:
    low = F.lower(col(unit))
    return F.coalesce(looked_up({word: name for name, words in UNIT_SYNONYMS.items() for word in words}, low), low)


def unit_price(price: Column | str, value: Column | str, unit: Column | str, packs: Column | str) -> Column:
    """Price of a kilogram or litre; null for other units and sizes not above 0."""
    factor = looked_up({u: f for u, (_, f) in TO_BASE.items()}, col(unit))
    amount = col(value) * F.coalesce(F.nullif(col(packs), F.lit(0.0)), F.lit(1.0)) * factor
    return F.when(col(value) > 0, col(price) / amount)


def _amount(size: Column) -> tuple[Column, Column, Column]:
    """A size text's amount in its base unit, dimension and unit name."""
    unit = unit_name(extract(size, rf"(?i){NUMBER}\s*([a-z]+)", 2))
    value = extract(size, rf"(?i){NUMBER}\s*([a-z]+)", 1).try_cast("double")
    factor, dimension = (looked_up({u: x[i] for u, x in (TO_BASE | LENGTHS).items()}, unit) for i in (1, 0))
    return value * F.coalesce(factor, F.lit(1.0)), dimension, unit


def sizes_agree(a: Column | str, b: Column | str, tolerance: float = 0.10) -> Column:
    """Whether two size texts may be one product's: equal or one unknown; clothing sizes only if equal; within ``tolerance`` of the larger in one dimension or unit."""
    a, b = F.lower(F.trim(col(a))), F.lower(F.trim(col(b)))
    (va, da, ua), (vb, db, ub) = _amount(a), _amount(b)
    clothing = a.isin(*CLOTHING) | b.isin(*CLOTHING)
    near = F.abs(va - vb) <= F.lit(tolerance) * F.greatest(va, vb)
    missing = F.coalesce(a, F.lit("")).isin("") | F.coalesce(b, F.lit("")).isin("")
    alike = F.when(da.isNotNull() & db.isNotNull(), (da == db) & near).otherwise(F.coalesce((ua == ub) & near, F.lit(False)))
    return F.when(missing, True).when(a == b, True).when(clothing, False).otherwise(alike)


def specs(name: Column | str) -> Column:
    """A struct of storage (GB), packs, size, unit, screen (inches) and model code read from a name; nulls where absent."""
    n = F.coalesce(col(name), F.lit(""))
    return F.struct(
        extract(n, r"(?i)\b([0-9]{1,4})\s*(?:GB|TB)\b").try_cast("int").alias("storage"), pack_quantity(F.lit(""), n).alias("packs"), size_value(F.lit(""), n).alias("size"),
        blank_to_null(size_unit(F.lit(""), n)).alias("unit"), extract(n, r"(?i)\b([0-9]{1,2}(?:\.[0-9])?)\s*(?:inch|\"|in\b)").try_cast("double").alias("screen"),
        F.upper(extract(n, r"(?i)\b([a-z]{1,4}-?[0-9]{2,5}[a-z]{0,3})\b(?<![0-9](?:g|kg|ml|l|gb))")).alias("model"))


def hedonic_specs(name: Column | str) -> Column:
    """Memory, storage, screen, camera and 5G of a device, within plausible bounds; 0 where absent or beyond."""
    n = F.coalesce(col(name), F.lit(""))

    def bounded(pattern: str, low: float, high: float) -> Column:
        value = extract(n, pattern).try_cast("double")
        return F.when(value.between(low, high), value).otherwise(0.0)

    gigabytes = F.array_sort(F.transform(F.regexp_extract_all(n, F.lit(r"(?i)\b([0-9]{1,4})\s*GB"), F.lit(1)), lambda x: x.cast("double")))
    memory = F.coalesce(F.array_max(F.filter(gigabytes, lambda x: x.between(1, 24))), F.lit(0.0))
    storage = F.coalesce(F.array_max(F.filter(gigabytes, lambda x: x.between(32, 2048))), F.lit(0.0))
    return F.struct(memory.alias("memory"), storage.alias("storage"), bounded(r"(?i)\b([0-9]{1,2}(?:\.[0-9]{1,2})?)\s*(?:inch|\")", 3, 20).alias("screen"),
                    bounded(r"(?i)\b([0-9]{1,3})\s*MP\b", 2, 250).alias("camera"), n.rlike(r"(?i)\b5G\b").cast("int").alias("is_5g"))


def is_diet(name: Column | str) -> Column:
    return col(name).rlike(r"(?i)\b(zero|diet|light|sugar[- ]free|no sugar)\b")


def specs_agree(a: Column | str, b: Column | str) -> Column:
    """Whether two names may be one product's: no storage, pack, screen, model or size that both state differs, and neither alone is a diet variant.

    Where names meet in pairs, take ``specs`` and ``is_diet`` of each name once before and compare with ``same_specs``. Here a lambda's
    variable holds them, so that each is computed once.
    """
    both = F.struct(specs(a).alias("x"), specs(b).alias("y"), is_diet(a).alias("x_diet"), is_diet(b).alias("y_diet"))
    return F.get(F.transform(F.array(both), lambda p: same_specs(p["x"], p["y"], p["x_diet"], p["y_diet"])), F.lit(0))


def same_specs(x: Column, y: Column, x_diet: Column, y_diet: Column) -> Column:
    differ = [x[f].isNotNull() & y[f].isNotNull() & (x[f] != y[f]) for f in ("storage", "screen", "model")]
    differ.append((x["packs"] != y["packs"]) & (x["packs"] > 1) & (y["packs"] > 1))
    sized = x["size"].isNotNull() & y["size"].isNotNull()
    differ.append(sized & ~sizes_agree(F.concat(x["size"], x["unit"]), F.concat(y["size"], y["unit"])))
    differ.append(x_diet != y_diet)
    return ~F.coalesce(any_of(*[F.coalesce(d, F.lit(False)) for d in differ]), F.lit(False))


def valid_barcode(code: Column | str, placeholders: Sequence[str] = ("123456789012", "1234567890123")) -> Column:
    """4 to 18 digits, not all alike, no placeholder, not ending in eight zeros; false for null."""
    c = F.trim(col(code))
    return F.coalesce(c.rlike(r"^[0-9]{4,18}$") & ~c.rlike(r"^([0-9])\1*$") & ~c.isin(*placeholders) & ~c.endswith("0" * 8), F.lit(False))


def hash_buckets(tokens: Column, size: int = 768) -> Column:
    """Each token's md5 modulo ``size``, from the two halves of its 128 bits."""
    def bucket(token: Column) -> Column:
        digest = F.md5(token.cast("binary"))
        half = lambda i: F.conv(F.substring(digest, i, 16), 16, 10).cast("decimal(20,0)") % size
        return ((half(1) * (2**64 % size) + half(17)) % size).cast("int")

    return F.transform(tokens, bucket)


def split_code(code: Column | str) -> Column:
    """Division, group, class and subclass of a dotted code; deeper parts are null for shorter codes."""
    parts = F.split(col(code), r"\.")
    head = lambda n: F.when(F.size(parts) >= n, F.array_join(F.slice(parts, 1, n), "."))
    return F.struct(F.lpad(head(1), 2, "0").alias("division"), head(2).alias("group"), head(3).alias("class"), head(4).alias("subclass"))


def normal_code(code: Column | str) -> Column:
    """A classifier's code as three parts: more are cut, a third ``0`` is added to two."""
    parts = F.split(F.trim(col(code)), r"\.")
    return F.when(F.size(parts) > 3, F.array_join(F.slice(parts, 1, 3), ".")).when(F.size(parts) == 2, F.concat(F.array_join(parts, "."), F.lit(".0"))).otherwise(F.trim(col(code)))
