"""Quality rules by tokeniser fertility.

Public vocabularies, read where they are installed, measure each text: characters per token, the share of tokens that fall
back to single bytes, and the entropy of its tokens. Two bands say which values are those of running text: a wide fixed one
per script, and a narrower one per language in its script, whose ends lie some quartile distances beyond the quartiles of
all documents of that language. Quartiles of few documents are drawn towards those of their script, and these towards those
of all documents, by the same weights in tables of any size. Distinct words of a few megabytes are tokenised once and
their counts gathered for all places where they stand, so the metrics are sums over words; both vocabularies split at white
space anyway.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Mapping
from dataclasses import astuple, dataclass
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.store import kept
from basketry.llm.words import PLAIN, U, Words, bounded_batches, chunks, mixed, powers, windows

FOLDER, PIECES, RANKS = "/opt/tokenizers", "piece_bpe_32k.model", "byte_bpe_multi_50k.tiktoken"
CHUNK = 4 << 20
SPREAD, WEIGHT, DIGITS = 4.0, 20, 3  # quartile distances beyond the quartiles; documents that the wider group counts as; digits of the metrics
#: Metrics with the ends of their bands that count, and the least distance of an end from its quartile.
ENDS = {"chars_per_token": (True, True, 0.1), "chars_per_byte_level_token": (True, True, 0.1), "byte_share": (False, True, 0.02), "entropy": (True, False, 0.02)}


@dataclass(frozen=True)
class Band:
    """Running text has at least and at most so many characters per token of the piece vocabulary, at least so many of the byte-level one, at most this share of byte tokens, and at least this entropy (1: all tokens differ)."""

    least_chars: float
    most_chars: float
    least_chars_byte_level: float
    most_byte_share: float
    least_entropy: float


# Bands by script.
BANDS = {
    "latin": Band(1.25, 8.0, 1.25, 0.20, 0.35),
    "greek": Band(0.8, 6.0, 0.6, 0.50, 0.30),
    "cyrillic": Band(1.0, 7.0, 0.8, 0.40, 0.30),
    "arabic": Band(0.7, 6.0, 0.6, 0.50, 0.30),
    "indic": Band(0.3, 5.0, 0.3, 0.80, 0.25),
    "cjk": Band(0.3, 4.0, 0.3, 0.80, 0.30),
    "other": Band(0.3, 8.0, 0.3, 1.00, 0.25),
}
SCRIPTS = list(BANDS)
SYMBOLS = b"#*$%&|<>"


def _script_of_byte() -> np.ndarray:
    """The script that a UTF-8 byte starts a letter of, as an index to SCRIPTS, or len(SCRIPTS)."""
    out = np.full(256, len(SCRIPTS), np.uint8)
    for script, ranges in {"latin": [(65, 91), (97, 123), (0xC3, 0xCA)], "greek": [(0xCE, 0xD0)], "cyrillic": [(0xD0, 0xD4)], "arabic": [(0xD8, 0xDC)], "indic": [(0xE0, 0xE1)], "cjk": [(0xE3, 0xEE)], "other": [(0xCA, 0xCE), (0xD4, 0xD8), (0xDC, 0xE0), (0xE1, 0xE3), (0xEE, 0xF5)]}.items():
        for a, z in ranges:
            out[a:z] = SCRIPTS.index(script)
    return out


SCRIPT_OF, IS_SYMBOL = _script_of_byte(), np.zeros(256, bool)
IS_SYMBOL[list(SYMBOLS)] = True


@cache
def _vocabularies(folder: str):
    """A worker's tokenisers, loaded once."""
    import sentencepiece
    import tiktoken

    pieces = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{PIECES}")
    is_byte = np.array([pieces.is_byte(i) for i in range(pieces.vocab_size())])
    with open(f"{folder}/{RANKS}", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return pieces, is_byte, tiktoken.Encoding("byte-level", pat_str=r"\s?\S+", mergeable_ranks=ranks, special_tokens={})


def _per_row(w: Words, flags: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(flags)]
    return total[w.at[1:]] - total[w.at[:-1]]


def _repeated(row: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes occur twice or more in their row."""
    keys = mixed(hashes + row.astype(U) * U(0x9E3779B97F4A7C15))
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(twice, keys)
    at[at == len(twice)] = 0
    return twice[at] == keys


def _repeat_words(w: Words) -> np.ndarray:
    at, row = np.flatnonzero(w.left() >= 3), w.row_of()
    again = at[_repeated(row[at], windows(w.hashes, 3)[at])]
    covered = np.zeros(len(w.hashes) + 3, bool)
    for i in range(3):
        covered[again + i] = True
    total = np.r_[0, np.cumsum(covered[: len(w.hashes)])]
    return total[w.bounds[1:]] - total[w.bounds[:-1]]


def _dup_lines(w: Words) -> np.ndarray:
    """Lines with a word that are equal to an earlier line of their row."""
    if not len(w.starts):
        return np.zeros(w.rows, np.int64)
    starts = np.unique(np.r_[w.at[:-1][np.diff(w.at) > 0], np.flatnonzero(w.raw == 10) + 1])
    starts = starts[starts < len(w.raw)]
    sizes = np.diff(starts, append=len(w.raw))
    place = np.arange(len(w.raw)) - np.repeat(starts, sizes)
    values = np.where(w.raw == 10, U(0), w.raw.astype(U) + U(1))
    hashes = mixed(np.add.reduceat(values * powers(U(0x9FB21C651E98DF25), int(sizes.max()))[place], starts))
    has_word = np.diff(np.searchsorted(w.starts, np.r_[starts, len(w.raw)])) > 0
    row = np.searchsorted(w.at, starts[has_word], "right") - 1
    keys = np.sort(mixed(hashes[has_word] + row.astype(U) * U(0x9E3779B97F4A7C15)))
    order = np.argsort(mixed(hashes[has_word] + row.astype(U) * U(0x9E3779B97F4A7C15)), kind="stable")
    again = np.zeros(len(order), bool)
    again[order[1:]] = keys[1:] == keys[:-1]
    return np.bincount(row[again], minlength=w.rows)


def _tokens(w: Words, folder: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """By row: tokens of either vocabulary, byte tokens, and the entropy of the pieces over its possible most."""
    zero = np.zeros(w.rows, np.int64)
    if not len(w.hashes):
        return zero, zero, zero, zero.astype(float)
    pieces, is_byte, byte_level = _vocabularies(folder)
    _, first, which = np.unique(w.hashes, return_index=True, return_inverse=True)
    whole = w.raw.tobytes()
    words = [whole[a:z].decode("utf-8", "replace") for a, z in zip(w.starts[first].tolist(), w.ends[first].tolist(), strict=True)]
    ids = pieces.encode(words, num_threads=1)
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.fromiter((x for word in ids for x in word), np.int64, int(sizes.sum()))
    bounds = np.r_[0, np.cumsum(sizes)]
    other = np.fromiter((len(byte_level.encode_ordinary(" " + word)) for word in words), np.int64, len(words))

    row = w.row_of()
    of = np.repeat(np.arange(len(which)), sizes[which])
    entry = np.arange(len(of)) - np.repeat(np.cumsum(sizes[which]) - sizes[which], sizes[which]) + np.repeat(bounds[which], sizes[which])
    token, token_row = flat[entry], row[of]
    n = np.bincount(token_row, minlength=w.rows)
    n_bytes = np.bincount(token_row[is_byte[token]], minlength=w.rows)
    keys = np.sort(token_row * len(is_byte) + token)
    new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    counts = np.diff(new, append=len(keys))
    spread = np.bincount(keys[new] // len(is_byte), weights=counts * np.log2(counts), minlength=w.rows)
    with np.errstate(all="ignore"):
        entropy = np.where(n > 1, (np.log2(n) - spread / n) / np.log2(np.maximum(n, 2)), 0.0)
    return n, np.bincount(row, weights=other[which], minlength=w.rows).astype(np.int64), n_bytes, entropy


def _measure(batches: Iterator[pa.RecordBatch], folder: str, bands: Mapping[str, Band]) -> Iterator[pa.RecordBatch]:
    limits = np.array([astuple(bands[s]) for s in SCRIPTS])
    for batch in batches:
        parts: list[list[np.ndarray]] = []
        for w in chunks(batch.column(1), PLAIN, CHUNK):
            n_words = np.diff(w.bounds)
            in_words = w.data != 0
            chars = _per_row(w, in_words & ((w.raw & 0xC0) != 0x80))
            repeat = _repeat_words(w)
            n, n_other, n_bytes, entropy = _tokens(w, folder)
            kinds = SCRIPT_OF[w.raw]
            script = np.argmax([_per_row(w, kinds == i) for i in range(len(SCRIPTS))], axis=0)
            failed = (n_words < 50) | (100 * repeat > 50 * n_words)
            per, per_other, share = chars / np.maximum(n, 1), chars / np.maximum(n_other, 1), n_bytes / np.maximum(n, 1)
            low, high, low_other, most_bytes, least_entropy = limits[script].T
            good = (per >= low) & (per <= high) & (per_other >= low_other) & (share <= most_bytes) & (entropy >= least_entropy)
            parts.append([n_words, chars, _per_row(w, IS_SYMBOL[w.raw]), _dup_lines(w), repeat, failed, good, script, per, per_other, share, entropy])
        columns = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.zeros(0)] * 12
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [None] + [pa.float64()] * 4
        arrays = [pa.array(c, k) if k else pa.array([SCRIPTS[int(i)] for i in c], pa.string()) for c, k in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *arrays], [c.split()[0] for c in SCHEMA.split(", ")])


SCHEMA = ("doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, in_fixed_band boolean, "
          "script string, chars_per_token double, chars_per_byte_level_token double, byte_share double, entropy double")  # fmt: skip


def language_bands(measured: DataFrame, spread: float = SPREAD, weight: float = WEIGHT) -> DataFrame:
    """``lang, script`` with ``<metric>_low`` and ``<metric>_high`` from all documents that pass the base rules; a null language is a language too.

    The quartiles of a language's ``n`` documents count ``n`` and those of its script ``weight``; those of the script are
    drawn towards the quartiles of all documents alike. Metrics are rounded first, so their counts are small tables and the
    quartiles exact and the same in every run.
    """
    metrics = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.round(m, DIGITS).alias("value")) for m in ENDS]))
    counted = measured.where("NOT base_failed").select("lang", "script", metrics.alias("x")).groupBy("lang", "script", "x.metric", "x.value").agg(F.count("*").alias("n"))
    counted = kept(counted, "metric-counts")

    def quartiles(keys: list[str], name: str) -> DataFrame:
        found = counted.groupBy(*keys, "metric").agg(F.percentile("value", F.array(F.lit(0.25), F.lit(0.75)), F.col("n")).alias("q"), F.sum("n").alias("n"))
        return found.select(*keys, "metric", F.col("q")[0].alias(f"{name}_1"), F.col("q")[1].alias(f"{name}_3"), F.col("n").alias(f"{name}_n"))

    def drawn(own: str, wider: str) -> list[Column]:
        return [((F.col(f"{own}_{i}") * F.col(f"{own}_n") + F.col(f"{wider}_{i}") * F.lit(weight)) / (F.col(f"{own}_n") + F.lit(weight))).alias(f"{own}_{i}") for i in (1, 3)]

    scripts = quartiles(["script"], "wide").join(quartiles([], "all"), "metric").select("script", "metric", *drawn("wide", "all"))
    bands = quartiles(["lang", "script"], "own").join(scripts, ["script", "metric"]).select("lang", "script", "metric", *drawn("own", "wide"))
    ends = []
    for metric, (has_low, has_high, least) in ENDS.items():
        low, high = (F.max(F.when(F.col("metric") == metric, F.col(f"own_{i}"))) for i in (1, 3))
        reach = F.greatest(spread * (high - low), F.lit(least))
        ends += [(low - reach if has_low else F.lit(-np.inf)).alias(f"{metric}_low"), (high + reach if has_high else F.lit(np.inf)).alias(f"{metric}_high")]
    return bands.groupBy("lang", "script").agg(*ends)


def fertility(docs: DataFrame, folder: str = FOLDER, bands: Mapping[str, Band] = BANDS, spread: float = SPREAD, weight: float = WEIGHT) -> DataFrame:
    """One row for each row of ``docs`` (``doc_id``, ``text``, and ``lang`` if there is one): counts, metrics and the verdict ``kept``.

    Words are runs of characters without ASCII white space. ``word_chars``: code points in words; ``n_symbols``: the
    characters ``#*$%&|<>``; ``n_dup_lines``: lines with a word that equal an earlier line; ``n_repeat_words``: words in
    three-word windows that the text holds twice or more; ``base_failed``: fewer than 50 words, or more than half of them
    such; ``kept``: not failed, all metrics inside the fixed band of the script that most letters have (ties: the first of
    ``SCRIPTS``), and inside the band of its language in that script (see ``language_bands``), whether the table is small or
    large. Null and empty texts have no words and fail. Null ids and repeated rows stay; other columns are not read. ``folder`` holds the vocabularies on every machine.
    """
    bounded_batches(docs.sparkSession)
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), lang.alias("lang"))
    measured = own.mapInArrow(partial(_measure, folder=folder, bands=dict(bands)), SCHEMA)
    measured = kept(measured, "fertility")
    # Languages are few: the table is small once written, and Spark broadcasts it by its size.
    limits = kept(language_bands(measured, spread, weight).withColumnsRenamed({"lang": "__lang", "script": "__script"}), "language-bands")
    inside = F.lit(True)
    for metric in ENDS:
        inside &= F.coalesce(F.col(metric).between(F.col(f"{metric}_low"), F.col(f"{metric}_high")), F.lit(True))
    same = F.col("lang").eqNullSafe(F.col("__lang")) & (F.col("script") == F.col("__script"))
    judged = measured.join(limits, same, "left").withColumn("kept", ~F.col("base_failed") & F.col("in_fixed_band") & inside)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lang", "script", *ENDS)
