"""One-permutation MinHash fingerprints in DataFrame functions alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import stored

#: Bins of a fingerprint, bits kept of each bin's value, words of a shingle.
BINS, BITS, SHINGLE = 128, 8, 5
#: Characters of the documents that one range of ids holds.
RANGE_CHARS = 4_000_000
SPACE = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shingle_hashes(text: Column, k: int = SHINGLE) -> Column:
    """Sorted hashes of all runs of k lower-case words; a text of fewer words has one run, an empty text none."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SPACE), lambda w: w != "")

    def hashes(w: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.size(w) - k), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]))
        return F.when(F.size(w) >= k, runs).when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))

    return F.sort_array(let(words, hashes))


def fingerprint(text: Column, bins: int = BINS, bits: int = BITS) -> Column:
    """Packed low-order bits of the least hash in each bin, as hexadecimal text; '' for a text without words.

    The top bits of a hash name its bin, so one pass over the sorted hashes finds the least of every bin. An empty bin borrows from a
    full one by optimal densification: it takes the first full bin in a random order of its own, the same for all texts.
    """
    if bins & (bins - 1) or bits % 4:
        raise ValueError("bins must be a power of two and bits a multiple of four")
    top = 64 - bins.bit_length() + 1
    bin_of = lambda h: F.shiftrightunsigned(h, top)
    digits = bits // 4

    def packed(hashes: Column) -> Column:
        least = F.filter(hashes, lambda h, i: (i == 0) | (bin_of(h) != bin_of(F.get(hashes, i - 1))))

        def filled(m: Column, full: Column) -> Column:
            def value(b: Column) -> Column:
                own = F.array_position(full, b).cast("int")
                lent = F.get(m, F.array_min(F.transform(full, lambda f, i: F.struct(F.xxhash64(b, f).alias("o"), i.alias("i"))))["i"])
                return let(own, lambda at: F.when(at > 0, F.get(m, at - 1)).otherwise(lent))

            codes = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long")), value)
            return F.array_join(F.transform(codes, lambda h: F.lpad(F.lower(F.hex(h.bitwiseAND(F.lit((1 << bits) - 1)))), digits, "0")), "")

        # the bins of a text are named once, not once for each bin that looks for its own
        return let(least, lambda m: F.when(F.size(m) > 0, let(F.transform(m, bin_of), lambda full: filled(m, full))).otherwise(F.lit("")))

    return let(shingle_hashes(text), packed)


def likeness(a: Column, b: Column, bins: int = BINS, bits: int = BITS) -> Column:
    """The estimated Jaccard similarity of two fingerprints. Unlike bins agree in their low bits by chance once in 2^bits, which is
    taken out: (share - c) / (1 - c), at least 0. Two texts without words are alike (1), one of them is like no other (0)."""
    digits, chance = bits // 4, 2.0 ** -bits
    # of bytes, a place is found without counting the characters before it
    cut = lambda s, i: F.substring(s, i * digits + 1, F.lit(digits))
    alike = lambda x, y: F.filter(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: cut(x, i) == cut(y, i))
    same = F.size(let(a.cast("binary"), lambda x: let(b.cast("binary"), lambda y: alike(x, y))))
    share = (same / F.lit(float(bins)) - chance) / (1 - chance)
    return (F.when((a == "") & (b == ""), 1.0).when((a == "") | (b == ""), 0.0).when(a == b, 1.0).otherwise(F.greatest(F.lit(0.0), share)))


def with_next(docs: DataFrame, columns: list[str], order: str = "doc_id", range_chars: int = RANGE_CHARS, derive: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """next_<c> of the row that follows in descending order of the id (null ids last; equal ids by text hash); after the last row comes
    the first. Rows are dealt to id ranges of like volume; in a range a window looks ahead, and the last row of a range takes the
    first row of the next range that has any, of which there is one per range. derive adds columns that follow from a row alone; it is
    applied to all rows and to those first ones, not to every row once more to find them."""
    total, rows = docs.agg(F.sum(F.length("text")), F.count("*")).first()
    n = max(1, -(-(total or 0) // range_chars), -(-rows // 20_000))
    cuts = docs.approxQuantile(order, [i / n for i in range(1, n)], 0.1 / n) if n > 1 else []
    bounds = F.array(*[F.lit(c) for c in sorted(set(cuts))]) if cuts else F.array().cast("array<double>")
    bucket = F.when(F.col(order).isNull(), -1).otherwise(F.size(F.filter(bounds, lambda c: c < F.col(order))))
    keyed = docs.withColumn("_bucket", bucket).withColumn("_tie", F.xxhash64("text"))
    sort = [F.col(order).desc_nulls_last(), F.col("_tie").asc()]
    inside = Window.partitionBy("_bucket").orderBy(*sort)
    derive = derive or (lambda df: df)
    plain = [c for c in columns if c in keyed.columns]
    ahead = derive(keyed).withColumn("_last", F.lead(F.lit(False), 1, True).over(inside))
    for c in columns:
        ahead = ahead.withColumn(f"next_{c}", F.lead(c).over(inside))
    # of each range the first row: the largest id, then the least hash
    key = F.struct(F.coalesce(-F.col(order), F.lit(0)).alias("k"), F.col("_tie"))
    heads = keyed.groupBy("_bucket").agg(F.min_by(F.struct(*plain), key).alias("head")).select("_bucket", "head.*")
    heads = derive(stored(heads, "firsts")).select("_bucket", F.struct(*columns).alias("head"))
    # one row per range: as many as there are cuts
    turn = Window.orderBy(F.col("_bucket").desc())
    ring = heads.withColumn("_to", F.coalesce(F.lead("head").over(turn), F.first("head").over(turn.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    ring = stored(ring.select("_bucket", "_to"), "heads")
    joined = ahead.join(F.broadcast(ring), "_bucket")
    for c in columns:
        joined = joined.withColumn(f"next_{c}", F.when(F.col("_last"), F.col(f"_to.{c}")).otherwise(F.col(f"next_{c}")))
    return joined.drop("_bucket", "_tie", "_last", "_to")


def edited_fingerprints(docs: DataFrame, bins: int = BINS, bits: int = BITS) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose second half is the beginning of the next document.

    A null text counts as empty; a single document is its own next one; an empty table gives no rows; repeated rows stand beside
    each other. Equal texts have equal fingerprints.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = F.length("text").cast("long")
    half = F.floor(n / 2).cast("int")
    paired = with_next(plain, ["text", "fingerprint"], derive=lambda df: df.withColumn("fingerprint", fingerprint(F.col("text"), bins, bits)))
    edited = F.concat(F.substring("text", F.lit(1), n.cast("int") - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = paired.select("doc_id", n.alias("n_chars"), "fingerprint", F.col("next_fingerprint"), edited.alias("edited"))
    done = rows.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "fingerprint",
                       fingerprint(F.col("edited"), bins, bits).alias("edited_fingerprint"), "next_fingerprint")
    return done.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       likeness(F.col("fingerprint"), F.col("edited_fingerprint"), bins, bits).alias("near_edited"),
                       likeness(F.col("fingerprint"), F.col("next_fingerprint"), bins, bits).alias("near_next"))
