"""Document fingerprints: SpotSigs, in DataFrame functions only.

A text is lower-cased and reduced to words.  Every word that follows one or
more common words (anchors) starts a spot: the anchor nearest before it, the
word itself and the content words after it, ``CHAIN`` of them in all; the
hash of the spot is a signature.  A text in which no content word follows an
anchor uses every word as the start of a spot, so that only a text without
content words has no signature.  The fingerprint is the sorted set of signatures.

Two sets are alike by their Jaccard coefficient.  It cannot exceed the ratio of
the smaller to the larger set, so pairs whose lengths rule out the wanted
threshold are pruned before the sets are touched (``likeness``).
``near_duplicates`` finds the alike sets of a whole table: it partitions sets by
length, such that a pair that can reach the threshold meets in one of two
neighbouring partitions, and joins only on the few signatures of each set that
a partner must share.  The registered query compares given pairs: each
document with its edited text, and with the next document.

Defined results: a null text counts as empty; texts without words, or of
common words only, have an empty fingerprint, and two empty ones are alike by 1 if compared; null ids
come first in the order of ids, equal ids are ordered by their texts; the
document after the last is the first (a single document follows itself); an
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import read, store

# Frequent function words of English, French, German and Spanish.
ANCHORS = (
    "a an and are as at be but by for from has have he in is it its of on or that the this to was "
    "were which will with "
    "au aux avec ce ces dans de des du elle en est et il la le les leur ne par pas pour que qui se "
    "son sur un une "
    "auf aus bei das dem den der des die ein eine einem einen einer es für im ist mit nicht sich "
    "sie und von zu zum zur "
    "al con del el ella ha las lo los más no o para pero por sin su sus una unos y"
)
#: Content words of a spot.
CHAIN = 3


def with_signatures(rows: DataFrame, text: str, out: str, anchors: str = ANCHORS,
                    chain: int = CHAIN) -> DataFrame:
    """``rows`` and, as ``out``, the sorted distinct signatures (array<bigint>)
    of a text column.  Every array has a select of its own, so that the
    functions over its elements look it up instead of making it anew."""
    common = sorted(set(anchors.split()))
    cols = rows.columns
    rows = rows.select(*cols, F.split(F.lower(text), r"[^\p{L}\p{N}]+").alias("_words"))

    def mark(word: Column, i: Column) -> Column:
        before = F.get("_words", i - 1)
        return (F.when(word.isin(common) | (word == ""), None)
                .when(before.isin(common), F.concat(before, F.lit("^"), word)).otherwise(word))

    rows = rows.select(*cols, F.array_compact(F.transform("_words", mark)).alias("_content"))
    rows = rows.select(*cols, "_content",
                       F.transform("_content", lambda w: F.substring_index(w, "^", -1)).alias("_bare"))

    def spot(word: Column, i: Column) -> Column:
        return F.xxhash64(word, *[F.get("_bare", i + k) for k in range(1, chain)])

    marked = F.array_compact(F.transform(
        "_content", lambda w, i: F.when(F.contains(w, F.lit("^")), spot(w, i))))
    rows = rows.select(*cols, "_content", "_bare", marked.alias("_spots"))
    found = F.when(F.size("_spots") > 0, F.col("_spots")).otherwise(F.transform("_content", spot))
    return rows.select(*cols, F.array_sort(F.array_distinct(found)).alias(out))


def fingerprint(sigs: Column) -> Column:
    """The signatures as one string of hexadecimal numbers."""
    return F.array_join(F.transform(sigs, lambda h: F.lower(F.hex(h))), " ")


def likeness(a: Column, b: Column, at_least: float = 0.0) -> Column:
    """Jaccard coefficient of two signature sets; null where their lengths
    alone keep it below ``at_least``."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    common = F.size(F.array_intersect(a, b))
    value = F.when(large == 0, F.lit(1.0)).when(small == 0, F.lit(0.0)).otherwise(
        common / (F.size(a) + F.size(b) - common))
    return value if at_least <= 0 else F.when(small >= at_least * large, value)


def near_duplicates(rows: DataFrame, threshold: float = 0.8, sigs: str = "sigs") -> tuple[DataFrame, DataFrame]:
    """Links (a, b, likeness) between the representatives of different
    signature sets that are alike by ``threshold`` or more, and the membership
    (id, representative) of rows (id, sigs).  Empty sets link with nothing.

    Sets are partitioned by their length: alike sets are in the same partition
    or in neighbouring ones.  Alike sets also share one of the first
    n - ceil(threshold * n) + 1 signatures of each, taken from the rarest to the
    most frequent, so only those are joined, per partition."""
    named = rows.where(F.size(sigs) > 0).select("id", F.col(sigs).alias("s"))
    sets = named.groupBy("s").agg(F.min("id").alias("rep"))
    each = sets.select("rep", F.explode("s").alias("sig"))
    often = each.groupBy("sig").agg(F.count("*").alias("df")).withColumnRenamed("sig", "sig2")
    ranked = (each.join(often, F.col("sig") == F.col("sig2")).groupBy("rep")
              .agg(F.array_sort(F.collect_list(F.struct("df", "sig"))).alias("o")))
    n = F.size("o")
    prefix = F.slice("o", F.lit(1), (n - F.ceil(n * threshold - 1e-9) + 1).cast("int"))
    part = F.floor(F.log(n) / -math.log(threshold) + 1e-9).cast("int")
    spread = ranked.select("rep", n.alias("n"), part.alias("k"), F.explode(prefix["sig"]).alias("sig"))
    spread = store(spread, "prefixes")
    left = spread.select("sig", F.col("k").alias("key"), F.col("rep").alias("a"), F.col("n").alias("na"),
                         F.col("k").alias("ka"))
    right = spread.select("sig", F.explode(F.array("k", F.col("k") - 1)).alias("key"), F.col("rep").alias("b"),
                          F.col("n").alias("nb"), F.col("k").alias("kb"))
    pairs = (left.join(right, ["sig", "key"])
             .where((F.col("ka") < F.col("kb")) | (F.col("a") < F.col("b")))
             .where(F.least("na", "nb") >= F.greatest("na", "nb") * threshold - 1e-9)
             .select("a", "b").distinct())
    both = (pairs.join(sets.select(F.col("rep").alias("a"), F.col("s").alias("sa")), "a")
            .join(sets.select(F.col("rep").alias("b"), F.col("s").alias("sb")), "b"))
    links = both.select("a", "b", likeness(F.col("sa"), F.col("sb"), threshold).alias("likeness"))
    return links.where(F.col("likeness") >= threshold), named.join(sets, "s").select("id", "rep")


#: Bytes of text that a range of documents is to hold, and the most ranges that a plan
#: names; beyond that product ranges grow, and are sorted with spills.
RANGE_BYTES, MOST_RANGES = 32 << 20, 50_000


def _prefix() -> Column:
    """The first seven bytes of the text as a number, in the order of texts."""
    head = F.rpad(F.hex(F.substring(F.col("text").cast("binary"), 1, 7)), 14, "0")
    return F.conv(head, 16, 10).cast("long")


def _cuts(rows: DataFrame, range_bytes: int) -> list[tuple[int, int, int]]:
    """(0 for null else 1, id, prefix of the text): ascending cuts of the rows'
    order into ranges of about ``range_bytes``.  An id that holds several ranges,
    null included, is cut by the beginnings of its texts."""
    sizes = rows.agg(F.count("*").alias("n"), F.count("id").alias("ids"), F.sum(F.octet_length("text")).alias("b")).first()
    n = min(MOST_RANGES, math.ceil((sizes.b or 0) / range_bytes))
    if n < 2:
        return []
    grid = F.percentile_approx("id", [i / n for i in range(1, n)], 10 * n)
    found = (rows.agg(grid.alias("q")).first().q or []) if sizes.ids else []
    cuts = {(1, i, -1) for i in found}
    if sizes.ids < sizes.n:
        cuts |= {(1, -(1 << 63), -1)} if sizes.ids else set()
    # how many ranges an id holds, rounded up to a power of two: one pass for all of a power
    shares = Counter(found)
    shares[None] = n * (sizes.n - sizes.ids) // sizes.n
    powers: dict[int, list] = {}
    for i, k in shares.items():
        if k > 1:
            powers.setdefault(1 << k.bit_length(), []).append(i)
    for m, ids in powers.items():
        own = [i for i in ids if i is not None]
        hot = F.col("id").isin(own) if None not in ids else F.col("id").isNull() | F.col("id").isin(own)
        grid = F.percentile_approx("prefix", [i / m for i in range(1, m)], 10 * m)
        for r in rows.where(hot).select("id", _prefix().alias("prefix")).groupBy("id").agg(grid.alias("q")).collect():
            cuts |= {(0, 0, p) if r.id is None else (1, r.id, p) for p in r.q or []}
    return sorted(cuts)


def _bucket(cuts: list[tuple[int, int, int]]) -> Column:
    """Number of cuts at or below the row, by binary search."""
    if not cuts:
        return F.lit(0)
    # constants, folded once
    known, ids, heads = (F.split(F.lit(",".join(str(c[k]) for c in cuts)), ",").cast("array<bigint>") for k in range(3))
    given, own = F.col("id").isNotNull().cast("long"), F.coalesce("id", F.lit(0).cast("long"))
    # the texts' beginnings are looked at only where a cut does
    head = _prefix() if any(c[2] >= 0 for c in cuts) else F.lit(0).cast("long")

    def reached(i: Column) -> Column:
        tie = (F.get(ids, i) == own) & (F.get(heads, i) <= head)
        return (F.get(known, i) < given) | ((F.get(known, i) == given) & ((F.get(ids, i) < own) | tie))

    steps = [1 << k for k in range(len(cuts).bit_length() - 1, -1, -1)]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda at, step: F.when((at + step <= len(cuts)) & reached(at + step - 1), at + step).otherwise(at))


def with_next(rows: DataFrame, sigs: str = "sigs", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``rows`` (id, text) with their signatures, and next_text and next_<sigs>
    of the row that follows in the order of ids.

    Rows are dealt to ranges of their order, whose number follows from the bytes
    of the texts, a task to each; inside a range the next row is the next one.  Across ranges only
    the first row of each is looked at.  Rows with the same id whose texts
    begin alike (seven bytes) stay together."""
    spark = rows.sparkSession
    cuts = _cuts(rows, range_bytes)
    bucket = _bucket(cuts)
    rank = F.struct(F.col("id").isNotNull(), "id", "text")
    firsts = store(rows.groupBy(bucket.alias("bucket")).agg(F.min(rank).alias("r"))
                   .select("bucket", "r.text"), "firsts")
    at = sorted(r.bucket for r in firsts.select("bucket").collect())
    follows = spark.createDataFrame([(a, b) for a, b in zip(at, at[1:] + at[:1])], "_from int, _to int")
    heads = with_signatures(follows.join(firsts, F.col("_to") == F.col("bucket")).select("_from", "text"),
                            "text", sigs)
    heads = heads.select("_from", F.struct("text", sigs).alias("_first"))
    order = Window.partitionBy("bucket").orderBy(F.col("id").asc_nulls_first(), "text")
    placed = with_signatures(rows, "text", sigs).withColumn("bucket", bucket).repartitionById(len(cuts) + 1, "bucket")
    inside = placed.select("*", F.lead(F.struct("text", sigs)).over(order).alias("_next"))
    joined = inside.join(heads, (F.col("bucket") == F.col("_from")) & F.col("_next").isNull(), "left")
    found = F.coalesce("_next", "_first")
    return joined.select(*rows.columns, sigs, found["text"].alias("next_text"), found[sigs].alias(f"next_{sigs}"))


def compare_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text (the last quarter
    replaced by the beginning of the next document), and how alike they are."""
    rows = docs.select(F.col(doc_id).cast("long").alias("id"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    pairs = with_next(rows)
    cut = F.floor(F.char_length("text") / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.char_length("text") - cut),
                      F.substring(F.col("next_text"), F.lit(1), cut))
    pairs = with_signatures(pairs.select("id", "text", "sigs", "next_sigs", edited.alias("edited")),
                            "edited", "edited_sigs")
    return pairs.select(
        F.col("id").alias("doc_id"), F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("sigs")).alias("fingerprint"),
        fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"),
        likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
        likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"))


def op8_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edits(read(spark, sf_dir, "documents"))
