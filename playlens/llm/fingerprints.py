"""Document fingerprints: bottom-k sketches of shingle hashes.

A shingle is ``WIDTH`` code points at every place of a text (a shorter text is
one shingle).  The sketch of a text is the ``K`` smallest different shingle
hashes, so sketches of parts merge into the sketch of the whole: the smallest
``K`` of both.  From two sketches follow estimates of the texts' resemblance,
of containment, and from one the number of different shingles (exact while
there are fewer than ``K``).

All of it is column expressions.  A text is read in parts that overlap by a
shingle less one, cut by one linear pass of a pattern; of each part's hashes
only those small enough for the sketch are kept, so a text of any length
holds one part's hashes and about one sketch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hashes in a sketch, and code points in a shingle.
K, WIDTH = 128, 8
#: Code points of a part whose hashes are gathered at once.
PART = 4096
#: Bytes of text that are put in order as one range of ids, and the most ranges there are.
RANGE_BYTES, MOST_RANGES = 4 << 20, 16_384

_LEAST_LONG = -(1 << 63)


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _parts(text: Column, width: int) -> Column:
    """Parts that start ``PART`` code points apart and overlap by ``width`` - 1."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{1,{PART + width - 1}}})).{{1,{PART}}}"), F.lit(1))


def _hashes(part: Column, width: int) -> Column:
    """Hashes of the shingles that start in a part."""
    return F.transform(F.regexp_extract_all(part, F.lit(f"(?s)(?=(.{{{width}}}))."), F.lit(1)), lambda s: F.xxhash64(s))


def merge_sketches(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def sketch(text: Column, k: int = K, width: int = WIDTH) -> Column:
    """Bottom-k sketch of a whole text: increasing, different hashes.

    Hashes are even, so of n shingles about 2k fall into the first 2k / n of
    their range: only those are gathered.  A text that repeats itself may have
    fewer than k there; it is gone through again without that bound.  A null
    text is like an empty one: an empty sketch."""
    text = F.coalesce(text, F.lit(""))
    none = F.array().cast("array<bigint>")

    def below(limit):
        found = F.flatten(F.transform(_parts(text, width), lambda p: F.array_distinct(
            F.filter(_hashes(p, width), lambda h: h <= limit))))
        return F.slice(F.sort_array(F.array_distinct(found)), 1, k)

    def take(held, part):
        # once k are held, only smaller hashes can get in
        return merge_sketches(held, F.filter(_hashes(part, width), lambda h: F.coalesce(
            h < F.get(held, F.lit(k - 1)), F.lit(True))), k)

    n = F.length(text) - (width - 1)
    some = F.when(n > 8 * k, (F.lit(2.0 ** 64 * 2 * k) / F.greatest(n, F.lit(1)) - F.lit(2.0 ** 63)).cast("long")
                  ).otherwise(F.lit((1 << 63) - 1))
    whole = _let(_let(some, below), lambda s: F.when((n <= 8 * k) | (F.size(s) == k), s).otherwise(
        F.aggregate(_parts(text, width), none, take)))
    return F.when(F.length(text) == 0, none).when(n < 1, F.array(F.xxhash64(text))).otherwise(whole)


def _share(h: Column) -> Column:
    """Where a hash lies between the least (0) and the greatest (1)."""
    return (h.cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)


def distinct_shingles(s: Column, k: int = K) -> Column:
    """Estimated number of different shingles (exact below k)."""
    full = F.lit(k - 1) / F.greatest(_share(F.get(s, F.lit(k - 1))), F.lit(2.0 ** -64))
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise(full)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles among all of two texts; two empty texts are alike (1)."""
    both = merge_sketches(a, b, k)
    common = F.size(F.array_intersect(both, F.array_intersect(a, b)))
    return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(common / F.greatest(F.size(both), F.lit(1)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has; an empty text lies in every text (1)."""
    both = merge_sketches(a, b, k)
    common = resemblance(a, b, k) * distinct_shingles(both, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), common / F.greatest(distinct_shingles(a, k), F.lit(1.0))))


def as_text(s: Column) -> Column:
    """A sketch as text: 16 hexadecimal digits a hash, in order."""
    return F.array_join(F.transform(s, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def merge_parts(parts: DataFrame, key: str, sketch_col: str, k: int = K) -> DataFrame:
    """``(key, sketch)``: sketches of the parts of each key, merged.

    A key may have any number of parts: their hashes are ranked, and no task
    sends more than k of a key.  A key whose sketches are all empty or null has
    an empty one; a null key is a key."""
    each = parts.select(F.col(key).alias("key"), F.explode_outer(sketch_col).alias("h")).distinct()
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.col("h").asc_nulls_last()))
    least = each.withColumn("place", place).where(F.col("place") <= k)
    return least.groupBy("key").agg(F.sort_array(F.collect_list("h")).alias("sketch")).withColumnRenamed("key", key)


def with_next(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """``(doc_id, text, sketch, next_text, next_sketch)``: each row beside the one with the next larger id.

    After the last row comes the first.  Null ids come first, rows with equal
    ids follow each other by text.  Ids are dealt into ranges of about equal
    size, so texts are shuffled once; the first rows of a range also go, as
    guests, to the end of the range before.  Rows of one id share a range."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(_LEAST_LONG)).alias("key"))
    total, least = rows.agg(F.sum(F.octet_length("text") + 8), F.min("key")).first()
    n = min(MOST_RANGES, max(1, -(-int(total or 0) // RANGE_BYTES)))
    bounds = [_LEAST_LONG if least is None else least]

    def range_of(bounds):
        known = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
        steps = F.array(*[F.lit(1 << j) for j in reversed(range(len(bounds).bit_length()))])
        return F.aggregate(steps, F.lit(0), lambda at, s: F.when(F.get(known, at + s) <= F.col("key"), at + s).otherwise(at)), known

    if n > 1:
        found = rows.agg(F.percentile_approx("key", [i / n for i in range(1, n)], F.lit(max(10_000, 10 * n)))).first()[0]
        bounds = sorted({*bounds, *found})
        # the least id of each range, as it stands in the table
        bounds = sorted(r[0] for r in rows.groupBy(range_of(bounds)[0].alias("g")).agg(F.min("key")).select("min(key)").collect())
    at, known = range_of(bounds)
    home = F.struct(F.col("g").alias("range"), F.lit(False).alias("guest"))
    guest = F.struct(F.pmod(F.col("g") - 1, F.lit(len(bounds))).alias("range"), F.lit(True).alias("guest"))
    first = F.get(known, F.col("g")) == F.col("key")
    dealt = (rows.withColumn("g", at)
             .withColumn("place", F.explode(F.when(first, F.array(home, guest)).otherwise(F.array(home))))
             .select("doc_id", "text", "key", "place.range", "place.guest"))
    order = Window.partitionBy("range").orderBy("guest", "key", "text")
    return (dealt.repartition("range").withColumn("sketch", sketch(F.col("text")))
            .select("doc_id", "text", "sketch", "guest", F.lead("text").over(order).alias("next_text"),
                    F.lead("sketch").over(order).alias("next_sketch"))
            .where(~F.col("guest")).drop("guest"))


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of all whole texts and of their edited texts.

    The last half (rounded down) of a text's code points is replaced by as
    many from the start of the next document's text, or all it has.  Returns
    ``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, n_shingles, contained_in_edited)``, a row per row.
    Null texts are empty; an empty text has an empty fingerprint and is like
    any other empty one; equal texts have equal fingerprints; rows with null or
    equal ids stay; an empty table gives no rows; other columns are not looked
    at."""
    rows = with_next(docs, id_col, text)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = (rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), n - half),
                                                 F.substring("next_text", F.lit(1), half)))
              .withColumn("edited_sketch", sketch(F.col("edited"))))
    own, new, after = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return edited.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        as_text(own).alias("fingerprint"), as_text(new).alias("edited_fingerprint"),
        resemblance(own, new).alias("near_edited"), resemblance(own, after).alias("near_next"),
        distinct_shingles(own).alias("n_shingles"), containment(own, new).alias("contained_in_edited"))
