"""Mixing sources to target weights, with DataFrame functions only.

Every document gets a random key (MD5 of seed and id) and its source is put in the
order of that key.  The key's leading hex digits cut each source into ranges of the
order, so that a source which holds a third of all rows is many ranges: range totals
(at most ``16 ** SLICE_DIGITS`` per source) are summed up per source, and only inside a
range a window adds up single documents.  A source's budget is cut exactly: whole epochs
first, then the documents up to the budget, the last one in part.

Defined cases: null or empty texts have size 0 and are never taken; a null source is a
source of its own, ordered last; rows with the same id share a key and are ordered by
size (``mixed_documents``: then by row digest), rows equal in all columns may stand for each other; an empty table gives no rows; other
columns aren't read, and ``mixed_documents`` passes them through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, as_struct, from_struct, held, row_digest, whole_text, written

SEED = "mix-1"
SLICE_DIGITS = 3            # 4096 ranges of the random order per source
WEIGHTS = (5.0, 2.0, 1.0)   # by rank of the source, repeating
SHARE = 1.5                 # of all sizes
LIMIT = 2.0                 # of its source's size


def random_key(doc_id: Column, seed: str = SEED) -> Column:
    """Hash-random key of a document, 32 hex digits."""
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")))
                 .cast("binary"))


def sized(docs: DataFrame, seed: str = SEED, digest: Column | None = None) -> DataFrame:
    """doc_id, source as (no_source, src), size in words, random key and its range, and
    ``digest`` where it is given."""
    key = random_key(F.col("doc_id"), seed)
    return docs.select(
        "doc_id", F.col("source").isNull().alias("no_source"),
        F.coalesce("source", F.lit("")).alias("src"),
        F.regexp_count(whole_text("text"), F.lit(WORD)).cast("long").alias("size"),
        key.alias("key"), *([] if digest is None else [digest.alias("digest")])).withColumn("slice", F.substring("key", 1, SLICE_DIGITS))


def ranked_weights(sources: DataFrame, weights=WEIGHTS) -> DataFrame:
    """Weights by the source's place in code point order (null last), repeating.

    One row per source goes through one ordered window.
    """
    place = F.row_number().over(Window.orderBy("no_source", "src")) - 1
    return sources.withColumn("weight", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int")))


def targets(sources: DataFrame, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """Add ``target`` to (no_source, src, source_size, weight).

    The budget (``share`` of all sizes) is dealt by weight; a source stops at ``limit``
    times its size and the excess goes to the others by weight.  In the order of
    limit / weight the stopped sources come first: with the first k stopped, the others
    get ``rate = (budget - their limits) / (other weights)`` per weight, and the smallest k
    whose next source isn't stopped by that rate is the answer.
    """
    by = ["ratio", "no_source", "src"]
    everything = Window.orderBy(*by).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    s = sources.withColumn("most", F.lit(float(limit)) * F.col("source_size"))
    s = s.withColumn("ratio", F.col("most") / F.col("weight"))
    zero = F.lit(0.0)
    s = (s.withColumn("budget", F.lit(float(share)) * F.sum("source_size").over(everything))
          .withColumn("rate", (F.col("budget") - F.coalesce(F.sum("most").over(before), zero))
                      / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), zero)))
          .withColumn("level", F.min(F.when(F.col("rate") <= F.col("ratio"), F.struct(*by, "rate")))
                      .over(everything).getField("rate")))
    return s.withColumn("target", F.least("most", F.coalesce(F.col("level"), F.col("ratio")) * F.col("weight"))) \
            .select("no_source", "src", "source_size", "target")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: float = LIMIT,
        seed: str = SEED, digest: Column | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, epochs: words of each document in
    the mix; ``epochs`` whole copies and ``taken - epochs * size`` words of one more.  A
    ``digest`` of the row orders rows of one id and size, and is returned."""
    more = [] if digest is None else ["digest"]
    docs = written(sized(docs, seed, digest), "mix-sizes")
    src = ["no_source", "src"]
    ranges = written(docs.groupBy(*src, "slice").agg(F.sum("size").alias("in_range")), "mix-ranges")
    plan = targets(ranked_weights(ranges.groupBy(*src).agg(F.sum("in_range").alias("source_size")),
                                  weights), share, limit)
    # the whole part of the target is the budget; limit * size may be several epochs
    plan = plan.withColumn("whole", F.floor("target").cast("long"))
    plan = plan.withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("whole div source_size"))
                           .otherwise(F.lit(0).cast("long")))
    plan = plan.withColumn("rest", F.col("whole") - F.col("epochs") * F.col("source_size"))
    earlier = Window.partitionBy(*src).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("range_start", F.coalesce(F.sum("in_range").over(earlier), F.lit(0).cast("long")))
    ranges = ranges.join(plan, src).drop("in_range")
    inside = Window.partitionBy(*src, "slice").orderBy("key", "size", *more).rowsBetween(Window.unboundedPreceding, 0)
    out = docs.join(ranges, [*src, "slice"]).withColumn("end", F.col("range_start") + F.sum("size").over(inside))
    part = F.greatest(F.lit(0).cast("long"),
                      F.least(F.col("size"), F.col("rest") - (F.col("end") - F.col("size"))))
    return out.select("doc_id", F.when(~F.col("no_source"), F.col("src")).alias("source"), "size",
                      "source_size", "target", (F.col("epochs") * F.col("size") + part).alias("taken"), "epochs", *more)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, with the columns of ``docs``: one row per whole copy, and for the
    document at the cut a row with its first words (white space kept, ``n_chars`` set).

    Each row gets its own copies, by its digest.  Rows equal in all columns are gathered in
    one, which gets the copies of all of them.
    """
    one = ["doc_id", "source", "digest"]
    taken = written(mix(docs, digest=row_digest(docs), **options)
                    .groupBy(*one).agg(F.sum("taken").alias("mix_taken"), F.count(F.lit(1)).alias("mix_rows"))
                    .where(F.col("mix_taken") > 0), "mix-taken")
    names = docs.columns
    row = F.struct("doc_id", "source", F.regexp_count(whole_text("text"), F.lit(WORD)).cast("long").alias("size"),
                   row_digest(docs).alias("digest"), as_struct(names))
    # exploding one row binds the values, whatever expressions the columns of ``docs`` are
    d = docs.select(F.explode(F.array(row)).alias("row")).select("row.*").alias("d")

    def joined(taken: DataFrame) -> DataFrame:
        t = taken.alias("t")
        return d.join(t, F.col("d.doc_id").eqNullSafe(F.col("t.doc_id")) & F.col("d.source").eqNullSafe(F.col("t.source"))
                      & F.col("d.digest").eqNullSafe(F.col("t.digest"))).select("d.*", "mix_taken")

    repeated = taken.where("mix_rows > 1")
    if not repeated.isEmpty():
        d = joined(taken.where("mix_rows = 1")).unionByName(joined(repeated).dropDuplicates(one))
    else:
        d = joined(taken)
    whole, part = F.expr("mix_taken div size"), F.col("mix_taken") % F.col("size")
    # lengths of the copies: whole ones, then the part (if any)
    copies = F.concat(F.array_repeat(F.col("size"), whole.cast("int")),
                      F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<bigint>")))
    d = d.select("doc", "size", F.explode(copies).alias("n"))
    text = held(names, "text")
    cut = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WS_AND_WORD), F.lit(0)), F.lit(1), F.col("n").cast("int")), "")
    in_part = F.col("n") < F.col("size")
    new = {"text": F.when(in_part, cut).otherwise(text)}
    if "n_chars" in names:
        new["n_chars"] = F.when(in_part, F.char_length(cut).cast(docs.schema["n_chars"].dataType)) \
            .otherwise(held(names, "n_chars"))
    return d.select(*from_struct(names, new))


#: A word with the white space before it.
WS_AND_WORD = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"
