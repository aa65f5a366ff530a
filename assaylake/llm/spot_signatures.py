"""Document fingerprints by spot signatures: chains of content words that follow common words.

A common word (an anchor) opens a signature made of itself and the next content words. Texts are compared by the Jaccard
similarity of their sets of signatures; sets whose sizes differ too much to be similar are never compared. All of it is
DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assaylake.session import settle

#: Common words of English, French, German and Spanish that serve as anchors.
ANCHORS = (
    "the a an of and to in is it that this was for with as on at by be from are not or",
    "le la les un une de des du et est que qui dans en pour par sur avec au ne pas",
    "der die das und ein eine den dem des ist zu mit von auf für im nicht als auch sich",
    "el los las una de del y que es por para con no se su al lo",
)
#: Content words of a chain.
CHAIN = 3


def anchors() -> list[str]:
    return sorted({w for line in ANCHORS for w in line.split()})


def with_signatures(df: DataFrame, text: str, name: str = "signatures") -> DataFrame:
    """Adds the sorted set of a text's signatures, as 64-bit hashes.

    A text without an anchor is signed by the chains of all its words, a text without words by itself, and an empty or
    null text not at all, so equal texts always have equal signatures.
    """
    common = anchors()
    cut, pairs, content, chains = (f"{name}_{k}_" for k in ("cut", "pairs", "content", "chains"))
    out = df.withColumn(cut, F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), "[^\\p{L}\\p{N}]+", -1))
    before = F.concat(F.array(F.lit("")), F.slice(F.col(cut), 1, F.greatest(F.size(cut) - 1, F.lit(0))))
    paired = F.zip_with(before, F.col(cut), lambda a, w: F.struct(a.alias("before"), w.alias("word")))
    out = out.withColumn(pairs, F.filter(paired, lambda p: (p["word"] != "") & ~p["word"].isin(common)))
    later = [F.slice(F.col(pairs), k + 1, F.greatest(F.size(pairs) - k, F.lit(0))) for k in range(1, CHAIN)]
    out = out.withColumn(content, F.arrays_zip(F.col(pairs), *(x.alias(f"next{k}") for k, x in enumerate(later))))
    spots = F.filter(F.col(content), lambda c: c[pairs]["before"].isin(common))
    out = out.withColumn(chains, spots)
    rest = [f"next{k}" for k in range(len(later))]

    def sign(chain: Column) -> Column:
        return F.xxhash64(chain[pairs]["before"], chain[pairs]["word"], *(chain[r]["word"] for r in rest))

    def sign_plain(chain: Column) -> Column:
        return F.xxhash64(F.lit(""), chain[pairs]["word"], *(chain[r]["word"] for r in rest))

    signed = (
        F.when(F.size(chains) > 0, F.transform(F.col(chains), sign))
        .when(F.size(content) > 0, F.transform(F.col(content), sign_plain))
        .when(F.coalesce(F.col(text), F.lit("")) != "", F.array(F.xxhash64(F.col(text))))
        .otherwise(F.array().cast("array<bigint>"))
    )
    return out.withColumn(name, F.array_sort(F.array_distinct(signed))).drop(cut, pairs, content, chains)


def fingerprint(signatures: Column) -> Column:
    """Signatures as text: hexadecimal, in order, joined by spaces."""
    return F.array_join(F.transform(signatures, lambda s: F.lower(F.lpad(F.hex(s), 16, "0"))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets of signatures; 1 if both are empty, 0 if one is."""
    common = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - common
    return F.when(union == 0, F.lit(1.0)).otherwise(common / union)


def _bounds(docs: DataFrame, key: str, most: int) -> list:
    """Ids that cut the table into at most `most` ranges of similar size."""
    shares = [k / most for k in range(1, most)]
    found = docs.agg(F.percentile_approx(key, shares, 10_000).alias("q")).first()["q"] if shares else []
    return sorted(set(found or []))


def with_next(df: DataFrame, columns: list[str], key: str = "doc_id", tie: str = "tie") -> DataFrame:
    """Adds `next`, a struct of the columns of the row that follows by (key, tie); the first follows the last.

    Rows are dealt to ranges of ids of similar size, each sorted on its own; a copy of the next range's first row, or of
    the first of all, stands at its end. Only range bounds and one id per range reach the driver, at most a thousand.
    """
    ranges = max(1, min(1000, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    bounds = _bounds(df, key, ranges)
    at = F.coalesce(F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= F.col(key))), F.lit(0)) if bounds else F.lit(0)
    rows = df.withColumn("range_", F.when(F.col(key).isNull(), F.lit(-1)).otherwise(at)).withColumn("end_", F.lit(False))
    heads = rows.groupBy("range_").agg(F.min(F.struct(F.col(key), F.col(tie))).alias("head")).orderBy("range_").collect()
    if not heads:
        return df.withColumn("next", F.struct(*columns))
    order = [r["range_"] for r in heads]
    # each range's first row goes to the end of the range before it
    goes = dict(zip(order, [order[-1], *order[:-1]], strict=True))
    first = rows.where(F.col(key).isin([r["head"][key] for r in heads if r["head"][key] is not None]) | F.col(key).isNull())
    whole = F.min_by(F.struct(*df.columns), F.struct(F.col(key), F.col(tie))).alias("row_")
    to = F.create_map(*(F.lit(x) for pair in goes.items() for x in pair))
    ends = first.groupBy("range_").agg(whole).select("row_.*", to[F.col("range_")].alias("range_"), F.lit(True).alias("end_"))
    w = Window.partitionBy("range_").orderBy(F.col("end_"), F.col(key).asc_nulls_first(), F.col(tie))
    following = F.lead(F.struct(*columns)).over(w)
    return rows.unionByName(ends).withColumn("next", following).where(~F.col("end_")).drop("range_", "end_")


def compare_edited(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited text, the signatures of text and edited text, and both likenesses.

    The edited text ends, instead of in its last quarter of code points, in the beginning of the next document. Null
    texts count as empty; null ids come first, equal ids are ordered by their texts' hash; other columns are ignored; an
    empty table gives no rows. The texts are shuffled once.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    follow = with_next(with_signatures(rows, "text"), ["text", "signatures"])
    follow = follow.withColumn("n_chars", F.length("text").cast("bigint"))
    kept = (F.col("n_chars") - F.floor(F.col("n_chars") / 4)).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), kept), F.substring("next.text", F.lit(1), (F.col("n_chars") - kept).cast("int")))
    out = follow.select("doc_id", "n_chars", "signatures", F.col("next.signatures").alias("next_signatures"), edited.alias("edited"))
    out = with_signatures(out, "edited", "edited_signatures")
    return out.withColumn("near_edited", likeness(F.col("signatures"), F.col("edited_signatures"))).withColumn(
        "near_next", likeness(F.col("signatures"), F.col("next_signatures"))
    )


def near_duplicates(signed: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Links (a, b, likeness) between classes of rows with equal signatures that are alike to the threshold or more; a
    and b are the smallest ids of their classes, a < b. signed: doc_id and signatures, ids unique.

    Classes are dealt to partitions by the size of their sets, so that similar sets lie in the same partition or in two
    neighbouring ones; within them, candidates share one of the rare signatures that similar sets cannot both miss, and
    have sizes within the threshold. Empty sets have no links.
    """
    sets = signed.where(F.size("signatures") > 0).groupBy("signatures").agg(F.min("doc_id").alias("id"))
    sets = settle(sets.withColumn("n", F.size("signatures")), "signature-sets")
    df = sets.select(F.explode("signatures").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("df"))
    ranked = sets.select("id", "n", F.explode("signatures").alias("s")).join(df, "s")
    lists = ranked.groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("df", "s"))).alias("order"))
    prefix = F.slice("order", 1, F.col("n") - F.ceil(F.col("n") * threshold).cast("int") + 1)
    part = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1 / threshold)))
    posted = lists.select("id", "n", part.alias("part"), F.explode(prefix).alias("p")).where("p.df > 1")
    posted = posted.select("id", "n", "part", F.col("p.s").alias("s"))
    # the smaller set stays in its partition, the larger one also looks at the partition below
    probe = posted.withColumn("part", F.explode(F.array(F.col("part"), F.col("part") - 1)))
    a, b = posted.alias("a"), probe.alias("b")
    fits = (F.col("a.n") < F.col("b.n")) | ((F.col("a.n") == F.col("b.n")) & (F.col("a.id") < F.col("b.id")))
    pairs = a.join(
        b, (F.col("a.s") == F.col("b.s")) & (F.col("a.part") == F.col("b.part")) & fits & (F.col("a.n") >= threshold * F.col("b.n"))
    ).select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct()
    left = sets.select(F.col("id").alias("a"), F.col("signatures").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("signatures").alias("y"))
    scored = pairs.join(left, "a").join(right, "b").withColumn("likeness", likeness(F.col("x"), F.col("y")))
    return scored.where(F.col("likeness") >= threshold).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "likeness"
    )
