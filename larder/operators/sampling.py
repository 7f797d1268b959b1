"""Training samples: positives, popularity, negatives, split, triples.

Every draw is a hash of (seed, epoch, item, attribute, slot). A negative is drawn
straight from the complement of the item's attributes: the drawn offset is moved
past the attributes the item has, so nothing is rejected and no list of the other
attributes is built.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from ..functions.hashing import hash_hex
from ..session import materialize
from .ranking import with_global_rank, with_running_total

POINTS_PER_ROW = 4096
SHARD_ROWS = 4096


def positive_samples(item_attrs: DataFrame, item_vectors: DataFrame, attr_vectors: DataFrame) -> DataFrame:
    """(item_id, attr_id) of the map rows that have both an item and an attribute vector."""
    pairs = item_attrs.select(F.col("upc_nbr").alias("item_id"), "attr_id")
    return pairs.join(attr_vectors.select("attr_id"), "attr_id", "left_semi").join(
        item_vectors.select("item_id"), "item_id", "left_semi"
    ).select("item_id", "attr_id")


def item_profiles(positives: DataFrame) -> DataFrame:
    """(item_id, attrs array<string>): sorted attributes of each item."""
    return positives.groupBy("item_id").agg(F.array_sort(F.collect_set("attr_id")).alias("attrs"))


def attribute_popularity(item_attrs: DataFrame, attr_vectors: DataFrame) -> DataFrame:
    """(attr_id, n_rows, probability) of every attribute that has a vector; 1 where the map has none."""
    counts = item_attrs.groupBy("attr_id").agg(F.count(F.lit(1)).alias("n"))
    weighted = attr_vectors.select("attr_id").join(counts, "attr_id", "left").select(
        "attr_id", F.coalesce("n", F.lit(1)).cast("bigint").alias("n_rows")
    )
    total = weighted.agg(F.sum("n_rows")).scalar()
    return weighted.withColumn("probability", F.col("n_rows") / total)


def train_val_split(item_vectors: DataFrame, train_ratio: float = 0.8, seed: int = 42) -> DataFrame:
    """(item_id, split): the first floor(n * train_ratio) items in hash order are 'train', the rest 'val'."""
    ids = item_vectors.select("item_id")
    n = ids.agg(F.count(F.lit(1))).scalar()
    order = F.concat_ws("|", hash_hex(F.lit(seed), F.col("item_id")), F.col("item_id"))
    ranked = with_global_rank(ids, order, "_rank")
    is_train = F.col("_rank") < F.floor(n * F.lit(float(train_ratio)))
    return ranked.select("item_id", F.when(is_train, "train").otherwise("val").alias("split"))


def _draws(total: str, k: int, seed: int, epoch: int) -> str:
    """For profile entry p of the row's item: k offsets below `total`."""
    key = f"concat_ws('|', '{seed}', '{epoch}', item_id, p.attr_id, s)"
    return (
        f"transform(sequence(0, {k} - 1), s -> "
        f"cast(conv(substr(md5({key}), 1, 15), 16, 10) AS bigint) % greatest({total}, 1))"
    )


def indexed_profiles(positives: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """One row per item: its attributes as sorted (idx, attr_id) entries, and what the draws need.

    vocabulary is (attr_id, idx) with idx from 0. A profile is at most the vocabulary.
    """
    size = vocabulary.agg(F.count(F.lit(1))).scalar()
    return (
        positives.join(vocabulary.select("attr_id", "idx"), "attr_id")
        .groupBy("item_id")
        .agg(F.array_sort(F.collect_set(F.struct("idx", "attr_id"))).alias("profile"))
        .withColumn("vocab_size", size)
        .withColumn("gaps", F.expr("transform(profile, (x, j) -> x.idx - j)"))
        .withColumn("steps", F.expr(halving_steps("profile")))
        .withColumn("free", F.expr("vocab_size - size(profile)"))
    )


def halving_steps(array: str) -> str:
    """Powers of two down to 1 with which places_up_to() reaches any place of a non-empty array."""
    return f"transform(sequence(length(bin(size({array}))) - 1, 0, -1), e -> shiftleft(1, e))"


def places_up_to(value: str) -> str:
    """How many entries of a sorted array are at most r, by binary search over `steps`; value: the entry that `at + s` places end with."""
    return f"aggregate(steps, 0, (at, s) -> if({value} <= r, at + s, at))"


def uniform_draws(k: int, seed: int, epoch: int) -> str:
    """For profile entry p: k vocabulary indices of attributes the item lacks; of any when it has all."""
    shifted = f"r -> r + {places_up_to('get(gaps, at + s - 1)')}"
    return (
        f"if(free = 0, {_draws('vocab_size', k, seed, epoch)}, "
        f"transform({_draws('free', k, seed, epoch)}, {shifted}))"
    )


def uniform_negative_indices(
    positives: DataFrame, vocabulary: DataFrame, k: int = 5, seed: int = 42, epoch: int = 0
) -> DataFrame:
    """(item_id, attr_id, idx, neg_idx array<bigint>): k negatives per positive, by vocabulary index."""
    draws = uniform_draws(k, seed, epoch)
    triples = f"inline(transform(profile, p -> struct(p.attr_id AS attr_id, p.idx AS idx, {draws} AS neg_idx)))"
    return indexed_profiles(positives, vocabulary).select("item_id", F.expr(triples))


def _named(drawn: DataFrame, vocabulary: DataFrame) -> DataFrame:
    names = vocabulary.select(F.col("idx").alias("neg"), F.col("attr_id").alias("neg_attr"))
    return drawn.join(names, "neg").select("item_id", "attr_id", "slot", "neg_attr")


def uniform_negatives(
    positives: DataFrame, attr_vectors: DataFrame, k: int = 5, seed: int = 42, epoch: int = 0
) -> DataFrame:
    """(item_id, attr_id, slot, neg_attr): every attribute the item lacks is equally likely."""
    vocabulary = with_global_rank(attr_vectors.select("attr_id"), F.col("attr_id"), "idx")
    drawn = uniform_negative_indices(positives, vocabulary, k, seed, epoch)
    return _named(drawn.select("item_id", "attr_id", F.posexplode("neg_idx").alias("slot", "neg")), vocabulary)


def popularity_negatives(
    positives: DataFrame, popularity: DataFrame, k: int = 5, seed: int = 42, epoch: int = 0
) -> DataFrame:
    """(item_id, attr_id, slot, neg_attr): attributes the item lacks, in proportion to n_rows.

    Weights are laid end to end in attribute order. A drawn point finds its attribute by an equi-join on stretches of points, so that
    neither popular nor rare attributes gather candidates.
    """
    laid = with_running_total(popularity, F.col("attr_id"), F.col("n_rows"), "start")
    total = popularity.agg(F.sum("n_rows")).scalar()
    upto = Window.partitionBy("item_id").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    entries = positives.distinct().join(laid.select("attr_id", "start", "n_rows"), "attr_id").withColumn(
        "after", F.sum("n_rows").over(upto)
    ).withColumn("limit", F.col("start") - F.col("after") + F.col("n_rows"))
    profiles = (
        entries.groupBy("item_id")
        .agg(
            F.array_sort(F.collect_list(F.struct("limit", "after", "attr_id"))).alias("profile"),
            F.sum("n_rows").alias("held"),
        )
        .withColumn("total", total)
        .withColumn("free", F.col("total") - F.col("held"))
        .withColumn("steps", F.expr(halving_steps("profile")))
    )
    shifted = f"r -> r + coalesce(get(profile, {places_up_to('get(profile, at + s - 1).limit')} - 1).after, 0L)"
    points = (
        f"if(free = 0, {_draws('total', k, seed, epoch)}, transform({_draws('free', k, seed, epoch)}, {shifted}))"
    )
    drawn = profiles.select(
        "item_id", F.expr(f"inline(transform(profile, p -> struct(p.attr_id AS attr_id, {points} AS points)))")
    ).select("item_id", "attr_id", F.posexplode("points").alias("slot", "r"))

    # A row a stretch of points: its attributes in order, in which a draw finds its own by a binary search. A popular attribute has a
    # row a stretch, not one a map row, and a stretch of rare ones holds no more of them than points. Written, so that Spark sees its size.
    last = f"(start + n_rows - 1) div {POINTS_PER_ROW}"
    stretches = materialize(
        laid.where("n_rows > 0")
        .select(F.struct("start", F.col("attr_id").alias("neg_attr")).alias("entry"), F.expr(f"explode(sequence(start div {POINTS_PER_ROW}, {last}))").alias("stretch"))
        .groupBy("stretch").agg(F.array_sort(F.collect_list("entry")).alias("entries"))
    )
    found = F.expr(f"get(entries, {places_up_to('get(entries, at + s - 1).start')} - 1).neg_attr").alias("neg_attr")
    met = drawn.withColumn("stretch", F.expr(f"r div {POINTS_PER_ROW}")).join(stretches, "stretch")
    return met.withColumn("steps", F.expr(halving_steps("entries"))).select("item_id", "attr_id", "slot", found)


def sample_negatives(
    positives: DataFrame, popularity: DataFrame, k: int = 5, strategy: str = "random", seed: int = 42, epoch: int = 0
) -> DataFrame:
    """Negatives by strategy: 'popularity', anything else is uniform."""
    draw = popularity_negatives if strategy == "popularity" else uniform_negatives
    return draw(positives, popularity, k, seed, epoch)


def training_triples(
    item_attrs: DataFrame,
    item_vectors: DataFrame,
    attr_vectors: DataFrame,
    train_ratio: float = 0.8,
    negatives_per_pos: int = 5,
    seed: int = 42,
    epoch: int = 0,
) -> DataFrame:
    """(split, item_id, pos_attr, neg_attrs array<string>) of the train and validation items."""
    split = train_val_split(item_vectors, train_ratio, seed)
    positives = positive_samples(item_attrs, item_vectors, attr_vectors)
    drawn = uniform_negatives(positives, attr_vectors, negatives_per_pos, seed, epoch)
    triples = drawn.groupBy("item_id", F.col("attr_id").alias("pos_attr")).agg(
        F.array_sort(F.collect_list(F.struct("slot", "neg_attr")))["neg_attr"].alias("neg_attrs")
    )
    return triples.join(split, "item_id").select("split", "item_id", "pos_attr", "neg_attrs")


def shard_vectors(triples: DataFrame, attr_vectors: DataFrame, shards: int) -> tuple[DataFrame, DataFrame]:
    """The triples with their `shard`, a hash of the item, and (shard, attr_id, vector): each attribute that a shard draws, once."""
    sharded = triples.withColumn("shard", F.pmod(F.xxhash64("item_id"), F.lit(shards)))
    drawn = sharded.select("shard", F.explode(F.concat(F.array("pos_attr"), "neg_attrs")).alias("attr_id")).distinct()
    return sharded, drawn.join(attr_vectors.select("attr_id", "vector"), "attr_id").select("shard", "attr_id", "vector")


def attach_vectors(
    triples: DataFrame, item_vectors: DataFrame, attr_vectors: DataFrame, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """Add item, positive and negative vectors to (item_id, pos_attr, neg_attrs) rows; those without a positive's vector go,
    and negatives without one are left out.

    A vector travels once to each shard of about `shard_rows` triples that draws it, not once to each draw.
    """
    triples = triples.select("item_id", "pos_attr", "neg_attrs")
    shards = max(1, -(-triples.count() // shard_rows))
    sharded, fetched = shard_vectors(triples, attr_vectors, shards)
    vector = fetched.schema["vector"].dataType
    schema = StructType([*triples.schema.fields, StructField("pos_vector", vector), StructField("neg_vectors", ArrayType(vector))])

    def look_up(rows: pa.Table, known: pa.Table) -> pa.Table:
        ids, vectors = (known.column(c).combine_chunks() for c in ("attr_id", "vector"))
        rows = rows.select(["item_id", "pos_attr", "neg_attrs"])
        rows = rows.filter(pc.is_in(rows.column("pos_attr"), ids)).combine_chunks()
        negatives = rows.column("neg_attrs").combine_chunks()
        at = pc.index_in(negatives.flatten(), ids)
        upto = np.concatenate([[0], np.cumsum(np.asarray(pc.is_valid(at)))])
        ends = upto[np.concatenate([[0], np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(negatives), 0)))])]
        neg_vectors = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), vectors.take(at.drop_null()))
        pos_vector = vectors.take(pc.index_in(rows.column("pos_attr").combine_chunks(), ids))
        return rows.append_column("pos_vector", pos_vector).append_column("neg_vectors", neg_vectors)

    met = sharded.groupBy("shard").cogroup(fetched.withColumnRenamed("shard", "of").groupBy("of")).applyInArrow(look_up, schema)
    return met.join(item_vectors.select("item_id", F.col("vector").alias("item_vector")), "item_id")
