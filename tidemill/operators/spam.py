"""Linear spam classification: scoring, ensembles and logistic-regression training.

Instances are ``doc_id, label, features``; a feature may repeat. Models are
``model_id, feature, weight``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.counts import unnested
from tidemill.runtime import attach, cut_lineage, is_small, keep_partitioned, shuffle_partitions

DELTA = 0.002
SHARDS = 256
# Models whose weights of a feature stand in one row, about.
MODELS_PER_BLOCK = 1_000


def is_spam(label: Column) -> Column:
    return F.when(label == "spam", 1).otherwise(0)


def predicted(score: Column) -> Column:
    """``spam`` above 0, else ``ham``."""
    return F.when(score > 0, "spam").otherwise("ham")


def _weighted(instances: DataFrame, model: DataFrame, hot_rows: int | None) -> DataFrame:
    """``doc_id, label`` and, per occurrence of a feature, ``weights``: model -> weight or null."""
    occurrences = instances.select("doc_id", "label", F.explode_outer("features").alias("feature"))
    packed = model.groupBy("feature").agg(F.map_from_entries(F.collect_list(F.struct("model_id", "weight"))).alias("weights"))
    if hot_rows is None and is_small(model):
        # At most SMALL_ROWS entries in all maps together.
        return occurrences.join(F.broadcast(packed), "feature", "left")
    fan = occurrences.groupBy("feature").agg(F.count(F.lit(1)).alias("fan"))
    return attach(occurrences, fan.join(packed, "feature"), ["feature"], ["doc_id"], "fan", how="left", hot_rows=hot_rows)


def scores(
    instances: DataFrame, model: DataFrame, model_ids: Sequence, hot_rows: int | None = None
) -> DataFrame:
    """``doc_id, label, scores``: model -> sum of its weights over all occurrences, unknown ones 0.

    All models are applied in one pass; ``model_ids`` is the list of the ensemble.
    """
    rows = _weighted(instances, model, hot_rows)
    sums = [F.sum(F.coalesce(F.col("weights")[F.lit(m)], F.lit(0.0))) for m in model_ids]
    named = [part for m, s in zip(model_ids, sums) for part in (F.lit(m), s)]
    return rows.groupBy("doc_id", "label").agg(F.create_map(*named).alias("scores"))


def score(instances: DataFrame, model: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """``doc_id, label, score`` by a single model."""
    only = model.select(F.lit(0).alias("model_id"), "feature", "weight")
    return scores(instances, only, [0], hot_rows).select("doc_id", "label", F.col("scores")[F.lit(0)].alias("score"))


def classify(instances: DataFrame, model: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """``doc_id, label, score, prediction`` by a single model."""
    return score(instances, model, hot_rows).withColumn("prediction", predicted(F.col("score")))


def _model_scores(counted: DataFrame, models: DataFrame, size: int, hot_rows: int | None) -> DataFrame:
    """``doc_id, label, model_id, copies, score``: a row per model that knows a feature of a document."""
    key = ["doc_id", "label"]
    if hot_rows is None and is_small(models):
        weighted = counted.join(F.broadcast(models), "feature")
    else:
        # A feature has a row per block of models, so that no row grows with their number.
        blocks = size // MODELS_PER_BLOCK + 1
        block = F.pmod(F.xxhash64("model_id"), F.lit(blocks)).alias("block")
        packed = models.groupBy("feature", block).agg(F.collect_list(F.struct("model_id", "copies", "weight")).alias("members"))
        fan = counted.groupBy("feature").agg(F.count(F.lit(1)).alias("fan"))
        every = F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))
        parts = counted.select(*key, "feature", "k", F.explode(every).alias("block"))
        met = attach(parts, packed.join(fan, "feature"), ["feature", "block"], key, "fan", hot_rows=hot_rows)
        weighted = met.select(*key, "k", F.inline("members"))
    return weighted.groupBy(*key, "model_id", "copies").agg(F.sum(F.col("k") * F.col("weight")).alias("score"))


def ensemble(
    instances: DataFrame,
    models: DataFrame,
    model_ids: Sequence | DataFrame,
    method: str,
    hot_rows: int | None = None,
) -> DataFrame:
    """``doc_id, label, score, prediction``: the mean of the scores, or one vote per model.

    ``model_ids`` lists the ensemble, or is a table ``model_id`` of any length. A model that
    knows no feature of a document scores 0 there, which is a vote for ham. An ensemble without
    models says nothing about any document.

    Models that are absent add nothing to a mean, so the weights of all models are summed per feature
    first and applied like one model. Votes need a score per model; a document without features
    has one empty occurrence, and so stays with no votes for spam.
    """
    if method not in ("average", "vote"):
        raise ValueError(f"neither average nor vote: {method!r}")
    if not isinstance(model_ids, DataFrame):
        kind = models.schema["model_id"].dataType.simpleString()
        model_ids = instances.sparkSession.createDataFrame([(m,) for m in model_ids], f"model_id {kind}")
    members = model_ids.groupBy("model_id").agg(F.count(F.lit(1)).alias("copies"))
    size = model_ids.count()
    known = models.join(members, "model_id")
    if method == "average":
        together = known.groupBy("feature").agg(F.sum(F.col("copies") * F.col("weight")).alias("weight"))
        mean = score(instances, together, hot_rows).filter(F.lit(size > 0)).withColumn("score", F.col("score") / size)
        return mean.withColumn("prediction", predicted(F.col("score")))
    key = ["doc_id", "label"]
    occurrences = instances.select(*key, F.explode_outer("features").alias("feature"))
    counted = occurrences.groupBy(*key, "feature").agg(F.count(F.lit(1)).alias("k")).filter(F.lit(size > 0))
    each = _model_scores(counted.filter(F.col("feature").isNotNull()), known, size, hot_rows)
    ayes = each.select(*key, F.when(F.col("score") > 0, F.col("copies")).otherwise(0).alias("ayes"))
    rows = ayes.unionByName(counted.select(*key, F.lit(0).cast("bigint").alias("ayes")))
    voted = rows.groupBy(*key).agg((2 * F.sum("ayes") - size).cast("double").alias("score"))
    return voted.withColumn("prediction", predicted(F.col("score")))


_WEIGHTS = ["model_id", "shard", "feature", "weight"]


def _one_pass(delta: float):
    """Follow the instances of each (model, shard) in the order they come in.

    A task sees one instance after the other and holds the weights of one shard only.
    """

    def emitted(shard: tuple, weights: dict[int, float]) -> pd.DataFrame:
        made = pd.DataFrame({"feature": np.array(list(weights), np.int32), "weight": np.array(list(weights.values()), float)})
        made["model_id"], made["shard"] = shard
        return made[_WEIGHTS]

    def descend(batches):
        current, weights = None, {}
        for batch in batches:
            for model, shard, spam, features in zip(batch["model_id"], batch["shard"], batch["spam"], batch["features"]):
                if (model, shard) != current:
                    if weights:
                        yield emitted(current, weights)
                    current, weights = (model, shard), {}
                score = math.fsum(weights.get(f, 0.0) for f in features)
                chance = 1.0 / (1.0 + math.exp(-score)) if score > -700 else 0.0
                step = (spam - chance) * delta
                for f in features:
                    weights[f] = weights.get(f, 0.0) + step
        if weights:
            yield emitted(current, weights)

    return descend


def shard_of(doc_id: Column, shards: int) -> Column:
    """Shard of a document: the first 32 bits of the MD5 of its id, modulo ``shards``."""
    return F.pmod(F.conv(F.substring(F.md5(doc_id.cast("string")), 1, 8), 16, 10).cast("bigint"), F.lit(shards)).cast("int")


def train_online(instances: DataFrame, seq: Column, delta: float = DELTA, shards: int = SHARDS) -> DataFrame:
    """Logistic regression by one pass of stochastic gradient descent in the order ``seq``.

    ``instances`` also has ``model_id``; one model is trained for each. Its instances are dealt
    to ``shards`` shards by document, each shard is followed one instance after the other, and
    the weights of the shards that have instances are averaged (Zinkevich et al., "Parallelized
    Stochastic Gradient Descent", NIPS 2010). ``shards`` is the caller's choice and changes the
    model; nothing else about the size or the other models does. One shard follows all
    instances of a model in one task.
    """
    sharded = instances.select(
        F.col("model_id"),
        shard_of(F.col("doc_id"), shards).alias("shard"),
        "doc_id",
        seq.alias("seq"),
        is_spam(F.col("label")).alias("spam"),
        "features",
    )
    kind = instances.schema["model_id"].dataType.simpleString()
    # Dealt by number: no two shards of a model share a partition while others are empty.
    parts = shuffle_partitions(sharded)
    place = F.pmod(F.col("shard") + F.crc32(F.col("model_id").cast("string").cast("binary")), F.lit(parts)).cast("int")
    together = sharded.repartitionById(parts, place)
    trained = together.sortWithinPartitions("model_id", "shard", "seq", "doc_id").mapInPandas(
        _one_pass(delta), f"model_id {kind}, shard int, feature int, weight double"
    )
    # One row per model: the number of its shards that hold instances.
    used = sharded.groupBy("model_id").agg(F.count_distinct("shard").alias("used"))
    # At most one weight per shard, added in a fixed order: the same seed gives the same bits.
    each = F.array_sort(F.collect_list("weight"))
    summed = trained.groupBy("model_id", "feature").agg(F.aggregate(each, F.lit(0.0), lambda a, w: a + w).alias("total"))
    return summed.join(used, "model_id").select("model_id", "feature", (F.col("total") / F.col("used")).alias("weight"))


def shuffled_order(seed: Column | int) -> Column:
    """A repeatable random order of documents."""
    seed = F.lit(seed) if isinstance(seed, int) else seed
    return F.md5(F.concat_ws("|", F.col("doc_id").cast("string"), seed.cast("string")))


def train_shuffled(instances: DataFrame, seed: int, delta: float = DELTA, shards: int = SHARDS) -> DataFrame:
    """``train_online`` in a random order that ``seed`` fixes."""
    return train_online(instances, shuffled_order(seed), delta, shards)


def train_repeatedly(
    instances: DataFrame, seeds: Sequence[int], delta: float = DELTA, shards: int = SHARDS
) -> DataFrame:
    """One shuffled run per seed, all at once; the seed becomes the model id."""
    copies = instances.select(
        F.explode(F.array(*[F.lit(s) for s in seeds])).alias("model_id"), "doc_id", "label", "features"
    )
    return train_online(copies, shuffled_order(F.col("model_id")), delta, shards)


def train_batch(
    instances: DataFrame, epochs: int, delta: float = DELTA, hot_rows: int | None = None
) -> DataFrame:
    """Logistic regression by full-batch gradient steps, the form that scales out.

    Each step adds ``delta`` times the summed residuals of all occurrences of a feature.
    Residuals are summed inside the tasks before the shuffle by feature.
    """
    key = ["model_id", "feature"]
    marked = instances.select("model_id", "doc_id", is_spam(F.col("label")).alias("spam"), "features")

    def count_features(rows: DataFrame) -> DataFrame:
        exploded = rows.select("model_id", "doc_id", "spam", F.explode_outer("features").alias("feature"))
        return unnested(exploded, "feature").groupBy("model_id", "doc_id", "spam", "feature").agg(F.count(F.lit(1)).alias("k"))

    # Laid out by document, so that a step with a broadcast model shuffles gradients only.
    counted = keep_partitioned(marked, "model_id", "doc_id", then=count_features)
    fan = counted.groupBy(*key).agg(F.count(F.lit(1)).alias("fan"))
    model: DataFrame | None = None
    for _ in range(epochs):
        if model is None:
            residual = counted.select(*key, "k", (F.col("spam") - 0.5).alias("residual"))
            before = fan.select(*key, "fan", F.lit(0.0).alias("weight"))
        else:
            if hot_rows is None and is_small(model):
                weighted = counted.join(F.broadcast(model.select(*key, "weight")), key)
            else:
                weighted = attach(counted, model, key, ["doc_id"], "fan", hot_rows=hot_rows)
            per_doc = weighted.groupBy("model_id", "doc_id", "spam").agg(
                F.sum(F.col("k") * F.col("weight")).alias("score"),
                F.collect_list(F.struct("feature", "k")).alias("features"),
            )
            chance = 1 / (1 + F.exp(-F.col("score")))
            residual = per_doc.select(
                "model_id", (F.col("spam") - chance).alias("residual"), F.explode("features").alias("f")
            ).select("model_id", "f.feature", "f.k", "residual")
            before = model
        steps = residual.groupBy(*key).agg((F.sum(F.col("k") * F.col("residual")) * delta).alias("step"))
        model = cut_lineage(
            before.join(steps, key).select(*key, "fan", (F.col("weight") + F.col("step")).alias("weight"))
        )
    if model is None:
        raise ValueError("no epochs")
    return model.select(*key, "weight")
