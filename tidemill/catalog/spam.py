"""Spam classification over labelled documents; a document of low quality counts as spam."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.catalog.base import Catalog
from tidemill.catalog.text_sql import cleaned
from tidemill.functions.text import tokenize
from tidemill.operators import spam as P
from tidemill.operators.evaluation import roc_gap
from tidemill.runtime import cut_lineage, scratch_path, spread_input
from tidemill.sources.sinks import write_text
from tidemill.sources.text import parse_instances, read_model

EPOCHS = 3
SEED = 7
SEEDS = (1, 2, 3)
# Two letters of a token give a feature from 0 to 701.
FEATURES = 702

INSTANCES = f"""words AS (SELECT doc_id, lang, unnest({cleaned('text')}) AS term FROM documents),
inst AS (SELECT d.doc_id, d.lang, CASE WHEN quality = 0 THEN 'spam' ELSE 'ham' END AS label,
  CASE WHEN quality = 0 THEN 1 ELSE 0 END AS spam FROM documents d JOIN labels USING (doc_id)),
occ AS (SELECT doc_id, CAST((ascii(term) - 97) * 27 +
  CASE WHEN substr(term, 2, 1) BETWEEN 'a' AND 'z' THEN ascii(substr(term, 2, 1)) - 96 ELSE 0 END AS INTEGER) AS feature
  FROM words JOIN inst USING (doc_id)),
counted AS (SELECT doc_id, inst.lang, spam, feature, count(*) AS k FROM occ JOIN inst USING (doc_id) GROUP BY ALL)"""


def batch_sql(epochs: int, model: str = "'all'") -> str:
    """Epochs of full-batch descent, one block of CTEs each; ``w`` is the model."""
    steps = [f"c AS MATERIALIZED (SELECT {model} AS model_id, doc_id, spam, feature, k FROM counted)",
             "w0 AS (SELECT DISTINCT model_id, feature, 0.0::DOUBLE AS weight FROM c)"]
    for e in range(epochs):
        steps.append(f"s{e} AS (SELECT model_id, doc_id, spam, sum(k * weight) AS score FROM c JOIN w{e} USING (model_id, feature) GROUP BY ALL)")
        steps.append(f"g{e} AS (SELECT model_id, feature, 0.002 * sum(k * (c.spam - 1 / (1 + exp(-score)))) AS step "
                     f"FROM c JOIN s{e} USING (model_id, doc_id) GROUP BY ALL)")
        steps.append(f"w{e + 1} AS MATERIALIZED (SELECT model_id, feature, weight + step AS weight FROM w{e} JOIN g{e} USING (model_id, feature))")
    steps.append(f"w AS MATERIALIZED (SELECT * FROM w{epochs})")
    return f"{INSTANCES}, " + ", ".join(steps)


def online_sql(order: str, seeds: tuple[int, ...] = (0,)) -> str:
    """One pass over every shard in the given order, one instance per step of the recursion;
    ``w`` is the mean of the shards."""
    return f"""{INSTANCES},
    dense AS MATERIALIZED (SELECT doc_id, spam, list(coalesce(k, 0)::DOUBLE ORDER BY feature) AS counts FROM
      (SELECT doc_id, spam, f AS feature FROM inst, range(0, {FEATURES}) r(f)) LEFT JOIN
      (SELECT doc_id, feature, k FROM counted) USING (doc_id, feature) GROUP BY 1, 2),
    run AS MATERIALIZED (SELECT seed, shard, row_number() OVER (PARTITION BY seed, shard ORDER BY {order}) AS i, spam, counts
      FROM (SELECT *, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % {P.SHARDS} AS shard FROM dense),
      (VALUES {', '.join(f'({s})' for s in seeds)}) v(seed)),
    ends AS (SELECT seed, shard, max(i) AS i FROM run GROUP BY 1, 2),
    sgd(seed, shard, i, weights) AS (
      SELECT seed, shard, 0::BIGINT, list_transform(range(0, {FEATURES}), lambda x: 0.0::DOUBLE) FROM ends
      UNION ALL
      SELECT seed, shard, i, list_transform(range(1, {FEATURES + 1}), lambda j: weights[j] + d * counts[j]) FROM
        (SELECT sgd.seed, sgd.shard, run.i, weights, counts, 0.002 * (spam - 1 / (1 + exp(-list_dot_product(weights, counts)))) AS d
         FROM sgd JOIN run ON run.seed = sgd.seed AND run.shard = sgd.shard AND run.i = sgd.i + 1)),
    w AS MATERIALIZED (SELECT seed AS model_id, feature, avg(weight) AS weight FROM
      (SELECT seed, unnest(range(0, {FEATURES})) AS feature, unnest(weights) AS weight FROM sgd JOIN ends USING (seed, shard, i))
      WHERE feature IN (SELECT feature FROM occ) GROUP BY 1, 2)"""


SCORED = """scored AS (SELECT inst.doc_id, label, model_id, coalesce(score, 0.0) AS score FROM inst
  CROSS JOIN (SELECT DISTINCT model_id FROM w) LEFT JOIN
  (SELECT doc_id, model_id, sum(weight) AS score FROM occ JOIN w USING (feature) GROUP BY ALL) USING (doc_id, model_id))"""
GAP = """SELECT 100 * (1 - sum(CASE WHEN s.score > h.score THEN 1.0 WHEN s.score = h.score THEN 0.5 ELSE 0 END) / count(*))"""
ROUNDED = "r AS (SELECT model_id, label, round(score, 9) AS score FROM scored)"


def _instances(t):
    texts = spread_input(t.documents.select("doc_id", "lang", "text"), "doc_id")
    tokens = texts.select("doc_id", "lang", tokenize(F.col("text")).alias("tokens"))

    def number(token):
        one, two = F.substring(token, 1, 1), F.substring(token, 2, 1)
        return (F.ascii(one) - 97) * 27 + F.when(two.between("a", "z"), F.ascii(two) - 96).otherwise(0)

    label = F.when(F.col("quality") == 0, "spam").otherwise("ham")
    return tokens.join(t.labels, "doc_id").select(
        F.lit("all").alias("model_id"), "doc_id", "lang", label.alias("label"), F.transform("tokens", number).alias("features")
    )


def _by_language(t):
    return _instances(t).withColumn("model_id", F.col("lang"))


def _model(t, epochs=EPOCHS):
    return P.train_batch(_instances(t), epochs)


def _rounded(df, column="score", digits=4):
    return df.withColumn(column, F.round(column, digits))


def _ensemble(t, method):
    rows = _by_language(t)
    trained = P.train_batch(rows, EPOCHS)
    # One model per language, however many there are.
    return _rounded(P.ensemble(rows, trained, trained.select("model_id").distinct(), method), digits=6)


def _lines(t):
    rows = _instances(t)
    return rows.select(F.concat_ws(" ", F.col("doc_id").cast("string"), "label", F.col("features").cast("array<string>")).alias("value"))


def _model_round_trip(t):
    path = scratch_path(t.spark, "model")
    write_text(_model(t, 1).select(F.format_string("(%d,%s)", "feature", F.col("weight").cast("string")).alias("value")), path)
    return read_model(t.spark, path, "all")


def _repeated(t):
    rows = _instances(t)
    scored = P.scores(rows, cut_lineage(P.train_repeatedly(rows, SEEDS)), SEEDS)
    flat = scored.select("label", F.explode("scores").alias("model_id", "score"))
    return roc_gap(_rounded(flat, digits=9), "model_id")


def register(catalog: Catalog) -> None:
    add = catalog.add
    add("src_instances",
        lambda t: parse_instances(_lines(t)).select("doc_id", "label", F.explode("features").alias("feature")).groupBy("doc_id", "label", "feature").agg(F.count(F.lit(1)).alias("k")),
        f"""WITH {INSTANCES} SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE WHEN spam = 1 THEN 'spam' ELSE 'ham' END AS label, feature, k FROM counted""")
    add("src_model", lambda t: _rounded(_model_round_trip(t), "weight", 8),
        f"WITH {batch_sql(1)} SELECT model_id, feature, round(weight, 8) AS weight FROM w")
    add("spam_score", lambda t: _rounded(P.score(_instances(t), _model(t))),
        f"WITH {batch_sql(EPOCHS)}, {SCORED} SELECT doc_id, label, round(score, 4) AS score FROM scored")
    add("spam_apply", lambda t: _rounded(P.classify(_instances(t), _model(t))),
        f"WITH {batch_sql(EPOCHS)}, {SCORED} SELECT doc_id, label, round(score, 4) AS score, CASE WHEN score > 0 THEN 'spam' ELSE 'ham' END AS prediction FROM scored")
    add("spam_ensemble_average", lambda t: _ensemble(t, "average"),
        f"""WITH {batch_sql(EPOCHS, 'lang')}, {SCORED}, e AS (SELECT doc_id, label, avg(score) AS score FROM scored GROUP BY ALL)
        SELECT doc_id, label, round(score, 6) AS score, CASE WHEN score > 0 THEN 'spam' ELSE 'ham' END AS prediction FROM e""")
    add("spam_ensemble_vote", lambda t: _ensemble(t, "vote"),
        f"""WITH {batch_sql(EPOCHS, 'lang')}, {SCORED}, e AS (SELECT doc_id, label, CAST(sum(CASE WHEN score > 0 THEN 1 ELSE -1 END) AS DOUBLE) AS score FROM scored GROUP BY ALL)
        SELECT doc_id, label, score, CASE WHEN score > 0 THEN 'spam' ELSE 'ham' END AS prediction FROM e""")
    add("spam_train_online", lambda t: _rounded(P.train_online(_instances(t), F.col("doc_id")).drop("model_id"), "weight", 8),
        f"WITH RECURSIVE {online_sql('doc_id')} SELECT CAST(feature AS INTEGER) AS feature, round(weight, 8) AS weight FROM w")
    add("spam_train_shuffled", lambda t: _rounded(P.train_shuffled(_instances(t), SEED).drop("model_id"), "weight", 8),
        f"WITH RECURSIVE {online_sql(f'''md5(doc_id || '|' || {SEED})''')} SELECT CAST(feature AS INTEGER) AS feature, round(weight, 8) AS weight FROM w")
    add("spam_train_batch", lambda t: _rounded(P.train_batch(_by_language(t), EPOCHS), "weight", 8),
        f"WITH {batch_sql(EPOCHS, 'lang')} SELECT model_id, feature, round(weight, 8) AS weight FROM w")
    add("spam_repeat_shuffle", lambda t: _rounded(_repeated(t), "roc_gap", 6),
        f"""WITH RECURSIVE {online_sql("md5(doc_id || '|' || seed)", SEEDS)}, {SCORED}, {ROUNDED}
        SELECT model_id, round(gap, 6) AS roc_gap FROM (SELECT s.model_id, {GAP.removeprefix('SELECT ')} AS gap
        FROM r s JOIN r h USING (model_id) WHERE s.label = 'spam' AND h.label = 'ham' GROUP BY 1)""")
    add("spam_eval", lambda t: _rounded(roc_gap(_rounded(P.score(_instances(t), _model(t)), digits=9)), "roc_gap", 6),
        f"""WITH {batch_sql(EPOCHS)}, {SCORED}, {ROUNDED} SELECT round(({GAP} FROM r s, r h WHERE s.label = 'spam' AND h.label = 'ham'), 6) AS roc_gap""")
