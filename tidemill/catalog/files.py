"""Text files as input: the tables are written as text first, then only the files are read."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.catalog import text_sql as S
from tidemill.catalog.base import Catalog
from tidemill.catalog.graphs import _lineitem_lines
from tidemill.catalog.spam import EPOCHS, INSTANCES, SCORED, _by_language, _instances, _lines, _rounded, batch_sql, online_sql
from tidemill.operators import counts as N
from tidemill.operators import spam as P
from tidemill.runtime import scratch_path
from tidemill.sources.sinks import write_models
from tidemill.sources.text import lines, read_adjacency, read_instances, read_lines, read_models


def _as_files(t, rows) -> str:
    path = scratch_path(t.spark, "text-files")
    rows.write.text(path)
    return path


def _text_files(t):
    return read_lines(t.spark, _as_files(t, lines(t.documents).select(F.col("line").alias("value"))))


def _stored(t, models):
    path = scratch_path(t.spark, "models")
    write_models(models, path)
    return read_models(t.spark, path)


def _stored_ensemble(t, method: str):
    """Train a model per language, store them as text, then apply all that are found there."""
    models = _stored(t, P.train_batch(_by_language(t), EPOCHS))
    return _rounded(P.ensemble(_instances(t), models, models.select("model_id").distinct(), method), digits=6)


def register(catalog: Catalog) -> None:
    add = catalog.add
    add("lines_of_files", lambda t: _text_files(t).groupBy("line").agg(F.count(F.lit(1)).alias("n")),
        f"WITH {S.LINES} SELECT line, count(*) AS n FROM lines GROUP BY line")
    add("word_count_of_files", lambda t: N.word_count(_text_files(t)), f"WITH {S.WORDS} SELECT term, count(*) AS n FROM words GROUP BY 1")
    add("adjacency_of_files",
        lambda t: read_adjacency(t.spark, _as_files(t, _lineitem_lines(t))).select("id", F.explode_outer("neighbors").alias("dst")).fillna(-1),
        """SELECT l_orderkey AS id, l_partkey AS dst FROM lineitem UNION ALL SELECT l_orderkey, l_suppkey FROM lineitem
        UNION ALL SELECT c_custkey, -1 FROM customer""")
    add("instances_of_files",
        lambda t: read_instances(t.spark, _as_files(t, _lines(t))).select("doc_id", "label", F.explode("features").alias("feature")).groupBy("doc_id", "label", "feature").agg(F.count(F.lit(1)).alias("k")),
        f"WITH {INSTANCES} SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE WHEN spam = 1 THEN 'spam' ELSE 'ham' END AS label, feature, k FROM counted")
    add("spam_stored_ensemble", lambda t: _stored_ensemble(t, "average"),
        f"""WITH {batch_sql(EPOCHS, 'lang')}, {SCORED}, e AS (SELECT doc_id, label, avg(score) AS score FROM scored GROUP BY ALL)
        SELECT doc_id, label, round(score, 6) AS score, CASE WHEN score > 0 THEN 'spam' ELSE 'ham' END AS prediction FROM e""")
    add("spam_stored_vote", lambda t: _stored_ensemble(t, "vote"),
        f"""WITH {batch_sql(EPOCHS, 'lang')}, {SCORED}, e AS (SELECT doc_id, label, CAST(sum(CASE WHEN score > 0 THEN 1 ELSE -1 END) AS DOUBLE) AS score FROM scored GROUP BY ALL)
        SELECT doc_id, label, score, CASE WHEN score > 0 THEN 'spam' ELSE 'ham' END AS prediction FROM e""")
    add("spam_stored_online", lambda t: _rounded(P.classify(_instances(t), _stored(t, P.train_online(_instances(t), F.col("doc_id"))).drop("model_id"))),
        f"""WITH RECURSIVE {online_sql('doc_id')}, {SCORED} SELECT doc_id, label, round(score, 4) AS score,
        CASE WHEN score > 0 THEN 'spam' ELSE 'ham' END AS prediction FROM scored""")
