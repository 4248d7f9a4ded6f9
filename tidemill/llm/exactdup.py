"""Exact duplicates by skew-safe combining.

Equal texts meet in three steps: inside a partition, inside one salt of a digest, and between
the salt winners of a digest. Every step sorts its rows by digest and full content and compares
neighbors byte by byte, so a digest only brings rows together. The winner of a run of equal
rows is the row with the largest id; it alone goes on. A text that fills a third of the table
therefore reaches a later step at most once per partition, then at most once per salt. Between
the first two steps digests are counted: content whose digest only one partition has is alone
and takes no further step.

Rows travel with their content compressed. The compressor is deterministic and lossless, so
two compressed contents are equal exactly when the texts are.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.shared import small, stored, utf8
from tidemill.runtime import shuffle_partitions

SALTS = 64
# Content held by one task while it deduplicates locally; a fuller table is emptied and begun
# anew, which only leaves more rows to the later steps.
LOCAL_BYTES = 16 << 20

_LOCAL = pa.schema(
    [("doc_id", pa.int64()), ("uid", pa.int64()), ("winner", pa.int64()), ("top", pa.int64()),
     ("digest", pa.binary()), ("body", pa.binary())]
)
_MERGED = pa.schema([("uid", pa.int64()), ("winner", pa.int64()), ("top", pa.int64()), ("digest", pa.binary()), ("body", pa.binary())])
_TYPES = {pa.int64(): "bigint", pa.binary(): "binary"}


def _spark_schema(schema: pa.Schema) -> str:
    return ", ".join(f"{field.name} {_TYPES[field.type]}" for field in schema)


def _rank(doc_id, uid) -> tuple:
    """The larger ``doc_id`` wins, a null one loses; of equal ids the larger row number wins."""
    return (doc_id is not None, doc_id or 0, uid)


def _local(local_bytes: int):
    """Per row its winner inside this partition; the winner's row carries the content."""

    def run(batches):
        first = TaskContext.get().partitionId() << 33
        uid, held, groups = first, 0, {}
        press = zstandard.ZstdCompressor(level=1)

        def emptied():
            rows = []
            for (digest, body), members in groups.items():
                best = max(members, key=lambda m: _rank(*m))
                for doc_id, number in members:
                    mine = number == best[1]
                    rows.append((doc_id, number, best[1], best[0] if mine else None, digest if mine else None, body if mine else None))
            groups.clear()
            columns = list(zip(*rows)) or [()] * len(_LOCAL)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _LOCAL)], schema=_LOCAL)

        for batch in small(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                key = (hashlib.sha256(text).digest(), press.compress(text))
                members = groups.get(key)
                if members is None:
                    groups[key] = [(doc_id, uid)]
                    held += len(key[1]) + 200
                else:
                    members.append((doc_id, uid))
                    held += 100
                uid += 1
                if held > local_bytes:
                    yield emptied()
                    held = 0
        if groups:
            yield emptied()

    return run


def _merged(batches):
    """Winner of every run of equal content; rows come sorted with the best of a run first."""
    content, winner = None, None
    for batch in small(batches):
        uids, tops, digests, bodies = (batch.column(i).to_pylist() for i in range(4))
        out_winner, out_top, out_digest, out_body = [], [], [], []
        for uid, top, digest, body in zip(uids, tops, digests, bodies):
            mine = content != (digest, body)
            if mine:
                content, winner = (digest, body), uid
            out_winner.append(winner)
            out_top.append(top if mine else None)
            out_digest.append(digest if mine else None)
            out_body.append(body if mine else None)
        columns = (uids, out_winner, out_top, out_digest, out_body)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _MERGED)], schema=_MERGED)


def _combine(winners: DataFrame, *keys) -> DataFrame:
    """One step: rows of one key meet in a task, sorted by content, the best of a run first."""
    met = winners.repartition(shuffle_partitions(winners), *keys).sortWithinPartitions(
        "digest", "body", F.desc_nulls_last("top"), F.desc("uid")
    )
    return met.select("uid", "top", "digest", "body").mapInArrow(_merged, _spark_schema(_MERGED))


def exact_duplicates(docs: DataFrame, salts: int = SALTS, local_bytes: int = LOCAL_BYTES) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``: one row per row of ``docs``.

    Rows are equal when their texts are identical; null counts as the empty text. The row with
    the largest ``doc_id`` of a group stays. A null ``doc_id`` is smaller than any other; where
    several rows have the largest one, exactly one of them is kept. Columns other than
    ``doc_id`` and ``text`` are not read. An empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    local = stored(rows.mapInArrow(_local(local_bytes), _spark_schema(_LOCAL)), "copies-local")
    going = local.filter(F.col("uid") == F.col("winner"))
    # Content whose digest no other local winner has meets nothing; it stays where it is.
    shared = going.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Stored, so that both sides of the join come straight from a shuffle and a hot digest can be
    # split. Merged, so that it is the same join at every size.
    shared = stored(shared.select("digest"), "shared-digests").hint("merge")
    contested = going.join(shared, "digest", "left_semi")
    salt = F.pmod(F.xxhash64("uid"), F.lit(salts))
    salted = stored(_combine(contested, F.col("digest"), salt), "copies-salted")
    final = stored(_combine(salted.filter(F.col("uid") == F.col("winner")), F.col("digest")).drop("body"), "copies-final")
    # Winner of each row: local winner, then salt winner, then overall winner.
    sha = F.lower(F.hex("digest")).alias("text_sha256")
    named = final.join(
        final.filter(F.col("uid") == F.col("winner")).select(F.col("winner"), F.col("top").alias("keep_id"), sha), "winner"
    ).select(F.col("uid").alias("salt_winner"), F.col("winner").alias("keeper"), "keep_id", "text_sha256")
    middle = salted.select(F.col("uid").alias("local_winner"), F.col("winner").alias("salt_winner")).join(named, "salt_winner").drop("salt_winner")
    alone = going.select("uid", "top", "digest").join(shared, "digest", "left_anti")
    middle = middle.unionByName(alone.select(F.col("uid").alias("local_winner"), F.col("uid").alias("keeper"), F.col("top").alias("keep_id"), sha))
    members = local.groupBy(F.col("winner").alias("local_winner")).agg(F.count(F.lit(1)).alias("n"))
    counted = middle.join(members, "local_winner")
    sizes = counted.groupBy("keeper").agg(F.sum("n").alias("group_size"))
    # Stored, so that both sides of the last join come straight from a shuffle and a hot text can be split.
    whole = stored(counted.join(sizes, "keeper").select("local_winner", "keeper", "keep_id", "text_sha256", "group_size"), "copies-groups")
    return local.select("doc_id", "uid", F.col("winner").alias("local_winner")).join(whole, "local_winner").select(
        "doc_id", "keep_id", "group_size", (F.col("uid") == F.col("keeper")).alias("kept"), "text_sha256"
    )
