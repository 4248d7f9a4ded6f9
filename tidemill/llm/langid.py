"""Language identification by compression.

Every language has a zstandard raw-content dictionary made of labelled texts. A text is
compressed with each, in pieces of PIECE bytes, so that in a long text the dictionary and not
the text's own beginning explains what follows. The dictionary that leaves the fewest bytes
over all pieces names the language. The score is the share of bytes by which the best beats
the second best. Where that margin is narrow the text is rejected.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.shared import others, small

# Bounds of the model: labelled texts aimed at per language, and bytes of one dictionary.
SAMPLE_TEXTS = 200
DICTIONARY_BYTES = 96 << 10
LEVEL = 6
PIECE = 1024
# Follows every piece: the compressor stores a few bytes as they are unless something in them
# repeats, and then no dictionary would tell.
PAD = bytes(64)
# Below this share of bytes two languages explain a text equally well.
MARGIN = 0.004

_LETTER = regex.compile(r"\p{L}")


def held_out(doc_id: Column) -> Column:
    """Documents that never take part in learning."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _folded(text: str) -> bytes:
    return " ".join(text.lower().split()).encode()


def _heads(taken: DataFrame, caps: dict[str, int]) -> DataFrame:
    """``lang, place, digest, size, head`` of ``lang, place, text``: digest and bytes of the folded
    text, and as many of its first bytes as ``caps`` has for the language."""

    def run(batches):
        for batch in small(batches):
            langs = batch.column(0).to_pylist()
            folded = [_folded(text) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array([hashlib.sha256(f).digest() for f in folded], pa.binary()), pa.array([len(f) for f in folded], pa.int64()),
                 pa.array([f[: caps.get(lang, 0)] for lang, f in zip(langs, folded)], pa.binary())],
                names=["lang", "place", "digest", "size", "head"],
            )

    return taken.mapInArrow(run, "lang string, place double, digest binary, size bigint, head binary").filter(F.col("size") > 0)


def _equal_share(sizes: list[int], room: int) -> int:
    """The largest cap with which texts of these sizes, a blank after each, fit into ``room``."""
    left = len(sizes)
    for size in sorted(sizes):
        if size + 1 > room // left:
            return max(room // left - 1, 1)
        room -= size + 1
        left -= 1
    return max(sizes, default=0)


def sampled(docs: DataFrame, sample_texts: int = SAMPLE_TEXTS, dictionary_bytes: int = DICTIONARY_BYTES) -> dict[str, list[bytes]]:
    """Beginnings of the texts each language is learned from, a list per language.

    About ``sample_texts`` rows per language are taken by a hash of ``doc_id``. Each distinct
    text among them has an equal share of ``dictionary_bytes``; what short texts leave over goes
    to the others. Texts are cut before they are collected.
    """
    known = docs.select("doc_id", "lang", "text").filter(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))
    )
    place = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 40)) / float(1 << 40)
    counts = {row["lang"]: row["n"] for row in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return {}
    limit = F.lit(0.0)
    for lang, n in counts.items():
        limit = F.when(F.col("lang") == lang, F.lit(min(1.0, sample_texts / n))).otherwise(limit)
    taken = known.withColumn("place", place).filter(F.col("place") < limit).select("lang", "place", "text")
    found: dict[str, list] = {}
    distinct = _heads(taken, {}).groupBy("lang", "digest").agg(F.min("place").alias("place"), F.first("size").alias("size"))
    for row in sorted(distinct.collect(), key=lambda r: (r["place"], r["digest"])):
        found.setdefault(row["lang"], []).append((bytes(row["digest"]), row["size"]))
    caps = {lang: _equal_share([size for _, size in own], dictionary_bytes) for lang, own in found.items()}
    cut = _heads(taken, caps).select("lang", "digest", "head").dropDuplicates(["lang", "digest"])
    heads = {(row["lang"], bytes(row["digest"])): bytes(row["head"]) for row in cut.collect()}
    return {lang: [heads[lang, digest] for digest, _ in own] for lang, own in found.items()}


def learn(docs: DataFrame, sample_texts: int = SAMPLE_TEXTS, dictionary_bytes: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """Dictionary per language from labelled documents that are not held out.

    It holds the texts of ``sampled``, at most ``dictionary_bytes`` bytes per language. Rows with
    a null ``doc_id``, ``lang`` or ``text`` teach nothing. No labelled rows give an empty model.
    """
    return {lang: b" ".join(own)[:dictionary_bytes] for lang, own in sampled(docs, sample_texts, dictionary_bytes).items()}


def identify(docs: DataFrame, model: dict[str, bytes], level: int = LEVEL, margin: float = MARGIN) -> DataFrame:
    """``docs`` with ``lang_pred, score, rejected``; columns of these names are replaced.

    A text that is null or has no letter is ``und`` with score 0 and rejected, as is every text
    under an empty model. Equal sizes go to the language first in the alphabet, with score 0.
    ``rejected`` is a score below ``margin``. A model of one language gives score 1.
    """
    kept = docs.select(*others(docs, "lang_pred", "score", "rejected"))
    langs = sorted(model)
    place = kept.columns.index(next(c for c in kept.columns if c.lower() == "text"))
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql import types as T

    schema = T.StructType(
        [*kept.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
    )
    extra = to_arrow_schema(T.StructType(schema.fields[-3:]))

    def run(batches):
        presses = [
            zstandard.ZstdCompressor(
                level=level, write_content_size=False, write_checksum=False, write_dict_id=False,
                dict_data=zstandard.ZstdCompressionDict(model[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT),
            )
            for lang in langs
        ]
        for batch in small(batches):
            preds, scores = [], []
            for text in batch.column(place).to_pylist():
                if not langs or text is None or not _LETTER.search(text):
                    preds.append("und")
                    scores.append(0.0)
                    continue
                folded = _folded(text)
                pieces = [folded[i : i + PIECE] + PAD for i in range(0, len(folded), PIECE)]
                sizes = sorted((sum(len(press.compress(p)) for p in pieces), lang) for press, lang in zip(presses, langs))
                preds.append(sizes[0][1])
                scores.append(1.0 if len(sizes) == 1 else 1.0 - sizes[0][0] / sizes[1][0])
            lost = [pred == "und" or score < margin for pred, score in zip(preds, scores)]
            made = [pa.array(v, f.type) for v, f in zip((preds, scores, lost), extra)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, *extra.names])

    return kept.mapInArrow(run, schema)
