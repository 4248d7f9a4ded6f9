"""Queries of the training-data operators, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.catalog.base import Catalog
from tidemill.llm import decontam, exactdup, langid, licenses, linededup, neardup, packing, phrases, pii, runs, substrings, tokens, warc
from tidemill.llm.catalog_sql import (
    COLLOCATIONS, DECONTAMINATION, EXACT_DUPLICATES, LICENSES, LINE_DEDUP, NEAR_DUPLICATES,
    PERIODIC_RUNS, PERSONAL_DATA, REPEATED_WINDOWS, WARC,
)


def _tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _texts(t) -> DataFrame:
    return t.documents.select("doc_id", "text")


def personal_data(t) -> DataFrame:
    found = pii.find_personal_data(_texts(t))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


def token_store(t) -> DataFrame:
    store = tokens.tokenize_to_store(_texts(t), _tokenizer_file(), fold=True)
    read = store.checksums(store.locate(tokens.document_keys(_texts(t))))
    return read.select("doc_id", "start", "n_tokens", "ids_crc32")


def line_dedup(t) -> DataFrame:
    kept = linededup.drop_repeated_lines(_texts(t))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def decontamination(t) -> DataFrame:
    found = decontam.find_contamination(_texts(t), t.benchmark)
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def captures(t) -> DataFrame:
    archives = warc.archive_pages(t.pages)
    return archives.read(archives.locate(t.pages))


def language(t) -> DataFrame:
    named = langid.identify(_texts(t), langid.learn(t.documents))
    return named.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """The texts the contract of op12 looks at: a tenth of them repeats from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    split = docs.withColumn("w", F.when(h % 10 == 0, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda word: word != "")))
    sized = split.withColumn("n", F.size("w").cast("bigint")).withColumn("g", F.floor(h / 10))
    placed = sized.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    placed = placed.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    tail = F.flatten(F.expr("array_repeat(slice(w, cast(a + 1 as int), cast(p as int)), cast((n - a) div p + 1 as int))"))
    planted = F.concat_ws(" ", F.expr("slice(w, 1, cast(a as int))"), F.slice(tail, F.lit(1), (F.col("n") - F.col("a")).cast("int")))
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def periodic_runs(t) -> DataFrame:
    found = runs.collapse_runs(_with_planted_runs(_texts(t)))
    # The longest run; of equal ones the first, then the one with the smallest period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.l").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.expr("(1000 * best.l) div (-best.p)").alias("exponent_milli"),
        F.sha2(F.concat_ws("", listed), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )


def repeated_windows(t) -> DataFrame:
    kept = substrings.drop_repeated_windows(_texts(t))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def register(catalog: Catalog) -> None:
    add = catalog.add
    add("op1_anchor_pii", personal_data, PERSONAL_DATA)
    add("op2_license_blocks", lambda t: licenses.find_licenses(_texts(t)), LICENSES)
    add("op3_token_store", token_store)
    add("op4_line_dedup", line_dedup, LINE_DEDUP)
    add("op5_near_duplicates", lambda t: neardup.near_duplicates(_texts(t)), NEAR_DUPLICATES)
    add("op6_decontamination", decontamination, DECONTAMINATION)
    add("op7_warc_captures", captures, WARC)
    add("op8_language_id", language)
    add("op9_exact_duplicates", lambda t: exactdup.exact_duplicates(_texts(t)), EXACT_DUPLICATES)
    add("op10_best_fit_packing", lambda t: packing.pack_documents(t.documents))
    add("op11_collocations", lambda t: phrases.collocations(t.documents), COLLOCATIONS)
    add("op12_periodic_runs", periodic_runs, PERIODIC_RUNS)
    add("op13_repeated_windows", repeated_windows, REPEATED_WINDOWS)
