"""Inverted index and Boolean retrieval."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.catalog.base import Catalog
from tidemill.catalog.text_sql import LINE_WORDS, cleaned
from tidemill.operators import index as I
from tidemill.operators import retrieval as Q
from tidemill.runtime import scratch_path
from tidemill.sources.sinks import fetch_postings, write_index, write_table
from tidemill.sources.text import lines

QUERY = "the and AND la OR de AND"
LINE_QUERY = "the and AND la les AND OR"
BATCH = [(1, "the and AND"), (2, "la de OR les AND"), (3, "nosuchword the OR"), (4, "nosuchword the AND"), (5, "th")]

WORDS = f"words AS (SELECT doc_id, unnest({cleaned('text')}) AS term FROM documents)"
POSTINGS = f"{WORDS}, postings AS (SELECT term, doc_id, count(*) AS tf FROM words GROUP BY 1, 2)"
GAPS = f"""{POSTINGS}, gaps AS (SELECT term, row_number() OVER w - 1 AS pos,
  doc_id - lag(doc_id, 1, 0) OVER w AS gap, tf FROM postings WINDOW w AS (PARTITION BY term ORDER BY doc_id))"""
SNIPPET = "CASE WHEN length(text) > 80 THEN substr(text, 1, 80) || '...' ELSE text END AS snippet"


def docs_of(term: str) -> str:
    return f"(SELECT DISTINCT doc_id FROM postings WHERE term = '{term}')"


def sets(query: str) -> str:
    """A postfix query as SQL set operations."""
    stack: list[str] = []
    for piece in query.split():
        if piece in ("AND", "OR"):
            right, left = stack.pop(), stack.pop()
            stack.append(f"(SELECT * FROM {left} {'INTERSECT' if piece == 'AND' else 'UNION'} SELECT * FROM {right})")
        else:
            stack.append(docs_of(piece))
    return stack[0]


def _postings(t):
    """Postings kept as a table, which is read twice below."""
    return write_table(I.term_freq(t.documents), scratch_path(t.spark, "postings"))


def _stored(t):
    path = scratch_path(t.spark, "index")
    write_index(I.term_freq(t.documents), path)
    return path


# Index folders by application and table folder: an index is built once and searched many times.
_INDEXES: dict[tuple[str, str, str], str] = {}


def _searched(t, words, kind="documents"):
    """Postings of the given words from the stored index of documents or of lines."""
    key = (t.spark.sparkContext.applicationId, t.folder, kind)
    if key not in _INDEXES:
        path = scratch_path(t.spark, f"index-{kind}")
        postings = I.term_freq(t.documents) if kind == "documents" else I.term_freq(lines(t.documents), text="line", unit=("line_no",))
        write_index(postings, path)
        _INDEXES[key] = path
    return Q.stored_postings(t.spark, _INDEXES[key], words)


def _search(t, run, query):
    return run(_searched(t, Q.query_terms(query)), query)


def _found_lines(t):
    ids = ("doc_id", "line_no")
    found = Q.search(_searched(t, Q.query_terms(LINE_QUERY), "lines"), LINE_QUERY, ids)
    return Q.hydrate(found, lines(t.documents), ids, "line")


def register(catalog: Catalog) -> None:
    add = catalog.add
    add("term_freq", lambda t: I.term_freq(t.documents), f"WITH {POSTINGS} SELECT term, doc_id, tf FROM postings")
    add("doc_freq", lambda t: I.doc_freq(I.term_freq(t.documents)),
        f"WITH {POSTINGS} SELECT term, count(*) AS df FROM postings GROUP BY 1")
    add("build_index", lambda t: I.flat_postings(I.posting_lists(_postings(t))),
        f"WITH {POSTINGS} SELECT term, count(*) OVER (PARTITION BY term) AS df, doc_id, tf FROM postings")
    add("build_index_table", lambda t: t.spark.read.parquet(_stored(t)).select("term", "doc_id", "tf"),
        f"WITH {POSTINGS} SELECT term, doc_id, tf FROM postings")
    add("sink_index",
        lambda t: t.spark.read.parquet(_stored(t)).groupBy("term").agg(
            F.countDistinct("bucket").alias("buckets"), F.count(F.lit(1)).alias("df"), F.sum("tf").alias("tf")),
        f"WITH {POSTINGS} SELECT term, CAST(1 AS BIGINT) AS buckets, count(*) AS df, CAST(sum(tf) AS BIGINT) AS tf FROM postings GROUP BY 1")
    add("gap_encode", lambda t: I.gap_encode(_postings(t)), f"WITH {GAPS} SELECT term, pos, gap, tf FROM gaps")
    add("gap_decode", lambda t: I.gap_decode(I.gap_encode(_postings(t))),
        f"WITH {POSTINGS} SELECT term, doc_id, tf FROM postings")
    add("fetch_postings", lambda t: fetch_postings(t.spark, _stored(t), "the"),
        f"WITH {POSTINGS} SELECT term, doc_id, tf FROM postings WHERE term = 'the'")
    add("fetch_doc_set", lambda t: I.doc_set(_searched(t, ["la"]), "la"), f"WITH {POSTINGS} SELECT doc_id FROM {docs_of('la')}")
    add("bool_and", lambda t: _search(t, Q.search_sets, "the and AND"),
        f"WITH {POSTINGS} SELECT doc_id FROM {sets('the and AND')}")
    add("bool_or", lambda t: _search(t, Q.search_sets, "the la OR"),
        f"WITH {POSTINGS} SELECT doc_id FROM {sets('the la OR')}")
    add("boolean_search", lambda t: Q.show_results(_search(t, Q.search, QUERY), t.documents),
        f"WITH {POSTINGS} SELECT doc_id, {SNIPPET} FROM documents WHERE doc_id IN (SELECT doc_id FROM {sets(QUERY)})")
    add("boolean_search_batch", lambda t: Q.search_many(_searched(t, sorted({w for _, q in BATCH for w in Q.query_terms(q)})), BATCH),
        f"WITH {POSTINGS} " + " UNION ALL ".join(f"SELECT CAST({qid} AS INTEGER) AS qid, doc_id FROM {sets(q)}" for qid, q in BATCH))
    add("hydrate_docs", lambda t: Q.hydrate(I.doc_set(_searched(t, ["de"]), "de"), t.documents),
        f"WITH {POSTINGS} SELECT doc_id, {SNIPPET} FROM documents WHERE doc_id IN {docs_of('de')}")
    has = ", ".join(f"list_contains(u, '{w}') AS has_{w}" for w in Q.query_terms(LINE_QUERY))
    add("line_search", _found_lines,
        f"""WITH {LINE_WORDS}, flags AS (SELECT doc_id, line_no, {has} FROM (SELECT doc_id, line_no, list(term) AS u FROM lw GROUP BY 1, 2))
        SELECT l.doc_id, CAST(l.line_no AS INTEGER) AS line_no, {SNIPPET.replace('text', 'line')}
        FROM lines l JOIN flags f ON l.doc_id = f.doc_id AND l.line_no = f.line_no WHERE (has_the AND has_and) OR (has_la AND has_les)""")
