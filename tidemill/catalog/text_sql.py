"""SQL fragments shared by the checks of text queries."""

LINES = r"""lines AS (
  SELECT doc_id, unnest(generate_series(0, len(parts) - 1)) AS line_no, unnest(parts) AS line
  FROM (SELECT doc_id, string_split_regex(text, '\r\n|\r|\n') AS parts FROM documents))"""


def cleaned(text: str) -> str:
    """List of cleaned tokens of an SQL string, one blank-separated piece after the other."""
    return (
        rf"list_filter(list_transform(string_split_regex({text}, '[ \t\n\r\f]+'), "
        rf"lambda w: regexp_replace(lower(w), '(^[^a-z]+|[^a-z]+$)', '', 'g')), lambda w: length(w) > 0)"
    )


TOKENS = f"{LINES}, tokens AS (SELECT doc_id, line_no, {cleaned('line')} AS t FROM lines)"
WORDS = f"{TOKENS}, words AS (SELECT doc_id, line_no, unnest(t) AS term FROM tokens)"
LINE_WORDS = (
    f"{TOKENS}, lw AS (SELECT doc_id, line_no, unnest(list_distinct(t)) AS term FROM tokens), "
    "freq AS (SELECT term, count(*) AS n FROM lw GROUP BY 1)"
)
BIGRAMS = (
    f"{TOKENS}, pairs AS (SELECT unnest(t[1:len(t)-1]) AS a, unnest(t[2:len(t)]) AS b FROM tokens WHERE len(t) > 1), "
    "counts AS (SELECT a, b, count(*) AS n FROM pairs GROUP BY 1, 2), "
    "totals AS (SELECT a, count(*) AS total FROM pairs GROUP BY 1)"
)


def first_pieces(line: str, n: int) -> str:
    """The first blank-separated pieces of an SQL string."""
    pieces = rf"list_filter(string_split_regex({line}, '[ \t\n\r\f]+'), lambda w: length(w) > 0)"
    return f"array_to_string(({pieces})[1:{n}], ' ')"


def half_pmi(min_count: int, max_tokens: int | None = None) -> str:
    """Pairs x < y by self join of the words of a line."""
    words = LINE_WORDS if max_tokens is None else LINE_WORDS.replace(cleaned("line"), cleaned(first_pieces("line", max_tokens)))
    return (
        f"{words}, kept AS (SELECT lw.* FROM lw JOIN freq USING (term) WHERE n >= {min_count}), "
        "half AS (SELECT l.term AS x, r.term AS y, count(*) AS n FROM kept l JOIN kept r "
        "ON l.doc_id = r.doc_id AND l.line_no = r.line_no AND l.term < r.term "
        f"GROUP BY 1, 2 HAVING count(*) >= {min_count}), "
        "total AS (SELECT count(*) AS lines FROM tokens WHERE len(t) > 0), "
        "scored AS (SELECT x, y, half.n, log10(half.n * lines / (fx.n * fy.n)) AS pmi "
        "FROM half JOIN freq fx ON fx.term = x JOIN freq fy ON fy.term = y, total), "
        "pmi AS (SELECT x, y, n, pmi FROM scored UNION ALL SELECT y, x, n, pmi FROM scored)"
    )
