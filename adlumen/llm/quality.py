"""Line-first cleaning, in SQL functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from adlumen.llm.common import SPACE_RUN, sql_text

SYMBOLS = "[#*$%&|<>]"
#: Line rules, fixed values of this operator. A line fails if it has too many symbols a
#: word, too many bare separators, too many shouted words, a boilerplate phrase, or no mark
#: that ends a sentence.
MAX_SYMBOLS, MAX_SEPARATORS, MAX_SHOUTED = 0.3, 0.15, 0.3
END_MARK = r"""[.!?…。！？][)\]"'”’»]*([\x20\x09-\x0D]|$)"""
SEPARATOR = r"^[|/<>«»·•→←-]+$"
SHOUTED = r"[!?][!?]+$"
BOILERPLATE = (r"(?i)javascript|lorem ipsum|all rights reserved|terms of (use|service)|privacy policy|"
               r"(use|accept|uses) (of )?cookies|cookie policy|sign in|log in to|subscribe to|"
               r"click here|skip to (main )?content|[{}]")
#: A document goes if it loses more than this share of its words.
MAX_LOST = 0.3
MIN_WORDS, MAX_REPEATED, SPAN = 10, 20, 5


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``row`` (all given columns) with base figures, ``lines`` and the verdict of each row.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, lost,
    kept, and clean: the text without the lines that failed.

    Null text counts as empty: no words, base_failed, clean null. Lines without words
    never fail. A long text is worked on within its row, in time that grows as n log n;
    nothing is shuffled. Repeated rows are judged alike. Any further columns pass.
    """
    space, end, sep, shout, boiler = map(sql_text, (SPACE_RUN, END_MARK, SEPARATOR, SHOUTED, BOILERPLATE))
    words = f"filter(split({{0}}, '{space}'), w -> w <> '')"

    def chars(text: str, pattern: str) -> str:  # of ASCII characters
        return f"octet_length({text}) - octet_length(regexp_replace({text}, '{pattern}', ''))"

    window = ", ".join(f"get(words, i + {k})" if k else "get(words, i)" for k in range(SPAN))
    one = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                      F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    two = one.selectExpr(
        "row", "t", f"{words.format('t')} AS words", "split(t, '\n') AS cut",
        f"CAST(length(t) - ({chars('t', space)}) AS BIGINT) AS word_chars",
        f"CAST({chars('t', SYMBOLS)} AS BIGINT) AS n_symbols")
    three = two.selectExpr(
        "row", "t", "words", "word_chars", "n_symbols", "CAST(size(words) AS BIGINT) AS n_words",
        f"""transform(cut, l -> struct(l AS line, {words.format('l')} AS words)) AS cut""",
        f"""CASE WHEN size(words) >= {SPAN} THEN transform(sequence(0, size(words) - {SPAN}),
              i -> xxhash64({window})) ELSE array() END AS spans""")
    four = three.selectExpr(
        "row", "word_chars", "n_symbols", "n_words",
        f"""transform(cut, c -> struct(c.line AS line, size(c.words) AS n,
            size(c.words) > 0 AND (
              {chars('c.line', SYMBOLS)} > {MAX_SYMBOLS} * size(c.words)
              OR size(filter(c.words, w -> w RLIKE '{sep}')) > {MAX_SEPARATORS} * size(c.words)
              OR size(filter(c.words, w -> w RLIKE '{shout}')) > {MAX_SHOUTED} * size(c.words)
              OR c.line RLIKE '{boiler}'
              OR NOT c.line RLIKE '{end}') AS failed)) AS lines""",
        "CASE WHEN size(array_distinct(spans)) = size(spans) THEN array() ELSE "
        "sort_array(transform(spans, (x, i) -> struct(x AS h, i AS i))) END AS spans")
    five = four.selectExpr(
        "row", "word_chars", "n_symbols", "n_words", "lines", "filter(lines, x -> x.n > 0) AS full",
        """sort_array(transform(filter(spans, (x, k) -> coalesce(get(spans, k - 1).h = x.h, false)
             OR coalesce(get(spans, k + 1).h = x.h, false)), x -> x.i)) AS again""")
    six = five.selectExpr(
        "row", "word_chars", "n_symbols", "n_words", "lines",
        "CAST(size(full) - size(array_distinct(transform(full, x -> x.line))) AS BIGINT) AS n_dup_lines",
        f"""CAST(aggregate(transform(again, (x, k) -> least({SPAN}, coalesce(get(again, k + 1) - x, {SPAN}))),
             0, (a, x) -> a + x) AS BIGINT) AS n_repeat_words""",
        "CAST(aggregate(filter(lines, x -> x.failed), 0, (a, x) -> a + x.n) AS BIGINT) AS lost",
        # keeps a filter on the verdict from being moved below, where it would repeat all of the above
        "spark_partition_id() AS task")
    seven = six.selectExpr(
        "*", f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed")
    return seven.selectExpr(
        "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "lost",
        f"NOT base_failed AND lost <= {MAX_LOST} * n_words AND task >= 0 AS kept",
        f"""CASE WHEN row.`{text_col}` IS NOT NULL THEN
              array_join(transform(filter(lines, x -> NOT x.failed), x -> x.line), '\n') END AS clean""")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the base figures and the verdict of every row."""
    return measured(docs, text_col).select(
        F.col(f"row.`{id_col}`").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "lost", "kept")


def cleaned(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The kept rows with the failed lines removed; n_chars, if given, follows the text."""
    found = measured(docs, text_col).where("kept")
    new = {text_col: F.col("clean")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("clean").cast(docs.schema["n_chars"].dataType)
    return found.select(*[(new[c] if c in new else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def _duck(pattern: str) -> str:
    return pattern.replace("'", "''")


#: The same for DuckDB.
REPORT_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '{SPACE_RUN}'), lambda x: x <> '') AS words FROM d),
spans AS (SELECT r, i, array_to_string(words[i:i + {SPAN - 1}], ' ') AS s
          FROM (SELECT r, words, unnest(range(1, len(words) - {SPAN - 2})) AS i FROM w WHERE len(words) >= {SPAN})),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM spans) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + {SPAN})) AS p FROM again) GROUP BY r),
cut AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
line AS (SELECT r, line, list_filter(regexp_split_to_array(line, '{SPACE_RUN}'), lambda x: x <> '') AS ws FROM cut),
judged AS (SELECT r, line, len(ws) AS n, len(ws) > 0 AND (
     length(line) - length(regexp_replace(line, '{SYMBOLS}', '', 'g')) > {MAX_SYMBOLS} * len(ws)
     OR len(list_filter(ws, lambda x: regexp_matches(x, '{SEPARATOR}'))) > {MAX_SEPARATORS} * len(ws)
     OR len(list_filter(ws, lambda x: regexp_matches(x, '{SHOUTED}'))) > {MAX_SHOUTED} * len(ws)
     OR regexp_matches(line, '{BOILERPLATE}')
     OR NOT regexp_matches(line, '{_duck(END_MARK)}')) AS failed FROM line),
l AS (SELECT r, count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0) AS dup,
             coalesce(sum(n) FILTER (failed), 0) AS lost FROM judged GROUP BY r),
f AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
       CAST(length(t) - (length(t) - length(regexp_replace(t, '{SPACE_RUN}', '', 'g'))) AS BIGINT) AS word_chars,
       CAST(length(t) - length(regexp_replace(t, '{SYMBOLS}', '', 'g')) AS BIGINT) AS n_symbols,
       CAST(dup AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(lost AS BIGINT) AS lost
      FROM w JOIN l USING (r) LEFT JOIN rep USING (r)),
g AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed FROM f)
SELECT *, NOT base_failed AND lost <= {MAX_LOST} * n_words AS kept FROM g
"""
