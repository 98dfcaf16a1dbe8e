"""The training-data queries, one for each operator, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from adlumen.llm import (bpe, chat, decontaminate, golay, langid, lexical, licenses, line_dedup, pii, quality, repeats, ring,
                         spelling)
from adlumen.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

SHARDS = 24
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that are similar to an earlier line."""
    return line_dedup.report(table(spark, sf_dir, "documents"))


@query
def op2_golay_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents whose fingerprints differ in four bits or fewer."""
    return golay.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op3_licence_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in all documents with family, probability and template."""
    docs = table(spark, sf_dir, "documents")
    return licenses.notices(docs, licenses.train(docs))


@query
def op4_language_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from three quarters of them."""
    return langid.identify(table(spark, sf_dir, "documents"))


@query
def op5_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures and the verdict of the line rules for all documents."""
    return quality.report(table(spark, sf_dir, "documents"))


SQL["op5_line_quality"] = quality.REPORT_SQL


@query
def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded again."""
    return bpe.digests(bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), TOKENIZER), TOKENIZER))


@query
def op7_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents on a ring of 24 shards with bounded loads; counts at most one apart."""
    return ring.assign(table(spark, sf_dir, "documents"), SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query
def op8_chat_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that holds foreign control strings, read back from the output."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame(
        [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")],
        "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_chats(rows.unionByName(odd), TOKENIZER))


#: Marks and escapes of the template, counted.
_MARK_CHARS = len(chat.TURN) + len(chat.BODY) + len(chat.END)
_ESCAPES = r"len(regexp_extract_all({}, '<\\*\||<\\*/?s>|\[\\*/?INST\]'))"
SQL["op8_chat_masks"] = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(role) + length(text) + {_MARK_CHARS} + {_ESCAPES.format("role")} + {_ESCAPES.format("text")}) AS BIGINT)
    AS formatted_chars
FROM c GROUP BY conv_id"""


@query
def op9_benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages of ten words or more in all documents."""
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


@query
def op10_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with surrogates for personal data and secrets."""
    return pii.report(table(spark, sf_dir, "documents"), key="op10")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '" + r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+" + "')"
SQL["op9_benchmark_hits"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, w, least({decontaminate.WINDOW}, len(w)) AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
p AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
      FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
s AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
      FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM b) WHERE len(w) >= n)),
h AS (SELECT r, i, n, item_id FROM s JOIN p USING (n, s)),
hit AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS place FROM h) GROUP BY r),
item AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
         FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM h) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN item USING (r)"""


@query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all documents for each benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '" + r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+" + "')"
SQL["op11_lexical_search"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
i AS (SELECT row_number() OVER () AS i, item_id, {_TERMS} AS w FROM (SELECT DISTINCT item_id, text FROM benchmark)),
q AS (SELECT i, t, count(*) AS times FROM (SELECT i, unnest(w) AS t FROM i) GROUP BY i, t),
s AS (SELECT count(*) FILTER (len(w) > 0) AS docs, sum(len(w))::BIGINT AS terms FROM d),
f AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) SEMI JOIN q USING (t) GROUP BY r, t),
e AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS weight
      FROM (SELECT t, count(*) AS df FROM f GROUP BY t), s),
m AS (SELECT r, 25 + (75 * len(w) * docs) // terms AS m FROM d, s WHERE len(w) > 0),
x AS (SELECT i, r, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM f JOIN e USING (t) JOIN q USING (t) JOIN m USING (r) GROUP BY i, r),
o AS (SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
      FROM x JOIN (SELECT i, item_id FROM i) USING (i) JOIN (SELECT r, doc_id FROM d) USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 10"""


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of the documents with their near words, forms and roots."""
    return spelling.variants(table(spark, sf_dir, "documents"))


_CRC = """list_reduce(list_prepend(4294967295, {bytes}), lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]))"""
_RUNS = "regexp_extract_all(translate(coalesce(text, ''), '" + _UPPER + "', '" + _LOWER + r"'), '[A-Za-z\x{C0}-\x{FF}]+')"
SQL["op12_spelling_variants"] = f"""
WITH RECURSIVE crcs AS (SELECT list(list_reduce(list_prepend(b, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS crc
  FROM (SELECT unnest(range(256)) AS b)),
r AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' AS id, unnest({_RUNS}) AS run FROM documents),
c AS (SELECT id, run, count(*) AS n FROM r WHERE length(run) >= 6 GROUP BY id, run),
h AS (SELECT run, n, xor({_CRC.format(bytes="""flatten(list_transform(string_split(id || run, ''),
    lambda x: CASE WHEN ord(x) < 128 THEN [CAST(ord(x) AS BIGINT)] ELSE [195, CAST(ord(x) - 64 AS BIGINT)] END))""")}, 4294967295) AS h FROM c, crcs),
w AS (SELECT CASE WHEN h % 199 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM h),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM w WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
k AS (SELECT word, n, i, word[:i - 1] || '.' || word[i + 1:] AS gap, word[:i - 1] || word[i + 1:] AS rest
      FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
near AS (SELECT a.word, b.word AS other, b.n FROM k a JOIN k b ON a.gap = b.gap AND a.word <> b.word
  UNION SELECT k.word, v.word, v.n FROM k JOIN v ON k.rest = v.word
  UNION SELECT v.word, k.word, k.n FROM k JOIN v ON k.rest = v.word),
best AS (SELECT word, other, n, count(*) OVER (PARTITION BY word) AS n_near,
  row_number() OVER (PARTITION BY word ORDER BY n DESC, other) AS place FROM near),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best.n >= 5 * v.n THEN other END AS form,
  CASE WHEN best.n >= 5 * v.n THEN best.n END AS form_n FROM v LEFT JOIN best ON v.word = best.word AND place = 1),
chain AS (SELECT word, form AS root, 1 AS step FROM f WHERE form IS NOT NULL
  UNION ALL SELECT chain.word, f.form, step + 1 FROM chain JOIN f ON f.word = chain.root WHERE f.form IS NOT NULL)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n
FROM f LEFT JOIN (SELECT word, arg_max(root, step) AS root FROM chain GROUP BY word) USING (word)"""


@query
def op13_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the passages of fifty words that an earlier document has."""
    return repeats.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "repeats.n_words", "repeats.n_removed", F.sha2("repeats.kept", 256).alias("kept_sha256"))


SQL["op13_repeated_passages"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT r, doc_id, i, md5(array_to_string(w[i:i + {repeats.WINDOW - 1}], ' ')) AS s
      FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - {repeats.WINDOW - 2})) AS i FROM d WHERE len(w) >= {repeats.WINDOW})),
f AS (SELECT s, min(doc_id) AS least FROM s GROUP BY s),
g AS (SELECT DISTINCT r, unnest(range(i, i + {repeats.WINDOW})) AS place FROM s JOIN f USING (s)
      WHERE coalesce(doc_id > least, least IS NOT NULL)),
k AS (SELECT r, string_agg(word, ' ' ORDER BY place) AS kept, count(*) AS n
      FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM d) ANTI JOIN g USING (r, place) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (r)"""
