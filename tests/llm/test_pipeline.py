from hashlib import sha256

import duckdb
from tokenizers import Tokenizer

import corpus_pipeline
from adlumen.llm import quality
from tests.llm import brute


def plain(folder):
    """All stages without Spark; the line rules come from their SQL."""
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    judged = quality.REPORT_SQL.strip()
    kept = {r[0] for r in db.execute(f"SELECT doc_id FROM ({judged}) WHERE kept").fetchall()}
    head = judged[:judged.rindex("),\nl AS")] + ") SELECT r, line, failed FROM judged"
    lines = {}
    at = dict(enumerate((r["doc_id"] for r in brute.rows(folder, "documents")), 1))
    failed = {(at[r], line) for r, line, bad in db.execute(head).fetchall() if bad}
    for r in brute.rows(folder, "documents"):
        if r["doc_id"] in kept:
            lines[r["doc_id"]] = "\n".join(x for x in r["text"].split("\n") if (r["doc_id"], x) not in failed)
    gone = brute.lines_gone(list(lines.items()))
    left = {d: brute.without_lines(d, t, gone) for d, t in lines.items()}
    left = {d: t for d, t in left.items() if t.encode().split()}
    classes = brute.jaccard_components(list(left.items()), corpus_pipeline.SHINGLE)
    left = {d: t for d, t in left.items() if classes[d] == d}
    found = brute.phrases([(r["item_id"], r["text"]) for r in brute.rows(folder, "benchmark")])
    return {d: brute.cut_hits(t, h) if (h := brute.benchmark_hits(t, found)[1]) else t for d, t in left.items()}


def test_rows_agree_with_brute_force(spark, small):
    library = Tokenizer.from_file(corpus_pipeline.TOKENIZER)
    want = {}
    for d, text in plain(small).items():
        ids = library.encode(text, add_special_tokens=False).ids
        want[d] = (len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256(text.encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, small).collect()}
    assert got == want and 50 < len(got) < 200


def test_stages_keep_the_columns_and_take_empty_tables(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for rows in (docs.limit(0), docs.limit(12)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            rows = stage(spark, rows, small)
            assert rows.columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, rows, small).count() <= 12
