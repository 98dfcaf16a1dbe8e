import duckdb

from adlumen.llm import quality

PROSE = "This is a plain sentence with more than ten words in it, and it ends well."
ROWS = [
    (1, None), (2, ""), (3, " \n\t "), (4, PROSE), (4, PROSE), (None, PROSE + "\n" + PROSE),
    (5, "home | about | news | help | more | shop | cart | login | rss | map"), (6, PROSE + "\nhome | about | news"),
    (7, "a*** b### c$$$ d%%% e*** f### g$$$ h%%% i*** j### k$$$."), (8, "word " * 20_000 + "."), (9, PROSE + "\nAll rights reserved."),
    (10, "no sentence here at all but quite a few words in one line"), (11, "one two three four five one two three four five six."),
    (12, "\n".join([PROSE] * 3)), (13, "RUN!! NOW!! GO!! STOP!! HERE!! THERE!! UP!! DOWN!! LEFT!! RIGHT!! END!!"), (14, "é中 " * 12 + "."),
]


def frame(spark):
    return spark.createDataFrame([(*r, "w", 3) for r in ROWS], "doc_id long, text string, words string, n_chars int")


def test_same_rows_as_sql(spark, tmp_path):
    docs = frame(spark)
    docs.select("doc_id", "text").write.parquet(str(tmp_path / "d"))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    want = db.execute(quality.REPORT_SQL)
    order = [c[0] for c in want.description]
    got = quality.report(docs).select(*order).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want.fetchall()))


def test_verdicts(spark):
    got = {r.doc_id: r for r in quality.report(frame(spark)).collect() if r.doc_id}
    assert {d for d, r in got.items() if r.kept} == {4, 6, 9}
    assert got[11].n_repeat_words == 10 and got[8].n_repeat_words == 20_000 and got[12].n_dup_lines == 2


def test_cleaned_rows(spark):
    docs = frame(spark)
    out = quality.cleaned(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: (r.text, r.n_chars, r.words) for r in out.collect()}
    assert got[6] == got[9] == (PROSE, len(PROSE), "w")
    assert out.where("doc_id = 4").count() == 2
    assert quality.report(docs.limit(0)).count() == 0 and quality.cleaned(docs.limit(0)).count() == 0
