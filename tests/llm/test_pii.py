import re

from pyspark.sql import functions as F

from adlumen.llm import pii
from adlumen.llm.queries import QUERIES
from tests.llm import brute

TEXT = ("Mr. John Smith met Mrs. Anna Smith. Mr. Smith wrote to john.smith@corp.com, JOHN.SMITH@CORP.COM and +1 (017) 555-7713 or "
        "+1 017 555 7713; 97.51.17.173 token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\" card 4980-7915-7628-0449 4980791576280449 "
        "г-жа Анна Петрова")


def one(spark, text, key="k"):
    return pii.report(spark.createDataFrame([(1, text)], "doc_id long, text string"), key).head().text


def test_form_gender_script_and_coreference(spark):
    new = one(spark, TEXT)
    m = re.fullmatch(
        r'Mr\. (\w+)n (\w+) met Mrs\. (\w+)na (\w+)\. Mr\. (\w+) wrote to (\S+@\w+\.example), (\S+) and \+1 \((\d{3})\) (\d{3})-(\d{4}) or '
        r'\+1 (\d{3}) (\d{3}) (\d{4}); (\d+\.\d+\.\d+\.\d+) token = "([0-9a-f]{40})" card (4\d{3}-\d{4}-\d{4}-\d{4}) (4\d{15}) г-жа ([а-яА-Я]+) ([а-яА-Я]+)', new)
    assert m, new
    g = m.groups()
    assert g[1] == g[3] == g[4] and g[6] == g[5].upper() and g[7:10] == g[10:13] and g[15].replace("-", "") == g[16]
    for old in ("John", "Smith", "corp", "7713", "97.51.17.173", "04dbebab", "4980-7915", "Анна", "Петрова"):
        assert old not in new
    assert one(spark, TEXT) == new != one(spark, TEXT, "other key")


def test_clean_text_stays(spark):
    for text in ("Version 3. CC BY-NC 4.0, in 2024: 12.5 % of 1000000 at 10:30", "He said M. and went on.", ""):
        assert one(spark, text) == text


def test_surrogates_are_distinct_and_new(spark):
    found = spark.createDataFrame([("given-m", f"name{i}") for i in range(3000)] + [("number", f"1555{i:07d}") for i in range(3000)],
                                  "kind string, canonical string")
    got = pii.surrogates(found, "k").toPandas()
    assert len(got) == 6000 and not got.duplicated(["kind", "surrogate"]).any()
    assert not set(got.surrogate) & set(got.canonical)
    assert (got[got.kind == "number"].surrogate.str.len() == 11).all()


def test_query_leaves_no_planted_entity(spark, small):
    old = {r["doc_id"]: r["text"] for r in brute.rows(small, "documents")}
    kinds = r"\w+\.\d+@mail\d\.example\.com|\+\d \(\d{3}\) 555-\d{4}|\b\d{1,3}(?:\.\d{1,3}){3}\b|\b\d{16}\b|\b[0-9a-fA-F]{40}\b"
    changed = 0
    for r in QUERIES["op10_surrogates"](spark, small).collect():
        planted = re.findall(kinds, old[r.doc_id])
        changed += bool(planted)
        assert not [p for p in planted if p in r.text]
        assert (r.text != old[r.doc_id]) == (r.n_found > 0) and (r.n_found > 0 or not planted)
    assert changed


def test_nulls_ties_long_and_empty(spark):
    long = "words and more " * 20_000 + "a@b.org"
    rows = [(1, None), (2, ""), (3, "x a@b.org"), (3, "x a@b.org"), (None, "A@B.ORG"), (4, long), (5, "a@b.org; c@b.org")]
    docs = spark.createDataFrame([(*r, "h", 1) for r in rows], "doc_id long, text string, text_hash string, n_found int")
    got = pii.report(docs, "k").collect()
    assert len(got) == len(rows)
    new = next(r.text for r in got if r.doc_id == 3)[2:]
    assert sorted(str((r.doc_id, r.n_found)) for r in got) == sorted(map(str, [(1, 0), (2, 0), (3, 1), (3, 1), (None, 1), (4, 1), (5, 2)]))
    assert next(r.text for r in got if r.doc_id is None) == new.upper() and next(r.text for r in got if r.doc_id == 4).endswith(" " + new)
    assert pii.report(docs.limit(0), "k").count() == 0
    kept = pii.pseudonymised(docs, "found", "k")
    assert kept.columns == [*docs.columns, "found"] and kept.where(F.col("text_hash") != "h").count() == 0
