"""Quality rules against brute force and the exact binomial sum."""

import math
import random
import re

import pytest

from tidemark.llm import quality
from tidemark.llm.reports import op1_quality_rules

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = text.split("\n")
    dup = sum(1 for i, line in enumerate(lines) if WORD.search(line) and line in lines[:i])
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), dup, len(covered)


ODD = [None, "", " \t\n", "a", "a b a b a b", "x\n\n\nx\n x\nx ", "é ü 日本 \x1c#\n#", "a a a a", "A|B<C>" * 5000]


def test_counts():
    rnd = random.Random(2)
    made = ["".join(rnd.choice("ab \n#") for _ in range(rnd.randint(0, 200))) for _ in range(200)]
    for text in ODD[:-1] + made:
        assert quality.measure(text)[:5] == brute(text)
    assert quality.measure(ODD[-1])[:3] == (1, 30_000, 15_000)


def test_query(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op1_quality_rules(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, chars, symbols, dup, repeated = brute(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dup, repeated)
        assert r["base_failed"] == (n < 50 or 100 * repeated > 50 * n)
        assert not (r["base_failed"] and r["kept"])


@pytest.mark.parametrize("n, p", [(1, 0.5), (10, 0.01), (300, 0.02), (5000, 0.01), (20_000, 0.3)])
def test_binomial_tail(n, p):
    log = lambda k: math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    total = 0.0
    for k in range(min(n, 400)):
        total += math.exp(log(k))
        assert quality.at_most(k, n, p) == pytest.approx(total, rel=1e-7, abs=1e-12)
    assert quality.at_most(n, n, p) == 1.0 and quality.at_most(-1, n, p) == 0.0


def test_certified_levels():
    levels, good, bad = [0.02, 0.1, 0.5, None], [0, 4, 60, 1936], [30, 20, 5, 0]
    assert quality.certified(levels, good, bad, 0.01, 0.01) == (0.1, 4, 50)
    assert quality.certified(levels, good, bad, 0.1, 0.01) == (0.1, 4, 50)  # the last level would lose more good than it gains
    assert quality.certified(levels, [g // 100 for g in good], bad, 0.01, 0.01)[0] is None  # too few labels
    assert quality.certified([0.02, None], [5, 1995], [5, 0], 0.01, 0.01)[0] is None  # no surplus
    assert quality.certified([None], [5000], [50], 0.01, 0.01)[0] is None


def test_path_goes_from_pure_to_mixed_cutoffs():
    rule = ["symbols"] * 4 + ["lines"] * 3
    cells, good, bad = [0, 70, 300, 400, 0, 50, 90], [90, 0, 0, 0, 80, 5, 5], [0, 4, 3, 2, 2, 0, 7]
    # All symbol cutoffs from 70 on are as pure as the mildest, so only that is a step; lines lose more from 50 than from 90.
    assert sorted(quality.drawn_path(rule, cells, good, bad)) == [("lines", 90, 6 / 8), ("symbols", 70, 1 / 10)]
    assert quality.drawn_path(["lines"], [0], [3], [9]) == []


def rows_of(spark, n=6000):
    """Good prose of rising noise up to a tenth, junk with half the words noise; two strata and a null one."""
    rnd, rows, labels = random.Random(4), [], []
    for i in range(n):
        bad = i % 5 == 0
        noise = rnd.uniform(0.3, 0.9) if bad else rnd.uniform(0, 0.05)
        text = " ".join(f"w{rnd.randrange(10**9)}" + ("###" if rnd.random() < noise else "") for _ in range(60))
        rows.append((i, text, ["en", "de", None][i % 3]))
        if i % 2 == 0:
            labels.append((i, 0 if bad else 1))
    return rows, labels


def test_risk_is_held_and_junk_goes(spark):
    rows, labels = rows_of(spark)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    marks = spark.createDataFrame(labels + [(0, None), (None, 1), (2, 0)], "doc_id bigint, quality int")
    judged, chosen = quality.judge(docs, marks)
    got = {r["doc_id"]: r for r in judged.collect()}
    assert len(got) == len(rows)
    bad = [r for i, r in got.items() if i % 5 == 0]
    good = [r for i, r in got.items() if i % 5]
    assert sum(not r["kept"] for r in bad) >= 0.98 * len(bad)
    for stratum in ("=en", "=de", "null"):
        own = [r for r in good if r["stratum"] == stratum]
        assert sum(not r["kept"] for r in own) <= quality.RISK * len(own)
    assert {r["stratum"] for r in chosen.where("cutoff IS NOT NULL").collect()} == {"=en", "=de", "null"}
    odd = docs.selectExpr("*", "'a' AS cuts", "'b' AS kept", "1 AS _q", "2 AS stratum", "3 AS _stratum", "4 AS symbols")
    kept = quality.keep_good(odd, marks)
    assert kept.columns == odd.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["kept"]}


def test_odd_rows(spark):
    docs = spark.createDataFrame([(i, t, None) for i, t in enumerate(ODD)] + [(0, None, None)], "doc_id bigint, text string, lang string")
    marks = spark.createDataFrame([], "doc_id bigint, quality int")
    judged, _ = quality.judge(docs, marks)
    assert judged.count() == len(ODD) + 1
    assert quality.judge(docs.limit(0), marks)[0].count() == 0
    assert quality.keep_good(docs.limit(0), marks).count() == 0


def test_verdicts_equal_the_sql(spark):
    import duckdb

    from tidemark.llm.reports import ORACLES

    duck = duckdb.connect()
    for name in ("documents", "labels"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    cursor = duck.execute(ORACLES["op1_quality_rules"])
    columns = [c[0] for c in cursor.description]
    assert sorted(map(tuple, op1_quality_rules(spark, SF).select(*columns).collect())) == sorted(cursor.fetchall())


def test_chosen_cutoffs_equal_the_sql(spark, tmp_path):
    import duckdb

    from tidemark.llm.reports import ORACLES

    rows, labels = rows_of(spark, 9000)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int")
    for name, frame in (("documents", docs), ("labels", marks)):
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    duck = duckdb.connect()
    for name in ("documents", "labels"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    cursor = duck.execute(ORACLES["op1_quality_rules"])
    columns = [c[0] for c in cursor.description]
    expected = sorted(cursor.fetchall(), key=repr)
    assert sorted(map(tuple, op1_quality_rules(spark, str(tmp_path)).select(*columns).collect()), key=repr) == expected
    assert any(r[columns.index("rejected_by")] for r in expected)


def test_repeated_rows_are_one_trial(spark):
    rows, labels = rows_of(spark, 3000)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int")
    once = quality.judge(docs, marks)[1].collect()
    four = quality.judge(docs.union(docs).union(docs).union(docs), marks)[1].collect()
    assert sorted(map(tuple, once), key=repr) == sorted(map(tuple, four), key=repr)


def test_repeated_rows_equal_the_sql(spark, tmp_path):
    import duckdb

    from tidemark.llm.reports import ORACLES

    rows, labels = rows_of(spark, 2400)
    rows += [(i, text + " extra ###", lang) for i, text, lang in rows[::3]] + rows[::2] + [(None, "words " * 70, "en")]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    duck = duckdb.connect()
    for name in ("documents", "labels"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    cursor = duck.execute(ORACLES["op1_quality_rules"])
    columns = [c[0] for c in cursor.description]
    expected = sorted(cursor.fetchall(), key=repr)
    assert sorted(map(tuple, op1_quality_rules(spark, str(tmp_path)).select(*columns).collect()), key=repr) == expected


def test_something_is_certified_on_a_thousand_documents(spark):
    sf = "/root/testdata/sf0.01"
    judged, chosen = quality.judge(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    found = [r for r in chosen.collect() if r["cutoff"] is not None]
    assert "=en" in {r["stratum"] for r in found}
    marks = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in judged.where("NOT base_failed AND stratum = '=en'").collect() if marks.get(r["doc_id"]) is not None]
    lost = [not r["kept"] for r in rows if marks[r["doc_id"]] == 1]
    gone = [not r["kept"] for r in rows if marks[r["doc_id"]] == 0]
    assert sum(lost) <= quality.RISK * len(lost) and sum(gone) >= 0.7 * len(gone)
