"""Line removal against a plain loop over all lines."""

import random
from collections import Counter

from orderflow.llm import lines
from orderflow.llm.common import free_name

TABLE = str.maketrans(lines.UPPER, lines.LOWER)


def key_of(line):
    return line.strip(lines.BLANKS).translate(TABLE)


def plain(texts, min_documents, min_chars=1):
    split = [(text or "").split("\n") for text in texts]
    held = Counter(key for found in split for key in {key_of(line) for line in found})
    gone = {key for key, n in held.items() if n >= min_documents and len(key) >= min_chars}
    out = []
    for found in split:
        kept = [line for line in found if key_of(line) not in gone]
        out.append((len(found), len(found) - len(kept), "\n".join(kept)))
    return out


def check(spark, texts, min_documents, min_chars=1):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(5)
    cut, name = lines.drop_frequent_lines(docs, ["doc_id"], "text", min_documents, min_chars)
    got = {r.doc_id: tuple(r[name]) for r in cut.collect()}
    assert [got[k] for k in range(len(texts))] == plain(texts, min_documents, min_chars)


def test_equals_plain_loop(spark):
    rng = random.Random(3)
    pool = ["Menu", " menu\t", "MENU\r", "É", "é", "ÀB", "Àb", "", "  ", " x", "x", "\x0bEnd\x0c", "İ", "ß", "a" * 3000]
    texts = ["\n".join(rng.choice(pool + [f"own {rng.random()}"]) for _ in range(rng.randint(0, 9))) for _ in range(60)]
    texts += [None, "", "\n", "\n\n", "menu", "menu\nmenu\nmenu", "end\n"]
    for threshold, shortest in ((1, 1), (3, 1), (10, 1), (10, 4), (500, 1)):
        check(spark, texts, threshold, shortest)


def test_a_line_counts_once_in_a_row(spark):
    check(spark, ["same\n" * 50, "same", "other\nsame", "other\nother"], 3)
    check(spark, ["same\n" * 50, "same", "other\nother"], 3)


def test_hot_line_and_one_very_long_text(spark):
    long = "\n".join(f"line {k % 700} of a long text" if k % 3 else f"only {k}" for k in range(30_000))
    texts = [f"All Rights Reserved\nnumber {k}" for k in range(200)] + [long]
    texts += ["\n".join(f"line {k} of a long text" for k in range(0, 700, step)) for step in (1,) * 9]
    check(spark, texts, 10)


def test_other_columns_pass_and_rows_are_their_own_documents(spark):
    rows = [(None, "a\nb", {"k": 1}, "c", 7), (None, "a\nb", {"k": 1}, "c", 7), (5, "a", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, cut map<string,int>, row_ string, text_ int")
    cut, name = lines.drop_frequent_lines(docs, docs.columns, "text", 3)
    assert name == "cut_" and cut.columns == [*docs.columns, "cut_"]
    assert sorted((r.doc_id or 0, r.cut and r.cut["k"], r.text_, tuple(r[name])) for r in cut.collect()) == sorted(
        [(0, 1, 7, (2, 1, "b")), (0, 1, 7, (2, 1, "b")), (5, None, None, (1, 1, ""))], key=str
    )
    empty, name = lines.drop_frequent_lines(docs.where("doc_id = 9"), ["doc_id"])
    assert empty.collect() == [] and free_name(docs, "cut") == "cut_"


def test_no_python_in_the_plan_and_lines_are_split_once(spark):
    docs = spark.createDataFrame([(1, "a\nb")], "doc_id int, text string")
    cut, name = lines.drop_frequent_lines(docs, ["doc_id"], "text", 1)
    plan = cut.select(f"{name}.kept")._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert not any("transform" in line and "split(" in line.split("transform", 1)[1] for line in plan.splitlines())
