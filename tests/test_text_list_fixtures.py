"""Logs, text and list analytics on hand-made inputs."""

import pytest
from pyspark.sql import functions as F

from sparklytics.functions.logparse import parse_access_log
from sparklytics.operators import lists as L
from sparklytics.operators import logs, text
from sparklytics.sources.text import read_documents, read_lines


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) if cols else tuple(r) for r in df.collect())


LOG = [
    '10.0.0.153 - - [10/Mar/2004:12:02:59 -0800] "POST /cgi-bin/mailgraph2.cgi HTTP/1.1" 200 2987',
    '10.0.0.1 - - [10/Mar/2004:12:03:00 -0800] "GET /twiki/bin/edit/Main/Double_bounce_sender?x=1 HTTP/1.1" 401 12846',
    '10.0.0.2 - - [10/Mar/2004:12:04:00 -0800] "POST /a HTTP/1.1" 200 -',
    '10.0.0.153 - - [10/Mar/2004:12:05:00 -0800] "POST /b HTTP/1.1" 200 100',
    '10.0.0.9 - - [10/Mar/2004:12:06:00 -0800] "GET /POST HTTP/1.1" 200 5',
]


def test_access_log_analytics(spark):
    lines = spark.createDataFrame(list(enumerate(LOG)), "line_no long, value string")
    p = parse_access_log(lines).collect()[0]
    assert (p["client"], p["time"], p["method"], p["path"], p["status"], p["size"]) == (
        "10.0.0.153", "10/Mar/2004:12:02:59", "POST", "/cgi-bin/mailgraph2.cgi", "200", "2987")
    assert rows(logs.post_requests(lines), "path") == [("/a",), ("/b",), ("/cgi-bin/mailgraph2.cgi",)]  # D19
    assert rows(logs.largest_post_response(lines)) == [("10.0.0.153", "/cgi-bin/mailgraph2.cgi")]
    assert rows(logs.top_post_client(lines)) == [(2, "10.0.0.153")]
    got = logs.first_quoted_requests(lines, "line_no", "GET", 1).collect()
    assert got[0]["request"] == "GET /twiki/bin/edit/Main/Double_bounce_sender?x=1 HTTP/1.1"
    csv = logs.access_log_to_csv(lines).orderBy("Time").first()
    assert tuple(csv) == ("10.0.0.153", "10/Mar/2004:12:02:59", "POST", "/cgi-bin/mailgraph2.cgi", "200", "2987")


def test_files_lines_and_csv_sink(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "error_log").write_text("a\nFile does not exist: /x\nb\n")
    (tmp_path / "sub" / "Access_LOG.txt").write_text("\n".join(LOG) + "\n")
    (tmp_path / "other.txt").write_text("nothing\n")
    found = sorted(r["path"].rsplit("/", 1)[1] for r in logs.find_files_by_name(spark, str(tmp_path)).collect())
    assert found == ["Access_LOG.txt", "error_log"]
    lines = read_lines(spark, str(tmp_path / "error_log"))
    assert [r["value"] for r in logs.lines_containing(lines).collect()] == ["File does not exist: /x"]
    ordered = read_lines(spark, str(tmp_path / "sub")).orderBy("line_key")
    assert [r["value"] for r in ordered.collect()] == LOG
    out = str(tmp_path / "csv")
    logs.write_csv(logs.access_log_to_csv(spark.createDataFrame([(0, LOG[0])], "line_no long, value string")), out)
    assert spark.read.text(out).first()["value"] == "10.0.0.153,10/Mar/2004:12:02:59,POST,/cgi-bin/mailgraph2.cgi,200,2987"


def test_book(spark, tmp_path):
    (tmp_path / "1-intro.txt").write_text("Vokali i am. i go\nto the\nsea.")
    (tmp_path / "2-ch1.txt").write_text("Is it i? The Book the book. Naïve iris.")
    (tmp_path / "0-blank.txt").write_text(" .. \n. ")  # no sentence at all: must not use up a slot
    docs = read_documents(spark, str(tmp_path))
    fixed = {r["path"].rsplit("/", 1)[1]: r["text"] for r in text.fix_lowercase_i(docs).collect()}
    assert fixed["1-intro.txt"] == "Vokali I am. I go\nto the\nsea."
    assert fixed["2-ch1.txt"] == "Is it I? The Book the book. Naïve iris."
    sent = [r["sentence"] for r in text.first_sentences(docs, "path", 4).collect()]
    assert sent == ["Vokali i am", "i go to the sea", "Is it i? The Book the book", "Naïve iris"]
    top = text.top_words(docs, 2).collect()
    assert [tuple(r) for r in top] == [(3, "the"), (3, "i")]


def test_list_functions(spark):
    df = spark.createDataFrame([(1, [1, 2, 3]), (2, []), (3, [30, 26, 4, 50, 60])], "id int, xs array<int>")
    got = {r["id"]: r for r in df.select(
        "id",
        L.array_map("xs", lambda x: x + 1).alias("m"),
        L.array_filter("xs", lambda x: x > 2).alias("f"),
        L.array_fold_left("xs", F.lit(""), lambda a, x: F.concat(a, x.cast("string"))).alias("fl"),
        L.array_fold_right("xs", F.lit(""), lambda x, a: F.concat(a, x.cast("string"))).alias("fr"),
        L.array_zip_shortest("xs", F.array(F.lit("a"))).alias("z"),
        L.array_first_n("xs", -1).alias("n0"), L.array_first_n("xs", 2).alias("n2"),
        L.list_max("xs").alias("mx"), L.list_sum("xs").alias("s"),
        L.list_first_divisible("xs", 3).alias("d3"),
        L.list_avg_first_n_above("xs", 25, 2).alias("avg"),
        L.list_sum_first_n_above("xs", 2, 25).alias("s2"),
    ).collect()}
    assert got[1]["m"] == [2, 3, 4] and got[1]["f"] == [3]
    assert got[1]["fl"] == "123" and got[1]["fr"] == "321"
    assert [tuple(p) for p in got[1]["z"]] == [(1, "a")]  # F6
    assert got[1]["n0"] == [] and got[1]["n2"] == [1, 2]
    assert got[2]["mx"] is None and got[2]["s"] == 0 and got[2]["avg"] is None  # D23
    assert got[1]["d3"] == 3 and got[2]["d3"] is None and got[3]["d3"] == 30
    assert got[3]["avg"] == 28 and got[3]["s2"] == 56


def test_optional_lists_and_deep_flatten(spark):
    df = spark.createDataFrame([([1, None, 4, 6, 7],)], "xs array<int>")
    r = df.select(L.list_sum_defined("xs").alias("s"), L.list_even_defined("xs").alias("e")).first()
    assert (r["s"], r["e"]) == (18, [4, 6])
    j = spark.createDataFrame([("[[1],[2,[3,[4]]],5]",), ('[["a,]", [true, null]], -2.5e3]',)], "j string")
    got = [r["f"] for r in j.select(L.json_flatten_deep("j").alias("f")).collect()]
    assert got == [["1", "2", "3", "4", "5"], ['"a,]"', "true", "null", "-2.5e3"]]  # F3
    typed = spark.createDataFrame([([[[1], [2, 3]], [[4]]],)], "x array<array<array<int>>>")
    assert typed.select(L.array_flatten_deep(typed, "x").alias("f")).first()["f"] == [1, 2, 3, 4]


def test_grouped_list_analytics(spark):
    grades = spark.createDataFrame([(1, 1, 6), (1, 2, 6), (2, 1, 10), (2, 2, 3), (3, 1, 5), (3, 2, 6)],
                                   "student_id long, pos long, grade long")
    assert L.passing_students(grades).first()["passing"] == 1  # 5.5 average fails, a 3 fails
    items = spark.createDataFrame([(1, i, v) for i, v in enumerate([30, 1, 40, 50, 26])], "list_id long, pos long, value long")
    assert L.sum_first_n_above(items, 2, 25).first()["total"] == 70
    lists = spark.createDataFrame([(1, [3, 1, 1]), (0, [5, 1]), (2, [2, 2])], "list_id long, xs array<int>")
    assert L.first_head_sums_tail(lists).first()["size"] == 2
    none = spark.createDataFrame([(0, [5, 1])], "list_id long, xs array<int>")
    assert L.first_head_sums_tail(none).first()["size"] is None
    n = spark.range(1, 16).select(L.fizzbuzz_label("id").alias("l"))
    assert [r["l"] for r in n.collect()][-3:] == ["13", "14", "FizzBuzz"]


def test_variant_flatten_and_long_form(spark):
    j = spark.createDataFrame([("[[1],[2,[3,[4]]],5]",)], "j string")
    v = j.select(L.json_flatten_deep("j", "variant").alias("v")).first()["v"]
    assert [x.toPython() for x in v] == [1, 2, 3, 4, 5]
    items = spark.createDataFrame([(1, 0, 3), (1, 1, None), (1, 2, 9), (2, 0, None)], "list_id long, pos long, value long")
    got = {r["list_id"]: (r["max"], r["sum"], r["defined"]) for r in L.per_list(items).collect()}
    assert got == {1: (9, 12, 2), 2: (None, 0, 0)}


def test_log_to_csv_tool(spark, tmp_path):
    import importlib.util
    import os
    spec = importlib.util.spec_from_file_location(
        "log_to_csv", os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools", "log_to_csv.py"))
    tool = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(tool)
    (tmp_path / "access_log").write_text("\n".join(LOG) + "\n")
    tool.convert(spark, str(tmp_path / "access_log"), str(tmp_path / "csv"))
    got = sorted(r["value"] for r in spark.read.text(str(tmp_path / "csv")).collect())
    assert len(got) == len(LOG) and "10.0.0.2,10/Mar/2004:12:04:00,POST,/a,200,-" in got


def test_csv_sink_does_not_overwrite(spark, tmp_path):
    out = str(tmp_path / "csv")
    rows = logs.access_log_to_csv(spark.createDataFrame([(0, LOG[0])], "line_no long, value string"))
    logs.write_csv(rows, out)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        logs.write_csv(rows, out)
    logs.write_csv(rows, out, mode="overwrite")
    assert spark.read.csv(out).count() == 1
