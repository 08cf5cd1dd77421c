import json
import os
import random

import pytest
from pyspark.sql import functions as F

from rollcall.functions.feed_json import read_feed
from rollcall.operators.ranking import ordered_lists
from rollcall.sources import documents
from rollcall.sources.documents import read_long_documents, write_document

ODD = ['a "b", c', "\\", '\\"', "", ",", ',"', "é日😀", "x\ny\tz", "[", "]}", '{"A": ["x"]}', "ends with \\\\", " "]


def names_of(found):
    return sorted((r.league_ord, r.league, r.name_ord, r.name) for r in found.collect())


def wanted(doc):
    return sorted((i, g, j, n) for i, (g, names) in enumerate(doc.items()) for j, n in enumerate(names))


def small_blocks(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")


@pytest.fixture(params=[None, 37])
def blocks(spark, request):
    """Whole files, and blocks of a few bytes, whose borders lie anywhere."""
    if request.param:
        small_blocks(spark, request.param)
    yield
    for name in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{name}")


def test_documents_of_any_layout(spark, tmp_path, blocks):
    draw = random.Random(1)
    for i, layout in enumerate([{}, {"indent": 2}, {"ensure_ascii": False}, {"separators": (",", ":")}]):
        doc = {g: [draw.choice(ODD) for _ in range(draw.randrange(6))] for g in ("B", "A, b", 'q"', "", "empty")}
        doc["empty"] = []
        path = f"{tmp_path}/{i}.json"
        with open(path, "w", encoding="utf-8") as out:
            json.dump(doc, out, **layout)
        found, bad = read_long_documents(spark, path)
        assert names_of(found) == wanted(doc) and bad.collect() == []


BAD = [
    '{"A": ["x"]} {"A": ["x"]}', '{"A": ["x"]},', '{"A": ["x"]', '{"A": ["x",]}', '{"A": ["x"] "B": []}', '["x"]', '{"A": "x"}', '{"A": [1]}',
    '{"A": ["x", ["y"]]}', '{"A": ["x"], ["y"]}', "{'A': ['x']}", '{"A": ["x\\ud800"]}', '{"A": ["x]}', '{"A": ["a\nb"]}', '{"A": ["x" "y"]}',
    '{"A": ["x"],}', '{,}', '{"A": {"B": ["x"]}}', '{"A": ["x"]}]', '"x"', '{"A": [null]}', '{"A": ["x"}]', '{"A": ["\\x"]}', '{"A"}',
]


def test_bad_documents_are_set_aside_and_no_other(spark, tmp_path):
    good = ['{}', ' {\n} ', '{"A": []}', '{"A": ["x"], "B": ["y"], "A": ["z", "w"]}', '{"A":["\\u00e9\\"", "\\ud83d\\ude00"]}\n']
    for i, body in enumerate(BAD + good):
        assert (read_feed(body)["reason"] is None) == (i >= len(BAD)), body
        with open(f"{tmp_path}/{i:02}.json", "w", encoding="utf-8", newline="") as out:
            out.write(body)
    found, bad = read_long_documents(spark, str(tmp_path))
    assert sorted(int(r.doc[-7:-5]) for r in bad.collect()) == list(range(len(BAD)))
    got = sorted((int(r.doc[-7:-5]) - len(BAD), r.league_ord, r.league, r.name_ord, r.name) for r in found.collect())
    assert got == [(3, 0, "A", 0, "z"), (3, 0, "A", 1, "w"), (3, 1, "B", 0, "y"), (4, 0, "A", 0, 'é"'), (4, 0, "A", 1, "😀")]


def lists(spark, doc, size):
    rows = [(g, i, n) for g, names in doc.items() for i, n in enumerate(names)]
    groups = spark.createDataFrame([(g,) for g in doc], "league string")
    return ordered_lists(spark.createDataFrame(rows, "league string, ord long, name string"), "league", "name", "ord", size, groups)


def concatenated(path):
    parts = sorted(x for x in os.listdir(path) if x.startswith("part-"))
    return "".join(open(f"{path}/{x}", encoding="utf-8").read() for x in parts)


@pytest.mark.parametrize("ascii_only", [False, True])
def test_one_valid_document_from_many_tasks(spark, tmp_path, blocks, ascii_only):
    doc = {"A": [f"n{i}" for i in range(50)], "B, c": ODD, "E": [], "Z": ["é, ü"] * 7}
    path = f"{tmp_path}/doc"
    write_document(lists(spark, doc, 3), path, ascii_only=ascii_only)
    body = concatenated(path)
    assert json.loads(body) == doc and body.isascii() == ascii_only
    found, bad = read_long_documents(spark, path, one=True)
    assert names_of(found) == wanted(doc) and bad.collect() == []


def test_a_long_group_keeps_all_its_names(spark, tmp_path):
    path, n = f"{tmp_path}/doc", 100_005
    rows = spark.range(n).select(F.lit("A").alias("league"), F.col("id").alias("ord"), F.concat(F.lit("name, "), "id").alias("name"))
    write_document(ordered_lists(rows, "league", "name", "ord", 4000), path)
    assert len(json.loads(concatenated(path))["A"]) == n
    small_blocks(spark, 200_000)
    try:
        found, _ = read_long_documents(spark, path, one=True)
        wrong = found.filter(F.col("name") != F.concat(F.lit("name, "), F.col("name_ord")))
        assert found.count() == n and wrong.count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_write_that_fails_leaves_nothing_to_read(spark, tmp_path):
    path = f"{tmp_path}/doc"
    rows = lists(spark, {"A": ["x"] * 40, "B": ["y"] * 40}, 2).withColumn(
        "names", F.when((F.col("league") == "B") & (F.col("part") == 19), F.array(F.raise_error(F.lit("killed")).cast("string"))).otherwise(F.col("names"))
    )
    with pytest.raises(Exception, match="killed"):
        write_document(rows, path)
    with pytest.raises(FileNotFoundError):
        read_long_documents(spark, path, one=True)


def test_a_quote_that_is_never_closed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(documents, "MOST_COMMAS", 20)
    with open(f"{tmp_path}/a.json", "w") as out:
        out.write('{"A": ["x' + ", y" * 100)
    found, bad = read_long_documents(spark, str(tmp_path))
    assert found.count() == 0 and bad.count() == 1


def test_no_names_give_an_empty_document(spark, tmp_path):
    path = f"{tmp_path}/doc"
    write_document(lists(spark, {"A": ["x"]}, 5).limit(0), path)
    found, bad = read_long_documents(spark, path, one=True)
    assert json.loads(concatenated(path)) == {} and found.count() == bad.count() == 0


def test_many_documents_are_dealt_out_by_their_rows(spark, tmp_path, monkeypatch):
    """Rows and documents of one task stay bounded, however well they compress: adaptive execution may not merge them."""
    monkeypatch.setattr(documents, "TASK_ROWS", 40)
    docs = {str(i): {f"g{i % 3}": [f"n{i}", "a, b"], "h": ["x"] * (i % 4)} for i in range(60)}
    for name, doc in docs.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(doc) if int(name) % 5 else json.dumps(doc)[:-1])
    plans = []
    real = documents.cut_lineage
    monkeypatch.setattr(documents, "cut_lineage", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df))
    names, bad = read_long_documents(spark, str(tmp_path))
    of = F.regexp_extract("doc", "([0-9]+).json", 1)
    got = sorted((r.d, r.league, r.name_ord, r.name) for r in names.withColumn("d", of).collect())
    assert got == sorted((k, g, j, n) for k, d in docs.items() if int(k) % 5 for g, ns in d.items() for j, n in enumerate(ns))
    assert sorted(int(r[0]) for r in bad.select(of).collect()) == list(range(0, 60, 5))
    # A window over rows or blocks sorts what it was dealt; only those over counted ranges are left to Spark.
    dealt = [line for text in plans[1:3] for line in text.splitlines() if "Exchange" in line and "doc#" in line]
    assert sum("REPARTITION_BY_NUM" in line for line in dealt) >= 3
