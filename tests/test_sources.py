"""Sources, sinks and the stream of arriving files, through folders made here."""

import json

from pyspark.sql import functions as F

from lexflume.functions import text as T
from lexflume.sinks import corpus as sink
from lexflume.sources import corpus as source
from lexflume.streaming.incremental import convert_arriving


def test_records_of_a_corpus(spark, tmp_path):
    for slug, body in {"a": json.dumps({"n_pages": 3, "title": "x"}), "b": "{broken", "_c": json.dumps({"n_pages": 1})}.items():
        (tmp_path / slug).mkdir()
        (tmp_path / slug / "stats.json").write_text(body)
        (tmp_path / slug / "raw_text.txt").write_text(f"{slug}\n\nend")
    got = source.read_records(spark, str(tmp_path), "stats.json", "n_pages int, title string").collect()
    assert [tuple(r) for r in got] == [("a", 3, "x")]
    assert sorted(map(tuple, source.read_texts(spark, str(tmp_path)).collect())) == [("a", "a\n\nend"), ("b", "b\n\nend")]


def test_files_by_content(spark, tmp_path):
    for name, body in {"b.pdf": b"one", "a.pdf": b"one", "c.pdf": b"two", "d.txt": b"three"}.items():
        (tmp_path / name).write_bytes(body)
    got = source.read_files(spark, str(tmp_path)).collect()
    assert sorted(r.path.rsplit("/", 1)[1] for r in got) == ["a.pdf", "c.pdf"]
    assert {r.length for r in got} == {3}


def test_append_new_keeps_what_is_there(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda *ids: spark.createDataFrame([(i, f"v{i}") for i in ids], "id int, v string")
    sink.append_new(rows(1, 2), path, "id")
    sink.append_new(rows(2, 3), path, "id")
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2, 3]


def test_texts_go_one_file_a_paper(spark, tmp_path):
    rows = spark.createDataFrame([("a", "x\ny"), ("b", "z")], "slug string, text string")
    sink.write_texts(rows, str(tmp_path / "t"))
    found = {p.parent.name: p.read_text() for p in (tmp_path / "t").glob("slug=*/part-*")}
    assert found == {"slug=a": "x\ny\n", "slug=b": "z\n"}
    sink.write_records(rows, str(tmp_path / "j"))
    assert sorted(p.parent.name for p in (tmp_path / "j").glob("slug=*/part-*.json")) == ["slug=a", "slug=b"]


def test_arriving_files_are_converted_once(spark, tmp_path):
    src, out, at = (str(tmp_path / x) for x in ("src", "out", "at"))

    def arrive(i, text):
        spark.createDataFrame([(i, text)], "doc_id long, text string").coalesce(1).write.mode("append").parquet(src)
        q = convert_arriving(spark, src, "doc_id long, text string", out, at, lambda d: d.select("doc_id", T.dehyphenate(F.col("text")).alias("text")))
        assert q.awaitTermination(60)

    arrive(1, "broken-\nword")
    arrive(2, "whole")
    assert sorted((r.doc_id, r.text) for r in spark.read.parquet(out).collect()) == [(1, "brokenword"), (2, "whole")]
