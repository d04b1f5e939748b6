from pyspark.sql import functions as F

from lodestat.sources import documents, files


def test_parse_documents(lines):
    rows = documents.parse_documents(
        documents.valid_lines(
            lines(
                '<doc id="12" url="http://x" title="T|U">A | b > "c"</doc>',
                '<doc id="13" title="T">no url</doc>',
                '<doc id="14" url="http://x no text mark</doc>',
                "url= without the mark of an id",
                '<doc id="15" url="u">x</doc>',
                '<doc id="16" url="u">abc',
                "",
            )
        )
    )
    assert {tuple(r) for r in rows.collect()} == {("12", 'A | b > "c"'), ("15", "x"), ("16", "")}


def test_parse_lines_keeps_every_line(lines):
    text = lines('<doc id="1" url="u">abc</doc>', "junk", '<doc id="2" url="u" no text', "")
    assert [tuple(r) for r in documents.parse_lines(text).collect()] == [("1", "abc"), (None, None), (None, None), (None, None)]


def test_parse_links(lines):
    rows = documents.parse_links(lines('"1","Sport"', '"2","a,b"', "3,plain", '"4"')).collect()
    assert {tuple(r) for r in rows} == {("1", "Sport"), ("2", "a"), ("3", "plain")}


def test_csv_links_keep_quoted_commas(spark, tmp_path):
    path = str(tmp_path / "links")
    rows = [("1", 'a, "b"'), ("2", "plain"), ("3", "back\\slash")]
    files.write_csv(spark.createDataFrame(rows, "doc_id string, category string"), path)
    assert sorted(tuple(r) for r in files.read_csv(spark, path, "doc_id string, category string").collect()) == rows


def test_parse_posts(lines):
    rows = documents.parse_posts(
        lines(
            '<doc id="news/sci.space/101" url="">hello </doc> tail',
            '<doc id="flat">x</doc>',
            '<doc id="news/a/1">open end',
            "no tag at all",
        )
    ).collect()
    assert [r["doc_id"] for r in rows] == ["news/sci.space/101", "flat", "news/a/1", ""]
    assert [r["category"] for r in rows] == ["sci.space", None, "a", None]
    assert [r["body"] for r in rows] == [">hello ", ">x", ">open en", ""]
    assert rows[0]["header"] == '<doc id="news/sci.space/101" url="">' and rows[3]["header"] == ""


def test_labels(spark):
    docs = spark.createDataFrame([("AU1",), ("1",), ("xAUx",)], "doc_id string")
    marked, rest = documents.split_by_class(docs)
    assert (marked.count(), rest.count()) == (2, 1)
    labels = docs.select(documents.class_label(F.col("doc_id")), documents.class_label(F.col("doc_id"), negative=-1))
    assert [tuple(r) for r in labels.collect()] == [(1, 1), (0, -1), (1, 1)]
