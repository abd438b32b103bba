from pyspark.sql import functions as F

from docloom.functions.text import fill, markup_to_text, namespace
from docloom.operators import chunk, extract

SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
BLOBS = [
    ("no.html", None),
    ("empty.html", b""),
    ("bytes.html", b"\xff\xfe\xfa"),
    ("letter.doc", b"x"),
    ("noext", b"plain"),
    ("good.html", "<html><p>Grüße &amp;lt; tom &amp; co</p><script>var a='</p>';</script></html>".encode()),
    ("http://x.example.com/7?page=2", b"<!DOCTYPE html><p>a<br>b</p>"),
]


def bronze(spark):
    rows = [(p, None, None if c is None else len(c), c) for p, c in BLOBS]
    return spark.createDataFrame(rows, SCHEMA)


def test_statuses(spark):
    got = {r.path: r for r in extract.silver(bronze(spark)).collect()}
    assert got["no.html"].parser_status == "ERROR: no content"
    assert got["empty.html"].parser_status == "ERROR: empty content"
    assert got["bytes.html"].parser_status == "ERROR: content is not UTF-8"
    assert got["letter.doc"].parser_status == "ERROR: no extractor for .doc"
    assert got["noext"].parser_status == "ERROR: no extractor for ."
    for r in got.values():
        if r.parser_status.startswith("ERROR"):
            assert r.doc_parsed_contents == {"num_pages": "", "parsed_content": ""}
    assert got["good.html"].doc_parsed_contents == {"num_pages": "1", "parsed_content": "Grüße &lt; tom & co"}
    assert got["http://x.example.com/7?page=2"].doc_parsed_contents["parsed_content"] == "a b"


def test_failures_have_no_chunks(spark):
    silver = extract.silver(bronze(spark))
    assert {r.path for r in chunk.gold(silver).collect()} == {"good.html", "http://x.example.com/7?page=2"}
    counts = {r.status: r.n for r in extract.status_counts(silver).collect()}
    assert counts == {
        "SUCCESS": 2,
        "ERROR: no content": 1,
        "ERROR: empty content": 1,
        "ERROR: content is not UTF-8": 1,
        "ERROR: no extractor for .doc": 1,
        "ERROR: no extractor for .": 1,
    }


def test_supplied_extractor(spark):
    def pages(content):
        if content == b"x":
            return ["one", "two"]
        raise ValueError("broken")

    more = bronze(spark).unionByName(spark.createDataFrame([("bad.doc", None, 1, b"y")], SCHEMA))
    got = {r.path: r for r in extract.silver(more, {"doc": pages}).collect()}
    assert len(got) == len(BLOBS) + 1
    assert got["letter.doc"].doc_parsed_contents == {"num_pages": "2", "parsed_content": "one\ntwo"}
    assert got["bad.doc"].parser_status == "ERROR: broken"
    assert got["good.html"].parser_status == "SUCCESS"


def test_pages_in_order(spark):
    rows = [("d", i, f"p{i}") for i in range(3000)] + [("e", 0, "only")]
    df = spark.createDataFrame(rows, "doc string, no int, text string").repartition(5)
    got = {r.path: r for r in extract.page_concat(df, "doc", "no", "text").collect()}
    assert got["d"].num_pages == "3000"
    assert got["d"].parsed_content == "\n".join(f"p{i}" for i in range(3000))
    assert got["e"].parsed_content == "only"


def test_namespace(spark):
    users = {"jo.smith@x.y": "jo_smith", "jo.hé-1@x.y": "jo_hé_1", "a½‿b@x.y": "a½_b", "plain": "plain"}
    df = spark.createDataFrame([(u,) for u in users], "u string")
    assert {r.u: r.n for r in df.select("u", namespace(F.col("u")).alias("n")).collect()} == users


def test_values_are_no_templates(spark):
    df = spark.createDataFrame([("{b} and {a}", "x")], "a string, b string")
    got = df.select(fill("<{a}|{b}>", a=F.col("a"), b=F.col("b")).alias("t")).first().t
    assert got == "<{b} and {a}|x>"


def test_markup_order(spark):
    html = "<style>p{}</style>A<!-- <b>gone</b> -->B&nbsp;&amp;quot;<script>'<!--'</script>C"
    df = spark.createDataFrame([(html,)], "h string")
    assert df.select(markup_to_text(F.col("h")).alias("t")).first().t == "A B &quot; C"
