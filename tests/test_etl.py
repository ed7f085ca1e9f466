"""Text records, tags, sources, numbering and evaluation."""

import gzip
import io
import tarfile

import pytest
from pyspark.sql import functions as F

from graphloom.functions import text
from graphloom.functions.ordering import dense_index, exact_median, next_value, running_totals
from graphloom.operators import etl, tabular
from graphloom.sources import tables as src

FIRST = r"""------------------------------------------------------------------------------
\\
Paper: hep-th/9612115
From: Asato Tsuchiya <someone@example.org>
Date: Wed, 11 Dec 1996 17:38:56 +0900   (20kb)
Date (revised): Tue, 31 Dec 1996 01:06:34 +0900

Title: A Large-N Reduced Model as Superstring
Authors: N. Ishibashi and others
Comments: 29 pages, Latex
  corrected, minor corrections
Report-no: KEK-TH-503, TIT/HEP-357
Journal-ref: Nucl.Phys. B498 (1997) 467-491
\\
  A matrix model is proposed.
Interactions are  analyzed.
\\
"""
SECOND = """Paper: hep-th/9711029
From: John Schwarz <someone@example.org>
Date: Wed, 5 Nov 1997 17:30:55 GMT   (20kb)
Title: The Status of String Theory
Author: John H. Schwarz
Report-no: CALT-68-2140
\\
  There have been many developments.
\\
"""


def fields(spark, record):
    df = spark.createDataFrame([(record,)], "record string")
    return df.select(*[text.record_field("record", f).alias(f) for f in text.RECORD_PATTERNS]).first().asDict()


def test_record_fields(spark):
    first, second = fields(spark, FIRST), fields(spark, SECOND)
    assert first == {
        "paper": "hep-th/9612115", "from": "Asato Tsuchiya", "date": "Wed, 11 Dec 1996 17:38:56 +0900",
        "title": "A Large-N Reduced Model as Superstring", "authors": "N. Ishibashi and others",
        "comments": "29 pages, Latex", "report_no": "KEK-TH-503, TIT/HEP-357",
        "journal_ref": "Nucl.Phys. B498 (1997) 467-491",
        "abstract": "A matrix model is proposed. Interactions are analyzed.",
    }
    assert second["authors"] is None and second["journal_ref"] is None and second["abstract"] is None
    assert second["from"] == "John Schwarz"
    # single-backslash bars do not make an abstract
    assert fields(spark, FIRST.replace("\\\\", "\\"))["abstract"] is None


def test_tags_and_cleaning(spark):
    df = spark.createDataFrame([("|a|b|", "<a><b>", "J. Phys. 12"), ("", "", ""), (None, None, None)], "p string, t string, j string")
    rows = df.select(text.split_pipe_tags("p"), text.angle_tags("t"), text.letters_only("j"), text.is_blank("j")).collect()
    assert [tuple(r) for r in rows] == [(["a", "b"], ["a", "b"], "J.Phys", False), ([""], [], "", True), (None, [], None, True)]


def test_schema_conflict_is_an_error(spark):
    with pytest.raises(TypeError):
        etl.align_schema(spark.range(1), spark.createDataFrame([("x",)], "id string"))


def test_edge_list_and_dates(spark, tmp_path):
    with gzip.open(tmp_path / "edges.txt.gz", "wt") as f:
        f.write("# head\n0001001\t9304045\n# again\n9304045\t0001001\n")
    rows = {(r.edge_id, r.src, r.dst) for r in src.scan_edge_list(spark, str(tmp_path / "edges.txt.gz")).collect()}
    assert rows == {(1, 1001, 9304045), (3, 9304045, 1001)}
    (tmp_path / "dates.txt").write_text("# head\n0001001\t1970-01-02\n")
    assert src.scan_dates(spark, str(tmp_path / "dates.txt")).first()["published"] == 86400


def test_records_from_tar(spark, tmp_path):
    with tarfile.open(tmp_path / "a.tar.gz", "w:gz") as archive:
        for name, body in (("1992/9201001.abs", b"Paper: one"), ("1992/9201002.abs", b"Paper: two")):
            info = tarfile.TarInfo(name)
            info.size = len(body)
            archive.addfile(info, io.BytesIO(body))
    rows = {(r.file_id, r.record) for r in src.scan_record_tars(spark, str(tmp_path / "*.tar.gz")).collect()}
    assert rows == {(9201001, "Paper: one"), (9201002, "Paper: two")}


def test_cached_table_computes_once(spark, tmp_path):
    calls = []

    def compute():
        calls.append(1)
        return spark.range(3)

    for _ in range(2):
        assert src.cached_table(spark, str(tmp_path / "t"), compute).count() == 3
    assert len(calls) == 1


def test_numbering_over_many_partitions(spark):
    df = spark.range(0, 5000, 1, 16).select(((F.col("id") * 7919) % 5000).alias("k"))
    numbered = dense_index(df, ["k"], "n")
    assert numbered.filter("k <> n").count() == 0 and numbered.count() == 5000
    sums = running_totals(df.withColumn("one", F.lit(1)), ["k"], {"one": "upto"})
    assert sums.filter("upto <> k + 1").count() == 0
    assert exact_median(df, "k", "m").first()["m"] == 2499.5
    # one group holds nearly every row
    hot = spark.range(0, 3000, 1, 8).select(F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(-1).alias("g"), "id")
    following = next_value(hot, "g", ["id"], "id", "next").filter("g = -1").orderBy("id").collect()
    assert [r["next"] for r in following] == [r["id"] for r in following[1:]] + [None]


def test_scores(spark):
    df = spark.createDataFrame([(0.1, False), (0.4, True), (0.4, False), (0.9, True)], "s double, y boolean")
    assert tabular.roc_auc(df, "s", "y").first()["auc"] == 0.875
    pairs = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b")], "label string, prediction string")
    scores = tabular.weighted_scores(pairs).first()
    assert abs(scores["accuracy"] - 2 / 3) < 1e-9 and abs(scores["precision"] - (2 / 3 * 1 + 1 / 3 * 0.5)) < 1e-9


def test_clean_property_map(spark):
    df = spark.createDataFrame([(1, {"a": "x", "n": "1"}), (2, {"a": "", "n": ""}), (3, {"a": "y", "n": "2"})], "id int, props map<string,string>")
    rows = {(r.id, r.property): r.value for r in etl.clean_property_map(df, "id", "props").collect()}
    assert rows[(2, "a")] == "0" and rows[(2, "n")] == ""
