"""Physical lines over split files."""

import pytest

from voxloom.sources import lines


@pytest.fixture
def small_pieces(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def _folder(tmp_path):
    files = {"a.txt": "".join(f"line {i} {'x' * (i % 40)}\n" * (i % 3 > 0) + "\n" * (i % 5 == 0) for i in range(300)), "b.txt": "one\n\n\nfour", "c.txt": "", "d.txt": "\n"}
    (tmp_path / "in").mkdir()
    for name, text in files.items():
        (tmp_path / "in" / name).write_bytes(text.encode())
    return {name: text.split("\n")[: -1 if text.endswith("\n") or not text else None] for name, text in files.items()}


def test_numbers_over_pieces(spark, small_pieces, tmp_path):
    want = {(f, i + 1, v) for f, found in _folder(tmp_path).items() for i, v in enumerate(found)}
    df = lines.numbered_lines(spark, str(tmp_path / "in"))
    got = df.collect()
    assert {(r["file"][-5:], r["line"], r["value"]) for r in got} == want and len(got) == len(want)
    assert spark.read.text(str(tmp_path / "in")).rdd.getNumPartitions() > 20


@pytest.mark.parametrize("k", [0, 1, 3, 37, 10_000])
def test_the_first_lines_of_each_file(spark, small_pieces, tmp_path, k):
    want = {(f, i + 1, v) for f, found in _folder(tmp_path).items() for i, v in enumerate(found[:k])}
    got = lines.first_lines(spark, str(tmp_path / "in"), k).collect()
    assert {(r["file"][-5:], r["line"], r["value"]) for r in got} == want and len(got) == len(want)


def test_bad_and_blank_lines_count(spark, small_pieces, tmp_path):
    text = ['{"file_name": "a.wav", "text": "é"}', "", "{broken", "[1]", '  {"text": "t"}', '{"file_name": "late"}']
    (tmp_path / "metadata.jsonl").write_text("\n".join(text))
    rows = lines.sampled_rows(spark, str(tmp_path), "file_name string, text string", 5).orderBy("line").collect()
    assert [r["problem"] for r in rows] == [None, "blank", "malformed", "malformed", None]
    assert [r["row"] and tuple(r["row"]) for r in rows] == [("a.wav", "é"), None, None, None, (None, "t")]
