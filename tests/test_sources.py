"""Manifests, listings, audio files, voices and metrics through folders and back."""

import datetime as dt
import io
import json
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.functions import text as T
from voxloom.sources import audio as A
from voxloom.sources import manifest as M

GOOD = {"file_name": "a.wav", "text": "één", "duration": 1.5, "confidence": 0.9}


def _lines(root, split, lines):
    (root / split).mkdir(parents=True, exist_ok=True)
    (root / split / "metadata.jsonl").write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))


def test_manifest_of_all_splits(spark, tmp_path):
    _lines(tmp_path, "train", [GOOD, "", {"file_name": "b.wav", "text": "x"}])
    _lines(tmp_path, "test", [{**GOOD, "split": "test"}])
    _lines(tmp_path, "other", [GOOD])
    rows = {(r["split"], r["file_name"]): r for r in M.read_manifest(spark, str(tmp_path)).collect()}
    assert set(rows) == {("train", "a.wav"), ("train", "b.wav"), ("test", "a.wav")}
    assert rows["train", "a.wav"]["text"] == "één" and rows["train", "b.wav"]["confidence"] is None


def test_malformed_lines_are_an_error_or_reported(spark, tmp_path):
    _lines(tmp_path, "train", [GOOD, "{bad", {"text": "no name"}])
    with pytest.raises(Exception, match="(?i)malformed"):
        M.read_manifest(spark, str(tmp_path)).collect()
    assert [r["file_name"] for r in M.read_manifest(spark, str(tmp_path), strict=False).collect()] == ["a.wav"]
    problems = {(r["split"], r["problem"]): r["n"] for r in M.manifest_problems(spark, str(tmp_path)).collect()}
    assert problems == {("train", "malformed"): 1, ("train", "missing_key"): 1}


def test_a_written_manifest_replaces_the_old_one(spark, tmp_path):
    root = str(tmp_path / "m")
    rows = spark.createDataFrame([("a.wav", "ü", "train", 1.0, 0.5), ("b.wav", "", "test", 2.0, None)], "file_name string, text string, split string, duration double, confidence double")
    M.write_manifest(rows, root)
    assert sorted(map(tuple, M.read_manifest(spark, root).select(*rows.columns).collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
    M.write_manifest(rows.where("split = 'test'"), root)
    assert [r["file_name"] for r in M.read_manifest(spark, root).collect()] == ["b.wav"]


def test_listing_and_voice_files(spark, tmp_path):
    for name in ("voices/af_x.pt", "voices/bm_y.pt", "else/af_z.pt", "else/a.wav"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"abc")
    found = {(r["folder"], r["file_name"], r["length"]) for r in M.list_payloads(spark, str(tmp_path)).collect()}
    assert found == {("else", "a.wav", 3)}
    assert [r["file_name"] for r in M.voice_files(M.list_payloads(spark, str(tmp_path), "*.pt")).collect()] == ["af_x.pt"]


def test_small_files(spark, tmp_path):
    (tmp_path / "urls.txt").write_text(" https://a/b \n\nhttps://c\n")
    assert sorted(r["url"] for r in M.read_url_list(spark, str(tmp_path / "urls.txt")).collect()) == ["https://a/b", "https://c"]
    (tmp_path / "s.json").write_text('{"a":\n 1}')
    assert M.read_sidecar(spark, str(tmp_path / "s.json")).first()["a"] == 1
    df = spark.createDataFrame([("train", 2, 0.5), ("test", 1, 0.25)], "split string, segments long, hours double")
    report = spark.createDataFrame([("too_short", 3), ("clipping", 5)], "reason string, n long")
    card = M.dataset_card(df, report, "Voices")
    assert card.startswith("# Voices\n") and "| test | 1 | 0.25 |" in card and card.index("clipping") < card.index("too_short")
    M.write_report(report, str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).count() == 2
    new = M.replace_table(df, str(tmp_path / "t"))
    assert new != str(tmp_path / "t") and spark.read.parquet(new).count() == 2


def test_voices_in_both_layouts(spark, tmp_path):
    one = spark.createDataFrame([("v", [1.0, 2.0])], "voice_id string, vec array<double>")
    M.write_voices(one, str(tmp_path / "one"))
    rows = M.read_voices(spark, str(tmp_path / "one"))
    assert rows.count() == 510 and rows.agg(F.min("length_idx"), F.max("length_idx")).first()[:] == (0, 509)
    M.write_voices(rows, str(tmp_path / "all"))
    again = M.read_voices(spark, str(tmp_path / "all"))
    assert again.dtypes == [("voice_id", "string"), ("length_idx", "int"), ("vec", "array<float>")] and again.count() == 510


def test_metrics_are_appended(spark, tmp_path):
    at = dt.datetime(2024, 1, 1)
    wide = spark.createDataFrame([(at, "r1", 1, 10, 0.5, None), (at, "r2", 1, 10, 0.25, 2.0)], "ts timestamp, run string, epoch int, step long, loss double, norm double")
    for _ in range(2):
        M.append_metrics(M.metric_rows(wide, ["loss", "norm"]), str(tmp_path / "m"))
    rows = spark.read.parquet(str(tmp_path / "m"))
    assert rows.count() == 6 and rows.where("run = 'r2' AND tag = 'norm'").select("value").distinct().first()[0] == 2.0


def test_token_analysis(spark, tmp_path):
    histogram = T.token_histogram(spark.createDataFrame([("p i p x",)], "text string"))
    M.write_token_analysis(histogram, str(tmp_path))
    assert spark.read.json(f"{tmp_path}/tokens").count() == 3
    row = spark.read.json(f"{tmp_path}/summary").first()
    assert (row["vowels"], row["consonants"], row["other"]) == (1, 2, 1)


def _wav(path, x, rate, width=2, channels=1):
    path.parent.mkdir(parents=True, exist_ok=True)
    scaled = np.round(x * (2.0 ** (8 * width - 1) - 1)).astype(np.int64) + (128 if width == 1 else 0)
    raw = b"".join(int(v).to_bytes(width, "little", signed=width > 1) for v in np.repeat(scaled, channels))
    with wave.open(str(path), "wb") as f:
        f.setnchannels(channels)
        f.setsampwidth(width)
        f.setframerate(rate)
        f.writeframes(raw)


@pytest.mark.parametrize("width", [1, 2, 3, 4])
def test_decode_every_width(tmp_path, width):
    x = np.sin(np.arange(400) / 7) * 0.9
    _wav(tmp_path / "a.wav", x, 8000, width, channels=2)
    rate, got = A.decode((tmp_path / "a.wav").read_bytes())
    assert rate == 8000 and np.abs(got - x).max() < 2.0 ** (2 - 8 * width) * 1.1 + 1e-9


def test_channels_are_averaged():
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(2)
        f.setsampwidth(2)
        f.setframerate(100)
        f.writeframes(np.array([16384, 0, -16384, 0], "<i2").tobytes())
    assert A.decode(out.getvalue())[1].tolist() == [0.25, -0.25]


def test_audio_is_read_resampled_and_written(spark, tmp_path):
    x = np.sin(2 * np.pi * 50 * np.arange(1600) / 1600)
    _wav(tmp_path / "in/a.wav", x, 1600)
    _wav(tmp_path / "in/b.wav", np.zeros(0), 1600)
    (tmp_path / "in/c.wav").write_bytes(b"no audio")
    heard = A.read_audio(spark, str(tmp_path / "in"), 2400)
    rows = {r["path"][-5:]: r for r in heard.collect()}
    assert rows["a.wav"]["rate"] == 2400 and len(rows["a.wav"]["samples"]) == 2400 and rows["a.wav"]["duration"] == 1.0
    inside = slice(60, -60)  # what lies outside the signal counts as silence, so its ends fade
    assert np.allclose(rows["a.wav"]["samples"][inside], np.sin(2 * np.pi * 50 * np.arange(2400) / 2400)[inside], atol=1e-3)
    assert rows["b.wav"]["samples"] == [] and rows["c.wav"]["samples"] is None and "Error" in rows["c.wav"]["error"]

    root = (tmp_path / "out").as_uri()
    segments = A.audio_only(heard).unionByName(spark.createDataFrame([("bad.wav", "t", "test", 0.5, None, None), ("good.wav", "hé", "test", 0.5, 100, [0.5, -2.0])], "file_name string, text string, split string, confidence double, rate int, samples array<double>"))
    done = {r["file_name"]: r for r in A.write_dataset(segments, root).collect()}
    assert sorted(done) == ["bad.wav", "good.wav", "segment_00000.wav", "segment_00001.wav"] and done["bad.wav"]["error"] and not done["good.wav"]["error"]
    manifest = {r["file_name"]: r for r in M.read_manifest(spark, root).collect()}
    assert sorted(manifest) == ["good.wav", "segment_00000.wav", "segment_00001.wav"]
    assert manifest["good.wav"]["text"] == "hé" and manifest["segment_00000.wav"]["text"] == "" and manifest["segment_00000.wav"]["confidence"] is None
    assert sorted(p.name for p in (tmp_path / "out/audio").rglob("*") if p.is_file()) == ["good.wav", "segment_00000.wav", "segment_00001.wav"]
    again = {r["path"][-8:]: r for r in A.read_audio(spark, root + "/audio").collect()}
    assert np.allclose(again["good.wav"]["samples"], [0.5, -1.0])
