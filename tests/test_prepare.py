"""From audio to a dataset over the command line: what is kept, what is reported, what a second call does."""

import json

import numpy as np
import pytest

from voxloom.__main__ import main
from voxloom.plans.prepare import Config, Preparation, stages
from voxloom.sources import audio as A
from voxloom.sources import manifest as M

RATE = 8000


def _speech(rng, seconds, level=0.5):
    """A tone whose loudness breathes, with a little noise, as a gate for signal over noise wants it."""
    t = np.arange(int(seconds * RATE)) / RATE
    return level * np.sin(2 * np.pi * 200 * t) * (0.02 + np.abs(np.sin(2 * np.pi * 1.5 * t)) ** 3) + rng.normal(size=len(t)) * 1e-4


def _folder(tmp_path):
    rng = np.random.default_rng(2)
    quiet = np.zeros(RATE)
    (tmp_path / "in/deep").mkdir(parents=True)
    signals = {"a.wav": [quiet, _speech(rng, 2), quiet, _speech(rng, 3), quiet, _speech(rng, 0.3), quiet], "deep/b.wav": [_speech(rng, 2.5), quiet, rng.normal(size=2 * RATE) * 0.2, quiet], "c.wav": [quiet]}
    for name, parts in signals.items():
        (tmp_path / "in" / name).write_bytes(A.encode(np.concatenate(parts), RATE))
    (tmp_path / "in/d.wav").write_bytes(b"no audio")
    (tmp_path / "in/e.raw").write_bytes((_speech(rng, 2) * 32767).astype("<i2").tobytes())
    return str(tmp_path / "in"), (tmp_path / "out").as_uri()


def _report(tmp_path, name):
    return [json.loads(line) for p in (tmp_path / f"out/_reports/{name}").glob("part-*") for line in p.read_text().splitlines()]


def test_a_dataset_from_the_command_line(spark, tmp_path, capsys):
    source, out = _folder(tmp_path)
    args = ["prepare", source, "-o", out, "--target-rate", str(RATE), "--min-speech-ms", "500", "--save-config", str(tmp_path / "saved")]
    assert main(args, spark) == 0
    shown = capsys.readouterr().out
    rows = M.read_manifest(spark, f"{out}/manifest").collect()
    heard = {r["path"].rsplit("/", 1)[-1]: r["duration"] for r in A.read_audio(spark, f"{out}/audio").collect()}
    assert len(rows) == 3 and {r["file_name"] for r in rows} == set(heard) and "ALL\t3" in shown
    assert sorted(round(d, 1) for d in heard.values()) == pytest.approx([2.0, 2.5, 3.0], abs=0.15)
    reasons = {r["reason"]: r["n"] for r in _report(tmp_path, "reasons")}
    assert reasons["low_snr"] == 1 and _report(tmp_path, "quality")[0]["total"] == 4
    assert [r["path"][-5:] for r in _report(tmp_path, "unreadable")] == ["d.wav"]

    args = args[:-2]  # not saved again
    assert main(args, spark) == 2 and "resume or restart" in capsys.readouterr().err
    assert main([*args, "--min-snr-db", "3", "--resume"], spark) == 2 and "other settings" in capsys.readouterr().err
    assert main(["prepare", "--config", str(tmp_path / "saved"), "--resume"], spark) == 0
    assert main(["prepare", "--config", str(tmp_path / "saved"), "--min-snr-db", "-50", "--force-restart"], spark) == 0
    assert M.read_manifest(spark, f"{out}/manifest").count() == 4
    assert main(["check", f"{out}"], spark) == 0
    (tmp_path / "out/audio/train").mkdir(exist_ok=True)
    (tmp_path / "out/audio/train/left.wav").write_bytes(b"x")
    assert main(["check", out, "--delete-list", str(tmp_path / "gone")], spark) == 1
    assert [r["value"] for r in spark.read.text(str(tmp_path / "gone")).collect()] == ["left.wav"]


def test_stages_left_out_a_decoder_and_a_transcriber(spark, tmp_path):
    source, out = _folder(tmp_path)
    raw = {"raw": lambda content: (RATE, np.frombuffer(content, "<i2") / 32768)}
    config = Config((source,), out, skip=("segment", "clean", "enhance"), target_rate=RATE, ratios=(1.0, 0.0, 0.0))

    def said(model, samples):
        return f"{model} {1 / (len(samples) > RATE):.0f}"

    stats = Preparation(spark, config, raw, (lambda: "heard", said)).execute().collect()
    assert {r["split"]: r["segments"] for r in stats} == {"ALL": 4, "train": 4}
    texts = [r["text"] for r in M.read_manifest(spark, f"{out}/manifest").collect()]
    assert sorted(texts) == ["", "heard 1", "heard 1", "heard 1"]  # the file of one second divides by zero


def test_settings(spark, tmp_path):
    config = Config(["x"], "y", seed=7)
    config.save(spark, str(tmp_path / "c"))
    assert Config.load(spark, str(tmp_path / "c")) == config and Config.load(spark, str(tmp_path / "c"), seed=8).seed == 8
    for wrong in ({"inputs": ()}, {"skip": ("listen",)}, {"target_rate": 0}, {"min_duration": 20.0}, {"ratios": (0.5, 0.2, 0.2)}):
        with pytest.raises(ValueError):
            Config(**{"inputs": ("x",), "output": "y", **wrong})
    spark.createDataFrame([('{"inputs": ["x"], "output": "y", "colour": 1}',)], "value string").write.text(str(tmp_path / "odd"))
    with pytest.raises(ValueError, match="colour"):
        Config.load(spark, str(tmp_path / "odd"))
    assert main(["prepare", "x"], spark) == 2 and len(stages(spark, config)) == 6


def test_filter_by_confidence(spark, tmp_path, capsys):
    rows = spark.createDataFrame([("a.wav", "a", "train", 1.0, 0.9), ("b.wav", "b", "train", 1.0, 0.2), ("c.wav", "c", "test", 1.0, None)], M.MANIFEST)
    M.write_manifest(rows, str(tmp_path / "m"))
    assert main(["filter-confidence", str(tmp_path / "m"), "--apply", str(tmp_path / "kept")], spark) == 0
    assert capsys.readouterr().out.splitlines()[1].startswith("3\t2\t1")
    assert sorted(r["file_name"] for r in M.read_manifest(spark, str(tmp_path / "kept")).collect()) == ["a.wav", "c.wav"]
