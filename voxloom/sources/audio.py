"""Audio payloads: WAV files to signals and back.

Spark's binary source reads a file to a row; what can't be decoded or written
becomes a row with an error and stops nothing.
"""

from __future__ import annotations

import io
import uuid
import wave
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rates import in_new_rate
from ..operators.splits import numbered
from ..schema import MANIFEST
from .manifest import write_manifest

SIGNAL = "path string, rate int, samples array<double>, duration double, error string"


def decode(content: bytes) -> tuple[int, np.ndarray]:
    """Rate and mono signal, the mean of all channels, of PCM with 8, 16, 24 or 32 bits."""
    with wave.open(io.BytesIO(content)) as f:
        rate, channels, width, raw = f.getframerate(), f.getnchannels(), f.getsampwidth(), f.readframes(f.getnframes())
    if width == 1:
        x = np.frombuffer(raw, np.uint8) / 128 - 1
    elif width == 3:
        wide = np.zeros((len(raw) // 3, 4), np.uint8)
        wide[:, 1:] = np.frombuffer(raw, np.uint8).reshape(-1, 3)
        x = wide.view("<i4")[:, 0] / 2**31
    else:
        x = np.frombuffer(raw, f"<i{width}") / 2.0 ** (8 * width - 1)
    return rate, x.reshape(-1, channels).mean(1)


def encode(samples: np.ndarray, rate: int) -> bytes:
    """A mono file of 16 bits; values beyond -1 and 1 are clipped."""
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(2)
        f.setframerate(rate)
        f.writeframes(np.clip(np.round(samples * 32768), -32768, 32767).astype("<i2").tobytes())
    return out.getvalue()


#: A file's content -> its rate and mono signal.
Decoder = Callable[[bytes], tuple[int, np.ndarray]]


def signals(files: DataFrame, rate: int | None = None, decoders: dict[str, Decoder] | None = None) -> DataFrame:
    """(path, rate, samples, duration, error) of files (path, content), at ``rate`` or at their own.

    ``decoders`` adds formats by the lower-case ending of the name, such as
    ``flac``; a file with an ending that none is known for has an error.
    """
    known = {"wav": decode, "wave": decode, **(decoders or {})}

    def decoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                row = {"path": path, "rate": None, "samples": None, "duration": None, "error": None}
                try:
                    ending = path.rsplit("/", 1)[-1].rpartition(".")[2].lower()
                    if ending not in known:
                        raise ValueError(f"no decoder for .{ending} files")
                    own, x = known[ending](bytes(content))
                    x = x if rate in (None, own) or not len(x) else in_new_rate(x, own, rate)
                    row.update(rate=rate or own, samples=x, duration=len(x) / (rate or own))
                except Exception as e:  # noqa: BLE001 - any damage of a file belongs to its row
                    row["error"] = f"{type(e).__name__}: {e}"
                yield pd.DataFrame([row]).astype({"rate": "Int32"})

    return files.select("path", "content").mapInPandas(decoded, SIGNAL)


def read_audio(spark: SparkSession, root: str | list[str], rate: int | None = None, pattern: str | None = None, decoders: dict[str, Decoder] | None = None) -> DataFrame:
    """``signals`` of all files under folders: of the formats that can be decoded, or of those that a pattern names."""
    wanted = pattern or "*.{" + ",".join(sorted(x for e in {"wav", *(decoders or {})} for x in (e, e.upper()))) + "}"
    return signals(spark.read.format("binaryFile").option("pathGlobFilter", wanted).option("recursiveFileLookup", "true").load(root), rate, decoders)


def audio_only(heard: DataFrame) -> DataFrame:
    """Decoded signals as rows of ``write_dataset`` without transcripts: all in ``train``, empty texts, numbered in the order of a hash of the path."""
    rows = numbered(heard.where("error IS NULL"), F.md5(F.col("path").cast("binary")), "path")
    return rows.select(F.format_string("segment_%05d.wav", F.col("rn") - 1).alias("file_name"), F.lit("").alias("text"), F.lit("train").alias("split"), F.lit(None).cast("double").alias("confidence"), "rate", "samples")


def write_dataset(rows: DataFrame, root: str) -> DataFrame:
    """Write a WAV file for each row (file_name, text, split, confidence, rate, samples) and the manifest of those written.

    Files go to ``root/audio/<split>``, the manifest to ``root/manifest``.  A
    file is written under a name of its own and then moved, so a repeated task
    leaves the same files.  Returns (file_name, split, duration, error) of all
    rows from a table beside them; a row with an error is not in the manifest.
    ``root`` is a path or URL that all executors can write to.
    """

    def store(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                duration, error = None, None
                try:
                    content = encode(np.asarray(row.samples, float), int(row.rate))
                    duration = len(row.samples) / row.rate
                    there, folder = fs.FileSystem.from_uri(f"{root.rstrip('/')}/audio/{row.split}")
                    there.create_dir(folder)
                    part = f"{folder}/.{uuid.uuid4().hex}"
                    with there.open_output_stream(part) as f:
                        f.write(content)
                    there.move(part, f"{folder}/{row.file_name}")
                except Exception as e:  # noqa: BLE001 - a failed file belongs to its row
                    error = f"{type(e).__name__}: {e}"
                yield pd.DataFrame([{"file_name": row.file_name, "text": row.text, "split": row.split, "duration": duration, "confidence": row.confidence, "error": error}])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in MANIFEST.fields)
    written = rows.select("file_name", "text", "split", F.col("confidence").cast("double").alias("confidence"), "rate", "samples").mapInPandas(store, f"{fields}, error string")
    table = f"{root.rstrip('/')}/written/{uuid.uuid4().hex}"
    written.write.parquet(table)
    done = rows.sparkSession.read.parquet(table)
    write_manifest(done.where("error IS NULL").select(*MANIFEST.fieldNames()), f"{root.rstrip('/')}/manifest")
    return done.select("file_name", "split", "duration", "error")
