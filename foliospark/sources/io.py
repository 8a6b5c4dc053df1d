"""Sources and sinks. Formats that need a library of their own sit behind small functions that the caller brings."""

from __future__ import annotations

import json
import os
import time
import warnings
import wave
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

PAGES = "book_id string, page_no long, text string, prob int"


def read_pages(spark: SparkSession, path: str, extract: Callable[[str, bytes], list[str]], pattern: str = "*.pdf") -> DataFrame:
    """Pages of binary books, a book a row group: extract(path, content) gives a book's page texts.

    A book that can't be opened gives no pages; the job goes on.
    """
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for book, content in zip(part["path"], part["content"]):
                try:
                    texts = extract(book, bytes(content))
                except Exception:  # noqa: BLE001
                    texts = []
                n = len(texts)
                yield pd.DataFrame({"book_id": pd.Series([book] * n, dtype=object), "page_no": pd.Series(range(n), dtype="int64"), "text": pd.Series(texts, dtype=object), "prob": pd.Series([0] * n, dtype="int32")})

    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "content").mapInPandas(run, PAGES)


def recogniser(recognise: Callable[[str, int], str | None]):
    """For pages.recognise: replace each page's text by recognise(book_id, page_no), null where that fails."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            texts = []
            for book, page in zip(batch.column("book_id").to_pylist(), batch.column("page_no").to_pylist()):
                try:
                    texts.append(recognise(book, page))
                except Exception:  # noqa: BLE001
                    texts.append(None)
            yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))

    return run


def read_words(spark: SparkSession, *paths: str) -> DataFrame:
    """Plain word lists, a word or a text a line, as texts for build_dictionary."""
    return spark.read.text(list(paths)).select(F.col("value").alias("text"))


def read_lemmas(spark: SparkSession, *paths: str) -> DataFrame:
    """Lemma lists of a lexical database (name.part.number, words joined by underscores): the names, without underscores."""
    return spark.read.text(list(paths)).select(F.replace(F.substring_index("value", ".", 1), F.lit("_"), F.lit("")).alias("text"))


def read_system_words(spark: SparkSession, *paths: str) -> DataFrame:
    """The system's word file: its runs of two ASCII letters or hyphens and more that no letter, digit or underscore touches, one a row."""
    found = F.regexp_extract_all("value", F.lit(r"(?<![\p{L}\p{N}_])[a-zA-Z-]{2,}(?![\p{L}\p{N}_])"), F.lit(0))
    return spark.read.text(list(paths)).select(F.explode(found).alias("text"))


def read_splits(spark: SparkSession, path: str, splits: tuple[str, ...] = ("train", "validation", "test")) -> DataFrame:
    """A dataset laid out by split=...; partition pruning reads the named splits alone. A missing one is left out with a warning."""
    rows = spark.read.parquet(path).where(F.col("split").isin(*splits))
    have = {r["split"] for r in rows.select("split").distinct().collect()}  # at most as many as are named
    for split in splits:
        if split not in have:
            warnings.warn(f"{path} has no split {split}", stacklevel=2)
    return rows


def write_splits(rows: DataFrame, path: str) -> None:
    rows.write.partitionBy("split").mode("overwrite").parquet(path)


def save(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A saved table with the schema that is expected of it."""
    return spark.read.schema(schema).parquet(path)


def read_parts(spark: SparkSession, path: str, pattern: str = "*.wav") -> DataFrame:
    """Part files with their process and part numbers, to be put in order by these."""
    out = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    number = lambda k: F.regexp_extract("path", r"_proc(\d+)_part_-?\d+_(\d+)\.wav\z", k).cast("long")
    return out.select("path", number(1).alias("proc"), number(2).alias("part"), "content")


def synthesise(paras: DataFrame, make: Callable[[], Callable[[str, str], None]]) -> DataFrame:
    """Speak each paragraph to its path with a model made once for each worker; path and ok, failures skipped."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        speak = None
        for part in parts:
            ok = []
            for text, path in zip(part["paragraph"], part["path"]):
                try:
                    speak = speak or make()
                    speak(text, path)
                    ok.append(True)
                except Exception:  # noqa: BLE001
                    ok.append(False)
            yield part[["proc", "gpu", "part", "path"]].assign(ok=ok)

    return paras.select("proc", "gpu", "part", "path", "paragraph").mapInPandas(run, "proc long, gpu long, part long, path string, ok boolean")


def concat_samples(parts: DataFrame, keys: list[str], fade: int = 0) -> DataFrame:
    """keys and the samples of their parts (proc, part, samples: array of doubles) in order, each part faded in and out linearly over `fade` samples."""
    n = F.size("samples")
    ramp = lambda x, i: x * F.least(F.lit(1.0), (i + 1) / F.lit(float(fade + 1)), (n - i) / F.lit(float(fade + 1)))
    faded = parts.withColumn("samples", F.transform("samples", ramp)) if fade else parts
    rows = F.array_sort(F.collect_list(F.when(F.size("samples") > 0, F.struct("proc", "part", "samples"))))
    return faded.groupBy(*keys).agg(F.flatten(F.transform(rows, lambda x: x["samples"])).alias("samples"))


def concat_waves(paths: list[str], out: str, fade_ms: int = 0) -> bool:
    """Write the waves at paths, in that order, as one at out, each faded in and out over fade_ms. Runs where the files are.

    A missing or unreadable file is left out, and one whose format isn't that of the first; False, and no file, if none is left.
    """
    form, chunks = None, []
    for path in paths:
        try:
            with wave.open(path, "rb") as f:
                now, raw = (f.getnchannels(), f.getsampwidth(), f.getframerate()), f.readframes(f.getnframes())
        except (OSError, EOFError, wave.Error):
            continue
        form = form or now
        if now == form and raw:
            chunks.append(faded(raw, form, fade_ms) if fade_ms else raw)
    if not chunks:
        return False
    with wave.open(out, "wb") as f:
        f.setnchannels(form[0])
        f.setsampwidth(form[1])
        f.setframerate(form[2])
        for raw in chunks:
            f.writeframes(raw)
    return True


def faded(raw: bytes, form: tuple[int, int, int], ms: int) -> bytes:
    """Frames of 16-bit samples with linear ramps at both ends; other widths stay as they are."""
    channels, width, rate = form
    if width != 2:
        return raw
    x = np.frombuffer(raw, dtype="<i2").reshape(-1, channels).astype(float)
    n = max(1, min(rate * ms // 1000, len(x) // 2))
    ramp = np.minimum(1.0, np.arange(1, len(x) + 1) / n)
    return (x * (ramp * ramp[::-1])[:, None]).astype("<i2").tobytes()


def concat_and_clean(paths: list[str], out: str, fade_ms: int = 0) -> tuple[bool, int, int]:
    """Concatenate part files and, only if that has worked, delete them: (done, removed, failed to be removed)."""
    if not concat_waves(paths, out, fade_ms):
        return False, 0, 0
    removed = failed = 0
    for path in paths:
        try:
            os.remove(path)
            removed += 1
        except OSError:
            failed += 1
    return True, removed, failed


def write_concat(rows: DataFrame, group: str, order: str, text: str, path: str, pieces: int | None = None) -> None:
    """The texts of each group as lines of text files, in order: the files of a group's folder, by name, are its one text.

    Ranges of (group, order) are sorted side by side; no group is gathered in one row or task.
    """
    n = pieces or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = rows.where(F.col(text).isNotNull()).repartitionByRange(n, group, order).sortWithinPartitions(group, order)
    at.select(group, F.col(text).alias("value")).write.mode("overwrite").partitionBy(group).text(path)


def save_model(save: Callable[[str], None], path: str) -> str:
    """Boundary of adapter and tokenizer sinks: save(folder) writes into a new folder beside path, which then takes its place."""
    made = f"{path}.new"
    os.makedirs(made, exist_ok=True)
    save(made)
    if os.path.exists(path):
        os.rename(path, f"{path}.old-{time.time_ns()}")
    os.rename(made, path)
    return path


def log_metrics(path: str, step: int, metrics: dict[str, float]) -> None:
    """Boundary of the metrics sink: one JSON line a call."""
    with open(path, "a", encoding="utf-8") as f:
        f.write(json.dumps({"step": step, **metrics}, sort_keys=True) + "\n")


def train(rows: DataFrame, make: Callable[[], Callable[[Iterator[dict], str | None], dict[str, float]]], folder: str, checkpoint: str | None = None, step: int = 0) -> dict[str, float]:
    """Boundary of a training run: make()(rows, checkpoint) learns from the rows, which come one partition at a time, resumes
    from a checkpoint if one is given, and returns its metrics, which are logged in folder."""
    os.makedirs(folder, exist_ok=True)
    metrics = make()((r.asDict() for r in rows.toLocalIterator()), checkpoint)
    log_metrics(f"{folder}/metrics.jsonl", step, metrics)
    return metrics


class ModelProvider:
    """Models by name, each loaded at most once for a Python worker; load(name) may raise, which skips that one."""

    def __init__(self, load: Callable[[str], object]):
        self._load, self._have = load, {}

    def get(self, name: str) -> object | None:
        if name not in self._have:
            try:
                self._have[name] = self._load(name)
            except Exception:  # noqa: BLE001
                self._have[name] = None
        return self._have[name]

    def several(self, names: list[str]) -> list[object]:
        found = [m for m in map(self.get, names) if m is not None]
        if not found:
            raise RuntimeError("no model could be loaded")
        return found
