"""Resumable stages: fingerprints of input and settings decide whether a stage runs again."""

from __future__ import annotations

import contextlib
import hashlib
import json
import platform
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass
from importlib import metadata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class FingerprintMismatch(RuntimeError):
    """A finished stage has other inputs or settings than now."""


@dataclass
class StageStatus:
    name: str
    status: str
    elapsed_seconds: float
    input_fingerprint: str
    settings_fingerprint: str
    output_fingerprint: str | None = None
    error: str | None = None


def content_fingerprint(df: DataFrame) -> str:
    """Digest of a table's rows, whatever their order or files: counts and sums of two row hashes."""
    columns = [F.col(f"`{c}`") for c in sorted(df.columns)]
    wide = "decimal(38,0)"
    row = df.agg(F.count("*"), F.sum(F.xxhash64(*columns).cast(wide)), F.sum(F.hash(*columns).cast(wide))).first()
    return hashlib.sha256(json.dumps([df.dtypes, [str(v) for v in row]]).encode()).hexdigest()


def settings_fingerprint(settings: dict) -> str:
    return hashlib.sha256(json.dumps(settings, sort_keys=True, default=str).encode()).hexdigest()


def environment(spark: SparkSession) -> dict[str, str]:
    """Versions and place of a run."""
    found = {"python": platform.python_version(), "platform": platform.platform(), "spark": spark.version, "master": spark.sparkContext.master}
    for name in ("pyarrow", "pandas", "numpy"):
        with contextlib.suppress(metadata.PackageNotFoundError):
            found[name] = metadata.version(name)
    return found


def strict_gate(counts: dict[str, int]) -> None:
    """Raise if any of these counts of faults isn't 0."""
    if wrong := {k: n for k, n in counts.items() if n}:
        raise ValueError(f"the corpus is not clean: {wrong}")


def run_stages(spark: SparkSession, source: DataFrame, stages: list[tuple[str, Callable[[DataFrame], DataFrame]]], folder: str, settings: dict | None = None, *, skip: frozenset[str] = frozenset()) -> tuple[DataFrame, list[StageStatus]]:
    """Run stages one after another, each written below ``folder``; finished equal ones are read back.

    A finished stage whose fingerprints differ raises ``FingerprintMismatch``.
    Stages named in ``skip`` pass their input on.  A stage that fails leaves a
    ``failed`` status, raises, and runs again the next time.
    """
    done: list[StageStatus] = []
    current, config = source, settings_fingerprint(settings or {})
    for name, stage in stages:
        began, at = time.time(), f"{folder.rstrip('/')}/{name}"
        if name in skip:
            done.append(StageStatus(name, "skipped", 0.0, "", config))
            continue
        given = content_fingerprint(current)
        old = _status(spark, f"{at}.status")
        if old and old["status"] == "success":
            if (old["input_fingerprint"], old["settings_fingerprint"]) != (given, config):
                raise FingerprintMismatch(name)
            current = spark.read.parquet(at)
            done.append(StageStatus(**old | {"status": "reused"}))
            continue
        try:
            stage(current).write.mode("overwrite").parquet(at)
        except Exception as error:
            _write_status(spark, f"{at}.status", StageStatus(name, "failed", time.time() - began, given, config, None, f"{type(error).__name__}: {error}"[:500]))
            raise
        current = spark.read.parquet(at)
        status = StageStatus(name, "success", time.time() - began, given, config, content_fingerprint(current))
        _write_status(spark, f"{at}.status", status)
        done.append(status)
    return current, done


def _write_status(spark: SparkSession, path: str, status: StageStatus) -> None:
    spark.createDataFrame([(json.dumps(asdict(status)),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def _status(spark: SparkSession, path: str) -> dict | None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path):
        return None
    return json.loads(spark.read.text(path).first()["value"])
