"""Command line: python -m velograph.plans.run --csv ... --roads ... --weather ... --out ... builds the layers.

Exit codes: 2 for parameters, 3 for inputs.
"""

from __future__ import annotations

import argparse
import dataclasses
import json
import platform
import shutil
import subprocess
import sys
import warnings
from importlib.metadata import PackageNotFoundError, version
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velograph.functions.geometry import unproject
from velograph.operators.identity import dedup_batches
from velograph.operators.reports import as_rows, gold_reconciliation, sums_agree, table_totals
from velograph.params import Params
from velograph.plans.stages import bronze, gold, normalise_roads, silver
from velograph.sources import layers, sinks
from velograph.sources.readers import extract_archives, find_csv, in_batches, read_roads, read_telemetry, read_weather

TABLE_KEYS = {"base": ["road_feature_id"], "season": ["road_feature_id", "season"], "month": ["road_feature_id", "month"], "weekday": ["road_feature_id", "day_of_week"], "time_of_day": ["road_feature_id", "time_of_day"], "flat": ["road_feature_id", "month", "day_of_week", "time_of_day"]}
STAGES = ("bronze", "silver", "gold")
BATCH_BYTES = 4 << 30


def build_bronze(spark: SparkSession, files: list[Path], stage: Path, p: Params, batch_bytes: int) -> tuple[DataFrame, dict, str]:
    """Deduplicated points, attrition counts and the layer's key. Files are read in batches that are checkpoints: a run that was broken
    off goes on after the last one that ended under the same parameters and files. When all have ended, they can be published
    without the files. Batches are deduplicated again against each other."""
    root = stage / "batches"
    root.mkdir(parents=True, exist_ok=True)
    key, batches = layers.inputs_key(p.fingerprint(), files), []
    if not files:
        if (ended := layers.ended_batches(root, p.fingerprint())) is None:
            raise FileNotFoundError("no CSV files, and no finished batches of them")
        key, batches = ended
    for names in in_batches([(str(f), f.stat().st_size) for f in files], batch_bytes):
        batches.append(layers.inputs_key(p.fingerprint(), map(Path, names)))
        if batches[-1] not in layers.checkpoints(root):
            folder = root / batches[-1][:32]
            shutil.rmtree(folder, ignore_errors=True)
            rows, seen = bronze(read_telemetry(spark, names), p)
            rows.write.mode("overwrite").parquet(str(folder / "points"))
            layers.finish_layer(folder, "bronze-batch", batches[-1], ["points"], {k: int(v) for k, v in seen.get.items()})
    layers.finish_batches(root, key, p.fingerprint(), batches)
    done = [layers.checkpoints(root)[b] for b in batches]
    parts = [spark.read.parquet(str(folder / "points")) for folder, _ in done]
    counts: dict = {}
    for _, marker in done:
        counts = {k: counts.get(k, 0) + v for k, v in marker["details"].items()}
    return parts[0] if len(parts) == 1 else dedup_batches(parts, "point_id", "source_file"), counts, key


def revision(folder: Path) -> str | None:
    """The commit of the code, if it stands in a repository."""
    try:
        return subprocess.run(["git", "-C", str(folder), "rev-parse", "HEAD"], capture_output=True, text=True, check=True, timeout=10).stdout.strip()
    except (OSError, subprocess.SubprocessError):
        return None


def write_manifest(out: Path, p: Params, stages: tuple[str, ...], force: bool, settings: dict) -> Path:
    """What a run was made with: parameters, code, versions and settings."""
    packages = {}
    for name in ("pyspark", "pyarrow", "pandas", "numpy"):
        try:
            packages[name] = version(name)
        except PackageNotFoundError:
            packages[name] = None
    path = out / "reports" / "run.json"
    sinks.write_json(path, {
        "written": layers.now(), "stages": list(stages), "force": force, "parameters": dataclasses.asdict(p), "fingerprint": p.fingerprint(), "revision": revision(Path(__file__).parent),
        "python": sys.version, "platform": platform.platform(), "packages": packages, "settings": settings, "paths": {s: str(out / s) for s in STAGES},
    })
    return path


def recorded_radii(out: Path, fallback: Params) -> tuple[float, float, str]:
    """The primary and the largest radius under which the layers below out were matched, and where that is known from: checks of
    matches must not hang on today's defaults."""
    try:
        known = json.loads((out / "reports" / "run.json").read_text(encoding="utf-8"))["parameters"]
        return float(known["primary_radius"]), float(max(known["radii"])), "run manifest"
    except (OSError, KeyError, TypeError, ValueError):
        return fallback.primary_radius, max(fallback.radii), "parameters"


def build(spark: SparkSession, csv: Path, roads: str, weather: str, out: Path, p: Params, force: bool = False, stages: tuple[str, ...] = STAGES, batch_bytes: int = BATCH_BYTES, settings: dict | None = None) -> dict:
    """The stages' layers below out; a layer that is complete under the same parameters and inputs is kept. Returns the attrition counts."""
    files = find_csv(csv)
    key = layers.inputs_key(p.fingerprint(), files)
    stage = out / ".staging"
    road_rows = normalise_roads(read_roads(spark, roads), p)
    due = lambda name: name in stages and (force or not layers.layer_is_done(out / name, name, key))
    if due("bronze"):
        layers.drop_staging(stage / "bronze", stage)
        rows, counts, key = build_bronze(spark, files, stage, p, batch_bytes)
        sinks.write_partitions(rows, str(stage / "bronze" / "points"), "year", "quarter")
        layers.finish_layer(stage / "bronze", "bronze", key, ["points"], counts)
        layers.swap_in(stage / "bronze", out / "bronze", stage)
        layers.drop_staging(stage / "batches", stage)
    for name in ("bronze", "silver")[: 0 if stages[0] == "bronze" else STAGES.index(stages[0])]:
        if layers.is_stale(out / name, key):
            warnings.warn(f"{out / name} was made under other parameters or inputs, and is used as it is", stacklevel=2)
    if due("silver"):
        layers.drop_staging(stage / "silver", stage)
        rows = silver(spark.read.parquet(str(out / "bronze" / "points")), road_rows, read_weather(spark, weather, p.weather_model), p)
        sinks.write_partitions(rows, str(stage / "silver" / "points"), "year", "month")
        layers.finish_layer(stage / "silver", "silver", key, ["points"])
        layers.swap_in(stage / "silver", out / "silver", stage)
    if due("gold"):
        layers.drop_staging(stage / "gold", stage)
        points = spark.read.parquet(str(out / "silver" / "points"))

        def keep(df: DataFrame, name: str) -> DataFrame:
            df.write.mode("overwrite").parquet(str(stage / "counts" / name))
            return spark.read.parquet(str(stage / "counts" / name))

        tables = gold(points, road_rows, p, keep)
        for name, df in tables.items():
            sinks.write_sorted(df, str((stage / "gold" / f"{name}.parquet").absolute()), TABLE_KEYS[name], csv=name != "base" and name != "flat")
        degrees = tables["base"].withColumn("line", unproject_line("line"))
        sinks.write_geoparquet(degrees, str((stage / "gold" / "base_geo.parquet").absolute()), TABLE_KEYS["base"])
        written = {n: spark.read.parquet(str(stage / "gold" / f"{n}.parquet")) for n in tables if n != "base"}
        totals = table_totals(written)
        if not sums_agree(totals).first()["agree"]:
            raise ValueError("the profiles' sample sums differ")
        sinks.write_report(as_rows(gold_reconciliation(points, p)).unionByName(totals), str(stage / "gold" / "reconciliation.parquet"))
        layers.finish_layer(stage / "gold", "gold", key, [f"{n}.parquet" for n in tables])
        layers.swap_in(stage / "gold", out / "gold", stage)
        layers.drop_staging(stage / "counts", stage)
    write_manifest(out, p, stages, force, settings or {})
    layers.drop_strays(out)
    return (layers.layer_marker(out / "bronze") or {"details": {}})["details"]


def unproject_line(line: str) -> Column:
    """A polyline in metres as one in degrees."""
    return F.transform(line, lambda v: F.struct(*[e.alias(n) for e, n in zip(unproject(v["x"], v["y"]), ("x", "y"), strict=True)]))


def options() -> argparse.ArgumentParser:
    a = argparse.ArgumentParser(description=__doc__)
    a.add_argument("--csv", required=True, help="folder of raw CSV files, or one file")
    a.add_argument("--archives", help="folder of ZIP files, extracted to --csv first unless it holds CSV files")
    for name in ("roads", "weather", "out"):
        a.add_argument(f"--{name}", required=True)
    a.add_argument("--stage", choices=("all", *STAGES), default="all")
    a.add_argument("--params", help="a JSON object of parameters that differ from the defaults")
    a.add_argument("--speed-source", choices=("gps_speed", "displacement"))
    a.add_argument("--weather-model")
    a.add_argument("--period", nargs=2, metavar=("FIRST", "LAST"))
    a.add_argument("--batch-gb", type=float, default=BATCH_BYTES / (1 << 30), help="raw bytes of a bronze checkpoint")
    a.add_argument("--master", help="as for Spark; its own setting if left out")
    a.add_argument("--threads", type=int, help="the same as --master local[THREADS]")
    a.add_argument("--shuffle-partitions", type=int)
    a.add_argument("--driver-memory")
    a.add_argument("--executor-memory")
    a.add_argument("--force", action="store_true")
    return a


def parameters(o: argparse.Namespace) -> Params:
    given = json.loads(o.params) if o.params else {}
    given |= {k: v for k, v in {"speed_source": o.speed_source, "weather_model": o.weather_model, "period": o.period}.items() if v is not None}
    if o.batch_gb <= 0:
        raise ValueError("--batch-gb must be above zero")
    return Params(**{k: tuple(v) if isinstance(v, list) else v for k, v in given.items()})


def session(o: argparse.Namespace) -> SparkSession:
    b = SparkSession.builder.appName("velograph").config("spark.sql.session.timeZone", "UTC")
    master = o.master or (f"local[{o.threads}]" if o.threads else None)
    b = b.master(master) if master else b
    for name, value in (("spark.sql.shuffle.partitions", o.shuffle_partitions), ("spark.driver.memory", o.driver_memory), ("spark.executor.memory", o.executor_memory)):
        b = b.config(name, value) if value else b
    return b.getOrCreate()


def main(args: list[str] | None = None) -> int:
    o = options().parse_args(args)
    try:
        p = parameters(o)
    except (TypeError, ValueError) as e:
        print(f"parameters: {e}", file=sys.stderr)
        return 2
    spark = session(o)
    settings = {k: v for k, v in vars(o).items() if k in ("batch_gb", "master", "threads", "shuffle_partitions", "driver_memory", "executor_memory") and v is not None}
    try:
        if o.archives:
            extract_archives(Path(o.archives), Path(o.csv))
        stages = STAGES if o.stage == "all" else (o.stage,)
        print(json.dumps(build(spark, Path(o.csv), o.roads, o.weather, Path(o.out), p, o.force, stages, int(o.batch_gb * (1 << 30)), settings), sort_keys=True))
    except (FileNotFoundError, ValueError) as e:
        print(e, file=sys.stderr)
        return 3
    return 0


if __name__ == "__main__":
    sys.exit(main())
