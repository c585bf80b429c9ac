"""Command line for finished layers: python -m velograph.plans.tools validate|matches|package ...

validate checks the gold tables against each other, matches reports on a sample of matched points, package builds a folder to hand
on. Exit codes: 1 if a check fails, 2 for parameters, 3 for inputs.
"""

from __future__ import annotations

import argparse
import dataclasses
import json
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velograph.functions.telemetry import SIGNAL_INVALID, SIGNAL_MISSING, SIGNAL_MODES
from velograph.operators.profiles import COMMON, MEASURES, TEMPORAL
from velograph.operators.reports import bottom_k, label_accuracy, match_metrics, orphans, profile_coverage, structural_violations, sums_agree, table_totals, unexpected_values
from velograph.params import Params
from velograph.plans.run import recorded_radii
from velograph.sources import layers, sinks
from velograph.sources.readers import read_table

# The words that a profile may hold.
VOCABULARY = {
    "travel_direction": ("FORWARD", "BACKWARD", "AGAINST_ONEWAY_DIGITIZED_DIRECTION", "UNKNOWN_STATIONARY_OR_SHORT_MOVE"),
    "signal_mode": (*SIGNAL_MODES, SIGNAL_MISSING, SIGNAL_INVALID),
    "weather_category": (
        "NO_RECORDED_PRECIPITATION", "RAIN_OR_LIQUID_PRECIPITATION", "SNOWFALL_OR_FREEZING_PRECIPITATION", "FOG_OR_LOW_VISIBILITY",
        "OTHER_OR_UNCLASSIFIED_WEATHER", "UNKNOWN_WEATHER",
    ),
    "season": ("WINTER", "SPRING", "SUMMER", "AUTUMN"),
    "time_of_day": ("PEAK_MORNING", "OFF_PEAK_DAY", "PEAK_EVENING", "NIGHT"),
}


def profile_keys(name: str) -> tuple[str, ...]:
    """The columns that name a row of a written profile."""
    return (*COMMON, *("day_of_week" if k == "day_of_week_iso" else k for k in TEMPORAL[name]))


def check_profile(name: str, df: DataFrame, base: DataFrame, p: Params) -> tuple[list[str], dict]:
    """Failures of one profile, and its figures."""
    wanted = {*profile_keys(name), *MEASURES, "delta_operating_speed_reference_kmh", "meets_min_sample_count", "min_sample_count"}
    if missing := sorted(wanted - set(df.columns)):
        return [f"{name}: columns are missing: {missing}"], {"table": name}
    broken = {k: v for k, v in structural_violations(df, p, profile_keys(name)).first().asDict().items() if v}
    broken |= {"orphans": n} if (n := orphans(df, base, "road_feature_id").count()) else {}
    broken |= {"methods_exceed_samples": n} if (n := df.filter(F.col("n_speed_derivation_methods") > F.col("n_samples")).count()) else {}
    words = [f"{name}: {r['column']} holds {r['values']}" for r in unexpected_values(df, VOCABULARY).collect()]
    return [f"{name}: {k}: {v}" for k, v in broken.items()] + words, {"table": name} | profile_coverage(df).first().asDict()


def validate(spark: SparkSession, gold: str, p: Params) -> tuple[list[str], list[dict]]:
    """What is wrong with the tables of a gold folder, and the coverage of each profile."""
    base = read_table(spark, gold, "base")
    tables = {name: read_table(spark, gold, name) for name in TEMPORAL}
    checked = [check_profile(name, df, base, p) for name, df in tables.items()]
    failures, figures = [x for found, _ in checked for x in found], [f for _, f in checked]
    if all("n_samples" in df.columns for df in tables.values()) and not sums_agree(table_totals(tables)).first()["agree"]:
        failures.append("the profiles' sample sums differ")
    for name in TEMPORAL:
        if name != "flat":
            failures += sinks.csv_twin_failures(spark, gold, name)
    return failures, figures


def sample_of(silver: DataFrame, k: int, strata: tuple[str, ...]) -> DataFrame:
    return bottom_k(silver, k, strata, "point_id")


def matches(spark: SparkSession, out: Path, p: Params, k: int, labels: str | None = None) -> tuple[DataFrame, dict]:
    """Metrics of a sample of matched points, by the radii under which they were matched, and what reviewers say of it."""
    primary, most, source = recorded_radii(out, p)
    silver = spark.read.parquet(str(out / "silver" / "points"))
    sample = sample_of(silver, k, ("year", "highway", "match_radius_tier"))
    used = p if most == max(p.radii) and primary == p.primary_radius else dataclasses.replace(p, radii=(*sorted({primary, *(r for r in p.radii if r < most)})[:2], most), primary_radius=primary)
    found = {"radii_from": source, "rows": sample.count()}
    if labels:
        found |= label_accuracy(sample, spark.read.option("header", True).csv(labels), "point_id", "correct_road_match").first().asDict()
    return match_metrics(sample, used), found


def package(gold: Path, output: Path, metadata: dict, readme: str) -> Path:
    """The finished gold tables with README, citation and checksums."""
    if not layers.layer_is_done(gold, "gold"):
        raise ValueError(f"{gold} isn't a finished gold layer")
    if output.resolve().is_relative_to(gold.resolve()):
        raise ValueError("the package must not lie in the gold folder")
    names = sorted(x.name for x in gold.iterdir() if x.suffix in (".parquet", ".csv") and not layers.is_sidecar(x.name))
    return sinks.build_package({n: gold / n for n in names}, output, metadata, readme, layers.SIDECARS)


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = argparse.ArgumentParser(description=__doc__)
    commands = a.add_subparsers(dest="command", required=True)
    v = commands.add_parser("validate")
    v.add_argument("--gold", required=True)
    v.add_argument("--report")
    m = commands.add_parser("matches")
    m.add_argument("--out", required=True, help="the folder with the layers")
    m.add_argument("--k", type=int, default=50, help="rows of each stratum")
    m.add_argument("--labels", help="CSV with point_id and correct_road_match")
    g = commands.add_parser("package")
    for name in ("gold", "output", "metadata", "readme"):
        g.add_argument(f"--{name}", required=True)
    for c in (v, m):
        c.add_argument("--params", help="a JSON object of parameters that differ from the defaults")
    o = a.parse_args(args)
    try:
        given = json.loads(o.params) if getattr(o, "params", None) else {}
        p = Params(**{k: tuple(x) if isinstance(x, list) else x for k, x in given.items()})
    except (TypeError, ValueError) as e:
        print(f"parameters: {e}", file=sys.stderr)
        return 2
    try:
        if o.command == "package":
            print(package(Path(o.gold), Path(o.output), json.loads(Path(o.metadata).read_text(encoding="utf-8")), Path(o.readme).read_text(encoding="utf-8")))
            return 0
        spark = spark or SparkSession.builder.appName("velograph").config("spark.sql.session.timeZone", "UTC").getOrCreate()
        if o.command == "matches":
            metrics, found = matches(spark, Path(o.out), p, o.k, o.labels)
            print(json.dumps(sinks.json_safe(found | {r["metric"]: r["value"] for r in metrics.collect()}), sort_keys=True))
            return int(bool(metrics.filter("metric = 'violations_total' AND value > 0").count()))
        failures, figures = validate(spark, o.gold, p)
        if o.report:
            sinks.write_json(Path(o.report), {"failures": failures, "tables": figures})
        print("\n".join(failures) or "no failures")
        return int(bool(failures))
    except (OSError, ValueError) as e:
        print(e, file=sys.stderr)
        return 3


if __name__ == "__main__":
    sys.exit(main())
