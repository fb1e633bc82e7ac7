"""Benchmark: the reference's headline operations on data derived from the driver tables.

Set-up (not timed): the export-shaped frame (lineitem JOIN part) is written as
sharded CSV with a two-row header in shard 00, the layout the import expects.

Timed, each forced to completion (a collect for small results, the no-op sink
for large ones):

* ``import``        sharded CSV -> typed, slugged Parquet (zstd level 9)
* ``reduce``        imported Parquet -> reduced table, sorted by grain, zstd 9
* ``class_report``  filter + group + rounded mean + top 5 over the import
* ``exact_lookup``  equality on the sorted reduced table
* ``fuzzy_sweep``   Damerau-Levenshtein <= 2 over all 9-mers of the reduced table
* ``fuzzy_join``    every part name against every reduced sequence, distance <= 2
* ``reduced_from_tables`` the flagship registered query straight from the tables

The same steps first run once, untimed, on ``BENCH_WARM_DIR`` (default
sf0.01) to warm the JVM. Each timed step then runs ``BENCH_REPS`` times
(default 3); ``queries`` holds the best run (warm, as the reference's
warm-cache timings), ``first_run`` the first.

``wide`` (outside the headline total): the export at the published width (112
columns, about 1.6 kB a row) and cardinality (about half a group per row, most
sequences distinct), ``BENCH_WIDE`` times the rows of lineitem (default 1; 0
disables), imported and reduced once, in GB/s and rows/s; the two lookups also run
on its reduced table. ``yardstick_s`` times a fixed aggregate: divide by it to
compare runs on machines of different speed.

Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tessera.functions.text import clean_sequence  # noqa: E402
from tessera.operators.reduce import extract_fields, reduce_to_grain  # noqa: E402
from tessera.operators.reports import class_report  # noqa: E402
from tessera.operators.ranking import exact_lookup  # noqa: E402
from tessera.operators.similarity import fuzzy_join, fuzzy_sweep  # noqa: E402
from tessera.plans.epitope_table import reduced_table  # noqa: E402
from tessera.plans.export_frame import export_frame, read_table  # noqa: E402
from tessera.plans.export_import import (  # noqa: E402
    convert_to_parquet,
    export_casts,
    export_groups_fields,
    export_shards_dir,
)
from tessera.sources.sharded_csv import write_sharded_csv  # noqa: E402
from tessera.session import get_session, release_scratch, scratch_path  # noqa: E402
from tessera.sinks.writers import write_reduced_table  # noqa: E402


_scratch = scratch_path


def _noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _steps(spark, sf_dir: str, cpus: int, times: dict, first: dict, reps: int):
    # set-up: the export as sharded CSV (not timed)
    n_export = read_table(spark, sf_dir, "lineitem").count()
    src = export_shards_dir(spark, sf_dir, max(1, n_export // max(cpus, 8)))
    casts = export_casts(export_frame(spark, sf_dir).columns)

    def timed(name, fn):
        out = None
        for i in range(reps):
            t0 = time.perf_counter()
            out = fn()
            dt = round(time.perf_counter() - t0, 3)
            if i == 0:
                first[name] = dt
            times[name] = min(times.get(name, dt), dt)
        return out

    imported = _scratch(spark, "bench-import")
    summary = timed("import", lambda: convert_to_parquet(spark, src, imported, casts).collect()[0])
    table = spark.read.parquet(imported)

    reduced_path = _scratch(spark, "bench-reduced")
    timed("reduce", lambda: write_reduced_table(reduce_to_grain(extract_fields(table)), reduced_path))
    reduced = spark.read.parquet(reduced_path)

    timed("class_report", lambda: class_report(table, "I", 1998, 5).collect())
    timed("exact_lookup", lambda: exact_lookup(reduced, "sequence", "SMALLRING").collect())
    timed("fuzzy_sweep", lambda: fuzzy_sweep(reduced.where(F.col("peptide_length") == 9), "sequence",
                                             "ERDWIDGET", 2).collect())
    names = read_table(spark, sf_dir, "part").select(clean_sequence(F.upper("p_name")).alias("q"))
    timed("fuzzy_join", lambda: _noop(fuzzy_join(names, "q", reduced, "sequence", 2)))
    timed("reduced_from_tables", lambda: _noop(reduced_table(spark, sf_dir)))
    return summary, reduced, n_export


WIDTH = 112
RESIDUES = "ACDEFGHIKLMNPQRSTVWY"


def _wide(spark, sf_dir: str, cpus: int, factor: int) -> dict:
    """Import and reduce an export of the published width and cardinality."""
    lineitem = read_table(spark, sf_dir, "lineitem")
    n_rows = lineitem.count() * factor
    e = export_frame(spark, sf_dir).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(factor))))
    # a sequence for every other row or so: the residues spell a hash
    rest = F.pmod(F.xxhash64("epitope_name", "reference_pmid", "_copy"), F.lit(max(1, n_rows // 400)))
    number = F.pmod(F.xxhash64("epitope_epitope_iri", "mhc_restriction_name", rest), F.lit(20**6))
    letters = [F.substring(F.lit(RESIDUES), (F.floor(number / 20**k) % 20 + 1).cast("int"), F.lit(1)) for k in range(6)]
    e = e.withColumn("epitope_name", F.concat(F.lit("SL"), *letters, F.lit("V"))).drop("_copy")
    filler = [F.concat_ws(" ", "epitope_source_molecule", F.lit(f"text {k}")).alias(f"assay_note_{k}")
              for k in range(WIDTH - len(e.columns))]
    e = e.select("*", *filler)
    groups, fields = export_groups_fields(e.columns)
    src = _scratch(spark, "bench-wide-src")
    n_shards = max(2 * cpus, 16)
    write_sharded_csv(e, src, "export", n_shards, groups, fields,
                      shard_col=F.pmod(F.xxhash64(*e.columns[:14]), F.lit(n_shards)))

    imported = _scratch(spark, "bench-wide-import")
    t0 = time.perf_counter()
    summary = convert_to_parquet(spark, src, imported, export_casts(e.columns)).collect()[0]
    t_import = time.perf_counter() - t0

    table = spark.read.parquet(imported)
    t0 = time.perf_counter()
    reduced = write_reduced_table(reduce_to_grain(extract_fields(table)), _scratch(spark, "bench-wide-reduced"))
    t_reduce = time.perf_counter() - t0
    rows, n_reduced = int(summary["rows"]), reduced.count()
    some = reduced.where("sequence is not null").select("sequence").first()["sequence"]
    swapped = some[:2] + some[3] + some[2] + some[4:]

    def best_of(n, fn):
        times = []
        for _ in range(n):
            t0 = time.perf_counter()
            fn()
            times.append(time.perf_counter() - t0)
        return round(min(times), 3)

    lookup_s = best_of(3, lambda: exact_lookup(reduced, "sequence", some).collect())
    sweep_s = best_of(3, lambda: fuzzy_sweep(reduced.where(F.col("peptide_length") == 9), "sequence", swapped, 2).collect())
    return {
        "columns": WIDTH,
        "rows": rows,
        "input_bytes": summary["input_bytes"],
        "groups_per_row": round(n_reduced / rows, 3) if rows else None,
        "distinct_sequences": reduced.select("sequence").distinct().count(),
        "import_s": round(t_import, 3),
        "reduce_s": round(t_reduce, 3),
        "import_gb_per_sec": round(summary["input_bytes"] / 1e9 / t_import, 3),
        "reduce_rows_per_sec": round(rows / t_reduce),
        "exact_lookup_s": lookup_s,
        "fuzzy_sweep_s": sweep_s,
    }


def _yardstick(spark) -> float:
    """Seconds of a fixed aggregate, so that runs on machines of different speed can be compared."""
    def run() -> float:
        t0 = time.perf_counter()
        spark.range(60_000_000).select(F.xxhash64("id").alias("h")).groupBy(F.pmod("h", F.lit(1000))).agg(F.sum(F.col("h") % 97)).collect()
        return time.perf_counter() - t0

    return round(min(run() for _ in range(3)), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(
        f"local[{cpus}]",
        app_name="tessera-bench",
        shuffle_partitions=2 * cpus,
        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
               "spark.sql.files.maxPartitionBytes": "8m", "spark.sql.files.openCostInBytes": "1m"},
    )
    sf = os.path.basename(sf_dir).removeprefix("sf")

    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.01")
    if os.path.exists(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        # one untimed pass of the same steps on small data: JVM classes, codegen, JIT, Python workers
        _steps(spark, warm_dir, cpus, {}, {}, 1)

    times: dict[str, float] = {}
    first: dict[str, float] = {}
    reps = max(1, int(os.environ.get("BENCH_REPS", "3")))
    summary, reduced, n_export = _steps(spark, sf_dir, cpus, times, first, reps)

    n_reduced = reduced.count()
    factor = int(os.environ.get("BENCH_WIDE", "1"))
    wide = _wide(spark, sf_dir, cpus, factor) if factor else None
    out = {
        "metric": "total_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "first_run": first,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "rows": {"export": n_export, "imported": int(summary["rows"]), "reduced": n_reduced},
        "import_gb_per_sec": round(summary["input_bytes"] / 1e9 / times["import"], 3),
        "throughput_rows_per_sec": {
            "reduce": round(n_export / times["reduce"]) if times["reduce"] else None,
        },
        "import": {"input_bytes": summary["input_bytes"], "output_bytes": summary["output_bytes"],
                   "compression": summary["compression"]},
        "cpus": cpus,
        "yardstick_s": _yardstick(spark),
        "wide": wide,
    }
    print(json.dumps(out))
    release_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
