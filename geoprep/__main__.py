"""Command-line jobs (W1-W5): ``python -m geoprep <job> ...`` or through spark-submit.

  boundaries  --adm0 P --adm1 P --adm2 P --out DIR        per-level tables (W1, W2)
  combined    --adm0 P --adm1 P --adm2 P --out DIR        combined hierarchy (W3)
  postal      --records P --bodies P --adm1 P --adm2 P --out DIR [--chunk-rows N]
                                                          postal table, one shot or chunked (W4, T1)
  serve       --postal P --out DIR                        keyed postal table + rejects (W5)

Sources are GeoPackage/SQLite files or folders (gpkg source) or any ``spark.read`` path;
``--table`` picks a table inside SQLite files.  The session comes from the environment
(``getOrCreate``); its ``spark.checkpoint.dir`` must name a shared folder on a cluster.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="geoprep")
    ap.add_argument("job", choices=["boundaries", "combined", "postal", "serve"])
    for opt in ("adm0", "adm1", "adm2", "records", "bodies", "postal", "out", "table"):
        ap.add_argument(f"--{opt}")
    ap.add_argument("--chunk-rows", type=int, default=None)
    ap.add_argument("--max-chunks", type=int, default=None)
    ap.add_argument("--staged", help="folder of the staged records; an interrupted load resumes when it is given again")
    ap.add_argument("--load-id", help="name of the load (default: derived from the staged files)")
    ap.add_argument("--format", default="parquet")
    a = ap.parse_args(argv)

    from geoprep.session import ensure_checkpoint_dir
    spark = SparkSession.builder.appName(f"geoprep-{a.job}").getOrCreate()
    ensure_checkpoint_dir(spark)
    from geoprep.plans import jobs
    from geoprep.sources.tables import path_exists, read_table, write_table

    def load(path):
        return jobs.load_boundaries(spark, path, table=a.table) if path else None

    if a.job == "boundaries":
        reports = jobs.run_all_levels(spark, {"ADM0": load(a.adm0), "ADM1": load(a.adm1), "ADM2": load(a.adm2)},
                                      a.out, fmt=a.format)
        print(json.dumps(reports))
    elif a.job == "combined":
        from geoprep.operators.boundary import combine_levels
        levels = {"ADM0": load(a.adm0), "ADM1": load(a.adm1), "ADM2": load(a.adm2)}
        missing = [k for k, v in levels.items() if v is None]
        if missing:
            print(json.dumps({"job": "combined", "status": "skipped", "missing": missing}))
        else:
            write_table(combine_levels(levels), a.out, fmt=a.format)
    elif a.job == "postal":
        from geoprep.operators.postal import enrich_postal, gazetteer_records
        from geoprep.spec import POSTAL_PARTITIONS
        spr, bodies = read_table(spark, a.records), read_table(spark, a.bodies)
        adm1, adm2 = load(a.adm1), load(a.adm2)
        if a.chunk_rows:
            from geoprep.session import scratch_dir
            from geoprep.streaming.incremental import chunked_load, stage_records
            recs = a.staged
            if recs is None or not path_exists(spark, recs):
                recs = stage_records(gazetteer_records(spr, bodies), recs or scratch_dir(spark, "records"), a.chunk_rows)
            print(json.dumps(chunked_load(spark, recs, adm1, adm2, a.out, load_id=a.load_id, max_chunks=a.max_chunks)))
        else:
            write_table(enrich_postal(spr, bodies, adm1, adm2), a.out, mode="append", partition_by=POSTAL_PARTITIONS,
                        deal_by=POSTAL_PARTITIONS[:-1])
    elif a.job == "serve":
        jobs.store_postal(spark, a.postal, a.out, fmt=a.format)


if __name__ == "__main__":
    main()
