"""Command line: the run modes of the reference, as Spark jobs.

    python -m tierline transform   --source DIR [--lake PATH]
    python -m tierline full        --source DIR [--lake PATH]
    python -m tierline incremental --source DIR [--lake PATH] --tasks 100
    python -m tierline models      --source DIR [--lake PATH]
    python -m tierline wap         --source DIR [--lake PATH]

``--kind`` says what the folder ``--source`` holds: ``tables`` five Parquet
tables (seasons, events, categories, sessions, classifications), ``payloads``
landed JSON payloads of the same entities, ``star`` (default) the driver's
tables the entities are derived from.  ``--lake`` defaults to a folder under ``spark.checkpoint.dir``.
Each mode prints one JSON line with the gold row count and stage times.
"""

from __future__ import annotations

import argparse
import json
import time

from tierline.plans import runs
from tierline.plans.lake import Lake
from tierline.plans.medallion import land_classifications, land_crawl
from tierline.session import build_session, run_folder
from tierline.sources.entities import payload_entities, table_entities
from tierline.sources.fixture import derive_entities

SOURCES = {"star": derive_entities, "tables": table_entities, "payloads": payload_entities}


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="python -m tierline")
    ap.add_argument("mode", choices=["transform", "full", "incremental", "models", "wap"])
    ap.add_argument("--source", required=True)
    ap.add_argument("--kind", choices=sorted(SOURCES), default="star")
    ap.add_argument("--lake")
    ap.add_argument("--tasks", type=int,
                    help="tasks per run (default: 100 if incremental, else every open task)")
    ap.add_argument("--layout", choices=["scale", "reference"], default="scale",
                    help="bronze layout: by (season, event), or one folder level "
                         "per parent key down to the session")
    ap.add_argument("--master")
    args = ap.parse_args(argv)

    spark = build_session(args.master, app_name=f"tierline-{args.mode}")
    lake = Lake(args.lake or run_folder(spark, "lake"))
    src = SOURCES[args.kind](spark, args.source)
    t0 = time.monotonic()
    out: dict = {"mode": args.mode, "lake": lake.root}
    if args.mode == "transform":
        gold = runs.transform(spark, lake, src, layout=args.layout)
    elif args.mode in ("full", "incremental"):
        full = args.mode == "full"
        tasks = 100 if args.tasks is None and not full else args.tasks
        rep = runs.run(spark, lake, src, runs.FULL if full else runs.INCREMENTAL,
                       n=tasks, layout=args.layout)
        gold = rep.gold
        out.update(run_id=rep.run_id, stage_ms=rep.stage_ms, dq_alert=rep.dq_alert)
    else:
        # models and wap start from a landed bronze layer
        c = land_crawl(spark, lake, src.seasons, src, args.layout)
        land_classifications(lake, c.tasks, src.classifications, args.layout, replace=True)
        gold = (runs.models(spark, lake, lake.root + "/models") if args.mode == "models"
                else runs.wap_run(spark, lake))
    out["gold_rows"] = gold.count()
    out["seconds"] = round(time.monotonic() - t0, 3)
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
