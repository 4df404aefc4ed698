"""Command line: python -m tracewright COMMAND. Exit code 0, or 1 if findings are errors.

    list                          the queries
    run QUERY DIR [OUT]           a query over the tables in DIR, shown or written as Parquet
    validate DIR                  schema rules of all tables and readiness rules, as counts
    inspect DIR [EPISODE]         the inspector's verdict of every episode, or of one
    plan DIR / stage DIR / dataset DIR    the rules of export plans, staged frames, datasets
    dependencies                  what media libraries are there
"""

from __future__ import annotations

import json
import sys


def main(argv: list[str]) -> int:
    from tracewright.sources import media

    if not argv or argv[0] in ("-h", "--help"):
        print(__doc__)
        return 0
    command, args = argv[0], argv[1:]
    if command == "dependencies":
        found = media.dependencies()
        print(json.dumps({"libraries": found, **media.readiness(found)}, indent=2))
        return 0
    from tracewright.plans import checks, core, pipeline

    queries = {k: f for part in (core, checks, pipeline) for k, f in part.QUERIES.items()}
    if command == "list":
        print("\n".join(sorted(queries)))
        return 0
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from tracewright.operators import rules

    spark = SparkSession.builder.appName("tracewright").getOrCreate()
    reports = {"plan": "plan_report", "stage": "staged_report", "dataset": "dataset_report"}
    if command == "run" and len(args) in (2, 3):
        df = queries[args[0]](spark, args[1])
        df.write.mode("errorifexists").parquet(args[2]) if len(args) == 3 else df.show(20, False)
        return 0
    if command == "validate" and len(args) == 1:
        found = rules.report(rules.all_findings(core._tables(spark, args[0])).unionByName(checks.readiness_of(spark, args[0])))
    elif command == "inspect" and len(args) in (1, 2):
        found = queries["inspection"](spark, args[0])
        if len(args) == 2:
            found = found.where(F.col("episode_id") == args[1])
        found = found.withColumn("severity", F.when(F.col("status") == "failed", "error").otherwise("warning"))
    elif command in reports and len(args) == 1:
        found = queries[reports[command]](spark, args[0]).withColumn("severity", F.lit("error"))
    else:
        print(__doc__, file=sys.stderr)
        return 1
    rows = found.limit(1000).collect()
    for r in rows:
        print(json.dumps(r.asDict(), ensure_ascii=False, default=str))
    return int(not found.where("severity = 'error'").isEmpty())


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
