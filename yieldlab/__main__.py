"""Command line: the whole analysis from raw text files.

    python -m yieldlab SENSORS.data LABELS.data OUT_DIR [--tune-on test]
    python -m yieldlab SENSORS.data LABELS.data OUT_DIR --score-with EARLIER_OUT_DIR/model

Writes ``production_logs``, ``ml_predictions`` and ``root_cause_analysis``
(Parquet, partitioned by production date), ``cleaned_features``, ``labels``
and the model bundle under OUT_DIR. With ``--score-with`` nothing is fitted:
the saved model, threshold and cleaner give ``ml_predictions`` and
``root_cause_analysis`` of the units. Prints the run's metrics, evaluation, row counts and view check as
one JSON line, and deletes the tables it staged in the checkpoint folder. Spark settings come
from the usual ``spark-submit`` / ``--conf`` mechanisms; set
``spark.checkpoint.dir`` to a shared folder on a cluster.
"""

from __future__ import annotations

import argparse
import json
import sys


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="python -m yieldlab")
    ap.add_argument("sensors")
    ap.add_argument("labels")
    ap.add_argument("out_dir")
    ap.add_argument("--tune-on", default="validation", choices=["validation", "test"])
    ap.add_argument("--fit-cleaner-on", default="all", choices=["all", "train"])
    ap.add_argument("--top-n", type=int, default=3)
    ap.add_argument("--max-iter", type=int, default=400)
    ap.add_argument("--explain", default="failures", choices=["failures", "all"])
    ap.add_argument("--top-sensors", type=int, default=None, help="sensors in the production log, by variance")
    ap.add_argument("--score-with", default=None, metavar="BUNDLE", help="score and explain with a saved model")
    args = ap.parse_args(argv)

    from .operators.boosting import BoostParams
    from .plans.end_to_end import run_from_text, score_units, units_from_labels
    from .plans.quality import smoke_test, table_row_counts
    from .sources.text import load_label_text, load_sensor_text, resolve_path
    from .session import drop_materialized, get_session

    spark = get_session()
    if args.score_with:
        predictions, rca = score_units(
            spark,
            args.score_with,
            load_sensor_text(spark, resolve_path(spark, args.sensors)).withColumnRenamed("row_idx", "unit_no"),
            units_from_labels(load_label_text(spark, resolve_path(spark, args.labels))),
            top_n=args.top_n,
            out_dir=args.out_dir,
        )
        counts = table_row_counts({"ml_predictions": predictions, "root_cause_analysis": rca})
        metrics = {"table_row_counts": [r.asDict() for r in counts.collect()]}
        drop_materialized(spark)
        print(json.dumps(metrics))
        return metrics
    run = run_from_text(
        spark,
        resolve_path(spark, args.sensors),
        resolve_path(spark, args.labels),
        out_dir=args.out_dir,
        tune_on=args.tune_on,
        fit_cleaner_on=args.fit_cleaner_on,
        top_n=args.top_n,
        gbt_params=BoostParams(rounds=args.max_iter),
        explain=args.explain,
        top_sensors=args.top_sensors,
    )
    run.save(f"{args.out_dir}/model")
    metrics = dict(run.metrics, views=run.views)
    for name, df in run.evaluation.items():  # small tables
        metrics[name] = [r.asDict() for r in df.collect()]
    metrics["smoke_test"] = [r.asDict() for r in smoke_test(spark, run.views).collect()]
    drop_materialized(spark)
    print(json.dumps(metrics, default=str))
    return metrics


if __name__ == "__main__":
    main(sys.argv[1:])
    sys.exit(0)
