"""Command line: one step of a harmonisation run per call.

    python -m carestitch vocabulary  -c config.json
    python -m carestitch stage-csv   -c config.json
    python -m carestitch stage-ehr   -c config.json
    python -m carestitch stage-ccda  -d documents -o staged --salt text
    python -m carestitch map         -c config.json
    python -m carestitch report      -m manifest.json -o folder [--extended]
    python -m carestitch publish     -m manifest.json -n database -d location [--format delta]
    python -m carestitch jdbc        -m manifest.json -c config.json [--schema s] [-x]
    python -m carestitch cdm-source  -n database -c metadata.json
"""

from __future__ import annotations

import argparse
import json

from .plans.cdm_source import populate_cdm_source
from .plans.pipeline import map_to_cdm, stage_documents, write_report
from .session import get_session
from .sinks.parquet import read_manifest
from .sinks.publish import jdbc_targets, publish_tables, write_jdbc
from .sources.ehr_csv import stage_extract
from .sources.tabular import StagingConfig, stage_csv
from .sources.vocabulary import build_vocabulary

STEPS = ("vocabulary", "stage-csv", "stage-ehr", "stage-ccda", "map", "report", "publish", "jdbc", "cdm-source")


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="carestitch", description=__doc__,
                                     formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("step", choices=STEPS)
    parser.add_argument("-c", "--config")
    parser.add_argument("-m", "--manifest")
    parser.add_argument("-n", "--database")
    parser.add_argument("-d", "--directory")
    parser.add_argument("-o", "--output")
    parser.add_argument("--salt", default="")
    parser.add_argument("--format", default="delta")
    parser.add_argument("--schema")
    parser.add_argument("--ddl", choices=("mssql", "psql"), help="load rules to publish or write under")
    parser.add_argument("--version", default="5.4", help="model version of what is published or written")
    parser.add_argument("--extended", action="store_true")
    parser.add_argument("-x", "--exclude-concept-tables", action="store_true")
    parser.add_argument("--exclude-source-tables", action="store_true")
    parser.add_argument("-l", "--run-local", action="store_true")
    parser.add_argument("--spark-config")
    return parser.parse_args()


def _json(path: str | None) -> dict:
    if not path:
        return {}
    with open(path) as text:
        return json.load(text)


def main() -> None:
    args = _arguments()
    config = _json(args.config)
    spark = get_session(f"carestitch {args.step}", args.run_local, _json(args.spark_config))
    manifest = read_manifest(spark, args.manifest) if args.manifest and args.step != "map" else {}
    if args.step == "vocabulary":
        build_vocabulary(spark, config)
    elif args.step == "stage-csv":
        stage_csv(spark, StagingConfig.from_dict(config))
    elif args.step == "stage-ehr":
        stage_extract(spark, config)
    elif args.step == "stage-ccda":
        stage_documents(spark, args.directory, args.salt, args.output, config.get("key_registry_path"))
    elif args.step == "map":
        map_to_cdm(spark, config, args.manifest or f"{args.config}.generated.parquet.json")
    elif args.step == "report":
        for name, path in write_report(spark, manifest, args.output, args.extended).items():
            print(name, spark.read.parquet(path).count(), path)
    elif args.step == "publish":
        publish_tables(spark, manifest, args.database, args.directory, args.format, args.version, args.ddl)
    elif args.step == "jdbc":
        targets = jdbc_targets(manifest, args.schema, args.exclude_concept_tables, args.exclude_source_tables)
        write_jdbc(spark, targets, config["jdbc"]["connection_string"], config["jdbc"]["properties"],
                   version=args.version, dialect=args.ddl)
    else:
        populate_cdm_source(spark, args.database, config, args.format)


if __name__ == "__main__":
    main()
