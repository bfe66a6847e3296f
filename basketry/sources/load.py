"""Load the extracts and print the rows of each table.

    spark-submit -m basketry.sources.load --data-dir ... --tables-dir ...
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from basketry.sources.extracts import load_tables


def main(argv: list[str] | None = None) -> int:
    """Publish the tables; 2 if a check refuses the extracts, which leaves the old tables."""
    parser = argparse.ArgumentParser(description="Load the marketplace extracts")
    parser.add_argument("--data-dir", required=True)
    parser.add_argument("--tables-dir", required=True)
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("basketry-load").getOrCreate()
    try:
        counts = load_tables(spark, args.data_dir, args.tables_dir)
    except (ValueError, FileNotFoundError) as error:
        print(error, file=sys.stderr)
        return 2
    for name, rows in counts.items():
        print(f"{name}: {rows} rows")
    return 0


if __name__ == "__main__":
    sys.exit(main())
