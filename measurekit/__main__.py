"""``python -m measurekit <job> <paths...>`` or ``spark-submit`` with the same arguments."""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from .plans.jobs import JOBS


def main(arguments: list[str]) -> int:
    if not arguments or arguments[0] not in JOBS:
        print(f"usage: measurekit <{'|'.join(JOBS)}> <input> [<bundle>] [<output>]", file=sys.stderr)
        return 2
    spark = SparkSession.builder.appName(f"measurekit {arguments[0]}").getOrCreate()
    result = JOBS[arguments[0]](spark, *arguments[1:])
    if arguments[0] == "compare-readers":
        result.show(truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
