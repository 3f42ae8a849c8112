"""python -m tidemark FOLDER [EVENTS]: run the engine on generated events and write its report there."""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from tidemark.plans.evidence import run


def main(folder: str, events: str = "5000") -> int:
    found = run(SparkSession.builder.appName("tidemark").getOrCreate(), folder, int(events))
    for name, holds in found.items():
        print(f"{'holds ' if holds else 'BROKEN'} {name}")
    return 0 if all(found.values()) else 1


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:3]))
