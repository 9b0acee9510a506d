"""Rebuild one region: ``spark-submit ... -m postlens <sources> <out> <settings.json>``.

The settings file holds the fields of ``postlens.settings.Settings``.
"""

from __future__ import annotations

import json
import sys

from postlens.plans.rebuild import rebuild
from postlens.plans.stored_views import store_views
from postlens.settings import Settings
from postlens.sources import build_session, read_sources


def main(base: str, out: str, settings_file: str) -> None:
    with open(settings_file, encoding="utf8") as f:
        settings = Settings(**json.load(f))
    spark = build_session()
    sources = read_sources(spark, base, settings)
    rebuild(sources, out, settings)
    store_views(spark, base, out, settings)
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
