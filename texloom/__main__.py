"""Run one variant end to end: ``spark-submit texloom/__main__.py <variant> <archive root> <output root>``.

Variants: ``figures`` (figure + caption records and assets), ``labeled`` (per-paper figure
lists with labels), ``arrays`` (per-paper texts/images/captions), ``lists`` (per-file
interleaved lists), ``full`` (per-paper segments + figures). Reruns skip finished archives.
With ``--outer`` the root holds large tars of papers' archives; these are unpacked to ``<out>/inner`` first.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from texloom.plans import variants as V  # noqa: E402
from texloom.session import BROADCAST_CONF, require_shared_folder  # noqa: E402

RUNNERS = {
    "figures": V.run_figure_captions,
    "labeled": V.run_labeled_figures,
    "arrays": V.run_interleaved_arrays,
    "lists": V.run_interleaved_lists,
    "full": V.run_interleaved_full,
}


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="texloom")
    p.add_argument("variant", choices=sorted(RUNNERS))
    p.add_argument("root", help="folder (any Hadoop filesystem URI) holding the paper archives")
    p.add_argument("out", help="output folder")
    p.add_argument("--glob", default=None, help="archive name pattern (default per variant)")
    p.add_argument("--buckets", type=int, default=64)
    p.add_argument("--format", default="parquet", choices=["parquet", "json"],
                   help="record format of the per-paper / per-file outputs (not used by 'figures')")
    p.add_argument("--outer", default=None, metavar="GLOB", help="the root holds outer tars of this name pattern")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"texloom-{a.variant}").getOrCreate()
    require_shared_folder(spark)
    for key, value in BROADCAST_CONF.items():
        spark.conf.set(key, value)
    root = a.root
    if a.outer:
        root = f"{a.out.rstrip('/')}/inner"
        for broken in V.unpack_outer_tars(spark, a.root, root, a.outer).toLocalIterator():
            print(f"cannot read {broken.path}: {broken.error}", file=sys.stderr)
    kwargs = {"n_buckets": a.buckets}
    if a.glob:
        kwargs["glob"] = a.glob
    if a.variant != "figures":
        kwargs["fmt"] = a.format
    RUNNERS[a.variant](spark, root, a.out, **kwargs)


if __name__ == "__main__":
    main()
