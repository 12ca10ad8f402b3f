"""Time the two forms of J3 (aggregate vs self-join) and J6 (equi vs theta).

Usage: python scripts/forms.py [sf_dir]   -> one JSON line (median of 3 after a warm-up)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from marquee.functions import split_list  # noqa: E402
from marquee.operators import array_match_join, dedupe_latest, unique_rows  # noqa: E402
from marquee.plans import models as M  # noqa: E402
from marquee.session import build_session  # noqa: E402
from tests.oracles import array_match_join_theta, unique_rows_selfjoin  # noqa: E402


def timed(fn, repeats=3):
    runs = []
    for i in range(repeats + 1):
        t0 = time.perf_counter()
        fn().write.format("noop").mode("overwrite").save()
        if i:
            runs.append(time.perf_counter() - t0)
    return round(statistics.median(runs), 4)


def row_number_latest(df, keys, order):
    w = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in order])
    return df.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 8)
    part = lambda: spark.read.parquet(f"{sf_dir}/part.parquet")
    li = lambda: spark.read.parquet(f"{sf_dir}/lineitem.parquet")

    def words():
        p = part().select("p_partkey", split_list("p_name", " ").alias("g"))
        return p, M.dim_genres(p.withColumnRenamed("g", "genres_array")).filter("genre not in ('anvil','red')")

    out = {
        "J3_aggregate_part": timed(lambda: unique_rows(part(), ["p_name", "p_size"], ["p_partkey"])),
        "J3_selfjoin_part": timed(lambda: unique_rows_selfjoin(part(), ["p_name", "p_size"], ["p_partkey"])),
        "J3_aggregate_lineitem": timed(lambda: unique_rows(li(), ["l_partkey", "l_suppkey"], ["l_orderkey"])),
        "J3_selfjoin_lineitem": timed(lambda: unique_rows_selfjoin(li(), ["l_partkey", "l_suppkey"], ["l_orderkey"])),
        "J6_equi": timed(lambda: array_match_join(*words()[:1], "g", words()[1], "genre", ["id"])),
        "SN8_max_by": timed(lambda: dedupe_latest(li(), ["l_partkey", "l_suppkey"], ["l_shipdate", "l_orderkey"])),
        "SN8_row_number": timed(lambda: row_number_latest(li(), ["l_partkey", "l_suppkey"], ["l_shipdate", "l_orderkey"])),
        "J6_theta": timed(lambda: array_match_join_theta(*words()[:1], "g", words()[1], "genre", ["id"])),
    }
    print(json.dumps({"sf_dir": sf_dir, "median_sec": out}))


if __name__ == "__main__":
    main()
