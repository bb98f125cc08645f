from __future__ import annotations

import os
import tempfile

from pyspark.sql import functions as F

from claimflow.operators import profile_state, profiling
from claimflow.sources.tables import manifest

COLUMNS = ["A", "B"]


def rows_of(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def test_states_add_up_over_many_files_and_read_each_once(spark):
    root = tempfile.mkdtemp(prefix="profile-")
    df = spark.range(2000).select(
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("k"), F.col("id") % 40)).alias("K"),
        F.when(F.col("id") % 3 > 0, (F.col("id") % 40).cast("string")).alias("A"),
        F.when(F.col("id") < 1999, F.lit("same")).otherwise(F.lit("other")).alias("B"), (F.col("id") % 20).alias("drop"),
    ).cache()
    seen = None
    for n in range(20):
        drop = df.where(f"drop = {n}").drop("drop")
        seen = drop if seen is None else seen.unionAll(drop)
        drop.coalesce(1).write.mode("append").parquet(f"{root}/t")
        state = profile_state.advance_profile(spark, f"{root}/t", drop.schema, root, "p", "K", COLUMNS)
        if n in (0, 1, 18, 19):
            assert rows_of(profile_state.null_profile_of(state, "K")) == rows_of(profiling.null_profile_by_key(seen, "K", COLUMNS))
            assert rows_of(profile_state.inconsistent_keys_of(state, "K")) == rows_of(profiling.inconsistent_keys(seen, "K", COLUMNS))
            want = profiling.null_counts(seen.select(*COLUMNS))
            assert rows_of(profile_state.null_counts_of(state)) == rows_of(want)
        if n == 10:  # what has been read cannot be read again, and is not
            for name in os.listdir(f"{root}/t"):
                if name.endswith(".parquet"):
                    os.truncate(f"{root}/t/{name}", 0)
    assert len(manifest(spark, root, "profile", "p").folders) < profile_state.MOST_PARTS
    again = profile_state.advance_profile(spark, f"{root}/t", df.drop("drop").schema, root, "p", "K", COLUMNS)
    assert rows_of(again) == rows_of(state)
    nothing = profile_state.advance_profile(spark, f"{root}/none", df.schema, root, "q", "K", COLUMNS)
    assert nothing.count() == 0
