"""Small cases of the findings of round 4."""

import datetime

from strandline.plans import queries as core

from .compare import assert_same


def test_f2_a10_digest_tree_of_more_files_than_five_levels_hold(spark, tmp_path):
    """Files far apart, more than 8 ** 5 positions: the query has its SQL's five levels, whose top nodes are several."""
    import duckdb

    at = datetime.datetime(2024, 5, 1)
    rows = [(i, at + datetime.timedelta(seconds=40 * i), user, "view", 12.5) for i, user in enumerate([0, 0, 3, 8**5 - 1, 8**5, 8**5 + 9, 89_999, 300_000])]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    got = core.QUERIES["a10_digest_tree"](spark, str(tmp_path))
    assert_same(got, con, core.ORACLES["a10_digest_tree"])
    assert {r.level for r in got.collect()} == {1, 2, 3, 4, 5} and got.where("level = 5").count() == 4
