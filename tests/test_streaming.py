from __future__ import annotations

import datetime as dt

from swelter.streaming.landing import merge_landed

SHAPE = "location_id int, date date, wetbulb double, wetbulb_avg double, source string"


def test_landed_files_are_merged_once(spark, tmp_path):
    landing, root, mark = (str(tmp_path / x) for x in ("in", "table", "mark"))
    day = dt.date(2020, 5, 1)
    land = lambda rows: spark.createDataFrame(rows, SHAPE).write.mode("append").parquet(landing)
    land([(1, day, 1.0, 1.0, "nldas"), (2, dt.date(2019, 5, 1), 1.0, 1.0, "isd")])
    merge_landed(spark, landing, root, mark).awaitTermination()
    land([(1, day, 2.0, 2.0, "ghcnh"), (2, dt.date(2019, 5, 1), 5.0, 5.0, "era5land"), (3, day, 3.0, 3.0, None)])
    merge_landed(spark, landing, root, mark).awaitTermination()
    merge_landed(spark, landing, root, mark).awaitTermination()
    got = {(r.location_id, r.year): (r.wetbulb, r.source) for r in spark.read.parquet(root).collect()}
    assert got == {(1, 2020): (2.0, "ghcnh"), (2, 2019): (1.0, "isd"), (3, 2020): (3.0, None)}
