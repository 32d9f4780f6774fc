import json

from leafline import schemas as SC
from leafline.functions.dates import COMPACT
from leafline.operators import records as R
from leafline.streaming.daily import run_new_days, stream_days


def test_only_new_days_are_processed(spark, tmp_path):
    src, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    src.mkdir()

    def run():
        days = stream_days(spark, f"{src}/*.json", SC.N_RUNNING, COMPACT)
        run_new_days(days, R.prepare_n, out, state).awaitTermination()
        got = spark.read.parquet(out)
        return sorted((r.t_index, str(r.snapshot_date)) for r in got.collect())

    (src / "20240309.json").write_text(json.dumps([{"t_IDs": "1"}, {"t_IDs": "2"}]))
    assert run() == [("N1", "2024-03-09"), ("N2", "2024-03-09")]
    (src / "20240310.json").write_text(json.dumps([{"t_IDs": "1"}]))
    want = [("N1", "2024-03-09"), ("N1", "2024-03-10"), ("N2", "2024-03-09")]
    assert run() == want
    assert run() == want
