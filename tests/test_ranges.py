"""The sort of the extract brings so many keys to the driver, however many its records."""

from test_joined import files, written

from enrollspark.plans import extract as ex
from enrollspark.plans.queries import _file_lines


def test_ranges_and_files_of_a_range_are_bounded(spark, tmp_out, monkeypatch):
    """Before, every ``lines`` records were a range, of which the driver samples the keys."""
    n = written(spark, f"{tmp_out}/one", single_file=True)
    want = [r["value"] for r in spark.read.text(f"{tmp_out}/one").coalesce(1).collect()]
    monkeypatch.setattr(ex, "RANGES", 3)
    for most in (1000, 5):
        monkeypatch.setattr(ex, "FILES", most)
        path = f"{tmp_out}/{most}"
        assert written(spark, path, lines=10) == n
        names = [f.rsplit("/", 1)[-1] for f in files(path)]
        by_range = [sum(x.startswith(f"part-{k:05d}-") for x in names) for k in range(3)]
        assert sum(by_range) == len(names) >= n / max(10, -(-n // most)) and max(by_range) <= most
        assert [r["rec_type"] for r in _file_lines(spark, path, n).sort("line_no").collect()] == want
