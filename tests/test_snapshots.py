"""Commits of id marks: rows changed, conflicts, and what readers see."""

import pytest

from opsloom.sources.snapshots import Conflict, SnapshotTable, mark


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id bigint")


def held(frame):
    return sorted(r["id"] for r in frame.collect())


def test_marks_return_the_rows_changed(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), "id bigint")
    assert held(table.read()) == [] and table.latest().version == 0
    assert mark(table, ids(spark, 1, 2, 2, None)) == 2
    assert mark(table, ids(spark, 2, 3)) == 1
    assert mark(table, ids(spark, 1, 3)) == 0
    assert mark(table, ids(spark)) == 0
    assert table.latest().version == 2
    assert held(table.read()) == [1, 2, 3]
    assert held(table.read(table.at(1))) == [1, 2]


def test_of_two_competing_commits_one_wins_and_no_id_is_lost(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), "id bigint")
    mark(table, ids(spark, 1))
    base = table.latest()
    ours, theirs = table.write(ids(spark, 2)), table.write(ids(spark, 3))
    table.publish(base, theirs)
    with pytest.raises(Conflict):
        table.publish(base, ours)
    assert held(table.read()) == [1, 3]     # nothing of the loser is seen
    assert mark(table, ids(spark, 2)) == 1  # it starts again from the new version
    assert held(table.read()) == [1, 2, 3]


def test_mark_starts_again_after_a_conflict(spark, tmp_path):
    class Raced(SnapshotTable):
        raced = False

        def publish(self, base, folder):
            if not self.raced:
                self.raced = True
                other = SnapshotTable(self.spark, self.path, self.schema)
                assert mark(other, ids(self.spark, 2, 7)) == 2
            return super().publish(base, folder)

    table = Raced(spark, str(tmp_path / "t"), "id bigint")
    assert mark(table, ids(spark, 1, 2)) == 1       # 2 was marked by the other
    assert held(table.read()) == [1, 2, 7]


def test_attempts_are_bounded(spark, tmp_path):
    class Busy(SnapshotTable):
        def publish(self, base, folder):
            raise Conflict("busy")

    with pytest.raises(Conflict):
        mark(Busy(spark, str(tmp_path / "t"), "id bigint"), ids(spark, 1), attempts=2)
    assert SnapshotTable(spark, str(tmp_path / "t"), "id bigint").latest().version == 0
