from __future__ import annotations

import tollbook as tb
from tollbook import workspace


def test_intermediates_of_this_application_are_cleared_and_no_others(spark, monkeypatch):
    monkeypatch.setattr(workspace, "_new_paths", {})
    mine = [workspace.new_path(spark, "mine") for _ in range(3)]
    for path in mine[:2]:
        spark.range(3).write.parquet(path)
    other = f"{workspace.shared_dir(spark)}/other"
    spark.range(3).write.mode("overwrite").parquet(other)
    assert tb.clear_intermediates(spark) == 2
    assert not any(workspace.exists(spark, path) for path in mine) and workspace.exists(spark, other)
    assert tb.clear_intermediates(spark) == 0


def test_a_name_that_is_taken_is_not_renamed_over(spark, tmp_path):
    for name in ("a", "b"):
        spark.range(1).write.parquet(str(tmp_path / name))
    try:
        workspace.rename(spark, str(tmp_path / "a"), str(tmp_path / "b"))
        raise AssertionError("renamed")
    except FileExistsError:
        assert (tmp_path / "a").exists() and (tmp_path / "b").exists()


def test_states_of_files_change_with_any_of_them(spark, tmp_path):
    (tmp_path / "m").mkdir()
    (tmp_path / "m/a.csv").write_text("x")
    before = workspace.file_states(spark, str(tmp_path / "m"))
    assert before == workspace.file_states(spark, str(tmp_path / "m")) != ""
    (tmp_path / "m/b.csv").write_text("y")
    assert workspace.file_states(spark, str(tmp_path / "m")) != before
    assert workspace.file_states(spark, str(tmp_path / "none")) == ""
