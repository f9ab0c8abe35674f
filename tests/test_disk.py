"""What a query leaves on disk: its own tables, and no shuffle files."""

import os

from carestitch.bridge import views
from carestitch.bridge.views import Bridge
from carestitch.plans import builds as B
from carestitch.sinks.parquet import write_and_reload

FOLDER = "/root/testdata/sf0.001"


def _shuffle_files(spark) -> set[str]:
    folders = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
    return {name for folder in folders for _, _, names in os.walk(folder) for name in names if name.startswith("shuffle_")}


def test_a_written_table_leaves_no_shuffle(spark, tmp_path):
    before = _shuffle_files(spark)
    back = write_and_reload(spark.range(1000).repartition(3, "id"), f"{tmp_path}/t")
    assert back.count() == 1000
    left = {name for name in _shuffle_files(spark) - before if name.endswith(".data")}
    # count() above may leave one exchange of its own: a row a task.
    assert len({name.split("_")[1] for name in left}) <= 1


def test_a_table_reads_the_staging_tables_it_is_made_of(spark):
    bridge = Bridge(spark, FOLDER)
    assert bridge.cdm.contribution(B.CONDITION, "condition_occurrence").count() > 0
    written = set(os.listdir(f"{bridge.folder.removeprefix('file://')}/staged"))
    # The facts are written once, not once more for each staging table made of them, and other sources not at all.
    assert "fact.parquet" in written
    assert not written & {f"{t}.parquet" for t in (
        "source_condition", "source_procedure", "source_device", "source_medication", "source_result", "source_note", "source_payer")}
    assert set(os.listdir(f"{bridge.folder.removeprefix('file://')}/books")) <= {
        "source_condition", "source_person", "source_encounter", "source_provider"}


def test_waves_hold_every_row_with_the_id_of_the_whole_table(spark, monkeypatch):
    monkeypatch.setattr(views, "WAVE_ROWS", 1000)
    bridge = Bridge(spark, FOLDER)
    waves = [df.select("s_id", "g_id") for df in bridge.waves("source_result")]
    whole = bridge("source_result").select("s_id", "g_id")
    assert len(waves) == 8 and all(df.count() > 0 for df in waves)
    assert sorted(row for df in waves for row in df.collect()) == sorted(whole.collect())
    matched, lazy = bridge.cdm.matched(B.CONDITION), bridge.cdm._resolved(B.CONDITION)
    columns = ["s_id", "s_g_id", "person_id", "visit_occurrence_id", "g_concept_id", "g_ordinal"]
    assert sorted(map(str, matched.select(columns).collect())) == sorted(map(str, lazy.select(columns).collect()))


def test_staging_files_of_a_table_go_before_the_next(spark):
    import carestitch.bridge.checks_sinks  # noqa: F401 registers the query
    from carestitch.bridge.registry import QUERIES
    bridge = Bridge(spark, FOLDER)
    assert QUERIES["stage_generic_csv"](bridge).count() > 0
    left = os.listdir(f"{bridge.folder.removeprefix('file://')}/staging_csv")
    assert not [name for name in left if name.startswith("IN_")]
