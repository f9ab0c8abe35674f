"""Run folders and the swap of the manifest."""

import os

import pytest

from carestitch.sinks.parquet import read_manifest, write_manifest
from carestitch.sinks.versions import new_version, prune_versions, versions


def test_a_manifest_is_replaced_whole_and_leaves_no_draft(spark, tmp_path):
    path = f"{tmp_path}/new/manifest.json"
    write_manifest(spark, {"a": {"t": "1"}}, path)
    write_manifest(spark, {"b": {"t": "\u00e9"}}, path)
    assert read_manifest(spark, path) == {"b": {"t": "\u00e9"}}
    assert {n for n in os.listdir(f"{tmp_path}/new") if not n.endswith(".crc")} == {"manifest.json"}


def test_a_manifest_that_cannot_be_written_leaves_the_one_before(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/manifest.json"
    write_manifest(spark, {"a": {"t": "1"}}, path)
    with pytest.raises(TypeError):
        write_manifest(spark, {"a": {"t": object()}}, path)
    assert read_manifest(spark, path) == {"a": {"t": "1"}}


def test_older_runs_go_and_newer_and_other_folders_stay(spark, tmp_path):
    names = [new_version(str(tmp_path)) for _ in range(5)]
    for folder in (*names, f"{tmp_path}/other"):
        os.mkdir(folder)
    short = [n.rpartition("/")[2] for n in names]
    assert versions(spark, str(tmp_path)) == short == sorted(short)
    assert prune_versions(spark, str(tmp_path), names[3], 2) == short[:2]
    assert versions(spark, str(tmp_path)) == short[2:] and os.path.isdir(f"{tmp_path}/other")
    assert prune_versions(spark, str(tmp_path), names[3], 9) == []
    assert versions(spark, f"{tmp_path}/nowhere") == []
    with pytest.raises(ValueError):
        prune_versions(spark, str(tmp_path), names[3], 0)
